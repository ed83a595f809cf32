from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text) pairs, with a clashing extra column."""

    def make(rows, partitions=3):
        data = [(i, t, "en", f"src{k % 3}", len(t or ""), "x") for k, (i, t) in enumerate(rows)]
        schema = "doc_id long, text string, lang string, source string, n_chars long, __text string"
        return spark.createDataFrame(data, schema).repartition(partitions)

    return make


ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "it's we'll 's 'sa ''s !'s I'VE they've\n's 'd'd", "  two  blanks ",
    "tab\there\x0b\x0cnew\r\nline \n x", "über straße école ñandú 12½ ²x Ⅷ ٣٤", "日本語のテキスト 한국어",
    "emoji 😀😀 👩‍👩‍👧 é", "nbsp here em　wide \x1c\x1d\x85end", "a" * 3000,
    "<|endoftext|> x", "word " * 400, "same text twice here now", "same text twice here now", "!!!???---   'll",
    "ab" * 700 + " " + "thon" * 300, "x" * 70 + " " * 90 + "\n" * 40 + "y", "A B C d E", "'", " '", "'r", "'re",
]
