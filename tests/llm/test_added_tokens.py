"""Added tokens inside texts, against the unmodified library on whole texts."""

from __future__ import annotations

import json
import zlib
from pathlib import Path

import numpy as np
import pytest

from recordloom.llm import queries, wavelet

from .conftest import ODD_TEXTS

public = pytest.importorskip("public_tokenizers")
JSON = public.path("byte_bpe_50k.json")
END = "<|endoftext|>"
TEXTS = [
    *ODD_TEXTS, END, f"{END}{END}", f"a  {END}  b", f"it{END}'ll", f" {END}\n\n{END} \n x", END[:-1],
    END[1:], f"<{END}>", f"über{END}ñandú 😀{END}", "<|endof", "text|> b", f"x {END}", f"{END[:5]}{END}", "", "'s",
]


def expected_rows(rows, file=JSON):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(str(file))
    start = 0
    for doc_id, text in sorted(rows):
        ids = [*made.encode(text or "", add_special_tokens=False).ids, 2]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_query_finds_added_tokens(spark, frame, tmp_path):
    rows = list(enumerate(TEXTS))
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op7_wavelet"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == list(expected_rows(rows))


@pytest.mark.parametrize("flags", [{}, {"lstrip": True}, {"single_word": True}])
def test_several_added_tokens(spark, frame, tmp_path, flags):
    made = json.loads(Path(JSON).read_text(encoding="utf-8"))
    extra = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}
    made["added_tokens"] += [
        {"id": 50257, "content": f"{END}{END}", **extra, **flags},
        {"id": 50258, "content": "blanks", **extra, **flags},
    ]
    file = tmp_path / "more.json"
    file.write_text(json.dumps(made), encoding="utf-8")
    rows = list(enumerate(TEXTS))
    path = str(tmp_path / "shards")
    wavelet.write_shards(frame(rows), str(file), path, end_id=2, shard_tokens=500, added_tokens=True)
    assert sorted(map(tuple, wavelet.read_shards(spark, path).collect())) == list(expected_rows(rows, file))
