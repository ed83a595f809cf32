"""Lookups in written shards against the library's ids."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recordloom.llm import shard_lookup, wavelet

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    texts = [None, "", "the cat and the dog", "the " * 900, "ñandú über 東京", *[f"row {i} of the set" for i in range(80)]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, "the same key"), (None, "the row without key")]
    path = str(tmp_path_factory.mktemp("lookup") / "shards")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wavelet.write_shards(docs, FILE, path, end_id=2, shard_tokens=300)
    made = Tokenizer.from_file(FILE)
    return path, [(key, [*made.encode(text or "", add_special_tokens=False).ids, 2]) for key, text in rows]


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_counts_and_occurrences(spark, written):
    path, docs = written
    asked = [2, docs[2][1][0], docs[4][1][1], 49_999, 70_000, -1, 1 << 40]
    places = [(key, t, p) for key, ids in docs for p, t in enumerate(ids) if t in asked]
    assert ordered(shard_lookup.occurrences(spark, path, asked).collect()) == ordered(places)
    sums = [(key, t, ids.count(t)) for key, ids in docs for t in set(asked) & set(ids)]
    assert ordered(shard_lookup.counts(spark, path, asked).collect()) == ordered(sums)
    assert shard_lookup.counts(spark, path, []).collect() == []


def test_ids_at_positions(spark, written):
    path, docs = written
    asked = [(key, p) for key, ids in docs for p in (0, len(ids) - 1, len(ids), -1, None)] + [(9999, 0), (3, 500), (3, 500)]
    wanted = spark.createDataFrame(asked, "doc_id long, position long")
    expected = [
        (key, p, ids[p]) for key, ids in docs for k, p in set(asked)
        if k == key and key is not None and p is not None and 0 <= p < len(ids)
    ]
    assert ordered(shard_lookup.ids_at(wanted, path).collect()) == ordered(expected)
    assert shard_lookup.ids_at(wanted.limit(0), path).collect() == []


def test_arrays_of_positions():
    rng = np.random.default_rng(1)
    for n in (1, 511, 512, 513, 5000):
        ids = rng.integers(0, 50, n).astype(np.uint16)
        planes = shard_lookup.Planes(wavelet.WaveletMatrix.build(ids, 6))
        at = np.arange(n + 1)
        assert (planes.ids_at(at[:-1]) == ids).all()
        for value in (0, 7, 49, 63):
            assert (planes.occurrences(value) == np.flatnonzero(ids == value)).all()
            assert (planes.ranks(value, at) == np.append(0, np.cumsum(ids == value))).all()
