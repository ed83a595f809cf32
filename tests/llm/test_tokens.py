"""BPE and wavelet shards against the public libraries, on whole texts."""

from __future__ import annotations

import base64
import hashlib
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import regex
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import arrays, bpe, queries, wavelet

from .conftest import ODD_TEXTS

public = pytest.importorskip("public_tokenizers")
RANKS = public.path("byte_bpe_multi_50k.tiktoken")
JSON = public.path("byte_bpe_50k.json")


def own_pretokens(texts):
    points, offsets = arrays.code_points(*arrays.text_buffer(pa.array(texts, pa.string())))
    begin, length, _, at = arrays.pretokens(points, offsets)
    joined = points.tobytes().decode("utf-32-le")
    pieces = [joined[b : b + n] for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
    return [pieces[lo:hi] for lo, hi in zip(at[:-1], at[1:], strict=True)]


def test_pretokens_match_the_pattern(monkeypatch):
    expected = [regex.findall(public.PATTERN, t or "") for t in ODD_TEXTS]
    assert own_pretokens(ODD_TEXTS) == expected
    monkeypatch.setattr(arrays, "STRETCH", 16)
    assert own_pretokens(ODD_TEXTS) == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="a sd'rev l\n\t1½é! ", max_size=30), max_size=4))
def test_pretokens_of_any_text(texts):
    assert own_pretokens(texts) == [regex.findall(public.PATTERN, t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\tA é", max_size=40), min_size=1, max_size=4))
def test_words_are_those_of_the_contract(texts):
    hashes, at = arrays.words(*arrays.text_buffer(pa.array(texts)))
    plain = [regex.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) for t in texts]
    assert np.diff(at).tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert len(set(flat)) == len(set(hashes.tolist()))


def test_words_across_stretches(monkeypatch):
    texts = [t for t in ODD_TEXTS if t] * 2
    column = pa.array(texts)
    whole = arrays.words(*arrays.text_buffer(column))
    monkeypatch.setattr(arrays, "STRETCH", 8)
    cut = arrays.words(*arrays.text_buffer(column))
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def tiktoken_rows(rows):
    import tiktoken

    lines = map(bytes.split, Path(RANKS).read_bytes().splitlines())
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    own = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for doc_id, text in rows:
        ids = own.encode_ordinary(text or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        yield doc_id, len(ids), listed, hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_matches_the_library(spark, frame):
    rows = list(enumerate(ODD_TEXTS))
    tokens = bpe.read_ranks(RANKS)
    got = bpe.digests(frame(rows), tokens, ["doc_id"]).collect()
    assert sorted(map(tuple, got)) == sorted(tiktoken_rows(rows))


def test_bpe_query_on_all_documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op6_bpe"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == sorted(tiktoken_rows(rows))


def test_bpe_round_trip_and_extra_columns(frame):
    docs = frame(list(enumerate(ODD_TEXTS)))
    tokens = bpe.read_ranks(RANKS)
    back = bpe.decode(bpe.encode(docs, tokens), tokens)
    assert back.columns == [*docs.columns, "ids", "bytes"]
    for row in back.collect():
        assert bytes(row["bytes"]).decode() == (row["text"] or "")


def test_long_pieces_take_the_same_merges():
    pairs = bpe.BytePairs(bpe.read_ranks(RANKS))
    rng = np.random.default_rng(3)
    for n in (2, 3, 7, 40, 200, 256):
        piece = bytes(rng.choice(list(b"thereinag"), n).tolist())
        ids, _ = pairs.pieces([piece.decode()])
        assert ids.tolist() == pairs.long_piece(piece)


def test_empty_table(frame):
    assert bpe.digests(frame([]), bpe.read_ranks(RANKS), ["doc_id"]).collect() == []


def expected_shard_rows(rows):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(JSON)
    made.encode_special_tokens = True
    start = 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = [*made.encode(text or "", add_special_tokens=False).ids, 2]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_wavelet_matches_the_library(spark, frame, tmp_path):
    rows = list(enumerate(ODD_TEXTS))
    path = str(tmp_path / "shards")
    wavelet.write_shards(frame(rows), JSON, path, end_id=2, shard_tokens=500)
    got = wavelet.read_shards(spark, path).collect()
    assert sorted(map(tuple, got)) == list(expected_shard_rows(rows))


def test_wavelet_query_on_all_documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op7_wavelet"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == list(expected_shard_rows(rows))


def test_wavelet_empty_table(spark, frame, tmp_path):
    path = str(tmp_path / "none")
    wavelet.write_shards(frame([]), JSON, path, end_id=2)
    assert wavelet.read_shards(spark, path).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 37), min_size=1, max_size=1500))
def test_wavelet_lookups(ids):
    sequence = np.array(ids, np.uint16)
    matrix = wavelet.WaveletMatrix.build(sequence, 6)
    assert matrix.ids().tolist() == ids
    for i in range(0, len(ids), max(1, len(ids) // 7)):
        value = ids[i]
        assert matrix.access(i) == value
        assert matrix.rank(value, i) == ids[:i].count(value)
        assert matrix.select(value, ids[:i].count(value)) == i
    assert matrix.select(ids[0], ids.count(ids[0])) == -1
