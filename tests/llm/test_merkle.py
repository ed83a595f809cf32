"""The Merkle manifest against a plain recursive version."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from recordloom.llm import merkle, toxicity
from recordloom.operators import ranges

from .conftest import ODD_TEXTS

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, pos int, named string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[1], row[2], row[3], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grown(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, at):
    out = []
    for row in levels[:-1]:
        lo = at - at % 8
        out.append((row[lo:at], row[at + 1 : lo + 8]))
        at //= 8
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[lang] = grown([leaf(r, r[4]) for r in by[lang]])
    top = grown([trees[x][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        for at, r in enumerate(by[lang]):
            steps = path(trees[lang], at) + path(top, k)
            digest = trees[lang][0][at]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                digest = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            for before, after in steps:
                digest = h(*before, digest, *after)
            proof = h(*[x for before, after in steps for x in before + after])
            root = top[-1][0]
            out.append((r[0], trees[lang][0][at], trees[lang][-1][0], root, proof, digest, digest == root))
    return out


def run(spark, rows, depth=4):
    df = spark.createDataFrame([(*r, "x", 7, None) for r in rows], SCHEMA).repartition(3)
    return merkle.manifest(df, toxicity.remainder(F.col("doc_id"), 3) == 0, depth)


def same(got, rows):
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def many(n, langs):
    texts = ["The Quick fox", "quiet words", "ÀÉ Über", None, "", "A"]
    return [(i * 3 - 50, f"s{i % 4}", langs[i * i % len(langs)], i, texts[i % len(texts)]) for i in range(n)]


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_against_brute_force(spark, monkeypatch, depth):
    monkeypatch.setattr(ranges, "RANGE_ROWS", 64)
    rows = many(700, ["en", None, "", "de", "zz", "en", "en"])
    same(run(spark, rows, depth).collect(), rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_sizes_of_one_tree(spark, n):
    rows = many(n, ["en"])
    same(run(spark, rows, 1).collect(), rows)


def test_many_groups_reach_a_higher_upper_tree(spark):
    rows = many(150, [f"l{k}" for k in range(73)])
    same(run(spark, rows, 1).collect(), rows)


def test_odd_rows(spark):
    rows = [(i, "s", "en" if i % 2 else None, None, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, None, None, None, None)] * 3 + [(4, "s", "en", 2, "Twice"), (4, "s", "en", 2, "Twice"), (4, "s", "en", 2, "Other")]
    rows += [(2**60 + 1, "s", None, 1, "Large id"), (-7, "é", "é", -3, "X" * 50_000)]
    same(run(spark, rows).collect(), rows)


def test_a_change_of_any_field_is_found(spark):
    rows = many(40, ["en", "de"])
    root = run(spark, rows).first().root
    for k, other in enumerate([(999, *rows[0][1:]), (*rows[0][:1], "new", *rows[0][2:]), (*rows[0][:4], "new")]):
        assert run(spark, [other, *rows[1:]]).first().root != root, k


def test_no_rows(spark):
    assert run(spark, []).collect() == []


def test_without_tampering_all_verify(spark):
    df = spark.createDataFrame([(*r, "x", 7, None) for r in many(90, ["en", "de"])], SCHEMA)
    assert merkle.manifest(df).filter("NOT verified").isEmpty()
