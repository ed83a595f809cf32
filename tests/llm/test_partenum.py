"""The Jaccard join by PartEnum signatures, and the comparison of groups, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR

from recordloom.llm import arrays, linking, partenum, queries

from .conftest import ODD_TEXTS
from .test_near_dedup import edited_copies


def shingles(text, width=4):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, percent=85, width=4):
    sets = [shingles(t, width) for _, t in rows]
    low = list(range(len(sets)))

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for x, a in enumerate(sets):
        for y in range(x):
            b = sets[y]
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                p, q = sorted((root(x), root(y)))
                low[q] = p
    best = {}
    for x, (i, _) in enumerate(rows):
        best[root(x)] = min(best.get(root(x), i), i)
    return sorted((i, len(sets[x]), best[root(x)]) for x, (i, _) in enumerate(rows))


@pytest.mark.parametrize("percent", [50, 80, 85, 95, 100])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    near = 0
    for _ in range(600):
        n = int(rng.integers(1, 120)) if rng.random() < 0.9 else int(rng.integers(120, 2000))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        drop, add = (int(rng.integers(0, int(n * (1 - percent / 100)) + 2)) for _ in range(2))
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**64, add, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= percent * (len(a) + len(b) - both):
            near += 1
            assert len(np.intersect1d(partenum.signatures(a, percent), partenum.signatures(b, percent)))
    assert near > 40


def test_crowded_sets_meet_too():
    """Sets whose elements lie in few cells leave more parts empty than any scheme expects."""
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**54, 90, dtype=np.uint64))
        b = np.unique(np.concatenate([a[4:], rng.integers(0, 2**54, 4, dtype=np.uint64)]))
        assert len(np.intersect1d(partenum.signatures(a), partenum.signatures(b)))


def test_few_signatures_and_few_chance_meetings():
    rng = np.random.default_rng(3)
    for n in (9, 14, 30, 47, 110, 400, 5000):
        keys = [partenum.signatures(np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))) for _ in range(60)]
        assert max(map(len, keys)) <= max(60, 5 * n)
        _, count = np.unique(np.concatenate([np.unique(k) for k in keys]), return_counts=True)
        assert (count > 1).sum() <= 2, n


def family(n, seed):
    """Near copies around the threshold, in chains and stars, with some of them far from all others."""
    rng = random.Random(seed)
    rows = edited_copies(n, seed)
    for k in range(n // 4):
        words = rows[rng.randrange(len(rows))].split()
        for at in rng.sample(range(len(words)), 7):
            words[at] = f"far{seed}x{k}x{at}"
        rows.append(" ".join(words))
    return rows


@pytest.mark.parametrize("limit", [None, 3000])
def test_against_brute_force(frame, limit):
    """With a small limit the families are large groups: thinned, then the rest against all."""
    texts = ODD_TEXTS + family(60, 1) + family(30, 2) + [ODD_TEXTS[5]] * 30 + [f"only {k} here" for k in range(9)]
    random.Random(4).shuffle(texts)
    rows = list(enumerate(texts))
    got = partenum.jaccard_join(frame(rows), limit=limit).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_texts_move_once_whatever_the_groups(frame, monkeypatch):
    """The sets of large groups are kept on the way, not read from all texts again."""
    calls = []
    sets_of = linking.sets_of
    monkeypatch.setattr(linking, "sets_of", lambda *args: calls.append(1) or sets_of(*args))
    rows = list(enumerate(family(60, 1) + family(30, 2) + [f"only {k} here" for k in range(9)]))
    for limit in (None, 3000):
        calls.clear()
        assert sorted(map(tuple, partenum.jaccard_join(frame(rows), limit=limit).collect())) == brute(rows)
        assert len(calls) == 1, limit


def test_other_threshold_and_width(frame):
    rows = list(enumerate(family(40, 3) + ODD_TEXTS))
    got = partenum.jaccard_join(frame(rows), percent=80, width=3).collect()
    assert sorted(map(tuple, got)) == brute(rows, 80, 3)


def test_rows_without_id_and_repeated_rows(frame):
    text = "one two three four five six"
    got = partenum.jaccard_join(frame([(None, text), (4, text.upper()), (4, text), (None, "z"), (None, None), (7, "")])).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == [
        (4, 3, 4), (4, 3, 4), (7, 0, 7), (None, 0, None), (None, 1, None), (None, 3, 4)
    ]


def test_empty_table(frame):
    assert partenum.jaccard_join(frame([])).collect() == []


def test_comparisons_stay_few_in_a_group_of_near_copies(monkeypatch):
    """Copies linked with the first one are not compared with each other."""
    made = []
    linked = linking.Sets.linked

    def counted(self, x, others):
        made.append(len(others))
        return linked(self, x, others)

    monkeypatch.setattr(linking.Sets, "linked", counted)
    for n in (100, 200):
        made.clear()
        rng = np.random.default_rng(n)
        base = rng.integers(0, 2**64, 300, dtype=np.uint64)
        sets = [np.unique(np.concatenate([base[:298], rng.integers(0, 2**64, 2, dtype=np.uint64)])) for _ in range(n)]
        one = np.zeros(n, np.int64)
        links = linking.joining_links(sets, one, np.arange(n), np.ones(n, bool), partenum.signatures, 85)
        assert len(links) == n - 1 and sum(made) < 3 * n


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op12_partenum"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == brute([tuple(r) for r in rows])
    assert arrays.SHINGLE == 5 and partenum.WIDTH == 4


@pytest.mark.parametrize("percent", [50, 80, 85, 95, 100])
def test_parity_bits_rule_no_link_out(percent):
    """Linked sets are in one tree whatever their sizes, far ones are not."""
    rng = np.random.default_rng(percent)
    linked = 0
    for _ in range(300):
        n = int(rng.integers(1, 140)) if rng.random() < 0.9 else int(rng.integers(140, 9000))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        drop, add = (int(rng.integers(0, int(n * (1 - percent / 100)) + 2)) for _ in range(2))
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**64, add, dtype=np.uint64)]))
        far = np.unique(rng.integers(0, 2**64, len(a) + 40, dtype=np.uint64))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= percent * (len(a) + len(b) - both):
            linked += 1
            sets = [far, a, b]
            sizes = np.array([len(s) for s in sets])
            edges = {tuple(sorted(e)) for e in linking.forest(sizes, [linking.parity(s) for s in sets], percent)}
            assert (1, 2) in edges or {(0, 1), (0, 2)} <= edges
            assert edges == {(1, 2)} or percent < 80 or n < 60
    assert linked > 40


@pytest.mark.parametrize("members", [3, 70])
def test_trees_connect_all_that_may_be_linked(members):
    """Chains of sets, each one near the next: one tree for each chain, however they are mixed."""
    rng = np.random.default_rng(members)
    sets, chain = [], []
    for k in range(3):
        base = rng.integers(0, 2**64, 400 + 6 * members, dtype=np.uint64)
        sets += [np.unique(base[i : i + 400]) for i in range(0, members * 6, 6)]
        chain += [k] * members
    order = rng.permutation(len(sets))
    sets, chain = [sets[i] for i in order], np.array(chain)[order]
    edges = linking.forest(np.array([len(s) for s in sets]), [linking.parity(s) for s in sets], 85)
    assert len(edges) <= len(sets) - 3 and all(chain[x] == chain[y] for x, y in edges)
    low = np.arange(len(sets))
    for x, y in edges:
        low[low == low[x]] = low[y]
    assert len(np.unique(low)) == 3


def test_runs_stay_whole_over_batches():
    keys = np.repeat(np.arange(8), [1, 5, 2, 9, 1, 1, 7, 3])
    batches = [pa.record_batch({"key": pa.array(keys[lo : lo + 3])}) for lo in range(0, len(keys), 3)]
    found = [t["key"].to_numpy() for t in linking._runs(iter(batches), "key")]
    assert np.concatenate(found).tolist() == keys.tolist()
    assert all(a[-1] != b[0] for a, b in zip(found, found[1:], strict=False))


def test_chance_meetings_make_no_groups(frame, monkeypatch):
    """Texts with a long passage in common share signatures; without a link they are in no group."""
    moved = []
    linked_components = linking.linked_components

    def asked(docs, pairs, *args):
        moved.extend(tuple(p) for p in pairs.collect())
        return linked_components(docs, pairs, *args)

    monkeypatch.setattr(linking, "linked_components", asked)
    passage = " ".join(f"c{i}" for i in range(40))
    texts = [passage + "".join(f" w{k}x{i}" for i in range(30 + k % 9)) for k in range(60)]
    sets = list(arrays.shingle_sets(*arrays.text_buffer(pa.array(texts)), partenum.WIDTH))
    keys = [set(partenum.signatures(s).tolist()) for s in sets]
    assert sum(bool(a & b) for i, a in enumerate(keys) for b in keys[:i]) > 100
    rows = list(enumerate([*texts, texts[7].replace("w7x29", "other"), *family(20, 5)]))
    assert sorted(map(tuple, partenum.jaccard_join(frame(rows)).collect())) == brute(rows)
    far = {linking.class_id(s) for s in sets}
    assert sum(a in far or b in far for a, b in moved) <= 1


def test_shuffled_signatures_do_not_stay(frame, spark, monkeypatch):
    """Signatures are far more than the texts; they are gone when the links are known."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(name), []
    linked_components = linking.linked_components

    def asked(*args):
        seen.append(spark.conf.get(name))
        return linked_components(*args)

    monkeypatch.setattr(linking, "linked_components", asked)
    partenum.jaccard_join(frame([(1, "a b c d e f"), (2, "a b c d e f g")]))
    assert seen == ["true"] and spark.conf.get(name) == before
