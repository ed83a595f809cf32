"""Near duplicates against brute force."""

from __future__ import annotations

import random

from conftest import SF_DIR

from recordloom.llm import linking, near_dedup, queries

from .conftest import ODD_TEXTS


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    low = list(range(len(sets)))

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y in range(x):
            b = sets[y][1]
            both = len(a & b)
            if a and b and 100 * both >= 85 * (len(a) + len(b) - both):
                p, q = sorted((root(x), root(y)))
                low[q] = p
    best = {}
    for x, (i, _) in enumerate(sets):
        r = root(x)
        best[r] = min(best.get(r, i), i)
    return sorted(
        (i, len(s), best[root(x)], best[root(x)] == i) for x, (i, s) in enumerate(sets)
    )


def edited_copies(n, seed):
    rng = random.Random(seed)
    base = [rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(150)]
    rows = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        rows.append(" ".join(words))
    return rows


def test_against_brute_force(frame):
    texts = ODD_TEXTS + edited_copies(120, 1) + edited_copies(40, 2) + [ODD_TEXTS[5]] * 30
    rows = list(enumerate(texts))
    got = near_dedup.near_duplicates(frame(rows)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_remaining_pairs_in_parts(frame):
    """The copies are one group far above the limit: thinned, then the rest against all, in parts."""
    rows = list(enumerate(edited_copies(90, 3)))
    got = near_dedup.near_duplicates(frame(rows), limit=1500).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_chain_of_copies_is_one_component(frame):
    words = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(30):
        words = [*words[5:], *[f"n{k}_{j}" for j in range(5)]]
        rows.append((100 - k, " ".join(words)))
    got = near_dedup.near_duplicates(frame(rows)).collect()
    assert sorted(map(tuple, got)) == brute(rows)
    assert {r.component_id for r in got} == {71}


def test_rows_without_key_and_repeated_rows(frame):
    text = "one two three four five six"
    got = near_dedup.near_duplicates(frame([(None, text), (4, text), (4, text), (None, "z")])).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_shingles)
    assert [tuple(r) for r in sorted(got, key=key)] == [
        (4, 2, 4, True), (4, 2, 4, True), (None, 1, None, True), (None, 2, 4, False)
    ]


def test_empty_table(frame):
    assert near_dedup.near_duplicates(frame([])).collect() == []


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op8_near_dedup"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == brute([tuple(r) for r in rows])


def test_texts_move_once_whatever_the_groups(frame, monkeypatch):
    """A small limit makes large groups, whose sets are kept on the way."""
    calls = []
    sets_of = linking.sets_of
    monkeypatch.setattr(linking, "sets_of", lambda *args: calls.append(1) or sets_of(*args))
    rows = list(enumerate(edited_copies(120, 8)))
    want = None
    for limit in (None, 2000):
        calls.clear()
        got = sorted(map(tuple, near_dedup.near_duplicates(frame(rows), limit=limit).collect()))
        want = want or got
        assert got == want and len(calls) == 1, limit
