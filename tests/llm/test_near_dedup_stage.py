"""The pipeline's near_dedup stage against brute force at its own threshold."""

from __future__ import annotations

import random

import corpus_pipeline

from recordloom.llm import near_dedup

from .conftest import ODD_TEXTS
from .test_near_dedup import edited_copies, shingles


def similarity(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def brute_kept(rows, percent):
    """The row of smallest id in each component over links of `percent` or more."""
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
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                p, q = sorted((root(x), root(y)))
                low[q] = p
    best = {}
    for x, (i, _) in enumerate(sets):
        best[root(x)] = min(best.get(root(x), i), i)
    return sorted(best.values())


def pairs_between(n, seed):
    """Pairs of texts with a similarity from 0.80 to just below 0.85."""
    rng = random.Random(seed)
    texts = []
    for k in range(n):
        words = [f"p{k}w{i}" for i in range(204)]
        other = list(words)
        # Each word replaced far from the others changes 5 of 200 shingles: 180 or 182 of 200 stay.
        for at in rng.sample(range(10, 190, 10), 4):
            other[at] = f"n{k}at{at}"
        if k % 2:
            other = other[: -rng.randrange(0, 3)] or other
        texts += [" ".join(words), " ".join(other)]
    return texts


def test_pairs_lie_between_the_thresholds():
    texts = pairs_between(40, 5)
    found = [similarity(shingles(a), shingles(b)) for a, b in zip(texts[::2], texts[1::2], strict=True)]
    assert all(0.80 <= s < 0.85 for s in found)


def test_stage_against_brute_force(spark, frame):
    texts = ODD_TEXTS + pairs_between(40, 5) + edited_copies(60, 1) + edited_copies(60, 7)
    rows = list(enumerate(texts))
    got = corpus_pipeline.drop_near_duplicates(spark, frame(rows), "")
    expected = brute_kept(rows, 80)
    assert expected != brute_kept(rows, 85)
    assert sorted(r.doc_id for r in got.collect()) == expected


def test_tables_follow_the_threshold():
    assert near_dedup.Banding.of(85) == near_dedup.Banding(85, 12)
    for percent in (70, 80, 85, 95):
        band, alike = near_dedup.Banding.of(percent), percent / 100
        assert 1 - (1 - (1 - alike**near_dedup.ROWS) ** band.halves) ** 2 <= near_dedup.MISSED


def test_rows_without_id_and_shared_ids(frame):
    text, other, third = "one two three four five six", "seven eight nine ten", "alpha beta gamma delta"
    rows = [
        (None, ""), (None, None), (None, None), (3, " \n"),  # empty sets: all stay
        (None, text), (4, text), (4, text), (9, text.upper()),  # one component with ids
        (None, third), (None, third),  # one component without ids
        (9, other), (5, other + " "), (5, other),  # two rows of the smallest id, the smaller text stays
        (9, "quite another text of its own"),  # shares its id with rows that go
    ]
    got = near_dedup.without_duplicates(frame(rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got), key=key) == [
        (3, " \n"), (4, text), (5, other), (9, "quite another text of its own"),
        (None, ""), (None, third), (None, None), (None, None),
    ]
