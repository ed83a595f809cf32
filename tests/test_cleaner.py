"""The user's cleaner: failures are isolated, the contract is checked."""

from __future__ import annotations

from recordloom.operators import cleaner
from recordloom.plans import jobs


def rows(spark, n=20):
    data = [(i, "boom" if i % 7 == 3 else f"text {i}", f"lo {i}") for i in range(n)]
    return spark.createDataFrame(data, "k int, description string, learningOutcomes string")


def test_failing_rows_keep_their_text(spark):
    def hook(batch):
        out = batch.copy()
        if (out["description"] == "boom").any():
            raise ValueError("no")
        out["description"] = out["description"].str.upper()
        out["description_removed"] = [["x"]] * len(out)
        return out

    results = cleaner.apply_hook(rows(spark), "k", hook)
    cleaned = {r.k: r for r in cleaner.hook_rows(results, "k").collect()}
    assert len(cleaned) == 20
    for k, r in cleaned.items():
        if k % 7 == 3:
            assert (r.description, r.error) == ("boom", "no")
        else:
            assert (r.description, r.learningOutcomes, r.error) == (f"TEXT {k}", f"lo {k}", None)
    audit = cleaner.hook_audit(results, "k").collect()
    assert len(audit) == 17
    assert all(a.removed.description == ["x"] and a.removed.learningOutcomes == [] for a in audit)


def test_a_missing_column_breaks_the_contract(spark):
    results = cleaner.apply_hook(rows(spark, 3), "k", lambda batch: batch[["description"]])
    got = cleaner.hook_rows(results, "k").collect()
    assert {r.error for r in got} == {cleaner.MISSING}
    assert {r.learningOutcomes for r in got} == {"lo 0", "lo 1", "lo 2"}


def test_a_changed_row_count_is_an_error(spark):
    results = cleaner.apply_hook(rows(spark, 3), "k", lambda batch: batch.iloc[:0])
    assert {r.error for r in cleaner.hook_rows(results, "k").collect()} == {"row count changed"}


def test_done_rows_are_skipped(spark):
    done = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    cleaned, audit = jobs.cleaned_with_audit(rows(spark, 5), "k", done)
    assert {r.k for r in cleaned.collect()} == {r.k for r in audit.collect()} == {0, 3, 4}


def test_one_bad_row_costs_few_calls(spark):
    calls = []

    def hook(batch):
        calls.append(len(batch))
        if (batch["description"] == "boom").any():
            raise ValueError("no")
        return batch.assign(description_removed=[[str(len(calls))]] * len(batch))

    data = [(i, "boom" if i == 63 else "fine", "lo") for i in range(64)]
    one_task = spark.createDataFrame(data, "k int, description string, learningOutcomes string").coalesce(1)
    got = cleaner.apply_hook(one_task, "k", hook).collect()
    assert [r.error for r in got] == [None] * 63 + ["no"]
    # The last good row comes one call before the bad one, at most 2 * log2(64) + 1 in all.
    assert max(int(r.description_removed[0]) for r in got if not r.error) <= 12


def test_a_hook_may_name_its_bad_rows(spark):
    def hook(batch):
        return batch.assign(error=["no" if d == "boom" else None for d in batch["description"]])

    got = {r.k: r.error for r in cleaner.hook_rows(cleaner.apply_hook(rows(spark), "k", hook), "k").collect()}
    assert got == {k: "no" if k % 7 == 3 else None for k in range(20)}


def test_a_hook_gets_few_rows_and_bytes_at_once(spark, monkeypatch):
    """However many rows an Arrow batch has, only a part of them are Python objects at a time."""
    monkeypatch.setattr(cleaner, "HOOK_ROWS", 8)
    monkeypatch.setattr(cleaner, "HOOK_BYTES", 100)

    def hook(batch):
        size = int(sum(batch[c].str.len().sum() for c in cleaner.TEXT_COLUMNS))
        note = f"{len(batch)} {size}"
        return batch.assign(description_removed=[[note, None]] * len(batch), error=["no" if d == "bad" else None for d in batch["description"]])

    data = [(None if i == 3 else i, "x" * 300 if i % 10 == 4 else None if i % 10 == 5 else "bad" if i == 9 else "ab", "cd") for i in range(50)]
    df = spark.createDataFrame(data, "k long, description string, learningOutcomes string").coalesce(1)
    got = cleaner.apply_hook(df, "k", hook).collect()
    assert [(r.k, r.description, r.description_cleaned) for r in got] == [(k, d or "", d or "") for k, d, _ in data]
    assert [r.error for r in got] == ["no" if i == 9 else None for i in range(50)]
    parts = [tuple(map(int, r.description_removed[0].split())) for r in got]
    assert all(n <= 8 and (size <= 100 or n == 1) for n, size in parts) and max(n for n, _ in parts) > 2
    assert {r.description_removed[1] for r in got} == {"None"} and {tuple(r.learningOutcomes_removed) for r in got} == {()}
