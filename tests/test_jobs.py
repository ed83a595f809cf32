"""The jobs from folders of files to CSV files."""

from __future__ import annotations

import csv
import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recordloom.plans import jobs


def rows_of(folder: Path) -> list[dict[str, str]]:
    rows: list[dict[str, str]] = []
    for part in sorted(folder.glob("*.csv")):
        with part.open(newline="") as f:
            rows += csv.DictReader(f)
    return rows


def place(label):
    return {"location": [{"address": [{"countryCode": {"prefLabel": label}}]}]}


QUAL = {
    "title": "Welder, basic",
    "publisher": place("Austria"),
    "EQFLevel": {"prefLabel": "EQF Level 4"},
    "learningOutcomeSummary": {"noteLiteral": "<p>Join &amp; cut</p>\nmetal"},
    "learningOutcome": [
        {"title": "1.", "additionalNote": []},
        {"title": "Title: Weld", "additionalNote": [{"noteLiteral": "safely"}, {"noteLiteral": "well"}]},
    ],
}
LO = {
    "title": "Course",
    "providedBy": [{"location": [{"address": [{"countryCode": {"prefLabel": "Malta"}}]}]}],
    "learningAchievementSpecification": {
        "EQFLevel": {"prefLabel": "Level 6"},
        "learningOutcomeSummary": {"noteLiteral": " Summary "},
        "learningOutcome": [{"title": "x", "additionalNote": [{"noteLiteral": "1) one"}, {"noteLiteral": "2) two"}]}],
    },
}


def put(path: Path, value) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value))


def test_qualifications_and_merge(spark, tmp_path):
    put(tmp_path / "q" / "AUT" / "a.json", QUAL)
    put(tmp_path / "q" / "AUT" / "b" / "c.JSON", {**QUAL, "title": "Other"})
    put(tmp_path / "q" / "bad.json", "{")
    put(tmp_path / "q" / "empty.json", {**QUAL, "learningOutcome": []})
    counts = jobs.qual_files_to_csv(
        spark, str(tmp_path / "q"), str(tmp_path / "out"), rows_per_file=1, dead=str(tmp_path / "dead"))
    assert counts == {"read": 4, "kept": 2, "dropped": 1, "dead": 1}
    (lost,) = spark.read.json(str(tmp_path / "dead")).collect()
    assert (lost.file.rpartition("/")[2], lost.reason, lost.body) == ("bad.json", "bad json", "{")
    rows = {r["qualificationName"]: r for r in rows_of(tmp_path / "out")}
    assert set(rows) == {"Welder, basic", "Other"}
    assert list(rows["Other"]) == [
        "qualificationName", "country", "qualificationLevel", "qualificationLevelNum", "description", "learningOutcomes"]
    assert rows["Welder, basic"] == {
        "qualificationName": "Welder, basic", "country": "Austria", "qualificationLevel": "EQF Level 4",
        "qualificationLevelNum": "4", "description": "Join & cut metal", "learningOutcomes": "Weld \u2014 safely well"}

    put(tmp_path / "l" / "one.json", LO)
    put(tmp_path / "l" / "two.json", {**LO, "title": " "})
    counts = jobs.lo_files_to_csv(spark, str(tmp_path / "l"), str(tmp_path / "lo"))
    assert counts == {"read": 2, "kept": 1, "dropped": 1, "dead": 0}
    assert not (tmp_path / "lo_dead").exists()
    (lo,) = rows_of(tmp_path / "lo")
    assert lo == {
        "title": "Course", "countryCode.prefLabel": "Malta", "EQFLevel_prefLabel": "Level 6", "EQFLevel_numeric": "6",
        "learningOutcomeSummary.noteLiteral": "Summary", "learningOutcome_additionalNote": "one ; 2) two"}

    jobs.merge_csv(spark, str(tmp_path / "lo"), str(tmp_path / "out"), str(tmp_path / "all"))
    merged = rows_of(tmp_path / "all")
    assert sorted(r["title"] for r in merged) == ["Course", "Other", "Welder, basic"]

    (tmp_path / "wide.csv").write_text("a,b,c,d,e,f,g\n1,2,3,4,5,6,7\n")
    with pytest.raises(ValueError, match="6 columns against 7"):
        jobs.merge_csv(spark, str(tmp_path / "lo"), str(tmp_path / "wide.csv"), str(tmp_path / "none"))

    counts = jobs.clean_csv(spark, str(tmp_path / "out"), list(rows["Other"]), "qualificationName",
                            str(tmp_path / "clean"), str(tmp_path / "audit"))
    assert counts == {"read": 2, "kept": 2, "dropped": 0, "dead": 0}
    assert len(rows_of(tmp_path / "clean")) == 2
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 2


def test_multilingual(spark, tmp_path):
    record = {
        "@id": "http://x.org/q/1", "title": "T", "description": "D", "EQFLevel": {"prefLabel": {"de": "Niveau 5.5", "fr": "n"}},
        "learningOutcome": [{"additionalNote": [{"noteLiteral": {"de": "a", "en": "b"}}, {"noteLiteral": ["c", ""]}]}],
    }
    put(tmp_path / "in" / "FRA" / "a.json", record)
    put(tmp_path / "in" / "FRA" / "b.json", {**record, "parts": [{"countryCode": {"prefLabel": {"en": "France"}}}]})
    put(tmp_path / "in" / "FRA" / "c.json", {**record, "learningOutcome": None})
    jobs.multilingual_files_to_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    rows = rows_of(tmp_path / "out")
    assert sorted(r["country"] for r in rows) == ["FRA", "France"]
    assert {k: v for k, v in rows[0].items() if k != "country"} == {
        "title": "T", "qualificationLevel": "Niveau 5.5", "qualificationLevelNum": "5.5", "description": "D",
        "learningOutcome": "b | c", "uri": "http://x.org/q/1"}
    put(tmp_path / "in" / "FRA" / "d.json", "null")
    jobs.multilingual_files_to_csv(
        spark, str(tmp_path / "in"), str(tmp_path / "all"), require_outcome=False)
    assert [r.body for r in spark.read.json(str(tmp_path / "all_dead")).collect()] == ["null"]
    assert len(rows_of(tmp_path / "all")) == 3


def test_ledger_of_item_pages(spark):
    rows = [("x", 0, '{"items":[{"id":"1"},{"id":"1"},{"n":2}]}'), ("x", 10, '{"items":[]}'), ("y", 0, "no json")]
    pages = spark.createDataFrame(rows, "cell string, `from` bigint, payload string")
    got = {r.cell: r for r in jobs.crawl_ledger(pages, ["cell"], courses_only=False).collect()}
    assert (got["x"].items, got["x"].new_items, got["x"].completed) == (3, 2, True)
    assert (got["y"].items, got["y"].new_items, got["y"].completed) == (0, 0, False)


def test_cells_with_many_lines_stay_open(spark):
    stored = spark.range(100_003).selectExpr("'A' AS cell")
    cells = spark.createDataFrame([("A",)], "cell string")
    none = spark.createDataFrame([], "cell string")
    assert jobs.open_requests(cells, none, stored, ["cell"]).first()["from"] == 100_000


def test_listed_items_keep_what_has_no_id(spark):
    items = [{"id": 0}, {"id": 0}, {"id": ""}, {"id": None, "uri": "u"}, {"uri": "u"}, {"id": "", "uri": "u"}, {"n": 1}, {"id": "0"}, {"id": "0"}]
    pages = spark.createDataFrame([("A", 0, json.dumps({"items": items}))], "cell string, `from` int, payload string")
    got = sorted((r.pos, r.id) for r in jobs.listed_items(pages, ["cell"]).collect())
    assert got == [(0, None), (1, None), (2, None), (3, "u"), (5, None), (6, None), (7, "0")]


def test_no_documents(spark, tmp_path):
    (tmp_path / "none").mkdir()
    counts = jobs.qual_files_to_csv(spark, str(tmp_path / "none"), str(tmp_path / "out"))
    assert counts == {"read": 0, "kept": 0, "dropped": 0, "dead": 0}


def test_a_record_beyond_one_variant_is_too_large(spark, tmp_path):
    put(tmp_path / "q" / "large.json", {**QUAL, "pad": "x" * (40 << 20)})
    put(tmp_path / "q" / "cut.json", json.dumps({**QUAL, "pad": "x" * (40 << 20)})[:-1])
    put(tmp_path / "q" / "good.json", QUAL)
    counts = jobs.qual_files_to_csv(spark, str(tmp_path / "q"), str(tmp_path / "out"))
    assert counts == {"read": 3, "kept": 1, "dropped": 0, "dead": 2}
    lost = spark.read.json(str(tmp_path / "out_dead")).select("file", "reason").collect()
    assert {(r.file.rpartition("/")[2], r.reason) for r in lost} == {("large.json", "too large"), ("cut.json", "bad json")}


def cleaning_hook(folder: str, bad: str):
    """Upper-cases texts; writes a line for every row; raises on one row and forgets the texts of another."""

    def hook(batch):
        (Path(folder) / uuid.uuid4().hex).write_text("".join(f"{t}\n" for t in batch["description"]))
        if (batch["description"] == bad).any():
            raise ValueError("no")
        out = batch.apply(lambda c: c.str.upper())
        out.loc[batch["description"] == "text 5", "description"] = None
        return out

    return hook


def test_a_killed_cleaning_run_goes_on(spark, tmp_path, monkeypatch):
    calls, out = tmp_path / "calls", str(tmp_path / "batches")
    calls.mkdir()
    data = [(i, f"text {i}", f"lo {i}") for i in range(60)]
    rows = spark.createDataFrame(data, "id long, description string, learningOutcomes string").repartition(3)
    hook = cleaning_hook(str(calls), "text 7")

    class Killed(Exception):
        pass

    checked, batches = jobs.cleaner.checked, []

    def cut_off(results, columns):
        batches.append(1)
        if len(batches) == 4:
            raise Killed
        return checked(results, columns)

    with monkeypatch.context() as m:
        m.setattr(jobs.cleaner, "checked", cut_off)
        with pytest.raises(Killed):
            jobs.clean_in_batches(rows, "id", out, hook, batches=6)
    first = jobs.cleaned_batches(spark, out).count()
    assert 0 < first < 60
    # A batch cut off while it was written: files, but no mark of success.
    half = tmp_path / "batches" / "batch=half-0"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"PAR1")
    jobs.clean_in_batches(rows, "id", out, hook, batches=6)
    jobs.clean_in_batches(rows, "id", out, hook, batches=2)
    results = jobs.cleaned_batches(spark, out)
    assert sorted(r.id for r in results.collect()) == list(range(60))
    cleaned = {r.id: r for r in jobs.cleaner.hook_rows(results, "id").collect()}
    assert all(cleaned[i].description == f"TEXT {i}" for i in range(60) if i not in (5, 7))
    dead = {r.id: (r.error, r.description) for r in jobs.cleaner.dead_rows(results, "id").collect()}
    assert set(dead) == {5, 7} and dead[7] == ("no", "text 7") and dead[5][1] == "text 5"
    assert jobs.cleaner.hook_audit(results, "id").count() == 58
    lines = [x for f in calls.iterdir() for x in f.read_text().splitlines()]
    # Rows that share a batch with the raising one are tried again in halves; no other row is.
    many = {x for x in lines if lines.count(x) > 1}
    failed = jobs.cleaned_batches(spark, out).filter("error = 'no'").select(F.input_file_name().alias("f"))
    alone = failed.first().f.rpartition("/")[0]
    together = {f"text {r.id}" for r in spark.read.parquet(alone).collect()}
    assert set(lines) == {f"text {i}" for i in range(60)} and many <= together


def test_clean_csv_with_a_hook(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    (tmp_path / "in.csv").write_text("n,description,learningOutcomes,x\n" + "".join(f"{i},text {i},lo,{i}\n" for i in range(9)))
    args = (spark, str(tmp_path / "in.csv"), ["x", "n", "description", "learningOutcomes"], "n", str(tmp_path / "out"), str(tmp_path / "audit"))
    for _ in range(2):
        counts = jobs.clean_csv(*args, hook=cleaning_hook(str(calls), "text 7"), batches=2)
        assert counts == {"read": 9, "kept": 9, "dropped": 0, "dead": 2}
    rows = {r["n"]: r for r in rows_of(tmp_path / "out")}
    assert list(rows["1"]) == ["x", "n", "description", "learningOutcomes"]
    assert rows["1"]["description"] == "TEXT 1" and rows["7"]["description"] == "text 7" and len(rows) == 9
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 7
    assert {r.error for r in spark.read.json(str(tmp_path / "out_dead")).collect()} == {"no", jobs.cleaner.MISSING}
