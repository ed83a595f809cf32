"""Extraction against small brute-force readers, and null safety."""

from __future__ import annotations

import json
import random
import time

from pyspark.sql import functions as F

from recordloom.functions import outcomes as ox
from recordloom.functions import variants as vx
from recordloom.operators import extract
from recordloom.plans import jobs


def docs(spark, bodies):
    rows = [(f"d{i}.json", "FOLDER", b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "file string, country string, body string")


def random_tree(rng: random.Random, depth: int):
    kind = rng.random()
    if depth == 0 or kind < 0.3:
        return rng.choice(["t", 1, None, True, '{"countryCode":{"prefLabel":"TEXT"}}'])
    if kind < 0.5:
        return [random_tree(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    node = {rng.choice("zyxwv") + str(i): random_tree(rng, depth - 1) for i in range(rng.randint(0, 3))}
    if rng.random() < 0.3:
        label = rng.choice(["", "Land", {"de": "", "fr": "Pays"}, {"de": "Land", "en": "Country"}, None, 5])
        items = list(node.items())
        items.insert(rng.randint(0, len(items)), ("countryCode", {"prefLabel": label}))
        node = dict(items)
    return node


def label_of(v):
    if isinstance(v, str):
        return v
    if isinstance(v, dict):
        return v.get("en") or next((x for x in v.values() if isinstance(x, str)), None)
    return None if v is None else str(v)


def first_country(node):
    """Depth first, in document order."""
    if isinstance(node, dict):
        code = node.get("countryCode")
        if isinstance(code, dict) and label_of(code.get("prefLabel")):
            return label_of(code["prefLabel"])
    elif not isinstance(node, list):
        return None
    for child in node if isinstance(node, list) else node.values():
        found = first_country(child)
        if found:
            return found
    return None


def test_deep_country_equals_depth_first_search(spark):
    rng = random.Random(7)
    trees = [{"r": random_tree(rng, 6), "s": random_tree(rng, 5)} for _ in range(300)]
    parsed = vx.with_json(docs(spark, trees), "body", "doc")
    found = parsed.select("file", extract.deep_country(F.col("body")).alias("c")).collect()
    got = {r.file: r.c for r in found}
    expected = {f"d{i}.json": first_country(t) for i, t in enumerate(trees)}
    assert got == expected
    assert sum(v is not None for v in expected.values()) > 50


def test_deep_country_in_a_deep_record(spark):
    node = {"countryCode": {"prefLabel": "Deep"}}
    for _ in range(200):
        node = {"a": [node]}
    parsed = vx.with_json(docs(spark, [node]), "body", "doc")
    assert parsed.select(extract.deep_country(F.col("body")).alias("c")).first().c == "Deep"


def seconds(df):
    df.write.format("noop").mode("overwrite").save()
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def test_country_and_notes_take_linear_time(spark):
    """Twice the record, about twice the time: no level and no note is read again for another one."""

    def record(n):
        node = {"countryCode": {"prefLabel": "End"}}
        for k in range(n // 100):
            node = {"side": [{"countryCode": {"prefLabel": ""}, "k": k}] * 100, "z": node}
            if k % 40 == 39:
                node = {"flat": "x", "y": [node]}
        notes = [{"noteLiteral": {"fr": f"note {i}", "de": "zwei"}} for i in range(n)]
        return {"learningOutcome": [{"additionalNote": notes}], "tree": node}

    taken = {}
    for n in (4000, 8000):
        parsed = vx.with_json(docs(spark, [record(n)]).coalesce(1), "body", "doc")
        country = parsed.select(extract.deep_country(F.col("body")).alias("v"))
        notes = parsed.select(ox.note_texts(F.col("doc"), F.col("body")).alias("v"))
        assert country.first().v == "End"
        got = notes.first().v
        assert len(got) == n and got[0] == "note 0" and got[-1] == f"note {n - 1}"
        taken[n] = [min(seconds(df) for _ in range(2)) for df in (country, notes)]
    for before, after in zip(taken[4000], taken[8000], strict=True):
        assert after < 3.2 * before + 0.3, taken


def test_notes_of_mixed_literals_meet_their_own_text(spark):
    forms = [{"zz": "first", "aa": "no"}, ["a", {"zz": "b", "aa": "no"}], "plain", None, {"zz": 1, "yy": "c"}, 5, [{"en": "d"}]]
    los = [{"additionalNote": [{"noteLiteral": f} for f in forms[i:]]} for i in range(len(forms))]
    parsed = vx.with_json(docs(spark, [{"learningOutcome": [los[0], None, "x", *los[1:]]}]), "body", "doc")
    got = parsed.select(ox.note_texts(F.col("doc"), F.col("body")).alias("n")).first().n
    flat = [["first"], ["a", "b"], ["plain"], [], ["c"], ["5"], ["d"]]
    assert got == [t for i in range(len(forms)) for part in flat[i:] for t in part]


def test_records_survive_nulls_and_odd_types(spark):
    odd = [
        {"title": None, "providedBy": [None, {"location": [None, {"address": [None]}]}], "publisher": {"location": [None]}},
        {"title": "t", "providedBy": "x", "publisher": [], "learningAchievementSpecification": {"learningOutcome": [None, "s", {"additionalNote": "n"}]}},
        {"title": 5, "EQFLevel": "Level 3", "learningOutcome": [None, {"title": None, "additionalNote": [None, {"noteLiteral": 3}]}]},
        "not json",
        "",
        "null",
    ]
    table = docs(spark, odd)
    lo = {r.file: r for r in extract.lo_records(table).collect()}
    assert sorted(lo) == ["d0.json", "d1.json", "d2.json"]
    assert lo["d0.json"].title == "" and lo["d0.json"]["countryCode.prefLabel"] == ""
    assert json.loads(lo["d1.json"].learningOutcome) == [{"title": "", "additionalNote": []}] * 3
    qual = {r.sourceFile: r for r in extract.qual_records(table).collect()}
    assert qual["d2.json"].qualificationName == "5"
    assert json.loads(qual["d2.json"].learningOutcomes) == [{"title": "", "additionalNotes": "3"}]
    assert {r.file for r in extract.malformed(table).collect()} == {"d3.json", "d4.json", "d5.json"}


def test_notes_take_every_label_form(spark):
    record = {
        "learningOutcome": [
            None,
            {"additionalNote": "x"},
            {"additionalNote": [{"noteLiteral": ["a", {"de": "b2", "en": "b"}, "", {"zz": "c", "aa": "d"}]}, None]},
            {"additionalNote": [{"noteLiteral": {"fr": "e", "de": "f"}}, {"noteLiteral": None}, {"noteLiteral": 7}]},
        ]
    }
    parsed = vx.with_json(docs(spark, [record]), "body", "doc")
    notes = parsed.select(ox.note_texts(F.col("doc"), F.col("body")).alias("n")).first().n
    assert notes == ["a", "b", "c", "e", "7"]


def test_nested_and_csv_forms_of_the_jobs_agree(spark):
    rng = random.Random(3)
    texts = ["1) Plan", "Note: x", "n/a", "", "<b>Use</b> &amp; do", '{"a"', "[x", "false", "0", "Title: \nNote - b"]

    def outcome():
        notes = [{"noteLiteral": rng.choice(texts)} for _ in range(rng.randint(0, 3))]
        return {"title": rng.choice(texts), "additionalNote": notes}

    records = []
    for _ in range(600):
        place = {"location": [{"address": [{"countryCode": {"prefLabel": rng.choice(["AT", ""])}}]}]}
        outcomes = [outcome() for _ in range(rng.randint(0, 3))]
        summary = {"noteLiteral": rng.choice(["text", " ", "null"])}
        level = {"prefLabel": rng.choice(["Level 4", "EQF 3"])}
        records.append({
            "title": rng.choice(["t", "null"]), "publisher": place, "EQFLevel": level,
            "learningOutcomeSummary": summary, "learningOutcome": outcomes,
            "learningAchievementSpecification": {"learningOutcomeSummary": summary, "learningOutcome": outcomes},
        })
    table = docs(spark, records)
    pairs = [
        (jobs.qual_dataset(table), jobs.qual_rows(extract.qual_records(table, with_entry=True))),
        (jobs.lo_dataset(table), jobs.lo_rows(extract.lo_records(table))),
    ]
    for direct, by_text in pairs:
        assert direct.columns == by_text.columns
        a, b = sorted(map(tuple, direct.collect())), sorted(map(tuple, by_text.collect()))
        assert a == b and len(a) > 10
