"""Readers and writers over real files, with files cut into many splits."""

from __future__ import annotations

import json
import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from recordloom.functions import variants as vx
from recordloom.operators import ledger
from recordloom.session import shared_dir
from recordloom.sources import readers, writers


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_numbers_across_splits(spark, tmp_path, small_splits):
    rng = random.Random(2)
    expected = set()
    for name, n in [("a", 1500), ("b", 3), ("c", 0), ("d", 700)]:
        lines = ["x" * rng.randint(0, 30) for _ in range(n)]
        ending = "\r\n" if name == "d" else "\n"
        (tmp_path / f"{name}.ndjson").write_bytes(ending.join(lines).encode() + (b"\n" if n else b""))
        expected |= {(name, i + 1, x) for i, x in enumerate(lines)}
    lines = readers.numbered_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() >= 1
    rows = lines.select(readers.country_of_file(F.col("file")).alias("f"), "line_no", "line").collect()
    assert {(r.f.lower(), r.line_no, r.line) for r in rows} == expected and len(rows) == len(expected)
    done = spark.createDataFrame([(r.file, 1400) for r in lines.select("file").distinct().collect() if "a.nd" in r.file],
                                 "file string, last_line bigint")
    assert readers.lines_after(lines, done).count() == len(expected) - 1400


def test_ndjson(spark, tmp_path):
    (tmp_path / "AUT_eqf3.ndjson").write_text('{"uri":"u1"}\n\n  \n not json \n {"id":2} \n')
    rows = readers.read_ndjson(spark, str(tmp_path)).select("line", vx.text_at(F.col("item"), "$").alias("item")).collect()
    assert [(r.line, r.item) for r in rows] == [
        ('{"uri":"u1"}', '{"uri":"u1"}'), ("not json", None), ('{"id":2}', '{"id":2}')]


def test_documents_any_depth(spark, tmp_path):
    for path, text in [("a.json", '{"x":\n1}'), ("s/b.JSON", "bad"), ("s/t/c.json", "[]"), ("s/d.txt", "{}")]:
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(text)
    rows = readers.read_documents(spark, str(tmp_path)).collect()
    assert {(r.name, r.body) for r in rows} == {("a.json", '{"x":\n1}'), ("b.JSON", "bad"), ("c.json", "[]")}
    assert {r.folder for r in rows} == {tmp_path.name, "s", "t"}
    flat = readers.read_documents(spark, str(tmp_path / "s"), recursive=False).collect()
    assert [r.name for r in flat] == ["b.JSON"]


def test_documents_are_written_one_a_file_in_bounded_folders(spark, tmp_path):
    odd = ['a "quoted"\r\n\u2028 line', "", None, "\u00e9\U0001f600"]
    df = spark.createDataFrame([(k, odd[k % 4]) for k in range(50)], "`i d` int, t string").repartition(3)
    path = str(tmp_path / "docs")
    writers.write_documents(df, path, per_folder=7)
    found = [p for p in Path(path).rglob("*") if p.is_file()]
    assert len(found) == 50 and {p.suffix for p in found} == {".json"}
    assert max(len(list(d.iterdir())) for d in Path(path).iterdir()) <= 7
    bodies = [r.body for r in readers.read_documents(spark, path).collect()]
    df.coalesce(1).write.json(str(tmp_path / "plain"))
    plain = "".join(p.read_text(newline="") for p in (tmp_path / "plain").glob("part-*"))
    assert sorted(bodies) == sorted(x + "\n" for x in plain.split("\n")[:-1])
    # A plan over binary files: the text source copies the settings for every file.
    assert "FileScan binaryFile" in readers.read_documents(spark, path)._jdf.queryExecution().toString()


def test_small_documents_share_tasks(spark, tmp_path, small_splits):
    df = spark.range(2000).withColumnRenamed("id", "x")
    writers.write_documents(df, str(tmp_path / "docs"))
    docs = readers.read_documents(spark, str(tmp_path / "docs"))
    assert docs.rdd.getNumPartitions() <= 2000 // readers.SPLITS + 1
    assert sorted(json.loads(r.body)["x"] for r in docs.collect()) == list(range(2000))
    (tmp_path / "none").mkdir()
    assert readers.read_documents(spark, str(tmp_path / "none")).collect() == []


def test_index(spark, tmp_path):
    (tmp_path / "level1.index.json").write_text(json.dumps(["u1", "u2", None], indent=2))
    (tmp_path / "level7.index.json").write_text('{"no":"array"}')
    good, bad = readers.read_index(spark, str(tmp_path))
    assert [(r.level, r.pos, r.uri) for r in good.orderBy("pos").collect()] == [(1, 0, "u1"), (1, 1, "u2"), (1, 2, None)]
    assert [r.level for r in bad.collect()] == [7]


def test_an_index_beyond_one_variant(spark, tmp_path):
    uris = [f"http://x.org/{i}/" + "u" * 1000 for i in range(40_000)]
    (tmp_path / "level3.index.json").write_text(json.dumps(uris))
    (tmp_path / "level4.index.json").write_text('["u1", 5, "5"] x')
    (tmp_path / "level5.index.json").write_text(' ["u1", 5, "5", {"a": 1}]\n')
    good, bad = readers.read_index(spark, str(tmp_path))
    assert good.filter("level = 3").agg(F.count_distinct("uri"), F.max("pos")).first()[:] == (40_000, 39_999)
    assert [r.uri for r in good.filter("level = 5").orderBy("pos").collect()] == ["u1", None, "5", None]
    assert [r.level for r in bad.collect()] == [4]


def test_grid_file_names(spark):
    names = ["/f/aut_EQF12.ndjson", "/f/AUTX_eqf1.ndjson", "/f/AUT_eqf1.json", "FRA_eqf8.NDJSON"]
    df = spark.createDataFrame([(n,) for n in names], "file string")
    country, level = readers.grid_columns(F.col("file"))
    rows = df.select(country.alias("c"), level.alias("l"), readers.is_ndjson_name(F.col("file")).alias("n")).collect()
    assert [(r.c, r.l) for r in rows] == [("AUT", 12), (None, None), (None, None), ("FRA", 8)]
    assert [r.n for r in rows] == [True, True, False, True]


ROWS = [('say "hi", you', "a\nb", None), (" edge ", "back\\slash", ""), ("", "x,y", "\u00E9")]


@pytest.mark.parametrize("quote_all", [False, True])
def test_csv_round_trip(spark, tmp_path, quote_all):
    df = spark.createDataFrame(ROWS, "`a.b` string, c string, d string").coalesce(1)
    path = str(tmp_path / "csv")
    writers.write_csv(df, path, quote_all)
    back = readers.read_csv(spark, path, df.columns).collect()
    assert {tuple(r) for r in back} == {tuple(x or "" for x in r) for r in ROWS}
    text = "".join(p.read_text() for p in Path(path).glob("*.csv"))
    assert text.startswith('"a.b","c","d"\n' if quote_all else "a.b,c,d\n")
    assert ('"back\\slash"' in text) == quote_all


def test_csv_short_rows_and_nested(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b,c\n1\n1,2,3,4\n")
    rows = readers.read_csv(spark, str(tmp_path / "in.csv"), ["a", "b", "c"]).collect()
    assert [tuple(r) for r in rows] == [("1", "", ""), ("1", "2", "3")]
    path = str(tmp_path / "in.csv")
    extra = readers.read_csv(spark, path, ["c", "a", "z"], surplus="line").collect()
    assert [tuple(r) for r in extra] == [("", "1", "", None), ("3", "1", "", "1,2,3,4")]
    (tmp_path / "turned.csv").write_text("b,a\nB1,A1\n")
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "turned.csv"), ["a", "b"]).collect()] == [("A1", "B1")]
    nested = spark.createDataFrame([(["x"], {"k": 1})], "a array<string>, m map<string,int>")
    assert writers.as_text(nested).first() == ('["x"]', '{"k":1}')


def test_csv_files_have_a_row_limit(spark, tmp_path):
    writers.write_csv(spark.range(25).coalesce(1), str(tmp_path / "c"), rows_per_file=10)
    sizes = sorted(len(p.read_text().splitlines()) - 1 for p in (tmp_path / "c").glob("*.csv"))
    assert sizes == [5, 10, 10]


def test_shards(spark, tmp_path):
    writers.write_shards(spark.range(25).repartition(4), str(tmp_path / "s"), ["id"], 10)
    got = {p.name: [len(f.read_text().splitlines()) - 1 for f in p.glob("*.csv")] for p in (tmp_path / "s").glob("shard=*")}
    assert got == {"shard=0": [10], "shard=1": [10], "shard=2": [5]}


def ordered_text(folder: Path) -> str:
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


def test_country_files_keep_order(spark, tmp_path):
    rows = [("AUT" if i % 3 else "HOT", i % 8 + 1, f"f{i % 2}", i, f" line {i} " if i % 5 else " ") for i in range(300)]
    df = spark.createDataFrame(rows, "country string, level int, file string, line_no int, line string")
    writers.write_country_files(df.repartition(5), str(tmp_path / "c"))
    for country in ("AUT", "HOT"):
        expected = [r[4].strip() for r in sorted(rows, key=lambda r: r[1:4]) if r[0] == country and r[4].strip()]
        assert ordered_text(tmp_path / "c" / f"country={country}").splitlines() == expected


def test_level_documents_are_json(spark, tmp_path):
    rows = [(i % 2 + 1, i // 10 * 10, i % 10, json.dumps({"nr": i})) for i in range(100)]
    df = spark.createDataFrame(rows, "level int, `from` bigint, pos bigint, item string")
    writers.write_level_documents(df.repartition(4), str(tmp_path / "l"))
    for level in (1, 2):
        doc = json.loads(ordered_text(tmp_path / "l" / f"level={level}"))
        assert doc["metadata"] == {"lastFrom": 90, "totalSaved": 50}
        assert [c["nr"] for c in doc["courses"]] == [i for i in range(100) if i % 2 + 1 == level]


def test_store_keeps_the_first_delivery(spark, tmp_path):
    path = str(tmp_path / "store")
    one = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, v int")
    two = spark.createDataFrame([("a", 9), ("c", 4)], "id string, v int")
    writers.store_new(one, path, "id", ["v"])
    stored = writers.store_new(two, path, "id", ["v"])
    assert {tuple(r) for r in stored.collect()} == {("a", 1), ("b", 3), ("c", 4)}


def test_append_and_split(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "bad")], "country string, level int, reason string")
    writers.write_split(df, "reason", str(tmp_path / "g"), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "g")).collect()[0].country == "a"
    assert spark.read.parquet(str(tmp_path / "d")).collect()[0].reason == "bad"
    for _ in range(2):
        writers.write_ndjson(df, str(tmp_path / "n"), ["country", "level"])
    assert spark.read.json(str(tmp_path / "n")).count() == 4


def test_pages(spark):
    assert [r.id for r in ledger.page_of(spark.range(30), ["id"], 20, 5).collect()] == list(range(20, 25))
    far = ledger.page_of(spark.range(30_000), ["id"], 29_990, 20).collect()
    assert [r.id for r in far] == list(range(29_990, 30_000))


def test_shared_folder_is_needed_on_a_cluster():
    def session(master, folder):
        conf = SimpleNamespace(get=lambda key: folder)
        context = SimpleNamespace(master=master, getConf=lambda: conf)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))

    assert shared_dir(session("spark://host:7077", "/shared/")) == "/shared"
    assert shared_dir(session("local[2]", None))
    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        shared_dir(session("spark://host:7077", None))


def test_lines_are_numbered_in_order_without_sorting_them(spark, tmp_path, small_splits):
    lines = {name: [f"{name} {i}" if i % 7 else "" for i in range(n)] for name, n in (("a", 3000), ("b", 1), ("c", 40))}
    for name, texts in lines.items():
        (tmp_path / f"{name}.txt").write_text("".join(t + "\n" for t in texts))
    blocks = spark.read.text(str(tmp_path)).select("_metadata.file_path", "_metadata.file_block_start").distinct()
    numbered = readers.numbered_lines(spark, str(tmp_path))
    got = sorted((Path(r.file).stem, r.line_no, r.line) for r in numbered.collect())
    assert blocks.count() > 3
    assert got == [(name, i + 1, t) for name in "abc" for i, t in enumerate(lines[name])]
    assert "SortMergeJoin" not in numbered._jdf.queryExecution().executedPlan().toString()
