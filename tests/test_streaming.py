"""Two runs over a growing folder, with state kept in the checkpoint."""

from __future__ import annotations

import json

import pytest

from recordloom.streaming import ingest

SCHEMA = "level int, country string, `from` bigint, pos bigint, uri string"


def drop(folder, name, items):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"level": 1, "country": "AT", "from": f, "pos": p, "uri": u}) for f, p, u in items]
    (folder / name).write_text("\n".join(lines))


def seen_run(spark, folder, tmp_path, schema=SCHEMA, files_per_batch=None):
    out = str(tmp_path / "seen")
    ingest.first_seen_stream(
        ingest.list_item_stream(spark, str(folder), schema, files_per_batch),
        lambda files: ingest.list_item_files(spark, files, schema),
        out, str(tmp_path / "seen_state"), "uri", ["from", "pos"], ["level"],
    )
    return spark.read.parquet(out)


def test_two_runs(spark, tmp_path):
    folder = tmp_path / "in"
    out = {k: str(tmp_path / k) for k in ("land", "land_state", "count", "count_state")}

    def run():
        def stream():
            return ingest.list_item_stream(spark, str(folder), SCHEMA, files_per_batch=1)

        ingest.ingest_files(stream(), out["land"], out["land_state"])
        ingest.counter_stream(stream(), out["count"], out["count_state"])
        return seen_run(spark, folder, tmp_path, files_per_batch=1)

    drop(folder, "1.json", [(0, 1, "a"), (0, 0, "a"), (0, 2, None), (0, 3, "")])
    run()
    drop(folder, "2.json", [(10, 0, "a"), (10, 1, "b"), (10, 2, "b")])
    run()
    seen = run().collect()
    assert spark.read.parquet(out["land"]).count() == 7
    assert {(r.uri, r["from"], r.pos) for r in seen} == {("a", 0, 0), ("b", 10, 1)} and len(seen) == 2
    counters = ingest.read_counters(spark, out["count"]).collect()
    assert [(r.country, r.level, r["items"], r.without_uri, r.last_from) for r in counters] == [("AT", 1, 7, 1, 10)]


def test_a_later_arrival_never_wins(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "1.json", [(50, 0, "a"), (40, 7, "a")])
    seen_run(spark, folder, tmp_path)
    drop(folder, "2.json", [(0, 0, "a"), (5, 5, "b"), (5, 5, "b")])
    got = seen_run(spark, folder, tmp_path).collect()
    assert sorted((r.uri, r["from"], r.pos) for r in got) == [("a", 40, 7), ("b", 5, 5)]


def test_state_holds_no_payload(spark, tmp_path):
    """The same keys with wide rows leave state of the same size."""
    sizes = []
    for width in (1, 4000):
        top = tmp_path / f"w{width}"
        folder = top / "in"
        folder.mkdir(parents=True)
        lines = [
            json.dumps({"level": 1, "from": 0, "pos": p, "uri": f"u{p}", "extra": chr(97 + p % 26) * width})
            for p in range(200)
        ]
        (folder / "1.json").write_text("\n".join(lines))
        got = seen_run(spark, folder, top, SCHEMA + ", extra string")
        assert got.count() == 200 and len(got.first().extra) == width
        state = [f.stat().st_size for f in (top / "seen_state" / "state").rglob("*") if f.suffix == ".delta"]
        sizes.append(sum(state))
    assert abs(sizes[0] - sizes[1]) < 0.1 * sizes[0]


class Killed(Exception):
    pass


def test_counters_stay_readable_when_a_batch_is_killed(spark, tmp_path, monkeypatch):
    folder, out, state = tmp_path / "in", str(tmp_path / "count"), str(tmp_path / "state")

    def run():
        ingest.counter_stream(ingest.list_item_stream(spark, str(folder), SCHEMA), out, state)

    def items():
        return [r["items"] for r in ingest.read_counters(spark, out).collect()]

    drop(folder, "1.json", [(0, 0, "a")])
    run()
    drop(folder, "2.json", [(10, 0, "b"), (10, 1, "c")])

    def killed(*_):
        raise Killed

    # Written, but the pointer was not switched.
    with monkeypatch.context() as m:
        m.setattr(ingest, "_switch", killed)
        with pytest.raises(Exception, match="STREAM_FAILED"):
            run()
    assert items() == [1]
    # Half written: no reader and no later run meets what is left of it.
    half = tmp_path / "count" / "version=1-half"
    half.mkdir()
    (half / "part-half.parquet").write_bytes(b"PAR1")
    run()
    assert items() == [3] and not half.exists()
    # Switched, but old versions still there.
    drop(folder, "3.json", [(20, 0, "d")])
    with monkeypatch.context() as m:
        m.setattr(ingest, "_drop_versions", killed)
        with pytest.raises(Exception, match="STREAM_FAILED"):
            run()
    assert items() == [4]
    run()
    assert items() == [4]


def test_no_counters_before_the_first_batch(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest.read_counters(spark, str(tmp_path / "none"))
