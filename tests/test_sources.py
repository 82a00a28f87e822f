"""Reading landed files, publishing, and appends that may be repeated."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.sources import keyed, registry, sinks, weather_feed
from tidemark.streaming import incremental


def test_registry(spark, rows, tmp_path):
    rows("a int", (1,)).write.parquet(str(tmp_path / "t.parquet"))
    reg = registry.SourceRegistry.from_folder(str(tmp_path), ["t"])
    reg.create_views(spark)
    assert spark.table("t").count() == 1 and reg.read(spark, "t").columns == ["a"]
    with pytest.raises(ValueError):
        reg.source("x")
    with pytest.raises(ValueError):
        reg.add(reg.source("t"))


def test_source_schema_and_options(spark, tmp_path):
    (tmp_path / "s.csv").write_text("item_name;category\nduvet;bedding_count\n")
    source = registry.Source("s", str(tmp_path / "s.csv"), "csv", "item_name string, category string", {"sep": ";", "header": "true"})
    assert source.read(spark).first()["category"] == "bedding_count"


def test_seed_must_fit_its_schema(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("d,n\n2024-01-01,1\n")
    seed = registry.read_seed(spark, str(tmp_path / "seed.csv"), "d date, n int")
    assert tuple(seed.first()) == (dt.date(2024, 1, 1), 1)
    (tmp_path / "bad.csv").write_text("d,n\n2024-01-01,x\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        registry.read_seed(spark, str(tmp_path / "bad.csv"), "d date, n int").collect()


def test_targets():
    assert list(registry.select_targets({"a": 1, "b": 2})) == ["a", "b"]
    assert registry.select_targets({"a": 1, "b": 2}, "b") == {"b": 2}
    with pytest.raises(ValueError):
        registry.select_targets({"a": 1}, "c")


def test_jdbc_options():
    got = registry.jdbc_options("jdbc:x", "payment", "id", 1, 1000, 8, properties={"user": "u"})
    assert got["fetchsize"] == "1000" and got["numPartitions"] == "8" and got["user"] == "u"
    with pytest.raises(ValueError):
        registry.jdbc_options("jdbc:x", "payment", "id", 5, 5, 8)


def test_only_recent_files_are_read(spark, rows, tmp_path):
    for name, when in (("old", 1_600_000_000), ("new", 1_700_000_000)):
        path = tmp_path / "in" / name
        rows("n string", (name,)).coalesce(1).write.parquet(str(path))
        for f in path.glob("*.parquet"):
            os.utime(f, (when, when))
    got = registry.read_recent(spark, str(tmp_path / "in" / "*"), "2022-01-01T00:00:00")
    assert [r[0] for r in got.collect()] == ["new"]


def test_default_target_is_the_safe_one(spark, rows):
    assert sinks.qualified_name("m") == "dev_sandbox.m"
    with pytest.raises(ValueError):
        sinks.qualified_name("m", "live")
    assert sinks.publish_table(rows("a int", (1,)), "m") == "dev_sandbox.m"
    assert spark.table("dev_sandbox.m").count() == 1
    assert not spark.catalog.tableExists("analytics_mart.m")


def test_snapshot_swap_leaves_old_readers_alone(spark, rows, tmp_path):
    root = str(tmp_path / "snap")
    sinks.publish_snapshot(rows("a int", (1,)), root, "1", "current_rows")
    held = spark.table("current_rows")
    sinks.publish_snapshot(rows("a int", (1,), (2,)), root, "2", "current_rows")
    assert spark.table("current_rows").count() == 2 and held.count() == 1
    other = spark.newSession()
    assert other.table("current_rows").count() == 2 and sinks.read_snapshot(other, root).count() == 2
    assert sinks.read_snapshot(other, root, "1").count() == 1


def test_old_versions_go_in_order_of_publication(spark, rows, tmp_path):
    root = str(tmp_path / "snap")
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, root)
    for i, name in enumerate(("b", "c", "a")):
        sinks.publish_snapshot(rows("a int", (i,)), root, name, keep=2)
    assert sinks.read_snapshot(spark, root).first()["a"] == 2
    assert [v for _, v in sinks.snapshot_versions(spark, root)] == ["b", "c", "a"]
    assert sorted(d for d in os.listdir(root) if d.startswith("version=")) == ["version=a", "version=c"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.publish_snapshot(rows("a int", (9,)), root, "a")
    assert sinks.read_snapshot(spark, root).first()["a"] == 2  # a failed publication changes nothing


def test_csv_snapshot_replaces_its_own_day_only(spark, rows, tmp_path):
    path = str(tmp_path / "crm")
    for day, n in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)):
        sinks.write_csv_snapshot(rows("n int", (n,)), path, day)
    got = spark.read.option("header", True).csv(path).select("n", F.col("snapshot_date").cast("string").alias("d"))
    assert sorted(tuple(r) for r in got.collect()) == [("1", "2024-01-01"), ("3", "2024-01-02")]


def test_append_twice_adds_once(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    batch = rows("id int, v string", (1, "b"), (1, "a"), (2, "c"))
    assert sinks.append_new(batch, path, "id", ["v"]) == 2
    assert sinks.append_new(batch, path, "id", ["v"]) == 0
    assert sinks.append_new(rows("id int, v string", (2, "z"), (3, "d")), path, "id") == 1
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_null_and_repeated_keys_are_appended_once(spark, rows, tmp_path):
    path, batch = str(tmp_path / "t"), rows("id int, v string", (None, "b"), (None, "a"), (1, "a"), (1, "a"))
    assert [sinks.append_new(batch, path, "id", ["v"]) for _ in range(3)] == [2, 0, 0]
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect() if r["id"]) == [(1, "a")]
    path, day = str(tmp_path / "inc"), dt.date(2024, 1, 5)
    source = rows("k int, d date", (None, day), (None, day), (1, day), (1, day), (2, None), (None, None))
    assert [incremental.load_increment(source, path, "d", "k").loaded for _ in range(3)] == [3, 0, 0]


def test_a_load_without_lookback_finds_what_was_missed(spark, rows, tmp_path):
    path = str(tmp_path / "inc")
    incremental.load_increment(rows("k int, d date", (1, dt.date(2024, 3, 1))), path, "d", "k")
    late = rows("k int, d date", (1, dt.date(2024, 3, 1)), (2, dt.date(2024, 1, 1)))
    assert incremental.load_increment(late, path, "d", "k").loaded == 0
    assert incremental.load_increment(late, path, "d", "k", lookback=None).loaded == 1
    assert incremental.load_increment(late, path, "d", "k").missed.isEmpty()


def test_keyed_table_opens_few_folders(spark, tmp_path):
    path = str(tmp_path / "keyed")
    batch = lambda a, b: spark.range(a, b).selectExpr("id", "cast(id as string) as v")
    make = lambda: keyed.KeyedTable(spark, path, "id", folders=16, folder_keys=1000)
    first = make().append(batch(0, 8000))
    assert first == (8000, 0, 0)  # nothing to open yet
    again = make().append(batch(0, 8000))
    assert again.rows == 0 and again.folders == 16 and again.files == 16
    one = make().append(batch(5, 6))
    assert (one.rows, one.folders, one.files) == (0, 1, 1)
    # New keys rarely look known: of 1,000 at most a few folders are opened, and all rows arrive.
    new = make().append(batch(8000, 9000))
    assert new.rows == 1000 and new.folders <= 12
    few = make().append(batch(9000, 9020))
    assert few.rows == 20 and few.folders <= 3
    got = make().read(batch(0, 1).schema)
    assert got.count() == 9020 == got.select("id").distinct().count() and got.columns == ["id", "v"]
    wider = keyed.KeyedTable(spark, path, "id", folders=99)  # the layout is that of the first write
    assert wider.folders == 16 and wider.append(batch(0, 100)).rows == 0


def test_keyed_table_is_right_with_full_filters(spark, rows, tmp_path):
    make = lambda: keyed.KeyedTable(spark, str(tmp_path / "keyed"), "k", folders=3, folder_keys=1)
    named = lambda *ks: rows("k string, v int", *[(k, i) for i, k in enumerate(ks)])
    assert make().append(named(None, None, "a", "b", "a")).rows == 3
    assert make().append(named(None, "a", "b")).rows == 0
    assert make().append(named(*[f"x{i}" for i in range(200)], None)).rows == 200
    assert make().append(named(*[f"x{i}" for i in range(200)], "y")).rows == 1
    assert make().append(named().limit(0)).rows == 0
    assert sorted((r["k"] or "") for r in make().read(named().schema).collect())[:3] == ["", "a", "b"]


def test_bits_without_rows_do_no_harm(spark, rows, tmp_path):
    """A run that failed after its bits were written: the next one loads the rows."""
    path, batch = str(tmp_path / "keyed"), rows("k int", (1,), (2,))
    table = keyed.KeyedTable(spark, path, "k")
    table.append(rows("k int", (7,)))
    bits = table._dealt(batch).select("key_folder", "key_word", "key_mask")
    bits.write.mode("append").parquet(os.path.join(path, "_keys", "filter"))
    assert keyed.KeyedTable(spark, path, "k").append(batch).rows == 2


def test_stream_once(spark, rows, tmp_path):
    source, path, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    schema = "k int, ts timestamp_ntz"

    def run(*values):
        rows(schema, *values).coalesce(1).write.mode("append").parquet(source)
        query = incremental.stream_once(
            incremental.read_files_stream(spark, source, rows(schema).schema), path, state, "ts", "k", "2 days"
        )
        query.awaitTermination()
        return incremental.late_count(query), sorted((r["k"] or 0, r["fate"]) for r in spark.read.parquet(path).collect())

    first = [(0, "timely"), (1, "timely"), (2, "timely"), (3, "undated")]
    assert run((1, at(10)), (1, at(10)), (2, at(9)), (3, None), (None, at(10))) == (0, first)
    # The state knows 1 and the null key; 4 is within the delay, 5 is behind it, 3 is found in the table.
    assert run((1, at(10)), (4, at(9)), (5, at(1)), (3, None), (None, at(10, 1))) == (1, sorted([*first, (4, "timely")]))
    everything = spark.read.schema(schema).parquet(source)
    assert incremental.load_late(everything, path, "ts", "k").rows == 1
    assert incremental.load_late(everything, path, "ts", "k").rows == 0
    # A key that comes again after the state has forgotten it is found in the table.
    assert run((9, at(25)))[1][-1] == (9, "timely")
    late, got = run((1, at(25)))
    assert got.count((1, "timely")) == 1 and len(got) == 7


def test_frozen_dates_survive_later_runs(spark, rows, tmp_path):
    path = str(tmp_path / "f")
    for day, y in (("2024-01-01", 1.0), ("2024-01-08", 2.0), ("2024-01-08", 3.0)):
        sinks.freeze_forecast(rows("series_id string, ds date, yhat double", ("a", dt.date(2024, 2, 1), y)), path, day)
    got = spark.read.parquet(path)
    assert sorted((str(r["as_of_date"]), r["yhat"]) for r in got.collect()) == [("2024-01-01", 1.0), ("2024-01-08", 3.0)]


def test_payload(rows):
    df = rows("m string, n int", ("b", 2), ("a", None))
    row = sinks.json_payload(df, "t", ["m"]).first()
    assert row["row_count"] == 2
    assert json.loads(row["payload"]) == {"target": "t", "data": [{"m": "a", "n": None}, {"m": "b", "n": 2}]}
    parts = sorted(sinks.json_payload(df, "t", ["m"], rows=1).collect())
    assert [(r["part"], json.loads(r["payload"])["data"][0]["m"]) for r in parts] == [(1, "a"), (2, "b")]
    assert sinks.json_payload(df.limit(0), "t", ["m"]).first()["row_count"] == 0


def test_json_records(spark, rows, tmp_path):
    sinks.write_json_records(rows("a int", (1,), (2,)), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_landed_weather(spark, tmp_path):
    def land(station, name, text):
        folder = tmp_path / "land" / f"station_id={station}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)

    def body(*items):
        return json.dumps(
            {"response": {"header": {"resultCode": "00"}, "body": {"items": {"item": list(items)}}}}, indent=2
        )

    land("108", "2023.json", body({"tm": "2023-01-02", "avgTa": "-", "sumRn": "", "max1hrRn": "2.5"}))
    land("108", "2024.json", body({"tm": "2024-01-02", "avgTa": "1.5"}, {"tm": "2024-01-01", "avgTa": "3", "sumRn": "4"}))
    land("112", "2024.json", '{"response": {"header": {"resultCode": "99", "resultMsg": "NO DATA"}}}')
    land("119", "2024.json", "<OpenAPI_ServiceResponse>\n<err/></OpenAPI_ServiceResponse>")
    responses = weather_feed.parse_responses(weather_feed.read_landing(spark, str(tmp_path / "land")))
    days = weather_feed.sorted_weather(weather_feed.daily_rows(responses))
    assert [(str(r["ds"]), r["region"], r["avg_temp"], r["rain_total"], r["rain_max_1h"]) for r in days.collect()] == [
        ("2023-01-02", "Region_A", None, 0.0, 2.5),
        ("2024-01-01", "Region_A", 3.0, 4.0, 0.0),
        ("2024-01-02", "Region_A", 1.5, 0.0, 0.0),
    ]
    bad = {r["station_id"]: (r["status"], r["detail"]) for r in weather_feed.quarantined(responses).collect()}
    assert bad["112"] == ("error_code", "99: NO DATA") and bad["119"][0] == "not_json"
    assert bad["119"][1].startswith("<OpenAPI") and len(bad) == 2


def test_a_body_is_parsed_once(rows):
    raw = rows("station_id string, raw string", ("108", "{}"))
    responses = weather_feed.parse_responses(raw)
    for out in (weather_feed.daily_rows(responses), weather_feed.quarantined(responses)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_increment_reruns_and_ties(spark, rows, tmp_path):
    path = str(tmp_path / "inc")
    day = dt.date(2024, 1, 1)
    first = rows("k int, d date", (1, day), (2, day))
    assert incremental.load_increment(first, path, "d", "k").loaded == 2
    assert incremental.load_increment(first, path, "d", "k").loaded == 0
    late = rows("k int, d date", (1, day), (2, day), (3, day), (4, dt.date(2024, 1, 2)), (0, dt.date(2023, 1, 1)))
    load = incremental.load_increment(late, path, "d", "k")
    assert load.loaded == 2 and [r["k"] for r in load.missed.collect()] == [0]
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]


def test_stream_rerun_adds_nothing(spark, rows, tmp_path):
    source, path, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    rows("id int", (1,), (2,)).write.parquet(source)
    schema = spark.read.parquet(source).schema

    def run():
        stream = incremental.read_files_stream(spark, source, schema)
        incremental.stream_append(stream, path, state).awaitTermination()
        return spark.read.parquet(path).count()

    assert (run(), run()) == (2, 2)
    rows("id int", (3,)).write.mode("append").parquet(source)
    assert run() == 3


def test_replayed_batch_adds_nothing(spark, rows, tmp_path):
    source, path = str(tmp_path / "src"), str(tmp_path / "out")
    rows("id int, v string", (1, "a"), (1, "a"), (2, "b")).write.parquet(source)
    schema = spark.read.parquet(source).schema
    for state in ("s1", "s2"):  # a lost checkpoint replays everything
        stream = incremental.read_files_stream(spark, source, schema)
        incremental.stream_transfer(stream, path, str(tmp_path / state)).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2]


def test_interval_trigger(spark, rows, tmp_path):
    rows("id int", (1,)).write.parquet(str(tmp_path / "src"))
    stream = incremental.read_files_stream(spark, str(tmp_path / "src"), spark.read.parquet(str(tmp_path / "src")).schema)
    query = incremental.stream_append(stream, str(tmp_path / "o"), str(tmp_path / "c"), "1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and spark.read.parquet(str(tmp_path / "o")).count() == 1
    finally:
        query.stop()
    assert incremental.REFRESH_INTERVAL == "15 minutes"


def test_shared_dir_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
