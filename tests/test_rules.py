"""Predicates and scalar rules on hand-made values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import predicates as P
from tidemark.functions import scalars as S


def one(df, column):
    return df.select(column.alias("v")).first()["v"]


def many(df, column, order="i"):
    return [r["v"] for r in df.orderBy(order).select(column.alias("v")).collect()]


def test_pickup_filter_drops_null_status(rows):
    df = rows("i int, status int", (1, 4), (2, 17), (3, 5), (4, None))
    assert [r["i"] for r in df.where(P.is_valid_pickup()).collect()] == [3]


def test_item_filter_drops_null_name(rows):
    df = rows(
        "i int, status int, channel_pgi int, item_name string",
        (1, 1, None, "shirt"), (2, 1, 9, "shirt"), (3, 1, None, None), (4, 1, None, P.NOT_WASHABLE_ITEM),
    )
    assert [r["i"] for r in df.where(P.is_valid_item()).collect()] == [1]


def test_end_day_of_the_two_range_forms(spark):
    df = spark.sql(
        "select * from values (1, timestamp_ntz'2024-01-31 00:00:00'), (2, timestamp_ntz'2024-01-31 10:00:00'),"
        "(3, timestamp_ntz'2024-02-01 00:00:00'), (4, timestamp_ntz'2023-12-31 23:59:59') as t(i, ts)"
    )
    days = df.where(P.on_days("ts", "2024-01-01", "2024-01-31"))
    instants = df.where(P.between_instants("ts", "2024-01-01", "2024-01-31"))
    assert {r["i"] for r in days.collect()} == {1, 2}
    assert {r["i"] for r in instants.collect()} == {1}


def test_range_filter_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select timestamp_ntz'2024-01-05 10:00:00' as ts, 1 as i").write.parquet(path)
    for rule in (P.on_days("ts", "2024-01-01", "2024-01-31"), P.is_expired("ts", "2029-02-01 00:00:00")):
        plan = spark.read.parquet(path).where(rule)._jdf.queryExecution().executedPlan().toString()
        assert "LessThan(ts," in plan.split("PushedFilters:")[1]


@pytest.mark.parametrize("text", ["2024-13-01", "2024/01/01", "", None, "2024-01-01'; drop table x"])
def test_bad_base_date(text):
    with pytest.raises(ValueError):
        P.on_base_date("base_date", text)


def test_retention_split_is_complete_and_leap_safe(spark):
    df = spark.sql("select timestampadd(DAY, id, timestamp_ntz'2018-01-01 00:00:00') as ts from range(800)")
    kept = df.where(P.is_retained("ts", "2024-02-29 00:00:00")).count()
    gone = df.where(P.is_expired("ts", "2024-02-29 00:00:00"))
    assert kept + gone.count() == 800
    assert gone.agg(F.max("ts")).first()[0] == dt.datetime(2019, 2, 27)


def test_unknown_region():
    with pytest.raises(ValueError, match="제주"):
        P.known_values("region", ["서울", "제주"], ["서울", "부산"])


def test_zero_parent_and_sign(rows):
    df = rows("i int, parent bigint, id bigint, t int, p int", (1, 0, 7, 0, 5), (2, 3, 8, 1, 5), (3, None, 9, 2, 5))
    assert many(df, S.zero_as_null("parent", "id")) == [7, 3, 9]
    assert many(df, S.signed_by_type("p", "t")) == [5, -5, -5]


def test_period_index_uses_30_and_a_half_days(spark):
    df = spark.sql("select date'2024-01-01' as a, date_add(date'2024-01-01', n) as b, n as i from values 0,30,31,60,61 t(n)")
    assert many(df, S.period_index("a", "b")) == [0, 0, 1, 1, 2]


def test_labels(rows):
    df = rows("i int, flag boolean, price decimal(18,2)", (1, True, None), (2, False, 3), (3, None, 4))
    assert many(df, S.first_use_label("flag")) == [S.FIRST_USE, S.REPEAT_USE, S.REPEAT_USE]
    assert many(df, S.amount_or_label("price")) == [S.COVERED_BY_PLAN, "3.00", "4.00"]


def test_numbers_from_text(rows):
    df = rows("i int, v string", (1, "1.5"), (2, ""), (3, "-"), (4, None), (5, "NaN"), (6, "1e400"))
    assert many(df, S.to_number("v")) == [1.5, None, None, None, None, None]
    assert many(df, S.blank_as("v", "0.0"))[1] == "0.0" and many(df, S.blank_as("v", "0.0"))[3] == "0.0"


def test_log_guard(rows):
    df = rows("i int, v double", (1, 0.0), (2, None), (3, -1.0), (4, -5.0), (5, 1.718281828459045))
    assert many(df, S.log1p_or_zero("v")) == pytest.approx([0, 0, 0, 0, 1.0])


def test_mixed_offsets_meet_in_one_month(spark, rows):
    df = rows("i int, t string", (1, "2024-01-31 16:00:00 +0000"), (2, "2024-02-01 01:00:00 +0900"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York", "Asia/Seoul"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            assert many(df, S.month_label(S.one_zone("t"))) == ["2024-02", "2024-02"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_dates_as_text(spark):
    df = spark.sql("select date'2026-01-05' as d, '20260105' as c, '0930' as t, '20261305' as bad")
    assert one(df, S.dashboard_day("d")) == "2026. 1. 5"
    assert one(df, S.compact_day("c")) == dt.date(2026, 1, 5)
    assert one(df, S.compact_slot("c", "t")) == dt.datetime(2026, 1, 5, 9, 30)
    assert one(df, S.compact_slot("bad", "t")) is None and one(df, S.compact_day("bad")) is None


def test_codes(rows):
    df = rows("i int, c string", (1, "1"), (2, "8"), (3, None))
    assert many(df, S.decode("c", S.PRECIPITATION_CODES)) == ["비", "8", None]


def test_issue_times_against_the_rule(spark):
    start = dt.datetime(2024, 2, 28, 22, 0)
    times = [start + dt.timedelta(minutes=7 * i) for i in range(420)]
    df = spark.createDataFrame([(i, str(t)) for i, t in enumerate(times)], "i int, t string").withColumn(
        "now", F.col("t").cast("timestamp_ntz")
    )

    def expected(now):
        t = now - dt.timedelta(minutes=15)
        issues = [
            dt.datetime(d.year, d.month, d.day, h) for d in (t - dt.timedelta(days=1), t) for h in range(2, 24, 3)
        ]
        return max(i for i in issues if i <= t)

    assert many(df, S.forecast_issue("now")) == [expected(t) for t in times]
    assert many(df, S.observation_issue("now"))[0] == dt.datetime(2024, 2, 28, 21)


def test_wall_times_ignore_the_session_zone(spark):
    """02:30 of 10 March 2024 does not exist in New York, and is an ordinary time here."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("select timestamp_ntz'2024-03-10 02:50:00' as t, '20240310' as d, '0230' as h")
        assert one(df, S.observation_issue("t").cast("string")) == "2024-03-10 02:00:00"
        assert one(df, S.forecast_issue("t").cast("string")) == "2024-03-10 02:00:00"
        assert one(df, S.compact_slot("d", "h").cast("string")) == "2024-03-10 02:30:00"
        assert one(df, P.from_current_hour("t", "2024-03-10 02:59:00")) is True
        assert one(df, P.from_current_hour("t", "2024-03-10 03:00:00")) is False
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_service_clock_rolls_the_day(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 20:00:00' as t")
    assert one(df, S.service_clock("t")) == dt.datetime(2024, 1, 2, 5)


def test_redact_plain_and_encoded(rows):
    df = rows("t string", ("key=a/b+c and a%2Fb%2Bc, x",))
    assert one(df, S.redact("t", ["a/b+c", "", None])) == "key=*** and ***, x"


def test_plan_rules(rows):
    df = rows(
        "i int, laundry_count int, shirt_count int, cleaning_count int, bedding_count int, launX_count int,"
        "low decimal(9,2), full decimal(9,2)",
        (1, 0, 0, 3, 4, 0, 40, 100), (2, 0, 0, 0, 0, 0, 50, 100), (3, 1, 2, 0, 0, 0, 60, 100),
    )
    assert many(df, S.plan_category()) == ["cleaning_count", None, "laundry_count"]
    assert many(df, S.plan_unit_price("low", "full")) == [60, 50, 60]


def test_deducted_and_truncated(rows):
    df = rows("i int, k string, q int, x double", (1, "SUBTRACT", 3, -1.7), (2, None, 3, 1.7), (3, "NONE", 3, 2.0))
    assert many(df, S.deducted_count("k", "q")) == [3, 0, 0]
    assert many(df, S.whole_part("x")) == [-1, 1, 2]


def test_tokens(rows):
    df = rows("id bigint", (1,), (2,), (3,))
    first = [r[0] for r in df.select(S.keyed_token("id", "s")).collect()]
    assert first == [r[0] for r in df.select(S.keyed_token("id", "s")).collect()]
    assert len(set(first)) == 3
    assert len({r[0] for r in df.select(S.random_token()).collect()}) == 3
