"""Operators on hand-made frames: the traps and the invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audience, cohorts, metrics, monitoring, orders, payments, quality, retention, weather

D = dt.date


def test_cancellation_on_another_day_nets_to_zero(rows):
    staged = rows(
        "payment_id bigint, parent_payment_id bigint, user_id bigint, payment_type int, paid_price int,"
        "point_price int, created_date date, approved_at date",
        (1, 0, 5, 0, 100, 10, D(2020, 1, 1), D(2020, 1, 1)),
        (2, 1, 5, 1, 100, 10, D(2020, 2, 1), D(2020, 2, 1)),
        (3, None, 5, 0, 70, 0, D(2019, 5, 1), D(2019, 5, 1)),
        (4, 99, 6, 2, 3000, 0, D(2019, 5, 1), D(2019, 5, 1)),
        (5, 98, 6, 2, 3000, 0, D(2020, 5, 1), D(2020, 5, 1)),
        (6, 0, 6, 0, 0, -5000, D(2020, 5, 1), D(2020, 5, 1)),
    )
    net = payments.net_payments(staged)
    assert {r["original_payment_id"]: r["net_paid_price"] for r in net.collect()} == {
        1: 0, 3: 70, 99: -3000, 98: -3000, 6: -5000,
    }
    assert [r["original_payment_id"] for r in payments.negative_net_payments(net).collect()] == [98]
    by_year = payments.count_by_year(payments.negative_net_payments(net, 0, ()))
    assert {r["year"]: r["violations"] for r in by_year.collect()} == {2019: 1, 2020: 1}
    assert payments.worst_offenders(net, 1).first()["original_payment_id"] == 6


def test_staging_carries_the_parent_key():
    assert "parent_payment_id" in payments.STAGED_COLUMNS and len(payments.STAGED_COLUMNS) == 21


def test_self_join_keeps_every_payment_once(rows):
    df = rows(
        "id bigint, user_id bigint, payment_type int, point_price int, parent_payment_id bigint, paid_price int,"
        "succeeded int",
        (1, 1, 0, 5, 0, 50, 1), (2, 1, 1, 5, 1, 50, 1), (3, 1, 1, 7, 77, 9, 1), (4, 1, 0, 1, 0, 1, 0),
    )
    out = {r["id"]: (r["signed_point_price"], r["original_id"]) for r in payments.signed_points(df).collect()}
    assert out == {1: (5, None), 2: (-5, 1), 3: (-7, None)}


def test_parity_flags_months_of_one_side(rows):
    a = rows("month string, model_value double", ("2024-01", 101.0), ("2024-02", 120.0), ("2024-03", 1.0))
    b = rows("month string, reference_value double", ("2024-01", 100.0), ("2024-02", 100.0), ("2024-04", 1.0))
    out = payments.reconcile(a, b, 0.011)
    assert {r["month"]: r["within_tolerance"] for r in out.collect()} == {
        "2024-01": True, "2024-02": False, "2024-03": False, "2024-04": False,
    }
    assert quality.parity_check(out, "x").first()["failures"] == 3


def test_cohort_counts_users_once_per_period(rows):
    df = rows(
        "user_id bigint, wash_date date",
        (1, D(2024, 1, 1)), (1, D(2024, 1, 1)), (1, D(2024, 2, 1)), (1, D(2024, 2, 2)), (2, D(2024, 1, 20)),
        (3, D(2024, 2, 5)),
    )
    out = {r["cohort_month"]: tuple(r)[1:] for r in cohorts.retention_cohorts(df, periods=3).collect()}
    assert out == {"2024-01": (2, 2, 1, 0), "2024-02": (1, 1, 0, 0)}


def test_hot_user_does_not_change_cohorts(spark):
    hot = spark.sql("select 0L as user_id, date_add(date'2024-01-01', int(id % 90)) as wash_date from range(30000)")
    rest = spark.sql("select id as user_id, date'2024-01-03' as wash_date from range(1, 500)")
    out = cohorts.retention_cohorts(hot.union(rest)).collect()
    assert [tuple(r) for r in out] == [("2024-01", 500, 500, 1)]


def test_order_report_keeps_fan_out_of_two_buyers(rows):
    main = rows(
        "order_id bigint, user_id bigint, created_at date, status string, external_channel_pgi int,"
        "is_first_order boolean",
        (1, 1, D(2024, 1, 5), "PAID", None, True), (2, 1, D(2024, 1, 5), "REFUNDED", None, True),
        (3, 1, D(2024, 1, 5), "PAID", 7, True), (4, 1, D(2024, 1, 5), "PAID", None, None),
    )
    store = rows(
        "user_id bigint, order_id bigint, order_status string, pay_amount int, cancel_amount int, created_at date",
        (1, 1, "COMPLETED", 10, 2, D(2024, 1, 6)), (2, 1, "COMPLETED", 5, 0, D(2024, 1, 6)),
        (1, 4, "COMPLETED", 5, 5, D(2024, 1, 6)), (1, 4, "OPEN", 50, 5, D(2024, 1, 6)),
    )
    member = rows("order_id bigint, membership_price decimal(18,2)", (4, 9900))
    out = orders.order_report(main, store, member, "2024-01-01", "2024-01-31")
    got = sorted((r["order_id"], r["store_amount"], r["membership_amount"]) for r in out.collect())
    assert got == [(1, 5, "정기결제 차감"), (1, 8, "정기결제 차감"), (4, 0, "9900.00")]


def test_users_with_and_without_cover_all(rows):
    users = rows("user_id bigint", (1,), (2,), (3,))
    items = rows("user_id bigint, x int", (1, 1), (1, 1), (2, 0), (None, 1))
    on = audience.users_with_item(users, items, F.col("x") == 1)
    off = audience.users_without_item(users, items, F.col("x") == 1)
    assert [r[0] for r in on.collect()] == [1] and sorted(r[0] for r in off.collect()) == [2, 3]


def test_channels_without_a_name_are_organic(rows):
    df = rows("ts date, event_type string, channel string, value int", (D(2024, 1, 1), "a", "ad", 1), (D(2024, 1, 1), "a", None, 1), (D(2024, 1, 1), "z", "ad", 1))
    out = audience.channel_counts(df, ["ad"], {"a": "sign_up"})
    assert sorted((r["channel_class"], r["events"]) for r in out.collect()) == [("organic", 1), ("paid", 1)]


def test_generic_checks(rows):
    df = rows("id int, t int, p int", (1, 0, 1), (1, 5, 2), (None, None, 9), (None, 1, None), (3, 1, 9))
    assert quality.unique_check(df, "id", "x").first()["failures"] == 1
    rules = {r["check"]: r["failures"] for r in quality.row_rules(df, "x", ["id"], {"t": [0, 1, 2]}).collect()}
    assert rules == {"not_null(id)": 2, "accepted_values(t)": 1}
    parent = rows("k int", (1,), (2,))
    row = quality.relationship_check(df, "p", parent, "k", "x", "warn").first()
    assert (row["failures"], row["status"]) == (2, "warn")
    worst = quality.worst_status(quality.row_rules(df, "x", ["id", "p"])).first()
    assert (worst["status"], worst["checks"], worst["not_passed"]) == ("error", 2, 2)


def test_empty_table_checks(rows):
    empty = rows("id int, created_at date")
    assert quality.unique_check(empty, "id", "x").first()["status"] == "pass"
    assert quality.freshness_check(empty, "created_at", "x", "2024-01-01 00:00:00").first()["status"] == "error"
    assert quality.volume_check(empty, "x").first()["message"] == "no rows"


@pytest.mark.parametrize("as_of,status", [("2024-01-02 00:00:00", "pass"), ("2024-01-02 00:00:01", "warn"), ("2024-01-03 00:00:01", "error")])
def test_freshness_borders(rows, as_of, status):
    df = rows("created_at date", (D(2024, 1, 1),))
    assert quality.freshness_check(df, "created_at", "x", as_of).first()["status"] == status


def test_one_failing_target_does_not_stop_the_others(spark, rows):
    def broken():
        raise KeyError("x")

    targets = {"a": lambda: rows("v int", (1,)), "b": broken, "c": lambda: rows("v int", (0,))}
    out = monitoring.run_summary(spark, targets, metrics={"c": "v"})
    assert {r["target"]: r["status"] for r in out.collect()} == {"a": "ok", "b": "failed", "c": "anomaly"}
    assert monitoring.is_bad_run(out)
    assert not monitoring.is_bad_run(monitoring.run_summary(spark, targets, "a"))
    with pytest.raises(ValueError):
        monitoring.run_summary(spark, targets, "nope")


def test_segment_checks_edges(spark, rows):
    labels = rows("user_id int, classification int", (1, 0), (2, 0), (3, 1), (4, 2))
    runs = rows("target string, run_ts date, row_count bigint", ("s", D(2024, 1, 1), 100), ("s", D(2024, 1, 2), 60))
    for k, failing in ((11, 1), (24, 1), (17, 0)):
        out = {r["check"]: r["failures"] for r in monitoring.segment_checks(labels, runs, k, range(10, 26)).collect()}
        assert out == {"user_drop": 1, "cluster_concentration": 1, "k_at_search_edge": failing}
    assert monitoring.cluster_shares(labels).agg(F.sum("share")).first()[0] == pytest.approx(1.0)


MODEL = metrics.model_from_spec(
    {
        "name": "m",
        "tables": [
            {"name": "item", "dimensions": [{"name": "cat", "expr": "cat"}],
             "measures": [{"name": "cnt", "expr": "n"}],
             "time_dimensions": [{"name": "day", "expr": "day"}],
             "facts": [{"name": "ok", "expr": "status not in (4, 17)", "labels": ["filter"]},
                       {"name": "note", "expr": "false"}]},
            {"name": "plan", "dimensions": [{"name": "plan_name", "expr": "upper(label)"}],
             "measures": [{"name": "price", "expr": "price"}]},
        ],
        "relationships": [{"name": "r", "left_table": "item", "right_table": "plan", "relationship_columns": [
            {"left_column": "plan_id", "right_column": "id"}, {"left_column": "cat", "right_column": "cat"}]}],
    }
)
REVENUE = metrics.Product("revenue", "cnt", "price")


@pytest.fixture
def frames(rows):
    item = rows(
        "plan_id int, cat string, n int, status int, day date",
        (1, "a", 2, 1, D(2024, 1, 3)), (1, "a", 3, 1, D(2024, 2, 3)), (None, "a", 9, 1, D(2024, 1, 3)),
        (2, "b", 1, 1, D(2024, 1, 3)), (2, "b", 50, 4, D(2024, 1, 3)),
    )
    plan = rows("id int, cat string, price int, label string", (1, "a", 10, "x"), (2, "a", 99, "y"), (2, "b", 7, "y"))
    return {"item": item, "plan": plan}


def test_metric_query(frames):
    out = metrics.metric_query(MODEL, frames, "item", ["cnt", REVENUE], ["cat"])
    assert {r["cat"]: (r["cnt"], r["revenue"]) for r in out.collect()} == {"a": (14, 50), "b": (1, 7)}
    by_plan = metrics.metric_query(MODEL, frames, "item", [REVENUE], ["plan_name", "day:month"])
    got = {(r["plan_name"], str(r["day_month"])): r["revenue"] for r in by_plan.collect()}
    assert got == {("X", "2024-01-01"): 20, ("X", "2024-02-01"): 30, (None, "2024-01-01"): None, ("Y", "2024-01-01"): 7}
    total = metrics.metric_query(MODEL, frames, "item", ["cnt"], where=["day < date'2024-02-01'"])
    assert total.first()["cnt"] == 12


@pytest.mark.parametrize("measures,dims", [(["nope"], []), (["cnt"], ["nope"]), (["cnt"], ["day:hour"]), ([metrics.Product("r", "cnt", "x")], [])])
def test_metric_names_are_checked(frames, measures, dims):
    with pytest.raises(ValueError):
        metrics.metric_query(MODEL, frames, "item", measures, dims)


def test_a_key_that_occurs_twice_fails_the_query(frames):
    twice = {**frames, "plan": frames["plan"].union(frames["plan"])}
    assert metrics.metric_query(MODEL, twice, "item", ["cnt"]).first()["cnt"] == 15  # the plans are not read
    with pytest.raises(Exception, match="more than once"):
        metrics.metric_query(MODEL, twice, "item", [REVENUE], ["cat"]).collect()


def _chain(*extra):
    names = {"item": "cnt", "plan": "price", "maker": "", "place": "", "shop": ""}
    tables = [
        {"name": t, "dimensions": [{"name": d, "expr": d} for d in ([f"{t}_name", "label"] if t != "item" else ["cat"])],
         "measures": [{"name": m, "expr": m}] if m else []}
        for t, m in names.items()
    ]
    links = [("made_by", "plan", "maker"), ("sold_as", "item", "plan"), ("maker_in", "maker", "place"), ("sold_in", "item", "shop"), *extra]
    relations = [
        {"name": n, "left_table": a, "right_table": b, "relationship_columns": [{"left_column": f"{b}_id", "right_column": "id"}]}
        for n, a, b in links
    ]
    return metrics.model_from_spec({"name": "chain", "tables": tables, "relationships": relations})


@pytest.fixture
def chain(rows):
    ref = lambda t, *v: rows(f"id int, {t}_name string, label string, place_id int, maker_id int, price int", *v)
    return {
        "item": rows("cat string, cnt int, plan_id int, shop_id int", ("a", 1, 1, 1), ("a", 2, 2, 2), ("b", 4, 1, None), ("b", 8, None, 1), ("b", 16, 9, 1)),
        "plan": ref("plan", (1, "p", "x", None, 1, 10), (2, "q", "y", None, 2, 100)),
        "maker": ref("maker", (1, "m", "x", 1, None, 0), (2, "n", "y", 2, None, 0)),
        "place": ref("place", (1, "north", "x", None, None, 0), (2, "south", "y", None, None, 0)),
        "shop": ref("shop", (1, "s", "x", 2, None, 0), (2, "t", "y", 1, None, 0)),
    }


def test_several_links_and_hops(chain):
    value = metrics.Product("value", "cnt", "price")
    out = metrics.metric_query(_chain(), chain, "item", ["cnt", value], ["place_name", "shop_name", "plan.label"])
    got = {(r["place_name"], r["shop_name"], r["plan_label"]): (r["cnt"], r["value"]) for r in out.collect()}
    assert got == {
        ("north", "s", "x"): (1, 10), ("south", "t", "y"): (2, 200), ("north", None, "x"): (4, 40), (None, "s", None): (24, None),
    }


def test_ways_between_tables(chain):
    both = _chain(("shop_in", "shop", "place"))
    with pytest.raises(ValueError, match="several ways .*made_by.* or .*shop_in"):
        metrics.metric_query(both, chain, "item", ["cnt"], ["place_name"])
    out = metrics.metric_query(both, chain, "item", ["cnt"], ["place_name"], via=["shop_in"])
    assert {r["place_name"]: r["cnt"] for r in out.collect()} == {"south": 25, "north": 2, None: 4}
    with pytest.raises(ValueError, match="many rows for one"):
        metrics.metric_query(both, chain, "plan", ["price"], ["cat"])
    with pytest.raises(ValueError, match="no relationship leads"):
        metrics.metric_query(both, chain, "plan", ["price"], ["shop_name"])
    with pytest.raises(ValueError, match="name the table"):
        metrics.metric_query(both, chain, "item", ["cnt"], ["label"])
    round_trip = _chain(("back", "place", "item"))  # a circle of links ends
    assert set(round_trip.paths("item")) == {"plan", "maker", "place", "shop"}


def test_relationship_key(frames, rows):
    assert metrics.check_relationship(MODEL, "r", frames).first()["status"] == "pass"
    twice = {**frames, "plan": frames["plan"].union(frames["plan"])}
    assert metrics.check_relationship(MODEL, "r", twice).first()["failures"] == 3


def test_unlisted_items_get_the_default(rows):
    items = rows("item_name string, n int", ("duvet", 1), ("sock", 1), (None, 1))
    out = metrics.categorize_items(items, rows("item_name string, category string", ("duvet", "bedding_count")))
    assert sorted((r["item_name"] or "", r["subtract_category"]) for r in out.collect()) == [
        ("", "cleaning_count"), ("duvet", "bedding_count"), ("sock", "cleaning_count"),
    ]


@pytest.fixture
def people(spark, rows):
    members = rows("id bigint, deleted_at string", (1, "2024-01-01"), (2, None), (3, "2023-01-01"))
    paid = spark.sql(
        "select id, user_id, paid_price, created_at, user_name, user_email, user_phone_number from values "
        "(10L, 1L, 5, timestamp_ntz'2010-01-01 00:00:00', 'kim', 'k@x', '010'),"
        "(11L, 1L, 5, timestamp_ntz'2023-01-01 00:00:00', 'kim', 'k@x', '010'),"
        "(12L, 2L, 5, timestamp_ntz'2010-01-01 00:00:00', 'lee', 'l@x', '011'),"
        "(13L, 3L, 5, timestamp_ntz'2010-01-01 00:00:00', null, 'c@x', '012'),"
        "(14L, 3L, 5, timestamp_ntz'2010-01-01 00:00:00', '탈퇴회원', 'tok', '01000000000'),"
        "(15L, 3L, 5, null, 'choi', 'c@x', '012') "
        "as t(id, user_id, paid_price, created_at, user_name, user_email, user_phone_number)"
    )
    return members, paid


def test_masking(people):
    members, paid = people
    out = retention.mask_main(paid, members, "2024-06-01 00:00:00")
    masked = {r["id"] for r in out.where("user_name = '탈퇴회원'").collect()}
    assert masked == {10, 13, 14} and out.count() == 6
    assert out.where("id = 14").first()["user_email"] == "tok"
    keep = ["id", "user_id", "paid_price", "created_at"]
    assert out.select(keep).exceptAll(paid.select(keep)).isEmpty()
    assert retention.rows_due(out, members, "2024-06-01 00:00:00").count() == 0
    again = retention.mask_main(out, members, "2024-06-01 00:00:00")
    assert again.exceptAll(out).isEmpty()


def test_plain_guard_skips_rows_without_a_name(people):
    members, paid = people
    assert retention.rows_due(paid, members, "2024-06-01 00:00:00").count() == 2
    assert retention.rows_due(paid, members, "2024-06-01 00:00:00", parity=True).count() == 1
    out = retention.mask_main(paid, members, "2024-06-01 00:00:00", parity=True)
    assert out.count() == 6 and out.where("id = 13").first()["user_name"] is None


def test_retention_batch_runs_twice(spark, people, tmp_path):
    members, paid = people
    store = str(tmp_path / "store")
    first = retention.run_retention(members, paid, store, str(tmp_path / "m1"), str(tmp_path / "s1"), "2024-06-01 00:00:00")
    assert first == {"transferred": 1, "masked_main": 2, "masked_store": 0}
    main = spark.read.parquet(str(tmp_path / "m1"))
    later = retention.run_retention(members, main, store, str(tmp_path / "m2"), str(tmp_path / "s2"), "2029-06-01 00:00:00")
    assert later == {"transferred": 0, "masked_main": 1, "masked_store": 1}
    stored = spark.read.parquet(str(tmp_path / "s2"))
    assert [r["user_name"] for r in stored.collect()] == ["탈퇴회원"]


def slots(rows, *values):
    return rows("region string, fcst_date string, fcst_time string, category string, fcst_value string, seq int", *values)


def test_last_value_wins_and_empty_categories_stay(rows):
    df = slots(rows, ("s", "20240101", "0900", "TMP", "1", 1), ("s", "20240101", "0900", "TMP", "2", 2))
    row = weather.slots_wide(df).first()
    assert row["TMP"] == "2" and row["SKY"] is None


def test_daily_rollup_rules(rows):
    df = slots(
        rows,
        ("s", "20240101", "0900", "TMN", "-3", 1), ("s", "20240101", "1000", "TMN", "x", 9),
        ("s", "20240101", "0900", "TMX", "5", 2), ("s", "20240101", "0900", "TMP", "0", 3),
        ("s", "20240101", "1000", "TMP", "4", 4), ("s", "20240101", "0900", "POP", "30", 5),
        ("s", "20240101", "1000", "POP", "bad", 6), ("s", "20240101", "0900", "REH", "2", 7),
        ("s", "20240101", "1000", "REH", "3", 8),
    )
    row = weather.daily_forecast(df).first().asDict()
    assert row == {
        "region": "s", "date": D(2024, 1, 1), "temp_min_c": 0.0, "temp_max_c": 5.0, "temp_from_hourly": True,
        "precip_prob_max_pct": 30.0, "humidity_avg_pct": 2,
    }


@pytest.mark.parametrize("hours,expected", [(None, 24), (0, 1), (-5, 1), (100, 72), (48, 48)])
def test_hours_are_clamped(hours, expected):
    assert weather.clamp_hours(hours) == expected


def test_upcoming_starts_at_the_current_hour(rows):
    df = slots(rows, *[("s", "20240101", f"{h:02d}00", "TMP", str(h), h) for h in range(24)])
    out = weather.hourly_forecast(df, "2024-01-01 09:59:00", 3)
    assert [r["time"] for r in out.orderBy("time").collect()] == ["01-01 09:00", "01-01 10:00", "01-01 11:00"]


def test_weekly_change_follows_the_shared_calendar(rows):
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(9)]
    a = [("a", d, float(i)) for i, d in enumerate(days)]
    b = [("b", d, 10.0 * i) for i, d in enumerate(days) if i != 1]
    out = weather.weekly_change(rows("region string, ds date, temp double", *a, *b))
    got = {(r["region"], r["ds"].day): r["change"] for r in out.collect() if r["change"] is not None}
    assert got == {("a", 8): 7.0, ("a", 9): 7.0, ("b", 8): 70.0}
    fired = weather.temperature_triggers(out.drop("change")).orderBy("ds").collect()
    assert len(fired) == 9 and [r["temp_trigger_3deg"] for r in fired] == [0] * 7 + [1, 0]
