"""One query per operator group: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidemark.functions import predicates as P
from tidemark.functions import scalars as S
from tidemark.operators import (
    audience,
    cohorts,
    forecast,
    metrics,
    monitoring,
    orders,
    payments,
    quality,
    retention,
    segments,
    weather,
)
from tidemark.plans.inputs import HOLIDAYS, load
from tidemark.session import materialize, scratch_path
from tidemark.sources import keyed, registry, sinks, weather_feed
from tidemark.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BASE_TIME = "2001-08-01 00:00:00"
PERIOD = ("1997-03-01", "1997-08-31")
SECRETS = ["@mail", "token = "]
STATION_OF = {"AFRICA": "108", "AMERICA": "112", "ASIA": "119", "EUROPE": "98", "MIDDLE EAST": "159"}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def edge(df: DataFrame) -> DataFrame:
    """Exact decimals become doubles once, at the end."""
    money = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in money}) if money else df


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


# Payments


@query
def stg_payment(spark, sf_dir):
    return edge(payments.stage_payments(load(spark, sf_dir, "payments")))


def _net(spark, sf_dir):
    return payments.net_payments(payments.stage_payments(load(spark, sf_dir, "payments")))


@query
def net_payment(spark, sf_dir):
    return edge(_net(spark, sf_dir))


@query
def net_payment_violations(spark, sf_dir):
    bad = payments.negative_net_payments(_net(spark, sf_dir), -2000, exempt_years=(1997,))
    return edge(bad.select("user_id", "created_date", "gross_paid_price", "cancelled_price", "net_paid_price"))


@query
def net_payment_violations_by_year(spark, sf_dir):
    return payments.count_by_year(payments.negative_net_payments(_net(spark, sf_dir), 0, exempt_years=()))


@query
def net_payment_worst(spark, sf_dir):
    bad = payments.negative_net_payments(_net(spark, sf_dir), 0, exempt_years=())
    return edge(payments.worst_offenders(bad).select("original_payment_id", "user_id", "net_paid_price"))


@query
def payment_signed_self_join(spark, sf_dir):
    return edge(payments.signed_points(load(spark, sf_dir, "payments")))


@query
def monthly_parity(spark, sf_dir):
    ledger = load(spark, sf_dir, "ledger_texts").select(
        S.one_zone("approved_text").alias("approved"),
        S.signed_by_type("paid_price").alias("paid"),
        S.signed_by_type(F.col("paid_price") + F.col("point_price")).alias("both"),
    )
    model = payments.monthly_amount(ledger, "approved", "both", "model_value")
    operating = payments.monthly_amount(ledger, "approved", "paid", "reference_value")
    return payments.reconcile(edge(model), edge(operating), tolerance=0.0011)


@query
def parity_status(spark, sf_dir):
    return quality.parity_check(monthly_parity(spark, sf_dir), "net_payment")


# Cohorts and orders


@query
def cohort_retention(spark, sf_dir):
    return cohorts.retention_cohorts(load(spark, sf_dir, "pickups"))


@query
def first_pickups(spark, sf_dir):
    return cohorts.first_day_per_user(load(spark, sf_dir, "pickups"))


def _report(spark, sf_dir, **options):
    main, store, member = (load(spark, sf_dir, n) for n in ("main_orders", "store_orders", "memberships"))
    return edge(orders.order_report(main, store, member, *PERIOD, **options))


@query
def order_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query
def order_report_instants(spark, sf_dir):
    return _report(spark, sf_dir, whole_end_day=False, headings=orders.REPORT_HEADINGS)


# Audiences


def _bedding_in_period():
    return F.col("item_name").like("%widget") & P.on_days("created_at", *PERIOD)


def _item_days(spark, sf_dir):
    return load(spark, sf_dir, "wash_items").withColumnRenamed("created_date", "created_at")


@query
def users_with_item(spark, sf_dir):
    users = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return audience.users_with_item(users, _item_days(spark, sf_dir), _bedding_in_period())


@query
def users_without_item(spark, sf_dir):
    users = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return audience.users_without_item(users, _item_days(spark, sf_dir), _bedding_in_period())


@query
def buyers_average(spark, sf_dir):
    return audience.buyers_average(load(spark, sf_dir, "coupon_uses"), load(spark, sf_dir, "activity"))


@query
def channel_signups(spark, sf_dir):
    k = F.get_json_object("props", "$.k").try_cast("int")
    channel = F.when(k < 30, F.lit("search_ad")).when(k < 50, F.lit("social_ad")).when(k < 80, F.lit("own"))
    events = load(spark, sf_dir, "events").select(
        "ts", "event_type", channel.alias("channel"), F.col("value").cast("decimal(18,2)").alias("value")
    )
    kinds = {"signup": "sign_up", "purchase": "install", "error": "removal"}
    return edge(audience.channel_counts(events, ["search_ad", "social_ad"], kinds))


@query
def rfm_features(spark, sf_dir):
    made = audience.rfm_features(load(spark, sf_dir, "activity"), "2001-12-31")
    return edge(audience.features_on(made, "2001-12-31"))


# Quality


@query
def dq_generic(spark, sf_dir):
    """The staged model's tested columns are written once, as checks run after models."""
    tested = ["payment_id", "payment_type", "payment_reason_type", "user_id", "wash_id"]
    staged = materialize(payments.stage_payments(load(spark, sf_dir, "payments"), tested), "stg_payment")
    name = "stg_payment"
    return quality.union_all(
        [
            quality.unique_check(staged, "payment_id", name),
            quality.unique_check(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem", "warn"),
            quality.row_rules(
                staged,
                name,
                not_null=["payment_id", "payment_type", "user_id", "wash_id"],
                accepted={"payment_type": [0, 1, 2], "payment_reason_type": [0, 1, 2, 3]},
            ),
            quality.relationship_check(
                staged, "user_id", load(spark, sf_dir, "customer"), "c_custkey", name, "warn"
            ),
            quality.relationship_check(staged, "wash_id", load(spark, sf_dir, "lineitem"), "l_orderkey", name),
        ]
    )


@query
def orphan_washes(spark, sf_dir):
    staged = payments.stage_payments(load(spark, sf_dir, "payments"))
    return quality.orphans(staged, "wash_id", load(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def dq_freshness(spark, sf_dir):
    ledger = load(spark, sf_dir, "payments")
    return quality.union_all(
        [
            quality.freshness_check(ledger, "created_at", f"payments@{as_of}", f"{as_of} 00:00:00")
            for as_of in ("2001-08-05", "2001-08-06", "2001-08-09")
        ]
    )


@query
def service_amount_check(spark, sf_dir):
    items = load(spark, sf_dir, "wash_items").groupBy("wash_id", "user_id", "subtract_type").agg(
        F.sum("total_price").alias("total_price"), F.sum("service_total_price").alias("service_total_price")
    )
    return edge(quality.negative_service_amounts(items))


def _failing_target():
    raise RuntimeError("source is not reachable")


@query
def dq_run_summary(spark, sf_dir):
    targets = {
        "cohorts": lambda: cohorts.retention_cohorts(load(spark, sf_dir, "pickups"), ordered=False),
        "net_payments": lambda: _net(spark, sf_dir),
        "empty": lambda: load(spark, sf_dir, "payments").where(F.col("payment_type") > 2),
        "regions": lambda: load(spark, sf_dir, "region"),
        "broken": _failing_target,
    }
    return monitoring.run_summary(
        spark,
        targets,
        min_rows={"regions": 6},
        metrics={"net_payments": "net_paid_price", "cohorts": "user_count"},
    )


@query
def dq_worst_status(spark, sf_dir):
    return quality.worst_status(dq_generic(spark, sf_dir))


@query
def volume_spikes(spark, sf_dir):
    return rounded(monitoring.spikes(load(spark, sf_dir, "volume"), 14, 2.0), "recent_mean", "ratio")


@query
def row_count_drops(spark, sf_dir):
    return rounded(monitoring.count_drops(load(spark, sf_dir, "runs"), 0.1), "drop_share")


# Metric layer

OFFERS = metrics.LogicalTable(
    "plan_item",
    dimensions=(metrics.Field("trips", "delivery_times"),),
    measures=(metrics.Field("price", "unit_price"),),
)
WASHED = metrics.LogicalTable(
    "wash_item",
    dimensions=(metrics.Field("category", "subtract_category"), metrics.Field("washer", "user_id")),
    measures=(metrics.Field("pieces", "qty"), metrics.Field("counted_pieces", "if(subtract_type = 'SUBTRACT', qty, 0)")),
    time_dimensions=(metrics.Field("washed_on", "created_date"),),
    filters=(metrics.Field("counts", f"not (status in (4, 17)) and channel_pgi is null and item_name <> '{P.NOT_WASHABLE_ITEM}'"),),
)
PRICED = metrics.Relationship("priced_by_plan", "wash_item", "plan_item", (("plan_id", "plan_id"), ("subtract_category", "subtract_category")))
WASHERS = metrics.LogicalTable("washer", dimensions=(metrics.Field("trade", "c_mktsegment"),))
NATIONS = metrics.LogicalTable("nation", dimensions=(metrics.Field("name", "n_name"),))
REGIONS = metrics.LogicalTable("region", dimensions=(metrics.Field("name", "r_name"),))
ITEM_LINKS = (
    PRICED,
    metrics.Relationship("washed_for", "wash_item", "washer", (("user_id", "c_custkey"),)),
    metrics.Relationship("lives_in", "washer", "nation", (("c_nationkey", "n_nationkey"),)),
    metrics.Relationship("lies_in", "nation", "region", (("n_regionkey", "r_regionkey"),)),
)
ITEM_MODEL = metrics.SemanticModel("laundry", (OFFERS, WASHED, WASHERS, NATIONS, REGIONS), ITEM_LINKS)
VALUE = metrics.Product("washed_value", "counted_pieces", "price")


def _item_frames(spark, sf_dir):
    seed = materialize(load(spark, sf_dir, "item_seed"), "seed")
    items = metrics.categorize_items(load(spark, sf_dir, "wash_items"), seed)
    related = {"plan_item": "plan_items", "washer": "customer", "nation": "nation", "region": "region"}
    return {"wash_item": items} | {name: load(spark, sf_dir, table) for name, table in related.items()}


@query
def item_categories(spark, sf_dir):
    items = _item_frames(spark, sf_dir)["wash_item"]
    valid = P.is_valid_item("status", "channel_pgi", "item_name")
    return (
        items.withColumn("deducted", S.deducted_count("subtract_type", "qty"))
        .groupBy("subtract_category", valid.alias("valid"))
        .agg(F.sum("deducted").alias("deducted"), F.sum("qty").alias("qty"))
    )


@query
def valid_pickups(spark, sf_dir):
    items = load(spark, sf_dir, "wash_items")
    kept = items.where(P.is_valid_pickup() & P.is_own_channel("channel_pgi"))
    return kept.groupBy("status").agg(F.count(F.lit(1)).alias("items"))


@query
def item_revenue(spark, sf_dir):
    out = metrics.metric_query(
        ITEM_MODEL,
        _item_frames(spark, sf_dir),
        "wash_item",
        ["pieces", "counted_pieces", VALUE],
        ["category", "washed_on:month"],
        where=["created_date >= date '1996-01-01'"],
    )
    return edge(out)


@query
def item_revenue_by_delivery(spark, sf_dir):
    out = metrics.metric_query(
        ITEM_MODEL, _item_frames(spark, sf_dir), "wash_item", ["counted_pieces", VALUE], ["trips"]
    )
    return edge(out)


@query
def item_revenue_by_region(spark, sf_dir):
    """Two links of one table, one of them over three hops."""
    dims = ["trips", "trade", "region.name", "washed_on:year"]
    return edge(metrics.metric_query(ITEM_MODEL, _item_frames(spark, sf_dir), "wash_item", ["pieces", VALUE], dims))


@query
def item_revenue_by_day(spark, sf_dir):
    out = metrics.metric_query(ITEM_MODEL, _item_frames(spark, sf_dir), "wash_item", ["pieces", VALUE], ["washed_on:day"])
    return edge(out)


@query
def item_revenue_by_grain(spark, sf_dir):
    frames = _item_frames(spark, sf_dir)
    one = lambda g: metrics.metric_query(ITEM_MODEL, frames, "wash_item", ["pieces"], [f"washed_on:{g}"])
    named = [one(g).select(F.lit(g).alias("grain"), F.col(f"washed_on_{g}").alias("starts"), "pieces") for g in metrics.GRAINS]
    return functools.reduce(DataFrame.unionByName, named)


@query
def item_quantity_total(spark, sf_dir):
    return metrics.metric_query(ITEM_MODEL, _item_frames(spark, sf_dir), "wash_item", ["pieces"])


@query
def plan_key_check(spark, sf_dir):
    return metrics.check_relationship(ITEM_MODEL, "priced_by_plan", _item_frames(spark, sf_dir))


@query
def plan_unit_price(spark, sf_dir):
    plans = load(spark, sf_dir, "plan_contents")
    return edge(
        plans.select(
            "plan_id",
            S.plan_category().alias("subtract_category"),
            S.plan_unit_price("discounted_price", "original_price").alias("unit_price"),
        )
    )


# Retention of personal data


def _members_payments(spark, sf_dir):
    return load(spark, sf_dir, "members"), load(spark, sf_dir, "personal_payments")


@query
def transfer_withdrawn(spark, sf_dir):
    members, paid = _members_payments(spark, sf_dir)
    half = paid.where(F.col("created_at") >= P.wall_time("1999-01-01 00:00:00"))
    stored = retention.transfer_rows(members, half, BASE_TIME)
    return edge(sinks.new_rows(retention.transfer_rows(members, paid, BASE_TIME), stored, "id", ["created_at"]))


def _due(spark, sf_dir):
    """Payments to transfer, some of them twice."""
    members, paid = _members_payments(spark, sf_dir)
    due = retention.transfer_rows(members, paid, BASE_TIME).select("id", "user_id", "paid_price", "created_at")
    return due.unionAll(due.where(F.col("id") % 13 == 0))


@query
def transfer_twice(spark, sf_dir):
    """Payments moved to a keyed table in three runs: the older half, the same again, all. Some have no id."""
    due = materialize(_due(spark, sf_dir).withColumn("id", F.when(F.col("id") % 97 != 0, F.col("id"))), "due")
    half = due.where(F.col("created_at") < P.wall_time("1999-01-01 00:00:00"))
    table = keyed.KeyedTable(spark, scratch_path(spark, "transferred"), "id")
    order = ["created_at", "user_id", "paid_price"]
    runs = [table.append(batch.withColumn("run", F.lit(run)), order) for run, batch in enumerate((half, half, due), 1)]
    if runs[1].rows:
        raise RuntimeError(f"the second run appended {runs[1].rows} rows")
    return edge(table.read(due.withColumn("run", F.lit(1)).schema))


@query
def stream_transfers(spark, sf_dir):
    """The same payments as a stream of three files, run again with a lost checkpoint, which replays all of them."""
    names = "transfer-landing", "transfer-streamed", "transfer-state", "transfer-state"
    landing, path, *checkpoints = (scratch_path(spark, n) for n in names)
    due = _due(spark, sf_dir)
    due.repartition(3, "user_id").write.parquet(landing)
    for checkpoint in checkpoints:
        stream = incremental.read_files_stream(spark, landing, due.schema, files_per_trigger=1)
        incremental.stream_transfer(stream, path, checkpoint).awaitTermination()
    return edge(keyed.KeyedTable(spark, path, "id").read(due.schema))


@query
def mask_expired(spark, sf_dir):
    members, paid = _members_payments(spark, sf_dir)
    return edge(retention.mask_main(paid, members, BASE_TIME, salt="retention"))


@query
def mask_store(spark, sf_dir):
    members, paid = _members_payments(spark, sf_dir)
    later = retention.transfer_rows(members, paid, "1999-08-01 00:00:00")
    return edge(retention.mask_store(later, BASE_TIME, salt="retention"))


@query
def mask_preflight(spark, sf_dir):
    members, paid = _members_payments(spark, sf_dir)

    def counted(rows, name):
        return rows.agg(F.count(F.lit(1)).alias("affected")).select(F.lit(name).alias("step"), "affected")

    return quality.union_all(
        [
            counted(retention.transfer_rows(members, paid, BASE_TIME), "transfer"),
            counted(retention.rows_due(paid, members, BASE_TIME), "mask_main"),
            counted(retention.rows_due(paid, members, BASE_TIME, parity=True), "mask_main_parity"),
            counted(retention.rows_due(paid, None, BASE_TIME), "mask_by_age"),
        ]
    )


# Weather


def _responses(spark, sf_dir):
    """One response text per region and month; some months have an error code or XML beside it."""
    rain = F.when(F.dayofmonth("ds") % 3 == 0, "").otherwise(F.dayofmonth("ds").cast("string"))
    item = F.struct(
        F.col("ds").cast("string").alias("tm"),
        F.when(F.dayofmonth("ds") == 13, "-").otherwise(F.col("temp").cast("string")).alias("avgTa"),
        rain.alias("sumRn"),
        F.when(F.dayofmonth("ds") % 2 == 0, "").otherwise("1.5").alias("max1hrRn"),
    )
    pairs = [F.lit(x) for kv in STATION_OF.items() for x in kv]
    station = F.element_at(F.create_map(*pairs), F.col("region"))
    months = (
        load(spark, sf_dir, "weather")
        .groupBy(station.alias("station_id"), S.month_label("ds").alias("month"))
        .agg(F.collect_list(item).alias("item"))
    )
    body = F.struct(
        F.struct(
            F.struct(F.lit("00").alias("resultCode"), F.lit("OK").alias("resultMsg")).alias("header"),
            F.struct(F.struct("item").alias("items")).alias("body"),
        ).alias("response")
    )
    number = F.substring("month", 6, 2).cast("int")
    bad = F.when(number == 7, F.lit('{"response":{"header":{"resultCode":"99","resultMsg":"LIMIT"}}}')).when(
        number == 11, F.concat(F.lit("<error><month>"), "month", F.lit("</month></error>"))
    )
    raw = F.explode(F.array_compact(F.array(F.to_json(body), bad)))
    return weather_feed.parse_responses(months.select("station_id", "month", raw.alias("raw")))


@query
def weather_json_rows(spark, sf_dir):
    names = {v: k for k, v in STATION_OF.items()}
    return weather_feed.sorted_weather(weather_feed.daily_rows(_responses(spark, sf_dir), names))


@query
def weather_json_quarantine(spark, sf_dir):
    return weather_feed.quarantined(_responses(spark, sf_dir))


@query
def landed_weather(spark, sf_dir):
    """The responses as one landed file each, in a folder per station, read again in one scan."""
    path = scratch_path(spark, "landing")
    bodies = _responses(spark, sf_dir).select("station_id", F.col("raw").alias("value")).repartition("station_id")
    bodies.write.partitionBy("station_id").option("maxRecordsPerFile", 1).option("lineSep", " ").text(path)
    names = {v: k for k, v in STATION_OF.items()}
    return weather_feed.daily_rows(weather_feed.parse_responses(weather_feed.read_landing(spark, path)), names)


@query
def forecast_slots_wide(spark, sf_dir):
    return weather.slots_wide(load(spark, sf_dir, "forecast_rows"))


@query
def hourly_forecast(spark, sf_dir):
    rows = load(spark, sf_dir, "forecast_rows").where(P.known_values("region", ["서울", "부산"], ["서울", "부산"]))
    return weather.hourly_forecast(rows, "2024-01-15 10:35:00", 48)


@query
def forecast_daily(spark, sf_dir):
    return weather.daily_forecast(load(spark, sf_dir, "forecast_rows"), "2024-01-15 10:35:00")


@query
def current_weather(spark, sf_dir):
    return weather.current_weather(load(spark, sf_dir, "observation_rows"))


@query
def issue_times(spark, sf_dir):
    return load(spark, sf_dir, "events").select(
        "event_id",
        S.observation_issue("ts").alias("observation_issue"),
        S.forecast_issue("ts").alias("forecast_issue"),
        S.observation_issue(S.service_clock("ts")).alias("kst_observation_issue"),
    )


# Demand forecast


def _daily(spark, sf_dir):
    """The daily volume, written once: the stand-in predictions are made of it too."""
    return materialize(load(spark, sf_dir, "volume"), "volume")


def _holidays(daily):
    return forecast.yearly_holidays(daily, HOLIDAYS)


@query
def temp_triggers(spark, sf_dir):
    return weather.temperature_triggers(materialize(load(spark, sf_dir, "weather"), "weather"))


@query
def training_days(spark, sf_dir):
    """Days of the volume that have triggers; the weather of odd days only, so that days without any drop out."""
    odd = load(spark, sf_dir, "weather").where(F.dayofmonth("ds") % 2 == 1)
    triggers = materialize(weather.temperature_triggers(materialize(odd, "weather")), "triggers")
    return forecast.training_days(load(spark, sf_dir, "volume"), triggers)


@query
def days_with_triggers(spark, sf_dir):
    triggers = materialize(weather.temperature_triggers(materialize(load(spark, sf_dir, "weather"), "weather")), "triggers")
    early = load(spark, sf_dir, "volume").where(F.col("ds") < "1997-07-01")
    return forecast.days_with_triggers(materialize(early, "early"), triggers.where(F.dayofmonth("ds") != 1), 60)


@query
def temperature_days(spark, sf_dir):
    """The filled temperatures: what was observed as it is, the days after only by their date."""
    observed = materialize(load(spark, sf_dir, "weather"), "weather")
    last = F.broadcast(observed.groupBy("region").agg(F.max("ds").alias("last")))
    filled = forecast.forecast_temperature(observed, 60).join(last, "region")
    ahead = F.col("ds") > F.col("last")
    return filled.select("region", "ds", F.when(~ahead, F.col("temp")).alias("temp"), (ahead & F.col("temp").isNotNull()).alias("ahead"))


@query
def holiday_window(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    return forecast.with_holidays(daily, _holidays(daily))


@query
def actual_over_forecast(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    actual = daily.select(F.col("series_id").alias("region"), "ds", F.col("y").alias("temp"))
    predicted = load(spark, sf_dir, "week_ago", volume=daily).withColumnRenamed("series_id", "region")
    return weather.actual_over_forecast(actual, predicted)


@query
def horizon_days(spark, sf_dir):
    return forecast.history_and_future(_daily(spark, sf_dir), 60)


@query
def forecast_totals(spark, sf_dir):
    return forecast.forecast_totals(load(spark, sf_dir, "week_ago"), n=60)


@query
def plan_series(spark, sf_dir):
    return forecast.clean_series(forecast.plans_to_series(load(spark, sf_dir, "wide_volume"), ["plan_a", "plan_b"]))


@query
def forecast_error(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    return rounded(forecast.mean_absolute_error(daily, load(spark, sf_dir, "week_ago", volume=daily)), "mae")


@query
def frozen_forecast(spark, sf_dir):
    made = load(spark, sf_dir, "dated_predictions", volume=_daily(spark, sf_dir))
    return forecast.frozen_pick(made, "2001-06-30")


@query
def forecast_checks(spark, sf_dir):
    """One more region is expected than there is."""
    seen = load(spark, sf_dir, "weather")
    known = load(spark, sf_dir, "region").select(F.col("r_name").alias("region"))
    expected = known.unionByName(spark.range(1).select(F.lit("ANTARCTICA").alias("region")))
    predicted = load(spark, sf_dir, "week_ago", volume=_daily(spark, sf_dir))
    return monitoring.forecast_checks(predicted, seen, expected, 14, 2.0)


def _daily_inputs(spark, sf_dir):
    series = materialize(load(spark, sf_dir, "region_volume"), "region-volume")
    return series, load(spark, sf_dir, "weather"), _holidays(series)


@query
def trend_forecast(spark, sf_dir):
    """A line per series, the one model whose solution SQL can state."""
    daily, spec = _daily(spark, sf_dir), forecast.ModelSpec(seasons=(), changepoints=0)
    days = forecast.history_and_future(daily, 60)
    made = forecast.predict_series(days, forecast.fit_series(daily, spec), spec)
    return rounded(made.select("series_id", "ds", "yhat"), "yhat")


@query
def forecast_backtest(spark, sf_dir):
    """Hold-out errors of a line per series over four cut-offs."""
    held_out = forecast.backtest(_daily(spark, sf_dir), forecast.ModelSpec(seasons=(), changepoints=0))
    return rounded(forecast.backtest_errors(held_out).drop("inside"), "mae", "rmse")


@query
def volume_backtest(spark, sf_dir):
    """Hold-out errors of the volume model; its triggers are those of the observed days."""
    series, weather_days, holidays = _daily_inputs(spark, sf_dir)
    triggers = materialize(weather.temperature_triggers(weather_days), "triggers")
    return rounded(forecast.volume_backtest(series, triggers, holidays), "mae", "rmse", "inside")


@query
def dashboard_forecast(spark, sf_dir):
    """Totals of all regions; a region's series holds all its orders, so that the series end on like days."""
    series, weather_days, _ = _daily_inputs(spark, sf_dir)
    region = F.substring_index("series_id", "/", -1).alias("series_id")
    daily = materialize(series.groupBy(region, "ds").agg(F.sum("y").alias("y")), "region-days")
    return forecast.dashboard_forecast(daily, weather_days, _holidays(daily), 60)


@query
def dashboard_gaps(spark, sf_dir):
    """The dashboard's totals less the sums of their own series: nothing, but for the cut to whole numbers."""
    made = materialize(forecast.last_days(forecast.forecast_volume(*_daily_inputs(spark, sf_dir), 60), 60), "parts")
    sums = made.groupBy(F.col("ds").alias("day")).agg(*[F.sum(c).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])
    off = lambda total, part: (F.abs(F.col(total) - F.col(part)) >= 1.0).alias(total.replace("total", "off"))
    both = forecast.forecast_totals(made, n=60).join(sums, "day")
    return both.select("day", off("total_yhat", "yhat"), off("total_lower", "yhat_lower"), off("total_upper", "yhat_upper"))


@query
def frozen_dates(spark, sf_dir):
    """Predictions frozen under two dates; the second date is frozen twice, its last run stays."""
    made = materialize(load(spark, sf_dir, "dated_predictions", volume=_daily(spark, sf_dir)), "predictions")
    path = scratch_path(spark, "frozen")
    for day, more in (("1998-01-05", 0.0), ("1998-01-12", 9.0), ("1998-01-12", 0.5)):
        rows = made.where(F.col("as_of_date") == day).select("series_id", "ds", (F.col("yhat") + more).alias("yhat"))
        sinks.freeze_forecast(rows, path, day)
    return spark.read.parquet(path)


@query
def volume_forecast(spark, sf_dir):
    made = forecast.forecast_volume(*_daily_inputs(spark, sf_dir), 60)
    return rounded(forecast.last_days(made, 60), "yhat", "yhat_lower", "yhat_upper")


# Segments


@query
def robust_scaled(spark, sf_dir):
    made = audience.rfm_features(load(spark, sf_dir, "activity"), "2001-12-31")
    features = materialize(made.drop("base_date"), "features")
    out = segments.robust_scaled(features)
    return rounded(out, *segments.feature_columns(out))


@query
def aic_elbow(spark, sf_dir):
    return rounded(segments.elbow(load(spark, sf_dir, "k_scores")), "second_difference", digits=2)


@query
def user_segments(spark, sf_dir):
    made = audience.rfm_features(load(spark, sf_dir, "activity"), "2001-12-31")
    return edge(segments.segment_users(audience.features_on(made, "2001-12-31")))


@query
def segment_invariants(spark, sf_dir):
    """What holds for any clustering: each user once, with all names, and clusters that add up to the whole."""
    made = materialize(user_segments(spark, sf_dir), "segments")
    summary = segments.cluster_summary(made.drop("cluster 1", "cluster 2", "cluster 3"))
    names = [c for c in summary.columns if c.startswith("avg_")]
    sums = [F.sum(F.col("members") * F.col(c)).alias(c.replace("avg_", "sum_")) for c in names]
    whole = summary.agg(F.sum("members").alias("members"), (F.count(F.lit(1)) >= 10).alias("enough_clusters"), *sums)
    named = F.coalesce(*[F.when(F.col(f"cluster {i}").isNull(), 1) for i in (1, 2, 3)], F.lit(0))
    users = made.agg(F.countDistinct("user_id").alias("users"), F.sum(named).alias("unnamed"))
    return rounded(whole.join(F.broadcast(users)), *[c.replace("avg_", "sum_") for c in names], digits=0)


@query
def labelled_users(spark, sf_dir):
    features = audience.rfm_features(load(spark, sf_dir, "activity"), "2001-12-31").drop("base_date")
    labelled = materialize(features.join(load(spark, sf_dir, "user_buckets"), "user_id"), "labelled")
    return edge(segments.with_names(labelled))


@query
def filled_features(spark, sf_dir):
    """Log features where some values are missing or not a number."""
    made = audience.rfm_features(load(spark, sf_dir, "activity"), "2001-12-31").select("user_id", "recency", "tenure", "monetary")
    gaps = made.select(
        "user_id",
        F.when(F.col("user_id") % 5 != 0, F.col("recency")).alias("recency"),
        F.when(F.col("user_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("tenure").cast("double")).alias("tenure"),
        F.when(F.col("user_id") % 11 == 0, F.lit(-5)).otherwise(F.col("monetary")).alias("monetary"),
    )
    return rounded(segments.log_features(gaps), "recency", "tenure", "monetary")


@query
def cluster_means(spark, sf_dir):
    features = audience.rfm_features(load(spark, sf_dir, "activity"), "2001-12-31").drop("base_date")
    labelled = features.join(load(spark, sf_dir, "user_buckets"), "user_id")
    summary = segments.cluster_summary(labelled)
    means = [c for c in summary.columns if c.startswith("avg_")]
    named = summary.join(segments.name_clusters(summary), "classification", "left")
    return rounded(named.withColumns({c: F.col(c).cast("double") for c in means}), *means, digits=3)


@query
def segment_checks(spark, sf_dir):
    k = segments.elbow(load(spark, sf_dir, "k_scores")).first()["k"]
    return monitoring.segment_checks(
        load(spark, sf_dir, "user_buckets"), load(spark, sf_dir, "runs"), k, range(10, 26), max_drop=0.1
    )


@query
def cluster_shares(spark, sf_dir):
    return rounded(monitoring.cluster_shares(load(spark, sf_dir, "user_buckets")), "share")


# Exports and published tables


@query
def crm_snapshot(spark, sf_dir):
    """Features exported as CSV for two dates, the second one twice, and read back."""
    path, columns = scratch_path(spark, "crm"), ["user_id", "recency", "frequency", "monetary"]
    for day in ("2000-12-31", "2001-12-31", "2001-12-31"):
        made = audience.rfm_features(load(spark, sf_dir, "activity"), day).select(*columns)
        sinks.write_csv_snapshot(made, path, day)
    schema = "user_id bigint, recency int, frequency bigint, monetary decimal(28,2), snapshot_date date"
    return edge(spark.read.schema(schema).option("header", True).csv(path))


@query
def published_categories(spark, sf_dir):
    """Parts by category: named sources, a seed loaded from CSV, and a table of the default target."""
    sources = registry.SourceRegistry.from_folder(sf_dir, ["part"])
    sources.create_views(spark)
    seed = scratch_path(spark, "seed")
    load(spark, sf_dir, "item_seed").write.option("header", True).csv(seed)
    named = registry.read_seed(spark, seed, "item_name string, category string")
    parts = spark.table("part").select(F.col("p_name").alias("item_name"), F.col("p_size").alias("size"))
    counted = metrics.categorize_items(parts, named).groupBy("subtract_category").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("size").alias("sizes")
    )
    return spark.table(sinks.publish_table(counted, "part_categories", root=scratch_path(spark, "published")))


# Incremental loads, payloads, texts


@query
def incremental_events(spark, sf_dir):
    """Two loads into a new table: first the older half, then everything."""
    events = load(spark, sf_dir, "events")
    path = scratch_path(spark, "incremental")
    incremental.load_increment(events.where(F.col("ts") < P.wall_time("2024-01-15 00:00:00")), path, "ts", "event_id")
    incremental.load_increment(events, path, "ts", "event_id")
    return spark.read.schema(events.schema).parquet(path)


@query
def incremental_late(spark, sf_dir):
    """Every seventh event comes late: loaded within the lookback, reported as missed beyond it.

    Some events have no id (one key like others, once in the lookback), some come twice.
    """
    events = load(spark, sf_dir, "events").select("event_id", "ts")
    path = scratch_path(spark, "incremental-late")
    events = events.withColumn("event_id", F.when(F.col("event_id") % 11 != 0, F.col("event_id")))
    events = events.unionAll(events.where(F.col("event_id") % 17 == 0))
    on_time = (F.col("ts") < P.wall_time("2024-01-15 00:00:00")) & ~F.coalesce(F.col("event_id") % 7 == 0, F.lit(False))
    incremental.load_increment(events.where(on_time), path, "ts", "event_id")
    missed = incremental.load_increment(events, path, "ts", "event_id").missed
    loaded = spark.read.schema(events.schema).parquet(path).withColumn("loaded", F.lit(True))
    return loaded.unionByName(materialize(missed.withColumn("loaded", F.lit(False)), "missed"))


@query
def stream_events(spark, sf_dir):
    """The events table as a stream, run twice; the second run finds nothing new."""
    source, schema = os.path.join(sf_dir, "events.parquet*"), load(spark, sf_dir, "events").schema
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    for _ in range(2):
        stream = incremental.read_files_stream(spark, source, schema)
        incremental.stream_append(stream, path, checkpoint).awaitTermination()
    return spark.read.schema(schema).parquet(path)


@query
def snapshot_swap(spark, sf_dir):
    """Two versions of the daily counts, published one after the other, as a second session finds them by name."""
    runs = materialize(load(spark, sf_dir, "runs"), "runs")
    root = scratch_path(spark, "snapshot")
    sinks.publish_snapshot(runs.where("run_ts < date '2024-01-15'"), root, "first", "current_runs")
    sinks.publish_snapshot(runs, root, "second", "current_runs")
    other = spark.newSession()
    by_name, by_path = other.table("current_runs"), sinks.read_snapshot(other, root)
    named = by_name.join(by_path.withColumnRenamed("row_count", "stored"), ["target", "run_ts"], "full")
    return named.select("target", "run_ts", "row_count", "stored")


@query
def stream_late(spark, sf_dir):
    """Two runs of a stream that loads each key once, then the rows that were too late for it.

    The second run starts anew from the checkpoint and gets all events again, late ones among them. Some events
    have no id, some no time, some come twice.
    """
    events = load(spark, sf_dir, "events").select("event_id", "ts")
    late = (F.col("event_id") % 7 == 0) | (F.col("ts") >= P.wall_time("2024-01-15 00:00:00"))
    rows = events.select(
        F.when(F.col("event_id") % 11 != 0, F.col("event_id")).alias("event_id"),
        F.when(F.col("event_id") % 13 != 0, F.col("ts")).alias("ts"),
        late.alias("late"),
    )
    rows = rows.unionAll(rows.where(F.col("event_id") % 17 == 0))
    names = "stream-landing", "stream-once", "stream-once-state"
    landing, path, checkpoint = (scratch_path(spark, n) for n in names)
    schema = events.schema
    for run, batch in enumerate((rows.where("not late"), rows)):
        batch.drop("late").write.parquet(os.path.join(landing, f"run={run}"))
        stream = incremental.read_files_stream(spark, os.path.join(landing, "run=*"), schema)
        incremental.stream_once(stream, path, checkpoint, "ts", "event_id").awaitTermination()
    incremental.load_late(rows.drop("late"), path, "ts", "event_id")
    loaded = keyed.KeyedTable(spark, path, "event_id").read(rows.drop("late").withColumn("fate", F.lit("")).schema)
    return loaded.withColumn("ts", F.when(F.col("event_id").isNotNull(), F.col("ts")))


@query
def json_payload(spark, sf_dir):
    report = cohorts.retention_cohorts(load(spark, sf_dir, "pickups"), ordered=False)
    return sinks.json_payload(report, "cohort_retention", ["cohort_month"])


@query
def redacted_text(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", S.redact("text", SECRETS).alias("text"))


@query
def net_payment_check(spark, sf_dir):
    bad = payments.negative_net_payments(_net(spark, sf_dir), -2000, exempt_years=(1997,))
    return quality.rows_check(bad, "net_payment_not_negative", "net_payment")
