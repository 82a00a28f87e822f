"""The service's tables, derived from the given tables.

Each text is plain SQL that Spark and DuckDB both accept. ``{name}`` is a given
table or another input of this module. Money is DECIMAL, so sums are exact.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

INPUTS: dict[str, str] = {}

INPUTS["payments"] = """
select o_orderkey * 2 + 2 as id, cast(0 as bigint) as parent_payment_id,
       case when o_orderkey % 9 = 0 then o_orderkey end as new_subscription_order_id,
       case when o_orderkey % 9 = 1 then o_orderkey end as old_subscription_order_id,
       o_orderkey as subscription_order_id, o_custkey as user_id,
       case when o_orderkey % 4 = 0 then null else o_orderkey end as wash_id,
       case when o_orderkey % 4 = 0 then o_orderkey end as receipt_order_id,
       0 as payment_type, cast(o_orderkey % 5 as int) as payment_reason_type, o_orderpriority as order_name,
       cast(o_totalprice as decimal(18,2)) as order_price, cast(o_totalprice as decimal(18,2)) as paid_price,
       cast((o_orderkey % 7) * 100 as decimal(18,2)) as point_price, cast(0 as decimal(18,2)) as coupon_price,
       cast(o_totalprice as decimal(18,2)) as total_paid_price,
       case when o_orderkey % 20 = 0 then 0 else 1 end as succeeded, 0 as cancelled,
       o_orderdate as approved_at, o_orderdate as created_at, cast(o_orderdate as date) as created_date
from {orders}
union all
select o_orderkey * 2 + 3, o_orderkey * 2 + 2,
       null, null, o_orderkey, o_custkey, null, null,
       cast(1 + o_orderkey % 2 as int), cast(o_orderkey % 5 as int), o_orderpriority,
       cast(o_totalprice as decimal(18,2)), cast(o_totalprice as decimal(18,2)),
       cast((o_orderkey % 11) * 100 as decimal(18,2)), cast(0 as decimal(18,2)),
       cast(o_totalprice as decimal(18,2)), 1, 1,
       o_orderdate + interval '3' day, o_orderdate + interval '3' day, cast(o_orderdate + interval '3' day as date)
from {orders} where o_orderstatus = 'F'
"""

# Approval times as texts with mixed offsets.
INPUTS["ledger_texts"] = """
select id, payment_type, paid_price, point_price,
       case when id % 3 = 0 then concat(cast(approved_at as varchar(40)), ' +0000')
            else concat(cast(approved_at as varchar(40)), ' +0900') end as approved_text
from {payments} where succeeded = 1
"""

INPUTS["pickups"] = """
select o_custkey as user_id, cast(o_orderdate as date) as wash_date from {orders} where o_orderstatus = 'F'
"""

INPUTS["store_orders"] = """
select l_orderkey as order_id, o_custkey as user_id,
       case when l_returnflag = 'R' then 'CANCELLED' else 'COMPLETED' end as order_status,
       cast(l_extendedprice as decimal(18,2)) as pay_amount,
       cast(case when l_returnflag = 'A' then l_extendedprice else 0 end as decimal(18,2)) as cancel_amount,
       cast(l_shipdate as date) as created_at
from {lineitem} join {orders} on l_orderkey = o_orderkey
"""

INPUTS["main_orders"] = """
select o_orderkey as order_id, o_custkey as user_id,
       case when o_orderkey % 24 = 0 then o_orderdate else o_orderdate + interval '10' hour end as created_at,
       case when o_orderstatus <> 'P' then 'PAID' when o_orderkey % 2 = 0 then 'CANCELLED'
            when o_orderkey % 3 = 0 then 'REFUNDED' else 'PAID' end as status,
       case when o_custkey % 10 = 0 then o_custkey end as external_channel_pgi,
       case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then true else false end as is_first_order
from {orders}
"""

INPUTS["memberships"] = """
select o_orderkey as order_id, cast(o_totalprice as decimal(18,2)) as membership_price
from {orders} where o_orderpriority = '1-URGENT'
"""

INPUTS["item_seed"] = """
select distinct p_name as item_name,
       case when p_name like '%widget' then 'bedding_count' when p_name like '%bolt' then 'shirt_count'
            else 'laundry_count' end as category
from {part} where p_name like '%widget' or p_name like '%bolt' or p_name like '%gear'
"""

INPUTS["plan_contents"] = """
select p_partkey as plan_id, p_name as name,
       case when p_type = 'LARGE' then p_size else 0 end as laundry_count,
       case when p_type in ('SMALL', 'LARGE') then p_size else 0 end as shirt_count,
       case when p_type = 'STANDARD' then p_size else 0 end as cleaning_count,
       case when p_type in ('PROMO', 'STANDARD') then p_size else 0 end as bedding_count,
       case when p_type = 'MEDIUM' then p_size else 0 end as launX_count,
       cast(p_retailprice as decimal(18,2)) as original_price,
       cast(p_retailprice as decimal(18,2)) - cast(p_size * 17 as decimal(18,2)) as discounted_price
from {part}
"""

INPUTS["plan_items"] = """
select cast(substr(p_brand, 7) as int) as plan_id,
       case p_type when 'PROMO' then 'bedding_count' when 'SMALL' then 'shirt_count'
                   when 'LARGE' then 'laundry_count' else 'cleaning_count' end as subtract_category,
       max(cast(p_retailprice as decimal(18,2))) as unit_price, min(p_size) as delivery_times
from {part} group by 1, 2
"""

INPUTS["wash_items"] = """
select l_orderkey as wash_id, o_custkey as user_id, l_linenumber as status,
       case when l_linestatus = 'O' then null else cast(substr(p_brand, 7) as int) end as plan_id,
       case when p_size = 7 then '세탁불가 부속품' else p_name end as item_name,
       case when l_returnflag = 'N' then 'SUBTRACT' when l_returnflag = 'R' then 'NONE' end as subtract_type,
       cast(l_quantity as bigint) as qty,
       case when l_suppkey % 10 = 0 then l_suppkey end as channel_pgi,
       cast(l_extendedprice as decimal(18,2)) as total_price,
       cast(case when l_discount > 0.08 then -l_extendedprice else l_extendedprice end as decimal(18,2))
           as service_total_price,
       cast(l_shipdate as date) as created_date
from {lineitem} join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey
"""

# Orders per customer and day: a hot customer is a few thousand rows in later joins.
INPUTS["customer_days"] = """
select o_custkey, o_orderstatus, cast(o_orderdate as date) as ds, count(*) as orders_made,
       sum(cast(o_totalprice as decimal(18,2))) as amount
from {orders} group by 1, 2, 3
"""

INPUTS["weather"] = """
select ds, r_name as region, cast(sum(amount) as double) / cast(10000 * sum(orders_made) as double) as temp
from {customer_days} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
join {region} on n_regionkey = r_regionkey group by 1, 2
"""

INPUTS["volume"] = """
select o_orderstatus as series_id, cast(o_orderdate as date) as ds, cast(count(*) as double) as y
from {orders} group by 1, 2
"""

INPUTS["region_volume"] = """
select concat(o_orderstatus, '/', r_name) as series_id, ds, cast(sum(orders_made) as double) as y
from {customer_days} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
join {region} on n_regionkey = r_regionkey group by 1, 2
"""

# Two plans side by side, one column each, as a warehouse report gives them; NULL on days without orders.
INPUTS["wide_volume"] = """
select cast(o_orderdate as date) as base_date,
       cast(nullif(sum(case when o_orderstatus = 'O' then 1 else 0 end), 0) as double) as a,
       cast(nullif(sum(case when o_orderstatus = 'F' then 1 else 0 end), 0) as double) as b
from {orders} group by 1
"""

# A stand-in for predictions: the value of seven days ago.
INPUTS["week_ago"] = """
select series_id, cast(ds + interval '7' day as date) as ds, y - 2.0 as yhat, y - 3.75 as yhat_lower,
       y + 1.75 as yhat_upper
from {volume}
"""

# The same stand-in, made one, two and three weeks ahead.
INPUTS["dated_predictions"] = """
select series_id, ds, cast(ds - interval '7' day as date) as as_of_date, y + 1.0 as yhat from {volume}
union all
select series_id, ds, cast(ds - interval '14' day as date), y + 2.0 from {volume}
union all
select series_id, ds, cast(ds - interval '21' day as date), y + 3.0 from {volume}
"""

INPUTS["members"] = """
select c_custkey as id, c_name as user_name,
       case when c_acctbal < 0 then cast('2000-06-01' as timestamp) end as deleted_at
from {customer}
"""

INPUTS["personal_payments"] = """
select o_orderkey as id, o_custkey as user_id, cast(o_totalprice as decimal(18,2)) as paid_price,
       o_orderdate as created_at,
       case when o_orderkey % 50 = 0 then null when o_orderkey % 51 = 0 then '탈퇴회원'
            else concat('user', cast(o_custkey as varchar(20))) end as user_name,
       concat('u', cast(o_custkey as varchar(20)), '@x.test') as user_email,
       concat('010', cast(o_custkey as varchar(20))) as user_phone_number
from {orders}
"""

INPUTS["forecast_rows"] = """
select case when user_id % 2 = 0 then '서울' else '부산' end as region,
       replace(substr(cast(ts as varchar(40)), 1, 10), '-', '') as fcst_date,
       concat(substr(cast(ts as varchar(40)), 12, 2), '00') as fcst_time,
       case event_id % 10 when 0 then 'TMP' when 1 then 'TMN' when 2 then 'TMX' when 3 then 'POP' when 4 then 'PTY'
            when 5 then 'PCP' when 6 then 'SNO' when 7 then 'REH' when 8 then 'WSD' else 'SKY' end as category,
       case event_id % 10
            when 0 then cast(value as varchar(40)) when 8 then cast(value as varchar(40))
            when 1 then case when value < 10 then '' else cast(value as varchar(40)) end
            when 2 then case when value < 10 then '-' else cast(value as varchar(40)) end
            when 3 then case when value < 5 then 'missing' else cast(cast(floor(value) as int) as varchar(10)) end
            when 7 then cast(cast(floor(value) as int) as varchar(10))
            when 5 then case when value < 30 then '강수없음' else concat(cast(value as varchar(40)), 'mm') end
            when 6 then case when value < 30 then '적설없음' else concat(cast(value as varchar(40)), 'cm') end
            else cast(cast(floor(value) as int) % 9 as varchar(10)) end as fcst_value,
       event_id as seq
from {events}
"""

INPUTS["observation_rows"] = """
select case when user_id % 2 = 0 then '서울' else '부산' end as region,
       date_trunc('hour', ts) as observed_at,
       case event_id % 5 when 0 then 'T1H' when 1 then 'RN1' when 2 then 'PTY' when 3 then 'REH' else 'WSD' end
           as category,
       case when event_id % 5 = 2 then cast(cast(floor(value) as int) % 9 as varchar(10))
            else cast(value as varchar(40)) end as obsr_value,
       event_id as seq
from {events}
"""

INPUTS["activity"] = """
select o_custkey as user_id, cast(o_orderdate as date) as day, cast(o_totalprice as decimal(18,2)) as amount,
       cast(o_totalprice as decimal(18,2)) as paid_price
from {orders}
"""

INPUTS["coupon_uses"] = """
select o_custkey as user_id from {orders} where o_orderpriority = '2-HIGH'
"""

# Per-k scores made of the data, one row per number of clusters.
INPUTS["k_scores"] = """
select cast(10 + o_custkey % 16 as int) as k, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as aic
from {orders} group by 1
"""

INPUTS["user_buckets"] = """
select o_custkey as user_id, cast(case when o_custkey % 10 < 6 then 0 else o_custkey % 10 end as int) as classification
from {orders} group by 1
"""

# Row counts per daily run and target.
INPUTS["runs"] = """
select event_type as target, cast(ts as date) as run_ts, count(*) as row_count from {events} group by 1, 2
"""

# Holidays of every year.
HOLIDAYS = ("01-01", "12-25")


def names_in(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"{(\w+)}", text)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def load(spark: SparkSession, sf_dir: str, name: str, **ready: DataFrame) -> DataFrame:
    """A given table or a derived input as a lazy DataFrame.

    ``ready`` holds inputs that are already there and need not be derived again.
    """
    if name in ready:
        return ready[name]
    if name in TABLES:
        return table(spark, sf_dir, name)
    text = INPUTS[name]
    return spark.sql(text, **{n: load(spark, sf_dir, n, **ready) for n in names_in(text)})


def with_inputs(body: str) -> str:
    """DuckDB text: the inputs that ``body`` names as ``{input}``, as common table expressions."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in names_in(text):
            if name in TABLES or name in order:
                continue
            visit(INPUTS[name])
            order.append(name)

    visit(body)
    plain: Callable[[str], str] = lambda text: re.sub(r"{(\w+)}", r"\1", text).strip()
    parts = [f"{name} as (\n{plain(INPUTS[name])}\n)" for name in order]
    text = plain(body)
    if not parts:
        return text
    if text[:5].lower() == "with ":
        return "with " + ",\n".join(parts) + ",\n" + text[5:]
    return "with " + ",\n".join(parts) + "\n" + text
