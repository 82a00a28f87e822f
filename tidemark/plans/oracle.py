"""The same results in plain SQL, for comparison with DuckDB."""

from __future__ import annotations

from tidemark.plans.inputs import HOLIDAYS, with_inputs

SQL: dict[str, str] = {}

_STAGED = """
select id as payment_id, parent_payment_id, new_subscription_order_id, old_subscription_order_id,
       subscription_order_id, user_id, wash_id, receipt_order_id, payment_type, payment_reason_type, order_name,
       order_price, paid_price, point_price, coupon_price, total_paid_price, succeeded, cancelled, approved_at,
       created_at, created_date
from {payments} where succeeded = 1
"""
_NET = f"""
select *, gross_paid_price + gross_point_price - cancelled_price - cancelled_point_price as net_paid_price from (
  select case when parent_payment_id = 0 then payment_id else parent_payment_id end as original_payment_id, user_id,
         min(created_date) as created_date, min(approved_at) as approved_at,
         coalesce(sum(paid_price) filter (where payment_type = 0), 0) as gross_paid_price,
         coalesce(sum(point_price) filter (where payment_type = 0), 0) as gross_point_price,
         coalesce(sum(paid_price) filter (where payment_type in (1, 2)), 0) as cancelled_price,
         coalesce(sum(point_price) filter (where payment_type in (1, 2)), 0) as cancelled_point_price
  from ({_STAGED}) s group by 1, 2) g
"""

SQL["stg_payment"] = f"""
select * replace (cast(order_price as double) as order_price, cast(paid_price as double) as paid_price,
  cast(point_price as double) as point_price, cast(coupon_price as double) as coupon_price,
  cast(total_paid_price as double) as total_paid_price) from ({_STAGED}) s
"""
SQL["net_payment"] = f"""
select original_payment_id, user_id, created_date, approved_at,
       cast(gross_paid_price as double) as gross_paid_price, cast(gross_point_price as double) as gross_point_price,
       cast(cancelled_price as double) as cancelled_price,
       cast(cancelled_point_price as double) as cancelled_point_price, cast(net_paid_price as double) as net_paid_price
from ({_NET}) n
"""
SQL["net_payment_violations"] = f"""
select user_id, created_date, cast(gross_paid_price as double) as gross_paid_price,
       cast(cancelled_price as double) as cancelled_price, cast(net_paid_price as double) as net_paid_price
from ({_NET}) n
where net_paid_price < 0 and extract(year from created_date) <> 1997 and net_paid_price <= -2000
  and not (gross_paid_price = 0 and cancelled_price = 0 and cancelled_point_price = 0)
"""
_NEGATIVE = f"""
select * from ({_NET}) n where net_paid_price < 0
  and not (gross_paid_price = 0 and cancelled_price = 0 and cancelled_point_price = 0)
"""
SQL["net_payment_violations_by_year"] = f"""
select cast(extract(year from created_date) as int) as year, count(*) as violations from ({_NEGATIVE}) v group by 1
"""
SQL["net_payment_worst"] = f"""
select original_payment_id, user_id, cast(net_paid_price as double) as net_paid_price from ({_NEGATIVE}) v
order by v.net_paid_price, original_payment_id, user_id limit 5
"""
SQL["payment_signed_self_join"] = """
select p.id, p.user_id, p.payment_type,
       cast(case when p.payment_type = 0 then p.point_price else -p.point_price end as double) as signed_point_price,
       nullif(p.parent_payment_id, 0) as parent_id, o.id as original_id,
       cast(o.paid_price as double) as original_paid_price
from {payments} p left join {payments} o on p.parent_payment_id = o.id where p.succeeded = 1
"""
_PARITY = """
select month, model_value, reference_value,
       abs(model_value - reference_value) / abs(reference_value) as relative_error,
       coalesce(abs(model_value - reference_value) / abs(reference_value) <= 0.0011, false) as within_tolerance
from (
  select strftime(cast(substr(approved_text, 1, 19) as timestamp)
                  + case when approved_text like '% +0000' then interval '9' hour else interval '0' hour end, '%Y-%m')
           as month,
         cast(sum(case when payment_type = 0 then paid_price + point_price else -(paid_price + point_price) end)
              as double) as model_value,
         cast(sum(case when payment_type = 0 then paid_price else -paid_price end) as double) as reference_value
  from {ledger_texts} group by 1) m
"""
SQL["monthly_parity"] = _PARITY


def _verdicts(check: str, target: str, severity: str, failures: str) -> str:
    return f"""select check_name as "check", target, case when failures > 0 then severity else 'pass' end as status,
  failures, severity, concat(check_name, ' on ', target, ': ', cast(failures as varchar), ' failing') as message
from (select '{check}' as check_name, '{target}' as target, '{severity}' as severity,
             cast(({failures}) as bigint) as failures) q"""


SQL["net_payment_check"] = _verdicts(
    "net_payment_not_negative", "net_payment", "error", f"select count(*) from ({SQL['net_payment_violations']}) v"
)
SQL["parity_status"] = _verdicts(
    "parity", "net_payment", "error", f"select count(*) from ({_PARITY}) p where not within_tolerance"
)
_COHORTS = """
with days as (select user_id, list(distinct wash_date) as washed, min(wash_date) as began from {pickups} group by user_id),
periods as (select strftime(began, '%Y-%m') as cohort_month,
                   list_transform(washed, lambda d: floor((d - began) / 30.5)) as numbers from days)
select cohort_month, count(*) as user_count, count(*) filter (where list_contains(numbers, 0)) as ret_0,
       count(*) filter (where list_contains(numbers, 1)) as ret_1
from periods group by cohort_month
"""
SQL["cohort_retention"] = _COHORTS
SQL["first_pickups"] = "select user_id, min(wash_date) as first_wash_date from {pickups} group by 1"


def _report(end_condition: str, names: tuple[str, ...]) -> str:
    day, order, user, member, store, first = names
    bought = """(select sum(pay_amount) - sum(cancel_amount) from {store_orders} x
       where x.order_id = main.order_id and x.user_id is not null and x.order_status = 'COMPLETED'
         and date_trunc('day', x.created_at) >= date '1997-03-01' and date_trunc('day', x.created_at) <= date '1997-08-31')"""
    return f"""
select day as "{day}", order_id as "{order}", user_id as "{user}", coalesce(price, '정기결제 차감') as "{member}",
       case when spent > 0 then spent::double else 0.0 end as "{store}",
       ['기존이용', '첫이용'][1 + coalesce(is_first_order, false)::int] as "{first}"
from (
  select created_at::date as day, order_id, user_id, is_first_order, {bought} as spent,
         (select membership_price::varchar from {{memberships}} y where y.order_id = main.order_id) as price
  from {{main_orders}} main
  where external_channel_pgi is null and status <> 'CANCELLED' and status <> 'REFUNDED' and {end_condition}
) picked
"""


SQL["order_report"] = _report(
    "cast(main.created_at as date) between date '1997-03-01' and date '1997-08-31'",
    ("order_date", "order_id", "user_id", "membership_amount", "store_amount", "first_use"),
)
SQL["order_report_instants"] = _report(
    "main.created_at between timestamp '1997-03-01 00:00:00' and timestamp '1997-08-31 00:00:00'",
    ("주문 일자", "주문 번호", "고객 번호", "멤버십 이용 금액", "스토어 결제 금액", "첫 이용 여부"),
)

_BEDDING = """exists (select 1 from {wash_items} w where w.user_id = c_custkey and w.item_name like '%widget'
  and w.created_date between date '1997-03-01' and date '1997-08-31')"""
SQL["users_with_item"] = f"select c_custkey as user_id from {{customer}} where {_BEDDING}"
SQL["users_without_item"] = f"select c_custkey as user_id from {{customer}} where not {_BEDDING}"
SQL["buyers_average"] = """
select count(*) as users, cast(sum(days) as double) / count(*) as avg_days,
       cast(sum(paid) as double) / count(*) as avg_paid, cast(sum(pickups) as double) / count(*) as avg_pickups
from (select user_id, date_diff('day', min(day), max(day)) as days, sum(paid_price) as paid, count(*) as pickups
      from {activity} where user_id in (select user_id from {coupon_uses}) group by 1) u
"""
SQL["channel_signups"] = """
select strftime(ts, '%Y-%m') as month,
       case when cast(json_extract_string(props, '$.k') as int) < 50 then 'paid' else 'organic' end as channel_class,
       case event_type when 'signup' then 'sign_up' when 'purchase' then 'install' else 'removal' end as event,
       count(*) as events, cast(sum(cast(value as decimal(18,2))) as double) as total_value
from {events} where event_type in ('signup', 'purchase', 'error') group by 1, 2, 3
"""
_RFM = """
select user_id, cast(date_diff('day', max(day), date '2001-12-31') as int) as recency, count(*) as frequency,
       cast(sum(amount) as double) as monetary, cast(date_diff('day', min(day), max(day)) as int) as tenure,
       cast(max(amount) as double) as max_amount
from {activity} where day <= date '2001-12-31' group by 1
"""
SQL["rfm_features"] = _RFM

_CHECKS = [
    _verdicts(
        "unique(payment_id)",
        "stg_payment",
        "error",
        f"select count(*) from (select payment_id from ({_STAGED}) s where payment_id is not null group by 1 "
        "having count(*) > 1) d",
    ),
    _verdicts(
        "unique(l_orderkey,l_linenumber)",
        "lineitem",
        "warn",
        "select count(*) from (select l_orderkey, l_linenumber from {lineitem} group by 1, 2 having count(*) > 1) d",
    ),
    *[
        _verdicts(f"not_null({c})", "stg_payment", "error", f"select count(*) from ({_STAGED}) s where {c} is null")
        for c in ("payment_id", "payment_type", "user_id", "wash_id")
    ],
    *[
        _verdicts(
            f"accepted_values({c})",
            "stg_payment",
            "error",
            f"select count(*) from ({_STAGED}) s where {c} not in ({values})",
        )
        for c, values in (("payment_type", "0, 1, 2"), ("payment_reason_type", "0, 1, 2, 3"))
    ],
    *[
        _verdicts(
            f"relationships({c})",
            "stg_payment",
            severity,
            f"select count(*) from ({_STAGED}) s where {c} is not null and {c} not in (select {k} from {{{t}}})",
        )
        for c, k, t, severity in (
            ("user_id", "c_custkey", "customer", "warn"),
            ("wash_id", "l_orderkey", "lineitem", "error"),
        )
    ],
]
SQL["dq_generic"] = "\nunion all\n".join(_CHECKS)
SQL["dq_worst_status"] = (
    "select case max(case status when 'pass' then 0 when 'warn' then 1 else 2 end) when 0 then 'pass' "
    "when 1 then 'warn' else 'error' end as status, count(*) as checks, "
    f"count(*) filter (where status <> 'pass') as not_passed from ({SQL['dq_generic']}) r"
)
SQL["orphan_washes"] = f"""
select wash_id as key, count(*) as n from ({_STAGED}) s
where wash_id is not null and not exists (select 1 from {{lineitem}} where l_orderkey = wash_id) group by 1
"""
SQL["dq_freshness"] = "\nunion all\n".join(
    f"""select 'freshness(created_at)' as "check", 'payments@{day}' as target, status,
  cast(case when status = 'pass' then 0 else 1 end as bigint) as failures,
  case when status = 'pass' then 'error' else status end as severity,
  concat('freshness on payments@{day}: ', cast(hours as varchar), ' hours old') as message
from (select hours, case when seconds > 48 * 3600 then 'error' when seconds > 24 * 3600 then 'warn' else 'pass' end
        as status
      from (select date_diff('second', max(created_at), timestamp '{day} 00:00:00') as seconds,
                   cast(floor(date_diff('second', max(created_at), timestamp '{day} 00:00:00') / 3600) as bigint)
                     as hours from {{payments}}) a) b"""
    for day in ("2001-08-05", "2001-08-06", "2001-08-09")
)
SQL["service_amount_check"] = """
select wash_id, user_id, subtract_type, cast(total_price as double) as total_price,
       cast(service_total_price as double) as service_total_price
from (select wash_id, user_id, subtract_type, sum(total_price) as total_price,
             sum(service_total_price) as service_total_price from {wash_items} group by 1, 2, 3) s
where service_total_price < 0 and subtract_type <> 'NONE'
"""
SQL["dq_run_summary"] = f"""
select 'cohorts' as target, 'ok' as status, (select count(*) from ({_COHORTS}) c) as row_count, 'ok' as message
union all
select 'net_payments', case when bad > 0 then 'anomaly' else 'ok' end, n,
       case when bad > 0 then 'key metric at or below zero' else 'ok' end
from (select count(*) as n, count(*) filter (where net_paid_price <= 0) as bad from ({_NET}) x) y
union all select 'empty', 'anomaly', 0, 'no rows'
union all select 'regions', 'anomaly', (select count(*) from {{region}}), 'fewer rows than expected'
union all select 'broken', 'failed', null, 'RuntimeError: source is not reachable'
"""
SQL["volume_spikes"] = """
select series_id, ds, y, round(recent_mean, 6) as recent_mean, round(y / nullif(recent_mean, 0), 6) as ratio
from (select *, avg(y) over (partition by series_id order by ds rows between 14 preceding and 1 preceding)
        as recent_mean from {volume}) s
where (recent_mean = 0 and y > 0) or (recent_mean <> 0 and y / recent_mean >= 2.0)
"""
SQL["row_count_drops"] = """
select target, run_ts, row_count, previous,
       round((previous - row_count) / cast(previous as double), 6) as drop_share
from (select *, lag(row_count) over (partition by target order by run_ts) as previous from {runs}) s
where (previous - row_count) / cast(previous as double) >= 0.1
"""

_ITEMS = """
select w.*, coalesce(s.category, 'cleaning_count') as subtract_category
from {wash_items} w left join {item_seed} s on w.item_name = s.item_name
"""
_VALID = "status not in (4, 17) and channel_pgi is null and item_name <> '세탁불가 부속품'"
SQL["item_categories"] = f"""
select subtract_category, {_VALID} as valid,
       cast(sum(case when subtract_type = 'SUBTRACT' then qty else 0 end) as bigint) as deducted,
       cast(sum(qty) as bigint) as qty
from ({_ITEMS}) i group by 1, 2
"""
SQL["valid_pickups"] = """
select status, count(*) as items from {wash_items} where status not in (4, 17) and channel_pgi is null group by 1
"""
_PRICED = f"""
select i.*, p.unit_price, p.delivery_times, case when subtract_type = 'SUBTRACT' then qty else 0 end as cnt
from ({_ITEMS}) i left join {{plan_items}} p
  on i.plan_id = p.plan_id and i.subtract_category = p.subtract_category
where {_VALID}
"""
SQL["item_revenue"] = f"""
select subtract_category as category, cast(date_trunc('month', created_date) as date) as washed_on_month,
       cast(sum(qty) as bigint) as pieces, cast(sum(cnt) as bigint) as counted_pieces,
       cast(sum(cnt * unit_price) as double) as washed_value
from ({_PRICED}) x where created_date >= date '1996-01-01' group by 1, 2
"""
SQL["item_revenue_by_delivery"] = f"""
select delivery_times as trips, cast(sum(cnt) as bigint) as counted_pieces,
       cast(sum(cnt * unit_price) as double) as washed_value from ({_PRICED}) x group by 1
"""
SQL["item_revenue_by_region"] = f"""
select delivery_times as trips, c_mktsegment as trade, r_name as region_name,
       cast(date_trunc('year', created_date) as date) as washed_on_year, cast(sum(qty) as bigint) as pieces,
       cast(sum(cnt * unit_price) as double) as washed_value
from ({_PRICED}) x left join {{customer}} on user_id = c_custkey left join {{nation}} on c_nationkey = n_nationkey
left join {{region}} on n_regionkey = r_regionkey group by 1, 2, 3, 4
"""
SQL["item_revenue_by_day"] = f"""
select cast(created_date as date) as washed_on_day, cast(sum(qty) as bigint) as pieces,
       cast(sum(cnt * unit_price) as double) as washed_value from ({_PRICED}) x group by 1
"""
SQL["item_revenue_by_grain"] = " union all ".join(
    f"select '{g}' as grain, cast(date_trunc('{g}', created_date) as date) as starts, cast(sum(qty) as bigint) as pieces"
    f" from ({_ITEMS}) i where {_VALID} group by 1, 2"
    for g in ("day", "week", "month", "quarter", "year")
)
SQL["item_quantity_total"] = f"select cast(sum(qty) as bigint) as pieces from ({_ITEMS}) i where {_VALID}"
SQL["plan_key_check"] = _verdicts(
    "unique(plan_id,subtract_category)",
    "plan_item",
    "error",
    "select count(*) from (select plan_id, subtract_category from {plan_items} group by 1, 2 having count(*) > 1) d",
)
SQL["plan_unit_price"] = """
select plan_id,
       case when laundry_count <> 0 then 'laundry_count' when shirt_count <> 0 then 'shirt_count'
            when cleaning_count <> 0 then 'cleaning_count' when bedding_count <> 0 then 'bedding_count'
            when launX_count <> 0 then 'launX_count' end as subtract_category,
       cast(case when 2 * discounted_price < original_price then original_price - discounted_price
                 else discounted_price end as double) as unit_price
from {plan_contents}
"""

_GONE = "user_id in (select id from {members} where deleted_at is not null)"
SQL["transfer_withdrawn"] = f"""
select id, user_id, cast(paid_price as double) as paid_price, created_at, user_name, user_email, user_phone_number
from {{personal_payments}}
where {_GONE} and created_at >= timestamp '1996-08-01 00:00:00' and created_at < timestamp '1999-01-01 00:00:00'
"""
SQL["transfer_twice"] = f"""
select case when id % 97 <> 0 then id end as id, user_id, cast(paid_price as double) as paid_price, created_at,
       cast(case when created_at < timestamp '1999-01-01' then 1 else 3 end as int) as run
from {{personal_payments}}
where {_GONE} and created_at >= timestamp '1996-08-01 00:00:00'
qualify id % 97 <> 0 or row_number() over (partition by id % 97 order by created_at, user_id, paid_price) = 1
"""
SQL["stream_transfers"] = f"""
select id, user_id, cast(paid_price as double) as paid_price, created_at
from {{personal_payments}} where {_GONE} and created_at >= timestamp '1996-08-01 00:00:00'
"""
_OLD = "created_at < timestamp '1996-08-01 00:00:00'"
_UNMASKED = "user_name is distinct from '탈퇴회원'"


def _masked(source: str, due: str) -> str:
    return f"""
select id, user_id, cast(paid_price as double) as paid_price, created_at,
       case when {due} then '탈퇴회원' else user_name end as user_name,
       case when {due} then sha256(concat(cast(id as varchar), 'retention')) else user_email end as user_email,
       case when {due} then '01000000000' else user_phone_number end as user_phone_number
from {source}
"""


SQL["mask_expired"] = _masked("{personal_payments}", f"({_OLD} and {_UNMASKED} and {_GONE})")
SQL["mask_store"] = _masked(
    f"(select * from {{personal_payments}} where {_GONE} and created_at >= timestamp '1994-08-01 00:00:00') t",
    f"({_OLD} and {_UNMASKED})",
)
SQL["mask_preflight"] = f"""
select 'transfer' as step, count(*) as affected from {{personal_payments}}
  where {_GONE} and created_at >= timestamp '1996-08-01 00:00:00'
union all select 'mask_main', count(*) from {{personal_payments}} where {_GONE} and {_OLD} and {_UNMASKED}
union all select 'mask_main_parity', count(*) from {{personal_payments}}
  where {_GONE} and {_OLD} and user_name <> '탈퇴회원'
union all select 'mask_by_age', count(*) from {{personal_payments}} where {_OLD} and {_UNMASKED}
"""

SQL["weather_json_rows"] = """
select ds, region, case when extract(day from ds) = 13 then null else temp end as avg_temp,
       case when extract(day from ds) % 3 = 0 then 0.0 else cast(extract(day from ds) as double) end as rain_total,
       cast(case when extract(day from ds) % 2 = 0 then 0.0 else 1.5 end as double) as rain_max_1h
from {weather}
"""
SQL["landed_weather"] = SQL["weather_json_rows"]
SQL["weather_json_quarantine"] = """
select case region when 'AFRICA' then '108' when 'AMERICA' then '112' when 'ASIA' then '119' when 'EUROPE' then '98'
                   else '159' end as station_id,
       month, case when month like '%-11' then 'not_json' else 'error_code' end as status,
       case when month like '%-11' then concat('<error><month>', month, '</month></error>') else '99: LIMIT' end
         as detail,
       case when month like '%-11' then concat('<error><month>', month, '</month></error>')
            else '{"response":{"header":{"resultCode":"99","resultMsg":"LIMIT"}}}' end as raw
from (select distinct region, strftime(ds, '%Y-%m') as month from {weather}
      where extract(month from ds) in (7, 11)) m
"""

_CATEGORIES = ("TMP", "TMN", "TMX", "POP", "PTY", "PCP", "SNO", "REH", "WSD", "SKY")
_LAST = """
select region, fcst_date, fcst_time, category, fcst_value from (
  select *, row_number() over (partition by region, fcst_date, fcst_time, category order by seq desc) as rn
  from {forecast_rows}) r where rn = 1
"""
_WIDE = (
    "select region, strptime(concat(fcst_date, fcst_time), '%Y%m%d%H%M') as slot, "
    + ", ".join(f'max(case when category = \'{c}\' then fcst_value end) as "{c}"' for c in _CATEGORIES)
    + f" from ({_LAST}) l group by 1, 2"
)
SQL["forecast_slots_wide"] = _WIDE


def _decode(column: str, codes: dict[str, str]) -> str:
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in codes.items())
    return f'case "{column}" {arms} else "{column}" end'


# The feed's code tables, stated again so that SQL is checked against them.
_PTY = {
    "0": "없음",
    "1": "비",
    "2": "비/눈",
    "3": "눈",
    "4": "소나기",
    "5": "빗방울",
    "6": "빗방울눈날림",
    "7": "눈날림",
}
_SKY = {"1": "맑음", "3": "구름많음", "4": "흐림"}
SQL["hourly_forecast"] = f"""
select region, '2024-01-15 08:00' as issued_at, strftime(slot, '%m-%d %H:%M') as time, try_cast("TMP" as double) as temperature_c,
       try_cast("POP" as double) as precip_prob_pct, {_decode("PTY", _PTY)} as precip_type, "PCP" as precip_mm,
       "SNO" as snow_cm, try_cast("REH" as double) as humidity_pct, try_cast("WSD" as double) as wind_speed_ms,
       {_decode("SKY", _SKY)} as sky
from (select *, row_number() over (partition by region order by slot) as rn from ({_WIDE}) w
      where slot >= timestamp '2024-01-15 10:00:00') u where rn <= 48
"""
SQL["forecast_daily"] = """
with numbered as (select region, cast(strptime(fcst_date, '%Y%m%d') as date) as date, category,
    try_cast(fcst_value as double) as v,
    row_number() over (partition by region, fcst_date, category order by seq desc) as rn from {forecast_rows}),
days as (select region, date,
    max(case when category = 'TMN' and rn = 1 then v end) as low,
    max(case when category = 'TMX' and rn = 1 then v end) as high,
    min(case when category = 'TMP' then v end) as tmp_min, max(case when category = 'TMP' then v end) as tmp_max,
    max(case when category = 'POP' then v end) as pop, avg(case when category = 'REH' then v end) as reh
    from numbered group by 1, 2)
select region, '2024-01-15 08:00' as issued_at, date, coalesce(low, tmp_min) as temp_min_c, coalesce(high, tmp_max) as temp_max_c,
       low is null or high is null as temp_from_hourly, pop as precip_prob_max_pct,
       cast(round_even(reh, 0) as bigint) as humidity_avg_pct
from days
"""
SQL["current_weather"] = f"""
select region, strftime(observed_at, '%Y-%m-%d %H:%M') as observed_at, try_cast("T1H" as double) as temperature_c,
       try_cast("RN1" as double) as precip_1h_mm, {_decode("PTY", _PTY)} as precip_type,
       try_cast("REH" as double) as humidity_pct, try_cast("WSD" as double) as wind_speed_ms
from (select region, observed_at,
        {", ".join(f"max(case when category = '{c}' then obsr_value end) as {chr(34)}{c}{chr(34)}"
                   for c in ("T1H", "RN1", "PTY", "REH", "WSD"))}
      from (select *, row_number() over (partition by region, observed_at, category order by seq desc) as rn
            from {{observation_rows}}) r where rn = 1 group by 1, 2) w
"""
SQL["issue_times"] = """
select event_id, date_trunc('hour', ts - interval '45' minute) as observation_issue,
       (select max(i) from (select cast(cast(ts - interval '15' minute as date) as timestamp) + h * interval '1' hour as i
          from unnest([-1, 2, 5, 8, 11, 14, 17, 20, 23]) as u(h)) c where i <= ts - interval '15' minute)
         as forecast_issue,
       date_trunc('hour', ts + interval '9' hour - interval '45' minute) as kst_observation_issue
from {events}
"""

SQL["temp_triggers"] = """
with days as (select distinct ds from {weather}),
grid as (select d.ds, r.region, w.temp from days d cross join (select distinct region from {weather}) r
         left join {weather} w on w.ds = d.ds and w.region = r.region),
change as (select ds, abs(temp - lag(temp, 7) over (partition by region order by ds)) as c from grid)
select ds, case when count(*) filter (where c >= 1) >= 2 then 1 else 0 end as temp_trigger_1deg,
       case when count(*) filter (where c >= 2) >= 2 then 1 else 0 end as temp_trigger_2deg,
       case when count(*) filter (where c >= 3) >= 2 then 1 else 0 end as temp_trigger_3deg
from change group by 1
"""
SQL["training_days"] = f"""
select series_id, v.ds, y, temp_trigger_1deg, temp_trigger_2deg, temp_trigger_3deg
from {{volume}} v join ({SQL["temp_triggers"].replace("{weather}", "(select * from {weather} where extract(day from ds) % 2 = 1)")}) t
  on v.ds = t.ds
"""
SQL["days_with_triggers"] = f"""
with early as (select * from {{volume}} where ds < date '1997-07-01'),
days as (select series_id, ds from early union all
         select series_id, cast(last + n as date) from (select series_id, max(ds) as last from early group by 1) l,
                (select cast(unnest(range(1, 61)) as int) as n) u)
select series_id, d.ds, coalesce(temp_trigger_1deg, 0) as temp_trigger_1deg,
       coalesce(temp_trigger_2deg, 0) as temp_trigger_2deg, coalesce(temp_trigger_3deg, 0) as temp_trigger_3deg
from days d left join ({SQL["temp_triggers"]}) t on d.ds = t.ds and extract(day from t.ds) <> 1
"""
SQL["temperature_days"] = """
select region, ds, temp, false as ahead from {weather}
union all
select region, cast(last + n as date), null, true
from (select region, max(ds) as last from {weather} group by 1) l, (select cast(unnest(range(1, 61)) as int) as n) u
"""
SQL["frozen_dates"] = """
select series_id, ds, as_of_date, yhat + case when as_of_date = date '1998-01-12' then 0.5 else 0.0 end as yhat
from {dated_predictions} where as_of_date in (date '1998-01-05', date '1998-01-12')
"""
SQL["dashboard_gaps"] = """
select cast(last + n as date) as day, false as off_yhat, false as off_lower, false as off_upper
from (select max(last) as last, min(last) as first from (select max(ds) as last from {region_volume} group by series_id) e) l,
     (select cast(unnest(range(1, 61)) as int) as n) u
where last + n <= first + 60
"""
_HOLIDAY_DATES = ", ".join(f"'{d}'" for d in HOLIDAYS)
SQL["holiday_window"] = f"""
select series_id, ds, y,
       case when strftime(ds + 1, '%m-%d') in ({_HOLIDAY_DATES}) then 1 else 0 end as holiday_0,
       case when strftime(ds, '%m-%d') in ({_HOLIDAY_DATES}) then 1 else 0 end as holiday_1,
       case when strftime(ds - 1, '%m-%d') in ({_HOLIDAY_DATES}) then 1 else 0 end as holiday_2
from {{volume}}
"""
SQL["trend_forecast"] = """
with s as (select series_id, min(ds) as began, max(ds) as ended, greatest(max(ds) - min(ds), 1) as span,
                  coalesce(nullif(max(abs(y)), 0), 1.0) as peak from {volume} group by 1),
g as (select v.series_id, count(*) + 0.0004 as a, sum((ds - began) / cast(span as double)) as b,
             sum(((ds - began) / cast(span as double)) ** 2) + 0.0004 as c, sum(y / peak) as p,
             sum((ds - began) / cast(span as double) * (y / peak)) as q
      from {volume} v join s on v.series_id = s.series_id group by 1),
days as (select series_id, ds from {volume} union all
         select series_id, cast(ended + n as date) from s, (select cast(unnest(range(1, 61)) as int) as n) u)
select d.series_id, d.ds,
       round(peak * ((c * p - b * q) + (a * q - b * p) * ((d.ds - began) / cast(span as double))) / (a * c - b * b), 6) as yhat
from days d join s on d.series_id = s.series_id join g on d.series_id = g.series_id
"""
SQL["forecast_backtest"] = """
with e as (select series_id, min(ds) as began, max(ds) as ended, greatest(max(ds) - min(ds), 1) as span from {volume} group by 1),
s as (select e.series_id, began, ended, span, coalesce(nullif(max(case when ds <= ended - 240 then abs(y) end), 0), 1.0) as peak
      from e join {volume} v on v.series_id = e.series_id group by 1, 2, 3, 4),
c as (select s.*, cast(ended - 60 * fold as date) as cutoff from s, (select cast(unnest(range(1, 5)) as int) as fold) f),
r as (select c.series_id, cutoff, ds, y, peak, (ds - began) / cast(span as double) as t, ds <= cutoff as past
      from c join {volume} v on v.series_id = c.series_id where ds <= cutoff + 60),
g as (select series_id, cutoff, count(*) + 0.0004 as a, sum(t) as b, sum(t * t) + 0.0004 as c, sum(y / peak) as p,
             sum(t * (y / peak)) as q from r where past group by 1, 2),
h as (select r.series_id, r.cutoff, y - peak * ((c * p - b * q) + (a * q - b * p) * t) / (a * c - b * b) as miss
      from r join g on r.series_id = g.series_id and r.cutoff = g.cutoff where not past)
select series_id, cutoff, count(*) as days, round(avg(abs(miss)), 6) as mae, round(sqrt(avg(miss * miss)), 6) as rmse
from h group by 1, 2
"""
SQL["actual_over_forecast"] = """
select coalesce(a.series_id, f.series_id) as region, coalesce(a.ds, f.ds) as ds, coalesce(a.y, f.yhat) as temp
from {volume} a full join {week_ago} f on a.series_id = f.series_id and a.ds = f.ds
"""
SQL["horizon_days"] = """
select series_id, ds from {volume}
union all
select series_id, cast(last + n as date) as ds
from (select series_id, max(ds) as last from {volume} group by 1) l, (select cast(unnest(range(1, 61)) as int) as n) u
"""
SQL["forecast_totals"] = """
select ds as day, concat(cast(extract(year from ds) as varchar), '. ', cast(extract(month from ds) as varchar), '. ',
                         cast(extract(day from ds) as varchar)) as ds,
       cast(trunc(sum(yhat)) as int) as total_yhat, cast(trunc(sum(yhat_lower)) as int) as total_lower,
       cast(trunc(sum(yhat_upper)) as int) as total_upper
from (select *, row_number() over (partition by series_id order by ds desc) as rn from {week_ago}) w
where rn <= 60 group by w.ds having count(*) = (select count(distinct series_id) from {week_ago})
"""
SQL["plan_series"] = """
select base_date as ds, 'plan_a' as series_id, a as y from {wide_volume} where a is not null
union all select base_date, 'plan_b', b from {wide_volume} where b is not null
"""
SQL["forecast_error"] = """
select v.series_id, round(avg(abs(v.y - w.yhat)), 6) as mae, count(*) as days
from {volume} v join {week_ago} w on v.series_id = w.series_id and v.ds = w.ds group by 1
"""
SQL["frozen_forecast"] = """
select series_id, ds, as_of_date, yhat from (
  select *, row_number() over (partition by series_id, ds order by as_of_date desc) as rn
  from {dated_predictions} where as_of_date <= date '2001-06-30') p where rn = 1
"""
SQL["forecast_checks"] = "\nunion all\n".join(
    [
        _verdicts(
            "missing_region",
            "weather",
            "error",
            "select count(*) from (select r_name from {region} union all select 'ANTARCTICA') e "
            "where r_name not in (select region from {weather})",
        ),
        _verdicts("negative_forecast", "forecast", "error", "select count(*) from {week_ago} where yhat < 0"),
        _verdicts(
            "forecast_jump",
            "forecast",
            "warn",
            "select count(*) from (select yhat, avg(yhat) over (partition by series_id order by ds rows between 14 "
            "preceding and 1 preceding) as m from {week_ago}) s where (m = 0 and yhat > 0) or (m <> 0 and yhat / m >= 2.0)",
        ),
    ]
)

_FEATURES = ("recency", "frequency", "monetary", "tenure", "max_amount")
SQL["robust_scaled"] = (
    "with logged as (select user_id, "
    + ", ".join(f"ln(1 + cast({c} as double)) as {c}" for c in _FEATURES)
    + f" from ({_RFM}) r), q as (select "
    + ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) as {c}" for c in _FEATURES)
    + " from logged) select user_id, "
    + ", ".join(f"round((logged.{c} - q.{c}[2]) / (q.{c}[3] - q.{c}[1]), 6) as {c}" for c in _FEATURES)
    + " from logged, q"
)
SQL["aic_elbow"] = """
select k, round(bend, 2) as second_difference from (
  select k, lead(aic) over (order by k) - 2 * aic + lag(aic) over (order by k) as bend from {k_scores}) s
where bend is not null order by bend desc, k limit 1
"""
SQL["cluster_means"] = f"""
select classification, members, round(r, 3) as avg_recency, round(f, 3) as avg_frequency, round(m, 3) as avg_monetary,
       round(t, 3) as avg_tenure, round(x, 3) as avg_max_amount,
       case when r <= 120 then 'active' when r <= 365 then 'at_risk' else 'dormant' end as "cluster 1",
       case when f >= 10 then 'subscription' when f >= 4 then 'swing' else 'pay_per_use' end as "cluster 2",
       case when m >= 2500000 then 'vvip' when t <= 180 then 'newcomer' else 'regular' end as "cluster 3"
from (select classification, count(*) as members, avg(recency) as r, avg(frequency) as f, avg(monetary) as m,
             avg(tenure) as t, avg(max_amount) as x
      from ({_RFM}) u join {{user_buckets}} b on u.user_id = b.user_id group by 1) s
"""
SQL["labelled_users"] = f"""
select u.*, b.classification, c."cluster 1", c."cluster 2", c."cluster 3"
from ({_RFM}) u join {{user_buckets}} b on u.user_id = b.user_id
join ({SQL["cluster_means"]}) c on c.classification = b.classification
"""
SQL["segment_invariants"] = f"""
select cast(count(*) as bigint) as members, true as enough_clusters, round(cast(sum(recency) as double), 0) as sum_recency,
       round(cast(sum(frequency) as double), 0) as sum_frequency, round(sum(monetary), 0) as sum_monetary,
       round(cast(sum(tenure) as double), 0) as sum_tenure, round(sum(max_amount), 0) as sum_max_amount,
       count(distinct user_id) as users, cast(0 as bigint) as unnamed
from ({_RFM}) u
"""
SQL["filled_features"] = f"""
select user_id, case when user_id % 5 = 0 then 0.0 else round(ln(1 + cast(recency as double)), 6) end as recency,
       case when user_id % 7 = 0 then 0.0 else round(ln(1 + cast(tenure as double)), 6) end as tenure,
       case when user_id % 11 = 0 then 0.0 else round(ln(1 + monetary), 6) end as monetary
from ({_RFM}) u
"""
SQL["cluster_shares"] = """
select classification, count(*) as members,
       round(count(*) / cast((select count(*) from {user_buckets}) as double), 6) as share
from {user_buckets} group by 1
"""
SQL["segment_checks"] = "\nunion all\n".join(
    [
        _verdicts(
            "user_drop",
            "segments",
            "warn",
            "select count(*) from (select row_count, lag(row_count) over (partition by target order by run_ts) as p "
            "from {runs}) s where (p - row_count) / cast(p as double) >= 0.1",
        ),
        _verdicts(
            "cluster_concentration",
            "segments",
            "warn",
            "select count(*) from (select classification from {user_buckets} group by 1 having count(*) >= 0.5 * "
            "(select count(*) from {user_buckets})) s",
        ),
        _verdicts("k_at_search_edge", "segments", "warn", f"select count(*) from ({SQL['aic_elbow']}) e where k <= 11 or k >= 24"),
    ]
)

SQL["incremental_events"] = "select * from {events}"
SQL["incremental_late"] = """
with e as (select case when event_id % 11 <> 0 then event_id end as event_id, ts from {events}),
first_load as (select * from e where ts < timestamp '2024-01-15' and coalesce(event_id % 7, 1) <> 0),
m as (select max(ts) - interval 3 day as edge from first_load),
unnamed as (select min(ts) as ts from first_load where event_id is null)
select event_id, ts, not (event_id % 7 = 0 and ts < edge) as loaded from e, m where event_id is not null
union all select null, ts, true from unnamed where ts is not null
union all
select null, min(e.ts), true from e, m, unnamed u where event_id is null and e.ts >= edge and (u.ts is null or u.ts < edge)
having count(*) > 0
"""
SQL["stream_events"] = "select * from {events}"
SQL["snapshot_swap"] = "select target, run_ts, row_count, row_count as stored from {runs}"
SQL["stream_late"] = """
with e as (select case when event_id % 11 <> 0 then event_id end as event_id, case when event_id % 13 <> 0 then ts end as ts,
                  event_id % 7 = 0 or ts >= timestamp '2024-01-15' as late from {events}),
m as (select max(ts) - interval 3 day as mark from e where not late)
select event_id, case when event_id is not null then ts end as ts,
       case when ts is null then 'undated' when late and ts <= mark then 'late' else 'timely' end as fate
from e, m
qualify event_id is not null or row_number() over (partition by event_id order by late, ts is null) = 1
"""
SQL["crm_snapshot"] = " union all ".join(
    f"select user_id, recency, frequency, monetary, date '{day}' as snapshot_date "
    f"from ({_RFM.replace('2001-12-31', day)}) u" for day in ("2000-12-31", "2001-12-31")
)
SQL["published_categories"] = """
select coalesce(category, 'cleaning_count') as subtract_category, count(*) as parts, cast(sum(p_size) as bigint) as sizes
from {part} left join {item_seed} on p_name = item_name group by 1
"""
SQL["json_payload"] = f"""
select 'cohort_retention' as target, cast(1 as int) as part, count(*) as row_count,
       concat('{{"target":"cohort_retention","data":[',
              string_agg(concat('{{"cohort_month":"', cohort_month, '","user_count":', cast(user_count as varchar),
                                ',"ret_0":', cast(ret_0 as varchar), ',"ret_1":', cast(ret_1 as varchar), '}}'), ','
                         order by cohort_month), ']}}') as payload
from ({_COHORTS}) c
"""
SQL["redacted_text"] = """
select doc_id, replace(replace(replace(replace(text, '@mail', '***'), '%40mail', '***'), 'token = ', '***'),
                       'token%20%3D%20', '***') as text
from {documents}
"""


def oracle_texts() -> dict[str, str]:
    return {name: with_inputs(text.strip()) for name, text in SQL.items()}
