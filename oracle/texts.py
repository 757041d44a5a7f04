"""One self-contained DuckDB query per registered result."""

from __future__ import annotations

import re

from innlake.constants import EMAIL_MASK_PATTERN, EMAIL_MASK_REPLACEMENT, PHONE_MASK_PREFIX
from oracle.layers import (
    AS_OF, BLOCKS, COLUMNS, KEYS, cap, day, mean, moment, money, number, pct, per, whole, yes, ymd,
)

_NAME = re.compile(r"\b(" + "|".join(sorted(BLOCKS, key=len, reverse=True)) + r")\b")


def _needed(text: str, found: dict[str, None]) -> dict[str, None]:
    for name in dict.fromkeys(_NAME.findall(text)):
        if name not in found:
            _needed(BLOCKS[name], found)
            found[name] = None
    return found


def standalone(body: str) -> str:
    """``body`` preceded by the blocks it refers to, in dependency order."""
    blocks = ",\n".join(f"{name} as ({BLOCKS[name].strip()})" for name in _needed(body, {}))
    return f"with {blocks}\n{body.strip()}" if blocks else body.strip()


_COUNTS = " union all ".join(
    f"select '{label}' as layer, count(*) as cnt from {table}"
    for label, table in (
        [(f"RAW {d.upper()}", f"raw_{d}") for d in KEYS]
        + [(f"VAL {d.upper()}", f"val_{d}") for d in KEYS]
        + [("FACT RESERVATION", "stays"), ("FACT HOUSEKEEPING", "tasks"), ("FACT BILLING", "bills")]
    )
)
_MASKED = EMAIL_MASK_REPLACEMENT.replace("$", "\\")
_MONTHS = "stays join dim_date on date_sk = check_in_date_sk"

BODIES = {
    **{f"raw_{d}": f"select * from raw_{d}" for d in KEYS},
    **{f"validate_{d}": f"select * from val_{d}" for d in KEYS},
    **{f"merge_{d}": f"select {', '.join(COLUMNS[d])} from mrg_{d}" for d in KEYS},
    **{f"ingest_{d}": f"select * from landed_{d}" for d in KEYS},
    **{f"ingest_refused_{d}": f"select * from landed_{d}" for d in KEYS},
    **{f"load_history_{d}": f"""
        select 'LOADED' as status, count(*) as row_count from landed_{d}
        union all select 'REFUSED', 1""" for d in KEYS},
    **{f"view_{k}": f"select * from {k}" for k in (
        "kpi_occupancy", "kpi_conversion", "kpi_hk_sla", "kpi_revpar", "kpi_billing_accuracy")},
    **{f"incremental_{d}": f"select * from after_third_{d}" for d in KEYS},
    **{f"incremental_strict_{d}": f"select * from after_strict_third_{d}" for d in KEYS},
    **{f"incremental_by_time_{d}": f"select * from after_by_time_{d}" for d in KEYS},
    "ingest_quoted": "select * replace (replace(amenities, ' ', chr(10)) as amenities) from landed_rooms",
    "list_files_rooms": "select cast(least(3, count(*)) as bigint) as files, cast(0 as bigint) as empty_files from landed_rooms",
    "job_fact_reservation": "select * from job_stays",
    "job_fact_housekeeping": "select * from job_tasks",
    "job_fact_billing": "select * from job_bills",
    "job_dim_guest": "select * from job_dim_guest_2",
    "job_dim_room": "select * from job_dim_room_2",
    "job_anomaly_log": f"""
        select {number('rule_name', 'entity_id', 'details')} as anomaly_id, *, {AS_OF} + interval 2 hour as detected_at
        from job_findings""",
    **{f"job_validated_{d}": f"select * from after_third_{d}" for d in KEYS},
    "job_load_log": f"""
        select row_number() over (order by run, md5(domain)) as log_id, domain, total_rows, passed_rows,
          total_rows - passed_rows as failed_rows,
          if(total_rows > passed_rows, format('{{}} rows rejected', total_rows - passed_rows), null) as error_detail, batch_ts
        from job_loads""",
    "job_dq_exceptions": f"""
        select {number('domain', 'natural_key', 'error_type', 'error_detail').replace('order by', 'order by run,')} as exception_id,
          domain, natural_key, error_type, error_detail, {AS_OF} + (run // 5) * interval 1 hour as logged_at from job_exceptions""",
    "dq_reservation_guest_fk": "select * from fk_reservation_guest",
    "dq_housekeeping_room_fk": "select * from fk_housekeeping_room",
    "dq_exceptions": f"""
        select {number('domain', 'natural_key', 'error_type', 'error_detail')} as exception_id, *,
          {AS_OF} as logged_at from exceptions""",
    "load_log": f"""
        select {number('domain')} as log_id, domain, total_rows, passed_rows,
          total_rows - passed_rows as failed_rows,
          if(total_rows > passed_rows, format('{{}} rows rejected', total_rows - passed_rows), null)
            as error_detail,
          {AS_OF} as batch_ts from loads""",
    "dim_hotel": "select * from dim_hotel",
    "dim_guest": "select * from dim_guest",
    "dim_room": "select * from dim_room",
    "dim_date": """
        select reservation_id, d.* exclude (date_sk), check_in_date_sk
        from stays join dim_date d on date_sk = check_in_date_sk""",
    "fact_reservation": "select * from stays",
    "fact_housekeeping": "select * from tasks",
    "fact_billing": "select * from bills",
    "scd2_dim_guest": "select * from scd_guest",
    "scd2_dim_room": "select * from scd_room",
    "scd2_feed_room": "select * from feed_versions",
    "refresh_curated": "select * from refreshed",
    "anomaly_double_booking": "select * from double_booking",
    "anomaly_hk_sla_breach": "select * from hk_sla_breach",
    "anomaly_maintenance_overdue": "select * from maintenance_overdue",
    "anomaly_billing_mismatch": "select * from billing_mismatch",
    "anomaly_suspicious_cancellation": "select * from suspicious_cancellation",
    "anomaly_log": "select * from anomaly_log",
    "anomaly_cancellation_sliding": "select * from cancellation_sliding",
    "anomaly_maintenance_followup": "select * from maintenance_followup",
    "kpi_occupancy": "select * from kpi_occupancy",
    "kpi_conversion": "select * from kpi_conversion",
    "kpi_hk_sla": "select * from kpi_hk_sla",
    "kpi_revpar": "select * from kpi_revpar",
    "kpi_billing_accuracy": "select * from kpi_billing_accuracy",
    "masked_dim_guest": f"""
        select * replace (
          regexp_replace(email, '{EMAIL_MASK_PATTERN}', '{_MASKED}') as email,
          '{PHONE_MASK_PREFIX}'||right(phone, 4) as phone)
        from dim_guest""",
    "row_access_view": "select * from dim_room where hotel_id like 'H1%'",
    "row_counts": _COUNTS,
    "rpt_status": "select status, count(*) as cnt from stays group by all",
    "rpt_monthly_bookings": f"select year, month, count(*) as bookings from {_MONTHS} group by all",
    "rpt_channel": "select booking_channel, count(*) as cnt from stays group by all",
    "rpt_length_of_stay": f"""
        select year, month, {mean('sum(length_of_stay)', 'count(*)')} as avg_length_of_stay
        from {_MONTHS} group by year, month""",
    "rpt_top_guests": """
        select guest_id, cast(sum(net_revenue) as decimal(38,2)) as total_revenue
        from bills join dim_guest using (guest_sk) group by guest_id
        order by total_revenue desc, guest_id limit 5""",
    "rpt_top_rooms": """
        select room_id, count(*) as reservations from stays join dim_room using (room_sk)
        group by room_id order by reservations desc, room_id limit 5""",
    "rpt_loyalty": "select loyalty_tier, count(*) as guests from dim_guest group by all",
    "rpt_room_type": "select room_type, count(*) as rooms from dim_room group by all",
    "rpt_task_status": "select task_type, status, count(*) as cnt from tasks group by all",
    "rpt_staff_workload": """
        select assigned_staff, count(*) as tasks, cast(sum(duration_minutes) as bigint) as total_minutes
        from tasks group by all""",
    "rpt_duration_vs_sla": f"""
        select task_type, {mean('sum(duration_minutes)', 'count(duration_minutes)')} as avg_duration,
          count(*) filter (duration_minutes > 120) as over_sla
        from tasks group by task_type""",
    "rpt_sla_trend": f"""
        select *, {pct('within_sla', 'total_tasks')} as sla_pct
        from (select year, month, cast(sum(total_tasks) as bigint) as total_tasks,
                cast(sum(within_sla) as bigint) as within_sla from kpi_hk_sla group by all)""",
    "rpt_revpar_line": f"""
        select *, {per('total_revenue', 'total_rooms')} as revpar
        from (select year, month, cast(sum(total_revenue) as decimal(38,2)) as total_revenue,
                cast(sum(total_rooms) as bigint) as total_rooms from kpi_revpar group by all)""",
    "rpt_payment_mode": """
        select payment_mode, count(*) as bills, cast(sum(net_revenue) as decimal(38,2)) as total_revenue
        from bills group by all""",
    "rpt_billing_accuracy": "select * from kpi_billing_accuracy",
    "rpt_anomaly_summary": "select rule_name, count(*) as anomalies from anomaly_log group by all",
    "fn_parse": f"""
        select bill_id, {money('total_amount', 12)} as amount, {money('total_amount', 5, 1)} as narrow_amount,
          {whole('total_amount')} as whole_amount, {day('payment_time')} as not_a_date,
          {moment('payment_time')} as paid_at, {yes('is_flagged')} as flagged,
          {day("left(payment_time, 10)")} as paid_on,
          {day("left(payment_time, 10) || ' '")} as padded_day, {day("left(payment_time, 10) || 'T'")} as cut_time,
          case when regexp_full_match(replace(total_amount, '.', ''), '[0-9]+')
            then timestamp '1970-01-01' + to_seconds(try_cast(replace(total_amount, '.', '') as bigint)) end as epoch_at,
          cast(null as timestamp) as far_epoch
        from raw_billing""",
    "fn_init_cap": f"select doc_id, {cap('text')} as spelled from documents",
    "fn_time_between": f"""
        select event_id, date_diff('minute', ts, ts + floor(value*60)::bigint * interval 1 second) as minutes,
          date_diff('hour', ts, {AS_OF}) as hours
        from events""",
    "fn_date_parts": f"""
        select o_orderkey, {ymd('o_orderdate')} as date_sk, cast(year(o_orderdate) as integer) as year,
          cast(month(o_orderdate) as integer) as month, cast(day(o_orderdate) as integer) as day,
          cast(quarter(o_orderdate) as integer) as quarter, left(dayname(o_orderdate),3) as day_name,
          dayofweek(o_orderdate) in (0,6) as is_weekend
        from orders""",
    "fn_safe_ratio": f"""
        select *, {pct('finished', 'open_orders')} as pct
        from (select o_custkey, count(*) filter (o_orderstatus = 'F') as finished,
                count(*) filter (o_orderstatus = 'O') as open_orders
              from orders group by o_custkey)""",
}


def all_texts() -> dict[str, str]:
    return {name: standalone(body) for name, body in BODIES.items()}
