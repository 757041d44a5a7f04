"""Every result by name, over the provided tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import lru_cache, partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from innlake.functions import dialect as d
from innlake.operators import scd2
from innlake.operators.scd2 import instant
from innlake.plans import anomalies, dims, facts, governance, jobs, kpis, quality, reports
from innlake.plans.domains import DOMAINS
from innlake.plans.lake import Lake
from innlake.plans.validate import merge
from innlake.sources.changes import ARRIVAL, change_batch
from innlake.sources.feeds import FEEDS
from innlake.sources.provided import table
from innlake.sources.tables import settle, settle_all
from innlake.streamed import (
    beside_refused, by_file_time, history, incremental, ingested, job_anomalies, job_log, job_table, job_validated, landed_files, quoted,
)

AS_OF = datetime(2024, 2, 1)
CHANGED_AT = datetime(2024, 2, 2)
CLERK = "FRONT_DESK"

Query = Callable[[SparkSession, str], DataFrame]


@lru_cache(maxsize=8)
def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Layers over one folder; only declarations are shared between results."""
    return Lake(spark, lambda domain: FEEDS[domain](spark, sf_dir), AS_OF)


def _over_lake(build: Callable[[Lake], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(lake(spark, sf_dir))


# ---- incremental ------------------------------------------------------------

def merged(lk: Lake, domain: str) -> DataFrame:
    changes = change_batch(domain, DOMAINS[domain].key, lk.raw[domain])
    return merge(domain, lk.valid[domain], changes, [ARRIVAL])


def _scd2_guest(lk: Lake) -> DataFrame:
    before, after = settle(lk.dim_guest, "dim_guest"), settle(merged(lk, "guests"), "guests")
    return dims.scd2_dim_guest(before, after, CHANGED_AT)


def _scd2_room(lk: Lake) -> DataFrame:
    before, after = settle(lk.dim_room, "dim_room"), settle(merged(lk, "rooms"), "rooms")
    return dims.scd2_dim_room(before, after, CHANGED_AT)


def _feed_room(lk: Lake) -> DataFrame:
    """Versions of every room after two runs of a change feed, the second one late; without the surrogate keys."""
    rooms = settle(lk.valid["rooms"], "rooms")
    hour = lambda n: instant(CHANGED_AT + timedelta(hours=n)).alias("changed_at")
    changed = lambda n, **new: rooms.select(*[new[c].alias(c) if c in new else c for c in rooms.columns], hour(n))
    third = F.pmod(F.crc32(F.col("room_id").cast("binary")), F.lit(3)) == 0
    first = changed(1, status=F.lit("Dirty")).unionByName(changed(2, status=F.lit("Dirty"), amenities=F.lit("none"))).unionByName(
        changed(4, base_price=F.col("base_price") + 1))
    late = changed(3, status=F.when(third, "Dirty").otherwise("Closed")).unionByName(changed(3.5, base_price=F.col("base_price") + 1))
    dim = settle(scd2.apply_feed(settle(lk.dim_room, "dim_room"), first, "room_sk", "room_id", dims.ROOM_TRACKED), "dim_room")
    return scd2.apply_feed(dim, late, "room_sk", "room_id", dims.ROOM_TRACKED).drop("room_sk")


def _refresh_curated(lk: Lake) -> DataFrame:
    """Reservation facts rebuilt on merged rows and new dimension versions."""
    return facts.fact_reservation(merged(lk, "reservations"), _scd2_guest(lk), _scd2_room(lk))


# ---- logs -------------------------------------------------------------------

def _dq_exceptions(lk: Lake) -> DataFrame:
    valid = {domain: settle(lk.valid[domain], domain) for domain in DOMAINS}
    found = settle_all(quality.all_exceptions(lk.raw, valid), "exceptions")
    return quality.exception_log(found, AS_OF)


def _findings(lk: Lake) -> DataFrame:
    """All anomalies, from fact tables written once as the daily run finds them."""
    room = settle(lk.dim_room, "dim_room")
    valid = lk.valid
    stays = settle(facts.fact_reservation(valid["reservations"], lk.dim_guest, room), "stays")
    tasks, bills = settle(lk.tasks_keyless, "tasks"), settle(lk.bills_keyless, "bills")
    return settle_all(anomalies.all_findings(stays, tasks, bills, room, AS_OF), "findings")


# ---- governance -------------------------------------------------------------

def _row_access(lk: Lake) -> DataFrame:
    """Rooms a front-desk role sees: it is granted the hotels H1, H10 … H19."""
    grants = lk.dim_hotel.filter(F.col("hotel_id").like("H1%")).select(
        F.lit(CLERK).alias("role"), "hotel_id"
    )
    return governance.row_access_view(lk.dim_room, grants, CLERK)


def _date_lookup(lk: Lake) -> DataFrame:
    """Calendar attributes of every check-in inside the date dimension."""
    days = F.broadcast(lk.dim_date).withColumnRenamed("date_sk", "check_in_date_sk")
    return lk.stays_keyless.select("reservation_id", "check_in_date_sk").join(days, "check_in_date_sk")


# ---- scalar functions over provided tables ----------------------------------

def _fn_parse(lk: Lake) -> DataFrame:
    day = F.substring("payment_time", 1, 10)
    rows = lk.raw["billing"].withColumns({
        "_day": day, "_padded": F.concat(day, F.lit(" ")), "_cut": F.concat(day, F.lit("T")),
        "_epoch": F.replace("total_amount", F.lit("."), F.lit("")),
        "_far": F.concat(F.lit("9"), F.lpad(F.replace("total_amount", F.lit("."), F.lit("")), 21, "0")),
    })
    return rows.select(
        "bill_id",
        d.try_decimal("total_amount", 12, 2).alias("amount"),
        d.try_decimal("total_amount", 5, 1).alias("narrow_amount"),
        d.try_number("total_amount").alias("whole_amount"),
        d.try_date("payment_time").alias("not_a_date"),
        d.try_timestamp("payment_time").alias("paid_at"),
        d.flag("is_flagged").alias("flagged"),
        d.try_date("_day").alias("paid_on"),
        d.try_date("_padded").alias("padded_day"),
        d.try_date("_cut").alias("cut_time"),
        d.try_timestamp("_epoch", epoch=True).alias("epoch_at"),
        d.try_timestamp("_far", epoch=True).alias("far_epoch"),
    )


def _fn_init_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", d.init_cap(F.col("text")).alias("spelled"))


def _fn_time_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    seconds = F.floor(F.col("value") * 60).cast("decimal(18,6)")
    end = ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return table(spark, sf_dir, "events").select(
        "event_id",
        d.minutes_between(ts, end).alias("minutes"),
        d.hours_between(ts, instant(AS_OF)).alias("hours"),
    )


def _fn_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        d.date_key(day).alias("date_sk"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        d.day_name(day).alias("day_name"),
        d.is_weekend(day).alias("is_weekend"),
    )


def _fn_safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
        F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"),
    )
    return per_customer.withColumn("pct", d.percent(F.col("finished"), F.col("open_orders")))


def _per_domain(prefix: str, build: Callable[[Lake, str], DataFrame]) -> dict[str, Query]:
    return {
        f"{prefix}_{domain}": _over_lake(lambda lk, domain=domain: build(lk, domain))
        for domain in DOMAINS
    }


def _streamed(prefix: str, build: Callable[..., DataFrame]) -> dict[str, Query]:
    return {
        f"{prefix}_{domain}": lambda spark, sf_dir, domain=domain: build(spark, sf_dir, domain, AS_OF)
        for domain in DOMAINS
    }


VIEWS = ("kpi_occupancy", "kpi_conversion", "kpi_hk_sla", "kpi_revpar", "kpi_billing_accuracy")


def _view(name: str, query: Query) -> Query:
    """The result as SQL users read it: a registered view."""
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        query(spark, sf_dir).createOrReplaceTempView(name)
        return spark.table(name)

    return read


def all_queries() -> dict[str, Query]:
    results = _results()
    return {**results, **{f"view_{name}": _view(name, results[name]) for name in VIEWS}}


def _results() -> dict[str, Query]:
    over = _over_lake
    return {
        **_per_domain("raw", lambda lk, domain: lk.raw[domain]),
        **_per_domain("validate", lambda lk, domain: lk.valid[domain]),
        **_per_domain("merge", merged),
        **_streamed("ingest", ingested),
        **_streamed("incremental", incremental),
        **_streamed("ingest_refused", beside_refused),
        **_streamed("load_history", history),
        **_streamed("incremental_strict", partial(incremental, strict=True)),
        **_streamed("incremental_by_time", by_file_time),
        "ingest_quoted": lambda spark, sf_dir: quoted(spark, sf_dir, "rooms", AS_OF, "amenities"),
        "list_files_rooms": lambda spark, sf_dir: landed_files(spark, sf_dir, "rooms", AS_OF),
        **{f"job_{t}": lambda spark, sf_dir, t=t: job_table(spark, sf_dir, t, AS_OF) for t in (*jobs.FACTS, *jobs.DIMENSIONS)},
        **{f"job_{t}": lambda spark, sf_dir, t=t: job_log(spark, sf_dir, t, AS_OF) for t in ("load_log", "dq_exceptions")},
        "job_anomaly_log": lambda spark, sf_dir: job_anomalies(spark, sf_dir, AS_OF),
        **_streamed("job_validated", job_validated),
        "dq_reservation_guest_fk": over(
            lambda lk: quality.reservation_guest_fk(lk.valid["reservations"], lk.valid["guests"])
        ),
        "dq_housekeeping_room_fk": over(
            lambda lk: quality.housekeeping_room_fk(lk.valid["housekeeping"], lk.valid["rooms"])
        ),
        "dq_exceptions": over(_dq_exceptions),
        "load_log": over(lambda lk: quality.load_log(lk.raw, lk.valid, AS_OF)),
        "dim_hotel": over(lambda lk: lk.dim_hotel),
        "dim_guest": over(lambda lk: lk.dim_guest),
        "dim_room": over(lambda lk: lk.dim_room),
        "dim_date": over(_date_lookup),
        "fact_reservation": over(lambda lk: lk.stays),
        "fact_housekeeping": over(lambda lk: lk.tasks),
        "fact_billing": over(lambda lk: lk.bills),
        "scd2_dim_guest": over(_scd2_guest),
        "scd2_dim_room": over(_scd2_room),
        "scd2_feed_room": over(_feed_room),
        "refresh_curated": over(_refresh_curated),
        "anomaly_double_booking": over(lambda lk: anomalies.double_booking(lk.stays_by_room)),
        "anomaly_hk_sla_breach": over(lambda lk: anomalies.hk_sla_breach(lk.tasks_keyless)),
        "anomaly_maintenance_overdue": over(
            lambda lk: anomalies.maintenance_overdue(lk.tasks_keyless, AS_OF)
        ),
        "anomaly_billing_mismatch": over(
            lambda lk: anomalies.billing_mismatch(lk.bills_keyless, lk.stays_by_room, lk.dim_room)
        ),
        "anomaly_suspicious_cancellation": over(
            lambda lk: anomalies.suspicious_cancellation(lk.stays_by_guest)
        ),
        "anomaly_log": over(lambda lk: anomalies.anomaly_log(_findings(lk), AS_OF)),
        "anomaly_cancellation_sliding": over(
            lambda lk: anomalies.cancellation_sliding(lk.stays_by_guest)
        ),
        "anomaly_maintenance_followup": over(
            lambda lk: anomalies.maintenance_without_followup(lk.tasks, AS_OF)
        ),
        "kpi_occupancy": over(
            lambda lk: kpis.kpi_occupancy(lk.stays_by_room, lk.dim_room, lk.dim_date, lk.n_days)
        ),
        "kpi_conversion": over(
            lambda lk: kpis.kpi_conversion(lk.stays_by_room, lk.dim_room, lk.dim_date, lk.n_days)
        ),
        "kpi_hk_sla": over(lambda lk: kpis.kpi_hk_sla(lk.tasks, lk.dim_room)),
        "kpi_revpar": over(_revpar),
        "kpi_billing_accuracy": over(lambda lk: kpis.kpi_billing_accuracy(lk.bills_keyless)),
        "masked_dim_guest": over(lambda lk: governance.masked_dim_guest(lk.dim_guest, CLERK)),
        "row_access_view": over(_row_access),
        "row_counts": over(lambda lk: governance.row_counts(lk.layers())),
        "rpt_status": over(lambda lk: reports.status(lk.stays_keyless)),
        "rpt_monthly_bookings": over(
            lambda lk: reports.monthly_bookings(lk.stays_keyless, lk.dim_date, lk.n_days)
        ),
        "rpt_channel": over(lambda lk: reports.channel(lk.stays_keyless)),
        "rpt_length_of_stay": over(
            lambda lk: reports.length_of_stay(lk.stays_keyless, lk.dim_date, lk.n_days)
        ),
        "rpt_top_guests": over(lambda lk: reports.top_guests(lk.bills, lk.dim_guest)),
        "rpt_top_rooms": over(lambda lk: reports.top_rooms(lk.stays_by_room, lk.dim_room)),
        "rpt_loyalty": over(lambda lk: reports.loyalty(lk.dim_guest)),
        "rpt_room_type": over(lambda lk: reports.room_type(lk.dim_room)),
        "rpt_task_status": over(lambda lk: reports.task_status(lk.tasks_keyless)),
        "rpt_staff_workload": over(lambda lk: reports.staff_workload(lk.tasks_keyless)),
        "rpt_duration_vs_sla": over(lambda lk: reports.duration_vs_sla(lk.tasks_keyless)),
        "rpt_sla_trend": over(
            lambda lk: reports.sla_trend(kpis.kpi_hk_sla(lk.tasks, lk.dim_room))
        ),
        "rpt_revpar_line": over(lambda lk: reports.revpar_line(_revpar(lk))),
        "rpt_payment_mode": over(lambda lk: reports.payment_mode(lk.bills_keyless)),
        "rpt_billing_accuracy": over(lambda lk: kpis.kpi_billing_accuracy(lk.bills_keyless)),
        "rpt_anomaly_summary": over(lambda lk: reports.anomaly_summary(_findings(lk))),
        "fn_parse": over(_fn_parse),
        "fn_init_cap": _fn_init_cap,
        "fn_time_between": _fn_time_between,
        "fn_date_parts": _fn_date_parts,
        "fn_safe_ratio": _fn_safe_ratio,
    }


def _revpar(lk: Lake) -> DataFrame:
    return kpis.kpi_revpar(lk.bills_keyless, lk.stays_by_room, lk.dim_room, lk.dim_date, lk.n_days)
