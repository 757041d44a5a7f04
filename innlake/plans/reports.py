"""Datasets behind the dashboard charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from innlake.constants import SLA_MINUTES
from innlake.functions.dialect import percent, safe_ratio
from innlake.plans.kpis import MONEY, with_month

TOP = 5


def _count_by(df: DataFrame, *columns: str, name: str = "cnt") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def _average(total: Column, rows: Column) -> Column:
    """Mean with two digits from exact sums."""
    return F.round(safe_ratio(total, rows), 2).cast("double")


def status(stays: DataFrame) -> DataFrame:
    return _count_by(stays, "status")


def monthly_bookings(stays: DataFrame, dim_date: DataFrame, n_days: int = 0) -> DataFrame:
    return _count_by(with_month(stays, dim_date, n_days), "year", "month", name="bookings")


def channel(stays: DataFrame) -> DataFrame:
    return _count_by(stays, "booking_channel")


def length_of_stay(stays: DataFrame, dim_date: DataFrame, n_days: int = 0) -> DataFrame:
    monthly = with_month(stays, dim_date, n_days).groupBy("year", "month").agg(
        F.sum("length_of_stay").alias("nights"), F.count(F.lit(1)).alias("stays")
    )
    return monthly.select(
        "year", "month", _average(F.col("nights"), F.col("stays")).alias("avg_length_of_stay")
    )


def top_guests(bills: DataFrame, dim_guest: DataFrame) -> DataFrame:
    """Adds up per surrogate key before looking the guest up."""
    spent = bills.groupBy("guest_sk").agg(F.sum("net_revenue").cast(MONEY).alias("revenue"))
    named = spent.join(dim_guest.select("guest_sk", "guest_id"), "guest_sk")
    per_guest = named.groupBy("guest_id").agg(F.sum("revenue").cast(MONEY).alias("total_revenue"))
    return per_guest.orderBy(F.desc("total_revenue"), "guest_id").limit(TOP)


def top_rooms(stays: DataFrame, dim_room: DataFrame) -> DataFrame:
    used = _count_by(stays, "room_sk", name="n")
    named = used.join(dim_room.select("room_sk", "room_id"), "room_sk")
    per_room = named.groupBy("room_id").agg(F.sum("n").alias("reservations"))
    return per_room.orderBy(F.desc("reservations"), "room_id").limit(TOP)


def loyalty(dim_guest: DataFrame) -> DataFrame:
    return _count_by(dim_guest.filter("is_current"), "loyalty_tier", name="guests")


def room_type(dim_room: DataFrame) -> DataFrame:
    return _count_by(dim_room.filter("is_current"), "room_type", name="rooms")


def task_status(tasks: DataFrame) -> DataFrame:
    return _count_by(tasks, "task_type", "status")


def staff_workload(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("assigned_staff").agg(
        F.count(F.lit(1)).alias("tasks"), F.sum("duration_minutes").alias("total_minutes")
    )


def duration_vs_sla(tasks: DataFrame) -> DataFrame:
    took = F.col("duration_minutes")
    per_type = tasks.groupBy("task_type").agg(
        F.sum(took).alias("minutes"),
        F.count(took).alias("timed"),
        F.count_if(took > SLA_MINUTES).alias("over_sla"),
    )
    return per_type.select(
        "task_type", _average(F.col("minutes"), F.col("timed")).alias("avg_duration"), "over_sla"
    )


def sla_trend(kpi_hk_sla: DataFrame) -> DataFrame:
    monthly = kpi_hk_sla.groupBy("year", "month").agg(
        F.sum("total_tasks").alias("total_tasks"), F.sum("within_sla").alias("within_sla")
    )
    return monthly.withColumn("sla_pct", percent(F.col("within_sla"), F.col("total_tasks")))


def revpar_line(kpi_revpar: DataFrame) -> DataFrame:
    monthly = kpi_revpar.groupBy("year", "month").agg(
        F.sum("total_revenue").cast(MONEY).alias("total_revenue"),
        F.sum("total_rooms").alias("total_rooms"),
    )
    ratio = safe_ratio(F.col("total_revenue"), F.col("total_rooms"), digits=8)
    return monthly.withColumn("revpar", F.round(ratio, 2).cast("double"))


def payment_mode(bills: DataFrame) -> DataFrame:
    return bills.groupBy("payment_mode").agg(
        F.count(F.lit(1)).alias("bills"), F.sum("net_revenue").cast(MONEY).alias("total_revenue")
    )


def anomaly_summary(log: DataFrame) -> DataFrame:
    return _count_by(log, "rule_name", name="anomalies")
