"""The five KPI views.

Each one first adds up per room and month, where partial aggregation absorbs a
busy room before the shuffle, and only then looks up the hotel: at that point
a room has one row per month. Distinct rooms are then simply rows, so no
distinct aggregate is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from innlake.constants import COMPLETED, CONFIRMED, SLA_MINUTES
from innlake.functions.dialect import percent, safe_ratio

MAX_BROADCAST_DAYS = 100_000
MONEY = "decimal(38,2)"


def _ones(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")


def with_month(facts: DataFrame, dim_date: DataFrame, n_days: int = 0) -> DataFrame:
    """Year and month of check-in; days outside the date dimension drop out.

    Facts that are kept by month are joined on it as well, so days of a few months leave the other parts unread.
    """
    part = (F.col("year") * 100 + F.col("month")).alias("check_in_month")
    months = dim_date.select(F.col("date_sk").alias("check_in_date_sk"), "year", "month", part)
    if 0 < n_days <= MAX_BROADCAST_DAYS:
        months = F.broadcast(months)
    if "check_in_month" in facts.columns:
        return facts.join(months, ["check_in_date_sk", "check_in_month"])
    return facts.join(months.drop("check_in_month"), "check_in_date_sk")


def _with_hotel(per_room: DataFrame, dim_room: DataFrame) -> DataFrame:
    hotels = dim_room.filter("is_current").select("room_sk", "hotel_id")
    return per_room.join(hotels, "room_sk")


def kpi_occupancy(stays: DataFrame, dim_room: DataFrame, dim_date: DataFrame, n_days: int = 0) -> DataFrame:
    """Confirmed reservations against rooms with any check-in that month.

    ``reservation_id`` is unique in the fact table, so counting rows counts
    distinct reservations.
    """
    per_room = (
        with_month(stays, dim_date, n_days)
        .groupBy("room_sk", "year", "month")
        .agg(_ones(F.col("status") == CONFIRMED).alias("booked"))
    )
    per_hotel = _with_hotel(per_room, dim_room).groupBy("hotel_id", "year", "month").agg(
        F.sum("booked").alias("booked_rooms"), F.count(F.lit(1)).alias("total_rooms")
    )
    return per_hotel.withColumn(
        "occupancy_rate_pct", percent(F.col("booked_rooms"), F.col("total_rooms"))
    )


def kpi_conversion(stays: DataFrame, dim_room: DataFrame, dim_date: DataFrame, n_days: int = 0) -> DataFrame:
    per_room = (
        with_month(stays, dim_date, n_days)
        .groupBy("room_sk", "year", "month")
        .agg(
            F.count(F.lit(1)).alias("total_reservations"),
            _ones(F.col("status") == CONFIRMED).alias("confirmed"),
            _ones(F.col("is_cancelled")).alias("cancellations"),
            _ones(F.col("is_no_show")).alias("no_shows"),
        )
    )
    measures = ("total_reservations", "confirmed", "cancellations", "no_shows")
    per_hotel = _with_hotel(per_room, dim_room).groupBy("hotel_id", "year", "month").agg(
        *[F.sum(m).alias(m) for m in measures]
    )
    return per_hotel.withColumn(
        "conversion_pct", percent(F.col("confirmed"), F.col("total_reservations"))
    )


def kpi_hk_sla(tasks: DataFrame, dim_room: DataFrame) -> DataFrame:
    in_time = (F.col("duration_minutes") <= SLA_MINUTES) & (F.col("status") == COMPLETED)
    when = F.col("scheduled_time")
    per_room = tasks.groupBy(
        "room_sk", "task_type", F.year(when).alias("year"), F.month(when).alias("month")
    ).agg(F.count(F.lit(1)).alias("total_tasks"), _ones(in_time).alias("within_sla"))
    per_hotel = _with_hotel(per_room, dim_room).groupBy("hotel_id", "task_type", "year", "month").agg(
        F.sum("total_tasks").alias("total_tasks"), F.sum("within_sla").alias("within_sla")
    )
    return per_hotel.withColumn("sla_pct", percent(F.col("within_sla"), F.col("total_tasks")))


def kpi_revpar(
    bills: DataFrame, stays: DataFrame, dim_room: DataFrame, dim_date: DataFrame, n_days: int = 0
) -> DataFrame:
    """Net revenue per room with at least one billed reservation that month.

    Bills are added up per reservation before the join, on the very exchange
    the join needs, so a reservation with countless bills joins as one row.
    """
    per_stay = bills.groupBy("reservation_id").agg(F.sum("net_revenue").cast(MONEY).alias("revenue"))
    billed = stays.select("reservation_id", "room_sk", "check_in_date_sk").join(
        per_stay, "reservation_id"
    )
    per_room = (
        with_month(billed, dim_date, n_days)
        .groupBy("room_sk", "year", "month")
        .agg(F.sum("revenue").cast(MONEY).alias("revenue"))
    )
    per_hotel = _with_hotel(per_room, dim_room).groupBy("hotel_id", "year", "month").agg(
        F.sum("revenue").cast(MONEY).alias("total_revenue"), F.count(F.lit(1)).alias("total_rooms")
    )
    ratio = safe_ratio(F.col("total_revenue"), F.col("total_rooms"), digits=8)
    return per_hotel.withColumn("revpar", F.round(ratio, 2).cast("double"))


def kpi_billing_accuracy(bills: DataFrame) -> DataFrame:
    paid = F.col("payment_time")
    monthly = bills.filter(paid.isNotNull()).groupBy(
        F.year(paid).alias("year"), F.month(paid).alias("month")
    ).agg(F.count(F.lit(1)).alias("total_bills"), _ones(F.col("is_flagged")).alias("flagged_bills"))
    ratio = safe_ratio(F.col("flagged_bills"), F.col("total_bills"))
    return monthly.withColumn("accuracy_index", F.round(1 - ratio, 4).cast("double"))
