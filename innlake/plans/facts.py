"""Facts of the star schema.

A dimension is unique on its natural key among current versions, so looking up
its surrogate key never changes the number of fact rows. A reader that does not
need one of the keys can leave that dimension out and save its join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from innlake.constants import CANCELLED, NO_SHOW
from innlake.functions.dialect import date_key, minutes_between


def _attach(facts: DataFrame, dim: DataFrame | None, key: str, sk: str) -> DataFrame:
    if dim is None:
        return facts
    return facts.join(dim.filter("is_current").select(key, sk), key, "left")


def _keep(df: DataFrame, *columns) -> DataFrame:
    """Select, skipping surrogate keys whose dimension was left out."""
    return df.select(*[c for c in columns if not isinstance(c, str) or c in df.columns])


def fact_reservation(
    reservations: DataFrame, dim_guest: DataFrame | None = None, dim_room: DataFrame | None = None
) -> DataFrame:
    stays = _attach(reservations, dim_guest, "guest_id", "guest_sk")
    stays = _attach(stays, dim_room, "room_id", "room_sk")
    return _keep(
        stays,
        "reservation_id", "guest_sk", "room_sk",
        date_key(F.col("check_in_date")).alias("check_in_date_sk"),
        date_key(F.col("check_out_date")).alias("check_out_date_sk"),
        "booking_channel", "booking_time", "cancellation_time", "status",
        F.datediff("check_out_date", "check_in_date").cast("bigint").alias("length_of_stay"),
        F.coalesce(F.col("status") == CANCELLED, F.lit(False)).alias("is_cancelled"),
        F.coalesce(F.col("status") == NO_SHOW, F.lit(False)).alias("is_no_show"),
    )


def fact_housekeeping(housekeeping: DataFrame, dim_room: DataFrame | None = None) -> DataFrame:
    tasks = _attach(housekeeping, dim_room, "room_id", "room_sk")
    return _keep(
        tasks,
        "task_id", "room_sk", "task_type", "assigned_staff", "scheduled_time", "start_time",
        "end_time",
        minutes_between(F.col("start_time"), F.col("end_time")).alias("duration_minutes"),
        "issue_detected_flag", "status",
    )


def fact_billing(billing: DataFrame, dim_guest: DataFrame | None = None) -> DataFrame:
    bills = _attach(billing, dim_guest, "guest_id", "guest_sk")
    return _keep(
        bills,
        "bill_id", "reservation_id", "guest_sk", "total_amount", "taxes", "discounts",
        (F.col("total_amount") - F.col("discounts")).cast("decimal(13,2)").alias("net_revenue"),
        "payment_mode", "payment_time", "is_flagged",
    )
