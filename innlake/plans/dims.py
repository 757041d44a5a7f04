"""Dimensions of the star schema."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from innlake.constants import DATE_DIM_DAYS, DATE_DIM_START, UNKNOWN
from innlake.functions.dialect import date_key, day_name, is_weekend
from innlake.operators.scd2 import apply_snapshot, initial_versions

GUEST_COLUMNS = (
    "guest_id", "name", "dob", "gender", "email", "phone", "city", "country", "loyalty_tier",
    "registration_date",
)
ROOM_COLUMNS = (
    "room_id", "hotel_id", "room_type", "floor", "capacity", "amenities", "status", "base_price",
)
GUEST_TRACKED = ("loyalty_tier", "email", "phone")
ROOM_TRACKED = ("base_price", "status")


def dim_hotel(rooms: DataFrame) -> DataFrame:
    return rooms.select("hotel_id").distinct().select(
        "hotel_id", F.lit(UNKNOWN).alias("hotel_name"), F.lit(UNKNOWN).alias("region")
    )


def dim_guest(guests: DataFrame, as_of: datetime) -> DataFrame:
    return initial_versions(guests, "guest_sk", "guest_id", GUEST_COLUMNS, as_of)


def dim_room(rooms: DataFrame, as_of: datetime) -> DataFrame:
    return initial_versions(rooms, "room_sk", "room_id", ROOM_COLUMNS, as_of)


def scd2_dim_guest(dim: DataFrame, guests: DataFrame, as_of: datetime) -> DataFrame:
    return apply_snapshot(dim, guests, "guest_sk", "guest_id", GUEST_TRACKED, as_of)


def scd2_dim_room(dim: DataFrame, rooms: DataFrame, as_of: datetime) -> DataFrame:
    return apply_snapshot(dim, rooms, "room_sk", "room_id", ROOM_TRACKED, as_of)


def dim_date(
    spark: SparkSession, start: str = DATE_DIM_START, n_days: int = DATE_DIM_DAYS
) -> DataFrame:
    day = F.col("full_date")
    return (
        spark.range(n_days)
        .select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("full_date"))
        .select(
            date_key(day).alias("date_sk"),
            "full_date",
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.quarter(day).alias("quarter"),
            day_name(day).alias("day_name"),
            is_weekend(day).alias("is_weekend"),
        )
    )
