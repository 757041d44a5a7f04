from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from innlake.constants import PRIVILEGED_ROLE
from innlake.functions import dialect as d, masking
from innlake.plans.dims import dim_date


def one(spark, value, expression):
    frame = spark.createDataFrame([(value,)], "x string")
    return frame.select(expression.alias("y")).first().y


@pytest.mark.parametrize("text,want", [
    ("2024-02-03", date(2024, 2, 3)), ("2024", None), ("2024-02-03 10:00:00", None),
    ("2024-02-30", None), ("31/12/1980", None), ("", None), (None, None), ("2024-2-003", None),
])
def test_try_date(spark, text, want):
    assert one(spark, text, d.try_date("x")) == want


def test_try_date_agrees_with_pattern_parse(spark):
    frame = spark.range(-719_162, 2_900_000, 997).select(
        F.date_from_unix_date(F.col("id").cast("int")).cast("string").alias("x")
    )
    strict = F.try_to_date("x", "yyyy-MM-dd")
    assert frame.filter(~d.try_date("x").eqNullSafe(strict)).count() == 0


@pytest.mark.parametrize("text,want", [
    ("2024-02-03 10:00:05", datetime(2024, 2, 3, 10, 0, 5)),
    ("2024-02-03T10:00:05", datetime(2024, 2, 3, 10, 0, 5)),
    ("2024-02-03", datetime(2024, 2, 3)),
    (" 2024-02-03 10:00:05 ", datetime(2024, 2, 3, 10, 0, 5)),
    ("2024-02-03 10:00:05.25", datetime(2024, 2, 3, 10, 0, 5, 250000)),
    ("2024", None), ("n/a", None), ("1700000000", None), (None, None),
])
def test_try_timestamp(spark, text, want):
    assert one(spark, text, d.try_timestamp("x")) == want


@pytest.mark.parametrize("text", ["1700000000", "1700000000000", "1700000000000000", "1700000000000000000"])
def test_epoch_digits_behind_a_switch(spark, text):
    assert one(spark, text, d.try_timestamp("x", epoch=True)) == datetime(2023, 11, 14, 22, 13, 20)


def test_epoch_switch_keeps_iso_text(spark):
    want = datetime(2024, 2, 3, 10, 0)
    assert one(spark, "2024-02-03 10:00:00", d.try_timestamp("x", epoch=True)) == want


@pytest.mark.parametrize("text,want", [("3.7", 4), ("3.5", 4), ("-3.5", -4), ("2", 2), ("G", None), (None, None)])
def test_try_integer(spark, text, want):
    assert one(spark, text, d.try_integer("x")) == want


@pytest.mark.parametrize("text,want", [
    ("123456789012", None), ("abc", None), (" 12.345 ", Decimal("12.35")), ("201", Decimal("201.00")),
])
def test_try_decimal(spark, text, want):
    assert one(spark, text, d.try_decimal("x", 10, 2)) == want


@pytest.mark.parametrize("text,want", [
    ("no_show", "No_Show"), ("CHECKED-OUT", "Checked-Out"), ("in progress", "In Progress"),
    ("o'neil a.b/c|d\\e[f]g", "O'neil A.B/C|D\\E[F]G"), ("confirmed", "Confirmed"),
    ("a\tb\nc", "A\tB\nC"), ("3rd_floor", "3rd_Floor"), ("", ""), (None, None),
])
def test_init_cap(spark, text, want):
    assert one(spark, text, d.init_cap(F.col("x"))) == want


@pytest.mark.parametrize("text,want", [("Y", True), (" y ", True), ("N", False), ("yes", False), (None, False)])
def test_flag(spark, text, want):
    assert one(spark, text, d.flag("x")) is want


@pytest.mark.parametrize("start,end,minutes,hours", [
    ("2024-01-01 00:00:59", "2024-01-01 00:01:01", 1, 0),
    ("2024-01-01 00:59:59", "2024-01-01 01:00:00", 1, 1),
    ("2024-01-01 00:01:00", "2024-01-01 00:01:59", 0, 0),
    ("2024-01-02 00:00:00", "2024-01-01 23:59:59", -1, -1),
    ("2024-01-01 10:30:00", "2024-01-03 09:15:00", 2805, 47),
])
def test_boundaries_crossed(spark, start, end, minutes, hours):
    frame = spark.createDataFrame([(start, end)], "a string, b string").select(
        F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
    )
    row = frame.select(
        d.minutes_between(F.col("a"), F.col("b")).alias("m"),
        d.hours_between(F.col("a"), F.col("b")).alias("h"),
    ).first()
    assert (row.m, row.h) == (minutes, hours)


def test_date_key_round_trip(spark):
    frame = spark.range(-30_000, 80_000, 7).select(
        F.col("id").cast("int").alias("n"), F.date_from_unix_date(F.col("id").cast("int")).alias("d")
    )
    assert frame.filter(d.day_number(d.date_key(F.col("d"))) != F.col("n")).count() == 0


def test_null_date_key(spark):
    assert one(spark, None, d.date_key(F.col("x").cast("date"))) is None


@pytest.mark.parametrize("a,b,want", [(1, 3, 33.33), (2, 3, 66.67), (3, 1, 300.0), (1, 0, None), (0, 5, 0.0)])
def test_percent(spark, a, b, want):
    frame = spark.createDataFrame([(a, b)], "a bigint, b bigint")
    assert frame.select(d.percent(F.col("a"), F.col("b")).alias("p")).first().p == want


@pytest.mark.parametrize("text,want", [
    ("alice@x.com", "al***@x.com"), ("ab@x.com", "ab@x.com"), ("a@b@c.com", "a@***@c.com"), (None, None),
])
def test_mask_email(spark, text, want):
    assert one(spark, text, masking.mask_email(F.col("x"), "CLERK")) == want


def test_strict_mask_hides_short_names(spark):
    assert one(spark, "ab@x.com", masking.mask_email(F.col("x"), "CLERK", strict=True)) == "***@x.com"
    assert one(spark, "a@b@c.com", masking.mask_email(F.col("x"), "CLERK", strict=True)) == "***@c.com"


@pytest.mark.parametrize("text,want", [("123", "XXXXXX123"), ("+15551234567", "XXXXXX4567"), (None, None)])
def test_mask_phone(spark, text, want):
    assert one(spark, text, masking.mask_phone(F.col("x"), "CLERK")) == want


def test_privileged_role_sees_everything(spark):
    assert one(spark, "alice@x.com", masking.mask_email(F.col("x"), PRIVILEGED_ROLE)) == "alice@x.com"
    assert one(spark, "123", masking.mask_phone(F.col("x"), PRIVILEGED_ROLE)) == "123"


def test_dim_date(spark):
    days = dim_date(spark)
    assert days.count() == days.select("date_sk").distinct().count() == 3650
    last = days.orderBy(F.desc("date_sk")).first()
    assert last.full_date == date(2029, 12, 28) and last.date_sk == 20291228
    assert days.filter("is_weekend").count() == 1042
    sunday = days.filter("full_date = date'2024-01-07'").first()
    assert (sunday.day_name, sunday.is_weekend, sunday.quarter) == ("Sun", True, 1)
    assert not days.filter("full_date = date'2024-01-08'").first().is_weekend


def test_no_session_zone_dependence(spark):
    frame = spark.createDataFrame([("2024-03-10 01:59:30", "2024-03-10 03:00:30")], "a string, b string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = frame.select(
            d.minutes_between(d.try_timestamp("a"), d.try_timestamp("b")).alias("m")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.m == 61


def test_ratio_of_very_large_counts(rows):
    got = rows([(5_000_000_000, 10_000_000_000), (1, 10**13), (9 * 10**17, 10**18)], "a bigint, b bigint").select(
        d.percent(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r.p for r in got] == [50.0, 0.0, 90.0]


def test_numbers_dates_and_epochs_beyond_their_types(rows):
    got = rows([("3000000000", "2024-01-1 ", "9000000000000000000000")], "n string, day string, t string").select(
        d.try_number("n").alias("n"), d.try_date("day").alias("day"), d.try_timestamp("t", epoch=True).alias("t")).first()
    assert (int(got.n), got.day, got.t) == (3_000_000_000, None, None)
