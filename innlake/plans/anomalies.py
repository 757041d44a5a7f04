"""Anomaly rules: each returns (rule_name, entity_id, details)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from innlake import constants as k
from innlake.functions.dialect import day_number, hours_between
from innlake.operators.joins import splittable_join
from innlake.operators.scd2 import instant
from innlake.operators.surrogate import with_surrogate_key

# Bins of the overlap join are 8, 64, 512, .. days wide; a stay goes to the first width that holds its nights.
BIN_BITS = 3


def _finding(rule: str, entity: Column, details: Column) -> list[Column]:
    return [
        F.lit(rule).alias("rule_name"),
        entity.cast("string").alias("entity_id"),
        details.alias("details"),
    ]


def clashing_pairs(stays: DataFrame) -> DataFrame:
    """Pairs of stays in one room that share a night, each pair once.

    Of two overlapping stays the later one starts inside the earlier one. So a
    stay is listed under the one or two bins of days it covers, at the width that fits
    its nights, and looked up under the bin of its own first day at every width that occurs: the
    pair meets exactly once, and a stay meets only those near it in time, near in terms of the listed stay's
    length, however many one room has.
    """
    stay = stays.select(
        "room_sk", "reservation_id",
        day_number(F.col("check_in_date_sk")).alias("first_day"),
        day_number(F.col("check_out_date_sk")).alias("end_day"),
    ).filter(F.col("room_sk").isNotNull() & (F.col("end_day") > F.col("first_day")))

    bits = F.length(F.bin(F.col("end_day") - F.col("first_day") - 1))
    power = F.greatest(F.lit(1), F.ceil(bits / BIN_BITS)) * BIN_BITS
    stay = stay.withColumn("width", F.pow(F.lit(2), power).cast("bigint"))
    listed = stay.select(
        "room_sk", "width",
        F.col("reservation_id").alias("early_id"),
        F.col("first_day").alias("early_first"),
        F.col("end_day").alias("early_end"),
        F.explode(F.sequence(
            F.floor(F.col("first_day") / F.col("width")),
            F.floor((F.col("end_day") - 1) / F.col("width")),
        )).alias("bin"),
    )
    widths = stay.agg(F.collect_set("width")).scalar()
    probing = stay.select(
        "room_sk",
        F.explode(widths).alias("width"),
        F.col("reservation_id").alias("late_id"),
        F.col("first_day").alias("late_first"),
    ).withColumn("bin", F.floor(F.col("late_first") / F.col("width")))

    starts_inside = (F.col("late_first") >= F.col("early_first")) & (
        F.col("late_first") < F.col("early_end")
    )
    one_way = (F.col("late_first") > F.col("early_first")) | (F.col("early_id") < F.col("late_id"))
    return (
        listed.join(probing, ["room_sk", "width", "bin"])
        .filter(starts_inside & one_way & (F.col("early_id") != F.col("late_id")))
        .select("room_sk", "early_id", "late_id")
    )


def double_booking(stays: DataFrame) -> DataFrame:
    """Overlapping stays that are not cancelled; a clash is reported from both sides."""
    pairs = clashing_pairs(stays.filter(~F.col("is_cancelled")))
    sides = pairs.select("room_sk", F.explode(F.array(
        F.struct(F.col("early_id").alias("id"), F.col("late_id").alias("other")),
        F.struct(F.col("late_id").alias("id"), F.col("early_id").alias("other")),
    )).alias("side"))
    details = F.concat(
        F.lit("Overlaps with "), F.col("side.other"), F.lit(" on room_sk "),
        F.col("room_sk").cast("string"),
    )
    return sides.select(*_finding(k.DOUBLE_BOOKING, F.col("side.id"), details))


def hk_sla_breach(tasks: DataFrame) -> DataFrame:
    late = tasks.filter(
        (F.col("task_type") == k.CLEANING)
        & (F.col("status") == k.COMPLETED)
        & (F.col("duration_minutes") > k.SLA_MINUTES)
    )
    details = F.concat(
        F.lit("Cleaning took "), F.col("duration_minutes").cast("string"),
        F.lit(f" mins (SLA: {k.SLA_MINUTES} mins)"),
    )
    return late.select(*_finding(k.HK_SLA_BREACH, F.col("task_id"), details))


def _issues(tasks: DataFrame) -> DataFrame:
    return tasks.filter(F.col("issue_detected_flag") & (F.col("status") == k.COMPLETED))


def maintenance_overdue(tasks: DataFrame, as_of: datetime) -> DataFrame:
    """Completed tasks with an issue that ended more than 24 hours before ``as_of``."""
    age = hours_between(F.col("end_time"), instant(as_of))
    overdue = _issues(tasks).filter(age > k.OVERDUE_HOURS)
    return overdue.select(*_finding(k.MAINTENANCE_OVERDUE, F.col("task_id"), _overdue_text(age)))


def _overdue_text(age: Column) -> Column:
    return F.concat(F.lit("Issue unresolved — overdue by "), age.cast("string"), F.lit("h"))


def maintenance_without_followup(tasks: DataFrame, as_of: datetime) -> DataFrame:
    """Overdue issues with no maintenance start in their room in the next 24 hours.

    A start belongs to its own day and the day before, an issue to the day it
    ended; the join keys room and day spread even a single busy room.
    """
    end = F.col("end_time")
    age = hours_between(end, instant(as_of))
    issues = _issues(tasks).filter(age > k.OVERDUE_HOURS).withColumn("day", F.unix_date(end.cast("date")))
    started = F.unix_date(F.col("follow_up").cast("date"))
    follow_ups = (
        tasks.filter((F.col("task_type") == k.MAINTENANCE) & F.col("start_time").isNotNull())
        .select("room_sk", F.col("start_time").alias("follow_up"))
        .distinct()
        .withColumn("day", F.explode(F.array(started, started - 1)))
        .select(F.col("room_sk").alias("f_room"), F.col("day").alias("f_day"), "follow_up")
    )
    answered = (
        (F.col("room_sk") == F.col("f_room"))
        & (F.col("day") == F.col("f_day"))
        & (F.col("follow_up") >= end)
        & (F.col("follow_up") <= end + F.expr(f"INTERVAL '{k.OVERDUE_HOURS}' HOUR"))
    )
    open_issues = issues.join(follow_ups, answered, "left_anti")
    return open_issues.select(*_finding(k.MAINTENANCE_OVERDUE, F.col("task_id"), _overdue_text(age)))


def billing_mismatch(bills: DataFrame, stays: DataFrame, dim_room: DataFrame) -> DataFrame:
    """Billed amount away from price × nights + taxes − discounts by more than 10."""
    nights = stays.select("reservation_id", "room_sk", "length_of_stay")
    prices = dim_room.filter("is_current").select("room_sk", "base_price")
    priced = nights.join(prices, "room_sk").select(
        "reservation_id",
        (F.col("base_price") * F.col("length_of_stay").cast("decimal(8,0)")).alias("room_total"),
    )
    expected = (F.col("room_total") + F.col("taxes") - F.col("discounts")).cast("decimal(20,2)")
    compared = splittable_join(bills, priced, "reservation_id").withColumn("expected", expected)
    off = compared.filter(F.abs(F.col("total_amount") - F.col("expected")) > k.BILLING_TOLERANCE)
    details = F.concat(
        F.lit("Billed $"), F.col("total_amount").cast("string"),
        F.lit(" vs expected $"), F.col("expected").cast("string"),
    )
    return off.select(*_finding(k.BILLING_MISMATCH, F.col("bill_id"), details))


def _cancellations(stays: DataFrame) -> DataFrame:
    return stays.filter(F.col("is_cancelled") & F.col("cancellation_time").isNotNull())


def _cancellation_findings(counted: DataFrame) -> DataFrame:
    details = F.concat(
        F.col("cnt").cast("string"), F.lit(f" cancellations within {k.CANCELLATION_HOURS}h")
    )
    return counted.select(*_finding(k.SUSPICIOUS_CANCELLATION, F.col("guest_sk"), details))


def suspicious_cancellation(stays: DataFrame) -> DataFrame:
    """Guests with more than three cancellations, all of them within 24 hours.

    Guests without a dimension row form one group with a NULL entity.
    """
    time = F.col("cancellation_time")
    per_guest = _cancellations(stays).groupBy("guest_sk").agg(
        F.count(F.lit(1)).alias("cnt"), F.min(time).alias("first"), F.max(time).alias("last")
    )
    span = hours_between(F.col("first"), F.col("last"))
    return _cancellation_findings(
        per_guest.filter((F.col("cnt") > k.CANCELLATION_LIMIT) & (span <= k.CANCELLATION_HOURS))
    )


def cancellation_sliding(stays: DataFrame) -> DataFrame:
    """Guests with more than three cancellations in any rolling 24 hours.

    Equal times are counted first. A window reaching back one day lies in the
    day of its last event and the day before, so events are also listed under
    the next day and the window runs per guest and day: no guest's history, nor
    the group of unknown guests, is ever sorted as a whole.
    """
    time = F.col("cancellation_time")
    per_moment = _cancellations(stays).groupBy("guest_sk", "cancellation_time").agg(
        F.count(F.lit(1)).alias("n")
    )
    day = F.unix_date(time.cast("date"))
    listed = per_moment.withColumn("own_day", day).withColumn(
        "day", F.explode(F.array(day, day + 1))
    )
    span = (
        f"sum(n) over (partition by guest_sk, day order by cancellation_time "
        f"range between interval {k.CANCELLATION_HOURS} hours preceding and current row)"
    )
    per_guest = (
        listed.withColumn("recent", F.expr(span))
        .filter(F.col("day") == F.col("own_day"))
        .groupBy("guest_sk")
        .agg(F.max("recent").alias("cnt"))
        .filter(F.col("cnt") > k.CANCELLATION_LIMIT)
    )
    return _cancellation_findings(per_guest)


def all_findings(
    stays: DataFrame, tasks: DataFrame, bills: DataFrame, dim_room: DataFrame, as_of: datetime
) -> list[DataFrame]:
    """The five rules, each as a frame of its own."""
    return [
        double_booking(stays),
        hk_sla_breach(tasks),
        maintenance_overdue(tasks, as_of),
        billing_mismatch(bills, stays, dim_room),
        suspicious_cancellation(stays),
    ]


def anomaly_log(findings: DataFrame, as_of: datetime, after: Column | int = 0) -> DataFrame:
    """Findings as log rows: numbered and stamped."""
    numbered = with_surrogate_key(
        findings, "anomaly_id", ["rule_name", "entity_id", "details"], after
    )
    return numbered.withColumn("detected_at", instant(as_of))
