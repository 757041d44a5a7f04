"""What each domain casts, accepts and updates, declared once.

The batch load and the incremental merge share the projection and differ in
their rule: the merge rules are the looser ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from innlake.constants import EMAIL_LIKE
from innlake.functions import dialect as d

Rule = Callable[[], Column]


@dataclass(frozen=True)
class Domain:
    name: str
    key: str
    columns: Callable[..., list[Column]]  # epoch=True also reads times written as digits
    batch_rule: Rule
    merge_rule: Rule
    merge_updates: tuple[str, ...]


def _as(expression: Column, name: str) -> Column:
    return expression.alias(name)


def _guest_columns(epoch: bool = False) -> list[Column]:
    return [
        F.col("guest_id"), F.col("name"), _as(d.try_date("dob"), "dob"), F.col("gender"),
        F.col("email"), F.col("phone"), F.col("address"), F.col("city"), F.col("country"),
        F.col("loyalty_tier"), _as(d.try_date("registration_date"), "registration_date"),
    ]


def _reservation_columns(epoch: bool = False) -> list[Column]:
    return [
        F.col("reservation_id"), F.col("guest_id"), F.col("room_id"),
        *[_as(d.try_date(c), c) for c in ("check_in_date", "check_out_date")],
        F.col("booking_channel"),
        *[_as(d.try_timestamp(c, epoch), c) for c in ("booking_time", "cancellation_time")],
        _as(d.init_cap(F.trim("status")), "status"),
    ]


def _room_columns(epoch: bool = False) -> list[Column]:
    return [
        F.col("room_id"), F.col("hotel_id"), F.col("room_type"),
        *[_as(d.try_number(c), c) for c in ("floor", "capacity")],
        F.col("amenities"),
        _as(d.init_cap(F.trim("status")), "status"),
        _as(d.try_decimal("base_price", 10, 2), "base_price"),
    ]


def _housekeeping_columns(epoch: bool = False) -> list[Column]:
    return [
        F.col("task_id"), F.col("room_id"),
        _as(F.upper(F.trim("task_type")), "task_type"),
        F.col("assigned_staff"),
        *[_as(d.try_timestamp(c, epoch), c) for c in ("scheduled_time", "start_time", "end_time")],
        _as(d.flag("issue_detected_flag"), "issue_detected_flag"),
        _as(d.init_cap(F.trim("status")), "status"),
    ]


def _billing_columns(epoch: bool = False) -> list[Column]:
    return [
        F.col("bill_id"), F.col("reservation_id"), F.col("guest_id"),
        _as(d.try_decimal("total_amount", 12, 2), "total_amount"),
        *[_as(d.try_decimal(c, 10, 2), c) for c in ("taxes", "discounts")],
        F.col("payment_mode"),
        _as(d.try_timestamp("payment_time", epoch), "payment_time"),
        _as(d.flag("is_flagged"), "is_flagged"),
    ]


def _email_ok() -> Column:
    return F.col("email").like(EMAIL_LIKE)


def _stay_ok() -> Column:
    return F.col("check_out_date") > F.col("check_in_date")


def _finish_ok() -> Column:
    return F.col("end_time").isNull() | (F.col("end_time") >= F.col("start_time"))


DOMAINS = {
    domain.name: domain
    for domain in (
        Domain(
            "guests", "guest_id", _guest_columns, _email_ok, _email_ok, ("loyalty_tier", "email")
        ),
        Domain(
            "reservations", "reservation_id", _reservation_columns, _stay_ok, _stay_ok,
            ("status", "cancellation_time"),
        ),
        Domain(
            "rooms", "room_id", _room_columns,
            lambda: (F.col("capacity") > 0) & (F.col("base_price") >= 0),
            lambda: F.col("capacity") > 0,
            ("status", "base_price"),
        ),
        Domain(
            "housekeeping", "task_id", _housekeeping_columns, _finish_ok, lambda: F.lit(True),
            ("status", "end_time"),
        ),
        Domain(
            "billing", "bill_id", _billing_columns,
            lambda: (F.col("total_amount") >= 0) & (F.col("taxes") >= 0) & (F.col("discounts") >= 0),
            lambda: F.col("total_amount") >= 0,
            ("is_flagged",),
        ),
    )
}
