"""RAW schemas: every field is text, in file order."""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: the columns of the landing files
RAW_COLUMNS = {
    "guests": (
        "guest_id", "name", "dob", "gender", "email", "phone", "address", "city",
        "country", "loyalty_tier", "registration_date",
    ),
    "reservations": (
        "reservation_id", "guest_id", "room_id", "check_in_date", "check_out_date",
        "booking_channel", "booking_time", "cancellation_time", "status",
    ),
    "rooms": (
        "room_id", "hotel_id", "room_type", "floor", "capacity", "amenities", "status",
        "base_price",
    ),
    "housekeeping": (
        "task_id", "room_id", "task_type", "assigned_staff", "scheduled_time", "start_time",
        "end_time", "issue_detected_flag", "status",
    ),
    "billing": (
        "bill_id", "reservation_id", "guest_id", "total_amount", "taxes", "discounts",
        "payment_mode", "payment_time", "is_flagged",
    ),
}


def raw_schema(domain: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[domain]])


RAW_SCHEMAS = {domain: raw_schema(domain) for domain in RAW_COLUMNS}
