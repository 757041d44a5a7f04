"""Change batches as Spark derives them from the RAW feeds.

Every feed is delivered again twice with other values, and once more under new
keys, so a merge sees matched rows, late arrivals and inserts over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

ARRIVAL = "arrival"
NEW_KEY_SUFFIX = "-N"

Overrides = Mapping[str, Callable[[], Column]]


def _nothing() -> Column:
    return F.lit(None).cast("string")


FIRST: dict[str, Overrides] = {
    "guests": {"loyalty_tier": lambda: F.lit("Platinum")},
    "reservations": {
        "status": lambda: F.lit(" CANCELLED"),
        "cancellation_time": lambda: F.concat("check_out_date", F.lit(" 08:00:00")),
    },
    "rooms": {"status": lambda: F.lit("under repair"), "base_price": lambda: F.lit("-7")},
    "housekeeping": {"status": lambda: F.lit("completed"), "end_time": _nothing},
    "billing": {"is_flagged": lambda: F.lit("Y")},
}
SECOND: dict[str, Overrides] = {
    "guests": {
        "loyalty_tier": lambda: F.lit("Diamond"),
        "email": lambda: F.concat(F.lit("new."), "email"),
    },
    "reservations": {"status": lambda: F.lit("checked-in"), "cancellation_time": _nothing},
    "rooms": {"status": lambda: F.lit("AVAILABLE"), "base_price": lambda: F.lit("99.99")},
    "housekeeping": {
        "status": lambda: F.lit("re-opened"),
        "end_time": lambda: F.col("start_time"),
    },
    "billing": {"is_flagged": lambda: F.lit("n")},
}


def change_batch(domain: str, key: str, raw: DataFrame) -> DataFrame:
    """RAW columns plus ``arrival``."""
    def delivery(arrival: int, overrides: Overrides) -> DataFrame:
        return raw.select(
            *[overrides[c]().alias(c) if c in overrides else F.col(c) for c in raw.columns],
            F.lit(arrival).alias(ARRIVAL),
        )

    renamed = {key: lambda: F.concat(key, F.lit(NEW_KEY_SUFFIX))}
    return reduce(DataFrame.unionByName, [
        delivery(1, FIRST[domain]), delivery(2, SECOND[domain]), delivery(2, renamed),
    ])
