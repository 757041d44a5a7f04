"""RAW to VALIDATED: batch validation and incremental merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from innlake import constants as k
from innlake.functions.dialect import has_key
from innlake.operators.dedup import first_per_key, latest_per_key
from innlake.operators.upsert import upsert
from innlake.plans.domains import DOMAINS


def winners(domain: str, raw: DataFrame, epoch: bool = False) -> DataFrame:
    """One typed row per usable key, before any quality rule."""
    spec = DOMAINS[domain]
    return first_per_key(raw.filter(has_key(spec.key)), spec.key).select(*spec.columns(epoch))


def validate(domain: str, raw: DataFrame, epoch: bool = False) -> DataFrame:
    """Deduplicate, cast, then apply the quality rule. ``epoch`` also reads times written as digits.

    The rule comes after the dedup on purpose: a key whose first row is bad
    disappears even if another copy was good.
    """
    return winners(domain, raw, epoch).filter(DOMAINS[domain].batch_rule())


def merge_source(
    domain: str,
    changes: DataFrame,
    arrival: Sequence[str] = (),
    strict: bool = False,
    batch: Sequence[str] = (),
) -> DataFrame:
    """Rows of a change batch that may be merged, the last arrival per key.

    ``strict=True`` asks for the batch rules instead of the looser merge rules.
    Where ``changes`` holds several batches, ``batch`` names the columns that
    tell them apart, and each batch keeps a row per key.
    """
    spec = DOMAINS[domain]
    usable = has_key(spec.key) if strict else F.col(spec.key).isNotNull()
    rule = spec.batch_rule if strict else spec.merge_rule
    typed = changes.filter(usable).select(*spec.columns(), *arrival, *batch).filter(rule())
    return latest_per_key(typed, [spec.key, *batch], arrival)


def judged(domain: str, changes: DataFrame, kept: Sequence[str] = (), strict: bool = False, epoch: bool = False) -> DataFrame:
    """Every row of a change batch, typed, with ``error_type`` and ``error_detail``; both NULL where the row may be merged."""
    spec = DOMAINS[domain]
    usable = has_key(spec.key) if strict else F.col(spec.key).isNotNull()
    passed = F.coalesce((spec.batch_rule if strict else spec.merge_rule)(), F.lit(False))
    error_type, detail = rejection(domain)
    typed = changes.withColumn("_usable", usable).select(*spec.columns(epoch), *kept, "_usable")
    return typed.withColumns({
        "error_type": F.when(~F.col("_usable"), k.VALUE).when(~passed, error_type),
        "error_detail": F.when(~F.col("_usable"), f"{spec.key} missing").when(~passed, detail),
    }).drop("_usable")


def rejection(domain: str) -> tuple[str, Column]:
    """Error type and text of a row that fails a rule."""
    if domain == "guests":
        return k.VALUE, F.lit("email not valid")
    if domain == "reservations":
        return k.TEMPORAL, (
            F.when(F.col("check_in_date").isNull(), "check_in_date not a date")
            .when(F.col("check_out_date").isNull(), "check_out_date not a date")
            .otherwise("check_out_date not after check_in_date")
        )
    if domain == "rooms":
        return k.VALUE, (
            F.when(F.coalesce(F.col("capacity") > 0, F.lit(False)), "base_price not valid")
            .otherwise("capacity not valid")
        )
    if domain == "housekeeping":
        return k.TEMPORAL, F.lit("end_time before start_time")
    return k.VALUE, F.lit("amount not valid")


def merge(
    domain: str,
    target: DataFrame,
    changes: DataFrame,
    arrival: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """VALIDATED after one change batch."""
    spec = DOMAINS[domain]
    source = merge_source(domain, changes, arrival, strict).drop(*arrival)
    return upsert(target, source, spec.key, spec.merge_updates)
