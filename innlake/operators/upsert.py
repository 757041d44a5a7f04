"""Upserts on file-based tables, as joins and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def upsert(target: DataFrame, source: DataFrame, key: str, updates: Sequence[str]) -> DataFrame:
    """Matched rows take ``updates`` from the source, unmatched source rows are added.

    Both sides must be unique on ``key``. Presence markers, not NULL tests,
    decide which side a value comes from, so an update to NULL sticks.
    """
    columns = target.columns
    old = target.select(F.col(key), *[F.col(c).alias(f"_old_{c}") for c in columns if c != key],
                        F.lit(True).alias("_in_target"))
    new = source.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in columns if c != key],
                        F.lit(True).alias("_in_source"))

    def pick(c: str):
        if c == key:
            return F.col(key)
        prefer_new = F.col("_in_source") if c in updates else F.col("_in_target").isNull()
        return F.when(prefer_new, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c)

    return old.join(new, key, "full_outer").select(*[pick(c) for c in columns])


def upsert_small(target: DataFrame, source: DataFrame, key: str, updates: Sequence[str]) -> DataFrame:
    """Same result for a source far smaller than the target.

    The target is only ever the streamed side of outer and semi joins, so it is
    not shuffled when the source turns out small enough to broadcast.
    """
    columns = target.columns
    change = source.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in updates],
                           F.lit(True).alias("_in_source"))
    kept = target.join(change, key, "left").select(*[
        F.when(F.col("_in_source"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c in updates else F.col(c)
        for c in columns
    ])
    matched = target.select(key).join(source.select(key), key, "left_semi")
    added = source.join(matched, key, "left_anti").select(*columns)
    return kept.unionByName(added)


def fold(changes: DataFrame, key: str, updates: Sequence[str], order: str) -> DataFrame:
    """Result of applying upserts in sequence, as one aggregation.

    The earliest row of a key inserted it and so fixes all columns but
    ``updates``; the latest row holds the last update. ``order`` must be unique
    within a key.
    """
    fixed = [c for c in changes.columns if c not in (key, order, *updates)]
    folded = changes.groupBy(key).agg(
        F.min_by(F.struct(*fixed), order).alias("_first"),
        F.max_by(F.struct(*updates), order).alias("_last"),
    )
    return folded.select(*[
        F.col(key) if c == key
        else F.col(f"_last.{c}").alias(c) if c in updates
        else F.col(f"_first.{c}").alias(c)
        for c in changes.columns if c != order
    ])
