"""Joins whose safety does not depend on how the keys are spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def splittable_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` that adaptive execution can always split.

    A side that is already partitioned on the key (after a dedup, say) joins
    without an exchange of its own, and then a hot key cannot be split at run
    time. The key's hash as a second join column asks for a fresh exchange on
    both sides, which makes the skew handling applicable; small sides are still
    turned into broadcasts by their measured size.
    """
    tag = "_key_hash"
    joined = left.withColumn(tag, F.xxhash64(key)).join(
        right.withColumn(tag, F.xxhash64(key)), [key, tag], how
    )
    return joined.drop(tag)


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` for which ``key NOT IN (select key from right)`` is true.

    A NULL key qualifies only against an empty right side, and a NULL on the
    right side rules out every row. Written as a plain anti join plus one scalar
    look at the right side, because the built-in form always broadcasts it.
    """
    probe = right.agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls"))
    ).scalar()
    candidate: Column = (
        F.when(probe["rows"] == 0, F.lit(True))
        .when(probe["nulls"] > 0, F.lit(False))
        .otherwise(F.col(key).isNotNull())
    )
    return splittable_join(left.filter(candidate), right.select(key), key, "left_anti")
