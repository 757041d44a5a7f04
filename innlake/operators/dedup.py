"""One row per natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """Keep the first row of each key; ties break on the remaining columns.

    The rank filter lets Spark cut each key to one row per map task before the
    shuffle, so a key holding a large share of all rows costs no more than
    any other after it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*(order or ()), *rest)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], arrival: Sequence[str] = ()
) -> DataFrame:
    """Keep the row that arrived last, going by the ``arrival`` columns."""
    return first_per_key(df, key, [F.col(c).desc_nulls_last() for c in arrival])
