"""Dense surrogate keys without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SEPARATOR = "|"
# three hexadecimal digits of the hash: 4096 buckets, whatever the data size
BUCKET_DIGITS = 3


def with_surrogate_key(
    df: DataFrame, name: str, keys: Sequence[str], after: Column | int = 0, copies: str | None = None
) -> DataFrame:
    """Number the rows ``after + 1, after + 2, …`` in order of the key's hash.

    The result equals ``row_number() over (order by md5(key), key)`` but never
    sorts in one task: rows are ranked inside hash buckets, evenly filled
    because the keys are unique, and shifted by the size of the buckets before.
    The bucket table has at most 4096 rows, which bounds both the running sum
    and the broadcast. Nothing is sampled or persisted, so a lost executor
    cannot change a key. ``copies`` names a column that says how many rows a row
    stands for; its number is then the first of as many.
    """
    size = F.lit(1).cast("bigint") if copies is None else F.col(copies)
    text = F.concat_ws(SEPARATOR, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    hashed = df.withColumn("_hash", F.md5(text)).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_DIGITS)
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy("_bucket")
        .agg(F.sum(size).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_bucket").orderBy("_hash", *keys)
    base = F.lit(after) if isinstance(after, int) else after
    return (
        hashed.withColumn("_position", _first_number(inside, copies))
        .join(F.broadcast(starts), "_bucket")
        .select(
            (base + F.col("_start") + F.col("_position")).cast("bigint").alias(name), *df.columns
        )
    )


def _first_number(inside, copies: str | None) -> Column:
    if copies is None:
        return F.row_number().over(inside)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(copies).over(earlier), F.lit(0)) + 1


def next_key(df: DataFrame, name: str) -> Column:
    """Largest key so far (0 for none), as a scalar subquery."""
    return F.coalesce(df.agg(F.max(name)).scalar(), F.lit(0))
