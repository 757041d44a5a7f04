"""Versioned dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from innlake.operators.surrogate import next_key, with_surrogate_key
from innlake.sources.tables import settle

VALIDITY = ("effective_from", "effective_to", "is_current")


def instant(as_of: datetime) -> Column:
    """A wall-clock moment as a zone-less literal."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def initial_versions(
    rows: DataFrame, sk: str, key: str, columns: Sequence[str], as_of: datetime
) -> DataFrame:
    """First load: every row is the current version of its key."""
    return with_surrogate_key(rows.select(*columns), sk, [key]).select(
        sk, *columns,
        instant(as_of).alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def apply_snapshot(
    dim: DataFrame, snapshot: DataFrame, sk: str, key: str, tracked: Sequence[str], as_of: datetime
) -> DataFrame:
    """Bring a dimension up to a snapshot.

    A changed tracked column closes the current version at ``as_of`` and opens
    a new one; other columns are overwritten on the current version. Intervals
    are half-open, keys missing from the snapshot stay as they are, and the
    same snapshot twice changes nothing.
    """
    columns = [c for c in dim.columns if c not in (sk, *VALIDITY)]
    values = [c for c in columns if c != key]
    current = dim.filter("is_current").withColumn("_known", F.lit(True))
    fresh = snapshot.select(
        F.col(key), *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_seen")
    )
    paired = settle(current.join(fresh, key, "full_outer"), "paired")  # read three times below

    known, seen = F.col("_known").isNotNull(), F.col("_seen").isNotNull()
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    closes = known & seen & changed
    opens = seen & (~known | changed)
    refresh = known & seen & ~changed

    now = instant(as_of)
    standing = paired.filter(known).select(
        F.col(sk), F.col(key),
        *[
            F.col(c) if c in tracked
            else F.when(refresh, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            for c in values
        ],
        "effective_from",
        F.when(closes, now).alias("effective_to"),
        (~closes).alias("is_current"),
    )
    opened = with_surrogate_key(
        paired.filter(opens).select(key, *[F.col(f"_new_{c}").alias(c) for c in values]),
        sk, [key], next_key(dim, sk),
    ).select(
        "*",
        now.alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    order = dim.columns
    history = dim.filter("not is_current")
    return (
        history.select(*order)
        .unionByName(standing.select(*order))
        .unionByName(opened.select(*order))
    )


def apply_feed(
    dim: DataFrame, feed: DataFrame, sk: str, key: str, tracked: Sequence[str], at: str = "changed_at"
) -> DataFrame:
    """Bring a dimension up to an ordered change feed.

    Every feed row says what a key looked like from ``at`` on. Where a tracked column differs from what
    held before, a version begins, so several changes of a key in one run become several
    versions; rows that change no tracked column overwrite the others on the version they fall in. A row older than the
    newest version splits the interval it falls in and holds up to the next version, which begins earlier if it says the
    same; what an earlier run merely confirmed is not kept.
    Existing versions keep their surrogate key, keys without feed rows stay as they are, and a feed applied twice changes nothing.

    What held before a row is found by hours of a key, so a key with very many feed rows is not ordered as a whole; only
    its versions are.
    """
    columns = [c for c in dim.columns if c not in (sk, *VALIDITY)]
    values = [c for c in columns if c != key]
    others = [c for c in values if c not in tracked]
    feed = feed.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        key, *[F.col(c).cast(dim.schema[c].dataType).alias(c) for c in values], F.col(at).cast("timestamp_ntz").alias("effective_from"), F.lit(None).cast("bigint").alias(sk))
    fed = settle(feed.dropDuplicates(), "feed")
    keys = fed.select(key).distinct()
    versions = dim.select(key, *values, "effective_from", F.col(sk).cast("bigint").alias(sk)).join(keys, key, "left_semi")
    events = versions.unionByName(fed).withColumns({
        "_hour": F.date_trunc("hour", "effective_from"),
        "_state": F.struct(*tracked),
        # at one moment a version comes before feed rows, these in order of their content
        "_order": F.struct("effective_from", F.col(sk).isNull().alias("fed"), *values),
    })
    events = settle(events, "events")

    ends = events.groupBy(key, "_hour").agg(F.max_by("_state", "_order").alias("_end"))
    ends = ends.select(key, "_hour", F.lag("_end").over(Window.partitionBy(key).orderBy("_hour")).alias("_hour_before"))
    inside = Window.partitionBy(key, "_hour").orderBy("_order")
    before = F.when(F.row_number().over(inside) == 1, F.col("_hour_before")).otherwise(F.lag("_state").over(inside))
    ordered = events.join(ends, [key, "_hour"]).withColumn("_before", before)
    starts = F.col("_before").isNull() | (F.col("_before") != F.col("_state"))
    marked = settle(ordered.withColumn("_starts", starts), "marked")

    # feed rows that change no tracked column: only the last one between two version events matters
    begins = marked.filter(F.col("_starts") | F.col(sk).isNotNull()).select(key, *values, "effective_from", sk, "_starts", "_order")
    run = F.sum(F.col("_starts").cast("int")).over(Window.partitionBy(key).orderBy("_order"))
    begins = begins.withColumn("_run", run)
    built = begins.groupBy(key, "_run").agg(
        F.min("effective_from").alias("effective_from"), F.max(sk).alias(sk), F.min("_order").alias("_first"),
        *[F.min_by(c, "_order").alias(c) for c in tracked], F.max_by(F.struct(*others), "_order").alias("_others"),
        F.max("_order").alias("_last"))
    following = Window.partitionBy(key).orderBy("_run")
    built = built.withColumns({"effective_to": F.lead("effective_from").over(following), "_next": F.lead("_first").over(following)})
    quiet = marked.filter(~F.col("_starts") & F.col(sk).isNull()).select(
        F.col(key), F.struct(*others).alias("_new"), F.col("_order").alias("_at"))
    latest = built.select(key, "_run", "_first", "_next", "_last").join(quiet, key).filter(
        (F.col("_at") > F.col("_first")) & (F.col("_next").isNull() | (F.col("_at") < F.col("_next"))) & (F.col("_at") > F.col("_last"))
    ).groupBy(key, "_run").agg(F.max_by("_new", "_at").alias("_new"))
    built = settle(built.join(latest, [key, "_run"], "left").withColumn("_others", F.coalesce("_new", "_others")), "versions")
    shown = lambda df: df.select(
        F.col(sk), key, *[F.col(c) if c in tracked else F.col(f"_others.{c}").alias(c) for c in values],
        "effective_from", "effective_to", F.col("effective_to").isNull().alias("is_current"))
    fresh = with_surrogate_key(built.filter(F.col(sk).isNull()).drop(sk), sk, [key, "effective_from"], next_key(dim, sk))
    standing = dim.join(keys, key, "left_anti").select(*dim.columns)
    return standing.unionByName(shown(built.filter(F.col(sk).isNotNull())).select(*dim.columns)).unionByName(shown(fresh).select(*dim.columns))
