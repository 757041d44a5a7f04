"""Audit: referential exceptions, rejected rows, load log."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from innlake import constants as k
from innlake.functions.dialect import has_key
from innlake.operators.joins import not_in
from innlake.operators.scd2 import instant
from innlake.operators.surrogate import with_surrogate_key
from innlake.plans.domains import DOMAINS
from innlake.plans.validate import rejection, winners

Frames = Mapping[str, DataFrame]

EXCEPTION_COLUMNS = ("domain", "natural_key", "error_type", "error_detail")
# duplicates unfolded from one counted row at a time
DUPLICATE_CHUNK = 100_000


def _spread(rows: DataFrame, total: int | None = None) -> int:
    """A stated number of partitions: chunks are tiny before they unfold, and adaptive execution would join them again.

    Where it is known how many rows they unfold to, no more than that asks for.
    """
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return most if total is None else min(most, 1 + total // DUPLICATE_CHUNK * 2)


def _exception(domain: str, key: Column, error_type: str, detail: Column) -> list[Column]:
    values = (F.lit(domain.upper()), key, F.lit(error_type), detail)
    return [value.alias(name) for name, value in zip(EXCEPTION_COLUMNS, values)]


def _orphans(domain: str, rows: DataFrame, parents: DataFrame, column: str, text: str) -> DataFrame:
    key = DOMAINS[domain].key
    lost = not_in(rows.select(key, column), parents, column)
    return lost.select(*_exception(domain, F.col(key), k.REF_INTEGRITY, F.lit(text)))


def reservation_guest_fk(reservations: DataFrame, guests: DataFrame) -> DataFrame:
    return _orphans("reservations", reservations, guests, "guest_id", k.GUEST_MISSING)


def housekeeping_room_fk(housekeeping: DataFrame, rooms: DataFrame) -> DataFrame:
    return _orphans("housekeeping", housekeeping, rooms, "room_id", k.ROOM_MISSING)


def reference_exceptions(valid: Frames) -> list[DataFrame]:
    """All five foreign keys."""
    guests, rooms, stays = valid["guests"], valid["rooms"], valid["reservations"]
    return [
        reservation_guest_fk(stays, guests),
        _orphans("reservations", stays, rooms, "room_id", k.ROOM_MISSING),
        housekeeping_room_fk(valid["housekeeping"], rooms),
        _orphans("billing", valid["billing"], stays, "reservation_id", k.RESERVATION_MISSING),
        _orphans("billing", valid["billing"], guests, "guest_id", k.GUEST_MISSING),
    ]


def duplicate_exceptions(domain: str, raw: DataFrame) -> DataFrame:
    """One exception per row that lost against another row of its key.

    Keys are counted with partial aggregation and the losers unfolded from the
    counts in chunks spread over the cluster, so copies of one key never meet
    in a single task.
    """
    key = DOMAINS[domain].key
    return losers(domain, raw.filter(has_key(key)).groupBy(key).agg(F.count(F.lit(1)).alias("copies")))


def losers(domain: str, counted: DataFrame, total: int | None = None) -> DataFrame:
    """The exceptions of keys with ``copies`` rows, all but the first of each."""
    key = DOMAINS[domain].key
    chunked = (
        counted.filter("copies > 1")
        .withColumn("chunk", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.floor((F.col("copies") - 2) / DUPLICATE_CHUNK)
        )))
        .repartition(_spread(counted, total), F.col(key), F.col("chunk"))
    )
    first = F.col("chunk") * DUPLICATE_CHUNK + 2
    last = F.least(F.col("copies"), first + DUPLICATE_CHUNK - 1)
    lost = chunked.withColumn("copy", F.explode(F.sequence(first, last)))
    detail = F.concat(
        F.lit("copy "), F.col("copy").cast("string"), F.lit(" of "), F.col("copies").cast("string"),
        F.lit(f" for {key}"),
    )
    return lost.select(*_exception(domain, F.col(key), k.DEDUP, detail))


def counted_fates(domain: str, rows: DataFrame) -> DataFrame:
    """Judged rows of change batches that were rejected or have copies, counted by batch, key and error."""
    counted = rows.groupBy("batch_id", DOMAINS[domain].key, "error_type", "error_detail").agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter("error_type is not null or copies > 1")


def merge_loads(domain: str, rows: DataFrame, fates: DataFrame) -> DataFrame:
    """Total, merged and failed rows of each change batch; of the rows of one key that may be merged one counts as merged."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    failed = F.col("copies") - F.when(F.col("error_type").isNull(), one).otherwise(none)
    counted = rows.select("batch_id", one.alias("total_rows"), one.alias("passed_rows")).unionByName(
        fates.select("batch_id", none.alias("total_rows"), (-failed).alias("passed_rows")))
    lines = counted.groupBy("batch_id").agg(F.sum("total_rows").alias("total_rows"), F.sum("passed_rows").alias("passed_rows"))
    return _with_failed(lines.withColumn("domain", F.lit(domain.upper())))


def merge_exceptions(domain: str, fates: DataFrame, total: int | None = None) -> DataFrame:
    """Rows of change batches that were rejected or lost as copies, equal ones counted in ``copies``."""
    key = DOMAINS[domain].key
    bad = fates.filter("error_type is not null").select(
        F.lit(domain.upper()).alias("domain"), F.col(key).alias("natural_key"), "error_type", "error_detail", "copies")
    lost = losers(domain, fates.filter("error_type is null"), total).withColumn("copies", F.lit(1).cast("bigint"))
    return bad.unionByName(lost)


def rule_exceptions(domain: str, raw: DataFrame, epoch: bool = False) -> DataFrame:
    """Deduplicated rows the batch rule rejects."""
    spec = DOMAINS[domain]
    error_type, text = rejection(domain)
    passed = F.coalesce(spec.batch_rule(), F.lit(False))
    return winners(domain, raw, epoch).filter(~passed).select(
        *_exception(domain, F.col(spec.key), error_type, text)
    )


def keyless_exceptions(domain: str, raw: DataFrame) -> DataFrame:
    """Rows without a usable key."""
    key = DOMAINS[domain].key
    return raw.filter(~has_key(key)).select(
        *_exception(domain, F.col(key), k.VALUE, F.lit(f"{key} missing"))
    )


def all_exceptions(raw: Frames, valid: Frames, epoch: Collection[str] = ()) -> list[DataFrame]:
    """Every check as a frame of its own; ``epoch`` names the domains whose times may be digits."""
    checks = reference_exceptions(valid)
    for domain in DOMAINS:
        checks += [
            keyless_exceptions(domain, raw[domain]),
            duplicate_exceptions(domain, raw[domain]),
            rule_exceptions(domain, raw[domain], domain in epoch),
        ]
    return checks


def exception_log(exceptions: DataFrame, as_of: datetime, after: Column | int = 0, total: int | None = None) -> DataFrame:
    """Exceptions with a dense number each.

    Equal exceptions are counted before they are numbered and unfolded in chunks
    afterwards, so any number of rows without a key never meets in one task. A column
    ``copies`` says how many a row stands for; ``total`` is the number of exceptions, where that is known.
    """
    rows = F.sum("copies") if "copies" in exceptions.columns else F.count(F.lit(1))
    counted = exceptions.groupBy(*EXCEPTION_COLUMNS).agg(rows.alias("copies"))
    numbered = with_surrogate_key(counted, "first_id", EXCEPTION_COLUMNS, after, copies="copies")
    chunked = numbered.withColumn("chunk", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / DUPLICATE_CHUNK)
    ))).repartition(_spread(exceptions, total), F.col("first_id"), F.col("chunk"))
    first = F.col("chunk") * DUPLICATE_CHUNK
    last = F.least(F.col("copies"), first + DUPLICATE_CHUNK) - 1
    unfolded = chunked.withColumn("copy", F.explode(F.sequence(first, last)))
    return unfolded.select(
        (F.col("first_id") + F.col("copy")).alias("exception_id"), *EXCEPTION_COLUMNS, instant(as_of).alias("logged_at")
    )


def load_counts(raw: Frames, valid: Frames) -> DataFrame:
    """Total, passed and failed rows; a domain without rows has its line too."""
    def one(domain: str) -> DataFrame:
        marked = raw[domain].select(F.lit(False).alias("passed")).unionByName(
            valid[domain].select(F.lit(True).alias("passed"))
        )
        return marked.agg(
            F.count_if(~F.col("passed")).alias("total_rows"),
            F.count_if(F.col("passed")).alias("passed_rows"),
        ).select(F.lit(domain.upper()).alias("domain"), "*")

    return _with_failed(reduce(DataFrame.unionByName, [one(domain) for domain in DOMAINS]))


def _with_failed(counted: DataFrame) -> DataFrame:
    failed = F.col("total_rows") - F.col("passed_rows")
    return counted.withColumn("failed_rows", failed).withColumn(
        "error_detail",
        F.when(failed > 0, F.concat(failed.cast("string"), F.lit(" rows rejected"))),
    )


LOAD_COLUMNS = ("log_id", "domain", "total_rows", "passed_rows", "failed_rows", "error_detail", "batch_ts")


def load_log(
    raw: Frames, valid: Frames, as_of: datetime, after: Column | int = 0
) -> DataFrame:
    return numbered_loads(load_counts(raw, valid), "domain", as_of, after)


def numbered_loads(lines: DataFrame, key: str, as_of: datetime, after: Column | int = 0) -> DataFrame:
    numbered = with_surrogate_key(lines, "log_id", [key], after)
    return numbered.withColumn("batch_ts", instant(as_of)).select(*LOAD_COLUMNS)
