"""Results that pass through files and micro-batches, by name.

The feeds are written as CSV below the working folder, picked up by the
streaming loader and, for the incremental results, merged in three deliveries.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from innlake.functions.dialect import has_key
from innlake.operators.dedup import first_per_key
from innlake.plans import jobs
from innlake.plans.domains import DOMAINS
from innlake.session import working_folder
from innlake.sources import landing as lf
from innlake.sources.changes import ARRIVAL, change_batch
from innlake.sources.feeds import FEEDS
from innlake.sources.schemas import RAW_COLUMNS
from innlake.sources.tables import AUDIT, LakeStore, bounded, settle, side_by_side
from innlake.streaming import merge
from innlake.streaming.ingest import ingest, load_history


# rows of a compressed landing file, which one task reads as a whole
ROWS_PER_FILE = 500_000


def deliver(rows: DataFrame, landing: str, domain: str, **options) -> None:
    """Drop rows as CSV files into a landing folder, blanks and all."""
    rows.write.mode("append").options(
        header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        emptyValue="", escape='"', **options,
    ).csv(lf.folder(landing, domain))


def _start(spark: SparkSession, as_of: datetime):
    store = LakeStore(spark, working_folder(spark, "lake"), buckets=8)
    landing = store.path("landing")
    # the feeds hold no quoted line breaks, so files may be split over tasks
    take = lambda domain: ingest(store, landing, domain, lambda: as_of, multiline=False)
    return store, landing, take


def ingested(spark: SparkSession, sf_dir: str, domain: str, as_of: datetime) -> DataFrame:
    """RAW rows as the loader lands them."""
    store, landing, take = _start(spark, as_of)
    deliver(FEEDS[domain](spark, sf_dir, spread=True), landing, domain)
    take(domain)
    return store.raw(domain).select(*RAW_COLUMNS[domain])


def quoted(spark: SparkSession, sf_dir: str, domain: str, as_of: datetime, column: str) -> DataFrame:
    """RAW rows of a delivery in which every blank of a column is a line break, so most records take several lines."""
    store, landing, _ = _start(spark, as_of)
    rows = FEEDS[domain](spark, sf_dir, spread=True)
    broken = rows.withColumn(column, F.replace(F.trim(F.col(column)), F.lit(" "), F.lit("\n")))
    broken.write.mode("append").options(header="true", quoteAll="true", escape='"', emptyValue="", nullValue="").csv(lf.folder(landing, domain))
    ingest(store, landing, domain, lambda: as_of, multiline="split")
    return store.raw(domain).select(*RAW_COLUMNS[domain])


def _with_refused(spark: SparkSession, sf_dir: str, domain: str, as_of: datetime) -> LakeStore:
    """A loaded delivery that has one malformed file among the good ones."""
    store, landing, take = _start(spark, as_of)
    deliver(FEEDS[domain](spark, sf_dir, spread=True), landing, domain)
    bad = F.when(F.col("id") == 0, "header").otherwise("one,two")
    spark.range(2).coalesce(1).select(bad.alias("value")).write.mode("append").text(lf.folder(landing, domain))
    take(domain)
    return store


def beside_refused(spark: SparkSession, sf_dir: str, domain: str, as_of: datetime) -> DataFrame:
    """RAW rows of the good files of a delivery with a malformed one."""
    store = _with_refused(spark, sf_dir, domain, as_of)
    return store.raw(domain).select(*RAW_COLUMNS[domain])


def history(spark: SparkSession, sf_dir: str, domain: str, as_of: datetime) -> DataFrame:
    """Rows loaded and records refused in the last 24 hours."""
    files = load_history(_with_refused(spark, sf_dir, domain, as_of), domain, as_of)
    return files.groupBy("status").agg(F.sum("row_count").alias("row_count"))


def incremental(spark: SparkSession, sf_dir: str, domain: str, as_of: datetime, strict: bool = False) -> DataFrame:
    """VALIDATED after a full load and two merged deliveries."""
    store, landing, take = _start(spark, as_of)
    raw = FEEDS[domain](spark, sf_dir, spread=True)
    deliver(raw, landing, domain)
    take(domain)
    merge.load_base(store, domain)
    changes = change_batch(domain, DOMAINS[domain].key, raw)
    for arrival in (1, 2):
        deliver(changes.filter(F.col(ARRIVAL) == arrival).drop(ARRIVAL), landing, domain)
        take(domain)
        # which file a duplicate ends up in is chance here, so it must not decide
        merge.run_merge(store, domain, strict, arrival=(), as_of=as_of, files_per_epoch=2)
    return merge.validated(store, domain)


def by_file_time(spark: SparkSession, sf_dir: str, domain: str, as_of: datetime) -> DataFrame:
    """VALIDATED after a full load and one batch with two versions of every row, of which the later file's counts."""
    store, landing, take = _start(spark, as_of)
    raw, key = FEEDS[domain](spark, sf_dir, spread=True), DOMAINS[domain].key
    deliver(raw, landing, domain)
    take(domain)
    merge.load_base(store, domain)
    # read by each of the three deliveries
    changes = change_batch(domain, key, settle(first_per_key(raw.filter(has_key(key)), key), "versions"))
    for arrival in (1, 2):
        deliver(changes.filter(F.col(ARRIVAL) == arrival).drop(ARRIVAL), landing, domain)
    take(domain)
    merge.run_merge(store, domain, as_of=as_of)
    return merge.validated(store, domain)


@lru_cache(maxsize=4)
def run_lake(spark: SparkSession, sf_dir: str, as_of: datetime) -> LakeStore:
    """A lake after a full load and two hours with a delivery each, written by the scheduled jobs."""
    store, landing, take = _start(spark, as_of)
    raw = {domain: FEEDS[domain](spark, sf_dir) for domain in DOMAINS}  # side by side they fill the cores, whatever the files

    def bring(rows: DataFrame, domain: str) -> None:
        deliver(rows, landing, domain, compression="gzip", maxRecordsPerFile=ROWS_PER_FILE)
        take(domain)

    def change(domain: str, arrival: int) -> None:
        changes = change_batch(domain, DOMAINS[domain].key, raw[domain])
        bring(changes.filter(F.col(ARRIVAL) == arrival).drop(ARRIVAL), domain)

    with bounded(spark):
        side_by_side([lambda d=d: bring(raw[d], d) for d in DOMAINS])
        jobs.full_load(store, as_of)
        for arrival in (1, 2):
            side_by_side([lambda d=d: change(d, arrival) for d in DOMAINS], store.at_once())
            jobs.hourly_increment(store, as_of + timedelta(hours=arrival), arrival=())
    return store


def job_table(spark: SparkSession, sf_dir: str, table: str, as_of: datetime) -> DataFrame:
    """A CURATED table of that lake, without the column that says which part a row is in."""
    rows = jobs.curated(run_lake(spark, sf_dir, as_of), table)
    return rows.drop(jobs.FACTS[table].part) if table in jobs.FACTS else rows


@lru_cache(maxsize=4)
def daily_lake(spark: SparkSession, sf_dir: str, as_of: datetime) -> LakeStore:
    """The same lake after the daily job: anomalies logged, merges folded into new bases."""
    store = run_lake(spark, sf_dir, as_of)
    jobs.daily(store, as_of + timedelta(hours=2))
    return store


def job_anomalies(spark: SparkSession, sf_dir: str, as_of: datetime) -> DataFrame:
    return daily_lake(spark, sf_dir, as_of).log(jobs.CURATED, "anomaly_log")


def job_validated(spark: SparkSession, sf_dir: str, domain: str, as_of: datetime) -> DataFrame:
    """VALIDATED after two merges and their compaction."""
    return merge.validated(daily_lake(spark, sf_dir, as_of), domain)


def job_log(spark: SparkSession, sf_dir: str, table: str, as_of: datetime) -> DataFrame:
    return run_lake(spark, sf_dir, as_of).log(AUDIT, table)


def landed_files(spark: SparkSession, sf_dir: str, domain: str, as_of: datetime) -> DataFrame:
    """The landing folder's files as the listing sees them: how many there are, whether any is empty."""
    store, landing, _ = _start(spark, as_of)
    deliver(FEEDS[domain](spark, sf_dir).repartition(3), landing, domain)
    files = lf.list_files(spark, landing).filter(F.col("path").endswith(".csv"))
    return files.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") == 0).alias("empty_files"))
