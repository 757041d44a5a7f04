"""Landing files to RAW, each file once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, functions as F

from innlake.operators.scd2 import instant
from innlake.sources import landing as lf, quoted
from innlake.sources.schemas import RAW_COLUMNS
from innlake.sources.tables import AUDIT, LakeStore

# files of one batch; a backfill of more takes several batches in the same run
FILES_PER_BATCH = 1000
# read tasks of a batch whose rows share a RAW file
TASKS_PER_FILE = 8
# bytes of a row group of RAW, so that readers may still split a file over tasks
ROW_GROUP = 16 * 1024 * 1024

Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def ingest(
    store: LakeStore,
    landing: str,
    domain: str,
    clock: Clock = utc_now,
    multiline: bool | str = True,
    max_files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Load every landing file not loaded before, then return.

    The first run is the backfill; later runs pick up new files only, and do
    nothing when there are none. A run takes everything in batches of
    ``max_files_per_batch`` files. A batch replaces its own RAW folder, so one
    repeated after a failure does not double its rows. ``multiline`` says whether quoted
    fields may hold line breaks: True reads a file in one task, ``"split"`` in a task per
    byte range.
    """
    spark, folder = store.spark, lf.folder(landing, domain)
    split = multiline == "split"
    if split:
        text = spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", max_files_per_batch)
        files = quoted.lines_of(text.text(folder))
    else:
        reader = spark.readStream.schema(lf.csv_schema(domain)).options(**lf.csv_options(bool(multiline)))
        files = lf.with_file(reader.option("maxFilesPerTrigger", max_files_per_batch).csv(folder))

    def land(batch: DataFrame, batch_id: int) -> None:
        # parsed once into the lake, in the form of RAW beside the mark of malformed records, which readers of RAW pass over:
        # where none is found the folder is moved into its place, else the good files' rows are written
        staged = store.path("staging", domain, f"batch_id={batch_id}")
        tasks = batch.rdd.getNumPartitions()
        if split:
            batch = quoted.parsed(quoted.records(batch), lf.csv_schema(domain), lf.csv_options(True))
        moment = clock()
        loaded_at = instant(moment).alias("_loaded_at")
        batch = lf.clean(batch, domain).select(*RAW_COLUMNS[domain], "_file", "_file_time", loaded_at, lf.CORRUPT)
        _gathered(batch, tasks).write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(staged)
        batch = spark.read.schema(batch.schema).parquet(staged)
        files = lf.counted_files(batch)
        refused = [file for file in files if file.bad_records]
        place = store.path("raw", domain, f"batch_id={batch_id}")
        if refused:
            listed = spark.createDataFrame([(f._file, f.bad_records) for f in refused], "_file string, bad_records long")
            listed.select("*", loaded_at).coalesce(1).write.mode("overwrite").parquet(
                store.path("audit", "refused_files", domain, f"batch_id={batch_id}")
            )
            good = lf.accepted_rows(batch, listed, len(refused))
            good.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(place)
            store.delete(staged)
        else:
            store.move(staged, place)
        _note_files(store, domain, batch_id, files, moment)

    query = (
        files.writeStream.foreachBatch(land)
        .option("checkpointLocation", store.path("checkpoints", "ingest", domain))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _gathered(batch: DataFrame, tasks: int) -> DataFrame:
    """Rows of many read tasks in fewer files: a merge takes RAW by files, and every epoch has costs of its own."""
    return batch if tasks < TASKS_PER_FILE else batch.repartition(max(2, -(-tasks // TASKS_PER_FILE)))


def _note_files(store: LakeStore, domain: str, batch_id: int, files: Sequence[Row], moment: datetime) -> None:
    """A line per file of a batch, kept by load day; a batch that is repeated has its lines in one day only."""
    lines = store.spark.createDataFrame([
        (f._file, "REFUSED", f.bad_records) if f.bad_records else (f._file, "LOADED", f.row_count) for f in files
    ], "file string, status string, row_count long")
    root, name, today = store.path(AUDIT, "files", domain), f"batch_id={batch_id}", f"load_day={moment:%Y-%m-%d}"
    lines.withColumn("loaded_at", instant(moment)).coalesce(1).write.mode("overwrite").parquet(f"{root}/{today}/{name}")
    for day in store.files(root):
        if day != today and name in store.files(f"{root}/{day}"):
            store.delete(f"{root}/{day}/{name}")


def load_history(store: LakeStore, domain: str, as_of: datetime, hours: int = 24) -> DataFrame:
    """Files loaded or refused in the last hours: file, status, rows, load time. Only the lines of these days are read."""
    root = store.path(AUDIT, "files", domain)
    since = as_of - timedelta(hours=hours)
    days = [d for d in store.files(root) if d >= f"load_day={since:%Y-%m-%d}"]
    schema = "file string, status string, row_count bigint, loaded_at timestamp_ntz"
    if not days:
        return store.spark.createDataFrame([], schema)
    rows = store.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f"{root}/{d}" for d in days])
    return rows.filter(F.col("loaded_at") >= instant(since))
