"""RAW changes to VALIDATED, incrementally.

VALIDATED is a base plus the merge sources that came after it. A micro-batch
only appends its own source; nothing already written is read or replaced, so
its cost follows the size of the change and a repeated batch rewrites the same
folder. Base and sources are dealt to buckets by a hash of the key: readers upsert
into the buckets that later sources touch and take the others as they are, and
compaction writes only those anew.

Every change row is judged once. What may be merged becomes the source, what was
rejected or lost as a copy goes to the exceptions, and the counts to the load log.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Sequence
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F, types as T

from innlake.operators.dedup import latest_per_key
from innlake.operators.upsert import fold, upsert, upsert_small
from innlake.plans import quality
from innlake.plans.domains import DOMAINS
from innlake.plans.validate import judged, validate
from innlake.sources.schemas import RAW_COLUMNS
from innlake.sources.tables import AUDIT, LakeStore, side_by_side
from innlake.sources.versions import Versions
from innlake.streaming.ingest import utc_now

ARRIVAL = ("_file_time", "_file")
# files of RAW that one epoch of a merge reads; a long outage is made up for in several epochs
FILES_PER_EPOCH = 1000
BUCKET = "bucket"
# a hidden file beside a source: the RAW batches it has rows of
BATCHES = "_batches"
# sources of less than this part of the base are joined as small ones
SMALLER = 10
# bytes of base and sources that are worked on at a time: buckets do not need each other, and what is shuffled for them lies on disk
TURN = 128 * 1024 * 1024


def last_raw_batch(store: LakeStore, domain: str) -> int:
    """Highest committed RAW batch, -1 for none."""
    return max((int(v) for v in store.values("batch_id", "raw", domain)), default=-1)


def epochs(store: LakeStore, domain: str) -> list[int]:
    """Committed merge sources, in order."""
    return sorted(int(v) for v in store.values("epoch", "merged", domain))


def last_merge(store: LakeStore, domain: str) -> int:
    """Highest committed merge source, -1 for none."""
    return max(epochs(store, domain), default=-1)


# ---- base -------------------------------------------------------------------

def base_table(store: LakeStore, domain: str) -> Versions:
    """Bases by the last RAW batch they hold."""
    return Versions(store, "validated", domain, BUCKET)


def _version(upto: int) -> str:
    return f"{upto + 1:020d}"  # a base of no batch comes first


def base_upto(store: LakeStore, domain: str) -> int:
    """Last RAW batch of the newest base, -1 for none."""
    name = base_table(store, domain).latest()
    return -1 if name is None else int(name) - 1


def _bucket(store: LakeStore, domain: str) -> Column:
    return F.pmod(F.xxhash64(DOMAINS[domain].key), F.lit(store.buckets)).cast("int").alias(BUCKET)


def load_base(store: LakeStore, domain: str) -> DataFrame:
    """Full load: validate everything in RAW and write it as the base."""
    upto = last_raw_batch(store, domain)
    rows = store.raw(domain).filter(F.col("batch_id") <= upto).select(*RAW_COLUMNS[domain])
    valid = validate(domain, rows, domain in store.epoch).withColumn(BUCKET, _bucket(store, domain))
    return base_table(store, domain).commit(valid, _version(upto), buckets=store.buckets).drop(BUCKET)


# ---- merge ------------------------------------------------------------------

def run_merge(
    store: LakeStore, domain: str, strict: bool = False, arrival: Sequence[str] = ARRIVAL,
    as_of: datetime | None = None, files_per_epoch: int = FILES_PER_EPOCH, turn: Callable[[], object] | None = None,
    numbered: Callable[[], object] | None = None,
) -> bool:
    """Take every RAW row that arrived since the last run, then say whether there was any source.

    The checkpoint is the position in the change stream. Rows the full load has
    already covered are passed over. Every RAW batch is a merge of its own, so
    the outcome depends neither on how many of them one run finds nor on the files
    an epoch takes. ``arrival`` says which of two rows with one key came later inside
    a batch; rows it leaves equal are told apart by their content. Where merges
    of several domains run together, ``turn`` returns when this one may take its log numbers, and ``numbered`` is called
    as soon as it has taken all of them, where RAW is few enough files for one epoch.
    """
    taken = numbered if numbered is not None and _one_epoch(store, domain, files_per_epoch) else None
    loaded_upto = base_upto(store, domain)
    before = last_merge(store, domain)
    moment = as_of or utc_now()

    def append_source(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():  # files that the base holds
            return
        staged = store.path("staging", "merge", domain, f"epoch={epoch}")
        rows = judged(domain, _spread(batch), [*arrival, "batch_id"], strict, domain in store.epoch)
        rows.write.mode("overwrite").parquet(f"{staged}/rows")
        rows = store.spark.read.schema(rows.schema).parquet(f"{staged}/rows")
        good = rows.filter("error_type is null").drop("error_type", "error_detail")
        source = latest_per_key(good, [DOMAINS[domain].key, "batch_id"], arrival).withColumn(BUCKET, _bucket(store, domain))
        log = partial(_log, store, domain, epoch, rows, f"{staged}/fates", moment, turn, taken)
        # in a folder beside, as the source is committed only when its log is
        written = f"{staged}/source"
        batches, _ = side_by_side([log, lambda: source.write.mode("overwrite").partitionBy(BUCKET).parquet(written)])
        store.put_text(f"{written}/{BATCHES}", json.dumps(batches))
        store.move(written, store.path("merged", domain, f"epoch={epoch}"))
        store.delete(staged)

    query = (
        store.spark.readStream.schema(store.raw_schema(domain))
        .option("maxFilesPerTrigger", files_per_epoch)
        .parquet(store.path("raw", domain))
        .filter(F.col("batch_id") > loaded_upto)  # here it prunes folders, so a first merge does not read what the base holds
        .writeStream.foreachBatch(append_source)
        .option("checkpointLocation", store.path("checkpoints", "merge", domain))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return last_merge(store, domain) != before


def _one_epoch(store: LakeStore, domain: str, files_per_epoch: int) -> bool:
    """Whether all of RAW, merged or not, is no more files than an epoch takes; no more folders than that are listed."""
    root, left = store.path("raw", domain), files_per_epoch
    for batch in store.files(root):
        left -= max(1, len(store.files(f"{root}/{batch}")))
        if left < 0:
            return False
    return True


def _spread(batch: DataFrame) -> DataFrame:
    """Rows of fewer files than there are cores, dealt to all of them where they are many."""
    cores = batch.sparkSession.sparkContext.defaultParallelism
    return batch.hint("rebalance") if batch.rdd.getNumPartitions() < cores else batch


def _log(
    store: LakeStore, domain: str, epoch: int, rows: DataFrame, path: str, as_of: datetime,
    turn: Callable[[], object] | None, taken: Callable[[], object] | None,
) -> list[int]:
    """Load log and exceptions of one epoch, under a run of its own: repeated, it replaces them under the same numbers.

    Returns the RAW batches that the epoch has rows of.
    """
    fates = quality.counted_fates(domain, rows)
    fates.write.mode("overwrite").parquet(path)
    fates = store.spark.read.schema(fates.schema).parquet(path)
    loads = quality.merge_loads(domain, rows, fates)
    lines = loads.collect()  # one per RAW batch, of which an epoch has no more than files
    failed = sum(line.failed_rows for line in lines)
    run = f"merge-{domain}-{epoch:012d}"
    if turn is not None:
        turn()
    first_load = store.reserve("load_log", run, len(lines)) if lines else 0
    first_exception = store.reserve("dq_exceptions", run, failed) if failed else 0
    if taken is not None:
        taken()

    def log_loads() -> None:
        values = F.array(*[F.struct(*[F.lit(line[f.name]).cast(f.dataType).alias(f.name) for f in loads.schema]) for line in lines])
        counted = store.spark.range(0, 1, 1, 1).select(F.inline(values))
        store.log_run(quality.numbered_loads(counted, "batch_id", as_of, first_load - 1), AUDIT, "load_log", run)

    def log_exceptions() -> None:
        found = quality.exception_log(quality.merge_exceptions(domain, fates, failed), as_of, first_exception - 1, failed)
        store.log_run(found, AUDIT, "dq_exceptions", run)

    side_by_side([*([log_loads] if lines else ()), *([log_exceptions] if failed else ())])
    return [line.batch_id for line in lines]


# ---- reading ----------------------------------------------------------------

def _read_sources(store: LakeStore, domain: str, after_epoch: int = -1, buckets: Collection[int] | None = None) -> DataFrame | None:
    root = store.path("merged", domain)
    paths = [f"{root}/epoch={e}" for e in epochs(store, domain) if e > after_epoch]
    if not paths:
        return None
    typed = judged(domain, store.spark.createDataFrame([], store.raw_schema(domain)), [*ARRIVAL, "batch_id"])
    schema = T.StructType([
        *typed.drop("error_type", "error_detail").schema.fields,
        T.StructField("epoch", T.LongType()), T.StructField(BUCKET, T.IntegerType()),
    ])
    rows = store.spark.read.schema(schema).option("basePath", root).parquet(*paths).drop("epoch")
    return rows if buckets is None else rows.filter(F.col(BUCKET).isin(*buckets))


def sources(store: LakeStore, domain: str, buckets: Collection[int] | None = None) -> DataFrame | None:
    """Rows of the committed merge sources, one per key and RAW batch, of all buckets or some; None without a source.

    An epoch may end inside a batch. Only then do two sources hold rows of one key and batch.
    """
    rows = _read_sources(store, domain, buckets=buckets)
    if rows is None:
        return None
    batches = source_batches(store, domain)
    if batches is None or len(batches) != len(set(batches)):
        rows = latest_per_key(rows, [DOMAINS[domain].key, "batch_id"], ARRIVAL)
    return rows.drop(*ARRIVAL)


def source_batches(store: LakeStore, domain: str) -> list[int] | None:
    """The RAW batches of every committed source, one after the other; None where a source does not say them."""
    found = []
    for epoch in epochs(store, domain):
        path = store.path("merged", domain, f"epoch={epoch}", BATCHES)
        if not store.exists(path):
            return None
        found += json.loads(store.read_text(path))
    return found


def touched_buckets(store: LakeStore, domain: str) -> list[int]:
    """Buckets with rows in the merge sources, from folder names."""
    root, prefix = store.path("merged", domain), f"{BUCKET}="
    found = {n for e in epochs(store, domain) for n in store.files(f"{root}/epoch={e}") if n.startswith(prefix)}
    return sorted(int(n[len(prefix):]) for n in found)


def turns(store: LakeStore, domain: str) -> list[list[int] | None]:
    """The buckets in groups of about ``TURN`` bytes; [None], which stands for all of them, where one group holds them."""
    table, root = base_table(store, domain), store.path("merged", domain)
    name = table.latest()
    paths = [f"{root}/epoch={e}" for e in epochs(store, domain)]
    size = store.size(*paths, *(table.folders(name) if name is not None else ()))
    n = min(store.buckets, -(-size // TURN))
    return [None] if n < 2 else [list(range(k, store.buckets, n)) for k in range(n)]


def _current(
    store: LakeStore, domain: str, buckets: Collection[int] | None = None
) -> tuple[DataFrame | None, DataFrame, list[int], str | None]:
    """(untouched rows, rows of the touched buckets, these buckets, the base's version), all with their bucket; ``buckets``: of these alone."""
    spec, table = DOMAINS[domain], base_table(store, domain)
    name = table.latest()
    if name is not None and table.note(name, "buckets") != store.buckets:
        raise ValueError(f"{domain} was dealt to {table.note(name, 'buckets')} buckets")
    later = sources(store, domain, buckets)
    if later is None:
        if name is None:
            raise ValueError(f"nothing loaded for {domain}")
        return table.read(name, only=buckets), table.read(name, only=()), [], name
    upto, known = base_upto(store, domain), source_batches(store, domain)
    if name is not None and known is not None and all(b <= upto for b in known):  # kept for its position alone
        return table.read(name, only=buckets), table.read(name, only=()), [], name
    later = later.filter(F.col("batch_id") > upto)
    if known is not None and len({b for b in known if b > upto}) == 1:
        changes = later.drop("batch_id")  # a single batch has nothing to be folded
    else:
        changes = fold(later, spec.key, spec.merge_updates, "batch_id")
    touched = [b for b in touched_buckets(store, domain) if buckets is None or b in buckets]
    if name is None:
        return None, changes, touched, None
    method = upsert_small if _small(store, domain, table, name) else upsert
    rows = method(table.read(name, only=touched), changes, spec.key, spec.merge_updates)
    return table.read(name, only=buckets, but=touched), rows, touched, name


def _small(store: LakeStore, domain: str, table: Versions, name: str) -> bool:
    """Whether the sources are far smaller than the base, by the size of their files."""
    root = store.path("merged", domain)
    size = store.size(*[f"{root}/epoch={e}" for e in epochs(store, domain)])
    return size * SMALLER < store.size(*table.folders(name))


def validated(store: LakeStore, domain: str, buckets: Collection[int] | None = None) -> DataFrame:
    """Current VALIDATED rows of a domain, of all buckets or some."""
    untouched, rows, touched, _ = _current(store, domain, buckets)
    if untouched is None:
        return rows.drop(BUCKET)
    return (untouched.unionByName(rows) if touched else untouched).drop(BUCKET)


def changed_keys(store: LakeStore, domain: str, after_epoch: int, buckets: Collection[int] | None = None) -> DataFrame:
    """Keys of the rows merged after an epoch, of all buckets or some."""
    key = DOMAINS[domain].key
    later = _read_sources(store, domain, after_epoch, buckets)
    if later is None:
        return store.spark.createDataFrame([], T.StructType([T.StructField(key, T.StringType())]))
    return later.select(key).distinct()


# ---- compaction -------------------------------------------------------------

def compact(store: LakeStore, domain: str, read_upto: int | None = None, keep: int = 2) -> DataFrame:
    """Make the current rows the base, bucket by bucket.

    Only touched buckets are written, some at a time where they are large. Sources that the new base holds are dropped but for
    the newest, which stays as the position; ``read_upto`` names the last epoch that
    nothing else needs, such as the refresh of the facts (all of them, if None).
    """
    table, done = base_table(store, domain), epochs(store, domain)
    upto = base_upto(store, domain)
    later = _read_sources(store, domain)
    reached = later.agg(F.max("batch_id")).first()[0] if later is not None else None
    if reached is not None and reached > upto:
        name, touched = table.latest(), touched_buckets(store, domain)
        rows = [_current(store, domain, group)[1] for group in turns(store, domain)]
        replace = None if name is None else touched
        table.commit(rows, _version(reached), base=name, replace=replace, buckets=store.buckets)
        table.drop_old(keep)
    for epoch in done[:-1]:
        if read_upto is None or epoch <= read_upto:
            store.delete(store.path("merged", domain, f"epoch={epoch}"))
    return validated(store, domain)
