"""Where layers live as Parquet, and how complete loads are told apart.

A table that is replaced as a whole gets a new ``load=<stamp>`` folder per run;
readers take the newest folder Spark has committed. Nothing is overwritten while
it is being read, and a run that died half way is simply not seen. Logs keep one
``run=<stamp>`` folder per run, so repeating a run replaces its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, types as T

from innlake.session import working_folder
from innlake.sources.schemas import RAW_SCHEMAS

RAW_AUDIT_FIELDS = [
    T.StructField("_file", T.StringType()),
    T.StructField("_file_time", T.TimestampNTZType()),
    T.StructField("_loaded_at", T.TimestampNTZType()),
    T.StructField("batch_id", T.LongType()),
]


_SETTLED: list[list[str]] = []
# independent Spark jobs a run submits at once
AT_ONCE = 5
# the same over inputs of which one step fills the cores by itself: the shuffle files of steps side by side lie on disk together
AT_ONCE_LARGE = 2
LARGE = 128 * 1024 * 1024
# bytes of files, as far as its columns go, up to which a join's side is broadcast unmeasured
BROADCAST_FILES = 1024 * 1024

# per session: how many ``bounded`` blocks are open, and the settings from before the first
_BOUNDED: dict[SparkSession, tuple[int, dict[str, str | None]]] = {}
_BOUNDING = Lock()


def _broadcasts(spark: SparkSession) -> dict[str, str]:
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    most = spark.conf.get(planned)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(most) <= BROADCAST_FILES:
        return {}
    return {planned: str(BROADCAST_FILES), measured: spark.conf.get(measured, None) or most}


@contextmanager
def bounded(spark: SparkSession):
    """Settings of the session by which a long job's disk and driver memory stay in bounds; the ones before are back at the end.

    A query's shuffle files go when it ends. Otherwise they go with the driver's garbage, and a job of hundreds of queries
    has most of them on disk at once. Tables are written with zstd. Before it runs, a join's side is taken for small only below
    ``BROADCAST_FILES`` of files: a few columns of 10 MB of Parquet may be millions of rows. What adaptive execution has measured
    is broadcast up to the session's threshold.
    """
    with _BOUNDING:
        depth, before = _BOUNDED.get(spark, (0, {}))
        if not depth:
            settings = {
                "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                "spark.sql.parquet.compression.codec": "zstd",
                **_broadcasts(spark),
            }
            before = {name: spark.conf.get(name, None) for name in settings}
            for name, value in settings.items():
                spark.conf.set(name, value)
        _BOUNDED[spark] = depth + 1, before
    try:
        yield
    finally:
        with _BOUNDING:
            depth, before = _BOUNDED.pop(spark)
            if depth > 1:
                _BOUNDED[spark] = depth - 1, before
            else:
                for name, value in before.items():
                    spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def settled_until_end(spark: SparkSession):
    """Folders that ``settle`` writes inside are removed at the end: for jobs, whose results are tables of their own."""
    _SETTLED.append([])
    try:
        yield
    finally:
        for path in _SETTLED.pop():
            delete(spark, path)


def _folder(spark: SparkSession, purpose: str) -> str:
    path = working_folder(spark, purpose)
    if _SETTLED:
        _SETTLED[-1].append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def side_by_side(steps: Sequence[Callable[[], object]], at_once: int = AT_ONCE) -> list:
    """Results of steps that do not need each other, submitted together, so that one fills the cores another leaves idle.

    All have ended when this returns or raises.
    """
    if len(steps) < 2:
        return [step() for step in steps]
    with ThreadPoolExecutor(at_once) as pool:
        begun = [pool.submit(inheritable_thread_target(SparkSession.active())(step)) for step in steps]
    return [step.result() for step in begun]


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame once to the shared working folder and read it back.

    For results that several branches of a plan use, and to keep plans short.
    """
    path = _folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_all(frames: Sequence[DataFrame], purpose: str, at_once: int = AT_ONCE) -> DataFrame:
    """Write frames of one schema, each by a query of its own, and read them as one.

    Short separate plans instead of one wide union that is re-planned after
    every stage.
    """
    spark, schema = frames[0].sparkSession, frames[0].schema
    root = _folder(spark, purpose)
    paths = [f"{root}/{i}" for i in range(len(frames))]
    side_by_side([lambda frame=frame, path=path: frame.write.parquet(path) for frame, path in zip(frames, paths)], at_once)
    return spark.read.schema(schema).parquet(*paths)


def stamp(moment: datetime) -> str:
    return moment.strftime("%Y%m%dT%H%M%S")


AUDIT = "audit"
BUCKETS = 64


class LakeStore:
    """A lake below one folder.

    ``buckets`` is how many parts VALIDATED tables have, the same for the lake's whole life; ``epoch`` names the domains whose
    landed times may be digits, counted from 1970.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, epoch: Collection[str] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.epoch = frozenset(epoch)
        self._numbering = Lock()

    # ---- paths --------------------------------------------------------------

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def _folders(self, path: str) -> list[str]:
        """Names of the committed Parquet folders directly below ``path``."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        # one listing whatever the number of folders
        marks = files.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "*/_SUCCESS"))
        return sorted(m.getPath().getParent().getName() for m in marks or ())

    def _system(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def files(self, path: str) -> list[str]:
        """Names of what lies directly in a folder, hidden files aside; none if there is no such folder."""
        path, files = self._system(path)
        names = (f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else ()
        return sorted(n for n in names if n[0] not in "._")

    def exists(self, path: str) -> bool:
        path, files = self._system(path)
        return files.exists(path)

    def read_text(self, path: str) -> str:
        path, files = self._system(path)
        stream = files.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_text(self, path: str, text: str) -> None:
        """Write a small file beside its place and move it there, so it is never seen in part."""
        target, files = self._system(path)
        beside, _ = self._system(f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
        stream = files.create(beside)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if not files.rename(beside, target):  # some file systems do not replace a file
            files.delete(target, False)
            if not files.rename(beside, target):
                raise OSError(f"{path} could not be put in place")

    def delete(self, path: str) -> None:
        """Remove a folder that nothing reads any more."""
        delete(self.spark, path)

    def move(self, path: str, to: str) -> None:
        """Put a finished folder in its place, instead of what is there."""
        source, files = self._system(path)
        target, _ = self._system(to)
        files.delete(target, True)
        files.mkdirs(target.getParent())
        if not files.rename(source, target):
            raise OSError(f"{path} could not be moved to {to}")

    def size(self, *paths: str) -> int:
        """Bytes below some folders."""
        return sum(files.getContentSummary(path).getLength() for path, files in map(self._system, paths))

    def at_once(self) -> int:
        """How many steps over whole domains are submitted together."""
        raw = self.path("raw")
        return AT_ONCE_LARGE if self.exists(raw) and self.size(raw) > LARGE else AT_ONCE

    def values(self, label: str, *parts: str) -> list[str]:
        prefix = f"{label}="
        names = self._folders(self.path(*parts))
        return [n[len(prefix):] for n in names if n.startswith(prefix)]

    # ---- replaced tables ----------------------------------------------------

    def replace(self, df: DataFrame, layer: str, table: str, as_of: datetime) -> DataFrame:
        path = self.path(layer, table, f"load={stamp(as_of)}")
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def latest(self, layer: str, table: str, before: datetime | None = None) -> DataFrame | None:
        """Newest committed load, or the newest one strictly before a moment."""
        loads = self.values("load", layer, table)
        if before is not None:
            loads = [load for load in loads if load < stamp(before)]
        if not loads:
            return None
        return self.spark.read.parquet(self.path(layer, table, f"load={loads[-1]}"))

    # ---- logs ---------------------------------------------------------------

    def log_run(self, df: DataFrame, layer: str, table: str, run: datetime | str) -> None:
        name = run if isinstance(run, str) else stamp(run)
        df.write.mode("overwrite").parquet(self.path(layer, table, f"run={name}"))

    def reserve(self, log: str, run: str, size: int) -> int:
        """First of ``size`` consecutive numbers for a run of a log; a repeated run of the same size gets the same ones.

        Ranges are the names of empty files, so finding the next one takes a listing and reads no log.
        """
        folder = self.path("audit", "id_ranges", log)
        with self._numbering:  # merges of several domains number side by side
            taken = {name: (int(first), int(n)) for name, first, n in (f.rsplit(",", 2) for f in self.files(folder) if f.count(",") >= 2)}
            if run in taken and taken[run][1] == size:
                return taken[run][0]
            first = max((a + n for a, n in taken.values()), default=1)
            if run in taken:
                self.delete(f"{folder}/{run},{taken[run][0]},{taken[run][1]}")
            self.put_text(f"{folder}/{run},{first},{size}", "")
            return first

    def log(self, layer: str, table: str, before: datetime | None = None) -> DataFrame | None:
        runs = self.values("run", layer, table)
        if before is not None:
            runs = [run for run in runs if run < stamp(before)]
        if not runs:
            return None
        return self.spark.read.parquet(*[self.path(layer, table, f"run={run}") for run in runs])

    # ---- RAW ----------------------------------------------------------------

    def raw_schema(self, domain: str) -> T.StructType:
        return T.StructType([*RAW_SCHEMAS[domain].fields, *RAW_AUDIT_FIELDS])

    def raw(self, domain: str) -> DataFrame:
        return self.spark.read.schema(self.raw_schema(domain)).parquet(self.path("raw", domain))
