"""What a long job may leave on disk and send to the driver."""

import glob
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from innlake import streamed
from innlake.plans import jobs
from innlake.sources import tables
from innlake.sources.schemas import RAW_COLUMNS
from innlake.sources.tables import bounded
from innlake.streaming import merge as merging
from tests.test_files import HEADER, NOW, put, room
from tests.test_versions import place, rows_of  # noqa: F401

CLEANUP, CODEC = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.parquet.compression.codec"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffle_files(spark)
    with bounded(spark):
        rows.write.parquet(str(tmp_path / "out"))
        end = time.time() + 20
        while shuffle_files(spark) - before and time.time() < end:
            time.sleep(0.2)
        assert not shuffle_files(spark) - before
        assert rows.collect() and len(rows.collect()) == 7  # a frame may be used again


def test_settings_come_back(spark):
    names = (CLEANUP, CODEC, "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(n, None) for n in names]
    with pytest.raises(KeyError), bounded(spark):
        inside = [spark.conf.get(n) for n in names]
        with bounded(spark):
            pass
        assert [spark.conf.get(n) for n in names] == inside and inside[:2] == ["true", "zstd"]
        raise KeyError
    assert [spark.conf.get(n, None) for n in names] == before


def full_lake(place):  # noqa: F811
    store, landing, take = place
    for domain in RAW_COLUMNS:
        put(landing, domain, "a.csv", ",".join(RAW_COLUMNS[domain]), *([room(f"r{n}") for n in range(200)] if domain == "rooms" else ()))
        take(domain)
    jobs.full_load(store, NOW)
    return store, landing, take


def test_jobs_write_compressed_tables_and_leave_the_session_alone(place, spark):  # noqa: F811
    before = spark.conf.get(CODEC, None), spark.conf.get(CLEANUP, None)
    store, *_ = full_lake(place)
    for table in ("validated/rooms", "curated/dim_room"):
        files = glob.glob(f"{store.root}/{table}/data/**/*.parquet", recursive=True)
        assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert (spark.conf.get(CODEC, None), spark.conf.get(CLEANUP, None)) == before


def test_compressed_deliveries_are_read_whole(place, spark):  # noqa: F811
    store, landing, take = place
    values = [tuple(room(f"r{n}").split(",")) for n in range(50)]
    rows = spark.createDataFrame(values, [*RAW_COLUMNS["rooms"]]).coalesce(1)
    streamed.deliver(rows, str(landing), "rooms", compression="gzip", maxRecordsPerFile=20)
    assert len(glob.glob(f"{landing}/*/*.csv.gz")) == 3
    take()
    assert sorted(r[0] for r in rows_of(store.raw("rooms").select("room_id"))) == sorted(v[0] for v in values)


def test_large_lakes_run_fewer_steps_at_once(place, monkeypatch):  # noqa: F811
    store, landing, take = place
    assert store.at_once() == tables.AT_ONCE
    put(landing, "rooms", "a.csv", HEADER, room("r1"))
    take()
    assert store.at_once() == tables.AT_ONCE
    monkeypatch.setattr(tables, "LARGE", 10)
    assert store.at_once() == tables.AT_ONCE_LARGE


def test_a_compacted_table_is_read_without_its_sources(place):  # noqa: F811
    store, landing, take = full_lake(place)
    put(landing, "rooms", "b.csv", HEADER, *(room(f"r{n}", "busy") for n in range(10)))
    take(), merging.run_merge(store, "rooms")
    before = rows_of(merging.validated(store, "rooms"))
    merging.compact(store, "rooms")
    assert merging.epochs(store, "rooms") and merging._current(store, "rooms")[2] == []
    assert rows_of(merging.validated(store, "rooms")) == before and len(before) == 200


def test_a_side_is_small_by_its_rows_and_not_by_its_files(spark, tmp_path):
    path = str(tmp_path / "keys")
    # millions of rows in some megabytes of files, of which the join reads one column
    spark.range(0, 3_000_000, 1, 1).select("id", *[F.lit(None).cast("string").alias(f"c{i}") for i in range(4)]).write.parquet(path)
    keys, other = spark.read.parquet(path).select("id"), spark.read.parquet(path).select(F.col("id").alias("other"))

    def planned():
        joined = keys.join(other, F.col("id") == F.col("other"), "left_anti")
        return joined._jdf.queryExecution().sparkPlan().toString()

    assert "BroadcastHashJoin" in planned()
    with bounded(spark):
        assert "BroadcastHashJoin" not in planned()


def test_buckets_and_months_in_turns_give_the_same_tables(place, monkeypatch):  # noqa: F811
    store, landing, take = full_lake(place)
    store.buckets = 16
    task = lambda n: f"t{n},r{n},cleaning,s1,2024-{1 + n % 3:02d}-03 10:00:00,2024-01-03 10:00:00,2024-01-03 11:00:00,N,completed"
    put(landing, "housekeeping", "b.csv", ",".join(RAW_COLUMNS["housekeeping"]), *(task(n) for n in range(30)))
    put(landing, "rooms", "b.csv", HEADER, *(room(f"r{n}", "busy") for n in range(20)))
    take("housekeeping"), take("rooms")
    frames, commit = [], merging.Versions.commit
    monkeypatch.setattr(merging.Versions, "commit", lambda self, df, *a, **k: (frames.append(df), commit(self, df, *a, **k))[1])
    monkeypatch.setattr(merging, "TURN", 3000)
    jobs.hourly_increment(store, NOW + timedelta(hours=1), arrival=())
    fact = jobs.FACTS["fact_housekeeping"]
    whole = fact.build(merging.validated(store, "housekeeping"), None, jobs.curated(store, "dim_room"))
    assert rows_of(jobs.curated(store, "fact_housekeeping").select(*whole.columns)) == rows_of(whole) and whole.count() == 30
    before = rows_of(merging.validated(store, "rooms"))
    merging.compact(store, "rooms")
    assert rows_of(merging.validated(store, "rooms")) == before and sum(r[6] == "Busy" for r in before) == 20
    assert [len(f) > 1 for f in frames if isinstance(f, list)] == [True, True]
