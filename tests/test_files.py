"""Landing files, RAW, incremental merge and the scheduled jobs."""

import os
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from innlake import streamed
from innlake.plans import jobs
from innlake.plans.validate import merge, validate
from innlake.session import working_folder
from innlake.sources import landing as lf
from innlake.sources.feeds import FEEDS
from innlake.sources.schemas import RAW_COLUMNS
from innlake.sources.tables import LakeStore
from innlake.streaming import merge as merging
from innlake.streaming.ingest import ingest, load_history

NOW = datetime(2024, 2, 1)
HEADER = ",".join(RAW_COLUMNS["rooms"])


def put(landing, domain, name, *lines):
    folder = lf.folder(str(landing), domain)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


@pytest.fixture()
def place(spark, tmp_path):
    landing = tmp_path / "landing"
    store = LakeStore(spark, str(tmp_path / "lake"))
    take = lambda domain="rooms", at=NOW, **kw: ingest(store, str(landing), domain, lambda: at, **kw)
    return store, landing, take


def raw_rows(store, domain="rooms"):
    got = store.raw(domain).select(*RAW_COLUMNS[domain]).collect()
    return sorted((tuple(r) for r in got), key=str)


def test_fields_are_cleaned(place):
    store, landing, take = place
    put(landing, "rooms", "a.csv", HEADER,
        'r1, h1 ,"a, b",NULL,null,"say ""hi""",," keep "',
        'r2,h1,"two\nlines",1,2,x,y,3')
    take()
    assert raw_rows(store) == [
        ("r1", "h1", "a, b", None, None, 'say "hi"', None, " keep "),
        ("r2", "h1", "two\nlines", "1", "2", "x", "y", "3"),
    ]


def test_each_file_once(place):
    store, landing, take = place
    put(landing, "rooms", "a.csv", HEADER, "r1,h,t,1,1,x,s,1")
    take(), take()
    assert len(raw_rows(store)) == 1
    put(landing, "rooms", "b.csv", HEADER, "r2,h,t,1,1,x,s,1")
    take(), take()
    assert [r[0] for r in raw_rows(store)] == ["r1", "r2"]
    assert store.values("batch_id", "raw", "rooms") == ["0", "1"]


def test_one_bad_record_refuses_its_file(place, spark):
    store, landing, take = place
    put(landing, "rooms", "good.csv", HEADER, "r1,h,t,1,1,x,s,1")
    put(landing, "rooms", "short.csv", HEADER, "r2,h,t,1,1,x,s,1", "r3,h")
    put(landing, "rooms", "long.csv", HEADER, "r4,h,t,1,1,x,s,1,extra", "r5,h,t,1,1,x,s,1")
    take()
    assert [r[0] for r in raw_rows(store)] == ["r1"]
    history = {r.file.rsplit("/", 1)[1]: (r.status, r.row_count) for r in load_history(store, "rooms", NOW).collect()}
    assert history == {"good.csv": ("LOADED", 1), "short.csv": ("REFUSED", 1), "long.csv": ("REFUSED", 1)}


def test_history_looks_back_a_day(place):
    store, landing, take = place
    put(landing, "rooms", "a.csv", HEADER, "r1,h,t,1,1,x,s,1")
    take(at=NOW - timedelta(hours=25))
    put(landing, "rooms", "b.csv", HEADER, "r2,h,t,1,1,x,s,1")
    take(at=NOW - timedelta(hours=24))
    files = [r.file.rsplit("/", 1)[1] for r in load_history(store, "rooms", NOW).collect()]
    assert files == ["b.csv"]


def test_listing(place, spark):
    _, landing, _ = place
    put(landing, "rooms", "a.csv", HEADER)
    put(landing, "guests", "b.csv", "x")
    found = lf.list_files(spark, str(landing)).collect()
    assert sorted(r.path.rsplit("/", 2)[1] for r in found) == ["guests", "rooms"]
    assert sum(r.length for r in found) == len(HEADER) + 3


def test_batch_read_marks_malformed_records(place, spark):
    _, landing, _ = place
    put(landing, "rooms", "a.csv", HEADER, "r1,h,t,1,1,x,s,1", "r2,h")
    rows = lf.read_csv(spark, str(landing), "rooms").cache()
    assert rows.filter(F.col(lf.CORRUPT).isNotNull()).count() == 1


def test_small_batches_add_up(place):
    store, landing, take = place
    for n in range(5):
        put(landing, "rooms", f"{n}.csv", HEADER, f"r{n},h,t,1,1,x,s,1")
    take(max_files_per_batch=2)
    assert len(raw_rows(store)) == 5
    assert len(store.values("batch_id", "raw", "rooms")) == 3


def room(key, status="free", price="10", capacity="2"):
    return f"{key},h1,double,1,{capacity},tv,{status},{price}"


def current(store):
    return {r.room_id: (r.status, r.base_price and float(r.base_price)) for r in merging.validated(store, "rooms").collect()}


def test_increments_follow_the_full_load(place):
    store, landing, take = place
    put(landing, "rooms", "a.csv", HEADER, room("r1"), room("r2"), room("r0", capacity="0"))
    take()
    merging.load_base(store, "rooms")
    merging.run_merge(store, "rooms")
    assert current(store) == {"r1": ("Free", 10.0), "r2": ("Free", 10.0)}
    put(landing, "rooms", "b.csv", HEADER, room("r2", "under_repair", "bad"), room("r3", "new", "-5"))
    take(), merging.run_merge(store, "rooms"), merging.run_merge(store, "rooms")
    want = {"r1": ("Free", 10.0), "r2": ("Under_Repair", None), "r3": ("New", -5.0)}
    assert current(store) == want
    put(landing, "rooms", "c.csv", HEADER, room("r3", "old", "7"))
    take(), merging.run_merge(store, "rooms")
    want["r3"] = ("Old", 7.0)
    assert current(store) == want
    merging.compact(store, "rooms"), merging.compact(store, "rooms")
    assert current(store) == want
    put(landing, "rooms", "d.csv", HEADER, room("r1", "gone", "1"))
    take(), merging.run_merge(store, "rooms")
    want["r1"] = ("Gone", 1.0)
    assert current(store) == want


def test_lost_checkpoint_changes_nothing(place, tmp_path):
    store, landing, take = place
    put(landing, "rooms", "a.csv", HEADER, room("r1"))
    take(), merging.load_base(store, "rooms")
    put(landing, "rooms", "b.csv", HEADER, room("r1", "busy", "3"), room("r2"))
    take(), merging.run_merge(store, "rooms")
    before = current(store)
    os.rename(tmp_path / "lake/checkpoints/merge", tmp_path / "lake/lost")
    merging.run_merge(store, "rooms")
    assert current(store) == before


def test_outcome_does_not_depend_on_when_merges_run(place, tmp_path):
    store, landing, take = place
    put(landing, "rooms", "a.csv", HEADER, room("r1"))
    take(), merging.load_base(store, "rooms")
    for n, status in enumerate(("new", "busy", "closed")):
        put(landing, "rooms", f"b{n}.csv", HEADER, room("r1", status), room("r2", status, capacity=str(n + 1)))
        take(), merging.run_merge(store, "rooms")
    read = lambda: sorted(map(repr, merging.validated(store, "rooms").collect()))
    stepwise = read()
    assert merging.validated(store, "rooms").filter("room_id = 'r2' and capacity = 1 and status = 'Closed'").count() == 1
    os.rename(tmp_path / "lake/checkpoints/merge", tmp_path / "lake/lost checkpoint")
    os.rename(tmp_path / "lake/merged", tmp_path / "lake/lost sources")
    merging.run_merge(store, "rooms")
    assert read() == stepwise


def test_streamed_merge_equals_batch_merge(place, spark, sf_dir):
    store, landing, take = place
    feed = FEEDS["rooms"](spark, sf_dir)
    change = feed.withColumn("status", F.lit("re-opened")).withColumn("base_price", F.lit("1.5"))
    write = lambda df: df.write.mode("append").csv(lf.folder(str(landing), "rooms"), header=True)
    write(feed), take(), merging.load_base(store, "rooms")
    write(change), take(), merging.run_merge(store, "rooms")
    batch = merge("rooms", validate("rooms", feed), change)
    a, b = (sorted(map(repr, df.select(*batch.columns).collect())) for df in (merging.validated(store, "rooms"), batch))
    assert a == b and len(a) > 150


class Session:
    """Just the settings of a session."""

    def __init__(self, master, **settings):
        self.conf = SimpleNamespace(get=lambda key, default: settings.get(key.replace(".", "_"), default))
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: None)


def test_working_folder_is_the_sessions():
    shared = Session("yarn", spark_checkpoint_dir="hdfs://shared/tmp/")
    first, second = working_folder(shared, "x"), working_folder(shared, "x")
    assert first.startswith("hdfs://shared/tmp/x-") and first != second


def test_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError):
        working_folder(Session("yarn"), "x")


def test_jobs_end_to_end(place, spark, sf_dir):
    store, landing, take = place
    for domain, feed in FEEDS.items():
        feed(spark, sf_dir).write.csv(lf.folder(str(landing), domain), header=True)
        take(domain, multiline=False)
    jobs.full_load(store, NOW)
    counts = {r.layer: r.cnt for r in jobs.row_counts(store).collect()}
    assert counts["VAL ROOMS"] == 193 and counts["FACT BILLING"] == counts["VAL BILLING"] == 1446
    assert counts["RAW GUESTS"] == 160 and counts["FACT RESERVATION"] == 1395

    log = {r.domain: (r.total_rows, r.passed_rows, r.failed_rows) for r in store.log("audit", "load_log").collect()}
    assert log["ROOMS"] == (200, 193, 7)
    exceptions = store.log("audit", "dq_exceptions")
    kinds = {r.error_type for r in exceptions.select("error_type").distinct().collect()}
    assert kinds == {"DEDUP", "REF_INTEGRITY", "TEMPORAL", "VALUE"}

    jobs.run_anomalies(store, NOW), jobs.run_anomalies(store, NOW)
    found = store.log("curated", "anomaly_log")
    first_run = found.count()
    assert first_run == 242
    jobs.run_anomalies(store, NOW + timedelta(days=1))
    both = store.log("curated", "anomaly_log")
    assert both.count() == both.select("anomaly_id").distinct().count() > 2 * 200

    # one room becomes dearer: a second version, and facts move to it
    raised = RAW_COLUMNS["rooms"]
    row = store.raw("rooms").filter("room_id = 'RM1'").select(*raised).first().asDict()
    row.update(base_price="999", status="occupied")
    put(landing, "rooms", "update.csv", HEADER, ",".join(row[c] or "" for c in raised))
    take("rooms")
    later = NOW + timedelta(hours=1)
    jobs.hourly_increment(store, later)
    versions = jobs.curated(store, "dim_room").filter("room_id = 'RM1'").orderBy("room_sk").collect()
    assert [v.is_current for v in versions] == [False, True]
    assert versions[0].effective_to == versions[1].effective_from == later
    assert versions[1].room_sk == 194
    stays = jobs.curated(store, "fact_reservation")
    assert stays.filter(F.col("room_sk") == versions[0].room_sk).count() == 0
    assert stays.filter("room_sk = 194").count() > 0 and stays.count() == 1395
    size = jobs.curated(store, "dim_room").count()
    jobs.refresh_curated(store, later)
    assert jobs.curated(store, "dim_room").count() == size == 194
    jobs.refresh_curated(store, later + timedelta(hours=1))
    assert jobs.curated(store, "dim_room").count() == size

    jobs.register_views(store, "FRONT_DESK")
    assert spark.table("kpi_conversion").agg(F.sum("total_reservations")).first()[0] == 1291
    assert spark.table("dim_guest").filter("phone not like 'XXXXXX%'").count() == 0


def test_increment_makes_up_for_a_dead_refresh(place, monkeypatch):
    store, landing, take = place
    for domain, columns in RAW_COLUMNS.items():
        put(landing, domain, "a.csv", ",".join(columns), ",".join("x" for _ in columns))
        take(domain)
    put(landing, "rooms", "b.csv", HEADER, "r1,h1,t,1,1,x,s,1")
    take()
    jobs.full_load(store, NOW)
    put(landing, "rooms", "c.csv", HEADER, "r2,h1,t,1,1,x,s,1")
    take()
    refresh, seen = jobs.refresh_curated, []

    def dies_once(store, as_of):
        seen.append(as_of)
        if len(seen) == 1:
            raise RuntimeError("died after the merges")
        refresh(store, as_of)

    monkeypatch.setattr(jobs, "refresh_curated", dies_once)
    hours = [NOW + timedelta(hours=n) for n in (1, 2, 3)]
    with pytest.raises(RuntimeError):
        jobs.hourly_increment(store, hours[0])
    jobs.hourly_increment(store, hours[1])
    jobs.hourly_increment(store, hours[2])
    assert seen == hours[:2]
    assert {r.room_id for r in jobs.curated(store, "dim_room").collect()} == {"r1", "r2"}


def test_a_table_of_one_row_group_is_delivered_by_several_tasks(spark, tmp_path):
    key = F.col("id")
    rows = spark.range(0, 400_000, 1, 1).select(
        key.alias("p_partkey"), F.sha2(key.cast("string"), 256).alias("p_name"), F.lit("t").alias("p_type"), F.lit(1).alias("p_size"), F.lit(900.0).alias("p_retailprice"))
    rows.write.parquet(str(tmp_path / "part.parquet"))
    streamed.deliver(FEEDS["rooms"](spark, str(tmp_path), spread=True), str(tmp_path / "landing"), "rooms")
    found = [name for name in os.listdir(lf.folder(str(tmp_path / "landing"), "rooms")) if name.endswith(".csv")]
    landed = lf.read_csv(spark, str(tmp_path / "landing"), "rooms", multiline=False)
    assert len(found) > 1 and landed.select("room_id").distinct().count() == landed.count() == 400_000


def test_files_of_a_batch_are_counted_in_one_pass(place, spark):
    store, landing, take = place
    put(landing, "rooms", "good.csv", HEADER, "r1,h,t,1,1,x,s,1", "r2,h,t,1,1,x,s,1")
    put(landing, "rooms", "bad.csv", HEADER, "r3,h,t,1,1,x,s,1", "r4,h")
    put(landing, "rooms", "empty.csv", HEADER)
    lf.read_csv(spark, str(landing), "rooms").write.parquet(store.path("parsed"))
    files = lf.counted_files(spark.read.parquet(store.path("parsed")))
    assert sorted((f._file.rpartition("/")[2], f.row_count, f.bad_records) for f in files) == [("bad.csv", 2, 1), ("good.csv", 2, 0)]
    take()
    assert sorted(r[0] for r in raw_rows(store)) == ["r1", "r2"]
    found = load_history(store, "rooms", NOW).select("file", "status", "row_count").collect()
    assert sorted((f.rpartition("/")[2], status, n) for f, status, n in found) == [("bad.csv", "REFUSED", 1), ("good.csv", "LOADED", 2)]
