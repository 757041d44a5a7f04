import random
from datetime import datetime

import pytest
from pyspark.sql import Window, functions as F

from innlake.operators.dedup import first_per_key, latest_per_key
from innlake.operators.joins import not_in, splittable_join
from innlake.operators.scd2 import apply_snapshot, initial_versions
from innlake.operators.surrogate import next_key, with_surrogate_key
from innlake.operators.upsert import fold, upsert, upsert_small

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


def bag(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_first_per_key_breaks_ties_on_the_rest(rows):
    df = rows([("a", "2", "x"), ("a", None, "z"), ("a", None, "y"), ("b", "1", "q")], "k string, v string, w string")
    assert bag(first_per_key(df, "k")) == [repr(("a", None, "y")), repr(("b", "1", "q"))]


def test_latest_per_key(rows):
    df = rows([("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), ("b", None, "n"), ("b", 0, "m")], "k string, t int, v string")
    assert {r.k: r.v for r in latest_per_key(df, "k", ["t"]).collect()} == {"a": "new", "b": "m"}


def test_dedup_of_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    result = first_per_key(df, "k")
    assert result.count() == 6001
    plan = result._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning(k", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_surrogate_key_equals_global_rank(spark):
    df = spark.range(5000).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("k"))
    ranked = with_surrogate_key(df, "sk", ["k"], after=100)
    whole = df.withColumn("want", 100 + F.row_number().over(Window.orderBy(F.md5("k"), "k")))
    assert ranked.join(whole, "k").filter("sk = want").count() == 5000
    assert ranked.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()[:] == (101, 5100, 5000)


def test_surrogate_key_with_null_parts(rows):
    df = rows([("a", None), ("a", "x"), (None, "x")], "k string, v string")
    assert sorted(r.sk for r in with_surrogate_key(df, "sk", ["k", "v"]).collect()) == [1, 2, 3]


def test_next_key_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "sk bigint")
    assert spark.range(1).select(next_key(empty, "sk").alias("n")).first().n == 0


@pytest.mark.parametrize("right,want", [
    ([("2",)], ["1"]),
    ([], ["1", "2", None]),
    ([("2",), (None,)], []),
    ([("1",), ("2",)], []),
])
def test_not_in(rows, right, want):
    left = rows([("1",), ("2",), (None,)], "k string")
    got = [r.k for r in not_in(left, rows(right, "k string"), "k").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_not_in_agrees_with_sql(spark):
    random.seed(5)
    left = spark.createDataFrame([(random.choice([None, *map(str, range(30))]),) for _ in range(300)], "k string")
    right = spark.createDataFrame([(str(n),) for n in range(0, 30, 2)], "k string")
    left.createOrReplaceTempView("l"), right.createOrReplaceTempView("r")
    assert bag(not_in(left, right, "k")) == bag(spark.sql("select k from l where k not in (select k from r)"))


def test_splittable_join_is_a_plain_join(spark):
    left = spark.range(100).select((F.col("id") % 7).cast("string").alias("k"), "id")
    right = spark.range(5).select(F.col("id").cast("string").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left", "left_anti", "left_semi"):
        assert bag(splittable_join(left, right, "k", how)) == bag(left.join(right, "k", how))


SKEW_CONFS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.mark.parametrize("how", ["inner", "left_anti"])
def test_hot_key_is_split_at_run_time(spark, how):
    """A third of all rows on one key, against a side already partitioned on it."""
    saved = {key: spark.conf.get(key) for key in SKEW_CONFS}
    for key, value in SKEW_CONFS.items():
        spark.conf.set(key, value)
    try:
        bills = spark.range(0, 120_000, 1, 12).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        stays = bills.groupBy("k").agg(F.count("*").alias("n")).filter("n = 1 or k = 'hot'")
        joined = splittable_join(bills, stays, "k", how)
        assert len(joined.collect()) == (120_000 if how == "inner" else 0)
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


TARGET = [("a", "1", "x"), ("b", "2", "y"), ("c", None, None)]
SOURCE = [("a", None, "new"), ("d", "4", "w")]
SCHEMA = "k string, v string, w string"


@pytest.mark.parametrize("method", [upsert, upsert_small])
def test_upsert(rows, method):
    got = {r.k: (r.v, r.w) for r in method(rows(TARGET, SCHEMA), rows(SOURCE, SCHEMA), "k", ["v"]).collect()}
    assert got == {"a": (None, "x"), "b": ("2", "y"), "c": (None, None), "d": ("4", "w")}


@pytest.mark.parametrize("method", [upsert, upsert_small])
def test_upsert_twice_is_once(rows, method):
    source = rows(SOURCE, SCHEMA)
    once = method(rows(TARGET, SCHEMA), source, "k", ["v"])
    assert bag(method(once, source, "k", ["v"])) == bag(once)


def test_fold_equals_upserts_in_sequence(spark):
    random.seed(11)
    make = lambda: [(f"k{k}", random.choice([None, "p", "q"]), random.choice([None, "r", "s"]))
                    for k in random.sample(range(40), 20)]
    batches = [spark.createDataFrame(make(), SCHEMA) for _ in range(4)]
    stepwise = batches[0]
    for batch in batches[1:]:
        stepwise = upsert(stepwise, batch, "k", ["v"])
    everything = None
    for n, batch in enumerate(batches):
        part = batch.withColumn("seq", F.lit(n))
        everything = part if everything is None else everything.unionByName(part)
    folded = fold(everything, "k", ["v"], "seq").select(*stepwise.columns)
    assert bag(folded) == bag(stepwise)


GUESTS = "id string, tier string, city string"


def versions(df):
    return sorted((r.id, r.sk, r.tier, r.city, r.effective_from, r.effective_to, r.is_current) for r in df.collect())


def start(rows, data):
    return initial_versions(rows(data, GUESTS), "sk", "id", ["id", "tier", "city"], T0)


def test_snapshot_opens_and_closes_versions(rows):
    dim = start(rows, [("g1", "Silver", "A")])
    dim = apply_snapshot(dim, rows([("g1", "Gold", "B"), ("g2", None, "C")], GUESTS), "sk", "id", ["tier"], T1)
    first, second, third = versions(dim)
    assert first == ("g1", 1, "Silver", "A", T0, T1, False)
    assert second[2:] == ("Gold", "B", T1, None, True) and third[2:] == (None, "C", T1, None, True)
    assert {second[1], third[1]} == {2, 3}


def test_untracked_change_overwrites_in_place(rows):
    dim = start(rows, [("g1", "Silver", "A")])
    dim = apply_snapshot(dim, rows([("g1", "Silver", "Z")], GUESTS), "sk", "id", ["tier"], T1)
    assert versions(dim) == [("g1", 1, "Silver", "Z", T0, None, True)]


def test_change_to_and_from_null_is_a_change(rows):
    dim = start(rows, [("g1", "Silver", "A"), ("g2", None, "A")])
    dim = apply_snapshot(dim, rows([("g1", None, "A"), ("g2", None, "A")], GUESTS), "sk", "id", ["tier"], T1)
    assert len(versions(dim)) == 3


def test_history_properties_over_random_snapshots(spark, rows):
    random.seed(3)
    pick = lambda: [(f"g{n}", random.choice(["S", "G", None]), random.choice("AB")) for n in range(25)]
    dim = start(rows, pick())
    for moment in (T1, T2):
        snapshot = rows(pick() + [(f"n{moment.day}", "S", "A")], GUESTS)
        dim = apply_snapshot(dim, snapshot, "sk", "id", ["tier"], moment)
        again = apply_snapshot(dim, snapshot, "sk", "id", ["tier"], datetime(2025, 1, 1))
        assert versions(again) == versions(dim)
    found = versions(dim)
    assert len({v[1] for v in found}) == len(found)
    for key in {v[0] for v in found}:
        own = sorted(v[4:] for v in found if v[0] == key)
        assert sum(current for _, _, current in own) == 1
        for (_, end, _), (begin, _, _) in zip(own, own[1:]):
            assert end == begin


def test_copies_get_dense_numbers_without_meeting(spark):
    from innlake.plans.quality import DUPLICATE_CHUNK, exception_log

    hot = spark.range(3 * DUPLICATE_CHUNK + 7).selectExpr("'ROOMS' as domain", "cast(null as string) as natural_key", "'VALUE' as error_type", "'room_id missing' as error_detail")
    some = spark.range(50).selectExpr("'ROOMS' as domain", "cast(id as string) as natural_key", "'VALUE' as error_type", "'x' as error_detail")
    log = exception_log(hot.unionByName(some), datetime(2024, 2, 1), 10)
    n = 3 * DUPLICATE_CHUNK + 57
    assert log.agg(F.min("exception_id"), F.max("exception_id"), F.countDistinct("exception_id"), F.count("*")).first()[:] == (11, n + 10, n, n)
    assert log.withColumn("p", F.spark_partition_id()).groupBy("p").count().count() > 1


# ---- versions from an ordered feed ------------------------------------------

def brute_versions(events):
    """(key, value, other, from, to) of (key, from, fed, value, other) events: runs of one value."""
    out = []
    for key in sorted({e[0] for e in events}):
        runs = []
        for _, at, _, value, other in sorted((e for e in events if e[0] == key), key=lambda e: (e[1], e[2], e[3], e[4])):
            if runs and runs[-1][0] == value:
                runs[-1][1] = other
            else:
                runs.append([value, other, at])
        ends = [r[2] for r in runs[1:]] + [None]
        out += [(key, v, o, a, b) for (v, o, a), b in zip(runs, ends)]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_feed_gives_every_version(rows, seed):
    import random
    from datetime import datetime, timedelta

    from innlake.operators.scd2 import apply_feed

    chance, start = random.Random(seed), datetime(2024, 1, 1)
    schema = "k string, v string, o string"
    dim = rows([(n, f"k{n}", "a", "x", start, None, True) for n in range(1, 7)], f"sk bigint, {schema}, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
    state = [(f"k{n}", "a", "x", start, None) for n in range(1, 7)]
    keys_before = {}
    for _ in range(3):  # later runs bring late rows too
        feed = [(f"k{chance.randint(1, 8)}", chance.choice("abc"), chance.choice("xyz"), start + timedelta(minutes=13 * chance.randint(1, 90))) for _ in range(25)]
        feed = list({(k, at): (k, v, o, at) for k, v, o, at in feed if (k, at) not in {(e[0], e[3]) for e in state}}.values())
        state = brute_versions([(k, at, 0, v, o) for k, v, o, at, _ in state] + [(k, at, 1, v, o) for k, v, o, at in feed])
        df = rows(feed, f"{schema}, changed_at timestamp_ntz")
        dim = apply_feed(dim, df, "sk", "k", ["v"])
        found = dim.collect()
        key = lambda r: (r[0], r[3])
        assert sorted(((r.k, r.v, r.o, r.effective_from, r.effective_to) for r in found), key=key) == sorted(state, key=key)
        assert len({r.sk for r in found}) == len(found) and all(r.is_current == (r.effective_to is None) for r in found)
        now = {r.sk: (r.k, r.v) for r in found}
        assert all(now.get(sk) == was for sk, was in keys_before.items())
        keys_before = now
        again = apply_feed(dim, df, "sk", "k", ["v"])
        assert sorted(map(repr, again.drop("o").collect())) == sorted(map(repr, dim.drop("o").collect()))
    assert dim.count() > 20


def test_feed_overwrites_other_columns(rows):
    from datetime import datetime

    from innlake.operators.scd2 import apply_feed

    day = lambda n: datetime(2024, 1, n)
    dim = rows([(1, "k", "a", "x", day(1), None, True), (2, "q", "a", "x", day(1), None, True)],
               "sk bigint, k string, v string, o string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
    feed = rows([("k", "a", "y", day(2)), ("k", "b", "y", day(4)), ("k", "b", None, day(5)), (None, "b", "y", day(4)), ("k", "b", "y", None), ("n", "a", "z", day(3))],
                "k string, v string, o string, changed_at timestamp_ntz")
    got = sorted(tuple(r) for r in apply_feed(dim, feed, "sk", "k", ["v"]).drop("sk").collect())
    assert got == [("k", "a", "y", day(1), day(4), False), ("k", "b", None, day(4), None, True), ("n", "a", "z", day(3), None, True), ("q", "a", "x", day(1), None, True)]
    empty = apply_feed(dim, feed.limit(0), "sk", "k", ["v"])
    assert sorted(map(repr, empty.collect())) == sorted(map(repr, dim.collect()))
