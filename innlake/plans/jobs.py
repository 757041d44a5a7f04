"""The scheduled runs: full load, hourly increment, daily anomalies.

An outside scheduler calls these. Each layer is written as a table and the next
one starts from it. Facts are kept in monthly parts and dimensions in a current and a
closed part, so an increment writes the months it touches and adds closed versions to
the ones before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from threading import Event

from pyspark.sql import Column, DataFrame, functions as F

from innlake.constants import DATE_DIM_DAYS, DATE_DIM_START
from innlake.plans import anomalies, dims, facts, governance, kpis, quality
from innlake.plans.domains import DOMAINS
from innlake.sources.schemas import RAW_COLUMNS
from innlake.sources.tables import AT_ONCE, AUDIT, LakeStore, bounded, settle, settle_all, settled_until_end, side_by_side, stamp
from innlake.sources.versions import Versions
from innlake.streaming import merge

CURATED, POSITION = "curated", "merge_position"
CLOSED = "closed"
KEEP_VERSIONS = 24


@dataclass(frozen=True)
class Fact:
    """How a fact table is built from its domain, and which month a row belongs to (0 without one)."""

    domain: str
    build: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]
    part: str
    month: Callable[[], Column]
    guests: bool = False
    rooms: bool = False


def _month_of(moment: str) -> Column:
    return F.coalesce(F.year(moment) * 100 + F.month(moment), F.lit(0))


# The columns that decide a month are none that a merge updates, so a row never moves to another part.
FACTS = {
    "fact_reservation": Fact(
        "reservations", facts.fact_reservation, "check_in_month",
        lambda: F.coalesce(F.floor(F.col("check_in_date_sk") / 100), F.lit(0)).cast("int"), guests=True, rooms=True),
    "fact_housekeeping": Fact(
        "housekeeping", lambda rows, guest, room: facts.fact_housekeeping(rows, room), "scheduled_month",
        lambda: _month_of("scheduled_time"), rooms=True),
    "fact_billing": Fact(
        "billing", lambda rows, guest, room: facts.fact_billing(rows, guest), "payment_month",
        lambda: _month_of("payment_time"), guests=True),
}
DIMENSIONS = {"dim_guest": ("guests", dims.scd2_dim_guest), "dim_room": ("rooms", dims.scd2_dim_room)}


def _table(store: LakeStore, name: str) -> Versions:
    return Versions(store, CURATED, name, FACTS[name].part if name in FACTS else CLOSED)


def _raw(store: LakeStore) -> dict[str, DataFrame]:
    return {d: store.raw(d).select(*RAW_COLUMNS[d]) for d in DOMAINS}


def _merged(store: LakeStore) -> dict[str, int]:
    """Position of the merges: the last committed source of each domain."""
    return {d: merge.last_merge(store, d) for d in DOMAINS}


def _refreshed(store: LakeStore, before: datetime | None = None) -> tuple[dict[str, int], datetime | None]:
    """Position of the merges that CURATED was last brought up to, and when."""
    rows = store.latest(CURATED, POSITION, before)
    found = rows.collect() if rows is not None else []
    return dict.fromkeys(DOMAINS, -1) | {r.domain: r.epoch for r in found}, max((r.refreshed_at for r in found), default=None)


def _mark_refreshed(store: LakeStore, position: dict[str, int], as_of: datetime) -> None:
    rows = [(domain, epoch, as_of) for domain, epoch in position.items()]
    store.replace(store.spark.createDataFrame(rows, "domain string, epoch long, refreshed_at timestamp_ntz"), CURATED, POSITION, as_of)


def _valid(store: LakeStore) -> dict[str, DataFrame]:
    return {d: merge.validated(store, d) for d in DOMAINS}


def audit(store: LakeStore, raw, valid, as_of: datetime) -> None:
    """Load log and rejected rows of one full load."""
    def exceptions() -> None:
        found = settle_all(quality.all_exceptions(raw, valid, store.epoch), "exceptions", store.at_once())
        total = found.count()
        first = store.reserve("dq_exceptions", stamp(as_of), total)
        store.log_run(quality.exception_log(found, as_of, first - 1, total), AUDIT, "dq_exceptions", as_of)

    def loads() -> None:
        first = store.reserve("load_log", stamp(as_of), len(DOMAINS))
        store.log_run(quality.load_log(raw, valid, as_of, first - 1), AUDIT, "load_log", as_of)

    side_by_side([exceptions, loads])


def full_load(
    store: LakeStore, as_of: datetime, first_day: str = DATE_DIM_START, n_days: int = DATE_DIM_DAYS
) -> None:
    """RAW to CURATED from scratch; the calendar must reach the last check-in."""
    with bounded(store.spark), settled_until_end(store.spark):
        position, at_once = _merged(store), store.at_once()  # before the bases, which hold all that is merged by now
        valid = dict(zip(DOMAINS, side_by_side([lambda d=d: merge.load_base(store, d) for d in DOMAINS], at_once)))
        covered = {d: store.raw(d).filter(F.col("batch_id") <= merge.base_upto(store, d)).select(*RAW_COLUMNS[d]) for d in DOMAINS}
        current = F.lit(0).alias(CLOSED)

        def star() -> None:
            guest, room, *_ = side_by_side([
                lambda: _table(store, "dim_guest").commit(dims.dim_guest(valid["guests"], as_of).select("*", current), stamp(as_of)),
                lambda: _table(store, "dim_room").commit(dims.dim_room(valid["rooms"], as_of).select("*", current), stamp(as_of)),
                lambda: store.replace(dims.dim_date(store.spark, first_day, n_days), CURATED, "dim_date", as_of),
                lambda: store.replace(dims.dim_hotel(valid["rooms"]), CURATED, "dim_hotel", as_of),
            ])
            side_by_side([lambda name=name, fact=fact: load(name, fact, guest, room) for name, fact in FACTS.items()], at_once)

        def load(name: str, fact: Fact, guest: DataFrame, room: DataFrame) -> None:
            rows = fact.build(valid[fact.domain], guest, room)
            _table(store, name).commit(rows.withColumn(fact.part, fact.month()), stamp(as_of))

        side_by_side([star, lambda: audit(store, covered, valid, as_of)])
        _mark_refreshed(store, position, as_of)


def hourly_increment(
    store: LakeStore, as_of: datetime, strict: bool = False, arrival: Sequence[str] = merge.ARRIVAL
) -> None:
    """Merge what arrived, then bring dimensions and facts up to date; an hour without data writes no table.

    What counts is whether CURATED has reached the committed merges, so a run that died
    between them and its tables is made up for by the next one.
    """
    numbered = {domain: Event() for domain in DOMAINS}

    def run(domain: str, before: Event | None) -> None:
        try:
            merge.run_merge(store, domain, strict, arrival, as_of, turn=before and before.wait, numbered=numbered[domain].set)
        finally:
            numbered[domain].set()

    with bounded(store.spark):
        # side by side, but each takes its numbers of the logs after the domain before it
        side_by_side([lambda d=d, before=numbered.get(b): run(d, before) for b, d in zip((None, *DOMAINS), DOMAINS)], store.at_once())
        if _merged(store) != _refreshed(store)[0]:
            refresh_curated(store, as_of)


def refresh_curated(store: LakeStore, as_of: datetime) -> None:
    """Dimension versions first, then the facts that the change reaches.

    A fact row is touched if its own row was merged, or if its guest or room has a version that was opened
    since the last refresh (facts left on a closed version would drop out of every KPI). Only the months with touched
    rows are written. All tables start from the versions before ``as_of``, which makes a repeated run give the same tables.
    """
    with bounded(store.spark), settled_until_end(store.spark):
        position = _merged(store)
        reached, refreshed_at = _refreshed(store, before=as_of)
        if refreshed_at is None:
            raise ValueError("run full_load first")
        guest, room = side_by_side([lambda name=name: _refresh_dimension(store, name, as_of) for name in DIMENSIONS])
        side_by_side([
            *[lambda name=name: _refresh_fact(store, name, guest, room, reached, refreshed_at, as_of) for name in FACTS],
            lambda: store.replace(dims.dim_hotel(room), CURATED, "dim_hotel", as_of),
        ], store.at_once())
        _mark_refreshed(store, position, as_of)


def _refresh_dimension(store: LakeStore, name: str, as_of: datetime) -> DataFrame:
    """The current versions. Those that close now are added to the closed part, which otherwise stays as it is."""
    domain, apply = DIMENSIONS[name]
    table = _table(store, name)
    base = table.latest(before=stamp(as_of))
    if base is None:
        raise ValueError("run full_load first")
    before = table.read(base, only=[0]).drop(CLOSED)
    after = apply(before, settle(merge.validated(store, domain), domain), as_of)
    rows = after.withColumn(CLOSED, F.when(F.col("is_current"), 0).otherwise(1))
    table.commit(rows, stamp(as_of), base=base, replace=[0], append=[1])
    return table.read(stamp(as_of), only=[0])


def _refresh_fact(
    store: LakeStore, name: str, guest: DataFrame, room: DataFrame, reached: dict[str, int], since: datetime, as_of: datetime,
) -> None:
    fact, table = FACTS[name], _table(store, name)
    key = DOMAINS[fact.domain].key

    def reached_rows(buckets: list[int] | None) -> DataFrame:
        rows = merge.validated(store, fact.domain, buckets)
        # one scan beside sets of changed keys, guests and rooms, which adaptive execution broadcasts while they are small
        changed = merge.changed_keys(store, fact.domain, reached[fact.domain], buckets)
        marked = rows.join(changed.withColumn("_changed", F.lit(True)), key, "left")
        touched = F.col("_changed").isNotNull()
        for used, column, dim in ((fact.guests, "guest_id", guest), (fact.rooms, "room_id", room)):
            if used:
                opened = dim.filter(F.col("is_current") & (F.col("effective_from") > F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")))
                marked = marked.join(opened.select(column, F.lit(True).alias(f"_{column}")), column, "left")
                touched = touched | F.col(f"_{column}").isNotNull()
        return fact.build(marked.filter(touched).select(*rows.columns), guest, room).withColumn(fact.part, fact.month())

    # buckets and months in turns, so that disk holds the shuffle files of one turn and not of the table; months are written with
    # half the shuffles and read all fresh rows each, so they take half as many
    turns = merge.turns(store, fact.domain)
    fresh = settle_all([reached_rows(buckets) for buckets in turns], name, at_once=1)
    base = table.latest(before=stamp(as_of))
    months = sorted(r[0] for r in fresh.select(fact.part).distinct().collect())
    if not months:
        return

    def whole(some: list[int]) -> DataFrame:
        new = fresh.filter(F.col(fact.part).isin(*some))
        kept = table.read(base, only=some).join(new.select(key), key, "left_anti")
        return kept.select(*fresh.columns).unionByName(new)

    n = -(-len(turns) // 2)
    parts = [some for k in range(n) if (some := months[k::n])]
    table.commit([whole(some) for some in parts], stamp(as_of), base=base, replace=months)


def curated(store: LakeStore, table: str, current: bool = False) -> DataFrame:
    """Newest version of a table, of a dimension only its ``current`` rows where these are asked for.

    Facts have their month as a column more, by which Spark leaves out parts.
    """
    if table in FACTS or table in DIMENSIONS:
        parts = _table(store, table)
        name = parts.latest()
        rows = None if name is None else parts.read(name, only=[0] if current and table in DIMENSIONS else None).drop(CLOSED)
    else:
        rows = store.latest(CURATED, table)
    if rows is None:
        raise ValueError(f"{table} has not been loaded")
    return rows


def run_anomalies(store: LakeStore, as_of: datetime) -> None:
    """All five rules into the anomaly log; repeating a run replaces its rows."""
    with bounded(store.spark), settled_until_end(store.spark):
        found = settle_all(anomalies.all_findings(
            curated(store, "fact_reservation"), curated(store, "fact_housekeeping"),
            curated(store, "fact_billing"), curated(store, "dim_room", current=True), as_of,
        ), "findings", store.at_once())
        first = store.reserve("anomaly_log", stamp(as_of), found.count())
        store.log_run(anomalies.anomaly_log(found, as_of, first - 1), CURATED, "anomaly_log", as_of)


def daily(store: LakeStore, as_of: datetime) -> None:
    """The anomaly rules, beside them the day's merge sources folded into new bases, and old versions dropped.

    Merge sources that the facts have not been refreshed from stay.
    """
    reached, _ = _refreshed(store)
    with bounded(store.spark):
        at_once = store.at_once()
        side_by_side([
            *[lambda d=d: merge.compact(store, d, read_upto=reached[d]) for d in DOMAINS], lambda: run_anomalies(store, as_of),
        ], len(DOMAINS) + 1 if at_once == AT_ONCE else at_once)
    for name in (*FACTS, *DIMENSIONS):
        _table(store, name).drop_old(KEEP_VERSIONS)


def register_views(store: LakeStore, role: str) -> None:
    """KPI views and the masked guest dimension as temporary views for SQL users."""
    stays, room = curated(store, "fact_reservation"), curated(store, "dim_room", current=True)
    tasks, bills = curated(store, "fact_housekeeping"), curated(store, "fact_billing")
    days = curated(store, "dim_date")
    views = {
        "kpi_occupancy": kpis.kpi_occupancy(stays, room, days),
        "kpi_conversion": kpis.kpi_conversion(stays, room, days),
        "kpi_hk_sla": kpis.kpi_hk_sla(tasks, room),
        "kpi_revpar": kpis.kpi_revpar(bills, stays, room, days),
        "kpi_billing_accuracy": kpis.kpi_billing_accuracy(bills),
        "dim_guest": governance.masked_dim_guest(curated(store, "dim_guest"), role),
    }
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)


def row_counts(store: LakeStore) -> DataFrame:
    """One count per table of the three layers, for a look after a load."""
    layers = {f"RAW {d.upper()}": rows for d, rows in _raw(store).items()}
    layers |= {f"VAL {d.upper()}": rows for d, rows in _valid(store).items()}
    for fact in ("reservation", "housekeeping", "billing"):
        layers[f"FACT {fact.upper()}"] = curated(store, f"fact_{fact}")
    return governance.row_counts(layers)
