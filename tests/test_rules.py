"""Validation, anomaly rules and KPIs on small frames, against brute force."""

import random
from datetime import date, datetime, timedelta
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from innlake.plans import anomalies, governance, kpis, quality
from innlake.plans.dims import dim_date, dim_hotel
from innlake.plans.facts import fact_housekeeping, fact_reservation
from innlake.plans.validate import merge, merge_source, validate
from innlake.sources.schemas import RAW_COLUMNS, RAW_SCHEMAS

AS_OF = datetime(2024, 2, 1)


@pytest.fixture()
def raw(spark):
    def build(domain, *records):
        columns = RAW_COLUMNS[domain]
        data = [tuple(r.get(c) for c in columns) for r in records]
        return spark.createDataFrame(data, RAW_SCHEMAS[domain])
    return build


def keys(df, column):
    return sorted(r[column] for r in df.collect())


def findings(df):
    return sorted((r.entity_id or "", r.details) for r in df.collect())


# ---- validation -------------------------------------------------------------

def test_rule_applies_after_dedup(raw):
    df = raw("guests",
             {"guest_id": "g1", "name": "a", "email": "bad"}, {"guest_id": "g1", "name": "b", "email": "ok@x.yz"},
             {"guest_id": "g2", "name": "a", "email": "ok@x.yz"}, {"guest_id": " ", "email": "ok@x.yz"},
             {"guest_id": None, "email": "ok@x.yz"}, {"guest_id": "g3", "email": None})
    assert keys(validate("guests", df), "guest_id") == ["g2"]


def test_reservation_dates(raw):
    stay = lambda key, a, b: {"reservation_id": key, "check_in_date": a, "check_out_date": b, "status": " no_show "}
    df = raw("reservations", stay("r1", "2024-01-01", "2024-01-02"), stay("r2", "2024-01-01", "2024-01-01"),
             stay("r3", "2024-02-30", "2024-03-02"), stay("r4", None, "2024-03-02"))
    valid = validate("reservations", df)
    assert keys(valid, "reservation_id") == ["r1"]
    fact = fact_reservation(valid).first()
    assert (fact.is_no_show, fact.is_cancelled, fact.length_of_stay) == (True, False, 1)
    assert (fact.check_in_date_sk, fact.check_out_date_sk) == (20240101, 20240102)


def test_room_numbers(raw):
    room = lambda key, capacity, price, floor="1": {
        "room_id": key, "capacity": capacity, "base_price": price, "floor": floor, "status": "out_of_order"}
    df = raw("rooms", room("a", "2", "10"), room("b", "0", "10"), room("c", "2", "-5"), room("d", "x", "10"),
             room("e", "2.5", "0", "G"))
    got = {r.room_id: (r.capacity, r.floor, r.status) for r in validate("rooms", df).collect()}
    assert got == {"a": (2, 1, "Out_Of_Order"), "e": (3, None, "Out_Of_Order")}


def test_housekeeping_times(raw):
    task = lambda key, start, end: {"task_id": key, "start_time": start, "end_time": end, "issue_detected_flag": "y"}
    df = raw("housekeeping", task("open", "2024-01-01 10:00:00", None),
             task("done", "2024-01-01 10:00:59", "2024-01-01 10:01:01"),
             task("backwards", "2024-01-01 10:00:00", "2024-01-01 09:00:00"),
             task("no start", None, "2024-01-01 09:00:00"))
    valid = validate("housekeeping", df)
    assert keys(valid, "task_id") == ["done", "open"]
    durations = {r.task_id: r.duration_minutes for r in fact_housekeeping(valid).collect()}
    assert durations == {"open": None, "done": 1}


def test_merge_rules_are_looser_unless_strict(raw):
    changes = raw("billing", {"bill_id": " ", "total_amount": "1", "taxes": "-1", "discounts": "0"},
                  {"bill_id": "b", "total_amount": "1", "taxes": None, "discounts": "0"},
                  {"bill_id": "c", "total_amount": "-1", "taxes": "1", "discounts": "0"})
    assert keys(merge_source("billing", changes), "bill_id") == [" ", "b"]
    assert keys(merge_source("billing", changes, strict=True), "bill_id") == []


def test_merge_updates_named_columns_only(raw):
    old = validate("reservations", raw("reservations", {
        "reservation_id": "r", "room_id": "old", "check_in_date": "2024-01-01", "check_out_date": "2024-01-02",
        "cancellation_time": "2024-01-01 08:00:00", "status": "Cancelled"}))
    change = raw("reservations", {
        "reservation_id": "r", "room_id": "new", "check_in_date": "2024-05-01", "check_out_date": "2024-05-02",
        "status": "confirmed"})
    row = merge("reservations", old, change).first()
    assert (row.room_id, row.check_in_date, row.status, row.cancellation_time) == (
        "old", date(2024, 1, 1), "Confirmed", None)


# ---- audit ------------------------------------------------------------------

def test_every_rejected_row_is_explained(raw, spark):
    frames = {d: raw(d) for d in RAW_COLUMNS}
    frames["rooms"] = raw("rooms", *(
        [{"room_id": "a", "capacity": "1", "base_price": "1"}] * 4
        + [{"room_id": "b", "capacity": "0", "base_price": "1"}, {"room_id": "c", "capacity": "1", "base_price": "-1"},
           {"room_id": None}, {"room_id": "  "}]))
    valid = {d: validate(d, frames[d]) for d in frames}
    found = None
    for check in quality.all_exceptions(frames, valid):
        found = check if found is None else found.unionByName(check)
    log = quality.exception_log(found, AS_OF, 10).collect()
    assert sorted(r.exception_id for r in log) == list(range(11, 18))
    assert sorted((r.natural_key or "", r.error_type) for r in log) == [
        ("", "VALUE"), ("  ", "VALUE"), ("a", "DEDUP"), ("a", "DEDUP"), ("a", "DEDUP"), ("b", "VALUE"), ("c", "VALUE")]
    counts = {r.domain: (r.total_rows, r.passed_rows, r.failed_rows) for r in quality.load_log(frames, valid, AS_OF).collect()}
    assert counts.pop("ROOMS") == (8, 1, 7)
    assert list(counts.values()) == [(0, 0, 0)] * 4


def test_duplicates_unfold_in_chunks(raw, monkeypatch):
    monkeypatch.setattr(quality, "DUPLICATE_CHUNK", 3)
    for copies in (2, 3, 4, 5, 7, 8, 20):
        df = raw("rooms", *[{"room_id": "a"}] * copies)
        details = keys(quality.duplicate_exceptions("rooms", df), "error_detail")
        assert sorted(details) == sorted(f"copy {i} of {copies} for room_id" for i in range(2, copies + 1))


# ---- anomalies --------------------------------------------------------------

STAY = "reservation_id string, room_sk bigint, check_in_date_sk int, check_out_date_sk int, is_cancelled boolean"


def sk(day):
    return day.year * 10000 + day.month * 100 + day.day


def clashes(data):
    return sorted(
        (a[0], f"Overlaps with {b[0]} on room_sk {a[1]}")
        for a, b in permutations(data, 2)
        if a[1] is not None and a[1] == b[1] and not a[4] and not b[4] and a[2] < b[3] and a[3] > b[2])


def test_back_to_back_is_no_clash(rows):
    base = [("a", 1, 20240101, 20240103, False), ("b", 1, 20240103, 20240105, False)]
    assert findings(anomalies.double_booking(rows(base, STAY))) == []
    base.append(("c", 1, 20240101, 20240104, False))
    assert len(findings(anomalies.double_booking(rows(base, STAY)))) == 4


@pytest.mark.parametrize("seed", [1, 2])
def test_double_booking_against_all_pairs(rows, seed):
    random.seed(seed)
    data = []
    for n in range(220):
        first = date(1969, 6, 1) + timedelta(days=random.randrange(1200))
        nights = random.choice([1, 2, 3, 7, 8, 9, 16, 40, 511, 512, 513, 3000])
        room = random.choice([None, 1, 1, 1, 2, 3, 4, 5, 6])
        data.append((f"r{n}", room, sk(first), sk(first + timedelta(days=nights)), random.random() < 0.2))
    assert findings(anomalies.double_booking(rows(data, STAY))) == clashes(data)


def test_same_day_clash_reported_once_per_side(rows):
    data = [(k, 9, 20240101, 20240102, False) for k in "abc"]
    assert findings(anomalies.double_booking(rows(data, STAY))) == clashes(data)


TASK = ("task_id string, room_sk bigint, task_type string, start_time timestamp_ntz, end_time timestamp_ntz, "
        "duration_minutes bigint, issue_detected_flag boolean, status string")


def test_sla_breach_is_for_finished_cleaning(rows):
    data = [("a", 1, "CLEANING", None, None, 121, False, "Completed"), ("b", 1, "CLEANING", None, None, 120, False, "Completed"),
            ("c", 1, "INSPECTION", None, None, 500, False, "Completed"), ("d", 1, "CLEANING", None, None, 500, False, "In Progress")]
    assert findings(anomalies.hk_sla_breach(rows(data, TASK))) == [("a", "Cleaning took 121 mins (SLA: 120 mins)")]


def test_overdue_counts_hours_from_the_end(rows):
    end = lambda hours: AS_OF - timedelta(hours=hours)
    data = [("a", 1, "X", None, end(25), 1, True, "Completed"), ("b", 1, "X", None, end(24), 1, True, "Completed"),
            ("c", 1, "X", None, end(99), 1, False, "Completed"), ("d", 1, "X", None, None, 1, True, "Completed")]
    assert findings(anomalies.maintenance_overdue(rows(data, TASK), AS_OF)) == [
        ("a", "Issue unresolved — overdue by 25h")]


def test_follow_up_against_all_pairs(rows):
    random.seed(4)
    day = timedelta(hours=24)
    data = []
    for n in range(300):
        start = datetime(2024, 1, 1) + timedelta(minutes=random.randrange(0, 60 * 24 * 14, 30))
        end = None if random.random() < 0.1 else start + timedelta(minutes=random.choice([30, 60, 600]))
        data.append((f"t{n}", random.choice([None, 1, 1, 2, 3]), random.choice(["MAINTENANCE", "CLEANING", "CLEANING"]),
                     start, end, 1, random.random() < 0.5, "Completed"))
    late = lambda t: t[6] and t[4] is not None and int(AS_OF.timestamp() // 3600) - int(t[4].timestamp() // 3600) > 24
    answered = lambda t: any(f[2] == "MAINTENANCE" and t[1] is not None and f[1] == t[1] and t[4] <= f[3] <= t[4] + day for f in data)
    want = sorted(t[0] for t in data if late(t) and not answered(t))
    assert 0 < len(want) < sum(1 for t in data if late(t))
    assert keys(anomalies.maintenance_without_followup(rows(data, TASK), AS_OF), "entity_id") == want


def test_billing_mismatch_is_strictly_more_than_ten(spark):
    bills = spark.createDataFrame(
        [("a", "r", "110.00", "0", "0"), ("b", "r", "110.01", "0", "0"), ("c", "r", "89.99", "0", "0"),
         ("d", "r", "120.00", "15", "5"), ("e", "gone", "999", "0", "0"), ("f", None, "999", "0", "0")],
        "bill_id string, reservation_id string, total_amount string, taxes string, discounts string",
    ).select("bill_id", "reservation_id", *[F.col(c).cast("decimal(12,2)") for c in ("total_amount", "taxes", "discounts")])
    stays = spark.createDataFrame([("r", 7, 2)], "reservation_id string, room_sk bigint, length_of_stay bigint")
    room = spark.sql("select 7L room_sk, 50.00BD base_price, true is_current")
    assert findings(anomalies.billing_mismatch(bills, stays, room)) == [
        ("b", "Billed $110.01 vs expected $100.00"), ("c", "Billed $89.99 vs expected $100.00")]


CANCEL = "guest_sk bigint, cancellation_time timestamp_ntz, is_cancelled boolean"


def test_stray_cancellation_hides_a_burst_only_for_the_whole_span_rule(rows):
    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    data = [(1, at(h), True) for h in (0, 5, 10, 24)] + [(2, at(h), True) for h in (0, 1, 2, 3, 9000)]
    data += [(3, at(h), True) for h in (0, 1, 2)] + [(None, at(h), True) for h in (0, 1, 2, 3, 4)]
    data += [(4, None, True)] * 5 + [(5, at(0), False)] * 5
    df = rows(data, CANCEL)
    assert findings(anomalies.suspicious_cancellation(df)) == [
        ("", "5 cancellations within 24h"), ("1", "4 cancellations within 24h")]
    assert findings(anomalies.cancellation_sliding(df)) == [
        ("", "5 cancellations within 24h"), ("1", "4 cancellations within 24h"), ("2", "4 cancellations within 24h")]


def test_sliding_window_against_brute_force(rows):
    random.seed(8)
    data = [(random.choice([None, 1, 1, 2, 3, 4]), datetime(2024, 1, 1) + timedelta(minutes=random.randrange(0, 60 * 24 * 20, 90)), True)
            for _ in range(160)]
    want = {}
    for guest, t, _ in data:
        n = sum(1 for g, u, _ in data if g == guest and t - timedelta(hours=24) <= u <= t)
        want[guest] = max(n, want.get(guest, 0))
    expected = sorted(("" if g is None else str(g), f"{n} cancellations within 24h") for g, n in want.items() if n > 3)
    assert findings(anomalies.cancellation_sliding(rows(data, CANCEL))) == expected


# ---- KPIs and views ---------------------------------------------------------

def test_occupancy_may_exceed_a_hundred(spark):
    stays = spark.createDataFrame(
        [("a", 1, 20240105, "Confirmed"), ("b", 1, 20240120, "Confirmed"), ("c", 2, 20240107, "Cancelled"),
         ("d", None, 20240107, "Confirmed"), ("e", 1, 20300101, "Confirmed"), ("f", 9, 20240101, "Confirmed")],
        "reservation_id string, room_sk bigint, check_in_date_sk int, status string")
    room = spark.createDataFrame([(1, "H", True), (2, "H", True), (9, "H", False), (3, "I", True)], "room_sk bigint, hotel_id string, is_current boolean")
    got = kpis.kpi_occupancy(stays, room, dim_date(spark)).collect()
    assert [tuple(r) for r in got] == [("H", 2024, 1, 2, 2, 100.0)]


def test_hotel_without_id_is_kept(rows):
    rooms = rows([("H1",), ("H1",), (None,)], "hotel_id string")
    assert sorted(map(tuple, dim_hotel(rooms).collect()), key=str) == [("H1", "Unknown", "Unknown"), (None, "Unknown", "Unknown")]


def test_row_access(rows):
    data = rows([("a", "H1"), ("b", "H2"), ("c", None)], "room_id string, hotel_id string")
    grants = rows([("DESK", "H1"), ("DESK", "H1"), ("OTHER", "H2")], "role string, hotel_id string")
    assert keys(governance.row_access_view(data, grants, "DESK"), "room_id") == ["a"]
    assert keys(governance.row_access_view(data, grants, "NOBODY"), "room_id") == []
    assert keys(governance.row_access_view(data, grants, "ACCOUNTADMIN"), "room_id") == ["a", "b", "c"]
