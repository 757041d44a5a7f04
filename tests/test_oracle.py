"""Every registered result against DuckDB over the same tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from innlake.queries import all_queries
from oracle.texts import all_texts

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, TEXTS = all_queries(), all_texts()
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_a_text():
    assert set(QUERIES) == set(TEXTS)
    assert set(QUERIES) <= set(contract.queries()) and set(TEXTS) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.sql(TEXTS[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    types = dict(zip(want.columns, map(str, want.types)))
    for field in got.schema:
        simple = field.dataType.simpleString()
        assert TYPES.get(simple, simple.upper()) == types[field.name], field.name
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = duck.execute(f"select {picked} from ({TEXTS[name]})").fetchall()
    actual = [tuple(r) for r in got.select(*columns).collect()]
    assert sorted(map(repr, actual)) == sorted(map(repr, expected))
    assert actual


def test_entry(spark, sf_dir):
    rows = contract.entry(spark).collect()
    assert len(rows) == 857
    assert sum(r.total_reservations for r in rows) == 1291
    assert sum(r.no_shows for r in rows) == 102


# totals of FIXTURES.md at the smallest scale
@pytest.mark.parametrize("name,count", [
    ("raw_guests", 160), ("raw_reservations", 1530), ("raw_rooms", 200),
    ("raw_housekeeping", 1000), ("raw_billing", 1500),
    ("validate_guests", 142), ("validate_reservations", 1395), ("validate_rooms", 193),
    ("validate_housekeeping", 977), ("validate_billing", 1446),
    ("dq_reservation_guest_fk", 82), ("dq_housekeeping_room_fk", 47), ("dim_hotel", 20),
    ("anomaly_double_booking", 32), ("anomaly_hk_sla_breach", 23),
    ("anomaly_maintenance_overdue", 106), ("anomaly_billing_mismatch", 78),
    ("anomaly_suspicious_cancellation", 3),
    ("kpi_occupancy", 857), ("kpi_hk_sla", 74), ("kpi_revpar", 838), ("kpi_billing_accuracy", 80),
])
def test_fixture_totals(spark, sf_dir, name, count):
    assert QUERIES[name](spark, sf_dir).count() == count
