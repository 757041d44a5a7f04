"""The queries that SQL can express, against DuckDB over the same tables."""

import duckdb
import pytest

from innlake.llm import queries

TEXTS = queries.all_texts()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_matches_duckdb(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got, want = queries.all_queries()[name](spark, sf_dir), con.sql(TEXTS[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in got.schema} == kinds
    expected = con.execute(f"select {', '.join(columns)} from ({TEXTS[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, expected))
