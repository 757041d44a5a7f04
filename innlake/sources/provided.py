"""Typed readers for the provided tables, without a schema-inference pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# columns the feeds use, with their stored types
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "documents": "doc_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A provided table. A file may be one row group, which one task reads; ``spread_by`` deals its rows to all cores before they are worked on."""
    rows = spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")
    return rows if spread_by is None else rows.hint("rebalance", spread_by)
