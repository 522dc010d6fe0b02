"""Parquet table reads with an explicit, pruned schema.

Every read names the columns it needs, so the scan's ``ReadSchema`` holds
only those columns and no schema-inference pass is made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column types of the provided tables (only the columns our operators use).
COLUMN_TYPES: dict[str, dict[str, str]] = {
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
        "l_linenumber": "int",
    },
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint"},
    "supplier": {"s_suppkey": "bigint"},
    "events": {"event_id": "bigint", "user_id": "bigint"},
    "documents": {"doc_id": "bigint", "text": "string"},
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str]) -> DataFrame:
    """Read ``columns`` of table ``name`` from ``sf_dir``."""
    types = COLUMN_TYPES[name]
    ddl = ", ".join(f"{c} {types[c]}" for c in columns)
    return spark.read.schema(ddl).parquet(table_path(sf_dir, name))
