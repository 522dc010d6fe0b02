"""Materialise an intermediate result as a parquet table in the shared
checkpoint folder.

Used where one intermediate feeds several branches of a plan (the edge
set of a triangle query is scanned three times by the self-join).  The
branches get different inferred filters, so Spark would otherwise
recompute the whole lineage -- scan, explode, distinct, degree joins --
once per branch.  Writing it once:

* cuts the lineage: a lost executor costs a re-read, not a recompute;
* gives AQE exact sizes for the joins that follow;
* keeps the data on shared storage (``spark.checkpoint.dir``), never on
  a machine-local folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyspark.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder; return a scan of it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
