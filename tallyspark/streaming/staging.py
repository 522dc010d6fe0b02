"""Bounded micro-batches over the ``events`` table.

A file source takes whole files, oldest first.  A table of several files is
rate-limited as it is.  A table of one file is first written as one file per
micro-batch, with modification times in batch order, so that a stream over it
runs as many micro-batches and meets them in a known order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import scratch_path
from tallyspark.sources.tables import read_table
from tallyspark.streaming.runner import _fs

EVENT_COLUMNS = "event_id bigint, user_id bigint"
STEP_COL = "step"


def stage_steps(df: DataFrame, step: Column, name: str) -> str:
    """Write ``df`` as one file per value of ``step`` (null: 0), oldest file
    first in the order of the values; return the folder.

    Modification times are set a second apart, one call per step.  A store that
    does not keep them is refused, as its file order would be unknown.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, name)
    (df.withColumn(STEP_COL, F.coalesce(step.cast("bigint"), F.lit(0))).repartitionByRange(STEP_COL)
     .write.partitionBy(STEP_COL).parquet(folder))
    fs, hpath = _fs(spark, folder)
    steps = sorted((int(st.getPath().getName().split("=", 1)[1]), st.getPath())
                   for st in fs.listStatus(hpath) if st.isDirectory())
    newest = max((fs.getFileStatus(p).getModificationTime() for _, p in steps), default=0)
    for k, (_, path) in enumerate(steps):
        at = (newest // 1000 - len(steps) + k) * 1000
        for st in fs.listStatus(path):
            fs.setTimes(st.getPath(), at, -1)
            if fs.getFileStatus(st.getPath()).getModificationTime() != at:
                raise RuntimeError(f"{folder} keeps no modification times; stage on another file system")
    return folder


def stream_steps(spark: SparkSession, folder: str, schema: str = EVENT_COLUMNS) -> DataFrame:
    """Stream a staged folder, one step a micro-batch."""
    return (spark.readStream.schema(f"{schema}, {STEP_COL} bigint").option("maxFilesPerTrigger", 1)
            .parquet(folder).drop(STEP_COL))


def events_in_steps(spark: SparkSession, sf_dir: str, steps: int) -> DataFrame:
    """Streaming ``(event_id, user_id)`` of the ``events`` table in ``steps``
    micro-batches of equal ranges of ids: step ``event_id * steps div (largest
    id + 1)``.  Ids are not negative."""
    events = read_table(spark, sf_dir, "events", ["event_id", "user_id"])
    largest = events.agg(F.max("event_id")).scalar()
    step = F.floor(F.col("event_id").cast("decimal(38,0)") * steps / (largest + 1))
    return stream_steps(spark, stage_steps(events, step, "event-steps"))


def events_in_batches(spark: SparkSession, sf_dir: str, per_batch: int) -> DataFrame:
    """The same with one micro-batch per ``event_id div per_batch``."""
    events = read_table(spark, sf_dir, "events", ["event_id", "user_id"])
    return stream_steps(spark, stage_steps(events, F.expr(f"event_id div {int(per_batch)}"), "event-batches"))
