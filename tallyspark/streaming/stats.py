"""Stream statistics as Structured Streaming queries.

Each function takes a *streaming* items DataFrame (bigint ``item``),
runs the matching operator of :mod:`tallyspark.operators.sketch` as a
stateful streaming aggregation to the end of the available input, and
returns the result as a batch DataFrame.  Results equal the batch
operators on the same items, however the input is split into batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.hashing import DEFAULT_PRIME
from tallyspark.operators import sketch as S
from tallyspark.streaming.runner import run_batch_sizes, run_complete, run_state, run_until_threshold


def stream_length(items: DataFrame) -> DataFrame:
    """``(n_items)``; global count, complete mode (one state row).  An
    empty stream runs no micro-batch; it reports 0 like the batch count."""
    out = run_complete(S.stream_length(items), "stream-length")
    return out.agg(F.coalesce(F.max("n_items"), F.lit(0)).cast("bigint").alias("n_items"))


def stream_interval_histogram(items: DataFrame, left: int, right: int) -> DataFrame:
    """``(item, n)`` for items in ``(left, right)``, read from the state of
    the finished query; no batch writes an output."""
    hist = S.interval_histogram(items, left, right)
    return run_state(hist, "stream-histogram", keys=["item"])


def stream_distinct_items(items: DataFrame, left: int, right: int) -> DataFrame:
    """``(n_distinct)`` of the streamed interval histogram."""
    return S.distinct_items(stream_interval_histogram(items, left, right))


def stream_count_sketch(items: DataFrame, params: S.SketchParams, width: int,
                        p: int = DEFAULT_PRIME) -> DataFrame:
    """``(row, col, value)`` of the count-sketch over all streamed items;
    complete mode (at most D*W state rows)."""
    return run_complete(S.count_sketch(items, params, width, p), "stream-sketch")


def stream_histogram_and_sketch(items: DataFrame, left: int, right: int, params: S.SketchParams,
                                width: int, p: int = DEFAULT_PRIME) -> tuple[DataFrame, DataFrame]:
    """``(item, n)`` and ``(row, col, value)`` over the items in ``(left,
    right)`` from one query, so that the stream is read once; read from its state."""
    inside = S.in_interval(items, left, right)
    cells = run_state(S.histogram_and_sketch(inside, params, width, p), "stream-cells",
                      keys=["row_idx", "cell"])
    return S.split_histogram_and_sketch(cells)


def stream_batch_sizes(items: DataFrame) -> DataFrame:
    """``(batch_id, n_items)`` of every non-empty micro-batch."""
    return run_batch_sizes(items)


def stream_until_threshold(items: DataFrame, threshold: int) -> DataFrame:
    """``(n_batches, n_items)`` that a running query takes until it stops
    itself: whole micro-batches while fewer than ``threshold`` items are taken."""
    per_batch = run_until_threshold(items, threshold).groupBy("batch_id").agg(F.sum("n").alias("n"))
    return per_batch.agg(F.count(F.lit(1)).alias("n_batches"),
                         F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_items"))
