"""Frequency statistics of an item stream: exact histogram, count-sketch,
second moments, top-k.

Input: a DataFrame with a bigint ``item`` column (and ``batch`` where the
micro-batch matters).  The aggregations used by the streaming runner
(:func:`interval_histogram`, :func:`count_sketch`, :func:`stream_length`)
are plain ``groupBy``/``agg`` so they run unchanged as stateful streaming
aggregations.  The rest are batch operators over their results.

Sketch rows.  A count-sketch with D rows and W columns takes, per row
``j``, a bucket hash ``h_j`` (params ``a, b``) and a sign hash ``g_j``
(params ``ga, gb``).  Every item occurrence adds ``g_j(x)`` to cell
``(j, h_j(x))`` of every row.  The D-fold fan-out is a literal array of
parameter structs exploded per item (bounded by D, a parameter); the
sum per ``(row, col)`` is combined map-side, so each task ships at most
D*W partial rows whatever the skew of the items.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.hashing import DEFAULT_PRIME, bucket_hash, low32, sign_hash

SketchParams = Sequence[tuple[int, int, int, int]]

# Batches per block of the two-level running total in :func:`stream_prefix`.
PREFIX_BLOCK = 4096


# ---------------------------------------------------------------------------
# Exact statistics
# ---------------------------------------------------------------------------

def in_interval(items: DataFrame, left: int, right: int) -> DataFrame:
    """Items strictly between ``left`` and ``right`` (both ends excluded)."""
    return items.where((F.col("item") > F.lit(left)) & (F.col("item") < F.lit(right)))


def item_histogram(items: DataFrame) -> DataFrame:
    """``(item, n)``: exact frequency of every item."""
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def interval_histogram(items: DataFrame, left: int, right: int) -> DataFrame:
    """``(item, n)`` for the items in the open interval ``(left, right)``."""
    return item_histogram(in_interval(items, left, right))


def batch_item_counts(items: DataFrame) -> DataFrame:
    """``(batch, item, n)``: frequencies inside each micro-batch."""
    return items.groupBy("batch", "item").agg(F.count(F.lit(1)).alias("n"))


def batch_sizes(items: DataFrame) -> DataFrame:
    """``(batch, n_items)`` for every non-empty micro-batch."""
    return items.groupBy("batch").agg(F.count(F.lit(1)).alias("n_items"))


def stream_length(items: DataFrame) -> DataFrame:
    """``(n_items)``: number of items seen."""
    return items.agg(F.count(F.lit(1)).alias("n_items"))


def distinct_items(hist: DataFrame) -> DataFrame:
    """``(n_distinct)``: number of distinct items of a histogram."""
    return hist.agg(F.count(F.lit(1)).alias("n_distinct"))


def largest_item(hist: DataFrame) -> DataFrame:
    """``(largest_item)``: the largest item, never below 0 (the original
    starts its running maximum at 0)."""
    return hist.agg(F.greatest(F.coalesce(F.max("item"), F.lit(0)), F.lit(0))
                    .cast("bigint").alias("largest_item"))


def _sum_of_squares(c: str) -> Column:
    """``sum(c^2)`` as a double, summed exactly in decimal(38,0): a key
    holding a third of 10^12 items has a square near 10^23, past 64 bits."""
    x = F.col(c).cast("decimal(20,0)")
    return F.sum(x * x).cast("double")


def second_moment_true(hist: DataFrame) -> DataFrame:
    """``(f2, n_distinct, f2_normalized)``: ``F2 = sum n^2`` and
    ``F2 / n_distinct^2`` (NULL for an empty histogram)."""
    agg = hist.agg(_sum_of_squares("n").alias("f2"),
                   F.count(F.lit(1)).alias("n_distinct"))
    d = F.col("n_distinct").cast("double")
    return agg.select(
        F.coalesce(F.col("f2"), F.lit(0.0)).alias("f2"), "n_distinct",
        (F.col("f2") / F.nullif(d * d, F.lit(0.0))).alias("f2_normalized"))


# ---------------------------------------------------------------------------
# Count-sketch
# ---------------------------------------------------------------------------

def _rows(params: SketchParams) -> Column:
    if not params:
        raise ValueError("a sketch needs at least one row of parameters")
    return F.array(*[
        F.struct(F.lit(j).alias("row_idx"), F.lit(int(a)).cast("bigint").alias("ha"),
                 F.lit(int(b)).cast("bigint").alias("hb"),
                 F.lit(int(ga)).cast("bigint").alias("ga"),
                 F.lit(int(gb)).cast("bigint").alias("gb"))
        for j, (a, b, ga, gb) in enumerate(params)])


def _with_rows(df: DataFrame, params: SketchParams, width: int, p: int,
               keep: Sequence[str], narrow32: bool = False) -> DataFrame:
    x = df.select(*keep, F.explode(_rows(params)).alias("r"))
    key = low32("item") if narrow32 else F.col("item")
    return x.select(
        *keep, F.col("r.row_idx").alias("row_idx"),
        bucket_hash(key, F.col("r.ha"), F.col("r.hb"), width, p).alias("col_idx"),
        sign_hash(key, F.col("r.ga"), F.col("r.gb"), p).alias("sign"))


def sketch_hashes(items: DataFrame, params: SketchParams, width: int,
                  p: int = DEFAULT_PRIME, narrow32: bool = False) -> DataFrame:
    """``(row_idx, item, col_idx, sign)`` for every distinct item and row.

    ``narrow32`` hashes the low 32 bits of the item (two's complement), as
    the original does for 64-bit items; equal to the default for
    ``|item| < 2**31``.
    """
    distinct = items.select("item").distinct()
    return _with_rows(distinct, params, width, p, ["item"], narrow32).select(
        "row_idx", "item", "col_idx", "sign")


def count_sketch(items: DataFrame, params: SketchParams, width: int,
                 p: int = DEFAULT_PRIME, narrow32: bool = False) -> DataFrame:
    """``(row_idx, col_idx, value)``: the non-empty cells of the count-sketch."""
    x = _with_rows(items, params, width, p, ["item"], narrow32)
    return x.groupBy("row_idx", "col_idx").agg(F.sum("sign").cast("bigint").alias("value"))


def count_sketch_from_counts(counts: DataFrame, params: SketchParams, width: int,
                             p: int = DEFAULT_PRIME, narrow32: bool = False) -> DataFrame:
    """Count-sketch from pre-aggregated ``(item, n)`` counts (e.g. per
    micro-batch): every cell gets ``g(x) * n``.  ``(row_idx, col_idx, value)``."""
    x = _with_rows(counts, params, width, p, ["item", "n"], narrow32)
    return x.groupBy("row_idx", "col_idx").agg(
        F.sum(F.col("sign") * F.col("n")).cast("bigint").alias("value"))


#: ``row_idx`` of the histogram's rows in :func:`histogram_and_sketch`
HISTOGRAM = -1


def histogram_and_sketch(items: DataFrame, params: SketchParams, width: int,
                         p: int = DEFAULT_PRIME) -> DataFrame:
    """``(row_idx, cell, value)``: the item histogram (row :data:`HISTOGRAM`,
    cell = item) and the count-sketch (cell = column) in one aggregation, so
    that a source that cannot be replayed is read once."""
    count = F.struct(F.lit(HISTOGRAM).alias("row_idx"), F.col("item").cast("bigint").alias("cell"),
                     F.lit(1).cast("bigint").alias("value"))
    cells = F.transform(_rows(params), lambda r: F.struct(
        r["row_idx"].alias("row_idx"),
        bucket_hash(F.col("item"), r["ha"], r["hb"], width, p).cast("bigint").alias("cell"),
        sign_hash(F.col("item"), r["ga"], r["gb"], p).cast("bigint").alias("value")))
    x = items.select(F.explode(F.concat(F.array(count), cells)).alias("c")).select("c.*")
    return x.groupBy("row_idx", "cell").agg(F.sum("value").alias("value"))


def split_histogram_and_sketch(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(item, n)`` and ``(row_idx, col_idx, value)`` of the joint result."""
    hist = cells.where(F.col("row_idx") == HISTOGRAM).select(
        F.col("cell").alias("item"), F.col("value").alias("n"))
    sketch = cells.where(F.col("row_idx") != HISTOGRAM).select(
        "row_idx", F.col("cell").alias("col_idx"), "value")
    return hist, sketch


def second_moment_rows(sketch: DataFrame) -> DataFrame:
    """``(row_idx, f2)``: per-row estimate ``sum_col value^2``."""
    return sketch.groupBy("row_idx").agg(_sum_of_squares("value").alias("f2"))


def second_moment_approx(sketch: DataFrame, hist: DataFrame) -> DataFrame:
    """``(f2_median, f2_normalized)``: median over rows of the row
    estimates, and that median divided by ``n_distinct^2`` of ``hist``."""
    d = hist.agg(F.count(F.lit(1)).cast("double")).scalar()
    med = second_moment_rows(sketch).agg(F.percentile("f2", 0.5).alias("f2_median"))
    return med.select(
        "f2_median",
        (F.col("f2_median") / F.nullif(d * d, F.lit(0.0))).alias("f2_normalized"))


def sketch_point_estimates(hist: DataFrame, sketch: DataFrame, params: SketchParams,
                           width: int, p: int = DEFAULT_PRIME,
                           narrow32: bool = False) -> DataFrame:
    """``(item, n, estimate)``: count-sketch frequency estimate
    ``median_j g_j(x) * M[j][h_j(x)]`` for every item of ``hist``.

    The sketch is one array of its D*W cells, parameters of the query, and
    each item reads its D cells and takes their median in its own row: the
    histogram is not shuffled again.
    """
    rows = len(params)
    if not rows:
        raise ValueError("a sketch needs at least one row of parameters")
    filled = sketch.select((F.col("row_idx") * F.lit(width) + F.col("col_idx")).cast("bigint").alias("cell"),
                           "value")
    empty = hist.sparkSession.range(rows * width).select(
        F.col("id").alias("cell"), F.lit(0).cast("bigint").alias("value"))
    dense = filled.union(empty).groupBy("cell").agg(F.sum("value").alias("value"))
    matrix = dense.agg(F.transform(
        F.sort_array(F.collect_list(F.struct("cell", "value"))), lambda c: c["value"])).scalar()
    key = low32("item") if narrow32 else F.col("item")
    signed = F.array(*[
        sign_hash(key, int(ga), int(gb), p)
        * F.get("matrix", (F.lit(j * width) + bucket_hash(key, int(a), int(b), width, p)).cast("int"))
        for j, (a, b, ga, gb) in enumerate(params)])
    ranked = hist.select("item", "n", matrix.alias("matrix")).select(
        "item", "n", F.sort_array(signed).alias("e"))
    low, high = F.col("e")[(rows - 1) // 2], F.col("e")[rows // 2]
    return ranked.select("item", "n", ((low.cast("double") + high) / 2).alias("estimate"))


# ---------------------------------------------------------------------------
# Top-k
# ---------------------------------------------------------------------------

def topk_items(hist: DataFrame, k: int) -> DataFrame:
    """``(item, n, rank)`` for items of rank <= k by frequency, ties kept
    (``rank = 1 + #items with a larger n``).

    No global window over the histogram: the k-th largest frequency comes
    from a bounded top-k (``orderBy.limit``), and ranks are computed over
    the at most k distinct frequencies at or above it.
    """
    threshold = hist.select("n").orderBy(F.col("n").desc()).limit(k) \
        .agg(F.min("n")).scalar()
    cand = hist.where(F.col("n") >= threshold)
    freq = cand.groupBy("n").agg(F.count(F.lit(1)).alias("cnt"))  # <= k rows
    above = Window.orderBy(F.col("n").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    ranks = freq.select(
        "n", (F.coalesce(F.sum("cnt").over(above), F.lit(0)) + 1)
        .cast("bigint").alias("rank"))
    return cand.join(F.broadcast(ranks), "n").select("item", "n", "rank")


def topk_avg_relative_error(hist: DataFrame, sketch: DataFrame, params: SketchParams,
                            width: int, k: int, p: int = DEFAULT_PRIME,
                            narrow32: bool = False) -> DataFrame:
    """``(k_items, avg_relative_error)``: mean of ``|n - estimate| / n``
    over the top-k items (ties kept), rounded to 9 decimals."""
    top = topk_items(hist, k).select("item", "n")
    est = sketch_point_estimates(top, sketch, params, width, p, narrow32)
    return est.agg(
        F.count(F.lit(1)).alias("k_items"),
        F.round(F.avg(F.abs(F.col("n") - F.col("estimate")) / F.col("n")), 9)
        .alias("avg_relative_error"))


# ---------------------------------------------------------------------------
# Stopping threshold (whole batches until the running total reaches T)
# ---------------------------------------------------------------------------

def stream_prefix(items: DataFrame, threshold: int) -> DataFrame:
    """``(n_batches, n_items)`` taken by "process whole batches while the
    running total is below ``threshold``" (the last batch overshoots).

    A batch is taken iff the items of all earlier batches number fewer
    than ``threshold``.  The running total is two-level: an exclusive sum
    inside blocks of ``PREFIX_BLOCK`` consecutive batch ids (bounded
    window partitions) plus the total of all earlier blocks (a window over
    the ``#batches / PREFIX_BLOCK`` block totals).
    """
    per_batch = items.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    per_batch = per_batch.withColumn("blk", F.expr(f"batch div {PREFIX_BLOCK}"))
    in_block = Window.partitionBy("blk").orderBy("batch").rowsBetween(
        Window.unboundedPreceding, -1)
    local = per_batch.withColumn(
        "before_in_blk", F.coalesce(F.sum("n").over(in_block), F.lit(0)))
    # ordered by their first batch and joined null-safe (no filter on one side
    # alone), so that both branches read the same rows and share one scan
    blocks = per_batch.groupBy("blk").agg(F.sum("n").alias("blk_n"), F.min("batch").alias("first"))
    earlier = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        F.col("blk").alias("b"), F.coalesce(F.sum("blk_n").over(earlier), F.lit(0)).alias("blk_offset"))
    taken = (local.join(offsets, F.col("blk").eqNullSafe(F.col("b")))
             .where(F.col("blk_offset") + F.col("before_in_blk") < F.lit(threshold)))
    return taken.agg(F.count(F.lit(1)).alias("n_batches"),
                     F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_items"))
