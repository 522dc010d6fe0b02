"""Registered queries: name -> ``fn(spark, sf_dir) -> DataFrame``.

Every query reads the provided tables of ``sf_dir`` (whole tables, whole
texts) and composes the operators with the literal parameters of
:mod:`tallyspark.plans.params`.  Names match ``oracles.ORACLE_SQL``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import graph as G
from tallyspark.operators import sketch as S
from tallyspark.operators import wordcount as W
from tallyspark.plans import params as P
from tallyspark.session import scratch_path
from tallyspark.sources import fixtures as X
from tallyspark.sources import files as FS
from tallyspark.streaming import stats as ST
from tallyspark.streaming.staging import events_in_batches, events_in_steps

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return X.document_lines(X.documents(spark, sf))


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return X.raw_edges(spark, sf)


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return X.items(spark, sf)


def _hist(spark: SparkSession, sf: str) -> DataFrame:
    return S.interval_histogram(_items(spark, sf), P.LEFT, P.RIGHT)


def _sketch(spark: SparkSession, sf: str) -> DataFrame:
    inside = S.in_interval(_items(spark, sf), P.LEFT, P.RIGHT)
    return S.count_sketch(inside, P.SKETCH_ROWS, P.SKETCH_WIDTH, P.P)


def _stream_items(spark: SparkSession, sf: str) -> DataFrame:
    """The events in :data:`P.STREAM_STEPS` micro-batches."""
    return X.events_to_items(events_in_steps(spark, sf, P.STREAM_STEPS)).select("item")


# ---------------------------------------------------------------------------
# Text
# ---------------------------------------------------------------------------

@query
def document_lines(spark, sf):
    return _lines(spark, sf).select("doc_id", "line_no", F.col("text").alias("line"))


@query
def document_count(spark, sf):
    return W.document_count(_lines(spark, sf))


@query
def doc_tokens(spark, sf):
    return W.doc_tokens(_lines(spark, sf))


@query
def doc_term_counts(spark, sf):
    return W.doc_term_counts(_lines(spark, sf))


@query
def word_count(spark, sf):
    return W.word_count(_lines(spark, sf))


@query
def word_count_salted(spark, sf):
    return W.word_count_salted(_lines(spark, sf), P.NUM_SALTS, P.SALT_SEED)


@query
def word_count_salted_at_shuffle(spark, sf):
    return W.word_count_salted_at_shuffle(_lines(spark, sf), P.NUM_SALTS, P.SALT_SEED)


@query
def word_count_by_partition(spark, sf):
    return W.word_count_by_partition(_lines(spark, sf))


@query
def distinct_words(spark, sf):
    return W.distinct_words(_lines(spark, sf))


@query
def average_word_length(spark, sf):
    return W.average_word_length(_lines(spark, sf))


@query
def text_file_word_count(spark, sf):
    """The documents written as a text file, read back line by line (each
    line a document), then counted."""
    path = scratch_path(spark, "documents-text")
    X.documents(spark, sf).select("text").write.text(path)
    return W.word_count(FS.read_text_documents(spark, path), id_cols=["doc_id"])


# ---------------------------------------------------------------------------
# Graph
# ---------------------------------------------------------------------------

@query
def edge_count(spark, sf):
    return G.edge_count(_edges(spark, sf))


@query
def distinct_directed_edges(spark, sf):
    return G.distinct_directed_edges(_edges(spark, sf))


@query
def canonical_edges(spark, sf):
    return G.canonical_edges(_edges(spark, sf))


@query
def adjacency(spark, sf):
    return G.adjacency(_edges(spark, sf))


@query
def graph_summary(spark, sf):
    return G.graph_summary(_edges(spark, sf))


@query
def triangles_exact(spark, sf):
    return G.triangles_exact(_edges(spark, sf))


@query
def triangles_exact_hub_split(spark, sf):
    """C3 with the hubs' neighbourhoods as bitmaps."""
    return G.triangles_hub_split(_edges(spark, sf))


@query
def triangles_exact_id_order(spark, sf):
    return G.triangles_exact(_edges(spark, sf), order="id")


@query
def node_colors(spark, sf):
    a, b = P.COLOR_RUNS[0]
    return G.node_colors(_edges(spark, sf), a, b, P.NUM_COLORS, P.P)


@query
def monochromatic_edges(spark, sf):
    a, b = P.COLOR_RUNS[0]
    return G.monochromatic_edges(_edges(spark, sf), a, b, P.NUM_COLORS, P.P)


@query
def triangles_per_color(spark, sf):
    a, b = P.COLOR_RUNS[0]
    return G.triangles_per_color(_edges(spark, sf), a, b, P.NUM_COLORS, P.P)


@query
def triangles_approx_color(spark, sf):
    a, b = P.COLOR_RUNS[0]
    return G.triangles_approx_color(_edges(spark, sf), a, b, P.NUM_COLORS, P.P)


@query
def triangles_approx_color_large_prime(spark, sf):
    a, b = P.LARGE_RUN
    return G.triangles_approx_color(_edges(spark, sf), a, b, P.NUM_COLORS, P.LARGE_P)


@query
def triangles_approx_color_runs(spark, sf):
    return G.triangles_approx_color_runs(_edges(spark, sf), P.COLOR_RUNS, P.NUM_COLORS, P.P)


@query
def triangles_approx_color_table(spark, sf):
    """D11 over the runs of a parameter table."""
    runs = G.run_parameters(spark, P.NUM_RUNS, P.RUN_SEED, P.P)
    return G.triangles_approx_color_runs(_edges(spark, sf), runs, P.NUM_COLORS, P.P)


@query
def triangles_approx_color_mean(spark, sf):
    return G.mean_estimate(triangles_approx_color_runs(spark, sf))


@query
def triangles_approx_color_median(spark, sf):
    return G.median_estimate(triangles_approx_color_runs(spark, sf))


@query
def triangles_approx_color_median_even(spark, sf):
    runs = G.triangles_approx_color_runs(_edges(spark, sf), P.EVEN_RUNS, P.NUM_COLORS, P.P)
    return G.median_estimate(runs)


@query
def edge_color_triples(spark, sf):
    a, b = P.COLOR_RUNS[0]
    return G.edge_color_triples(_edges(spark, sf), a, b, P.NUM_COLORS, P.P)


@query
def triangles_per_color_triple(spark, sf):
    a, b = P.COLOR_RUNS[0]
    return G.triangles_per_color_triple(_edges(spark, sf), a, b, P.NUM_COLORS, P.P)


@query
def triangles_exact_colored(spark, sf):
    a, b = P.COLOR_RUNS[0]
    return G.triangles_exact_colored(_edges(spark, sf), a, b, P.NUM_COLORS, P.P)


@query
def triangles_per_edge_bucket(spark, sf):
    return G.triangles_per_edge_bucket(_edges(spark, sf), P.BUCKET_A_U, P.BUCKET_A_V,
                                       P.BUCKET_B, P.NUM_COLORS, P.P)


@query
def triangles_approx_partition(spark, sf):
    return G.triangles_approx_partition(_edges(spark, sf), P.BUCKET_A_U, P.BUCKET_A_V,
                                        P.BUCKET_B, P.NUM_COLORS, P.P)


@query
def triangles_approx_partition_directed(spark, sf):
    return G.triangles_approx_partition_directed(_edges(spark, sf), P.BUCKET_A_U, P.BUCKET_A_V,
                                                 P.BUCKET_B, P.NUM_COLORS, P.P)


@query
def triangles_approx_spark_partition(spark, sf):
    return G.triangles_approx_spark_partition(_edges(spark, sf), P.NUM_COLORS)


@query
def edges_from_pair_lines(spark, sf):
    """Raw edges written as ``u,v`` text lines, read back by the pair scan."""
    path = scratch_path(spark, "edges-pairs")
    FS.write_pair_lines(_edges(spark, sf), path)
    return FS.read_pair_lines(spark, path)


@query
def edges_from_flat_lines(spark, sf):
    """One ``u1,v1,u2,v2,u3,v3`` line per lineitem row, read back by the
    flat-line scan."""
    path = scratch_path(spark, "edges-flat")
    li = X.lineitem(spark, sf)
    FS.write_flat_lines(li.select(X.lineitem_edge_array().alias("edges")), path)
    return FS.read_flat_lines(spark, path)


# ---------------------------------------------------------------------------
# Item stream
# ---------------------------------------------------------------------------

@query
def batch_item_counts(spark, sf):
    return S.batch_item_counts(_items(spark, sf))


@query
def batch_sizes(spark, sf):
    return S.batch_sizes(_items(spark, sf))


@query
def interval_histogram(spark, sf):
    return _hist(spark, sf)


@query
def stream_length(spark, sf):
    return ST.stream_length(_stream_items(spark, sf))


@query
def stream_interval_histogram(spark, sf):
    return ST.stream_interval_histogram(_stream_items(spark, sf), P.LEFT, P.RIGHT)


@query
def stream_distinct_items(spark, sf):
    return ST.stream_distinct_items(_stream_items(spark, sf), P.LEFT, P.RIGHT)


@query
def stream_count_sketch(spark, sf):
    inside = S.in_interval(_stream_items(spark, sf), P.LEFT, P.RIGHT)
    return ST.stream_count_sketch(inside, P.SKETCH_ROWS, P.SKETCH_WIDTH, P.P)


@query
def stream_second_moment_true(spark, sf):
    """S8 over the streamed histogram (stateful query, then batch)."""
    hist = ST.stream_interval_histogram(_stream_items(spark, sf), P.LEFT, P.RIGHT)
    return S.second_moment_true(hist)


@query
def stream_second_moment_approx(spark, sf):
    """S10 over the histogram and sketch of one streaming query."""
    hist, sketch = ST.stream_histogram_and_sketch(
        _stream_items(spark, sf), P.LEFT, P.RIGHT, P.SKETCH_ROWS, P.SKETCH_WIDTH, P.P)
    return S.second_moment_approx(sketch, hist)


@query
def stream_batch_sizes(spark, sf):
    return ST.stream_batch_sizes(_stream_items(spark, sf))


@query
def stream_until_threshold(spark, sf):
    """S4 by a running query; its micro-batches are those of ``stream_prefix``."""
    events = events_in_batches(spark, sf, X.EVENTS_PER_BATCH)
    return ST.stream_until_threshold(X.events_to_items(events).select("item"), P.THRESHOLD)


@query
def stream_prefix(spark, sf):
    return S.stream_prefix(_items(spark, sf), P.THRESHOLD)


@query
def sketch_hashes(spark, sf):
    return S.sketch_hashes(_items(spark, sf), P.SKETCH_ROWS, P.SKETCH_WIDTH, P.P)


@query
def sketch_hashes_narrow32(spark, sf):
    """B11: the hashes of the low 32 bits of ids past 2**31."""
    return S.sketch_hashes(X.wide_items(_items(spark, sf)), P.SKETCH_ROWS, P.SKETCH_WIDTH, P.P, narrow32=True)


@query
def count_sketch(spark, sf):
    return _sketch(spark, sf)


@query
def count_sketch_all(spark, sf):
    return S.count_sketch(_items(spark, sf), P.SKETCH_ROWS, P.SKETCH_WIDTH, P.P)


@query
def second_moment_true(spark, sf):
    return S.second_moment_true(_hist(spark, sf))


@query
def second_moment_rows(spark, sf):
    return S.second_moment_rows(_sketch(spark, sf))


@query
def second_moment_approx(spark, sf):
    return S.second_moment_approx(_sketch(spark, sf), _hist(spark, sf))


@query
def second_moment_approx_all(spark, sf):
    return S.second_moment_approx(count_sketch_all(spark, sf), _hist(spark, sf))


@query
def sketch_point_estimates(spark, sf):
    return S.sketch_point_estimates(_hist(spark, sf), _sketch(spark, sf),
                                    P.SKETCH_ROWS, P.SKETCH_WIDTH, P.P)


@query
def count_sketch_large_prime(spark, sf):
    return S.count_sketch(_items(spark, sf), P.LARGE_ROWS, P.SKETCH_WIDTH, P.LARGE_P)


@query
def sketch_point_estimates_large_prime(spark, sf):
    """Over all items, the sketch and the probes."""
    return S.sketch_point_estimates(S.item_histogram(_items(spark, sf)), count_sketch_large_prime(spark, sf),
                                    P.LARGE_ROWS, P.SKETCH_WIDTH, P.LARGE_P)


@query
def topk_items(spark, sf):
    return S.topk_items(_hist(spark, sf), P.TOP_K)


@query
def topk_avg_relative_error(spark, sf):
    return S.topk_avg_relative_error(_hist(spark, sf), _sketch(spark, sf),
                                     P.SKETCH_ROWS, P.SKETCH_WIDTH, P.TOP_K, P.P)


@query
def distinct_items(spark, sf):
    return S.distinct_items(_hist(spark, sf))


@query
def largest_item(spark, sf):
    return S.largest_item(_hist(spark, sf))
