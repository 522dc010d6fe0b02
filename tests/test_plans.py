"""Plan-shape checks on every registered query: the properties that matter
at scale, asserted on the physical plans Spark chooses."""

import os
import re

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

FORBIDDEN = {
    "CartesianProduct": "cross join",
    "BroadcastNestedLoopJoin": "nested-loop join",
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "Python UDF",
    "FlatMapGroupsInPandas": "whole group through Python",
    "AggregateInPandas": "whole group through Python",
}

COLUMNS_USED = {
    "lineitem": {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"},
    "events": {"event_id", "user_id"},
    "documents": {"doc_id", "text"},
}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in E.queries().items():
        out[name] = plan_text(fn(spark, SF_SMALL))
    return out


def test_no_forbidden_operators(plans):
    bad = [(name, why) for name, plan in plans.items()
           for op, why in FORBIDDEN.items() if op in plan]
    assert not bad, bad


def test_scans_read_only_needed_columns(plans):
    for name, plan in plans.items():
        for table, cols in re.findall(r"/(\w+)\.parquet.*?ReadSchema: struct<([^>]*)>", plan):
            if table in COLUMNS_USED:
                read = {c.split(":")[0] for c in cols.split(",")}
                assert read <= COLUMNS_USED[table], (name, table, read)


@pytest.mark.parametrize("name", ["word_count", "doc_term_counts", "count_sketch",
                                  "count_sketch_all", "interval_histogram", "adjacency"])
def test_partial_aggregation_before_shuffle(plans, name):
    plan = plans[name]
    assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan), plan


def test_interval_filter_pushed_to_scan(plans):
    assert "PushedFilters: [IsNotNull(user_id), GreaterThan(user_id,10), " \
           "LessThan(user_id,100)]" in plans["count_sketch"]


def test_triangle_join_reads_stored_edges(plans):
    # the three branches of the self-join scan one stored edge table
    plan = plans["triangles_exact"]
    assert plan.count("ReadSchema: struct<src:bigint,dst:bigint>") == 3
    assert "lineitem.parquet" not in plan


REPLICATED = {"triangles_per_color_triple": "triple-edges", "triangles_exact_colored": "triple-edges",
              "triangles_approx_color_runs": "run-edges", "triangles_approx_color_table": "run-edges"}


def _stored_bytes(spark, name):
    from tallyspark.session import _SCRATCH
    path = [p for p in _SCRATCH[spark.sparkContext.applicationId] if f"/{name}-" in p][-1]
    folder = path.replace("file:", "")
    return sum(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".parquet"))


@pytest.mark.parametrize("name", sorted(REPLICATED))
def test_replicated_edges_never_broadcast(spark, name):
    """Replicated sets are stored: with a broadcast limit below their real
    size (at run time too) no join on a vertex column is a broadcast."""
    E.queries()[name](spark, SF_SMALL)  # stores the set
    # a branch reads three or more of the five columns
    limit = str(_stored_bytes(spark, REPLICATED[name]) // 2)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set(keys[0], limit)
        spark.conf.set(keys[1], "-1")
        df = E.queries()[name](spark, SF_SMALL)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") >= 2
    # the only broadcast allowed is the zero-fill over the bounded group list
    assert not re.search(r"BroadcastHashJoin \[[^\]]*\b[abc]#", plan), plan
    assert "Generate" not in plan.split("SortMergeJoin")[-1]  # joins scan the stored set


def test_hub_key_is_split_by_aqe_skew_join(spark):
    """A hub holding most edges is one skewed key of the wedge join; with
    broadcasts off and tiny skew thresholds, AQE must split it, and the
    count stays exact."""
    from pyspark.sql import functions as F

    from tallyspark.operators import graph as G
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 3000  # hub 0 -> every leaf; leaves in a path
        pairs = [(0, x) for x in range(1, n + 1)] + [(x, x + 1) for x in range(1, n)]
        df = spark.createDataFrame(pairs, "u bigint, v bigint")
        t = G.list_triangles(G.oriented_edges(df)).agg(F.count(F.lit(1)))
        assert t.collect()[0][0] == n - 1
        plan = t._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin\(skew=true\) \[b#", plan), plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_word_count_by_partition_shuffles_once(spark):
    df = E.queries()["word_count_by_partition"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    full = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(word" in full and full.count("Exchange ") == 1, plan


@pytest.mark.parametrize("name", ["triangles_exact_colored", "triangles_approx_partition"])
def test_plain_sums_scan_the_edges_three_times(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # of the stored set (replicated copies also hold their key)
    assert plan.count("src:bigint,dst:bigint") == 3 and plan.count("FileScan parquet") == 3


def test_stream_prefix_scans_the_events_once(spark):
    df = E.queries()["stream_prefix"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan
