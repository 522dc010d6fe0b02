"""Micro-batches in a known order, sizes of a running query's batches, results
read from the state store, the stop rule as a query."""

import glob
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import sketch as S
from tallyspark.plans import params as P
from tallyspark.plans.catalog import QUERIES
from tallyspark.sources import fixtures as X
from tallyspark.streaming import runner as R
from tallyspark.streaming import staging as G
from tallyspark.streaming import stats as ST

from conftest import SF_MID, SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def staged(spark):
    """Five files of different sizes, the last step first on disk."""
    df = spark.range(1000).select(F.col("id").alias("event_id"), (F.col("id") % 37).alias("user_id"))
    step = F.when(F.col("event_id") < 500, 10).when(F.col("event_id") < 510, -3).otherwise(F.col("event_id") % 3)
    return G.stage_steps(df, step, "staged-test")


def items_of(spark, folder):
    return G.stream_steps(spark, folder).select(F.col("user_id").alias("item"))


def plain(folder):
    return folder.replace("file:", "")


def test_steps_arrive_in_order(spark, staged):
    out = R.drain(G.stream_steps(spark, staged), "order-test", "append")
    per_batch = [r.n for r in spark.read.parquet(out).groupBy("batch_id").agg(F.count("*").alias("n"))
                 .orderBy("batch_id").collect()]
    sizes = [sum(1 for i in range(510, 1000) if i % 3 == s) for s in range(3)]
    assert per_batch == [10, *sizes, 500]


def test_registered_streams_run_several_batches(spark):
    s = X.events_to_items(G.events_in_steps(spark, SF_MID, P.STREAM_STEPS)).select("item")
    assert P.STREAM_STEPS >= 5 and ST.stream_batch_sizes(s).count() == P.STREAM_STEPS


def test_steps_of_an_empty_table_and_of_null_ids(spark):
    schema = "event_id bigint, user_id bigint"
    empty = G.stage_steps(spark.createDataFrame([], schema), F.col("event_id"), "staged-empty")
    assert rows(ST.stream_batch_sizes(items_of(spark, empty))) == []
    assert rows(ST.stream_until_threshold(items_of(spark, empty), 5)) == [(0, 0)]
    nulls = G.stage_steps(spark.createDataFrame([(None, 1), (3, 2), (None, 4)], schema), F.col("event_id"), "staged-null")
    assert rows(ST.stream_batch_sizes(items_of(spark, nulls))) == [(0, 2), (1, 1)]


# -- sizes ---------------------------------------------------------------------

def test_sizes_are_stored_and_reported(spark, staged):
    told = {}
    got = R.run_batch_sizes(items_of(spark, staged), on_size=told.__setitem__)
    assert [n for _, n in rows(got)][0] == 10 and sum(n for _, n in rows(got)) == 1000
    assert sorted(told.items()) == rows(got)  # observed metrics of the running query
    assert got.columns == ["batch_id", "n_items"]


def test_replayed_batch_replaces_its_size(spark, staged):
    loc = tempfile.mkdtemp(prefix="sizes-")
    first = rows(R.run_batch_sizes(items_of(spark, staged), location=loc))
    # the driver died after the last batch was written, before its commit
    for f in glob.glob(f"{loc}/chk/commits/*4*") + glob.glob(f"{loc}/chk/commits/.*4*"):
        os.remove(f)
    shutil.rmtree(f"{loc}/out/batch_id=4")
    assert rows(R.run_batch_sizes(items_of(spark, staged), location=loc)) == first


def test_report_of_any_observed_query(spark, staged):
    with R.BatchReport().listening(spark) as report:
        R.drain(S.item_histogram(R.observed(items_of(spark, staged))), "report-test", "update", keep_output=False)
    assert sorted(report.sizes) == [0, 1, 2, 3, 4] and sum(report.sizes.values()) == 1000


def test_stop_rule_reports_sizes(spark, staged):
    told = {}
    taken = R.run_until_threshold(items_of(spark, staged), 400, on_size=told.__setitem__)
    per_batch = dict(rows(taken.groupBy("batch_id").agg(F.sum("n"))))
    assert per_batch == {b: told[b] for b in per_batch} and sum(per_batch.values()) >= 400


@pytest.mark.parametrize("threshold", [1, 10, 11, 400, 10_000])
def test_stop_rule_equals_the_batch_prefix(spark, staged, threshold):
    batch = (spark.read.parquet(staged).withColumn("batch", F.col("step").cast("bigint")))
    want = rows(S.stream_prefix(batch, threshold))
    assert rows(ST.stream_until_threshold(items_of(spark, staged), threshold)) == want


def test_stop_rule_query(spark):
    assert rows(QUERIES["stream_until_threshold"](spark, SF_MID)) == rows(QUERIES["stream_prefix"](spark, SF_MID))


# -- state -----------------------------------------------------------------------

def test_histogram_is_read_from_state(spark, staged):
    want = rows(S.item_histogram(spark.read.parquet(staged).select(F.col("user_id").alias("item"))))
    loc = tempfile.mkdtemp(prefix="state-")
    got = R.run_state(S.item_histogram(items_of(spark, staged)), "state-test", ["item"], location=loc)
    assert rows(got) == want and got.columns == ["item", "n"]
    assert os.listdir(f"{loc}/out") == []  # no batch wrote an output
    assert "storename=default" in got._jdf.queryExecution().toString().lower()


def test_state_settings_hold_on_any_session(spark, staged):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    changelog = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    spark.conf.set(key, other)
    try:
        loc = tempfile.mkdtemp(prefix="state-")
        got = R.run_state(S.item_histogram(items_of(spark, staged)), "state-test", ["item"], location=loc)
        assert sum(n for _, n in rows(got)) == 1000
        assert spark.conf.get(key) == other
        files = [f for _, _, names in os.walk(f"{loc}/chk/state") for f in names]
        assert any(f.endswith(".changelog") for f in files), files[:20]
        assert not any(f.endswith(".delta") for f in files)
    finally:
        spark.conf.set(key, before)
    assert spark.conf.get(changelog, None) in (None, "false")


def test_state_of_a_resumed_query(spark, staged):
    """A second run at the same location adds the new files to the state."""
    folder, loc = tempfile.mkdtemp(prefix="grow-"), tempfile.mkdtemp(prefix="state-")
    schema = "event_id bigint, user_id bigint"
    stream = spark.readStream.schema(schema).parquet(folder).select(F.col("user_id").alias("item"))
    cells = S.histogram_and_sketch(stream, P.SKETCH_ROWS, 16)
    assert rows(R.run_state(cells, "grow", ["row_idx", "cell"], location=loc)) == []
    want = None
    for part in range(3):
        new = spark.createDataFrame([(i, i % 7) for i in range(part * 40, part * 40 + 40)], schema)
        new.coalesce(1).write.mode("append").parquet(folder)
        got = rows(R.run_state(cells, "grow", ["row_idx", "cell"], location=loc))
        seen = spark.read.schema(schema).parquet(folder).select(F.col("user_id").alias("item"))
        want = rows(S.histogram_and_sketch(seen, P.SKETCH_ROWS, 16))
        assert got == want
    assert sum(n for row, _, n in want if row == S.HISTOGRAM) == 120


def test_state_of_several_buffers_is_refused(spark, staged):
    mean = items_of(spark, staged).groupBy("item").agg(F.avg("item").alias("m"))
    with pytest.raises(ValueError, match="does not hold"):
        R.run_state(mean, "state-avg", ["item"])


def test_narrow_hashes_differ_only_past_32_bits(spark, items_df):
    small = items_df([5, -5, 2**31 - 1, -(2**31)])
    wide = items_df([5 + 2**32, -5 - 2**32, 2**31 - 1 + 2**34, -(2**31) + 2**40])
    keep = ["row_idx", "col_idx", "sign"]
    a = S.sketch_hashes(small, P.SKETCH_ROWS, 64, narrow32=True)
    assert rows(a) == rows(S.sketch_hashes(small, P.SKETCH_ROWS, 64))
    assert rows(a.select(keep)) == rows(S.sketch_hashes(wide, P.SKETCH_ROWS, 64, narrow32=True).select(keep))
    assert rows(a.select(keep)) != rows(S.sketch_hashes(wide, P.SKETCH_ROWS, 64).select(keep))
    assert QUERIES["sketch_hashes_narrow32"](spark, SF_SMALL).where("abs(item) > 2147483648").count() > 0
