"""Drive the sketch operators as Structured Streaming queries.

Sink design (exactly-once, executor-loss safe): every micro-batch is
written by ``foreachBatch`` to its own directory ``<out>/batch_id=<id>``
in overwrite mode, so a replayed batch rewrites the same directory.  The
streaming checkpoint and the output both live under the shared
``spark.checkpoint.dir``.

* ``complete`` mode (small state, e.g. the D*W sketch cells or a global
  count): each batch directory holds the whole result; the result is the
  directory of the last batch.
* ``update`` mode (large keyed state, e.g. an item histogram kept in the
  RocksDB state store): each batch directory holds only the keys that
  changed; the result is, per key, the row of the latest batch.

:func:`run_state` writes no output at all: the result of an aggregation is
read from its state store, whose size is that of the result however many
batches ran.  Every query started here keeps its state in RocksDB with
changelog checkpoints, whatever session it is given.
"""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import LongType, StructField, StructType

from tallyspark.session import scratch_path
from tallyspark.sources.tables import table_path

BATCH_COL = "batch_id"

# State on the executors' disks; a batch uploads its changes only.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextlib.contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    """A query takes its session's settings when it starts."""
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def events_stream(spark: SparkSession, sf_dir: str,
                  max_files_per_trigger: int | None = None,
                  path: str | None = None) -> DataFrame:
    """Streaming ``(event_id, user_id)`` over the ``events`` parquet data.

    With ``path`` a directory of parquet files is read (one micro-batch per
    ``max_files_per_trigger`` files); otherwise ``events.parquet`` of
    ``sf_dir``.
    """
    reader = spark.readStream.schema("event_id bigint, user_id bigint")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if path is None:
        table = table_path(sf_dir, "events")
        fs, hpath = _fs(spark, table)
        if not fs.exists(hpath):
            raise FileNotFoundError(f"no stream source at {table}")
        if not fs.getFileStatus(hpath).isDirectory():
            # A file cannot be a streaming source path; read its folder
            # restricted to that one file name.
            folder, name = table.rsplit("/", 1)
            return reader.option("pathGlobFilter", name).parquet(folder)
        path = table
    return reader.parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _mkdirs(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.mkdirs(hpath)


def _numbered_dirs(spark: SparkSession, folder: str, prefix: str,
                   complete_only: bool = False) -> dict[int, str]:
    """``{n: path}`` of the sub-folders ``<prefix>=<n>`` of ``folder``."""
    fs, hpath = _fs(spark, folder)
    if not fs.exists(hpath):
        return {}
    found = {}
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix + "="):
            if complete_only and not fs.exists(
                    spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
                        st.getPath(), "_SUCCESS")):
                continue
            found[int(name.split("=", 1)[1])] = st.getPath().toString()
    return found


def _delete(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def drain(stream: DataFrame, name: str, output_mode: str,
          on_batch: Callable[[DataFrame, int, str], None] | None = None,
          stop_when: Callable[[], bool] | None = None,
          processing_time: str | None = None,
          location: str | None = None,
          compact_every: int | None = None,
          keys: Sequence[str] = (),
          keep_output: bool = True) -> str:
    """Run ``stream`` to the end of its input (``availableNow``) into
    per-batch directories; return the output folder.

    ``on_batch(df, batch_id, path)`` replaces the default batch writer
    (it must write idempotently to ``path`` or skip the batch).
    ``stop_when`` is polled from this (the main) thread; when true the
    query is stopped -- the callback itself never stops the query.
    ``processing_time`` replaces ``availableNow`` with a fixed-interval
    trigger (for unbounded sources).  ``location`` fixes the folder of the
    output and the streaming checkpoint (a rerun then resumes the query);
    by default a fresh scratch folder is used.

    ``compact_every`` (update mode, with the key columns ``keys``) folds
    the output every N batches into one snapshot, so the output of a
    long-running query does not grow by one folder per batch.  Without
    ``keep_output`` the batches only update the query's state, in ``chk``
    beside the returned folder.
    """
    spark = stream.sparkSession
    base = location.rstrip("/") if location else scratch_path(spark, name)
    out, chk = f"{base}/out", f"{base}/chk"
    _mkdirs(spark, out)

    schema = stream.schema

    def sink(df: DataFrame, batch_id: int) -> None:
        path = f"{out}/{BATCH_COL}={batch_id}"
        if on_batch is not None:
            on_batch(df, batch_id, path)
        else:
            df.write.mode("overwrite").parquet(path)
            if output_mode == "complete":
                # each folder holds the whole result: the newest two are enough
                # for readers and for a replay of the last batch
                for n, old in _numbered_dirs(spark, out, BATCH_COL).items():
                    if n < batch_id - 1:
                        _delete(spark, old)
        if compact_every and output_mode == "update" and (batch_id + 1) % compact_every == 0:
            compact_update_output(spark, out, schema, keys, batch_id)

    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", chk)
    writer = writer.foreachBatch(sink) if keep_output else writer.format("noop")
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    else:
        writer = writer.trigger(availableNow=True)
    with _state_settings(spark):
        query = writer.start()
    try:
        if stop_when is None:
            query.awaitTermination()
        else:
            while query.isActive:
                if stop_when():
                    query.stop()
                    break
                query.awaitTermination(0.05)
        if query.exception() is not None:
            raise query.exception()
    finally:
        if query.isActive:
            query.stop()
    return out


def _with_batch(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(BATCH_COL, LongType())])


def read_complete(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """Result of a complete-mode query: the rows of the last batch."""
    df = spark.read.schema(_with_batch(schema)).parquet(out)
    last = df.agg(F.max(BATCH_COL)).scalar()
    return df.where(F.col(BATCH_COL) == last).drop(BATCH_COL)


def _snap_folder(out: str) -> str:
    return out.rstrip("/").rsplit("/", 1)[0] + "/snap"


def read_update(spark: SparkSession, out: str, schema: StructType,
                keys: Sequence[str]) -> DataFrame:
    """Result of an update-mode query: per key, the row of the latest batch.

    With compaction, the newest complete snapshot stands for every batch
    up to its id; only later batch folders are read next to it.
    """
    df = spark.read.schema(_with_batch(schema)).parquet(out)
    snaps = _numbered_dirs(spark, _snap_folder(out), "upto", complete_only=True)
    if snaps:
        upto = max(snaps)
        snap = spark.read.schema(schema).parquet(snaps[upto]) \
            .withColumn(BATCH_COL, F.lit(upto).cast("bigint"))
        df = df.where(F.col(BATCH_COL) > upto).unionByName(snap)
    values = [f.name for f in schema.fields if f.name not in keys]
    latest = F.max_by(F.struct(*values), F.col(BATCH_COL)).alias("v")
    return df.groupBy(*keys).agg(latest).select(*keys, *[f"v.{c}" for c in values])


def compact_update_output(spark: SparkSession, out: str, schema: StructType,
                          keys: Sequence[str], upto: int) -> None:
    """Fold every batch up to ``upto`` into the snapshot ``snap/upto=<upto>``,
    then delete the folded batch folders and older snapshots.

    Runs inside the batch callback (batches run one after another).  A
    replayed batch finds its snapshot already complete and skips the
    fold; its rewritten batch folder is ignored by readers, the snapshot
    covers it.
    """
    if not keys:
        raise ValueError("compaction needs the key columns of the result")
    snap_root = _snap_folder(out)
    if upto in _numbered_dirs(spark, snap_root, "upto", complete_only=True):
        return
    folded = read_update(spark, out, schema, keys)
    folded.write.mode("overwrite").parquet(f"{snap_root}/upto={upto}")
    for n, path in _numbered_dirs(spark, out, BATCH_COL).items():
        if n <= upto:
            _delete(spark, path)
    for n, path in _numbered_dirs(spark, snap_root, "upto").items():
        if n < upto:
            _delete(spark, path)


def run_complete(stream_result: DataFrame, name: str) -> DataFrame:
    out = drain(stream_result, name, "complete")
    return read_complete(stream_result.sparkSession, out, stream_result.schema)


def run_update(stream_result: DataFrame, name: str, keys: Sequence[str],
               compact_every: int | None = None) -> DataFrame:
    out = drain(stream_result, name, "update", compact_every=compact_every, keys=keys)
    return read_update(stream_result.sparkSession, out, stream_result.schema, keys)


def run_state(stream_result: DataFrame, name: str, keys: Sequence[str],
              location: str | None = None) -> DataFrame:
    """Run a grouped aggregation to the end of its input and return its result
    as the state store holds it after the last batch.

    Each value column must be one buffer of its aggregate, as for count, sum,
    min and max (an average has two and is refused).  A stream without any
    input gives no rows.  ``location`` as in :func:`drain`.
    """
    spark = stream_result.sparkSession
    out = drain(stream_result, name, "update", location=location, keep_output=False)
    chk = out.rsplit("/", 1)[0] + "/chk"
    schema = stream_result.schema
    fs, state = _fs(spark, f"{chk}/state")
    if not fs.exists(state):
        return spark.createDataFrame([], schema)
    stored = spark.read.format("statestore").load(chk)
    values = [f.name for f in schema.fields if f.name not in keys]
    fields = {side: stored.schema[side].dataType.names for side in ("key", "value")}
    if (len(fields["key"]), len(fields["value"])) != (len(keys), len(values)):
        raise ValueError(f"state {fields} does not hold {list(keys)} and {values} as they are")
    place = {**dict(zip(keys, (f"key.`{c}`" for c in fields["key"]))),
             **dict(zip(values, (f"value.`{c}`" for c in fields["value"])))}
    return stored.select(*[F.col(place[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields])


# ---------------------------------------------------------------------------
# Sizes of the batches of a running query
# ---------------------------------------------------------------------------

#: name of the observed metrics and of the number of rows in them
OBSERVED, OBSERVED_ROWS = "batch", "n_items"


def observed(stream: DataFrame) -> DataFrame:
    """``stream`` whose progress reports carry each batch's number of rows."""
    return stream.observe(OBSERVED, F.count(F.lit(1)).alias(OBSERVED_ROWS))


class BatchReport(StreamingQueryListener):
    """Calls ``on_size(batch_id, n)`` as the batches of queries over an
    :func:`observed` stream end; ``sizes`` keeps the last call of each batch.

    It is the live report of a running query.  Spark counts a task again that
    runs again after a lost executor, so a reported size can be too large; the
    sizes that :func:`run_batch_sizes` stores cannot.
    """

    def __init__(self, on_size: Callable[[int, int], None] | None = None) -> None:
        self.sizes: dict[int, int] = {}
        self._on_size = on_size
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        metrics = event.progress.observedMetrics.get(OBSERVED)
        if metrics is not None:
            batch, n = int(event.progress.batchId), int(metrics[OBSERVED_ROWS])
            self.sizes[batch] = n
            if self._on_size is not None:
                self._on_size(batch, n)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    @contextlib.contextmanager
    def listening(self, spark: SparkSession, seconds: float = 30) -> Iterator[BatchReport]:
        """Listen to the queries run inside; on leaving, wait for the report
        of the end (listeners are told a little later)."""
        spark.streams.addListener(self)
        try:
            yield self
            self._ended.wait(seconds)
        finally:
            spark.streams.removeListener(self)


_SIZE = StructType([StructField(OBSERVED_ROWS, LongType())])


def run_batch_sizes(items_stream: DataFrame, name: str = "batch-sizes",
                    on_size: Callable[[int, int], None] | None = None,
                    location: str | None = None) -> DataFrame:
    """``(batch_id, n_items)`` of every non-empty micro-batch of the stream.

    A batch's size is stored under its id before the batch is committed, in
    overwrite mode: a batch that is replayed replaces its size, and a run
    resumed at ``location`` keeps the earlier ones.  ``on_size`` is called
    while the query runs (see :class:`BatchReport`).
    """
    spark = items_stream.sparkSession

    def on_batch(df: DataFrame, batch_id: int, path: str) -> None:
        df.agg(F.count(F.lit(1)).alias(OBSERVED_ROWS)).write.mode("overwrite").parquet(path)

    with BatchReport(on_size).listening(spark):
        out = drain(observed(items_stream), name, "append", on_batch=on_batch, location=location)
    stored = spark.read.schema(_with_batch(_SIZE)).parquet(out)
    return stored.where(F.col(OBSERVED_ROWS) > 0).select(BATCH_COL, OBSERVED_ROWS)


_ITEM_COUNTS = StructType([StructField("item", LongType()), StructField("n", LongType())])


def _stored_total(spark: SparkSession, out: str) -> tuple[int, int, int]:
    """(last stored batch, its items, the items of all batches before it)."""
    per_batch = spark.read.schema(_with_batch(_ITEM_COUNTS)).parquet(out) \
        .groupBy(BATCH_COL).agg(F.sum("n").alias("n"))
    row = per_batch.agg(F.max(BATCH_COL).alias("last"), F.max_by("n", BATCH_COL).alias("n"),
                        F.sum("n").alias("total")).first()
    if row["last"] is None:
        return -1, 0, 0
    return int(row["last"]), int(row["n"]), int(row["total"] - row["n"])


def run_until_threshold(items_stream: DataFrame, threshold: int,
                        name: str = "prefix",
                        processing_time: str | None = None,
                        location: str | None = None,
                        on_size: Callable[[int, int], None] | None = None) -> DataFrame:
    """Take whole micro-batches while fewer than ``threshold`` items have
    been taken, then stop the query.

    Every committed batch is stored pre-aggregated as ``(item, n)`` in its
    own batch directory, also the ones that arrive before the stop takes
    effect; the stop rule is applied when reading: the returned DataFrame
    ``(batch_id, item, n)`` holds the batches whose predecessors hold fewer
    than ``threshold`` items.  So a run resumed at the same ``location``
    with a higher threshold finds every batch.  The driver keeps one running
    total; a replayed batch replaces its own part of it.  ``on_size(batch_id,
    n)`` is told every stored batch's size.
    """
    spark = items_stream.sparkSession
    state = (-1, 0, 0)
    if location:
        _mkdirs(spark, f"{location.rstrip('/')}/out")
        state = _stored_total(spark, f"{location.rstrip('/')}/out")
    lock = threading.Lock()

    def on_batch(df: DataFrame, batch_id: int, path: str) -> None:
        nonlocal state
        df.groupBy("item").agg(F.count(F.lit(1)).alias("n")) \
            .write.mode("overwrite").parquet(path)
        size = int(df.sparkSession.read.parquet(path).agg(F.sum("n")).first()[0] or 0)
        with lock:
            last, n, before = state
            state = (batch_id, size, before if batch_id == last else before + n)
        if on_size is not None:
            on_size(batch_id, size)

    def reached() -> bool:
        with lock:
            return state[1] + state[2] >= threshold

    out = drain(items_stream.select("item"), name, "append", on_batch=on_batch,
                stop_when=reached, processing_time=processing_time, location=location)
    stored = spark.read.schema(_with_batch(_ITEM_COUNTS)).parquet(out)
    # one row per batch
    earlier = F.sum("n").over(Window.orderBy(BATCH_COL).rowsBetween(Window.unboundedPreceding, -1))
    taken = (stored.groupBy(BATCH_COL).agg(F.sum("n").alias("n"))
             .select(BATCH_COL, F.coalesce(earlier, F.lit(0)).alias("earlier"))
             .where(F.col("earlier") < threshold).select(BATCH_COL))
    return stored.join(taken, BATCH_COL, "left_semi").select(BATCH_COL, "item", "n")
