"""Session construction and the shared scratch location.

Everything that must survive an executor loss (streaming checkpoints,
materialised intermediate tables, text files written for the file-scan
operators) goes under the cluster's ``spark.checkpoint.dir``.  We only
invent a directory when none is configured *and* Spark runs in local
mode (tests, the bench); on a cluster an unset checkpoint dir is an
error rather than a silent fallback to a machine-local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tallyspark",
    driver_memory: str | None = None,
) -> SparkSession:
    """A session tuned for these operators (AQE on, UI off, UTC).  Master,
    partition count and driver memory are those of the submission unless
    given here (or, for the master, in ``TALLYSPARK_MASTER``)."""
    builder = SparkSession.builder
    for key, value in (("spark.master", master or os.environ.get("TALLYSPARK_MASTER")),
                       ("spark.sql.shuffle.partitions", shuffle_partitions),
                       ("spark.driver.memory", driver_memory)):
        if value is not None:
            builder = builder.config(key, str(value))
    builder = (
        builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Runtime re-planning: coalesce small shuffle partitions, split
        # skewed join partitions, turn joins whose measured side is small
        # into broadcast joins (a size check done by Spark at runtime).
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        # Let AQE replace a sort-merge join by a shuffled hash join when
        # every partition's build side is under this bound (no sort of the
        # wedge stream; memory per task stays bounded).
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state."
                "RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Read small stored tables (a few files) in at least two splits per
    # core; large inputs split by size anyway.
    spark.conf.set("spark.sql.files.minPartitionNum",
                   str(2 * spark.sparkContext.defaultParallelism))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session (``spark.checkpoint.dir``)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder shared "
                "by all executors (HDFS, S3, ...) before running tallyspark jobs")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return current


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """For entry points of tests and benches: give a session in local mode
    that has no checkpoint folder a temporary one.  A configured folder is
    left alone, and on a cluster an unset one is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None):
        return
    if sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyspark-ckpt-"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors through Spark, once per
    application, so that Python workers can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tallyspark-src-"), "tallyspark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


# Scratch paths handed out per SparkContext (by its application id).
_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared checkpoint folder.

    The path is remembered so that :func:`drop_scratch` can delete it once
    the DataFrames reading it are no longer needed.
    """
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete every scratch path this session created (stored intermediate
    tables, streaming outputs and checkpoints); return how many.

    DataFrames that read those paths must not be used afterwards.
    """
    sc = spark.sparkContext
    paths = _SCRATCH.pop(sc.applicationId, [])
    jvm = sc._jvm
    conf = sc._jsc.hadoopConfiguration()
    for path in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(conf).delete(hpath, True)
    return len(paths)
