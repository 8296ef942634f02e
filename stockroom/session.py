"""Session settings the library relies on, and where it may write scratch data."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that decide results or plans; all can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join key may hold a third of the rows: let AQE split such partitions,
    # also where splitting costs a later exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The Spark default (INT96) carries no statistics, so an incremental bound
    # on a timestamp could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Surrogate keys are hex digits, which the default (Snappy) stores as they are.
    "spark.sql.parquet.compression.codec": "zstd",
}

# Fixed value: the setting by which Spark removes the shuffle files of a query that has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query leave the disk when the query ends.

    Without it they stay until the driver collects garbage, so that a run of many steps
    holds the shuffles of all of them. Only for steps that write or collect: a frame that
    is collected twice is shuffled twice.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def local_session(cores: int = 8, app: str = "stockroom", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.warehouse.dir", tempfile.gettempdir() + "/stockroom-warehouse")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Every executor must see the folder, so a machine-local one is used only
    when the setting is absent and the master itself is local.
    """
    leaf = f"{label}-{uuid.uuid4().hex}"
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/stockroom/{leaf}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    base = tempfile.mkdtemp(prefix="stockroom-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base}/{leaf}"
