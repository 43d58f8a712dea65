"""Session construction and lineage cutting."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app: str = "weirgate", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library is written for.

    Cluster sizing (executors, memory, ``spark.checkpoint.dir``) belongs to
    ``spark-submit``; only semantics and adaptive execution are fixed here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Stream state beyond the heap: windows and request ids are kept on local disk.
        STATE_STORE: ROCKSDB,
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Keyed state (maps, lists, timers) needs a store with column families; Spark's default has none.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Each store reserves some MB of disk ahead of its rows, and a stream has one a partition and operator.
RESERVE_AHEAD = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, unless the session names another store than the default."""
    before = spark.conf.get(STATE_STORE)
    if not before.endswith("HDFSBackedStateStoreProvider"):
        yield
        return
    reserve = spark.conf.get(RESERVE_AHEAD, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    spark.conf.set(RESERVE_AHEAD, reserve or "false")
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)
        if reserve is None:
            spark.conf.unset(RESERVE_AHEAD)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory for reliable checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Where it is unset, a local
    session gets a temporary one; anything else must be told, because executors on
    other machines could not read a machine-local folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="weirgate-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


# Spark's own switch: a finished job's shuffle files go at once, not with the driver's garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Jobs whose whole result is stored inside; nothing reads their shuffles afterwards."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, survives executor loss, read by every later branch."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_released(df.sparkSession):
        return df.checkpoint(eager=True)


def small_side(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Join side that is broadcast only after its size is known.

    The side is materialised and counted; beyond ``max_rows`` it stays a plain join
    side and adaptive execution picks the strategy.
    """
    pinned = cut_lineage(df)
    return F.broadcast(pinned) if pinned.count() <= max_rows else pinned


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Driver-side rows as a local relation, whose size the optimizer knows."""
    parsed = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], parsed)
    frame = pd.DataFrame(rows, columns=parsed.names, dtype=object)
    return spark.createDataFrame(frame, parsed)
