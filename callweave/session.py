"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


# PySpark notes the call site of every column call by default, which makes plans of
# some hundred expressions slow to build.
LEAN_CALLS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "callweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` keys use `__` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # the state of stream de-duplication lives on disk, not in the executors' heap
        STATE_PROVIDER: ROCKSDB,
        **LEAN_CALLS,
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """What results rest on, for sessions made elsewhere: epoch seconds are
    rendered in UTC, whatever the machine's zone. Stream state lies on disk unless the session names
    a provider of its own; a query that goes on from a checkpoint keeps the one it began with."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if STATE_PROVIDER not in spark.conf.getAll:
        spark.conf.set(STATE_PROVIDER, ROCKSDB)
    return spark


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables, below ``spark.checkpoint.dir`` (within ``scratch``, below its folder).

    Executors on other machines must reach it, so a machine-local folder is
    made only where the setting is absent and the whole session is local.
    """
    root = _SCRATCH.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="callweave-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """Work paths made within lie below one folder, whose files go at the end, also after a failure: nothing may be read
    from them later. Spark's writer removes them by writing no rows in their place, so it works on any shared storage."""
    path = work_path(spark, label)
    outer = _SCRATCH.set(path)
    try:
        yield path
    finally:
        _SCRATCH.reset(outer)
        spark.range(0).write.mode("overwrite").parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over all cores if their files give fewer partitions than that.

    A few small files (or one Parquet row group) would leave most cores idle.
    Inputs with enough partitions, so all large ones, pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
