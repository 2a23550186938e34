"""Session defaults and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "salesmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, no web UI)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A folder of our own is made only where nothing is configured and the session is a local one.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="salesmart-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled", codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and carry on from the written copy.

    Later jobs read columnar files with known size, and a lost executor costs a re-read rather than
    a recomputation of everything upstream. ``codec`` is that of the copy, for large ones; by default the session's.
    """
    path = scratch_path(df.sparkSession, label)
    if getattr(_load, "copies", None) is not None:
        _load.copies.append((df.sparkSession, path))
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a query has shuffled is deleted when that query ends, not when the driver next collects its garbage.

    A load is many queries in a row, whose shuffled rows would all lie on the disks until the last one. A frame
    that is run once more afterwards is computed anew.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, "false")
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


#: The settled copies of the load that runs in this thread, if one does.
_load = threading.local()


def drops_copies(load: Callable) -> Callable:
    """A load that deletes the copies it has settled when it ends, also if it fails.

    For functions whose results read stored tables only: nothing that they return may still need a copy.
    """
    @wraps(load)
    def run(*args, **options):
        outer, _load.copies = getattr(_load, "copies", None), []
        try:
            return load(*args, **options)
        finally:
            own, _load.copies = _load.copies, outer
            for spark, path in own:
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    return run
