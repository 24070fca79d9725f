"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import contextlib
import functools
import re
import tempfile
import uuid
import weakref
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings that hold from a laptop to a large cluster. The shuffle partition count is only a starting point for
# batch work, since adaptive execution coalesces and splits partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str = "tickloom", master: str | None = None, conf: dict[str, str] | None = None):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Event times are instants: windows, hours and dates are cut in UTC whatever the host's zone is."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tickloom-")


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a session whose executors are threads of the driver (``local[...]``) gets a folder of its own; any
    other one is refused, since a folder of one machine would lose what the others write.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that start inside are deleted as each ends.

    Otherwise they stay until the driver happens to collect its garbage, which for a job of many steps means to its end.
    """
    before = spark.conf.get(_CLEANUP, None)
    if before == "true":
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage for frames that several branches of a plan read, survives the loss of executors, and, unlike a
    checkpoint of rows, lets each branch prune columns at the scan. What was shuffled on the way is deleted.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _STORED[stored] = path
    return stored


_STORED: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def release(*frames: DataFrame) -> None:
    """Delete the tables behind frames that ``materialize`` returned, through the file system that Spark writes with.

    For steps that are done: whatever was derived from such a frame must be stored by then, or it fails when it is read.
    Frames that ``materialize`` did not return, and those released before, are left as they are.
    """
    for frame in frames:
        written = _STORED.pop(frame, None)
        if written is not None:
            spark = frame.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(written)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
