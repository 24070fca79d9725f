"""Starting, draining and observing streaming queries."""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# State lives off the heap and on local disk with its changes in the checkpoint, so it may outgrow executor memory
# and is rebuilt on another executor when one is lost.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]):
    """Set session options for the start of a query, which keeps its own copy, and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start_table_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = None,
    name: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    state_partitions: int | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append a stream to a table, each row once, across restarts from ``checkpoint``.

    ``trigger`` is a processing-time interval; without one the query takes what is there and stops.
    ``state_partitions`` sets the number of state partitions, which the first run of a query fixes for good.
    ``files_per_batch`` spreads each micro-batch evenly over that many files. Without it every task writes its own,
    which with many topic or state partitions and short triggers fills the table with tiny files.
    """
    if files_per_batch:
        df = df.repartition(files_per_batch)
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    conf = dict(STATE_CONF)
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    with session_conf(df.sparkSession, conf):
        return writer.start(path)


def start_batches(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = None,
    name: str | None = None,
    mode: str = "append",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Give each micro-batch, computed once, to ``write(batch, batch_id)``, which may write it to several tables.

    A batch that was under way when the query stopped is given again with its old number, so ``write`` must replace what
    it has written for that number before (see ``replace_batch``) or merge by key.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.DISK_ONLY)  # what an executor loses is computed again
        try:
            write(kept, batch_id)
        finally:
            kept.unpersist()

    writer = df.writeStream.foreachBatch(run).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    conf = dict(STATE_CONF)
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    with session_conf(df.sparkSession, conf):
        return writer.start()


BATCH = "batch"


def replace_batch(rows: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), files: int | None = None) -> None:
    """Write the rows of a micro-batch under ``batch=<batch_id>`` of a table; what was there before is replaced whole."""
    if files:
        rows = rows.repartition(files)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")


def start_console(df: DataFrame, trigger: str, rows: int = 20) -> StreamingQuery:
    """Show each micro-batch, values in full: a smoke check of a feed."""
    writer = df.writeStream.format("console").outputMode("append").option("numRows", rows).option("truncate", False)
    return writer.trigger(processingTime=trigger).start()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query that stops by itself; raises its error if it failed."""
    try:
        query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
    return query


def run_until_signalled(query: StreamingQuery) -> None:
    """Keep a continuous query running until SIGINT or SIGTERM, then stop it.

    What a batch under way has not committed is done again after a restart from the same checkpoint.
    """
    asked = []
    previous = {s: signal.signal(s, lambda signum, _: asked.append(signum)) for s in (signal.SIGINT, signal.SIGTERM)}
    try:
        while not asked and not query.awaitTermination(1):
            pass
    finally:
        query.stop()
        for s, handler in previous.items():
            signal.signal(s, handler)


PROGRESS_SCHEMA = (
    "query string, batch_id long, started_at string, input_rows long, input_rows_per_second double, "
    "processed_rows_per_second double, batch_ms long, watermark string, state_rows long, late_rows long"
)


def _finite(value) -> float | None:
    return None if value is None else float(value)


class ProgressLog(StreamingQueryListener):
    """Writes one row per micro-batch of every query of a session to a table: throughput, watermark, state, late rows.

    The table outlives queries and sessions and holds all batches, where a query itself keeps its last reports only.
    Rows are gathered and written ``rows_per_file`` at a time, by the first report that comes ``max_seconds`` after the
    oldest one that waits, and at the end of a query and of the block; a session that dies loses those that wait. Use
    ``recording``.
    """

    def __init__(self, spark: SparkSession, path: str, rows_per_file: int = 100, max_seconds: float = 60) -> None:
        super().__init__()
        self._spark, self._path = spark, path
        self._rows_per_file, self._max_seconds = rows_per_file, max_seconds
        self._waiting: list[tuple] = []
        self._since = 0.0
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (
            p.name, p.batchId, p.timestamp, p.numInputRows, _finite(p.inputRowsPerSecond),
            _finite(p.processedRowsPerSecond), p.durationMs.get("triggerExecution"), p.eventTime.get("watermark"),
            sum(s.numRowsTotal for s in p.stateOperators), sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        )
        with self._change:
            if not self._waiting:
                self._since = time.monotonic()
            self._waiting.append(row)
            due = len(self._waiting) >= self._rows_per_file or time.monotonic() - self._since >= self._max_seconds
        if due:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def flush(self) -> None:
        """Write the rows that wait, as one file."""
        with self._change:
            rows, self._waiting = self._waiting, []
        if rows:
            self._spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self._path)

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Reports arrive a little after the query: wait until the last one of an ended query is written."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of {query.name or query.runId} was reported")


@contextmanager
def recording(spark: SparkSession, path: str):
    """Write the progress of all queries of the session that run in the block to the table at ``path``."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)
        log.flush()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)
