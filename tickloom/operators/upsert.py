"""Update-or-insert into tables of dated snapshots, and backfills into their own partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tickloom.functions.scalar import utc_date
from tickloom.operators.dedupe import latest_by
from tickloom.sources.tables import read_table, table_exists

PARTITION = "snapshot_date"


def upsert(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    time_column: str = "snapshot_hour",
    newest_by: str = "ingested_at",
    fmt: str = "parquet",
    partition: str = PARTITION,
) -> None:
    """Merge ``source`` into the table at ``path``: a matching key is replaced whole, a new key is added.

    The source is first reduced to its newest row per key, since a merge needs unique keys. The table is partitioned
    by the date of ``time_column``, which must be a key, and only dates the source touches are read and rewritten.
    Rows with a NULL key never match, as in a merge, and are added. An empty source changes nothing.
    """
    if time_column not in keys:
        raise ValueError("the time column must be one of the keys")
    dated = latest_by(source, keys, newest_by).withColumn(partition, utc_date(F.col(time_column)))
    fresh = dated.persist(StorageLevel.DISK_ONLY)  # read several times; what an executor loses is computed again
    try:
        if fresh.isEmpty():
            return
        if not table_exists(source.sparkSession, path, fmt):
            _write_dates(fresh, path, fmt, "append" if fmt == "delta" else "overwrite", partition)
        elif fmt == "delta":
            _merge_delta(fresh, path, keys)
        else:
            _write_dates(_merged_dates(fresh, path, keys, fmt, partition), path, fmt, "overwrite", partition)
    finally:
        fresh.unpersist()


def _merged_dates(fresh: DataFrame, path: str, keys: Sequence[str], fmt: str, partition: str) -> DataFrame:
    # two scalars bound the partitions to list and read; the semi join then drops those in between that stay as they are
    lo, hi = fresh.agg(F.min(partition), F.max(partition)).first()
    target = read_table(fresh.sparkSession, path, fresh.schema, fmt)
    inside = target.where(F.col(partition).between(F.lit(lo), F.lit(hi)) | F.col(partition).isNull())
    touched = fresh.select(partition).distinct()
    kept = inside.join(touched, inside[partition].eqNullSafe(touched[partition]), "left_semi")
    return kept.join(fresh, list(keys), "left_anti").unionByName(fresh)


def _write_dates(rows: DataFrame, path: str, fmt: str, mode: str, partition: str) -> None:
    # rebalancing gathers a date into few files and, unlike a plain repartition, splits a date that is too large
    writer = rows.hint("rebalance", partition).write.format(fmt).mode(mode)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition).save(path)


def _merge_delta(fresh: DataFrame, path: str, keys: Sequence[str]) -> None:
    from delta.tables import DeltaTable  # only needed for this format

    condition = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    merge = DeltaTable.forPath(fresh.sparkSession, path).alias("t").merge(fresh.alias("s"), condition)
    merge.whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()


def read_snapshots(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The table without its partition column, which a filter on it may still prune before this."""
    stored = StructType(schema.fields + [StructField(PARTITION, DateType())])
    return read_table(spark, path, stored, fmt).select(*schema.fieldNames())


def upsert_market_snapshot(source: DataFrame, path: str, fmt: str = "parquet") -> None:
    upsert(source, path, ["symbol", "snapshot_hour"], fmt=fmt)


def upsert_global_metrics(source: DataFrame, path: str, fmt: str = "parquet") -> None:
    upsert(source, path, ["snapshot_hour"], fmt=fmt)


def backfill(history: DataFrame, path: str, label: str, fmt: str = "parquet", time_column: str = "event_time") -> None:
    """Load a batch of history under ``load=<label>``, by date like the streamed raw table; a second run replaces it.

    ``path`` is a table of its own beside the streamed one: a stream keeps a list of the files that it committed, and
    readers of its folder see no others. ``read_raw_table`` reads both.
    """
    dated = history.withColumn("trade_date", utc_date(F.col(time_column)))
    # the folder of the label is replaced whole: dates that a second run no longer has must not stay behind
    writer = dated.hint("rebalance", "trade_date").write.format(fmt).mode("overwrite")
    writer.option("partitionOverwriteMode", "static").partitionBy("trade_date").save(f"{path.rstrip('/')}/load={label}")


def read_raw_table(
    spark: SparkSession, live_path: str, history_path: str, schema: StructType, fmt: str = "parquet"
) -> DataFrame:
    """Streamed and backfilled raw trades together, with ``trade_date`` and ``load`` (NULL for streamed rows)."""
    dated = StructType(schema.fields + [StructField("trade_date", DateType())])
    live = read_table(spark, live_path, dated, fmt).withColumn("load", F.lit(None).cast("string"))
    if not table_exists(spark, history_path, fmt):
        return live
    loaded = StructType(dated.fields + [StructField("load", StringType())])
    return live.unionByName(read_table(spark, history_path, loaded, fmt).select(*live.columns))
