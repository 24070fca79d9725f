"""Reconciliation by a tree of digests: months, their dates, the symbols of a date.

Each layer keeps a small table of digests beside it, written when a date is loaded. Two layers are compared from the top
down: months first, then the dates of months that differ, and only the candles of dates that differ are rebuilt and read.
A digest is the sum of the hashes of candles, so the order of rows plays no part, and the digest of a parent is the sum
of its children's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StringType, StructField, StructType

from tickloom.functions.scalar import utc_date
from tickloom.operators.quality import RECONCILED, reconcile_candles
from tickloom.sources.tables import read_table, table_exists

MONTH, DATE = "month", "candle_date"
_DIGEST = [StructField("candles", LongType()), StructField("digest", DecimalType(38, 0))]
_MONTHS = StructType([*_DIGEST, StructField(MONTH, DateType())])
_LEAVES = StructType([StructField("symbol", StringType()), *_DIGEST, StructField(MONTH, DateType()), StructField(DATE, DateType())])


def _month(date: Column) -> Column:
    return F.trunc(date, "month")


def _shown(measure: str) -> Column:
    """Ten digits of a measure: sums that differ by the order of their terms only are equal but for rare borders, which
    cost a look at the date, and equal texts differ by less than the tolerance of the comparison."""
    value = F.col(measure).cast("double")
    return F.coalesce(F.format_string("%.9e", value), F.lit("null"))


def candle_digests(candles: DataFrame, measures: Sequence[str] = RECONCILED) -> DataFrame:
    """month, candle_date, symbol, candles and digest of ``candles`` (symbol, window_start and the measures)."""
    date = utc_date(F.col("window_start"))
    code = F.xxhash64("symbol", F.unix_micros("window_start"), *[_shown(m) for m in measures])
    return candles.groupBy(_month(date).alias(MONTH), date.alias(DATE), "symbol").agg(
        F.count("*").alias("candles"), F.sum(code.cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest")
    )


def _paths(path: str) -> tuple[str, str]:
    return f"{path.rstrip('/')}/months", f"{path.rstrip('/')}/dates"


def _replace(rows: DataFrame, path: str, partitions: Sequence[str]) -> None:
    writer = rows.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def record_digests(candles: DataFrame, path: str, measures: Sequence[str] = RECONCILED) -> None:
    """Write the digests of the dates of ``candles``, which holds these dates whole, and of their months.

    Dates that it does not have stay as they are. Call it with the dates that a load has touched.
    """
    spark = candles.sparkSession
    months_path, dates_path = _paths(path)
    leaves = candle_digests(candles, measures).persist()
    try:
        touched = [row[0] for row in leaves.select(MONTH).distinct().collect()]  # a few dates of a calendar
        _replace(leaves, dates_path, [MONTH, DATE])
    finally:
        leaves.unpersist()
    stored = read_table(spark, dates_path, _LEAVES).where(F.col(MONTH).isin(touched))
    _replace(stored.groupBy(MONTH).agg(F.sum("candles").alias("candles"), F.sum("digest").cast("decimal(38,0)").alias("digest")),
             months_path, [MONTH])


def _differing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose counts or digests differ, or that one side lacks."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.struct(*keys).alias("k"), F.struct("candles", "digest").alias(name))

    both = side(left, "mine").join(side(right, "other"), "k", "full_outer")
    return both.where(~F.col("mine").eqNullSafe(F.col("other"))).select("k.*")


def differing_dates(spark: SparkSession, left_path: str, right_path: str) -> DataFrame:
    """(candle_date, symbol) of two recorded trees that differ; dates of months that agree are not read."""
    def table(path: str, schema: StructType) -> DataFrame:
        return read_table(spark, path, schema) if table_exists(spark, path) else spark.createDataFrame([], schema)

    (left_months, left_dates), (right_months, right_dates) = _paths(left_path), _paths(right_path)
    months = _differing(table(left_months, _MONTHS), table(right_months, _MONTHS), [MONTH])
    inside = F.col(MONTH).isin([row[0] for row in months.collect()])  # a calendar's months at most
    left, right = (table(path, _LEAVES).where(inside) for path in (left_dates, right_dates))
    return _differing(left, right, [DATE, "symbol"])


def reconcile_by_digests(
    trades: DataFrame,
    silver: DataFrame,
    trades_tree: str,
    silver_tree: str,
    window: str,
    replay: str = "2 minutes",
    trade_date: str = "trade_date",
    candle_date: str = DATE,
) -> DataFrame:
    """The windows of raw trades and candles that are not equal, as ``quality.reconcile_candles`` reports them.

    ``trades`` is partitioned by ``trade_date`` and ``silver`` by ``candle_date``, both have their digests recorded, the
    former those of the candles that they give. Only dates whose digests differ are read, and of the date before them the
    time in which the original of a replay may lie. ``window`` divides a day.
    """
    spark = silver.sparkSession
    found = differing_dates(spark, trades_tree, silver_tree).select(DATE).distinct()
    dates = [row[0] for row in found.collect()]  # a calendar's dates at most
    eves = [row[0] for row in found.select(F.date_sub(DATE, 1)).collect()]
    midnight = F.timestamp_micros(F.unix_date(F.date_add(trade_date, 1)).cast("long") * 86_400_000_000)
    inside = F.col(trade_date).isin(dates)
    lead = F.col(trade_date).isin(eves) & (F.col("event_time") >= midnight - F.expr(f"INTERVAL {replay}"))
    read = trades.where(F.col(trade_date).isin(sorted({*dates, *eves}))).where(inside | lead)
    compared = reconcile_candles(read, silver.where(F.col(candle_date).isin(dates)), window)
    return compared.where(utc_date(F.col("window_start")).isin(dates) & (F.col("status") != "equal"))
