"""Files laid along a space-filling curve of (symbol, time), so that either predicate leaves out most of them.

Partitions by date help a range of time alone. Here each row gets a position on a Z-order curve: the share of rows
with smaller symbols and the share with earlier times, their bits interleaved. Rows go to files by ranges of that
position, and a manifest of the files' least and greatest symbol and time says which ones a look-up has to open.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tickloom.session import materialize, release
from tickloom.sources.tables import overwrite_table, read_table

BITS = 16  # of each side of the curve
ROWS_PER_FILE = 2_000_000


def _spread(value: Column) -> Column:
    """The low 16 bits of a number moved to the even places of a 32-bit one."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return value


def interleave(x: Column, y: Column) -> Column:
    """Z-order position of two numbers under 2^16; the bits of ``y`` are the higher ones."""
    return _spread(x.cast("long")).bitwiseOR(F.shiftleft(_spread(y.cast("long")), 1))


def _shares(cells: DataFrame, key: str) -> DataFrame:
    """Each value of ``key`` with the share of rows before it and its own. One row per symbol, or per hour."""
    sizes = cells.groupBy(key).agg(F.sum("rows").alias("rows"))
    total = F.sum("rows").over(W.partitionBy())
    before = F.sum("rows").over(W.orderBy(F.col(key).asc_nulls_first())) - F.col("rows")
    return sizes.select(
        F.col(key).alias(f"_{key}_key"), (before / total).alias(f"_{key}_start"),
        (F.col("rows") / total).alias(f"_{key}_width"),
    )


def _place(share: Column) -> Column:
    return F.least(F.floor(share * (1 << BITS)), F.lit((1 << BITS) - 1))


def _with_curve(rows: DataFrame, cells: DataFrame, symbol: str, time: str) -> DataFrame:
    hour = F.date_trunc("hour", F.col(time))
    within = (F.unix_micros(F.col(time)) - F.unix_micros(hour)) / 3_600_000_000
    keyed = rows.withColumn("_hour", hour).join(
        _shares(cells, "symbol"), F.col(symbol).eqNullSafe(F.col("_symbol_key")), "left"
    ).join(_shares(cells, "hour"), F.col("_hour").eqNullSafe(F.col("_hour_key")), "left")
    across = _place(F.col("_hour_start") + F.col("_hour_width") * F.coalesce(within, F.lit(0.0)))
    curve = interleave(across, _place(F.col("_symbol_start")))
    return keyed.withColumn("_curve", curve).select(*[F.col(f"`{name}`") for name in rows.columns], "_curve")


def write_along_curve(
    rows: DataFrame,
    path: str,
    manifest_path: str,
    symbol: str = "symbol",
    time: str = "event_time",
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Write ``rows`` in files along the curve, and the manifest of those files.

    Shares are of rows and not of values: a symbol with a third of all trades has a third of the curve, and a wrong
    time far away takes only the place of its own row. They come from counts by symbol and hour. Rows without symbol
    or time come first. Both tables are replaced; ``rows`` is read twice, to count and to write, and must not be them.
    """
    counted = rows.groupBy(F.col(symbol).alias("symbol"), F.date_trunc("hour", F.col(time)).alias("hour"))
    cells = materialize(counted.agg(F.count("*").alias("rows")), "curve-cells")
    total = cells.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    files = max(1, -(-total // rows_per_file))
    laid = _with_curve(rows, cells, symbol, time).repartitionByRange(files, "_curve", time)
    overwrite_table(laid.sortWithinPartitions("_curve", time).drop("_curve"), path)
    release(cells)
    file_facts(rows.sparkSession, path, symbol, time).write.mode("overwrite").parquet(manifest_path)


def file_facts(spark: SparkSession, path: str, symbol: str = "symbol", time: str = "event_time") -> DataFrame:
    """Per file: rows, least and greatest symbol and time. Reads two columns."""
    rows = read_table(spark, path).select(F.col("_metadata.file_path").alias("file"), symbol, time)
    return rows.groupBy("file").agg(
        F.count("*").alias("rows"),
        F.min(symbol).alias("first_symbol"), F.max(symbol).alias("last_symbol"),
        F.min(time).alias("first_time"), F.max(time).alias("last_time"),
    )


def look_up(
    spark: SparkSession,
    path: str,
    manifest_path: str,
    symbol_value: str | None = None,
    start: str | dt.datetime | None = None,
    end: str | dt.datetime | None = None,
    symbol: str = "symbol",
    time: str = "event_time",
) -> DataFrame:
    """Rows of a symbol, of the half-open range of time, or of both, out of the files that can hold them.

    The paths of those files pass through the driver, as those of any scan do; row groups within them are left out by
    the pushed filters.
    """
    files, rows = F.lit(True), F.lit(True)
    if symbol_value is not None:
        files &= (F.col("first_symbol") <= symbol_value) & (F.col("last_symbol") >= symbol_value)
        rows &= F.col(symbol) == symbol_value
    if start is not None:
        files &= F.col("last_time") >= F.lit(start).cast("timestamp")
        rows &= F.col(time) >= F.lit(start).cast("timestamp")
    if end is not None:
        files &= F.col("first_time") < F.lit(end).cast("timestamp")
        rows &= F.col(time) < F.lit(end).cast("timestamp")
    schema = read_table(spark, path).schema
    found = [row.file for row in read_table(spark, manifest_path).where(files).select("file").collect()]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*found).where(rows)
