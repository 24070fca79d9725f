"""Ordered operators over per-key series, computed in chunks of bounded size.

``partitionBy("symbol")`` would put a symbol's whole history into one task. Here every row first gets its position in
its series from per-day counts, series are cut into chunks of ``chunk_rows`` positions, and each chunk borrows the few
rows before it that its frames look back on. The results equal those of windows over whole series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from tickloom.functions.scalar import utc_date

CHUNK_ROWS = 4096

_SERIES, _BUCKET = "_series", "_bucket"


def index_series(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    order: str = "window_start",
    value: str = "close",
    bucket: str = "day",
    start: DataFrame | None = None,
    offsets: DataFrame | None = None,
) -> DataFrame:
    """Add ``row_idx`` (position in the series, from 1) and ``candle_idx`` (running count of non-null ``value``).

    Rows are numbered within (series, bucket), which for candles is at most the number of windows in a day, and
    shifted by the counts of the earlier buckets. Only those per-bucket counts are ordered over a whole series. The
    series key is a struct so that a NULL key matches itself in the join. ``df`` is read twice: pass a stored table.

    ``start`` (keys, ``rows_before``, ``values_before``) continues series whose earlier rows are not in ``df``.
    ``offsets`` (keys, ``date``, ``rows_before``, ``values_before``) gives the counts before each date in UTC, for a ``df``
    that holds whole dates of a series with gaps between them; nothing is counted then.
    """
    within = W.partitionBy(_SERIES, _BUCKET).orderBy(order)
    numbers = {
        "_row": F.row_number().over(within),
        "_value": F.count(value).over(within.rowsBetween(W.unboundedPreceding, 0)),
    }
    places = {
        "row_idx": F.col("_rows_before") + F.col("_row"),
        "candle_idx": F.col("_values_before") + F.col("_value"),
    }
    if offsets is not None:
        known = offsets.select(
            F.struct(*keys).alias(_SERIES), F.col("date").alias(_BUCKET), F.col("rows_before").alias("_rows_before"),
            F.col("values_before").alias("_values_before"),
        )
        dated = df.withColumn(_SERIES, F.struct(*keys)).withColumn(_BUCKET, utc_date(F.col(order)))
        indexed = dated.withColumns(numbers).join(known, [_SERIES, _BUCKET]).withColumns(places)
        return indexed.select(*df.columns, _SERIES, "row_idx", "candle_idx")
    keyed = df.withColumn(_SERIES, F.struct(*keys)).withColumn(_BUCKET, F.date_trunc(bucket, order))
    counts = keyed.groupBy(_SERIES, _BUCKET).agg(F.count("*").alias("_rows"), F.count(value).alias("_values"))
    earlier = W.partitionBy(_SERIES).orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        _SERIES,
        _BUCKET,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_values").over(earlier), F.lit(0)).alias("_values_before"),
    )
    if start is not None:
        begun = start.select(F.struct(*keys).alias(_SERIES), "rows_before", "values_before")
        offsets = offsets.join(begun, _SERIES, "left").select(
            _SERIES,
            _BUCKET,
            (F.col("_rows_before") + F.coalesce("rows_before", F.lit(0))).alias("_rows_before"),
            (F.col("_values_before") + F.coalesce("values_before", F.lit(0))).alias("_values_before"),
        )
    indexed = keyed.withColumns(numbers).join(offsets, [_SERIES, _BUCKET]).withColumns(places)
    return indexed.select(*df.columns, _SERIES, "row_idx", "candle_idx")


def chunk_series(indexed: DataFrame, halo: int, chunk_rows: int, position: str = "row_idx") -> DataFrame:
    """Assign rows to chunks and lend the last ``halo`` positions of each chunk to the next one."""
    if not 0 <= halo <= chunk_rows:
        raise ValueError("halo must lie between 0 and chunk_rows")
    # rows before the first non-null value have position 0 when counting values; they belong to the first chunk
    start = F.greatest(F.col(position), F.lit(1)) - 1
    home = F.floor(start / chunk_rows)
    lent = start % chunk_rows >= chunk_rows - halo
    targets = F.when(lent, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
    return indexed.withColumn("_home", home).withColumn("_chunk", F.explode(targets))


def over_series(
    df: DataFrame,
    columns: Callable[[DataFrame, WindowSpec], DataFrame],
    halo: int,
    keys: Sequence[str] = ("symbol",),
    order: str = "window_start",
    value: str = "close",
    chunk_rows: int | None = CHUNK_ROWS,
    bucket: str = "day",
    start: DataFrame | None = None,
    offsets: DataFrame | None = None,
) -> DataFrame:
    """Apply ``columns(frame, window)`` with ``window`` ordered along each series; frames may look back ``halo`` rows.

    ``columns`` may also use ``row_idx`` and ``candle_idx``; both are dropped from the result unless it renames them.
    ``chunk_rows=None`` uses one window per series, for series known to be short. ``start`` continues series and
    ``offsets`` places parts of them, see ``index_series``.
    """
    if chunk_rows is None and (start is not None or offsets is not None):
        raise ValueError("continuing a series needs chunk_rows")
    if chunk_rows is None:
        window = W.partitionBy(*keys).orderBy(order)
        running = window.rowsBetween(W.unboundedPreceding, 0)
        plain = df.withColumns(
            {"row_idx": F.row_number().over(window), "candle_idx": F.count(value).over(running)}
        )
        return columns(plain, window).drop("row_idx", "candle_idx")
    chunked = chunk_series(index_series(df, keys, order, value, bucket, start, offsets), halo, chunk_rows)
    window = W.partitionBy(_SERIES, "_chunk").orderBy("row_idx")
    result = columns(chunked, window).where(F.col("_chunk") == F.col("_home"))
    return result.drop(_SERIES, "_home", "_chunk", "row_idx", "candle_idx")


def latest_per_key(
    df: DataFrame, keys: Sequence[str] = ("symbol",), order: str = "window_start", n: int = 1
) -> DataFrame:
    """The ``n`` newest rows per key with their rank ``recency`` from 1.

    Spark limits each map task to ``n`` rows per key before the shuffle, so a long series stays where it is.
    """
    newest = W.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("recency", F.row_number().over(newest)).where(F.col("recency") <= n)


def last_non_null(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("symbol",), order: str = "window_start"
) -> DataFrame:
    """Per key the newest non-null value of each column, NULL without one. One aggregate, partial in the map tasks."""
    def last(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order))).alias(name)

    return df.groupBy(*keys).agg(*[last(c) for c in columns])


def previous_value(df: DataFrame, column: str, keys: Sequence[str] = ("symbol",), order: str = "window_start",
                   chunk_rows: int | None = CHUNK_ROWS, bucket: str = "day") -> DataFrame:
    """Add ``prev_<column>``: the previous row's value, or the row's own on the first row of its series."""
    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        own_when_first = F.when(F.col("row_idx") == 1, F.col(column)).otherwise(F.lag(column).over(window))
        return frame.withColumn(f"prev_{column}", own_when_first)

    return over_series(df, add, halo=1, keys=keys, order=order, value=column, chunk_rows=chunk_rows, bucket=bucket)
