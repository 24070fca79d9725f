"""Signal classes and serving views over candles and indicators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.scalar import bps_text, clock_text, in_zone, one_decimal_text, percent_text, price_text
from tickloom.operators.series import latest_per_key
from tickloom.schemas import RSI_OVERBOUGHT, RSI_OVERSOLD, VWAP_BAND_BPS, WARMUP

NO_VALUE = "—"


def rsi_zone(rsi: Column) -> Column:
    return (
        F.when(rsi.isNull(), NO_VALUE)
        .when(rsi >= RSI_OVERBOUGHT, "Overbought")
        .when(rsi <= RSI_OVERSOLD, "Oversold")
        .otherwise("Neutral")
    )


def macd_direction(macd: Column, signal: Column) -> Column:
    """NULL when either is missing; equality counts as bearish."""
    return F.when(macd.isNull() | signal.isNull(), None).when(macd > signal, "Bullish").otherwise("Bearish")


def bollinger_position(close: Column, upper: Column, lower: Column) -> Column:
    return (
        F.when(close.isNull() | upper.isNull() | lower.isNull(), None)
        .when(close > upper, "Above")
        .when(close < lower, "Below")
        .otherwise("Inside")
    )


def vwap_distance_bps(close: Column, vwap: Column) -> Column:
    """Distance in basis points; NULL when either is missing or the VWAP is 0."""
    return F.try_divide(close - vwap, vwap) * 10_000


def vwap_position(distance_bps: Column) -> Column:
    return (
        F.when(distance_bps.isNull(), None)
        .when(distance_bps > VWAP_BAND_BPS, "Above")
        .when(distance_bps < -VWAP_BAND_BPS, "Below")
        .otherwise("At")
    )


def change_direction(change: Column) -> Column:
    """Up unless negative; a missing change counts as 0."""
    return F.when(F.coalesce(change, F.lit(0.0)) >= 0, "up").otherwise("down")


def percent_change(change: Column, previous: Column) -> Column:
    """0.0 when the previous value is 0."""
    return F.when(previous == 0, 0.0).otherwise(F.try_divide(change, previous) * 100)


def canonical_symbols(table: DataFrame) -> DataFrame:
    """Serving views group by the upper-cased symbol, whatever a writer stored."""
    return table.withColumn("symbol", F.upper("symbol"))


def distinct_symbols(candles: DataFrame) -> DataFrame:
    return canonical_symbols(candles.select("symbol")).distinct().orderBy("symbol")


def candle_directions(gold: DataFrame) -> DataFrame:
    """Direction of each candle's body and of its MACD histogram."""
    return gold.select(
        "symbol", "window_start",
        F.when(F.col("close") >= F.col("open"), "up").otherwise("down").alias("candle_direction"),
        F.coalesce("macd_histogram", F.lit(0.0)).alias("histogram"),
        change_direction(F.col("macd_histogram")).alias("histogram_direction"),
    )


def indicator_points(gold: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows to draw: those with a value in each of ``columns``."""
    return gold.dropna(subset=list(columns)).select("symbol", "window_start", *columns)


def price_board(candles: DataFrame, zone: str = "UTC") -> DataFrame:
    """Newest price per symbol with its change from the candle before; a lone candle has no change.

    Only the two newest candles per symbol take part, so no history is shuffled.
    """
    newest = latest_per_key(canonical_symbols(candles), n=2)
    pair = newest.groupBy("symbol").agg(
        F.max_by("avg_price", F.when(F.col("recency") == 1, 1)).alias("price"),
        F.max_by("avg_price", F.when(F.col("recency") == 2, 1)).alias("earlier"),
        F.max("recency").alias("_have"),
        F.max("window_start").alias("window_start"),
    )
    previous = F.when(F.col("_have") > 1, F.col("earlier")).otherwise(F.col("price"))
    board = pair.withColumn("prev_price", previous).withColumn("change", F.col("price") - F.col("prev_price"))
    board = board.withColumn("pct", percent_change(F.col("change"), F.col("prev_price")))
    return board.select(
        "symbol", "window_start", "price", "prev_price", "change", "pct",
        change_direction(F.col("change")).alias("direction"),
        price_text(F.col("price")).alias("price_label"),
        percent_text(F.col("pct")).alias("pct_label"),
        clock_text(in_zone(F.col("window_start"), zone)).alias("clock"),
    )


def signal_summary(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """One row per symbol of Silver, classified by its newest Gold row; NULL where Gold has no row for it.

    The last price is the newest average price, positions use the newest close.
    """
    latest = latest_per_key(canonical_symbols(silver)).select(
        "symbol", F.col("avg_price").alias("last_price"), F.col("close").alias("last_close")
    )
    indicators = latest_per_key(canonical_symbols(gold)).select(
        "symbol", "rsi", "macd_approx", "signal_approx", "bb_upper", "bb_lower", "vwap"
    )
    joined = latest.join(indicators, "symbol", "left").withColumn(
        "vwap_bps", vwap_distance_bps(F.col("last_close"), F.col("vwap"))
    )
    return joined.select(
        "symbol", "last_price", "last_close", "rsi",
        rsi_zone(F.col("rsi")).alias("rsi_zone"),
        macd_direction(F.col("macd_approx"), F.col("signal_approx")).alias("macd_direction"),
        bollinger_position(F.col("last_close"), F.col("bb_upper"), F.col("bb_lower")).alias("bollinger_position"),
        "vwap_bps",
        vwap_position(F.col("vwap_bps")).alias("vwap_position"),
        F.coalesce(price_text(F.col("last_price")), F.lit(NO_VALUE)).alias("price_label"),
        F.coalesce(one_decimal_text(F.col("rsi")), F.lit(NO_VALUE)).alias("rsi_label"),
        F.coalesce(bps_text(F.col("vwap_bps")), F.lit(NO_VALUE)).alias("vwap_label"),
    )


def warmup_status(candles: DataFrame, needs: Mapping[str, int] = WARMUP) -> DataFrame:
    """Per symbol and indicator the candles it has, the candles it needs, and whether it is ready."""
    counts = canonical_symbols(candles.select("symbol")).groupBy("symbol").agg(F.count("*").alias("have"))
    wanted = F.array(*[F.struct(F.lit(name).alias("indicator"), F.lit(n).alias("need")) for name, n in needs.items()])
    rows = counts.select("symbol", "have", F.explode(wanted).alias("w"))
    return rows.select(
        "symbol", F.col("w.indicator").alias("indicator"), "have", F.col("w.need").alias("need"),
        (F.col("have") >= F.col("w.need")).alias("is_ready"),
    )


def serving_view(table: DataFrame, zone: str = "UTC", columns: Sequence[str] = ("window_start", "window_end")):
    """A table as readers see it: upper-cased symbols, times in the display zone, ordered by symbol and time."""
    shown = canonical_symbols(table)
    present = [c for c in columns if c in table.columns]
    shown = shown.withColumns({c: in_zone(F.col(c), zone) for c in present})
    return shown.orderBy("symbol", "window_start")
