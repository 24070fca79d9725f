"""Open-high-low-close-volume candles and VWAP over tumbling event-time windows, batch and stream alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tickloom.schemas import CANDLE_WINDOW

_MEASURES = ("open", "high", "low", "close", "volume", "trade_count", "avg_price", "vwap")


def ohlcv(
    trades: DataFrame,
    window: str = CANDLE_WINDOW,
    keys: Sequence[str] = ("symbol",),
) -> DataFrame:
    """One candle per (window, keys).

    Open and close are the prices at the first and last event time; among trades at the same instant open takes the
    lowest price and close the highest. That rule orders (time, price) pairs, which Spark aggregates by sorting each
    map partition first. The map tasks reduce their rows to one per group before the shuffle, so a hot symbol costs no
    more than any other. Hash aggregation would need a first step by instant, which shuffles nearly every trade.
    """
    first = F.min(F.struct("event_time", "price"))["price"]
    last = F.max(F.struct("event_time", "price"))["price"]
    bucket = F.window("event_time", window)
    # a stream needs the window itself, which carries the watermark; for a batch its start is the cheaper key
    key = bucket.alias("window") if trades.isStreaming else bucket["start"].alias("window_start")
    grouped = trades.groupBy(key, *keys).agg(
        first.alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        last.alias("close"),
        F.sum("quantity").alias("volume"),
        F.count("*").alias("trade_count"),
        F.avg("price").alias("avg_price"),
        F.sum(F.col("price") * F.col("quantity")).alias("notional"),
    )
    if trades.isStreaming:
        start, end = F.col("window.start"), F.col("window.end")
    else:
        start, end = F.col("window_start"), F.window("window_start", window)["end"]
    vwap = F.when(F.col("volume") > 0, F.col("notional") / F.col("volume"))
    return grouped.withColumn("vwap", vwap).select(
        start.alias("window_start"), end.alias("window_end"), *keys, *_MEASURES
    )


def closed_candles(candles: DataFrame, watermark: str, newest) -> DataFrame:
    """Candles a stream in append mode has emitted once it has seen event time ``newest`` (a timestamp literal)."""
    return candles.where(F.col("window_end") <= F.lit(newest) - F.expr(f"INTERVAL {watermark}"))
