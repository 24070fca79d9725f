"""Replayed trades: exact removal in batch, bounded state in a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def dedupe_batch(df: DataFrame, keys: Sequence[str] = ("trade_id",), prefer: Sequence[str] = ("event_time",)):
    """One row per key: the smallest by ``prefer``, then by the remaining columns, so the choice never varies.

    An aggregate and not a ranked window: copies collapse in the map tasks before the shuffle, so an id that makes up
    a third of the input reaches its reducer as one row per map task. Rows with a NULL key are refused a place: they
    are no copies of one another, and belong into the quarantine.
    """
    df = df.dropna(subset=list(keys))
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    first = F.min(F.struct(*prefer, *rest)).alias("_first")
    picked = df.groupBy(*keys).agg(first)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def latest_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key: the largest by ``order``, then by the remaining columns."""
    rest = [c for c in df.columns if c not in keys and c != order]
    picked = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_last"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])


def dedupe_stream(
    df: DataFrame,
    watermark: str,
    keys: Sequence[str] = ("trade_id",),
    event_time: str = "event_time",
    spread_by: Column | None = None,
    spread: int = 16,
) -> DataFrame:
    """First arrival per key, state kept only while a copy can still arrive in time.

    A replay carries the event time of the original, so once the state of a key has expired its copies are late.
    ``spread_by`` adds a first pass on (key, hash of that column): copies of a hot key are then reduced on ``spread``
    partitions before they meet in one. Which of them stays is then left to the order of their arrival there, so use
    it only where copies are equal in all columns that are kept.
    """
    marked = df.withWatermark(event_time, watermark)
    if spread_by is None:
        return marked.dropDuplicatesWithinWatermark(list(keys))
    salted = marked.withColumn("_spread", F.pmod(F.xxhash64(spread_by), F.lit(spread)))
    once = salted.dropDuplicatesWithinWatermark([*keys, "_spread"]).drop("_spread")
    return once.dropDuplicatesWithinWatermark(list(keys))
