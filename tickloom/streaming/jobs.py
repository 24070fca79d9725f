"""The layers as streaming jobs: envelope to raw trades, raw trades to candles, candles to indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tickloom.functions.scalar import utc_date
from tickloom.operators import upsert
from tickloom.operators.bronze import bronze_rows, parse_envelope, quarantine_rows
from tickloom.operators.candles import ohlcv
from tickloom.operators.dedupe import dedupe_stream
from tickloom.operators.indicators import CHUNK_ROWS, GOLD_HALO, gold_from, gold_indicators
from tickloom.schemas import BRONZE, CANDLE_WINDOW, GOLD, MACD_SIGNAL, MACD_SLOW, QUARANTINE, SILVER, WATERMARK
from tickloom.sources.tables import overwrite_table, read_table, table_exists
from tickloom.streaming.runner import BATCH, replace_batch, start_batches, start_table_sink

CANDLE_DATE, TRADE_DATE = "candle_date", "trade_date"
COUNTS = StructType([
    StructField("symbol", StringType()), StructField("rows", LongType()), StructField("closes", LongType()),
    StructField("digest", DecimalType(30, 0)), StructField(CANDLE_DATE, DateType()),
])
LATE_FIELDS = [StructField("watermark", TimestampType()), StructField("delay_seconds", DoubleType())]
GOLD_WARMUP = MACD_SLOW + MACD_SIGNAL  # closes that a series needs before all of its indicators have values


def start_bronze(envelope: DataFrame, path: str, checkpoint: str, **sink) -> StreamingQuery:
    """Raw trades, partitioned by trade date so that time-range readers skip files."""
    rows = bronze_rows(parse_envelope(envelope)).withColumn(TRADE_DATE, utc_date(F.col("event_time")))
    return start_table_sink(rows, path, checkpoint, partition_by=[TRADE_DATE], **sink)


def start_quarantine(envelope: DataFrame, path: str, checkpoint: str, **sink) -> StreamingQuery:
    """Rejected messages with their reasons, in a query of its own: both sinks then keep their exactly-once commit."""
    return start_table_sink(quarantine_rows(parse_envelope(envelope)), path, checkpoint, **sink)


def start_bronze_and_quarantine(
    envelope: DataFrame, path: str, quarantine_path: str, checkpoint: str, files_per_batch: int | None = None, **sink
) -> StreamingQuery:
    """Raw trades and rejected messages from one read and one parse of the feed.

    Each micro-batch is parsed, kept, and written to both tables under its number. A run that stopped between the two
    writes does the batch again, which replaces what is there: the tables together always hold each message once.
    Read them by ``read_batches``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = bronze_rows(batch).withColumn(TRADE_DATE, utc_date(F.col("event_time")))
        replace_batch(rows, path, batch_id, [TRADE_DATE], files_per_batch)
        replace_batch(quarantine_rows(batch), quarantine_path, batch_id, files=1)

    return start_batches(parse_envelope(envelope), write, checkpoint, **sink)


def read_batches(spark: SparkSession, path: str, schema: StructType, dates: str | None = None) -> DataFrame:
    """A table of numbered batches with the columns of ``schema``, its date partition if it has one, and ``batch``."""
    fields = schema.fields + ([StructField(dates, DateType())] if dates else []) + [StructField(BATCH, LongType())]
    return read_table(spark, path, StructType(fields))


def start_trades_and_late(
    trades: DataFrame, path: str, late_path: str, log_path: str, checkpoint: str, watermark: str = WATERMARK, **sink
) -> StreamingQuery:
    """Trades in time and trades too late, each kept in a table of its own.

    A trade is late if its event time is not above the watermark with which its batch began, which is the rule by which
    the engine's stateful operators drop it: the greatest event time of all batches before, less the delay, in whole
    milliseconds. That maximum is kept per batch beside the tables, so that a repeated batch finds the same one. Late
    trades carry that watermark and their delay behind it in seconds.
    """
    spark = trades.sparkSession
    seen_schema = StructType([StructField("newest", LongType()), StructField(BATCH, LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = None
        if table_exists(spark, log_path):
            before = read_table(spark, log_path, seen_schema).where(F.col(BATCH) < batch_id)
            newest = before.agg(F.max("newest")).first()[0]
        limit = F.timestamp_millis(F.lit(newest).cast("long")) - F.expr(f"INTERVAL {watermark}")
        is_late = F.coalesce(F.col("event_time") <= limit, F.lit(False))
        dated = batch.withColumn(TRADE_DATE, utc_date(F.col("event_time")))
        replace_batch(dated.where(~is_late), path, batch_id, [TRADE_DATE])
        delay = (F.unix_micros("watermark") - F.unix_micros("event_time")) / 1e6
        late = batch.where(is_late).withColumn("watermark", limit).withColumn("delay_seconds", delay)
        replace_batch(late, late_path, batch_id, files=1)
        replace_batch(batch.agg(F.max(F.unix_millis("event_time")).alias("newest")), log_path, batch_id, files=1)

    return start_batches(trades, write, checkpoint, **sink)


def start_live_candles(
    trades: DataFrame, path: str, checkpoint: str, window: str = CANDLE_WINDOW, watermark: str = WATERMARK,
    fmt: str = "parquet", **sink
) -> StreamingQuery:
    """Candles as they stand after each micro-batch, open windows included, for a live board.

    The query runs in update mode: a batch gives the candles that it changed, which are merged by symbol and window. A
    merge replaces whole candles of the dates it touches, so a batch that is given again changes nothing. Read by
    ``read_layer``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert.upsert(batch, path, ["symbol", "window_start"], "window_start", "trade_count", fmt, CANDLE_DATE)

    return start_batches(candle_stream(trades, window, watermark), write, checkpoint, mode="update", **sink)


def candle_stream(
    trades: DataFrame,
    window: str = CANDLE_WINDOW,
    watermark: str = WATERMARK,
    keys: Sequence[str] = ("symbol",),
    spread_by: Column | None = None,
) -> DataFrame:
    """Candles of a trade stream, replays removed first. A candle is emitted once its window can change no more."""
    columns = list(dict.fromkeys([*keys, "price", "quantity", "event_time", "trade_id"]))
    lean = trades.select(*columns) if spread_by is None else trades
    return ohlcv(dedupe_stream(lean, watermark, spread_by=spread_by), window, keys)


def start_silver(trades: DataFrame, path: str, checkpoint: str, window: str = CANDLE_WINDOW,
                 watermark: str = WATERMARK, keys: Sequence[str] = ("symbol",), spread_by: Column | None = None,
                 **sink) -> StreamingQuery:
    """Candles, partitioned by date so that readers of a time range, and Gold's extension, skip the rest."""
    rows = dated(candle_stream(trades, window, watermark, keys, spread_by))
    return start_table_sink(rows, path, checkpoint, partition_by=[CANDLE_DATE], **sink)


def dated(candles: DataFrame) -> DataFrame:
    return candles.withColumn(CANDLE_DATE, utc_date(F.col("window_start")))


def read_layer(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Silver or Gold with the columns of ``schema`` and their partition, ``candle_date``."""
    return read_table(spark, path, StructType(schema.fields + [StructField(CANDLE_DATE, DateType())]), fmt)


def _replace_dates(rows: DataFrame, path: str, fmt: str) -> None:
    # the dates that ``rows`` has are replaced whole, others stay; rebalancing splits a date that is too large
    writer = rows.hint("rebalance", CANDLE_DATE).write.format(fmt).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(CANDLE_DATE).save(path)


def _counts_path(gold_path: str) -> str:
    return gold_path.rstrip("/") + "-counts"


def _counts(silver: DataFrame) -> DataFrame:
    """Candles, closes and an order-independent digest per symbol and date: the sum of the hashes of whole candles."""
    hashes = F.xxhash64(*SILVER.fieldNames()).cast("decimal(20,0)")
    return silver.groupBy("symbol", CANDLE_DATE).agg(
        F.count("*").alias("rows"), F.count("close").alias("closes"), F.sum(hashes).cast("decimal(30,0)").alias("digest")
    )


def _corrections_path(silver_path: str) -> str:
    return silver_path.rstrip("/") + "-corrections"


def _digests_path(silver_path: str) -> str:
    return silver_path.rstrip("/") + "-digests"


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Silver with its corrections in the place of the candles that they correct, and ``candle_date``.

    Only dates that have corrections are compared with them; all others come from the scan as they are.
    """
    silver = read_layer(spark, path, SILVER, fmt)
    if not table_exists(spark, _corrections_path(path), fmt):
        return silver
    corrections = read_layer(spark, _corrections_path(path), SILVER, fmt)
    dates = [row[0] for row in corrections.select(CANDLE_DATE).distinct().collect()]  # a calendar's at most
    touched = F.coalesce(F.col(CANDLE_DATE).isin(dates), F.lit(False))
    same = silver["symbol"].eqNullSafe(corrections["symbol"]) & (silver[CANDLE_DATE] == corrections[CANDLE_DATE]) & (
        silver["window_start"] == corrections["window_start"]
    )
    kept = silver.where(touched).join(corrections, same, "left_anti")
    return silver.where(~touched).unionByName(kept).unionByName(corrections)


def correct_candles(spark: SparkSession, corrections: DataFrame, silver_path: str, fmt: str = "parquet") -> None:
    """Replace candles of Silver, or add late ones, in a table beside it; a second run with the same rows changes nothing.

    The streamed table itself is left alone, since a stream keeps a list of the files that it committed. Of several
    corrections of one candle the one with most trades counts. The digests of the dates that are touched are recorded, so
    that ``correct_gold`` finds them without a look at Silver. Candles are replaced and added, never taken away; one
    without symbol has no key to be found by and is left out.
    """
    rows = corrections.select(*SILVER.fieldNames()).dropna(subset=["symbol", "window_start"])
    upsert.upsert(rows, _corrections_path(silver_path), ["symbol", "window_start"], "window_start", "trade_count", fmt,
                  CANDLE_DATE)
    dates = [row[0] for row in dated(rows).select(CANDLE_DATE).distinct().collect()]
    touched = read_silver(spark, silver_path, fmt).where(F.col(CANDLE_DATE).isin(dates))
    _replace_dates(_counts(touched), _digests_path(silver_path), fmt)


def _same(left: DataFrame, right: DataFrame):
    return left["symbol"].eqNullSafe(right["symbol"]) & (left[CANDLE_DATE] == right[CANDLE_DATE])


def _paired(new: DataFrame, old: DataFrame) -> DataFrame:
    """Counts of both sides per symbol and date (zero where one has none), and whether their candles differ."""
    def side(df: DataFrame, name: str) -> DataFrame:
        counts = [F.col(c).alias(f"{name}_{c}") for c in ("rows", "closes", "digest")]
        return df.select(F.struct("symbol", CANDLE_DATE).alias("k"), *counts)

    both = side(new, "new").join(side(old, "old"), "k", "full_outer")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("new_rows", "new_closes", "old_closes")]
    changed = ~F.col("new_digest").eqNullSafe(F.col("old_digest"))
    return both.select("k.symbol", f"k.{CANDLE_DATE}", *zero, changed.alias("changed"))


def _affected(paired: DataFrame) -> DataFrame:
    """Rows of ``paired`` with the counts before them, ``affected`` and ``needed``. One row per symbol and date.

    Indicators of a date change if its own candles did, if fewer than ``GOLD_HALO`` candles lie between it and the last
    date before that changed, or if the series was still warming up and a date before changed. They need the dates that
    hold the ``GOLD_HALO`` candles before.
    """
    before = W.partitionBy("symbol").orderBy(CANDLE_DATE).rowsBetween(W.unboundedPreceding, -1)
    after = W.partitionBy("symbol").orderBy(CANDLE_DATE).rowsBetween(1, W.unboundedFollowing)

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    counted = paired.withColumns({
        "rows_before": total("new_rows"), "values_before": total("new_closes"), "old_values_before": total("old_closes"),
    }).withColumn("rows_to", F.col("rows_before") + F.col("new_rows"))
    since = F.col("rows_before") - F.max(F.when(F.col("changed"), F.col("rows_to"))).over(before)
    warming = F.least("values_before", "old_values_before") < GOLD_WARMUP
    affected = F.col("changed") | F.coalesce((since < GOLD_HALO) | (since.isNotNull() & warming), F.lit(False))
    marked = counted.withColumn("affected", affected)
    until = F.min(F.when(F.col("affected"), F.col("rows_before"))).over(after) - F.col("rows_to")
    return marked.withColumn("needed", F.col("affected") | F.coalesce(until < GOLD_HALO, F.lit(False)))


def correct_gold(spark: SparkSession, silver_path: str, gold_path: str, fmt: str = "parquet",
                 chunk_rows: int = CHUNK_ROWS) -> None:
    """Bring Gold up to the corrections of Silver, and leave alone what they cannot reach.

    The digests that ``correct_candles`` recorded are compared with those that Gold was computed from. Dates that differ
    are read, and of each symbol the dates that depend on them and the ones before that hold the candles these look back
    on; no other date of Silver or Gold is read. The result equals a full pass over the corrected Silver. Gold's counts
    and digests are written last, so a run that stopped halfway is done again by the next one.
    """
    counts_path, digests_path = _counts_path(gold_path), _digests_path(silver_path)
    if not table_exists(spark, counts_path, fmt):
        refresh_gold(spark, silver_path, gold_path, fmt, chunk_rows)
        return
    if not table_exists(spark, digests_path, fmt):
        return
    known = read_table(spark, counts_path, COUNTS, fmt)
    recorded = read_table(spark, digests_path, COUNTS, fmt)
    ever = [row[0] for row in recorded.select(CANDLE_DATE).distinct().collect()]
    stale = _paired(recorded, known.where(F.col(CANDLE_DATE).isin(ever))).where("changed")
    dates = [row[0] for row in stale.select(CANDLE_DATE).distinct().collect()]
    if not dates:
        return
    silver = read_silver(spark, silver_path, fmt)
    inside = F.col(CANDLE_DATE).isin(dates)
    actual = _counts(silver.where(inside)).persist(StorageLevel.DISK_ONLY)
    plan = None
    try:
        changes = _paired(actual, known.where(inside))
        others = known.where(~inside)
        unchanged = others.select(
            "symbol", CANDLE_DATE, F.col("rows").alias("new_rows"), F.col("closes").alias("new_closes"),
            F.col("closes").alias("old_closes"), F.lit(False).alias("changed"),
        )
        plan = _affected(changes.unionByName(unchanged)).where("needed").persist(StorageLevel.DISK_ONLY)
        read = [row[0] for row in plan.select(CANDLE_DATE).distinct().collect()]
        reached = plan.where("affected").select("symbol", CANDLE_DATE)
        written = [row[0] for row in reached.select(CANDLE_DATE).distinct().collect()]
        candles = silver.where(F.col(CANDLE_DATE).isin(read))
        candles = candles.join(plan, _same(candles, plan), "left_semi").drop(CANDLE_DATE)
        offsets = plan.select("symbol", F.col(CANDLE_DATE).alias("date"), "rows_before", "values_before")
        scored = dated(gold_indicators(candles, chunk_rows=chunk_rows, offsets=offsets))
        fresh = scored.join(reached, _same(scored, reached), "left_semi")
        gold = read_layer(spark, gold_path, GOLD, fmt).where(F.col(CANDLE_DATE).isin(written))
        kept = gold.join(reached, _same(gold, reached), "left_anti")
        _replace_dates(kept.unionByName(fresh), gold_path, fmt)
        _replace_dates(actual, counts_path, fmt)
        _replace_dates(actual, digests_path, fmt)  # as they are now, should Silver have grown since
    finally:
        actual.unpersist()
        if plan is not None:
            plan.unpersist()


def refresh_gold(spark: SparkSession, silver_path: str, gold_path: str, fmt: str = "parquet",
                 chunk_rows: int | None = CHUNK_ROWS) -> None:
    """Recompute the indicators of all candles and replace the table and its counts."""
    silver = read_silver(spark, silver_path, fmt)
    gold = dated(gold_indicators(silver.drop(CANDLE_DATE), chunk_rows=chunk_rows))
    overwrite_table(gold, gold_path, [CANDLE_DATE], fmt)
    overwrite_table(_counts(silver), _counts_path(gold_path), [CANDLE_DATE], fmt)


def extend_gold(spark: SparkSession, silver_path: str, gold_path: str, fmt: str = "parquet",
                chunk_rows: int = CHUNK_ROWS) -> None:
    """Bring Gold up to Silver by the newest dates only.

    A small table beside Gold counts the candles of each symbol and date. Its newest date is the first to be computed
    again, since it may have been incomplete; Silver is read from the date on that gives each symbol the candles that
    its indicators look back on, and older dates are neither listed nor read. Dates are replaced whole and the counts
    are written last: an extension that stopped halfway is done again by the next one. For a Silver table written by the
    candle stream, which emits windows in the order in which they close. Corrections to older candles reach Gold by
    ``correct_gold``.
    """
    counts_path = _counts_path(gold_path)
    if not table_exists(spark, counts_path, fmt):
        refresh_gold(spark, silver_path, gold_path, fmt, chunk_rows)
        return
    counts = read_table(spark, counts_path, COUNTS, fmt)
    first_date = counts.agg(F.max(CANDLE_DATE)).first()[0]
    if first_date is None:
        refresh_gold(spark, silver_path, gold_path, fmt, chunk_rows)
        return
    # per symbol, the newest dates before that hold enough candles: one row per symbol and date
    newer = W.partitionBy("symbol").orderBy(F.desc(CANDLE_DATE)).rowsBetween(W.unboundedPreceding, -1)
    past = counts.where(F.col(CANDLE_DATE) < F.lit(first_date)).withColumn(
        "lent", F.coalesce(F.sum("rows").over(newer), F.lit(0)) < GOLD_HALO
    )
    past = past.persist(StorageLevel.DISK_ONLY)
    try:
        needed = past.where("lent").select("symbol", CANDLE_DATE)
        dates = [row[0] for row in needed.select(CANDLE_DATE).distinct().collect()]  # few, and no rows of candles
        start = past.where("NOT lent").groupBy("symbol").agg(
            F.sum("rows").alias("rows_before"), F.sum("closes").alias("values_before")
        )
        silver = read_silver(spark, silver_path, fmt)
        since = silver.where(F.col(CANDLE_DATE) >= F.lit(first_date))
        same = silver["symbol"].eqNullSafe(needed["symbol"]) & (silver[CANDLE_DATE] == needed[CANDLE_DATE])
        lead = silver.where(F.col(CANDLE_DATE).isin(dates)).join(needed, same, "left_semi")
        recent = lead.unionByName(since).drop(CANDLE_DATE)
        _replace_dates(dated(gold_from(recent, start, F.lit(first_date), chunk_rows=chunk_rows)), gold_path, fmt)
        _replace_dates(_counts(since), counts_path, fmt)
    finally:
        past.unpersist()
