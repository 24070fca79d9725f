"""Registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.functions.scalar import clock_text, utc_date
from tickloom.operators import bronze, candles, dedupe, digests, drift, indicators, layout, normalize, quality, series, signals, upsert
from tickloom.plans import feeds
from tickloom.schemas import (
    BRONZE,
    GLOBAL_METRICS,
    GOLD,
    GOLD_REQUIRED,
    MARKET_SNAPSHOT,
    QUARANTINE,
    SILVER,
    SILVER_REQUIRED,
    SYMBOLS,
    TRADE_FIELDS,
    TRADE_MESSAGE,
    VENUE_B,
    WATERMARK,
)
from tickloom.session import materialize, require_utc, scratch_path
from tickloom.sources import kafka, landing, tables
from tickloom.streaming import health, jobs, runner

WINDOW = "1 hour"
ZONE = "Europe/Paris"
UPDATES_FROM = "2024-01-15"
BASE_UNTIL = "2024-01-20"
EXTENDED_FROM = "2024-01-15 07:00:00"
RANGE = ("2024-01-10", "2024-01-11")
CORRECTED = ("2024-01-09 11:00:00", "2024-01-10 04:00:00")  # candles that a symbol gets late
CURVE_ROWS = 10_000  # of a file along the curve, few because the feed is small
MISTAKEN = ("2024-01-20 05:00:00", "2024-01-20 09:00:00")  # candles of another one with wrong prices at first

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, instants as zone-free timestamps, arrays of text as text.

    Averages over 2^n rows often end in an exact half at the seventh decimal, where the order of summation would
    decide the last digit. A billionth is added first, so that such halves always round the same way.
    """
    shown = {}
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            shown[field.name] = F.round(column + 1e-9, 6) + F.lit(0.0)
        elif isinstance(field.dataType, T.TimestampType):
            shown[field.name] = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            shown[field.name] = F.array_join(column, ",")
    return df.withColumns(shown) if shown else df


def silver_of(trades: DataFrame) -> DataFrame:
    return candles.ohlcv(trades, WINDOW)


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles written as the Silver table and read back, so that several readers do not rebuild them."""
    return materialize(silver_of(feeds.trades(spark, sf_dir)), "silver")


def stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trades written as the Bronze table and read back, so that messages are parsed once for several readers."""
    return materialize(bronze.bronze_rows(bronze.parse_envelope(feeds.envelope(spark, sf_dir))), "bronze")


# ---- candles and indicators -------------------------------------------------------------------------------------
def ohlcv_candles(spark, sf_dir):
    return silver_of(dedupe.dedupe_batch(feeds.trades_with_replays(spark, sf_dir)))


def ohlcv_by_source(spark, sf_dir):
    return candles.ohlcv(feeds.trades(spark, sf_dir), "1 day", keys=("symbol", "source"))


def brand_weekly_candles(spark, sf_dir):
    return candles.ohlcv(feeds.brand_trades(spark, sf_dir), "7 days")


def brand_daily_indicators(spark, sf_dir):
    daily = materialize(candles.ohlcv(feeds.brand_trades(spark, sf_dir), "1 day"), "brand-daily")
    columns = ("symbol", "window_start", "close", "rsi", "macd_approx", "signal_approx", "bb_middle", "bb_upper")
    # a day holds one candle here, so candles are counted by year
    return indicators.gold_indicators(daily, chunk_rows=512, bucket="year").select(*columns)


def candle_index(spark, sf_dir):
    indexed = indicators.candle_index(stored_silver(spark, sf_dir))
    return indexed.select("symbol", "window_start", "row_idx", "candle_idx")


def price_change_lag(spark, sf_dir):
    changed = indicators.price_change(stored_silver(spark, sf_dir))
    return changed.select("symbol", "window_start", "close", "prev_close", "change", "gain", "loss")


def previous_price(spark, sf_dir):
    return series.previous_value(stored_silver(spark, sf_dir), "avg_price").select(
        "symbol", "window_start", "avg_price", "prev_avg_price"
    )


def rolling_mean_std(spark, sf_dir):
    rolled = indicators.rolling_stats(stored_silver(spark, sf_dir), "close", 20)
    return rolled.select("symbol", "window_start", "mean_20", "std_20")


def rsi14(spark, sf_dir):
    scored = indicators.rsi(stored_silver(spark, sf_dir))
    return scored.select("symbol", "window_start", "avg_gain", "avg_loss", "rsi")


def macd_sma(spark, sf_dir):
    scored = indicators.macd(stored_silver(spark, sf_dir))
    return scored.select(
        "symbol", "window_start", "ma12", "ma26", "macd_approx", "signal_approx", "macd_histogram"
    )


def bollinger20(spark, sf_dir):
    banded = indicators.bollinger(stored_silver(spark, sf_dir))
    return banded.select("symbol", "window_start", "bb_middle", "bb_std", "bb_upper", "bb_lower")


def gold_indicators(spark, sf_dir):
    return indicators.gold_indicators(stored_silver(spark, sf_dir), chunk_rows=512)


def ema_macd(spark, sf_dir):
    return indicators.ema_macd(stored_silver(spark, sf_dir))


def ema_macd_gaps(spark, sf_dir):
    """Every fifth hour has no close."""
    silver = stored_silver(spark, sf_dir)
    hour = F.floor(F.unix_micros("window_start") / 3_600_000_000)
    return indicators.ema_macd(silver.withColumn("close", F.when(hour % 5 != 0, F.col("close"))), chunk_rows=64)


def volume_zscore(spark, sf_dir):
    scored = indicators.volume_zscore(stored_silver(spark, sf_dir))
    return scored.select("symbol", "window_start", "volume", "volume_mean", "volume_std", "volume_zscore", "is_spike")


# ---- raw layer and normalisation --------------------------------------------------------------------------------
def bronze_parse(spark, sf_dir):
    rows = bronze.bronze_rows(bronze.parse_envelope(feeds.envelope(spark, sf_dir)))
    return rows.drop("ingested_at", "raw_payload")


def bronze_quarantine(spark, sf_dir):
    rejected = bronze.quarantine_rows(bronze.parse_envelope(feeds.envelope(spark, sf_dir)))
    return rejected.drop("raw_payload")


def message_completeness(spark, sf_dir):
    checked = bronze.message_completeness(bronze.parse_envelope(feeds.envelope(spark, sf_dir)))
    return checked.drop("raw_payload")


def normalize_venue_a(spark, sf_dir):
    return normalize.normalize_venue_a(feeds.venue_a_messages(spark, sf_dir))


def normalize_venue_b(spark, sf_dir):
    return normalize.normalize_venue_b(feeds.venue_b_messages(spark, sf_dir))


def venue_a_rejects(spark, sf_dir):
    """Trades with texts that cannot be read; of the texts those that are to blame."""
    rows = normalize.venue_a_rejects(feeds.venue_a_messages(spark, sf_dir, faults=True))
    texts = {"price_text": "price", "quantity_text": "quantity", "event_text": "event_time"}
    return rows.withColumns({
        text: F.when(F.array_contains("reasons", f"invalid:{name}"), F.col(text)) for text, name in texts.items()
    })


def venue_a_strict(spark, sf_dir):
    return normalize.normalize_venue_a(feeds.venue_a_messages(spark, sf_dir, faults=True), strict=True)


def venue_b_rejects(spark, sf_dir):
    return normalize.venue_b_rejects(feeds.venue_b_messages(spark, sf_dir))


def venue_union(spark, sf_dir):
    return normalize.union_venues(normalize_venue_a(spark, sf_dir), normalize_venue_b(spark, sf_dir))


def symbol_map(spark, sf_dir):
    updates = normalize.venue_b_updates(feeds.venue_b_messages(spark, sf_dir))
    mapped = normalize.map_pairs(updates, normalize.symbol_dimension(spark))
    return mapped.groupBy("venue_pair", "symbol").agg(F.count("*").alias("trades"))


def allowed_symbols(spark, sf_dir):
    kept = feeds.trades(spark, sf_dir).where(F.col("symbol").isin(*SYMBOLS[:3]))
    return quality.counts_by(kept, "symbol")


def kafka_publish_rows(spark, sf_dir):
    """Rows to publish, their JSON value shown by its fields."""
    messages = feeds.with_trade_columns(feeds.table(spark, sf_dir, "events")).withColumn(
        "event_time", F.unix_millis("event_time")
    )
    rows = kafka.publish_rows(messages)
    return rows.select("topic", "key", F.from_json("value", TRADE_MESSAGE).alias("t")).select("topic", "key", "t.*")


def raw_replay(spark, sf_dir):
    path = scratch_path(spark, "landing")
    landing.save_raw(bronze.parse_envelope(feeds.envelope(spark, sf_dir)), "raw_payload", path)
    return bronze.reparse_payloads(landing.read_raw(spark, path))


def json_landing(spark, sf_dir):
    """Unified trades kept as JSON rows and read back by their schema."""
    path = scratch_path(spark, "json")
    landing.save_json(normalize_venue_a(spark, sf_dir), path)
    return landing.read_json(spark, path, TRADE_MESSAGE)


def stored_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a feed that drifts, landed with their payload as text and as VARIANT."""
    return materialize(drift.with_variant(feeds.drifting_messages(spark, sf_dir)), "payloads")


def payload_drift(spark, sf_dir):
    """Fields that appeared, vanished or changed type, by topic and date."""
    return drift.field_changes(drift.payload_shapes(stored_payloads(spark, sf_dir)))


def payload_readability(spark, sf_dir):
    return drift.unreadable(drift.payload_shapes(stored_payloads(spark, sf_dir)))


def drift_replay(spark, sf_dir):
    """Unified messages with a field that the contract got later, and the names of those it still does not know."""
    rows = drift.promote(drift.replay_with_rest(stored_payloads(spark, sf_dir)), "fee", "double")
    return rows.withColumn("rest", F.to_json("rest"))


def curve_lookup(spark, sf_dir):
    """A day of one symbol out of trades laid along the curve of symbol and time."""
    path, manifest = scratch_path(spark, "curve"), scratch_path(spark, "curve-files")
    layout.write_along_curve(feeds.trades(spark, sf_dir), path, manifest, rows_per_file=CURVE_ROWS)
    return layout.look_up(spark, path, manifest, "ETHUSDT", *RANGE)


def market_snapshot_rows(spark, sf_dir):
    return normalize.market_snapshot_rows(feeds.market_payloads(spark, sf_dir))


def global_metrics_rows(spark, sf_dir):
    return normalize.global_metrics_rows(feeds.global_payloads(spark, sf_dir))


# ---- dedupe, upsert, tables -------------------------------------------------------------------------------------
def dedupe_trades(spark, sf_dir):
    return dedupe.dedupe_batch(feeds.trades_with_replays(spark, sf_dir))


def snapshot_upsert(spark, sf_dir):
    rows = materialize(market_snapshot_rows(spark, sf_dir), "snapshots")
    path = scratch_path(spark, "market_snapshot")
    upsert.upsert_market_snapshot(rows.where(F.col("snapshot_hour") < BASE_UNTIL), path)
    corrected = rows.where(F.col("snapshot_hour") >= UPDATES_FROM).withColumns(
        {"current_price": F.col("current_price") + 1, "ingested_at": F.expr("ingested_at + INTERVAL 1 MINUTE")}
    )
    for _ in range(2):  # merging the same source again changes nothing
        upsert.upsert_market_snapshot(corrected, path)
    return upsert.read_snapshots(spark, path, MARKET_SNAPSHOT)


def global_metrics_upsert(spark, sf_dir):
    rows = materialize(global_metrics_rows(spark, sf_dir), "metrics")
    path = scratch_path(spark, "global_metrics")
    upsert.upsert_global_metrics(rows.where(F.col("snapshot_hour") < BASE_UNTIL), path)
    update = rows.where(F.col("snapshot_hour") >= UPDATES_FROM)
    newer = update.withColumns(
        {"markets": F.col("markets") + 100, "ingested_at": F.expr("ingested_at + INTERVAL 1 MINUTE")}
    )
    upsert.upsert_global_metrics(update.unionByName(newer), path)
    return upsert.read_snapshots(spark, path, GLOBAL_METRICS)


def roundtrip_overwrite(spark, sf_dir):
    path = scratch_path(spark, "roundtrip")
    fresh = silver_of(feeds.trades(spark, sf_dir))
    for _ in range(2):
        tables.overwrite_table(fresh, path)
    return tables.read_table(spark, path, SILVER)


def backfill_merge(spark, sf_dir):
    """History loaded twice beside a raw table that a stream has written, read together."""
    sink, history_path = _sink(spark, "bronze"), scratch_path(spark, "history")
    live = F.col("event_time") >= UPDATES_FROM
    envelope = feeds.envelope_of(_trade_stream(spark, sf_dir).where(live))
    runner.drain(jobs.start_bronze(envelope, **sink))
    history = feeds.envelope_of(feeds.with_trade_columns(feeds.table(spark, sf_dir, "events")).where(~live))
    rows = bronze.bronze_rows(bronze.parse_envelope(history))
    for _ in range(2):
        upsert.backfill(rows, history_path, "history")
    both = upsert.read_raw_table(spark, sink["path"], history_path, BRONZE)
    return both.withColumn("load", F.coalesce("load", F.lit("live"))).drop("ingested_at", "raw_payload", "trade_date")


# ---- streams ----------------------------------------------------------------------------------------------------
def _trade_stream(spark, sf_dir, copies=False, late=False):
    """The trades as a stream of one micro-batch per week.

    With ``copies`` the reconnecting users' trades come again a week later, with ``late`` the first week's trades of
    one user come in the fourth only.
    """
    rows = feeds.with_trade_columns(feeds.table(spark, sf_dir, "events"))
    arrival = feeds.week_of(F.col("event_time"))
    if copies:
        rows = feeds.replayed(rows)
        arrival = arrival + F.col("copy")
    if late:
        arrival = F.when(feeds.is_late(), F.lit(3)).otherwise(arrival)
    path = scratch_path(spark, "arrivals")
    files = feeds.land(rows, arrival, path)
    return tables.stream_table(spark, path, rows.schema, max_files_per_trigger=files)


def _sink(spark, name):
    """Fresh folders, and as many state partitions as there are cores."""
    return {
        "path": scratch_path(spark, name),
        "checkpoint": scratch_path(spark, f"{name}-checkpoint"),
        "state_partitions": spark.sparkContext.defaultParallelism,
    }


def stream_bronze(spark, sf_dir):
    sink = _sink(spark, "bronze")
    envelope = feeds.envelope_of(_trade_stream(spark, sf_dir))
    runner.drain(jobs.start_bronze(envelope, **sink))
    schema = T.StructType(BRONZE.fields + [T.StructField("trade_date", T.DateType())])
    stored = tables.read_table(spark, sink["path"], schema)
    return stored.drop("ingested_at", "raw_payload", "trade_date")


def stream_quarantine(spark, sf_dir):
    sink = _sink(spark, "quarantine")
    envelope = feeds.envelope_of(_trade_stream(spark, sf_dir))
    runner.drain(jobs.start_quarantine(envelope, **sink))
    return tables.read_table(spark, sink["path"]).drop("raw_payload")


def stream_bronze_and_quarantine(spark, sf_dir):
    """Both tables of one query that reads and parses the feed once, together."""
    path, rejected = scratch_path(spark, "bronze"), scratch_path(spark, "quarantine")
    envelope = feeds.envelope_of(_trade_stream(spark, sf_dir))
    runner.drain(jobs.start_bronze_and_quarantine(envelope, path, rejected, scratch_path(spark, "checkpoint")))
    columns = ("topic", "kafka_partition", "kafka_offset", "kafka_timestamp")
    kept = jobs.read_batches(spark, path, BRONZE, jobs.TRADE_DATE).select(
        F.lit("bronze").alias("table_name"), *columns, "trade_id", F.lit(None).cast("array<string>").alias("reasons")
    )
    return kept.unionByName(jobs.read_batches(spark, rejected, QUARANTINE).select(
        F.lit("quarantine").alias("table_name"), *columns, F.lit(None).cast("string").alias("trade_id"), "reasons"
    ))


def stream_ohlcv(spark, sf_dir):
    sink = _sink(spark, "silver")
    replays = _trade_stream(spark, sf_dir, copies=True)
    runner.drain(jobs.start_silver(replays, window=WINDOW, **sink))
    return jobs.read_layer(spark, sink["path"], SILVER).drop(jobs.CANDLE_DATE)


def stream_dedupe(spark, sf_dir):
    sink = _sink(spark, "dedupe")
    replays = _trade_stream(spark, sf_dir, copies=True)
    # a copy comes a week after its trade, so the state must remember a week and what a batch may be late by
    unique = dedupe.dedupe_stream(replays.select(*TRADE_FIELDS), "16 days")
    runner.drain(runner.start_table_sink(unique, **sink))
    return tables.read_table(spark, sink["path"])


def stream_feed_health(spark, sf_dir):
    sink = _sink(spark, "health")
    envelope = feeds.envelope_of(_trade_stream(spark, sf_dir))
    checked = bronze.message_completeness(bronze.parse_envelope(envelope)).withWatermark("kafka_timestamp", WATERMARK)
    runner.drain(runner.start_table_sink(quality.feed_health(checked, "1 day"), **sink))
    return tables.read_table(spark, sink["path"])


def stream_gold_refresh(spark, sf_dir):
    sink = _sink(spark, "silver")
    gold_path = scratch_path(spark, "gold")
    runner.drain(jobs.start_silver(_trade_stream(spark, sf_dir), window=WINDOW, **sink))
    jobs.refresh_gold(spark, sink["path"], gold_path)
    return jobs.read_layer(spark, gold_path, GOLD).drop(jobs.CANDLE_DATE)


def gold_extend(spark, sf_dir):
    """Gold built up to the middle of a day, then extended by the candles after it, twice."""
    silver_path, gold_path = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    silver = jobs.dated(stored_silver(spark, sf_dir))
    early = F.col("window_start") < EXTENDED_FROM
    tables.append_table(silver.where(early), silver_path, [jobs.CANDLE_DATE])
    jobs.extend_gold(spark, silver_path, gold_path)
    tables.append_table(silver.where(~early), silver_path, [jobs.CANDLE_DATE])
    for _ in range(2):
        jobs.extend_gold(spark, silver_path, gold_path)
    return jobs.read_layer(spark, gold_path, GOLD).drop(jobs.CANDLE_DATE)


def gold_correct(spark, sf_dir):
    """Gold of a Silver with wrong and missing candles in the middle, brought up to their corrections, twice."""
    silver_path, gold_path = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    silver = stored_silver(spark, sf_dir)
    time = F.col("window_start")
    late = (F.col("symbol") == SYMBOLS[1]) & time.between(*CORRECTED)
    wrong = (F.col("symbol") == SYMBOLS[2]) & time.between(*MISTAKEN)
    first = silver.where(~late).withColumn("close", F.when(wrong, F.col("close") * 2).otherwise(F.col("close")))
    tables.append_table(jobs.dated(first), silver_path, [jobs.CANDLE_DATE])
    jobs.refresh_gold(spark, silver_path, gold_path)
    for corrections in (silver.where(late), silver.where(wrong)):
        jobs.correct_candles(spark, corrections, silver_path)
        jobs.correct_gold(spark, silver_path, gold_path)
    return jobs.read_layer(spark, gold_path, GOLD).drop(jobs.CANDLE_DATE)


def _late_silver(spark, sf_dir, name):
    """Candles of the feed with late trades, and the table of the progress that Spark reports of it."""
    sink, log_path = _sink(spark, "silver"), scratch_path(spark, "progress")
    with runner.recording(spark, log_path) as log:
        trades = _trade_stream(spark, sf_dir, late=True)
        log.wait_for(runner.drain(jobs.start_silver(trades, window=WINDOW, name=name, **sink)))
    return jobs.read_layer(spark, sink["path"], SILVER).drop(jobs.CANDLE_DATE), runner.read_progress(spark, log_path)


def stream_late_candles(spark, sf_dir):
    """Candles without the trades that come too late."""
    return _late_silver(spark, sf_dir, "silver_late")[0]


def stream_progress(spark, sf_dir):
    """Rows fed to a stream, rows it dropped as late by its own count, and whether each arrival was a batch."""
    _, progress = _late_silver(spark, sf_dir, "silver_progress")
    return progress.groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"),
        F.count_if(F.col("input_rows") > 0).alias("data_batches"),
    )


def stream_late_trades(spark, sf_dir):
    """The trades themselves that come too late, and by how much."""
    path, late_path, log_path = (scratch_path(spark, name) for name in ("in-time", "late", "newest"))
    trades = _trade_stream(spark, sf_dir, late=True).select(*TRADE_FIELDS)
    schema = trades.schema
    runner.drain(jobs.start_trades_and_late(trades, path, late_path, log_path, scratch_path(spark, "checkpoint")))
    late = jobs.read_batches(spark, late_path, T.StructType(schema.fields + jobs.LATE_FIELDS))
    return late.select("symbol", "trade_id", "event_time", "watermark", "delay_seconds")


def stream_price_board(spark, sf_dir):
    """The price board of candles that a stream keeps up to date, open windows included."""
    path = scratch_path(spark, "live")
    sink = {"checkpoint": scratch_path(spark, "live-checkpoint"), "state_partitions": spark.sparkContext.defaultParallelism}
    runner.drain(jobs.start_live_candles(_trade_stream(spark, sf_dir), path, window=WINDOW, **sink))
    return signals.price_board(jobs.read_layer(spark, path, SILVER).drop(jobs.CANDLE_DATE), ZONE)


def stream_state_health(spark, sf_dir):
    """State that a drained candle stream has left in its checkpoint, per operator."""
    sink = _sink(spark, "silver")
    runner.drain(jobs.start_silver(_trade_stream(spark, sf_dir, copies=True), window=WINDOW, **sink))
    return health.state_health(spark, sink["checkpoint"]).groupBy("operator").agg(
        F.sum("state_rows").alias("state_rows"), F.min("first_due").alias("first_due"),
        F.max("last_due").alias("last_due"),
    )


def late_data_audit(spark, sf_dir):
    """Per symbol the trades that the stream of unique trades dropped as late."""
    sink = _sink(spark, "audit")
    unique = dedupe.dedupe_stream(_trade_stream(spark, sf_dir, late=True).select(*TRADE_FIELDS), WATERMARK)
    runner.drain(runner.start_table_sink(unique, **sink))
    return quality.late_summary(feeds.trades(spark, sf_dir), tables.read_table(spark, sink["path"]))


# ---- serving ----------------------------------------------------------------------------------------------------
def latest_per_symbol(spark, sf_dir):
    return series.latest_per_key(silver_of(feeds.trades(spark, sf_dir))).drop("recency")


def last_non_null(spark, sf_dir):
    return series.last_non_null(silver_of(feeds.trades(spark, sf_dir)), ["close", "vwap", "volume"])


def price_board(spark, sf_dir):
    return signals.price_board(silver_of(feeds.trades(spark, sf_dir)), ZONE)


def signal_summary(spark, sf_dir):
    silver = stored_silver(spark, sf_dir)
    return signals.signal_summary(silver, indicators.gold_indicators(silver))


def signal_history(spark, sf_dir):
    """The four classifiers on every candle."""
    gold = indicators.gold_indicators(stored_silver(spark, sf_dir))
    bps = signals.vwap_distance_bps(F.col("close"), F.col("vwap"))
    return gold.select(
        "symbol", "window_start",
        signals.rsi_zone(F.col("rsi")).alias("rsi_zone"),
        signals.macd_direction(F.col("macd_approx"), F.col("signal_approx")).alias("macd_direction"),
        signals.bollinger_position(F.col("close"), F.col("bb_upper"), F.col("bb_lower")).alias("bollinger_position"),
        bps.alias("vwap_bps"),
        signals.vwap_position(bps).alias("vwap_position"),
    )


def warmup_status(spark, sf_dir):
    return signals.warmup_status(silver_of(feeds.trades(spark, sf_dir)))


def candle_direction(spark, sf_dir):
    return signals.candle_directions(indicators.gold_indicators(stored_silver(spark, sf_dir)))


def indicator_points(spark, sf_dir):
    gold = indicators.gold_indicators(stored_silver(spark, sf_dir))
    return signals.indicator_points(gold, ["macd_approx", "signal_approx"])


def distinct_symbols(spark, sf_dir):
    return signals.distinct_symbols(silver_of(feeds.trades(spark, sf_dir)))


def display_time(spark, sf_dir):
    shown = silver_of(feeds.trades(spark, sf_dir)).select("symbol", "window_start", "window_end", "close")
    return signals.serving_view(shown, ZONE).withColumn("clock", clock_text(F.col("window_start")))


# ---- quality ----------------------------------------------------------------------------------------------------
def bronze_silver_recon(spark, sf_dir):
    """Candles rebuilt from replayed trades against Silver kept without one venue's last day, which must show up."""
    recorded = feeds.trades(spark, sf_dir).where(
        ~((F.col("source") == VENUE_B) & (F.col("event_time") >= "2024-01-30"))
    )
    return quality.reconcile_candles(feeds.trades_with_replays(spark, sf_dir), silver_of(recorded), WINDOW)


def recon_by_digests(spark, sf_dir):
    """Only the windows that differ, found from the digests that both layers keep."""
    paths = {name: scratch_path(spark, name) for name in ("bronze", "silver", "bronze-tree", "silver-tree")}
    trades = feeds.trades_with_replays(spark, sf_dir).withColumn("trade_date", utc_date(F.col("event_time")))
    recorded = feeds.trades(spark, sf_dir).where(
        ~((F.col("source") == VENUE_B) & (F.col("event_time") >= "2024-01-30"))
    )
    tables.append_table(trades, paths["bronze"], ["trade_date"])
    tables.append_table(jobs.dated(silver_of(recorded)), paths["silver"], [jobs.CANDLE_DATE])
    bronze_rows, silver = (tables.read_table(spark, paths[name]) for name in ("bronze", "silver"))
    digests.record_digests(silver_of(dedupe.dedupe_batch(bronze_rows.drop("trade_date"))), paths["bronze-tree"])
    digests.record_digests(silver, paths["silver-tree"])
    return digests.reconcile_by_digests(bronze_rows, silver, paths["bronze-tree"], paths["silver-tree"], WINDOW)


def layer_count_parity(spark, sf_dir):
    """Gold that lost one symbol's last days, which must show up."""
    silver = stored_silver(spark, sf_dir)
    gold = indicators.gold_indicators(silver)
    lost = (F.col("symbol") == SYMBOLS[0]) & (F.col("window_start") >= BASE_UNTIL)
    return quality.count_parity(silver, gold.where(~lost))


def null_pattern(spark, sf_dir):
    gold = materialize(indicators.gold_indicators(stored_silver(spark, sf_dir)), "gold")
    return quality.null_pattern(gold)


def table_profile(spark, sf_dir):
    return quality.table_profile(silver_of(feeds.trades(spark, sf_dir)))


def counts_by_source(spark, sf_dir):
    return quality.counts_by(feeds.trades(spark, sf_dir), "symbol", "source")


def topic_health(spark, sf_dir):
    checked = bronze.message_completeness(bronze.parse_envelope(feeds.envelope(spark, sf_dir)))
    return quality.feed_health(checked)


def arrival_lag(spark, sf_dir):
    rows = bronze.bronze_rows(bronze.parse_envelope(feeds.envelope(spark, sf_dir)))
    return quality.arrival_lag(rows)


def feed_percentiles(spark, sf_dir):
    """Percentiles of lag and rate from daily sketches, and whether each is within the stated error of its rank."""
    rows = stored_bronze(spark, sf_dir)
    report = None
    for measure, values in (("lag", quality.lag_values(rows)), ("rate", quality.rate_values(rows, "1 hour"))):
        found = quality.percentiles(materialize(quality.daily_sketches(values), f"{measure}-sketches"))
        checked = quality.rank_errors(values, found).select(
            F.lit(measure).alias("measure"), "topic", "rank", "n_values",
            (F.col("rank_error") <= quality.RANK_ERROR).alias("is_within"),
        )
        report = checked if report is None else report.unionByName(checked)
    return report


def first_sample(spark, sf_dir):
    checked = bronze.message_completeness(bronze.parse_envelope(feeds.envelope(spark, sf_dir)))
    samples = quality.first_samples(checked)
    return samples.select("*", F.from_json("raw_payload", TRADE_MESSAGE).alias("t")).select(
        "topic", "kafka_partition", "kafka_offset", "t.*"
    )


def window_range_check(spark, sf_dir):
    trades = feeds.trades_with_replays(spark, sf_dir)
    return quality.window_check(trades, "BTCUSDT", *[F.lit(t).cast("timestamp") for t in RANGE])


def latest_trades_topk(spark, sf_dir):
    columns = ("symbol", "source", "price", "quantity", "event_time", "trade_id")
    return quality.newest_rows(feeds.trades(spark, sf_dir), 10, columns, "event_time", "trade_id")


def schema_contract(spark, sf_dir):
    """Contracts of Silver, of Gold, and of a Gold that lost two columns."""
    silver = stored_silver(spark, sf_dir)
    gold = materialize(indicators.gold_indicators(silver), "gold")
    return quality.contract_report(
        {
            "silver": (silver, SILVER_REQUIRED),
            "gold": (gold, GOLD_REQUIRED),
            "gold_drifted": (gold.drop("vwap", "rsi"), GOLD_REQUIRED),
        }
    )


def reference_price_check(spark, sf_dir):
    snapshots = normalize.market_snapshot_rows(feeds.market_payloads(spark, sf_dir))
    minutes = candles.ohlcv(feeds.trades(spark, sf_dir), "15 minutes")
    return quality.reference_check(minutes, snapshots)


def reference_price_asof(spark, sf_dir):
    """Every third fetch of the hourly prices failed; the newest fetch of six hours at most stands in."""
    snapshots = normalize.market_snapshot_rows(feeds.market_payloads(spark, sf_dir))
    fetched = snapshots.where(F.hour("snapshot_hour") % 3 != 1)
    minutes = candles.ohlcv(feeds.trades(spark, sf_dir), "15 minutes")
    return quality.reference_check_asof(minutes, fetched, max_age="6 hours")


QUERIES: Sequence[Query] = (
    ohlcv_candles, ohlcv_by_source, brand_weekly_candles, brand_daily_indicators,
    candle_index, price_change_lag, previous_price, rolling_mean_std, rsi14, macd_sma, bollinger20, gold_indicators,
    ema_macd, ema_macd_gaps, volume_zscore,
    bronze_parse, bronze_quarantine, message_completeness, normalize_venue_a, normalize_venue_b, venue_b_rejects,
    venue_a_rejects, venue_a_strict, json_landing,
    venue_union, symbol_map, allowed_symbols, kafka_publish_rows, raw_replay, market_snapshot_rows,
    payload_drift, payload_readability, drift_replay, curve_lookup,
    global_metrics_rows,
    dedupe_trades, snapshot_upsert, global_metrics_upsert, roundtrip_overwrite, backfill_merge,
    stream_bronze, stream_quarantine, stream_ohlcv, stream_dedupe, stream_feed_health, stream_gold_refresh,
    stream_bronze_and_quarantine, gold_correct, stream_late_trades, stream_price_board, stream_state_health,
    gold_extend, stream_late_candles, stream_progress, late_data_audit,
    latest_per_symbol, last_non_null, price_board, signal_summary, signal_history, warmup_status, candle_direction,
    indicator_points, distinct_symbols, display_time,
    bronze_silver_recon, layer_count_parity, null_pattern, table_profile, counts_by_source, topic_health, arrival_lag,
    first_sample, window_range_check, latest_trades_topk, schema_contract, reference_price_check,
    recon_by_digests, reference_price_asof, feed_percentiles,
)


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        require_utc(spark)
        return comparable(query(spark, sf_dir))

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def registry() -> dict[str, Query]:
    return {query.__name__: _registered(query) for query in QUERIES}
