"""Contracts, reconciliation between layers, profiles and feed health. Reports are frames, nothing is printed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tickloom.functions.scalar import snapshot_hour, utc_date
from tickloom.operators.asof import asof_join
from tickloom.operators.dedupe import dedupe_batch, latest_by
from tickloom.operators.candles import ohlcv
from tickloom.operators.normalize import base_of_symbol
from tickloom.operators.indicators import candle_index
from tickloom.schemas import BOLLINGER_PERIOD, MACD_SIGNAL, MACD_SLOW, RSI_PERIOD

FIRST_VALUE_AT = {
    "rsi": RSI_PERIOD,
    "bb_middle": BOLLINGER_PERIOD,
    "macd_approx": MACD_SLOW,
    "signal_approx": MACD_SLOW + MACD_SIGNAL,
}


RECONCILED = ("open", "high", "low", "close", "volume", "trade_count")


class ContractError(ValueError):
    """A table lacks columns that its readers rely on."""


def missing_columns(df: DataFrame, required: Sequence[str], strict: bool = False) -> list[str]:
    """Required columns the frame lacks, sorted. Soft unless ``strict``."""
    missing = sorted(set(required) - set(df.columns))
    if missing and strict:
        raise ContractError(f"missing columns: {missing}")
    return missing


def schema_differences(df: DataFrame, expected: StructType) -> list[str]:
    """What a writer's frame has otherwise than its contract: columns missing, added, or of another type."""
    actual = {f.name: f.dataType for f in df.schema}
    wanted = {f.name: f.dataType for f in expected}
    found = [f"{name}: missing" for name in wanted if name not in actual]
    found += [f"{name}: not in the contract" for name in actual if name not in wanted]
    found += [
        f"{name}: {actual[name].simpleString()} instead of {dtype.simpleString()}"
        for name, dtype in wanted.items()
        if name in actual and actual[name] != dtype
    ]
    return sorted(found)


def contract_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per table: its missing columns, whether it holds to its contract, and its row count."""
    report = None
    for name, (df, required) in tables.items():
        missing = [F.lit(c) for c in missing_columns(df, required)]
        row = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            F.array(*missing).cast("array<string>").alias("missing"),
            F.lit(not missing).alias("is_valid"),
            "n_rows",
        )
        report = row if report is None else report.unionByName(row)
    return report


def in_time_range(df: DataFrame, column: str, start: Column, end: Column, date_partition: str | None = None):
    """Half-open range; with literal bounds it reaches the scan as a pushed filter.

    ``date_partition`` names a partition column with the date of ``column``: other dates are then not even listed.
    """
    ranged = df.where((F.col(column) >= start) & (F.col(column) < end))
    if date_partition is None:
        return ranged
    return ranged.where(F.col(date_partition).between(F.to_date(start), F.to_date(end)))


def window_check(trades: DataFrame, symbol: str, start, end) -> DataFrame:
    """Recompute one symbol's figures for one time range from raw trades, replays removed."""
    chosen = in_time_range(trades.where(F.col("symbol") == symbol), "event_time", start, end)
    return dedupe_batch(chosen.select("trade_id", "event_time", "price", "quantity")).agg(
        F.count("*").alias("trade_count"),
        F.sum("quantity").alias("volume"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
    )


def reconcile_candles(
    trades: DataFrame,
    silver: DataFrame,
    window: str,
    measures: Sequence[str] = RECONCILED,
    tolerance: float = 1e-9,
) -> DataFrame:
    """Candles rebuilt from raw trades against the recorded ones, all windows.

    One row per (symbol, window) of either side: where it is present, the measures of both, and those that differ by
    more than a relative ``tolerance``. Both sides arrive reduced to one row per key, so the join has no hot key.
    """
    rebuilt = ohlcv(dedupe_batch(trades.select("trade_id", "event_time", "symbol", "price", "quantity")), window)
    left = rebuilt.select(
        F.struct("symbol", "window_start").alias("k"), *[F.col(m).alias(f"bronze_{m}") for m in measures],
        F.lit(True).alias("_in_bronze"),
    )
    right = silver.select(
        F.struct("symbol", "window_start").alias("k"), *[F.col(m).alias(f"silver_{m}") for m in measures],
        F.lit(True).alias("_in_silver"),
    )
    both = left.join(right, "k", "full_outer")

    def differs(m: str) -> Column:
        a, b = F.col(f"bronze_{m}"), F.col(f"silver_{m}")
        close = F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
        return F.when(~(a.eqNullSafe(b) | F.coalesce(close, F.lit(False))), F.lit(m))

    status = (
        F.when(F.col("_in_silver").isNull(), "missing_in_silver")
        .when(F.col("_in_bronze").isNull(), "missing_in_bronze")
        .when(F.size("differences") > 0, "different")
        .otherwise("equal")
    )
    compared = both.withColumn("differences", F.array_compact(F.array(*[differs(m) for m in measures])))
    return compared.select(
        "k.symbol", "k.window_start", *[f"{side}_{m}" for m in measures for side in ("bronze", "silver")],
        F.array_join("differences", ",").alias("differences"), status.alias("status"),
    )


def count_parity(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows per symbol in both layers and whether they agree."""
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.struct("symbol").alias("k")).agg(F.count("*").alias(name))

    both = counts(silver, "silver_rows").join(counts(gold, "gold_rows"), "k", "full_outer")
    return both.select(
        "k.symbol",
        F.coalesce("silver_rows", F.lit(0)).alias("silver_rows"),
        F.coalesce("gold_rows", F.lit(0)).alias("gold_rows"),
        F.col("silver_rows").eqNullSafe(F.col("gold_rows")).alias("is_equal"),
    )


def null_pattern(gold: DataFrame, first_at: Mapping[str, int] = FIRST_VALUE_AT) -> DataFrame:
    """Per symbol and indicator the first candle with a value, the candle it should be, and nulls after it."""
    indexed = candle_index(gold.select("symbol", "window_start", "close", *first_at))
    aggregates = [F.max("candle_idx").alias("candles")]
    for name, need in first_at.items():
        has_value = F.col(name).isNotNull()
        aggregates.append(F.min(F.when(has_value, F.col("candle_idx"))).alias(f"{name}_first"))
        aggregates.append(F.count_if((F.col("candle_idx") >= need) & ~has_value).alias(f"{name}_nulls"))
    stats = indexed.groupBy("symbol").agg(*aggregates)
    per_indicator = F.array(
        *[
            F.struct(
                F.lit(name).alias("indicator"),
                F.lit(need).alias("expected_first"),
                F.col(f"{name}_first").alias("actual_first"),
                F.col(f"{name}_nulls").alias("mature_nulls"),
            )
            for name, need in first_at.items()
        ]
    )
    rows = stats.select("symbol", "candles", F.explode(per_indicator).alias("i")).select("symbol", "candles", "i.*")
    on_time = F.when(F.col("candles") < F.col("expected_first"), F.col("actual_first").isNull()).otherwise(
        F.col("actual_first").eqNullSafe(F.col("expected_first"))
    )
    return rows.withColumn("is_expected", on_time & (F.col("mature_nulls") == 0))


def table_profile(table: DataFrame, time_column: str = "window_start", key: str = "symbol") -> DataFrame:
    """Row count, first and last time per key and, on the row marked ``is_total``, of the whole table.

    The totals are summed from the per-key rows, so the table is read and shuffled once.
    """
    per_key = table.groupBy(key).agg(
        F.count("*").alias("n_rows"), F.min(time_column).alias("first_time"), F.max(time_column).alias("last_time")
    )
    totals = per_key.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
    )
    return per_key.withColumn("is_total", F.lit(False)).unionByName(
        totals.withColumn(key, F.lit(None).cast(table.schema[key].dataType)).withColumn("is_total", F.lit(True))
    )


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def newest_rows(df: DataFrame, k: int, columns: Sequence[str], time_column: str, tie_break: str) -> DataFrame:
    """The ``k`` newest rows; the tie-break column makes the choice unique."""
    return df.select(*columns).orderBy(F.col(time_column).desc(), F.col(tie_break).desc()).limit(k)


def feed_health(checked: DataFrame, window: str | None = None) -> DataFrame:
    """Messages, incomplete messages and message rates per topic, over all time or per arrival window.

    ``checked`` holds ``topic, kafka_timestamp, is_complete``. Works on streams when ``window`` is given.
    """
    keys = [F.col("topic")]
    if window:
        keys.append(F.window("kafka_timestamp", window).alias("window"))
    grouped = checked.groupBy(*keys).agg(
        F.count("*").alias("messages"),
        F.count_if(~F.col("is_complete")).alias("invalid"),
        F.min("kafka_timestamp").alias("first_seen"),
        F.max("kafka_timestamp").alias("last_seen"),
    )
    seconds = (F.unix_micros("last_seen") - F.unix_micros("first_seen")) / 1e6
    rate = F.when(seconds > 0, F.col("messages") / seconds)
    rated = grouped.withColumn("per_second", rate).withColumn("per_minute", F.col("per_second") * 60)
    if window:
        rated = rated.withColumn("window_start", F.col("window.start")).drop("window")
    return rated


def first_samples(checked: DataFrame) -> DataFrame:
    """The first complete message of each topic in broker order."""
    position = F.struct("kafka_partition", "kafka_offset")
    first = F.min(F.struct("kafka_partition", "kafka_offset", "raw_payload")).alias("s")
    return checked.where("is_complete").where(position.isNotNull()).groupBy("topic").agg(first).select(
        "topic", "s.kafka_partition", "s.kafka_offset", "s.raw_payload"
    )


def late_summary(fed: DataFrame, kept: DataFrame) -> DataFrame:
    """Per symbol the trades fed to a stream and those that it dropped as late: fed without copies, but not kept.

    Both sides arrive as one row per symbol, so the join has no hot key.
    """
    before = fed.groupBy("symbol").agg(F.count("*").alias("trades"))
    after = kept.groupBy("symbol").agg(F.count("*").alias("kept"))
    late = F.col("trades") - F.coalesce("kept", F.lit(0))
    return before.join(after, "symbol", "left").select("symbol", "trades", late.alias("late_trades"))


def arrival_lag(bronze: DataFrame) -> DataFrame:
    """Seconds from trade to broker per topic: mean, largest, and the number of trades stamped after their arrival."""
    lag = (F.unix_micros("kafka_timestamp") - F.unix_micros("event_time")) / 1e6
    return bronze.withColumn("lag", lag).groupBy("topic").agg(
        F.count("*").alias("messages"),
        F.avg("lag").alias("mean_lag_seconds"),
        F.max("lag").alias("max_lag_seconds"),
        F.count_if(F.col("lag") < 0).alias("from_the_future"),
    )


SKETCH_K = 800  # the rank of a quantile is off by less than RANK_ERROR in 99 of 100 cases
RANK_ERROR = 0.005


def lag_values(bronze: DataFrame) -> DataFrame:
    """topic, day of arrival and value, the seconds from trade to broker."""
    lag = (F.unix_micros("kafka_timestamp") - F.unix_micros("event_time")) / 1e6
    return bronze.select("topic", utc_date(F.col("kafka_timestamp")).alias("day"), lag.alias("value"))


def rate_values(bronze: DataFrame, span: str = "1 minute") -> DataFrame:
    """topic, day and value, the messages in each span of the day that has any."""
    begin = F.window("kafka_timestamp", span)["start"]
    counts = bronze.groupBy("topic", begin.alias("begin")).agg(F.count("*").cast("double").alias("value"))
    return counts.select("topic", utc_date(F.col("begin")).alias("day"), "value")


def daily_sketches(values: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """A quantile sketch per topic and day with the number of its values. Some kilobytes each, merged in the map tasks;
    kept in a table, they answer for any span of days without another look at the messages."""
    known = values.where("value IS NOT NULL")
    sketch = F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch")
    return known.groupBy("topic", "day").agg(sketch, F.count("*").alias("n_values"))


def percentiles(sketches: DataFrame, ranks: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """topic, rank, value and n_values over all days of ``sketches``, by merging them."""
    merged = sketches.groupBy("topic").agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n_values").alias("n_values")
    )
    asked = F.array(*[F.lit(float(r)) for r in ranks])
    pairs = F.arrays_zip(asked.alias("rank"), F.kll_sketch_get_quantile_double("sketch", asked).alias("value"))
    return merged.select("topic", "n_values", F.explode(pairs).alias("pair")).select(
        "topic", F.col("pair.rank").alias("rank"), F.col("pair.value").alias("value"), "n_values"
    )


def rank_errors(values: DataFrame, found: DataFrame) -> DataFrame:
    """How far the rank of each percentile of ``found`` lies from the one asked for, counted over all ``values``.

    One aggregate over the values: a value's rank is the span between the shares below it and up to it.
    """
    estimates = found.select("topic", "rank", F.col("value").alias("estimate"), "n_values")
    met = values.where("value IS NOT NULL").join(estimates, "topic")
    shares = met.groupBy("topic", "rank", "n_values").agg(
        (F.count_if(F.col("value") < F.col("estimate")) / F.count("*")).alias("below"),
        (F.count_if(F.col("value") <= F.col("estimate")) / F.count("*")).alias("up_to"),
    )
    error = F.greatest(F.col("below") - F.col("rank"), F.col("rank") - F.col("up_to"), F.lit(0.0))
    return shares.select("topic", "rank", "n_values", error.alias("rank_error"))


def reference_check(candles: DataFrame, snapshots: DataFrame, price: str = "close") -> DataFrame:
    """Candle price against the hourly reference price of its base symbol, in basis points; NULL without a reference.

    Of several fetches in an hour the last counts, so the join neither multiplies rows nor meets a hot key.
    """
    newest = latest_by(snapshots, ["symbol", "snapshot_hour"], "ingested_at")
    reference = newest.select(
        F.col("symbol").alias("base_symbol"), F.col("snapshot_hour"), F.col("current_price").alias("reference_price")
    )
    keyed = candles.withColumns(
        {"base_symbol": base_of_symbol(F.col("symbol")), "snapshot_hour": snapshot_hour(F.col("window_start"))}
    )
    joined = keyed.join(reference, ["base_symbol", "snapshot_hour"], "left")
    deviation = F.try_divide(F.col(price) - F.col("reference_price"), F.col("reference_price")) * 10_000
    return joined.select("symbol", "window_start", F.col(price).alias("price"), "reference_price",
                         deviation.alias("deviation_bps"))


def reference_check_asof(
    candles: DataFrame, snapshots: DataFrame, price: str = "close", max_age: str | None = None
) -> DataFrame:
    """Candle price against the newest reference price fetched up to the end of its window, in basis points.

    An hour whose fetch failed is bridged by the fetch before, whose age in seconds is told; NULL without one, or if it
    is older than ``max_age``.
    """
    reference = snapshots.select(
        F.col("symbol").alias("base_symbol"), "ingested_at", F.col("current_price").alias("reference_price")
    )
    keyed = candles.select("symbol", "window_start", "window_end", F.col(price).alias("price"),
                           base_of_symbol(F.col("symbol")).alias("base_symbol"))
    oldest = None if max_age is None else F.expr(f"INTERVAL {max_age}")
    joined = asof_join(keyed, reference, ["base_symbol"], "window_end", "ingested_at", ["reference_price", "ingested_at"], oldest)
    deviation = F.try_divide(F.col("price") - F.col("reference_price"), F.col("reference_price")) * 10_000
    age = (F.unix_micros("window_end") - F.unix_micros("ingested_at")) / 1e6
    return joined.select("symbol", "window_start", "price", "reference_price", age.alias("age_seconds"),
                         deviation.alias("deviation_bps"))
