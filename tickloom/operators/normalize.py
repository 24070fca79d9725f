"""Venue messages and snapshot payloads, from raw JSON text to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.scalar import millis_from_rfc3339, once, prefixed_trade_id, snapshot_hour, to_double, to_long
from tickloom.schemas import (
    GLOBAL_METRICS,
    GLOBAL_PAYLOAD,
    MARKET_PAYLOAD,
    MARKET_SNAPSHOT,
    PAIR_SYMBOLS,
    TRADE_FIELDS,
    VENUE_A,
    VENUE_A_MESSAGE,
    VENUE_B,
    VENUE_B_MESSAGE,
)


def symbol_dimension(spark: SparkSession) -> DataFrame:
    rows = [(pair, symbol, base) for pair, (symbol, base) in PAIR_SYMBOLS.items()]
    return spark.createDataFrame(rows, "venue_pair string, symbol string, base_symbol string")


def symbol_of_pair(pair: Column) -> Column:
    """The built-in pair table as a literal map, NULL for a pair outside it: no join and no shuffle."""
    entries = [F.lit(x) for name, (symbol, _) in PAIR_SYMBOLS.items() for x in (name, symbol)]
    return F.try_element_at(F.create_map(*entries), pair)


def base_of_symbol(symbol: Column) -> Column:
    bases = {sym: base for sym, base in PAIR_SYMBOLS.values()}
    return F.try_element_at(F.create_map(*[F.lit(x) for entry in bases.items() for x in entry]), symbol)


def venue_a_updates(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Trade messages with their fields as text, what the text says, and ``reasons``: the fields that it does not say.

    A field that is not there at all is NULL and no reason of its own; text that is no number, or no time, is one.
    """
    def field(key: str) -> Column:
        return F.try_element_at("d", F.lit(key))

    parsed = messages.select(once(F.from_json(payload, VENUE_A_MESSAGE)["data"]).alias("d"))
    texts = parsed.where(field("e") == "trade").select(
        field("s").alias("symbol"), field("p").alias("price_text"), field("q").alias("quantity_text"),
        field("T").alias("event_text"), prefixed_trade_id(F.lit(VENUE_A), field("t")).alias("trade_id"),
    )
    read = texts.withColumns({
        "price": to_double(F.col("price_text")), "quantity": to_double(F.col("quantity_text")),
        "event_time": to_long(F.col("event_text")), "source": F.lit(VENUE_A),
    })

    def unread(name: str, text: str) -> Column:
        return F.when(F.col(text).isNotNull() & F.col(name).isNull(), F.lit(f"invalid:{name}"))

    reasons = F.array(unread("price", "price_text"), unread("quantity", "quantity_text"), unread("event_time", "event_text"))
    return read.withColumn("reasons", F.array_compact(reasons))


def normalize_venue_a(messages: DataFrame, payload: str = "payload", strict: bool = False) -> DataFrame:
    """One trade per message. Prices, sizes and times arrive as text; text that is no number becomes NULL.

    With ``strict`` such trades are left to ``venue_a_rejects``.
    """
    updates = venue_a_updates(messages, payload)
    return (updates.where(F.size("reasons") == 0) if strict else updates).select(*TRADE_FIELDS)


def venue_a_rejects(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Trades of the first venue whose texts cannot all be read, as they came, with the reasons."""
    unread = venue_a_updates(messages, payload).where(F.size("reasons") > 0)
    return unread.select("trade_id", "symbol", "price_text", "quantity_text", "event_text", "reasons")


def venue_b_updates(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Update messages of the trade channel, one row per trade in their arrays."""
    parsed = messages.select(once(F.from_json(payload, VENUE_B_MESSAGE)).alias("m"))
    updates = parsed.where((F.col("m.channel") == "trade") & (F.col("m.type") == "update"))
    return updates.select(F.explode("m.data").alias("d")).select(
        F.col("d.symbol").alias("venue_pair"),
        F.col("d.price").alias("price"),
        F.col("d.qty").alias("quantity"),
        F.col("d.timestamp").alias("event_text"),
        millis_from_rfc3339(F.col("d.timestamp")).alias("event_time"),
        prefixed_trade_id(F.lit(VENUE_B), F.col("d.trade_id")).alias("trade_id"),
        F.lit(VENUE_B).alias("source"),
    )


def map_pairs(updates: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Give each update its canonical symbol; a pair outside the table is not followed and its rows go.

    ``dim`` replaces the built-in pairs with a table ``venue_pair, symbol`` of any size: a plain join, which adaptive
    execution broadcasts or splits by what it measures.
    """
    if dim is None:
        mapped = updates.withColumn("symbol", symbol_of_pair(F.col("venue_pair")))
        return mapped.where(F.col("symbol").isNotNull())
    return updates.join(dim.select("venue_pair", "symbol"), "venue_pair")


def normalize_venue_b(messages: DataFrame, payload: str = "payload", dim: DataFrame | None = None) -> DataFrame:
    """Trades of the second venue. A trade whose time cannot be read is left to ``venue_b_rejects``."""
    return map_pairs(venue_b_updates(messages, payload), dim).where(F.col("event_time").isNotNull()).select(
        *TRADE_FIELDS
    )


def venue_b_rejects(messages: DataFrame, payload: str = "payload", dim: DataFrame | None = None) -> DataFrame:
    """Trades set aside because their time cannot be read; no time is invented for them."""
    late = map_pairs(venue_b_updates(messages, payload), dim).where(F.col("event_time").isNull())
    return late.select("trade_id", "symbol", "event_text", F.lit("invalid:timestamp").alias("reason"))


def union_venues(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One feed from several normalised ones, matched by column name."""
    merged = first
    for other in others:
        merged = merged.unionByName(other)
    return merged


def market_snapshot_rows(payloads: DataFrame, payload: str = "payload", fetched_at: str = "fetched_at") -> DataFrame:
    """Market payload (a JSON array of coins) to one row per coin, keyed by the hour of its fetch."""
    coins = payloads.select(F.col(fetched_at).alias("at"), F.explode(F.from_json(payload, MARKET_PAYLOAD)).alias("c"))
    rows = coins.select(
        snapshot_hour(F.col("at")).alias("snapshot_hour"),
        F.upper("c.symbol").alias("symbol"),
        F.col("c.name").alias("name"),
        F.col("c.current_price").alias("current_price"),
        F.col("c.market_cap").alias("market_cap"),
        F.col("c.market_cap_rank").alias("market_cap_rank"),
        F.col("c.total_volume").alias("total_volume_24h"),
        F.col("c.price_change_percentage_24h").alias("price_change_24h_pct"),
        F.col("c.circulating_supply").alias("circulating_supply"),
        F.col("at").alias("ingested_at"),
    )
    return rows.select(*MARKET_SNAPSHOT.fieldNames())


def global_metrics_rows(payloads: DataFrame, payload: str = "payload", fetched_at: str = "fetched_at") -> DataFrame:
    """Global payload (one JSON object) to one row keyed by the hour of its fetch; without data it gives none."""
    data = F.from_json(payload, GLOBAL_PAYLOAD)["data"]
    parsed = payloads.select(F.col(fetched_at).alias("at"), once(data).alias("d"))
    rows = parsed.where(F.col("d").isNotNull()).select(
        snapshot_hour(F.col("at")).alias("snapshot_hour"),
        F.try_element_at("d.total_market_cap", F.lit("usd")).alias("total_market_cap_usd"),
        F.try_element_at("d.total_volume", F.lit("usd")).alias("total_volume_24h_usd"),
        F.try_element_at("d.market_cap_percentage", F.lit("btc")).alias("btc_dominance"),
        F.try_element_at("d.market_cap_percentage", F.lit("eth")).alias("eth_dominance"),
        F.col("d.active_cryptocurrencies").alias("active_cryptocurrencies"),
        F.col("d.markets").alias("markets"),
        F.col("at").alias("ingested_at"),
    )
    return rows.select(*GLOBAL_METRICS.fieldNames())
