"""Feeds derived from the given tables: trades, venue messages, broker envelopes and snapshot payloads.

``events`` plays the trade feed. Its five event types stand for five symbols, even users trade on the first venue and
odd users on the second. Some users' connections misbehave in a fixed way, which gives each fault its share of rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.scalar import once, topic_of
from tickloom.schemas import VENUE_A, VENUE_B

EVENT_SYMBOLS = {
    "click": "BTCUSDT",
    "view": "ETHUSDT",
    "purchase": "XRPUSDT",
    "signup": "ADAUSDT",
    "error": "SOLUSDT",
}

# users whose messages carry a fault
MALFORMED_USER, NO_PRICE_USER, TEXT_PRICE_USER, NO_ID_USER, EMPTY_USER = 3, 5, 7, 9, 11
SNAPSHOT_USER, UNKNOWN_PAIR_USER, BAD_TIME_USER, OTHER_KIND_USER = 1, 13, 15, 2
LATE_USER, REPLAY_USER = 4, 6
WORD_PRICE_USER, EMPTY_SIZE_USER, WORD_TIME_USER = 8, 10, 12

# days on which the fields of the feed change
FEE_FROM, NOTE_FROM, NOTE_TEXT_FROM, NOTE_UNTIL, TEXT_PRICE_FROM, NO_SOURCE_FROM = (
    "2024-01-10", "2024-01-12", "2024-01-13", "2024-01-14", "2024-01-15", "2024-01-20"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _symbol(event_type: Column) -> Column:
    entries = [F.lit(x) for pair in EVENT_SYMBOLS.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), event_type)


def with_trade_columns(events: DataFrame) -> DataFrame:
    """Events plus the trade columns; works on the table and on a stream of its file."""
    source = F.when(F.col("user_id") % 2 == 0, VENUE_A).otherwise(VENUE_B)
    return events.select(
        "event_id", "user_id",
        _symbol(F.col("event_type")).alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.concat(source, F.lit(":"), F.col("event_id").cast("string")).alias("trade_id"),
        source.alias("source"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("symbol", "price", "quantity", "event_time", "trade_id", "source")
    return with_trade_columns(table(spark, sf_dir, "events")).select(*columns)


def trades_with_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades where reconnecting users' messages come twice, the copy a second later with another price."""
    return replayed(with_trade_columns(table(spark, sf_dir, "events"))).select(
        "symbol",
        (F.col("price") + F.col("copy")).alias("price"),
        "quantity",
        F.timestamp_micros(F.unix_micros("event_time") + F.col("copy") * 1_000_000).alias("event_time"),
        "trade_id",
        "source",
    )


def replayed(rows: DataFrame) -> DataFrame:
    """Trade rows plus a copy of each row of the reconnecting users, told apart by ``copy``."""
    copies = F.when(F.col("user_id") <= REPLAY_USER, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies))


def envelope_of(rows: DataFrame) -> DataFrame:
    """Broker rows for trade rows. User-bound faults: cut text, missing or quoted price, missing id, empty value."""
    user = F.col("user_id")
    ms = F.unix_millis("event_time")
    price_free = F.struct("symbol", "quantity", ms.alias("event_time"), "trade_id", "source")
    quoted = F.struct(
        "symbol", F.col("price").cast("string").alias("price"), "quantity", ms.alias("event_time"), "trade_id", "source"
    )
    id_free = F.struct("symbol", "price", "quantity", ms.alias("event_time"), "source")
    full = F.struct("symbol", "price", "quantity", ms.alias("event_time"), "trade_id", "source")
    text = F.to_json(full)
    value = (
        F.when(user == MALFORMED_USER, F.substring(text, F.lit(1), F.length(text) - 5))
        .when(user == NO_PRICE_USER, F.to_json(price_free))
        .when(user == TEXT_PRICE_USER, F.to_json(quoted))
        .when(user == NO_ID_USER, F.to_json(id_free))
        .when(user == EMPTY_USER, F.lit(None).cast("string"))
        .otherwise(text)
    )
    delay_micros = F.when(user == LATE_USER, F.lit(3 * 3600 * 1_000_000)).otherwise(F.lit(250_000))
    return rows.select(
        F.col("symbol").cast("binary").alias("key"),
        once(value.cast("binary")).alias("value"),
        topic_of(F.col("symbol")).alias("topic"),
        (user % 6).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_micros(F.unix_micros("event_time") + delay_micros).alias("timestamp"),
    )


def drifting_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose fields change by date, beside broken and empty ones.

    A fee is added, a nested note comes, has its number turned into text and goes, prices of the second venue become
    text, and one topic loses its source.
    """
    rows = with_trade_columns(table(spark, sf_dir, "events"))
    time, user = F.col("event_time"), F.col("user_id")
    price_is_text = (time >= TEXT_PRICE_FROM) & (F.col("source") == VENUE_B)
    price = F.when(price_is_text, F.col("price").cast("string").cast("variant")).otherwise(F.col("price").cast("variant"))
    by = F.when(time >= NOTE_TEXT_FROM, user.cast("string").cast("variant")).otherwise(user.cast("long").cast("variant"))
    noted = (time >= NOTE_FROM) & (time < NOTE_UNTIL)
    no_source = (time >= NO_SOURCE_FROM) & (F.col("symbol") == "ETHUSDT")
    text = F.to_json(F.struct(
        "symbol", price.alias("price"), "quantity", F.unix_millis("event_time").alias("event_time"), "trade_id",
        F.when(~no_source, F.col("source")).alias("source"),
        F.when(time >= FEE_FROM, user / 100).alias("fee"),
        F.when(noted, F.struct(by.alias("by"))).alias("note"),
    ))
    payload = (
        F.when(user == MALFORMED_USER, F.substring(text, F.lit(1), F.length(text) - 5))
        .when(user == EMPTY_USER, F.lit(None).cast("string"))
        .otherwise(text)
    )
    return rows.select(
        topic_of(F.col("symbol")).alias("topic"), time.alias("kafka_timestamp"), once(payload).alias("raw_payload")
    )


LANDING_FILES = 4  # of each arrival at least, so that a trigger of as many files takes just one
FILE_ROWS = 1_000_000  # of the largest arrival in a file; all arrivals have as many files


def week_of(time: Column) -> Column:
    """Arrival of a trade: the week of the month, from 0."""
    return F.floor((F.dayofmonth(time.cast("timestamp_ntz")) - 1) / 7).cast("int")


def is_late() -> Column:
    """Trades that a feed may deliver long after their time."""
    return (F.col("user_id") == LATE_USER) & (week_of(F.col("event_time")) == 0)


def land(rows: DataFrame, arrival: Column, path: str) -> int:
    """Write a feed as it arrives, one append per arrival in order: a stream of the folder takes them one by one.

    Every arrival has the same number of files, which is returned and grows with the largest one, and the files of one
    are older than those of the next.
    """
    arrived = rows.withColumn("_arrival", arrival).persist(StorageLevel.DISK_ONLY)  # the feed is read once
    try:
        sizes = sorted(tuple(row) for row in arrived.groupBy("_arrival").count().collect())  # a handful
        files = max([LANDING_FILES, *(-(-size // FILE_ROWS) for _, size in sizes)])
        for number, _ in sizes:
            part = arrived.where(F.col("_arrival") == number).drop("_arrival")
            part.repartition(files).write.mode("append").parquet(path)
        return files
    finally:
        arrived.unpersist()


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope_of(with_trade_columns(table(spark, sf_dir, "events")))


def venue_a_messages(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """First venue: one trade per message with text numbers; one user's messages are of another kind.

    With ``faults`` three users' messages have a word as price, an empty size, or a word as time.
    """
    rows = with_trade_columns(table(spark, sf_dir, "events")).where(F.col("source") == VENUE_A)
    kind = F.when(F.col("user_id") == OTHER_KIND_USER, "aggTrade").otherwise("trade")
    ms, price, size = F.unix_millis("event_time"), F.col("price").cast("string"), F.col("quantity").cast("string")
    time = ms.cast("string") if faults else ms
    if faults:
        user = F.col("user_id")
        price = F.when(user == WORD_PRICE_USER, F.lit("n/a")).otherwise(price)
        size = F.when(user == EMPTY_SIZE_USER, F.lit("")).otherwise(size)
        time = F.when(user == WORD_TIME_USER, F.lit("soon")).otherwise(time)
    data = F.struct(
        kind.alias("e"), ms.alias("E"), F.col("symbol").alias("s"), F.col("event_id").alias("t"),
        price.alias("p"), size.alias("q"), time.alias("T"),
    )
    stream = F.concat(F.lower("symbol"), F.lit("@trade"))
    return rows.select(once(F.to_json(F.struct(stream.alias("stream"), data.alias("data")))).alias("payload"))


def venue_b_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second venue: its trades among eight consecutive events share a message, so an array holds at most eight.

    Faults: a user whose messages are snapshots, one with a pair outside the table, one with unreadable times.
    """
    rows = with_trade_columns(table(spark, sf_dir, "events")).where(F.col("source") == VENUE_B)
    user = F.col("user_id")
    base = F.regexp_extract("symbol", "^(.*)USDT$", 1)
    pair = (
        F.when(user == UNKNOWN_PAIR_USER, F.concat(base, F.lit("/EUR")))
        .when((base == "BTC") & (user % 3 == 0), F.lit("XBT/USD"))
        .when((base == "BTC") & (user % 3 == 1), F.lit("BTC-USD"))
        .otherwise(F.concat(base, F.lit("/USD")))
    )
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    trade = F.struct(
        pair.alias("symbol"), F.lit("buy").alias("side"), "price", F.col("quantity").alias("qty"),
        F.lit("market").alias("ord_type"), F.col("event_id").alias("trade_id"),
        F.when(user == BAD_TIME_USER, F.lit("yesterday")).otherwise(iso).alias("timestamp"),
    )
    kind = F.when(user == SNAPSHOT_USER, "snapshot").otherwise("update")
    pack = F.floor(F.col("event_id") / 8)
    messages = rows.groupBy(pack.alias("pack"), kind.alias("type")).agg(F.collect_list(trade).alias("data"))
    message = F.struct(F.lit("trade").alias("channel"), "type", "data")
    return messages.select(once(F.to_json(message)).alias("payload"))


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.date_trunc("hour", "event_time")
    return trades(spark, sf_dir).groupBy(hour.alias("hour"), "symbol").agg(
        F.max(F.struct("event_time", "price"))["price"].alias("last_price"),
        F.sum("quantity").alias("quantity"),
        F.sum(F.col("price") * F.col("quantity")).alias("notional"),
        F.count("*").alias("n"),
    )


def _fetch_time(hour: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(hour) + 17 * 60 * 1_000_000)


def market_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One market payload per hour: a JSON array with a coin per symbol traded in it."""
    base = F.lower(F.regexp_extract("symbol", "^(.*)USDT$", 1))
    coin = F.struct(
        base.alias("symbol"), F.initcap(base).alias("name"), F.col("last_price").alias("current_price"),
        F.col("notional").alias("market_cap"), F.col("n").alias("market_cap_rank"),
        F.col("quantity").alias("total_volume"), F.lit(None).cast("double").alias("price_change_percentage_24h"),
        F.col("n").cast("double").alias("circulating_supply"),
    )
    per_hour = _hourly(spark, sf_dir).groupBy("hour").agg(F.collect_list(coin).alias("coins"))
    return per_hour.select(_fetch_time(F.col("hour")).alias("fetched_at"), F.to_json("coins").alias("payload"))


def global_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One global payload per hour with nested objects keyed by currency; shares are of the traded value."""
    def share(symbol: str) -> Column:
        of_symbol = F.sum(F.when(F.col("symbol") == symbol, F.col("notional")))
        return F.try_divide(of_symbol * 100, F.sum("notional"))

    per_hour = _hourly(spark, sf_dir).groupBy("hour").agg(
        F.sum("notional").alias("cap"), F.sum("quantity").alias("volume"),
        share("BTCUSDT").alias("btc"), share("ETHUSDT").alias("eth"),
        F.count("*").alias("symbols"), F.sum("n").alias("n"),
    )
    data = F.struct(
        F.struct(F.col("cap").alias("usd")).alias("total_market_cap"),
        F.struct(F.col("volume").alias("usd")).alias("total_volume"),
        F.struct("btc", "eth").alias("market_cap_percentage"),
        F.col("symbols").alias("active_cryptocurrencies"), F.col("n").alias("markets"),
    )
    payload = F.to_json(F.struct(data.alias("data")))
    return per_hour.select(_fetch_time(F.col("hour")).alias("fetched_at"), payload.alias("payload"))


def brand_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger feed: order lines as trades of their part's brand, stamped with the shipping day.

    Parts are joined to lines by key with no hint; adaptive execution broadcasts them while they are small.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("symbol"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
    )
