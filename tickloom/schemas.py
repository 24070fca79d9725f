"""Record layouts, table contracts and the fixed values shared by all layers."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------------------------------------------
TRADE_FIELDS = ("symbol", "price", "quantity", "event_time", "trade_id", "source")

SYMBOLS = ("BTCUSDT", "ETHUSDT", "XRPUSDT", "ADAUSDT", "SOLUSDT")

VENUE_A = "binance"
VENUE_B = "kraken"

# venue pair -> (symbol, base symbol)
PAIR_SYMBOLS = {
    "BTC/USD": ("BTCUSDT", "BTC"),
    "ETH/USD": ("ETHUSDT", "ETH"),
    "XRP/USD": ("XRPUSDT", "XRP"),
    "ADA/USD": ("ADAUSDT", "ADA"),
    "SOL/USD": ("SOLUSDT", "SOL"),
    "XBT/USD": ("BTCUSDT", "BTC"),
    "BTC-USD": ("BTCUSDT", "BTC"),
}

TOPIC_PREFIX = "crypto-trades-"
DEAD_LETTER_TOPIC = "crypto-trades-dead-letter"

RSI_PERIOD = 14
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
BOLLINGER_PERIOD, BOLLINGER_WIDTH = 20, 2.0
WARMUP = {"rsi": RSI_PERIOD, "bollinger": BOLLINGER_PERIOD, "macd": MACD_SLOW + MACD_SIGNAL}

RSI_OVERBOUGHT, RSI_OVERSOLD = 70, 30
VWAP_BAND_BPS = 5

CANDLE_WINDOW = "1 minute"
WATERMARK = "2 minutes"
BRONZE_TRIGGER, SILVER_TRIGGER, CONSOLE_TRIGGER = "30 seconds", "50 seconds", "5 seconds"

# columns a reader of each table relies on
SILVER_REQUIRED = (
    "window_start", "symbol", "open", "high", "low", "close", "volume", "avg_price", "trade_count",
)
GOLD_REQUIRED = (
    "window_start", "symbol", "close", "rsi", "macd_approx", "signal_approx", "macd_histogram",
    "bb_upper", "bb_middle", "bb_lower", "vwap",
)
# -----------------------------------------------------------------------------------------------------------------

TRADE_TOPICS = tuple(TOPIC_PREFIX + s.lower() for s in SYMBOLS)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


TRADE_MESSAGE = _struct(
    symbol=T.StringType(),
    price=T.DoubleType(),
    quantity=T.DoubleType(),
    event_time=T.LongType(),
    trade_id=T.StringType(),
    source=T.StringType(),
)

KAFKA_ENVELOPE = _struct(
    key=T.BinaryType(),
    value=T.BinaryType(),
    topic=T.StringType(),
    partition=T.IntegerType(),
    offset=T.LongType(),
    timestamp=T.TimestampType(),
)

BRONZE = _struct(
    topic=T.StringType(),
    kafka_partition=T.IntegerType(),
    kafka_offset=T.LongType(),
    kafka_timestamp=T.TimestampType(),
    raw_payload=T.StringType(),
    symbol=T.StringType(),
    price=T.DoubleType(),
    quantity=T.DoubleType(),
    event_time=T.TimestampType(),
    event_time_ms=T.LongType(),
    trade_id=T.StringType(),
    source=T.StringType(),
    ingested_at=T.TimestampType(),
)

QUARANTINE = T.StructType(BRONZE.fields[:5] + [T.StructField("reasons", T.ArrayType(T.StringType()), True)])

SILVER = _struct(
    window_start=T.TimestampType(),
    window_end=T.TimestampType(),
    symbol=T.StringType(),
    open=T.DoubleType(),
    high=T.DoubleType(),
    low=T.DoubleType(),
    close=T.DoubleType(),
    volume=T.DoubleType(),
    trade_count=T.LongType(),
    avg_price=T.DoubleType(),
    vwap=T.DoubleType(),
)

GOLD = _struct(
    symbol=T.StringType(),
    window_start=T.TimestampType(),
    window_end=T.TimestampType(),
    open=T.DoubleType(),
    high=T.DoubleType(),
    low=T.DoubleType(),
    close=T.DoubleType(),
    volume=T.DoubleType(),
    trade_count=T.LongType(),
    avg_price=T.DoubleType(),
    vwap=T.DoubleType(),
    rsi=T.DoubleType(),
    ma12=T.DoubleType(),
    ma26=T.DoubleType(),
    macd_approx=T.DoubleType(),
    signal_approx=T.DoubleType(),
    macd_histogram=T.DoubleType(),
    bb_middle=T.DoubleType(),
    bb_upper=T.DoubleType(),
    bb_lower=T.DoubleType(),
)

MARKET_SNAPSHOT = _struct(
    snapshot_hour=T.TimestampType(),
    symbol=T.StringType(),
    name=T.StringType(),
    current_price=T.DoubleType(),
    market_cap=T.DoubleType(),
    market_cap_rank=T.LongType(),
    total_volume_24h=T.DoubleType(),
    price_change_24h_pct=T.DoubleType(),
    circulating_supply=T.DoubleType(),
    ingested_at=T.TimestampType(),
)

GLOBAL_METRICS = _struct(
    snapshot_hour=T.TimestampType(),
    total_market_cap_usd=T.DoubleType(),
    total_volume_24h_usd=T.DoubleType(),
    btc_dominance=T.DoubleType(),
    eth_dominance=T.DoubleType(),
    active_cryptocurrencies=T.LongType(),
    markets=T.LongType(),
    ingested_at=T.TimestampType(),
)

# Raw payloads as the venues and the snapshot service send them. Numbers that a venue sends as text stay text here.
# Keys of this venue differ only in case (t is an id, T a time), so they are read as a map, whose lookup is exact.
VENUE_A_MESSAGE = _struct(stream=T.StringType(), data=T.MapType(T.StringType(), T.StringType()))

VENUE_B_MESSAGE = _struct(
    channel=T.StringType(),
    type=T.StringType(),
    data=T.ArrayType(
        _struct(
            symbol=T.StringType(), side=T.StringType(), price=T.DoubleType(), qty=T.DoubleType(),
            ord_type=T.StringType(), trade_id=T.LongType(), timestamp=T.StringType(),
        )
    ),
)

MARKET_PAYLOAD = T.ArrayType(
    _struct(
        symbol=T.StringType(), name=T.StringType(), current_price=T.DoubleType(), market_cap=T.DoubleType(),
        market_cap_rank=T.LongType(), total_volume=T.DoubleType(), price_change_percentage_24h=T.DoubleType(),
        circulating_supply=T.DoubleType(),
    )
)

_BY_CURRENCY = T.MapType(T.StringType(), T.DoubleType())
GLOBAL_PAYLOAD = _struct(
    data=_struct(
        total_market_cap=_BY_CURRENCY, total_volume=_BY_CURRENCY, market_cap_percentage=_BY_CURRENCY,
        active_cryptocurrencies=T.LongType(), markets=T.LongType(),
    )
)
