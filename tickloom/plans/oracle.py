"""Independent SQL for the registered queries, run by another engine on the same tables.

The statements start from the given tables and state the expected result directly: they do not retrace how the Spark
side gets there (no JSON, no envelopes, no chunks, no streams). Doubles are rounded like the compared results: to six
decimals after adding a billionth, so that exact halves round the same way whatever the order of summation.
"""

from __future__ import annotations


def _r(*names: str, table: str = "") -> str:
    prefix = f"{table}." if table else ""
    return ", ".join(f"round({prefix}{n} + 1e-9, 6) + 0.0 AS {n}" for n in names)


TRADES = """
t0 AS (
  SELECT event_id, user_id,
         CASE event_type WHEN 'click' THEN 'BTCUSDT' WHEN 'view' THEN 'ETHUSDT' WHEN 'purchase' THEN 'XRPUSDT'
                         WHEN 'signup' THEN 'ADAUSDT' WHEN 'error' THEN 'SOLUSDT' END AS symbol,
         value AS price,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS quantity,
         ts AS event_time,
         CAST(epoch_us(ts) // 1000 AS BIGINT) AS event_ms,
         CASE WHEN user_id % 2 = 0 THEN 'binance' ELSE 'kraken' END AS source
  FROM events),
trades AS (SELECT *, source || ':' || CAST(event_id AS VARCHAR) AS trade_id FROM t0)"""


def _candles(source: str, width: str, name: str, keys: str = "symbol") -> str:
    bucket = f"time_bucket(INTERVAL {width}, event_time, TIMESTAMP '1970-01-01')"
    return f"""
{name} AS (
  SELECT {bucket} AS window_start, {bucket} + INTERVAL {width} AS window_end, {keys},
         min(struct_pack(t := event_time, p := price)).p AS open,
         max(price) AS high, min(price) AS low,
         max(struct_pack(t := event_time, p := price)).p AS close,
         sum(quantity) AS volume, count(*) AS trade_count, avg(price) AS avg_price,
         CASE WHEN sum(quantity) > 0 THEN sum(price * quantity) / sum(quantity) END AS vwap
  FROM {source} GROUP BY {bucket}, {keys})"""


HOURLY = TRADES + "," + _candles("trades", "1 HOUR", "candles")
CANDLE_COLUMNS = "window_start, window_end, symbol, trade_count, " + _r(
    "open", "high", "low", "close", "volume", "avg_price", "vwap"
)


def _gold(source: str = "candles") -> str:
    return f"""
g1 AS (
  SELECT *, count(close) OVER w AS candle_idx, row_number() OVER w AS row_idx,
         lag(close) OVER w AS prev_close, close - lag(close) OVER w AS change
  FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY window_start)),
g2 AS (
  SELECT *, CASE WHEN change > 0 THEN change ELSE 0.0 END AS gain,
         CASE WHEN change < 0 THEN -change ELSE 0.0 END AS loss FROM g1),
g3 AS (
  SELECT *,
    avg(gain) OVER (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS avg_gain,
    avg(loss) OVER (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS avg_loss,
    avg(close) OVER (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ma12,
    avg(close) OVER (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 25 PRECEDING AND CURRENT ROW) AS ma26,
    avg(close) OVER (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS mean20,
    stddev_pop(close) OVER (PARTITION BY symbol ORDER BY window_start
                            ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS bb_std
  FROM g2),
g4 AS (
  SELECT *,
    CASE WHEN candle_idx >= 14 THEN
      CASE WHEN avg_loss = 0 THEN 100.0 ELSE 100 - 100 / (1 + avg_gain / avg_loss) END END AS rsi,
    CASE WHEN candle_idx >= 26 THEN ma12 - ma26 END AS macd_approx,
    CASE WHEN candle_idx >= 20 THEN mean20 END AS bb_middle,
    CASE WHEN candle_idx >= 20 THEN mean20 + 2 * bb_std END AS bb_upper,
    CASE WHEN candle_idx >= 20 THEN mean20 - 2 * bb_std END AS bb_lower
  FROM g3),
g5 AS (
  SELECT *, CASE WHEN candle_idx >= 35 THEN
    avg(macd_approx) OVER (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 8 PRECEDING AND CURRENT ROW)
    END AS signal_approx FROM g4),
gold AS (SELECT *, macd_approx - signal_approx AS macd_histogram FROM g5)"""


GOLD = HOURLY + "," + _gold()
GOLD_COLUMNS = "symbol, window_start, window_end, trade_count, " + _r(
    "open", "high", "low", "close", "volume", "avg_price", "vwap", "rsi", "ma12", "ma26", "macd_approx",
    "signal_approx", "macd_histogram", "bb_middle", "bb_upper", "bb_lower",
)

# messages as the broker holds them: what each fault leaves of a trade
ENVELOPE = TRADES + """,
envelope AS (
  SELECT 'crypto-trades-' || lower(symbol) AS topic, CAST(user_id % 6 AS INTEGER) AS kafka_partition,
         event_id AS kafka_offset,
         event_time + CASE WHEN user_id = 4 THEN INTERVAL 3 HOUR ELSE INTERVAL 250 MILLISECOND END AS kafka_timestamp,
         symbol, CASE WHEN user_id IN (5, 7) THEN NULL ELSE price END AS price, quantity,
         make_timestamp(event_ms * 1000) AS event_time, event_ms AS event_time_ms,
         CASE WHEN user_id IN (3, 9, 11) THEN NULL ELSE trade_id END AS trade_id, source,
         CASE user_id WHEN 3 THEN 'malformed_json' WHEN 5 THEN 'missing:price' WHEN 7 THEN 'invalid:price'
                      WHEN 9 THEN 'missing:trade_id' WHEN 11 THEN 'empty_payload' ELSE '' END AS reasons
  FROM trades),
bronze AS (SELECT * EXCLUDE (reasons) FROM envelope WHERE trade_id IS NOT NULL)"""
BRONZE_COLUMNS = (
    f"topic, kafka_partition, kafka_offset, kafka_timestamp, symbol, {_r('price', 'quantity')}, event_time, "
    "event_time_ms, trade_id, source"
)
QUARANTINE = f"""WITH {ENVELOPE}
SELECT topic, kafka_partition, kafka_offset, kafka_timestamp, reasons FROM envelope WHERE trade_id IS NULL"""

# what each readable message of the drifting feed holds
DRIFT = TRADES + """,
d0 AS (
  SELECT 'crypto-trades-' || lower(symbol) AS topic, CAST(event_time AS DATE) AS day, user_id, symbol, price, quantity,
         event_time, event_ms, trade_id, source, user_id IN (3, 11) AS broken,
         event_time >= TIMESTAMP '2024-01-15' AND source = 'kraken' AS price_is_text,
         event_time >= TIMESTAMP '2024-01-20' AND symbol = 'ETHUSDT' AS no_source FROM trades),
d1 AS (
  SELECT topic, day, unnest([
    {'f': 'symbol', 't': CASE WHEN symbol IS NOT NULL THEN 'STRING' END},
    {'f': 'price', 't': CASE WHEN price IS NULL THEN NULL WHEN price_is_text THEN 'STRING' ELSE 'NUMBER' END},
    {'f': 'quantity', 't': CASE WHEN quantity IS NOT NULL THEN 'NUMBER' END},
    {'f': 'event_time', 't': CASE WHEN event_ms IS NOT NULL THEN 'NUMBER' END},
    {'f': 'trade_id', 't': CASE WHEN trade_id IS NOT NULL THEN 'STRING' END},
    {'f': 'source', 't': CASE WHEN NOT no_source THEN 'STRING' END},
    {'f': 'fee', 't': CASE WHEN day >= DATE '2024-01-10' THEN 'NUMBER' END},
    {'f': 'note', 't': CASE WHEN day = DATE '2024-01-12' THEN 'OBJECT<by: NUMBER>'
                            WHEN day = DATE '2024-01-13' THEN 'OBJECT<by: STRING>' END}]) AS e
  FROM d0 WHERE NOT broken),
d2 AS (
  SELECT topic, day, e.f AS field, string_agg(DISTINCT e.t, '|' ORDER BY e.t) AS types, count(*) AS messages
  FROM d1 WHERE e.t IS NOT NULL GROUP BY topic, day, e.f),
d3 AS (
  SELECT topic, day, lag(day) OVER (PARTITION BY topic ORDER BY day) AS day_before
  FROM (SELECT DISTINCT topic, day FROM d0 WHERE NOT broken)),
d4 AS (
  SELECT d3.topic, d3.day, b.field, b.types FROM d3 JOIN d2 b ON b.topic = d3.topic AND b.day = d3.day_before),
d5 AS (SELECT d2.* FROM d2 JOIN d3 USING (topic, day) WHERE day_before IS NOT NULL)"""

MESSAGE_COLUMNS = (
    f"symbol, {_r('price', 'quantity')}, event_ms AS event_time, trade_id, source"
)
VENUE_A_ROWS = f"SELECT {MESSAGE_COLUMNS} FROM trades WHERE source = 'binance' AND user_id <> 2"
VENUE_B_ROWS = f"SELECT {MESSAGE_COLUMNS} FROM trades WHERE source = 'kraken' AND user_id NOT IN (1, 13, 15)"

HOUR_FACTS = TRADES + """,
per_symbol AS (
  SELECT date_trunc('hour', event_time) AS snapshot_hour, replace(symbol, 'USDT', '') AS symbol,
         max(struct_pack(t := event_time, p := price)).p AS last_price, sum(quantity) AS quantity,
         sum(price * quantity) AS notional, count(*) AS n
  FROM trades GROUP BY 1, 2),
snapshots AS (
  SELECT CAST(snapshot_hour AS TIMESTAMP) AS snapshot_hour, symbol,
         substr(symbol, 1, 1) || lower(substr(symbol, 2)) AS name, last_price AS current_price,
         round(notional + 1e-9, 6) + 0.0 AS market_cap, n AS market_cap_rank, quantity AS total_volume_24h,
         CAST(NULL AS DOUBLE) AS price_change_24h_pct, CAST(n AS DOUBLE) AS circulating_supply,
         CAST(snapshot_hour AS TIMESTAMP) + INTERVAL 17 MINUTE AS ingested_at
  FROM per_symbol),
metrics AS (
  SELECT CAST(snapshot_hour AS TIMESTAMP) AS snapshot_hour,
         round(sum(notional) + 1e-9, 6) + 0.0 AS total_market_cap_usd,
         sum(quantity) AS total_volume_24h_usd,
         round((CASE WHEN sum(notional) <> 0
                     THEN sum(notional) FILTER (WHERE symbol = 'BTC') * 100 / sum(notional) END) + 1e-9, 6) + 0.0
           AS btc_dominance,
         round((CASE WHEN sum(notional) <> 0
                     THEN sum(notional) FILTER (WHERE symbol = 'ETH') * 100 / sum(notional) END) + 1e-9, 6) + 0.0
           AS eth_dominance,
         count(*) AS active_cryptocurrencies, CAST(sum(n) AS BIGINT) AS markets,
         CAST(snapshot_hour AS TIMESTAMP) + INTERVAL 17 MINUTE AS ingested_at
  FROM per_symbol GROUP BY snapshot_hour)"""

# candles that a drained stream has emitted: their window closed before the newest event less the allowed delay
CLOSED = "window_end <= (SELECT max(event_time) FROM trades) - INTERVAL 2 MINUTE"

# trades of the first week that a feed delivers in the fourth
LATE = "user_id = 4 AND day(event_time) <= 7"

NEWEST = HOURLY + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS recency FROM candles)"""


def _ema(close: str = "close") -> str:
    """The recursion written out; a missing close keeps what there is, and the first close seeds both averages."""
    return f"""WITH RECURSIVE {HOURLY},
shown AS (SELECT symbol, window_start, {close} AS close FROM candles),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start) AS rn FROM shown),
walk AS (
  SELECT symbol, rn, window_start, close, close AS f, close AS s,
         CASE WHEN close IS NOT NULL THEN 0.0::DOUBLE END AS sig FROM numbered WHERE rn = 1
  UNION ALL
  SELECT symbol, rn, window_start, close, f, s,
         CASE WHEN close IS NULL THEN sig WHEN sig IS NULL THEN 0.0 ELSE 0.2 * (f - s) + 0.8 * sig END AS sig
  FROM (SELECT n.symbol, n.rn, n.window_start, n.close, w.sig,
               CASE WHEN n.close IS NULL THEN w.f ELSE coalesce(2.0 / 13 * n.close + 11.0 / 13 * w.f, n.close) END AS f,
               CASE WHEN n.close IS NULL THEN w.s ELSE coalesce(2.0 / 27 * n.close + 25.0 / 27 * w.s, n.close) END AS s
        FROM walk w JOIN numbered n ON n.symbol = w.symbol AND n.rn = w.rn + 1))
SELECT symbol, window_start, round(close + 1e-9, 6) + 0.0 AS close, round(f + 1e-9, 6) + 0.0 AS ema_fast,
       round(s + 1e-9, 6) + 0.0 AS ema_slow, round((f - s) + 1e-9, 6) + 0.0 AS ema_macd,
       round(sig + 1e-9, 6) + 0.0 AS ema_signal,
       round((f - s - sig) + 1e-9, 6) + 0.0 AS ema_histogram
FROM walk"""


BRANDS = """
brand_trades AS (
  SELECT p_brand AS symbol, l_extendedprice AS price, l_quantity AS quantity, l_shipdate AS event_time
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

RECON_MEASURES = ("open", "high", "low", "close", "volume", "trade_count")


def _recon() -> str:
    sides = ", ".join(
        f"b.{m} AS bronze_{m}, s.{m} AS silver_{m}" if m == "trade_count"
        else f"round(b.{m} + 1e-9, 6) + 0.0 AS bronze_{m}, round(s.{m} + 1e-9, 6) + 0.0 AS silver_{m}"
        for m in RECON_MEASURES
    )
    differs = ", ".join(
        f"CASE WHEN (b.{m} IS NULL) <> (s.{m} IS NULL) OR abs(b.{m} - s.{m}) > 1e-9 * greatest(abs(b.{m}), 1) "
        f"THEN '{m}' END"
        for m in RECON_MEASURES
    )
    kept = "kept AS (SELECT * FROM trades WHERE NOT (source = 'kraken' AND event_time >= TIMESTAMP '2024-01-30'))"
    return f"""WITH {HOURLY}, {kept}, {_candles("kept", "1 HOUR", "silver")}
SELECT coalesce(b.symbol, s.symbol) AS symbol, coalesce(b.window_start, s.window_start) AS window_start, {sides},
       concat_ws(',', {differs}) AS differences,
       CASE WHEN s.symbol IS NULL THEN 'missing_in_silver' WHEN b.symbol IS NULL THEN 'missing_in_bronze'
            WHEN concat_ws(',', {differs}) <> '' THEN 'different' ELSE 'equal' END AS status
FROM candles b FULL JOIN silver s ON b.symbol = s.symbol AND b.window_start = s.window_start"""


CLASSES = """
CASE WHEN rsi IS NULL THEN '—' WHEN rsi >= 70 THEN 'Overbought' WHEN rsi <= 30 THEN 'Oversold' ELSE 'Neutral' END
  AS rsi_zone,
CASE WHEN macd_approx > signal_approx THEN 'Bullish' WHEN macd_approx <= signal_approx THEN 'Bearish' END
  AS macd_direction,
CASE WHEN close > bb_upper THEN 'Above' WHEN close < bb_lower THEN 'Below' WHEN bb_upper IS NOT NULL THEN 'Inside' END
  AS bollinger_position,
round((CASE WHEN vwap <> 0 THEN (close - vwap) / vwap * 10000 END) + 1e-9, 6) + 0.0 AS vwap_bps,
CASE WHEN vwap = 0 OR vwap IS NULL THEN NULL WHEN (close - vwap) / vwap * 10000 > 5 THEN 'Above'
     WHEN (close - vwap) / vwap * 10000 < -5 THEN 'Below' ELSE 'At' END AS vwap_position"""

# the first indicator values and nulls after them, one row per symbol and indicator
_INDICATORS = {"rsi": 14, "bb_middle": 20, "macd_approx": 26, "signal_approx": 35}
NULL_PATTERN = f"WITH {GOLD}\n" + "\nUNION ALL\n".join(
    f"""SELECT symbol, max(candle_idx) AS candles, '{name}' AS indicator, {need} AS expected_first,
       min(candle_idx) FILTER (WHERE {name} IS NOT NULL) AS actual_first,
       count(*) FILTER (WHERE candle_idx >= {need} AND {name} IS NULL) AS mature_nulls,
       CASE WHEN max(candle_idx) < {need} THEN min(candle_idx) FILTER (WHERE {name} IS NOT NULL) IS NULL
            ELSE coalesce(min(candle_idx) FILTER (WHERE {name} IS NOT NULL) = {need}, false) END
         AND count(*) FILTER (WHERE candle_idx >= {need} AND {name} IS NULL) = 0 AS is_expected
FROM gold GROUP BY symbol"""
    for name, need in _INDICATORS.items()
)


def _rate(first: str = "min(kafka_timestamp)", last: str = "max(kafka_timestamp)") -> str:
    seconds = f"((epoch_us({last}) - epoch_us({first})) / 1e6)"
    per_second = f"CASE WHEN {seconds} > 0 THEN count(*) / {seconds} END"
    per_minute = f"({per_second} * 60)"
    return f"round({per_second} + 1e-9, 6) + 0.0 AS per_second, round({per_minute} + 1e-9, 6) + 0.0 AS per_minute"


PRICE_BOARD = f"""WITH {NEWEST},
p AS (SELECT a.symbol, a.window_start, a.avg_price AS price, coalesce(b.avg_price, a.avg_price) AS prev_price
      FROM (FROM ranked WHERE recency = 1) a LEFT JOIN (FROM ranked WHERE recency = 2) b ON a.symbol = b.symbol),
c AS (SELECT *, price - prev_price AS change,
             CASE WHEN prev_price = 0 THEN 0.0 ELSE (price - prev_price) / prev_price * 100 END AS pct FROM p)
SELECT symbol, window_start, {_r('price', 'prev_price', 'change', 'pct')},
       CASE WHEN change >= 0 THEN 'up' ELSE 'down' END AS direction,
       '$' || format('{{:,.4f}}', price) AS price_label, format('{{:+.2f}}', pct) || '%' AS pct_label,
       strftime(window_start + INTERVAL 1 HOUR, '%H:%M') AS clock FROM c"""


def statements() -> dict[str, str]:
    candle_rows = f"WITH {HOURLY} SELECT {CANDLE_COLUMNS} FROM candles"
    bronze_rows = f"WITH {ENVELOPE} SELECT {BRONZE_COLUMNS} FROM bronze"
    trade_rows = (
        f"symbol, {_r('price', 'quantity')}, event_time, trade_id, source"
    )
    return {
        "ohlcv_candles": candle_rows,
        "ohlcv_by_source": f"WITH {TRADES}, {_candles('trades', '1 DAY', 'daily', 'symbol, source')} "
        f"SELECT source, {CANDLE_COLUMNS} FROM daily",
        "brand_weekly_candles": f"WITH {BRANDS}, {_candles('brand_trades', '7 DAYS', 'weekly')} "
        f"SELECT {CANDLE_COLUMNS} FROM weekly",
        "brand_daily_indicators": f"WITH {BRANDS}, {_candles('brand_trades', '1 DAY', 'daily')}, {_gold('daily')} "
        f"SELECT symbol, window_start, "
        f"{_r('close', 'rsi', 'macd_approx', 'signal_approx', 'bb_middle', 'bb_upper')} FROM gold",
        "candle_index": f"WITH {GOLD} SELECT symbol, window_start, row_idx, candle_idx FROM gold",
        "price_change_lag": f"WITH {GOLD} SELECT symbol, window_start, "
        f"{_r('close', 'prev_close', 'change', 'gain', 'loss')} FROM gold",
        "previous_price": f"""WITH {HOURLY} SELECT symbol, window_start, round(avg_price + 1e-9, 6) + 0.0 AS avg_price,
            round(coalesce(lag(avg_price) OVER (PARTITION BY symbol ORDER BY window_start), avg_price) + 1e-9, 6) + 0.0
            AS prev_avg_price FROM candles""",
        "rolling_mean_std": f"WITH {GOLD} SELECT symbol, window_start, round(mean20 + 1e-9, 6) + 0.0 AS mean_20, "
        "round(bb_std + 1e-9, 6) + 0.0 AS std_20 FROM gold",
        "rsi14": f"WITH {GOLD} SELECT symbol, window_start, {_r('avg_gain', 'avg_loss', 'rsi')} FROM gold",
        "macd_sma": f"WITH {GOLD} SELECT symbol, window_start, "
        f"{_r('ma12', 'ma26', 'macd_approx', 'signal_approx', 'macd_histogram')} FROM gold",
        "bollinger20": f"WITH {GOLD} SELECT symbol, window_start, "
        f"{_r('bb_middle', 'bb_std', 'bb_upper', 'bb_lower')} FROM gold",
        "gold_indicators": f"WITH {GOLD} SELECT {GOLD_COLUMNS} FROM gold",
        "ema_macd": _ema(),
        "ema_macd_gaps": _ema("CASE WHEN epoch_us(window_start) // 3600000000 % 5 <> 0 THEN close END"),
        "volume_zscore": f"""WITH {HOURLY},
z AS (SELECT symbol, window_start, volume, row_number() OVER (PARTITION BY symbol ORDER BY window_start) AS rn,
        avg(volume) OVER w AS volume_mean, stddev_pop(volume) OVER w AS volume_std
      FROM candles
      WINDOW w AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, CASE WHEN rn > 20 AND volume_std > 0 THEN (volume - volume_mean) / volume_std END AS volume_zscore
      FROM z)
SELECT symbol, window_start, {_r('volume', 'volume_mean', 'volume_std', 'volume_zscore')},
       coalesce(volume_zscore > 3, false) AS is_spike FROM s""",
        "bronze_parse": bronze_rows,
        "bronze_quarantine": QUARANTINE,
        "message_completeness": f"""WITH {ENVELOPE}
SELECT topic, kafka_partition, kafka_offset, kafka_timestamp, trade_id, reasons, reasons = '' AS is_complete,
       trade_id IS NOT NULL AS is_admitted FROM envelope""",
        "normalize_venue_a": f"WITH {TRADES} {VENUE_A_ROWS}",
        "normalize_venue_b": f"WITH {TRADES} {VENUE_B_ROWS}",
        "venue_a_rejects": f"""WITH {TRADES} SELECT trade_id, symbol,
            CASE WHEN user_id = 8 THEN 'n/a' END AS price_text, CASE WHEN user_id = 10 THEN '' END AS quantity_text,
            CASE WHEN user_id = 12 THEN 'soon' END AS event_text,
            CASE user_id WHEN 8 THEN 'invalid:price' WHEN 10 THEN 'invalid:quantity' ELSE 'invalid:event_time' END AS reasons
            FROM trades WHERE user_id IN (8, 10, 12)""",
        "venue_a_strict": f"WITH {TRADES} {VENUE_A_ROWS} AND user_id NOT IN (8, 10, 12)",
        "json_landing": f"WITH {TRADES} {VENUE_A_ROWS}",
        "venue_b_rejects": f"""WITH {TRADES} SELECT trade_id, symbol, 'yesterday' AS event_text,
            'invalid:timestamp' AS reason FROM trades WHERE source = 'kraken' AND user_id = 15""",
        "venue_union": f"WITH {TRADES} {VENUE_A_ROWS} UNION ALL {VENUE_B_ROWS}",
        "symbol_map": f"""WITH {TRADES},
pairs AS (SELECT symbol, CASE WHEN symbol = 'BTCUSDT' AND user_id % 3 = 0 THEN 'XBT/USD'
                 WHEN symbol = 'BTCUSDT' AND user_id % 3 = 1 THEN 'BTC-USD'
                 ELSE replace(symbol, 'USDT', '') || '/USD' END AS venue_pair
          FROM trades WHERE source = 'kraken' AND user_id NOT IN (1, 13))
SELECT venue_pair, symbol, count(*) AS trades FROM pairs GROUP BY venue_pair, symbol""",
        "allowed_symbols": f"""WITH {TRADES} SELECT symbol, count(*) AS n_rows FROM trades
            WHERE symbol IN ('BTCUSDT', 'ETHUSDT', 'XRPUSDT') GROUP BY symbol""",
        "kafka_publish_rows": f"WITH {TRADES} SELECT 'crypto-trades-' || lower(symbol) AS topic, symbol AS key, "
        f"{MESSAGE_COLUMNS} FROM trades",
        "raw_replay": f"""WITH {ENVELOPE} SELECT symbol, round(price + 1e-9, 6) + 0.0 AS price,
            round(quantity + 1e-9, 6) + 0.0 AS quantity, event_time_ms AS event_time, trade_id, source FROM bronze""",
        "payload_drift": f"""WITH {DRIFT}
SELECT topic, day, field, CASE WHEN b.types IS NULL THEN 'appeared' WHEN a.types IS NULL THEN 'vanished'
       ELSE 'retyped' END AS change, b.types AS types_before, a.types AS types_after, coalesce(a.messages, 0) AS messages
FROM d5 a FULL JOIN d4 b USING (topic, day, field) WHERE a.types IS DISTINCT FROM b.types""",
        "payload_readability": f"""WITH {DRIFT}
SELECT topic, day, count(*) AS messages, count(*) FILTER (WHERE broken) AS unreadable FROM d0 GROUP BY topic, day""",
        "drift_replay": f"""WITH {DRIFT}
SELECT symbol, CASE WHEN NOT price_is_text THEN round(price + 1e-9, 6) + 0.0 END AS price, {_r('quantity')},
       event_ms AS event_time, trade_id, CASE WHEN NOT no_source THEN source END AS source,
       CASE WHEN day >= DATE '2024-01-10' THEN round(user_id / 100 + 1e-9, 6) + 0.0 END AS fee,
       CASE WHEN day = DATE '2024-01-12' THEN '{{"note":{{"by":' || user_id || '}}}}'
            WHEN day = DATE '2024-01-13' THEN '{{"note":{{"by":"' || user_id || '"}}}}' ELSE '{{}}' END AS rest
FROM d0 WHERE NOT broken AND trade_id IS NOT NULL""",
        "curve_lookup": f"""WITH {TRADES} SELECT symbol, {_r('price', 'quantity')}, event_time, trade_id, source
FROM trades WHERE symbol = 'ETHUSDT' AND event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-11'""",
        "market_snapshot_rows": f"WITH {HOUR_FACTS} SELECT * FROM snapshots",
        "global_metrics_rows": f"WITH {HOUR_FACTS} SELECT * FROM metrics",
        "dedupe_trades": f"WITH {TRADES} SELECT {trade_rows} FROM trades",
        "snapshot_upsert": f"""WITH {HOUR_FACTS} SELECT * REPLACE (
            CASE WHEN snapshot_hour >= TIMESTAMP '2024-01-15' THEN round((current_price + 1) + 1e-9, 6) + 0.0
                 ELSE current_price END AS current_price,
            CASE WHEN snapshot_hour >= TIMESTAMP '2024-01-15' THEN ingested_at + INTERVAL 1 MINUTE
                 ELSE ingested_at END AS ingested_at) FROM snapshots""",
        "global_metrics_upsert": f"""WITH {HOUR_FACTS} SELECT * REPLACE (
            CASE WHEN snapshot_hour >= TIMESTAMP '2024-01-15' THEN markets + 100 ELSE markets END AS markets,
            CASE WHEN snapshot_hour >= TIMESTAMP '2024-01-15' THEN ingested_at + INTERVAL 1 MINUTE
                 ELSE ingested_at END AS ingested_at) FROM metrics""",
        "roundtrip_overwrite": candle_rows,
        "backfill_merge": f"""WITH {ENVELOPE}
SELECT CASE WHEN event_time >= TIMESTAMP '2024-01-15' THEN 'live' ELSE 'history' END AS load, {BRONZE_COLUMNS}
FROM bronze""",
        "stream_bronze": bronze_rows,
        "stream_quarantine": QUARANTINE,
        "stream_bronze_and_quarantine": f"""WITH {ENVELOPE}
SELECT CASE WHEN trade_id IS NULL THEN 'quarantine' ELSE 'bronze' END AS table_name, topic, kafka_partition, kafka_offset,
       kafka_timestamp, trade_id, CASE WHEN trade_id IS NULL THEN reasons END AS reasons FROM envelope""",
        "stream_ohlcv": f"WITH {HOURLY} SELECT {CANDLE_COLUMNS} FROM candles WHERE {CLOSED}",
        "stream_dedupe": f"WITH {TRADES} SELECT {trade_rows} FROM trades",
        "stream_feed_health": f"""WITH {ENVELOPE}
SELECT topic, time_bucket(INTERVAL 1 DAY, kafka_timestamp, TIMESTAMP '1970-01-01') AS window_start,
       count(*) AS messages, count(*) FILTER (WHERE reasons <> '') AS invalid, min(kafka_timestamp) AS first_seen,
       max(kafka_timestamp) AS last_seen, {_rate()}
FROM envelope GROUP BY 1, 2
HAVING time_bucket(INTERVAL 1 DAY, kafka_timestamp, TIMESTAMP '1970-01-01') + INTERVAL 1 DAY
       <= (SELECT max(kafka_timestamp) FROM envelope) - INTERVAL 2 MINUTE""",
        "stream_gold_refresh": f"WITH {HOURLY}, closed AS (SELECT * FROM candles WHERE {CLOSED}), {_gold('closed')} "
        f"SELECT {GOLD_COLUMNS} FROM gold",
        "gold_extend": f"WITH {GOLD} SELECT {GOLD_COLUMNS} FROM gold",
        "gold_correct": f"WITH {GOLD} SELECT {GOLD_COLUMNS} FROM gold",
        "stream_late_trades": f"""WITH {TRADES}, w AS (
  SELECT make_timestamp(max(event_ms) * 1000) - INTERVAL 2 MINUTE AS watermark
  FROM trades WHERE (day(event_time) - 1) // 7 < 3 AND NOT ({LATE}))
SELECT symbol, trade_id, event_time, watermark,
       round((epoch_us(watermark) - epoch_us(event_time)) / 1e6 + 1e-9, 6) + 0.0 AS delay_seconds
FROM trades, w WHERE {LATE}""",
        "stream_state_health": f"""WITH {HOURLY}, w AS (
  SELECT make_timestamp(max(event_ms) * 1000) - INTERVAL 2 MINUTE AS watermark FROM trades)
SELECT 'dedupeWithinWatermark' AS operator, count(*) AS state_rows, min(event_time + INTERVAL 2 MINUTE) AS first_due,
       max(event_time + INTERVAL 2 MINUTE) AS last_due FROM trades, w WHERE event_time + INTERVAL 2 MINUTE > watermark
UNION ALL
SELECT 'stateStoreSave', count(*), min(window_end), max(window_end) FROM candles, w WHERE window_end > watermark""",
        "stream_late_candles": f"""WITH {TRADES}, in_time AS (SELECT * FROM trades WHERE NOT ({LATE})),
{_candles('in_time', '1 HOUR', 'candles')} SELECT {CANDLE_COLUMNS} FROM candles WHERE {CLOSED}""",
        "stream_progress": f"""WITH {TRADES} SELECT 'silver_progress' AS query, count(*) AS input_rows,
            count(*) FILTER (WHERE {LATE}) AS late_rows, count(DISTINCT (day(event_time) - 1) // 7) AS data_batches
            FROM trades""",
        "late_data_audit": f"""WITH {TRADES} SELECT symbol, count(*) AS trades,
            count(*) FILTER (WHERE {LATE}) AS late_trades FROM trades GROUP BY symbol""",
        "latest_per_symbol": f"WITH {NEWEST} SELECT {CANDLE_COLUMNS} FROM ranked WHERE recency = 1",
        "last_non_null": f"""WITH {HOURLY} SELECT symbol, round(max_by(close, window_start) + 1e-9, 6) + 0.0 AS close,
            round(max_by(vwap, window_start) FILTER (WHERE vwap IS NOT NULL) + 1e-9, 6) + 0.0 AS vwap,
            round(max_by(volume, window_start) + 1e-9, 6) + 0.0 AS volume FROM candles GROUP BY symbol""",
        "price_board": PRICE_BOARD,
        "stream_price_board": PRICE_BOARD,
        "signal_summary": f"""WITH {GOLD}, last AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS recency FROM gold)
SELECT symbol, round(avg_price + 1e-9, 6) + 0.0 AS last_price, round(close + 1e-9, 6) + 0.0 AS last_close,
       round(rsi + 1e-9, 6) + 0.0 AS rsi, {CLASSES}, '$' || format('{{:,.4f}}', avg_price) AS price_label,
       coalesce(format('{{:.1f}}', rsi), '—') AS rsi_label,
       coalesce(format('{{:+.0f}}', CASE WHEN vwap <> 0 THEN (close - vwap) / vwap * 10000 END) || 'bps', '—')
         AS vwap_label
FROM last WHERE recency = 1""",
        "signal_history": f"WITH {GOLD} SELECT symbol, window_start, {CLASSES} FROM gold",
        "warmup_status": f"""WITH {HOURLY}, n AS (SELECT symbol, count(*) AS have FROM candles GROUP BY symbol)
SELECT symbol, indicator, have, need, have >= need AS is_ready
FROM n, (VALUES ('rsi', 14), ('bollinger', 20), ('macd', 35)) AS v(indicator, need)""",
        "candle_direction": f"""WITH {GOLD} SELECT symbol, window_start,
            CASE WHEN close >= open THEN 'up' ELSE 'down' END AS candle_direction,
            round(coalesce(macd_histogram, 0) + 1e-9, 6) + 0.0 AS histogram,
            CASE WHEN coalesce(macd_histogram, 0) >= 0 THEN 'up' ELSE 'down' END AS histogram_direction FROM gold""",
        "indicator_points": f"""WITH {GOLD} SELECT symbol, window_start, {_r('macd_approx', 'signal_approx')}
            FROM gold WHERE macd_approx IS NOT NULL AND signal_approx IS NOT NULL""",
        "distinct_symbols": f"WITH {HOURLY} SELECT DISTINCT symbol FROM candles",
        # the zone is one hour ahead of UTC in the month the data covers
        "display_time": f"""WITH {HOURLY} SELECT symbol, window_start + INTERVAL 1 HOUR AS window_start,
            window_end + INTERVAL 1 HOUR AS window_end, round(close + 1e-9, 6) + 0.0 AS close,
            strftime(window_start + INTERVAL 1 HOUR, '%H:%M') AS clock FROM candles""",
        "bronze_silver_recon": _recon(),
        "recon_by_digests": f"SELECT * FROM ({_recon()}) WHERE status <> 'equal'",
        "layer_count_parity": f"""WITH {HOURLY}, c AS (SELECT symbol, count(*) AS silver_rows, count(*) FILTER
              (WHERE NOT (symbol = 'BTCUSDT' AND window_start >= TIMESTAMP '2024-01-20')) AS gold_rows
            FROM candles GROUP BY symbol) SELECT *, silver_rows = gold_rows AS is_equal FROM c""",
        "null_pattern": NULL_PATTERN,
        "table_profile": f"""WITH {HOURLY}
SELECT symbol, count(*) AS n_rows, min(window_start) AS first_time, max(window_start) AS last_time,
       symbol IS NULL AS is_total FROM candles GROUP BY GROUPING SETS ((symbol), ())""",
        "counts_by_source": f"WITH {TRADES} SELECT symbol, source, count(*) AS n_rows FROM trades "
        "GROUP BY symbol, source",
        "topic_health": f"""WITH {ENVELOPE} SELECT topic, count(*) AS messages,
            count(*) FILTER (WHERE reasons <> '') AS invalid, min(kafka_timestamp) AS first_seen,
            max(kafka_timestamp) AS last_seen, {_rate()} FROM envelope GROUP BY topic""",
        "arrival_lag": f"""WITH {ENVELOPE},
l AS (SELECT topic, (epoch_us(kafka_timestamp) - epoch_us(event_time)) / 1e6 AS lag FROM bronze)
SELECT topic, count(*) AS messages, round(avg(lag) + 1e-9, 6) + 0.0 AS mean_lag_seconds,
       round(max(lag) + 1e-9, 6) + 0.0 AS max_lag_seconds, count(*) FILTER (WHERE lag < 0) AS from_the_future
FROM l GROUP BY topic""",
        "feed_percentiles": f"""WITH {ENVELOPE},
v AS (SELECT 'lag' AS measure, topic FROM bronze
      UNION ALL SELECT DISTINCT 'rate' || strftime(date_trunc('hour', kafka_timestamp), ' %x %H'), topic FROM bronze),
n AS (SELECT split_part(measure, ' ', 1) AS measure, topic, count(*) AS n_values FROM v GROUP BY 1, 2)
SELECT measure, topic, CAST(r AS DOUBLE) AS rank, n_values, true AS is_within FROM n, (VALUES (0.5), (0.9), (0.99)) AS q(r)""",
        "first_sample": f"""WITH {ENVELOPE},
r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY kafka_partition, kafka_offset) AS n
      FROM envelope WHERE reasons = '')
SELECT topic, kafka_partition, kafka_offset, symbol, round(price + 1e-9, 6) + 0.0 AS price,
       round(quantity + 1e-9, 6) + 0.0 AS quantity, event_time_ms AS event_time, trade_id, source FROM r WHERE n = 1""",
        "window_range_check": f"""WITH {TRADES} SELECT count(*) AS trade_count,
            round(sum(quantity) + 1e-9, 6) + 0.0 AS volume, min(price) AS low, max(price) AS high
            FROM trades WHERE symbol = 'BTCUSDT'
            AND event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-11'""",
        "latest_trades_topk": f"""WITH {TRADES} SELECT {trade_rows} FROM trades
            ORDER BY event_time DESC, trade_id DESC LIMIT 10""",
        "schema_contract": f"""WITH {HOURLY}
SELECT 'silver' AS table_name, '' AS missing, true AS is_valid, count(*) AS n_rows FROM candles
UNION ALL SELECT 'gold', '', true, count(*) FROM candles
UNION ALL SELECT 'gold_drifted', 'rsi,vwap', false, count(*) FROM candles""",
        "reference_price_asof": f"""WITH {HOUR_FACTS}, {_candles('trades', '15 MINUTE', 'quarters')},
fetched AS (SELECT * FROM snapshots WHERE hour(snapshot_hour) % 3 <> 1),
found AS (
  SELECT q.symbol, q.window_start, q.window_end, q.close,
         CASE WHEN s.ingested_at >= q.window_end - INTERVAL 6 HOUR THEN s.current_price END AS p,
         CASE WHEN s.ingested_at >= q.window_end - INTERVAL 6 HOUR THEN s.ingested_at END AS fetched_at
  FROM quarters q ASOF LEFT JOIN fetched s
    ON s.symbol = replace(q.symbol, 'USDT', '') AND q.window_end >= s.ingested_at)
SELECT symbol, window_start, round(close + 1e-9, 6) + 0.0 AS price, round(p + 1e-9, 6) + 0.0 AS reference_price,
       round((epoch_us(window_end) - epoch_us(fetched_at)) / 1e6 + 1e-9, 6) + 0.0 AS age_seconds,
       round((CASE WHEN p <> 0 THEN (close - p) / p * 10000 END) + 1e-9, 6) + 0.0 AS deviation_bps FROM found""",
        "reference_price_check": f"""WITH {HOUR_FACTS}, {_candles('trades', '15 MINUTE', 'quarters')}
SELECT q.symbol, q.window_start, round(q.close + 1e-9, 6) + 0.0 AS price,
       round(s.current_price + 1e-9, 6) + 0.0 AS reference_price,
       round((CASE WHEN s.current_price <> 0 THEN (q.close - s.current_price) / s.current_price * 10000 END) + 1e-9, 6)
         + 0.0 AS deviation_bps
FROM quarters q LEFT JOIN snapshots s
  ON s.symbol = replace(q.symbol, 'USDT', '') AND s.snapshot_hour = date_trunc('hour', q.window_start)""",
    }
