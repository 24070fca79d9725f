import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import candles, dedupe
from tickloom.schemas import SILVER

TRADES = "symbol string, price double, quantity double, event_time timestamp, trade_id string"


def sixty_trades(at):
    rng = random.Random(7)
    return [("BTCUSDT", round(100 + rng.uniform(-5, 5), 2), float(rng.randint(0, 9)), at(i * 3), f"v:{i}")
            for i in range(60)]


def by_hand(rows, at):
    result = {}
    for minute in range(3):
        part = [r for r in rows if at(60 * minute) <= r[3] < at(60 * minute + 60)]
        part.sort(key=lambda r: r[3])
        volume = sum(r[2] for r in part)
        result[at(60 * minute)] = (
            part[0][1], max(r[1] for r in part), min(r[1] for r in part), part[-1][1], volume, len(part),
            sum(r[1] for r in part) / len(part), sum(r[1] * r[2] for r in part) / volume)
    return result


def as_dict(frame):
    columns = ("open", "high", "low", "close", "volume", "trade_count", "avg_price", "vwap")
    return {r.window_start: tuple(r[c] for c in columns) for r in frame.collect()}


def assert_close(got, expected):
    assert got.keys() == expected.keys()
    for window, values in expected.items():
        assert got[window] == pytest.approx(values)


def test_sixty_trades_by_hand(spark, at):
    rows = sixty_trades(at)
    got = as_dict(candles.ohlcv(spark.createDataFrame(rows, TRADES)))
    assert_close(got, by_hand(rows, at))


def test_contract(spark, at):
    frame = candles.ohlcv(spark.createDataFrame(sixty_trades(at), TRADES))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in SILVER]


def test_edges_ties_and_zero_volume(spark, at):
    rows = [
        ("A", 5.0, 1.0, at(0), "1"), ("A", 4.0, 1.0, at(0), "2"),          # same first instant: lower opens
        ("A", 7.0, 1.0, at(59), "3"), ("A", 8.0, 1.0, at(59), "4"),        # same last instant: higher closes
        ("A", 9.0, 0.0, at(60), "5"),                                       # on the edge: the later window
        ("A", None, 2.0, at(180), "6"), ("A", 3.0, 2.0, at(181), "7"),      # a missing price is counted, not averaged
        (None, 1.0, 1.0, at(0), "8"),                                       # trades without a symbol stay
    ]
    got = {(r.symbol, r.window_start): r for r in candles.ohlcv(spark.createDataFrame(rows, TRADES)).collect()}
    assert set(got) == {("A", at(0)), ("A", at(60)), ("A", at(180)), (None, at(0))}
    assert (got["A", at(0)].open, got["A", at(0)].close) == (4.0, 8.0)
    assert got["A", at(60)].vwap is None and got["A", at(60)].volume == 0.0
    assert got["A", at(180)].trade_count == 2 and got["A", at(180)].avg_price == 3.0
    assert got["A", at(180)].open is None


def test_window_length_does_not_depend_on_the_session_zone(spark):
    """A day that loses an hour of summer time is still one window of 24 hours."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        frame = spark.createDataFrame([(1761438600 + h * 3600, 1.0) for h in range(48)], "s long, price double")
        trades = frame.select(F.timestamp_seconds("s").alias("event_time"), "price", F.lit(1.0).alias("quantity"),
                              F.lit("A").alias("symbol"))
        lengths = candles.ohlcv(trades, "1 day").select(
            (F.unix_seconds("window_end") - F.unix_seconds("window_start")).alias("n")).distinct().collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.n for r in lengths] == [86400]


def test_order_and_split_do_not_matter(spark, at):
    rows = sixty_trades(at)
    expected = as_dict(candles.ohlcv(spark.createDataFrame(rows, TRADES).coalesce(1)))
    random.Random(1).shuffle(rows)
    shuffled = as_dict(candles.ohlcv(spark.createDataFrame(rows, TRADES).repartition(13)))
    assert_close(shuffled, expected)


def test_bounds_hold(spark, at):
    frame = candles.ohlcv(spark.createDataFrame(sixty_trades(at), TRADES))
    inside = [F.col(c).between(F.col("low"), F.col("high")) for c in ("open", "close", "avg_price", "vwap")]
    assert frame.where(~(inside[0] & inside[1] & inside[2] & inside[3])).count() == 0


def test_replaying_any_subset_changes_nothing(spark, at):
    rows = sixty_trades(at)
    once = spark.createDataFrame(rows, TRADES)
    replayed = spark.createDataFrame(rows + rows[10:40] + rows[::3], TRADES)
    assert_close(as_dict(candles.ohlcv(dedupe.dedupe_batch(replayed))), as_dict(candles.ohlcv(once)))


def test_dedupe_prefers_the_earliest_and_is_deterministic(spark, at):
    rows = [("A", 2.0, 1.0, at(5), "x"), ("A", 1.0, 1.0, at(1), "x"), ("A", 3.0, 1.0, at(1), "x"),
            ("A", 9.0, 1.0, at(9), None), ("A", 8.0, 1.0, at(8), None)]
    for parts in (1, 5):
        got = dedupe.dedupe_batch(spark.createDataFrame(rows, TRADES).repartition(parts))
        assert got.columns == ["symbol", "price", "quantity", "event_time", "trade_id"]
        assert {r.trade_id: r.price for r in got.collect()} == {"x": 1.0}  # rows without an id are no copies


def test_candles_of_a_hot_symbol_are_reduced_before_the_shuffle(spark, at):
    plan = candles.ohlcv(spark.createDataFrame(sixty_trades(at), TRADES))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Exchange hashpartitioning") < text.index("partial_min")
