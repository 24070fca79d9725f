import contextlib
import datetime as dt
import io
import math
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import indicators, series
from tickloom.schemas import GOLD, SILVER

N = 40


def closes():
    return {
        "rising": [100.0 + i for i in range(N)],
        "falling": [100.0 - i for i in range(N)],
        "flat": [50.0] * N,
        "alternating": [10.0 + (i % 2) for i in range(N)],
        "gaps": [None if i % 5 == 2 else 20.0 + math.sin(i) for i in range(N)],
        "short": [30.0 + i for i in range(13)],
        "late": [None] * 6 + [5.0 + i * i for i in range(N - 6)],
        None: [70.0 + math.cos(i) for i in range(N)],
    }


@pytest.fixture(scope="module")
def candles(spark):
    start = dt.datetime(2024, 3, 1, 22, 0, 0)
    rows = []
    for symbol, values in closes().items():
        for i, close in enumerate(values):
            begin = start + dt.timedelta(minutes=7 * i)  # crosses midnight, so that two day buckets are counted
            rows.append((begin, begin + dt.timedelta(minutes=1), symbol, close, close, close, close, 1.0 + i % 7, 1,
                         close, close))
    return spark.createDataFrame(rows, SILVER).repartition(5)


def golden(values):
    """The definitions, written out over plain lists."""
    rows, macds = [], []
    idx = 0
    gains, losses = [], []
    for i, close in enumerate(values):
        idx += close is not None
        previous = values[i - 1] if i else None
        change = None if close is None or previous is None else close - previous
        gains.append(change if change is not None and change > 0 else 0.0)
        losses.append(-change if change is not None and change < 0 else 0.0)

        def last(n, source=values):
            return [v for v in source[max(0, i - n + 1): i + 1] if v is not None]

        def mean(xs):
            return sum(xs) / len(xs) if xs else None

        gain, loss = mean(gains[max(0, i - 13): i + 1]), mean(losses[max(0, i - 13): i + 1])
        rsi = None if idx < 14 else 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss)
        ma12, ma26 = mean(last(12)), mean(last(26))
        macds.append(ma12 - ma26 if idx >= 26 else None)
        signal = mean(last(9, macds)) if idx >= 35 else None
        middle = mean(last(20))
        std = math.sqrt(mean([(x - middle) ** 2 for x in last(20)])) if last(20) else None
        ready = idx >= 20
        rows.append((
            rsi, ma12, ma26, macds[-1], signal,
            macds[-1] - signal if signal is not None and macds[-1] is not None else None,
            middle if ready else None, middle + 2 * std if ready else None, middle - 2 * std if ready else None))
    return rows


INDICATORS = ("rsi", "ma12", "ma26", "macd_approx", "signal_approx", "macd_histogram", "bb_middle", "bb_upper",
              "bb_lower")


def collected(frame, columns):
    got = {}
    for r in frame.orderBy("window_start").collect():
        got.setdefault(r.symbol, []).append(tuple(r[c] for c in columns))
    return got


def assert_same(got, expected):
    assert got.keys() == expected.keys()
    for symbol, rows in expected.items():
        assert len(got[symbol]) == len(rows), symbol
        for i, (a, e) in enumerate(zip(got[symbol], rows)):
            for x, y in zip(a, e):
                assert (x is None) == (y is None) and (y is None or x == pytest.approx(y, abs=1e-9)), (symbol, i)


@pytest.mark.parametrize("chunk_rows", [None, 33, 36, 4096])
def test_gold_against_written_out_definitions(candles, chunk_rows):
    gold = indicators.gold_indicators(candles, chunk_rows=chunk_rows)
    assert [(f.name, f.dataType) for f in gold.schema] == [(f.name, f.dataType) for f in GOLD]
    assert_same(collected(gold, INDICATORS), {s: golden(v) for s, v in closes().items()})


def test_newest_rows_are_limited_in_the_map_tasks(candles):
    plan = series.latest_per_key(candles)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("row_number(), 1, Partial")


def test_extremes(candles):
    last = {r.symbol: r for r in series.latest_per_key(indicators.gold_indicators(candles)).collect()}
    assert last["rising"].rsi == 100.0 and last["falling"].rsi == 0.0 and last["flat"].rsi == 100.0
    assert last["flat"].bb_upper == last["flat"].bb_lower == 50.0
    assert last["short"].rsi is None and last["short"].ma26 is not None


def test_rsi_stays_in_range(candles):
    assert indicators.rsi(candles, chunk_rows=20).where(~F.col("rsi").between(0, 100)).count() == 0


def test_parameters(candles):
    rows = collected(indicators.rsi(candles, period=5, chunk_rows=7), ["rsi"])["alternating"]
    assert [r[0] is None for r in rows[:6]] == [True] * 4 + [False] * 2
    wide = collected(indicators.bollinger(candles, period=4, width=3.0, chunk_rows=9), ["bb_upper"])["rising"]
    values = closes()["rising"][2:6]
    mean = sum(values) / 4
    std = math.sqrt(sum((v - mean) ** 2 for v in values) / 4)
    assert wide[5][0] == pytest.approx(mean + 3 * std)


@pytest.mark.parametrize("operator", [
    lambda c, k: indicators.price_change(c, chunk_rows=k),
    lambda c, k: indicators.rolling_stats(c, "volume", 6, chunk_rows=k),
    lambda c, k: indicators.macd(c, 3, 6, 2, chunk_rows=k),
    lambda c, k: indicators.volume_zscore(c, rows=6, chunk_rows=k),
    lambda c, k: series.previous_value(c, "avg_price", chunk_rows=k),
])
def test_chunked_equals_whole(candles, operator):
    whole, chunked = operator(candles, None), operator(candles, 8)
    assert sorted(whole.columns) == sorted(chunked.columns)
    shared = whole.columns
    assert sorted(map(str, whole.select(shared).collect())) == sorted(map(str, chunked.select(shared).collect()))


def test_index_counts_closes(candles):
    rows = collected(indicators.candle_index(candles), ["row_idx", "candle_idx"])
    for symbol, values in closes().items():
        expected = [(i + 1, sum(v is not None for v in values[: i + 1])) for i in range(len(values))]
        assert rows[symbol] == expected


def test_ema_against_whole_series(spark):
    start = dt.datetime(2024, 3, 1)
    values = [None if i in (0, 1, 700, 701, 2500) or i % 11 == 4 else 100 + 10 * math.sin(i / 9) + (i % 13) for i in range(3000)]
    rows = [(s, start + dt.timedelta(minutes=i), v if s == "a" else 2.0 * i)
            for s, n in (("a", 3000), ("b", 30)) for i, v in enumerate(values[:n])]
    frame = spark.createDataFrame(rows, "symbol string, window_start timestamp, close double")
    for chunk_rows in (7, 64):
        got = {(r.symbol, r.window_start): r for r in indicators.ema_macd(frame, chunk_rows=chunk_rows).collect()}
        assert len(got) == len(rows)
        state = {}
        for symbol, time, close in sorted(rows):
            if close is not None:
                f, s, g = state.get(symbol, (close, close, 0.0))
                f, s = f + 2 / 13 * (close - f), s + 2 / 27 * (close - s)
                state[symbol] = (f, s, g + 0.2 * (f - s - g))
            row = got[symbol, time]
            assert row.close == close
            if symbol not in state:
                assert row.ema_fast is None and row.ema_signal is None
                continue
            f, s, g = state[symbol]
            expected = (f, s, f - s, g, f - s - g)
            shown = (row.ema_fast, row.ema_slow, row.ema_macd, row.ema_signal, row.ema_histogram)
            assert shown == pytest.approx(expected, abs=1e-9)


def test_no_task_gets_a_whole_series(spark, candles):
    """The largest window group of the chunked form stays within chunk and halo."""
    chunked = series.chunk_series(series.index_series(candles), halo=3, chunk_rows=10)
    largest = chunked.groupBy("_series", "_chunk").count().agg(F.max("count")).first()[0]
    assert largest == 13


def test_no_shuffle_by_series_carries_candles(spark, candles):
    """Exponential averages: what meets by the series alone is one small row per chunk or bucket."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as shown:
            indicators.ema_macd(candles, chunk_rows=8).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\(_series#\d+, \d+\)", shown.getvalue())
    assert exchanges
    assert not [columns for columns in exchanges if re.search(r"\b(rows|window_start|maps)#", columns)]


@pytest.mark.parametrize("operator", [
    lambda c, b: indicators.gold_indicators(c, chunk_rows=40, bucket=b),
    lambda c, b: indicators.rsi(c, chunk_rows=40, bucket=b),
    lambda c, b: indicators.ema_macd(c, chunk_rows=8, bucket=b),
    lambda c, b: indicators.volume_zscore(c, rows=6, chunk_rows=40, bucket=b),
    lambda c, b: indicators.rolling_stats(c, "volume", 6, chunk_rows=40, bucket=b),
    lambda c, b: series.previous_value(c, "avg_price", chunk_rows=40, bucket=b),
    lambda c, b: indicators.candle_index(c, bucket=b),
])
def test_the_bucket_changes_no_result(candles, operator):
    shown = [sorted(map(str, operator(candles, bucket).collect())) for bucket in ("hour", "day", "year")]
    assert shown[0] == shown[1] == shown[2]
