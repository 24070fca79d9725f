import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from tickloom import session
from tickloom.functions import scalar
from tickloom.operators import bronze, candles, quality, signals, upsert
from tickloom.schemas import GOLD, GOLD_REQUIRED, MARKET_SNAPSHOT, SILVER, SILVER_REQUIRED
from tickloom.sources import landing, tables
from tickloom.streaming import runner

HOUR = dt.datetime(2024, 3, 1, 23)


def snapshots(spark, *rows):
    """Rows of (symbol, hours after 23:00, price, minute of ingestion)."""
    full = [
        (HOUR + dt.timedelta(hours=h), s, s.lower() if s else None, float(p), 1.0, 1, 1.0, None, 1.0,
         HOUR + dt.timedelta(hours=h, minutes=m))
        for s, h, p, m in rows
    ]
    return spark.createDataFrame(full, MARKET_SNAPSHOT)


def stored(spark, path):
    rows = upsert.read_snapshots(spark, path, MARKET_SNAPSHOT).collect()
    hours = [int((r.snapshot_hour - HOUR).total_seconds() // 3600) for r in rows]
    return sorted((r.symbol, h, r.current_price) for r, h in zip(rows, hours))


def test_round_trip(spark, tmp_path):
    rows = [("BTCUSDT", 84000.0, 0.5), ("ETHUSDT", 3200.0, 1.2), ("BTCUSDT", 84100.0, 0.3)]
    frame = spark.createDataFrame(rows, ["symbol", "price", "qty"])
    for _ in range(2):
        tables.overwrite_table(frame, str(tmp_path / "t"))
    assert sorted(map(tuple, tables.read_table(spark, str(tmp_path / "t")).collect())) == sorted(rows)
    tables.append_table(frame, str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path / "t"), frame.schema).count() == 6
    landing.save_json(frame, str(tmp_path / "j"))
    assert spark.read.schema(frame.schema).json(str(tmp_path / "j")).count() == 3


def test_table_exists(spark, tmp_path):
    assert not tables.table_exists(spark, str(tmp_path / "nothing"))
    (tmp_path / "empty").mkdir()
    assert not tables.table_exists(spark, str(tmp_path / "empty"))


def test_upsert_cases(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    upsert.upsert_market_snapshot(snapshots(spark, ("BTC", 0, 1, 1), ("ETH", 0, 2, 1), ("BTC", 30, 3, 1)), path)
    assert stored(spark, path) == [("BTC", 0, 1.0), ("BTC", 30, 3.0), ("ETH", 0, 2.0)]
    # update only
    upsert.upsert_market_snapshot(snapshots(spark, ("BTC", 0, 10, 2)), path)
    assert stored(spark, path) == [("BTC", 0, 10.0), ("BTC", 30, 3.0), ("ETH", 0, 2.0)]
    # insert only, into a date there is (1 hour later) and into a new one (60)
    upsert.upsert_market_snapshot(snapshots(spark, ("BTC", 1, 4, 1), ("BTC", 60, 5, 1)), path)
    # mixed, with a key twice in the source: the newest counts
    mixed = snapshots(spark, ("ETH", 0, 20, 3), ("ETH", 0, 21, 4), ("ETH", 0, 19, 2), ("XRP", 60, 7, 1))
    for _ in range(2):
        upsert.upsert_market_snapshot(mixed, path)
    assert stored(spark, path) == [("BTC", 0, 10.0), ("BTC", 1, 4.0), ("BTC", 30, 3.0), ("BTC", 60, 5.0),
                                   ("ETH", 0, 21.0), ("XRP", 60, 7.0)]


def test_upsert_leaves_other_dates_alone(spark, tmp_path):
    path = tmp_path / "snapshots"
    upsert.upsert_market_snapshot(snapshots(spark, *[("BTC", 24 * d, d, 1) for d in range(5)]), str(path))
    files = {f: f.stat().st_mtime_ns for f in path.glob("snapshot_date=*/*.parquet")}
    upsert.upsert_market_snapshot(snapshots(spark, ("BTC", 24, 100, 2), ("BTC", 72, 300, 2)), str(path))
    after = {f: f.stat().st_mtime_ns for f in path.glob("snapshot_date=*/*.parquet")}
    untouched = {f.parent.name for f in files if after.get(f) == files[f]}
    assert untouched == {"snapshot_date=2024-03-01", "snapshot_date=2024-03-03", "snapshot_date=2024-03-05"}
    assert [p for _, _, p in stored(spark, str(path))] == [0.0, 100.0, 2.0, 300.0, 4.0]


def test_upsert_against_a_dictionary(spark, tmp_path):
    rng = random.Random(3)
    path, expected = str(tmp_path / "snapshots"), {}
    for step in range(4):
        batch = [(rng.choice(["A", "B", "C"]), rng.randint(0, 70), step * 1000 + i, i) for i in range(40)]
        upsert.upsert_market_snapshot(snapshots(spark, *batch), path)
        newest = {}
        for s, h, p, m in batch:
            if (s, h) not in newest or m > newest[s, h][1]:
                newest[s, h] = (float(p), m)
        expected.update({k: v[0] for k, v in newest.items()})
    assert stored(spark, path) == sorted((s, h, p) for (s, h), p in expected.items())


def test_backfill_replaces_its_own_partition_only(spark, tmp_path, at):
    path = str(tmp_path / "history")

    def days(*numbers):
        return spark.createDataFrame([(at(86400 * n), n) for n in numbers], "event_time timestamp, n int")

    upsert.backfill(days(0, 1), path, "2018")
    upsert.backfill(days(2, 3, 4), path, "2019")
    upsert.backfill(days(2, 5), path, "2019")
    rows = spark.read.parquet(path).collect()
    assert sorted((str(r.load), r.n) for r in rows) == [("2018", 0), ("2018", 1), ("2019", 2), ("2019", 5)]


def test_backfill_is_seen_beside_a_streamed_table(spark, tmp_path, at):
    schema = spark.createDataFrame([], "event_time timestamp, n int").schema
    frame = spark.createDataFrame([(at(i), i) for i in range(4)], schema)
    frame.write.parquet(str(tmp_path / "feed"))
    stream = tables.stream_table(spark, str(tmp_path / "feed"), schema).withColumn(
        "trade_date", scalar.utc_date(F.col("event_time")))
    live, history = str(tmp_path / "live"), str(tmp_path / "history")
    runner.drain(runner.start_table_sink(stream, live, str(tmp_path / "c"), partition_by=["trade_date"]))
    assert upsert.read_raw_table(spark, live, history, schema).count() == 4
    upsert.backfill(spark.createDataFrame([(at(-86400 - i), i) for i in range(3)], schema), history, "old")
    both = upsert.read_raw_table(spark, live, history, schema)
    assert both.groupBy("load").count().orderBy("load").collect() == [(None, 4), ("old", 3)]


def test_upsert_of_nothing(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    upsert.upsert_market_snapshot(snapshots(spark, ("BTC", 0, 1, 1)).limit(0), path)
    upsert.upsert_market_snapshot(snapshots(spark, ("BTC", 0, 1, 1)), path)
    upsert.upsert_market_snapshot(snapshots(spark, ("BTC", 0, 2, 1)).limit(0), path)
    assert stored(spark, path) == [("BTC", 0, 1.0)]
    (tmp_path / "touched").mkdir()
    (tmp_path / "touched" / "_SUCCESS").touch()
    upsert.upsert_market_snapshot(snapshots(spark, ("BTC", 0, 1, 1)), str(tmp_path / "touched"))
    assert stored(spark, str(tmp_path / "touched")) == [("BTC", 0, 1.0)]


def test_scratch_folder(spark, monkeypatch):
    class Session:
        def __init__(self, master, root=None):
            self.conf, self.sparkContext, self._root, self.master = self, self, root, master

        def get(self, key, default):
            return self._root or default

        def getCheckpointDir(self):
            return None

    assert session.scratch_root(Session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    local = session.scratch_root(Session("local[4]"))
    assert local == session.scratch_root(Session("local"))
    for master in ("yarn", "local-cluster[3,2,1024]", "spark://host:7077"):
        with pytest.raises(ValueError):
            session.scratch_root(Session(master))


def test_raw_text_with_line_breaks_is_kept_whole(spark, tmp_path):
    message = '{\n  "symbol": "A",\r\n  "price": 1.5, "quantity": 2.0, "event_time": 5, "trade_id": "v:1", "source": "v"\n}'
    frame = spark.createDataFrame([(message,), (None,)], "raw_payload string")
    landing.save_raw(frame, "raw_payload", str(tmp_path / "raw"))
    rows = bronze.reparse_payloads(landing.read_raw(spark, str(tmp_path / "raw"))).collect()
    assert [(r.trade_id, r.price) for r in rows] == [("v:1", 1.5)]


def test_reference_price_of_the_last_fetch(spark, at):
    candle = spark.createDataFrame([(at(600), "BTCUSDT", 110.0)], "window_start timestamp, symbol string, close double")
    hour = dt.datetime(2024, 3, 1, 12)
    fetched = [(hour, "BTC", "btc", p, 1.0, 1, 1.0, None, 1.0, hour + dt.timedelta(minutes=m)) for p, m in ((90.0, 5), (100.0, 40))]
    (row,) = quality.reference_check(candle, spark.createDataFrame(fetched, MARKET_SNAPSHOT)).collect()
    assert (row.reference_price, row.deviation_bps) == (100.0, 1000.0)


def test_contracts(spark):
    silver, gold = spark.createDataFrame([], SILVER), spark.createDataFrame([], GOLD)
    assert quality.missing_columns(silver, SILVER_REQUIRED) == []
    assert quality.missing_columns(gold, GOLD_REQUIRED, strict=True) == []
    assert quality.missing_columns(gold.drop("vwap", "rsi"), GOLD_REQUIRED) == ["rsi", "vwap"]
    assert quality.schema_differences(silver, SILVER) == []
    drifted = silver.withColumn("close", F.lit(1)).withColumn("extra", F.lit(1)).drop("vwap")
    assert quality.schema_differences(drifted, SILVER) == [
        "close: int instead of double", "extra: not in the contract", "vwap: missing"]
    with pytest.raises(quality.ContractError):
        quality.missing_columns(gold.drop("vwap"), GOLD_REQUIRED, strict=True)


def test_time_range_reaches_the_scan(spark, tmp_path, at):
    frame = spark.createDataFrame([(at(i * 3600), i) for i in range(40)], "event_time timestamp, i int")
    frame = frame.withColumn("trade_date", F.to_date("event_time"))
    tables.overwrite_table(frame, str(tmp_path / "t"), partition_by=["trade_date"])
    stored = tables.read_table(spark, str(tmp_path / "t"), frame.schema)
    bounds = [F.lit(at(s * 3600)) for s in (2, 5)]
    for partition in (None, "trade_date"):
        ranged = quality.in_time_range(stored, "event_time", *bounds, partition)
        assert sorted(r.i for r in ranged.collect()) == [2, 3, 4]
        plan = ranged._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(event_time" in plan
        assert ("PartitionFilters: []" in plan) == (partition is None)
        files = ranged._jdf.queryExecution().executedPlan().collectLeaves().head().selectedPartitions()
        assert files.partitionCount() == (3 if partition is None else 1)


# ---- reconciliation and signals ---------------------------------------------------------------------------------
TRADES = "trade_id string, event_time timestamp, symbol string, price double, quantity double"


def test_reconciliation_states(spark, at):
    trades = spark.createDataFrame([("1", at(0), "A", 1.0, 2.0), ("1", at(0), "A", 1.0, 2.0),
                                    ("2", at(70), "A", 3.0, 1.0), ("3", at(0), None, 5.0, 1.0)], TRADES)
    once = trades.dropDuplicates(["trade_id"])
    silver = candles.ohlcv(once.where("trade_id <> '2'"))
    wrong = silver.withColumn("volume", F.when(F.col("symbol") == "A", 9.0).otherwise(F.col("volume")))
    extra = wrong.unionByName(candles.ohlcv(spark.createDataFrame([("9", at(600), "B", 1.0, 1.0)], TRADES)))
    got = {(r.symbol, r.window_start): (r.status, r.differences)
           for r in quality.reconcile_candles(trades, extra, "1 minute").collect()}
    assert got["A", at(0)] == ("different", "volume") and got[None, at(0)] == ("equal", "")
    assert got["A", at(60)][0] == "missing_in_silver" and got["B", at(600)][0] == "missing_in_bronze"
    assert len(got) == 4


SIGNALS = "close double, upper double, lower double, rsi double, macd double, signal double, vwap double"


def test_classifiers(spark):
    rows = [
        ((10.0, 10.0, 5.0, 70.0, 1.0, 1.0, 10.0), ("Overbought", "Bearish", "Inside", "At")),
        ((10.1, 10.0, 5.0, 30.0, 1.1, 1.0, 10.0), ("Oversold", "Bullish", "Above", "Above")),
        ((4.9, 10.0, 5.0, 50.0, 0.9, 1.0, 10.0), ("Neutral", "Bearish", "Below", "Below")),
        ((10.0, None, 5.0, None, None, 1.0, 0.0), ("—", None, None, None)),
        ((None, 10.0, 5.0, 69.9, 1.0, None, None), ("Neutral", None, None, None)),
        ((20010.0, 1.0, 1.0, 29.9, 1.0, 0.0, 20000.0), ("Oversold", "Bullish", "Above", "At")),   # exactly +5 bps
        ((19990.0, 1.0, 1.0, 71.0, 1.0, 0.0, 20000.0), ("Overbought", "Bullish", "Above", "At")),  # exactly -5 bps
    ]
    frame = spark.createDataFrame([r for r, _ in rows], SIGNALS).coalesce(1)
    c = F.col
    got = frame.select(
        signals.rsi_zone(c("rsi")), signals.macd_direction(c("macd"), c("signal")),
        signals.bollinger_position(c("close"), c("upper"), c("lower")),
        signals.vwap_position(signals.vwap_distance_bps(c("close"), c("vwap")))).collect()
    assert [tuple(r) for r in got] == [expected for _, expected in rows]


def silver_row(symbol, at, minute, avg, close=1.0):
    return (at(60 * minute), at(60 * minute + 60), symbol, close, close, close, close, 1.0, 1, avg, close)


def test_price_board(spark, at):
    rows = [silver_row("a", at, 0, 0.0), silver_row("a", at, 1, 5.0), silver_row("B", at, 0, 8.0),
            silver_row("C", at, 0, 1.0), silver_row("C", at, 5, 10.0), silver_row("C", at, 9, 9.0)]
    board = {r.symbol: r for r in signals.price_board(spark.createDataFrame(rows, SILVER), "Europe/Paris").collect()}
    assert set(board) == {"A", "B", "C"}
    assert (board["A"].change, board["A"].pct, board["A"].direction) == (5.0, 0.0, "up")
    assert (board["B"].change, board["B"].pct, board["B"].direction) == (0.0, 0.0, "up")
    assert (board["C"].pct, board["C"].direction, board["C"].pct_label) == (-10.0, "down", "-10.00%")
    assert (board["C"].price_label, board["C"].clock) == ("$9.0000", "13:09")


def test_symbol_without_gold_has_nulls(spark, at):
    silver = spark.createDataFrame([silver_row("A", at, 0, 2.0), silver_row("B", at, 0, 3.0)], SILVER)
    gold = spark.createDataFrame([], GOLD)
    rows = signals.signal_summary(silver, gold).collect()
    assert {r.symbol for r in rows} == {"A", "B"}
    shown = {(r.rsi, r.rsi_zone, r.macd_direction, r.bollinger_position, r.vwap_label) for r in rows}
    assert shown == {(None, "—", None, None, "—")}


def test_warmup(spark, at):
    silver = spark.createDataFrame([silver_row("A", at, i, 2.0) for i in range(20)], SILVER)
    got = {r.indicator: (r.have, r.need, r.is_ready) for r in signals.warmup_status(silver).collect()}
    assert got == {"rsi": (20, 14, True), "bollinger": (20, 20, True), "macd": (20, 35, False)}


def test_serving_view_shifts_times(spark, at):
    silver = spark.createDataFrame([silver_row("a", at, 0, 2.0)], SILVER)
    row = signals.serving_view(silver, "Europe/Paris").first()
    assert row.symbol == "A" and row.window_start == at(3600) and row.window_end == at(3660)


def test_newest_rows_and_profile(spark, at):
    frame = spark.createDataFrame([(f"t{i}", at(i // 2), "A" if i else None) for i in range(9)],
                                  "trade_id string, event_time timestamp, symbol string")
    top = quality.newest_rows(frame, 3, ["trade_id", "event_time"], "event_time", "trade_id").collect()
    assert [r.trade_id for r in top] == ["t8", "t7", "t6"]
    profile = quality.table_profile(frame, "event_time")
    total = profile.where("is_total").first()
    assert (total.n_rows, total.first_time, total.last_time) == (9, at(0), at(4))
    assert profile.where("NOT is_total").count() == 2
    empty = quality.table_profile(frame.where("false"), "event_time").collect()
    assert [(r.n_rows, r.is_total) for r in empty] == [(0, True)]


def test_released_tables_are_gone_and_only_they(spark):
    frame = spark.range(10)
    first, second = session.materialize(frame, "step"), session.materialize(frame, "step")
    path = first.inputFiles()[0].rsplit("/", 1)[0]
    derived = first.where("id > 3")
    session.release(derived)  # no table of its own
    assert derived.count() == 6
    session.release(first)
    session.release(first, frame)
    assert not tables.table_exists(spark, path)
    assert second.count() == 10


def test_what_was_shuffled_for_a_stored_table_is_deleted(spark):
    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        names = (str(blocks.apply(i)) for i in range(blocks.size()))
        return {name for name in names if name.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(session._CLEANUP, None)
    stored = session.materialize(spark.range(1000).repartition(3, "id"), "step")
    for _ in range(50):  # files go a little later
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and stored.count() == 1000
    assert spark.conf.get(session._CLEANUP, None) == setting
