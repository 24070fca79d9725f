import os
import signal
import threading

import pytest
from pyspark.sql import functions as F

from tickloom.operators import bronze, candles, dedupe, indicators, quality
from tickloom.plans.queries import registry
from tickloom.schemas import GOLD, KAFKA_ENVELOPE, SILVER
from tickloom.sources import kafka, tables
from tickloom.streaming import jobs, runner

SF_DIR = "/root/testdata/sf0.001"
TRADES = "symbol string, price double, quantity double, event_time timestamp, trade_id string"


def trade_rows(at):
    """Four hours of trades of two symbols, a third of them replayed."""
    rows = [("AB"[i % 2], 10.0 + i % 17, float(i % 5), at(i * 37), f"v:{i}") for i in range(400)]
    return rows + rows[::3]


@pytest.fixture
def feed(spark, tmp_path):
    """A folder that takes one file per call, streamed one file per micro-batch."""
    folder = tmp_path / "feed"

    class Feed:
        out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

        def add(self, rows):
            spark.createDataFrame(rows, TRADES).coalesce(1).write.mode("append").parquet(str(folder))

        def stream(self):
            schema = spark.createDataFrame([], TRADES).schema
            return tables.stream_table(spark, str(folder), schema, max_files_per_trigger=1)

        def run(self, transform, **sink):
            query = runner.start_table_sink(transform(self.stream()), self.out, self.checkpoint,
                                            state_partitions=4, **sink)
            return runner.drain(query)

    return Feed()


def in_batches(rows, n):
    size = -(-len(rows) // n)
    return [rows[i: i + size] for i in range(0, len(rows), size)]


def sorted_rows(frame):
    return sorted(map(str, frame.collect()))


def closed_batch_candles(spark, rows, at, newest):
    unique = dedupe.dedupe_batch(spark.createDataFrame(rows, TRADES))
    return candles.closed_candles(candles.ohlcv(unique, "10 minutes"), "2 minutes", newest)


def ordered(at):
    return sorted(trade_rows(at), key=lambda r: r[3])


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_stream_equals_batch_on_closed_windows(spark, feed, at, batches):
    rows = ordered(at)
    for part in in_batches(rows, batches):
        feed.add(part)
    feed.run(lambda s: jobs.candle_stream(s, "10 minutes"))
    got = tables.read_table(spark, feed.out, SILVER)
    expected = closed_batch_candles(spark, rows, at, max(r[3] for r in rows))
    assert got.count() > 0 and sorted_rows(got) == sorted_rows(expected)


def test_restart_from_the_checkpoint(spark, feed, at):
    rows = ordered(at)
    parts = in_batches(rows, 4)
    for part in parts[:2]:
        feed.add(part)
    feed.run(lambda s: jobs.candle_stream(s, "10 minutes"))
    half = tables.read_table(spark, feed.out, SILVER).count()
    for part in parts[2:]:
        feed.add(part)
    feed.run(lambda s: jobs.candle_stream(s, "10 minutes"))
    got = tables.read_table(spark, feed.out, SILVER)
    assert 0 < half < got.count()
    assert sorted_rows(got) == sorted_rows(closed_batch_candles(spark, rows, at, max(r[3] for r in rows)))


@pytest.mark.parametrize("spread", [False, True])
def test_copies_in_later_batches_are_dropped(spark, feed, at, spread):
    rows = [("A", 1.0, 1.0, at(i), f"v:{i}") for i in range(20)]
    feed.add(rows)
    feed.add(rows[5:] + [("A", 1.0, 1.0, at(21), "v:21")])
    by = F.col("event_time") if spread else None
    feed.run(lambda s: dedupe.dedupe_stream(s, "2 minutes", spread_by=by))
    ids = [r.trade_id for r in spark.read.parquet(feed.out).collect()]
    assert sorted(ids) == sorted({f"v:{i}" for i in range(20)} | {"v:21"})


def test_late_rows_are_dropped_and_reported(spark, feed, at):
    feed.add([("A", 1.0, 1.0, at(0), "a"), ("A", 2.0, 1.0, at(3600), "b")])
    feed.run(lambda s: jobs.candle_stream(s, "10 minutes"))
    feed.add([("A", 99.0, 1.0, at(10), "late"), ("A", 3.0, 1.0, at(7200), "c")])
    with runner.recording(spark, feed.out + "-progress") as log:
        log.wait_for(feed.run(lambda s: jobs.candle_stream(s, "10 minutes"), name="late_check"))
    got = {r.window_start: r for r in tables.read_table(spark, feed.out, SILVER).collect()}
    assert got[at(0)].high == 1.0 and got[at(0)].trade_count == 1
    progress = runner.read_progress(spark, feed.out + "-progress")
    assert progress.agg(F.sum("late_rows")).first()[0] == 1
    assert progress.agg(F.sum("input_rows")).first()[0] == 2
    assert {r.query for r in progress.collect()} == {"late_check"}


def test_progress_outlives_the_reports_that_a_query_keeps(spark, feed, at):
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    for i in range(6):
        feed.add([("A", 1.0, 1.0, at(i * 60 + j), f"v:{i}:{j}") for j in range(5)])
    try:
        spark.conf.set(key, 2)
        with runner.recording(spark, feed.out + "-progress") as log:
            log.wait_for(feed.run(lambda s: s, name="many"))
    finally:
        spark.conf.set(key, before)
    progress = runner.read_progress(spark, feed.out + "-progress").where("query = 'many'")
    assert progress.agg(F.sum("input_rows")).first()[0] == 30
    assert progress.where("input_rows > 0").count() == 6


@pytest.mark.parametrize("name", ["stream_bronze", "stream_dedupe"])
def test_registered_streams_read_tables_of_many_files(spark, tmp_path, name):
    for table in ("events",):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").repartition(4).write.parquet(str(tmp_path / f"{table}.parquet"))
    query = registry()[name]
    rows = query(spark, str(tmp_path))
    assert rows.count() > 0 and sorted_rows(rows) == sorted_rows(query(spark, SF_DIR))


def test_bronze_and_quarantine_split_the_feed(spark, tmp_path, at):
    good = '{"symbol":"A","price":1.0,"quantity":2.0,"event_time":1709294400123,"trade_id":"v:%d","source":"v"}'
    rows = [(b"A", (good % i).encode() if i % 4 else b"{oops", "topic-a", 0, i, at(i)) for i in range(40)]
    spark.createDataFrame(rows, KAFKA_ENVELOPE).write.parquet(str(tmp_path / "topic"))
    for start, name in ((jobs.start_bronze, "bronze"), (jobs.start_quarantine, "dead")):
        stream = kafka.replay_stream(spark, str(tmp_path / "topic"), max_files_per_trigger=2)
        runner.drain(start(stream, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")))
    kept = spark.read.parquet(str(tmp_path / "bronze"))
    dead = spark.read.parquet(str(tmp_path / "dead"))
    assert (kept.count(), dead.count()) == (30, 10)
    assert {tuple(r.reasons) for r in dead.collect()} == {("malformed_json",)}
    assert os.listdir(tmp_path / "bronze").count("trade_date=2024-03-01") == 1


def test_layers_end_to_end(spark, tmp_path, at):
    """Envelope files to Bronze, to Silver, to Gold; each layer reads the table of the one before."""
    message = '{"symbol":"A","price":%f,"quantity":1.0,"event_time":%d,"trade_id":"v:%d","source":"v"}'
    rows = [(b"A", (message % (10 + i % 7, 1709294400000 + i * 30000, i)).encode(), "topic-a", 0, i, at(i * 30))
            for i in range(200)]
    spark.createDataFrame(rows, KAFKA_ENVELOPE).write.parquet(str(tmp_path / "topic"))
    path = {n: str(tmp_path / n) for n in ("topic", "bronze", "silver", "gold", "c1", "c2")}
    runner.drain(jobs.start_bronze(kafka.replay_stream(spark, path["topic"]), path["bronze"], path["c1"]))
    schema = spark.read.parquet(path["bronze"]).schema
    runner.drain(jobs.start_silver(tables.stream_table(spark, path["bronze"], schema), path["silver"], path["c2"]))
    jobs.refresh_gold(spark, path["silver"], path["gold"])
    gold = spark.read.parquet(path["gold"])
    silver = spark.read.parquet(path["silver"])
    assert gold.count() == silver.count() == 97
    parity = quality.count_parity(silver, gold).collect()
    assert all(r.is_equal for r in parity)
    pattern = quality.null_pattern(gold).collect()
    assert len(pattern) == 4 and all(r.is_expected for r in pattern)


def test_files_per_batch(spark, feed, at, tmp_path):
    feed.add([("A", 1.0, 1.0, at(i), f"v:{i}") for i in range(100)])
    feed.run(lambda s: s, files_per_batch=3)
    assert spark.read.parquet(feed.out).count() == 100
    assert len([f for f in os.listdir(feed.out) if f.endswith(".parquet")]) == 3


def test_session_options_are_put_back(spark, feed, at):
    key = "spark.sql.streaming.stateStore.providerClass"
    before, partitions = spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")
    feed.add([("A", 1.0, 1.0, at(0), "a")])
    feed.run(lambda s: dedupe.dedupe_stream(s, "2 minutes"))
    assert spark.conf.get(key) == before and spark.conf.get("spark.sql.shuffle.partitions") == partitions


def test_signal_stops_a_continuous_query(spark, feed, at):
    feed.add([("A", 1.0, 1.0, at(0), "a")])
    query = runner.start_table_sink(feed.stream(), feed.out, feed.checkpoint, trigger="1 second")
    timer = threading.Timer(4, os.kill, (os.getpid(), signal.SIGTERM))
    timer.start()
    runner.run_until_signalled(query)
    timer.join()
    assert not query.isActive
    assert signal.getsignal(signal.SIGTERM) == signal.SIG_DFL


def test_console_sink(feed, at):
    feed.add([("A", 1.0, 1.0, at(0), "a"), ("A", 1.0, 1.0, at(1), "b")])
    query = runner.start_console(feed.stream(), "1 second")
    query.processAllAvailable()
    shown = [p for p in query.recentProgress if p["numInputRows"]]
    query.stop()
    assert [p["numInputRows"] for p in shown] == [2]
    assert "Console" in shown[0]["sink"]["description"] and query.exception() is None


def test_completeness_works_on_streams(spark, tmp_path, at):
    rows = [(b"A", b"{oops" if i % 2 else None, "topic-a", 0, i, at(i * 60)) for i in range(30)]
    spark.createDataFrame(rows, KAFKA_ENVELOPE).write.parquet(str(tmp_path / "topic"))
    checked = bronze.message_completeness(bronze.parse_envelope(kafka.replay_stream(spark, str(tmp_path / "topic"))))
    health = quality.feed_health(checked.withWatermark("kafka_timestamp", "1 minute"), "10 minutes")
    runner.drain(runner.start_table_sink(health, str(tmp_path / "out"), str(tmp_path / "checkpoint")))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.messages, r.invalid) for r in got} == {(10, 10)} and len(got) == 2


# ---- Gold by dates ----------------------------------------------------------------------------------------------
@pytest.fixture
def layers(spark, tmp_path, at):
    """Forty days of candles, eight a day, one symbol silent for ten days and one that starts late."""
    rows = []
    for i in range(320):
        for symbol in ("A", "B", "C"):
            if symbol == "B" and 100 <= i < 180 or symbol == "C" and i < 250:
                continue
            close = None if i % 13 == 5 else 100.0 + i % 17
            rows.append((at(i * 10800), at(i * 10800 + 60), symbol, 1.0, 1.0, 1.0, close, 1.0, 1, 1.0, 1.0))
    silver = jobs.dated(spark.createDataFrame(rows, SILVER))

    class Layers:
        path, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
        all = silver

        def add(self, condition):
            tables.append_table(silver.where(condition), self.path, [jobs.CANDLE_DATE])

        def shown(self):
            return sorted_rows(jobs.read_layer(spark, self.gold, GOLD).drop(jobs.CANDLE_DATE))

        def expected(self, condition):
            return sorted_rows(indicators.gold_indicators(silver.where(condition).drop(jobs.CANDLE_DATE), chunk_rows=None))

    return Layers()


def test_extended_gold_equals_a_full_pass(spark, layers):
    steps = ["2024-03-05 09:00:00", "2024-03-20 00:00:00", "2024-03-24 21:30:00", "2025-01-01 00:00:00"]
    low = "2000-01-01 00:00:00"
    for high in steps:
        layers.add((F.col("window_start") >= low) & (F.col("window_start") < high))
        for _ in range(2):
            jobs.extend_gold(spark, layers.path, layers.gold)
            assert layers.shown() == layers.expected(F.col("window_start") < high)
        low = high


def test_extension_does_not_read_old_dates(spark, layers):
    layers.add(F.col("window_start") < "2024-04-05")
    jobs.extend_gold(spark, layers.path, layers.gold)
    # a history that can no longer be read is not missed
    for folder in os.listdir(layers.path):
        if "candle_date=2024-03-02" <= folder <= "candle_date=2024-03-28":
            for name in os.listdir(os.path.join(layers.path, folder)):
                if name.endswith(".parquet"):
                    with open(os.path.join(layers.path, folder, name), "wb") as file:
                        file.write(b"unreadable")
    layers.add(F.col("window_start") >= "2024-04-05")
    jobs.extend_gold(spark, layers.path, layers.gold)
    assert layers.shown() == layers.expected(F.lit(True))


def test_half_written_extension_heals(spark, layers):
    layers.add(F.col("window_start") < "2024-03-20")
    jobs.extend_gold(spark, layers.path, layers.gold)
    layers.add(F.col("window_start") >= "2024-03-20")
    # what a stopped run may leave: some new dates in Gold, wrong or partial, and no counts for them
    wrong = jobs.dated(layers.all.where((F.col("window_start") >= "2024-03-25")).limit(5))
    partial = indicators.gold_indicators(wrong.drop(jobs.CANDLE_DATE), chunk_rows=None)
    tables.append_table(jobs.dated(partial), layers.gold, [jobs.CANDLE_DATE])
    jobs.extend_gold(spark, layers.path, layers.gold)
    assert layers.shown() == layers.expected(F.lit(True))


def test_files_of_an_arrival_grow_with_its_rows(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from tickloom.plans import feeds

    rows = spark.range(100)
    arrival = F.when(F.col("id") < 90, 0).otherwise(1)
    assert feeds.land(rows, arrival, str(tmp_path / "few")) == 4
    monkeypatch.setattr(feeds, "FILE_ROWS", 10)
    assert feeds.land(rows, arrival, str(tmp_path / "many")) == 9
    assert len(list((tmp_path / "many").glob("*.parquet"))) == 18
    assert spark.read.parquet(str(tmp_path / "many")).count() == 100
