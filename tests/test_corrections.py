"""Corrections that reach Gold, digest trees, as-of joins, and one feed for several tables."""

import contextlib
import datetime as dt
import io
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tickloom.operators import candles, dedupe, digests, indicators, quality, signals
from tickloom.operators.asof import asof_join
from tickloom.plans import feeds, queries
from tickloom.schemas import BRONZE, GOLD, KAFKA_ENVELOPE, QUARANTINE, SILVER, TRADE_FIELDS, WATERMARK
from tickloom.sources import tables
from tickloom.streaming import health, jobs, runner

SF_DIR = "/root/testdata/sf0.001"


def sorted_rows(frame):
    return sorted(map(str, frame.collect()))


def spoil(path, keep):
    """Make the files of all partitions but those of ``keep`` (folder names) unreadable."""
    for folder, _, names in os.walk(path):
        if "=" in folder and not any(part in keep for part in folder.split(os.sep)):
            for name in names:
                if name.endswith(".parquet"):
                    with open(os.path.join(folder, name), "wb") as file:
                        file.write(b"unreadable")


# ---- corrections ------------------------------------------------------------------------------------------------
@pytest.fixture
def layers(spark, tmp_path, at):
    """Forty days of candles, eight a day, one symbol silent for ten days and one that starts late."""
    rows = {}
    for i in range(320):
        for symbol in ("A", "B", "C", None):
            if symbol == "B" and 100 <= i < 180 or symbol == "C" and i < 250:
                continue
            close = None if i % 13 == 5 else 100.0 + i % 17
            rows[symbol, i] = (at(i * 10800), at(i * 10800 + 60), symbol, 1.0, 1.0, 1.0, close, 1.0, 1, 1.0, 1.0)

    class Layers:
        path, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
        truth = dict(rows)

        def frame(self, some):
            return spark.createDataFrame(list(some), SILVER)

        def begin(self, without=()):
            stored = [row for key, row in self.truth.items() if key not in without]
            tables.append_table(jobs.dated(self.frame(stored)), self.path, [jobs.CANDLE_DATE])
            jobs.refresh_gold(spark, self.path, self.gold)

        def correct(self, changes):
            """``changes``: (symbol, number) to close, or None to add the candle as it is."""
            for key, close in changes.items():
                if close is not None:
                    row = self.truth[key]
                    self.truth[key] = (*row[:6], close, *row[7:])
            jobs.correct_candles(spark, self.frame(self.truth[key] for key in changes), self.path)

        def shown(self):
            return sorted_rows(jobs.read_layer(spark, self.gold, GOLD).drop(jobs.CANDLE_DATE))

        def expected(self):
            return sorted_rows(indicators.gold_indicators(self.frame(self.truth.values()), chunk_rows=None))

    return Layers()


@pytest.mark.parametrize("changes", [
    {("A", 150): 90.0},
    {("A", 2): 90.0, ("A", 300): 91.0},  # within the warm-up, and near the end
    {("B", 99): 90.0, ("B", 181): 92.0},  # on both sides of a gap
    {("C", 250): 1.0, ("B", 0): 2.0},
    {("A", 319): 7.0},
])
def test_corrected_gold_equals_a_full_pass(spark, layers, changes):
    layers.begin()
    layers.correct(changes)
    assert layers.shown() != layers.expected()
    for _ in range(2):
        jobs.correct_gold(spark, layers.path, layers.gold, chunk_rows=64)
        assert layers.shown() == layers.expected()
        layers.correct(changes)  # the same again changes nothing


def test_late_candles_move_the_count_of_those_after(spark, layers):
    late = [("A", 3), ("A", 4), ("A", 5), ("B", 185)]
    layers.begin(without=late)
    layers.correct({key: None for key in late})
    jobs.correct_gold(spark, layers.path, layers.gold)
    assert layers.shown() == layers.expected()


def test_corrections_after_one_another_and_an_extension(spark, layers, at):
    layers.begin()
    layers.correct({("A", 100): 90.0})
    layers.correct({("A", 100): 80.0, ("A", 110): 81.0})
    newer = {("A", i): (at(i * 10800), at(i * 10800 + 60), "A", 1.0, 1.0, 1.0, 9.0 + i % 5, 1.0, 1, 1.0, 1.0) for i in (320, 321)}
    layers.truth |= newer
    tables.append_table(jobs.dated(layers.frame(newer.values())), layers.path, [jobs.CANDLE_DATE])
    jobs.extend_gold(spark, layers.path, layers.gold)
    jobs.correct_gold(spark, layers.path, layers.gold)
    assert layers.shown() == layers.expected()


def test_corrections_read_no_untouched_date(spark, layers, at):
    layers.begin()
    expected_dates = {f"candle_date={at(i * 10800).date() + dt.timedelta(days=d)}" for i in (150,) for d in range(-6, 7)}
    layers.correct({("A", 150): 90.0})
    expected = layers.expected()
    kept = {str(row.day) for row in jobs.read_layer(spark, layers.gold, GOLD).select(F.col("candle_date").alias("day")).distinct().collect()}
    gold_before = {d: sorted_rows(jobs.read_layer(spark, layers.gold, GOLD).where(F.col("candle_date") == d)) for d in kept}
    spoil(layers.path, expected_dates)
    jobs.correct_gold(spark, layers.path, layers.gold)
    assert layers.shown() == expected
    gold = jobs.read_layer(spark, layers.gold, GOLD)
    changed = {d for d in kept if sorted_rows(gold.where(F.col("candle_date") == d)) != gold_before[d]}
    assert changed and {f"candle_date={d}" for d in changed} <= expected_dates


def test_half_done_corrections_are_done_again(spark, layers, monkeypatch):
    layers.begin()
    layers.correct({("A", 150): 90.0})
    replace, calls = jobs._replace_dates, []

    def fail_after_gold(rows, path, fmt):
        if calls:
            raise OSError("stopped")
        calls.append(path)
        replace(rows, path, fmt)

    monkeypatch.setattr(jobs, "_replace_dates", fail_after_gold)
    with pytest.raises(OSError):
        jobs.correct_gold(spark, layers.path, layers.gold)
    monkeypatch.setattr(jobs, "_replace_dates", replace)
    jobs.correct_gold(spark, layers.path, layers.gold)
    assert layers.shown() == layers.expected()


def test_a_correction_without_symbol_is_left_out(spark, layers):
    layers.begin()
    before = layers.shown()
    jobs.correct_candles(spark, layers.frame([layers.truth[None, 3]]), layers.path)
    jobs.correct_gold(spark, layers.path, layers.gold)
    assert layers.shown() == before


# ---- one read for two tables -------------------------------------------------------------------------------------
def envelopes(at, n):
    rows = []
    for i in range(n):
        text = f'{{"symbol":"A","price":{i}.5,"quantity":1.0,"event_time":{int(at(i).timestamp()) * 1000},"trade_id":"x:{i}","source":"v"}}'
        value = [text, text[:-9], None, '{"symbol":"A"}'][0 if i % 3 else i % 4]
        rows.append((b"A", None if value is None else value.encode(), "t", 0, i, at(i)))
    return rows


def test_a_run_that_stops_between_two_writes(spark, tmp_path, at, monkeypatch):
    folder, path, rejected, checkpoint = (str(tmp_path / n) for n in ("feed", "bronze", "quarantine", "checkpoint"))
    rows = envelopes(at, 90)
    for part in (rows[:30], rows[30:60], rows[60:]):
        spark.createDataFrame(part, KAFKA_ENVELOPE).coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = tables.stream_table(spark, folder, KAFKA_ENVELOPE, max_files_per_trigger=1)
        return runner.drain(jobs.start_bronze_and_quarantine(stream, path, rejected, checkpoint))

    replace = jobs.replace_batch

    def fail(frame, where, batch_id, *args, **kwargs):
        if where == rejected and batch_id == 1:
            raise OSError("stopped between the writes")
        replace(frame, where, batch_id, *args, **kwargs)

    monkeypatch.setattr(jobs, "replace_batch", fail)
    with pytest.raises(Exception, match="stopped between"):
        run()
    monkeypatch.setattr(jobs, "replace_batch", replace)
    query = run()
    kept = jobs.read_batches(spark, path, BRONZE, jobs.TRADE_DATE).collect()
    apart = jobs.read_batches(spark, rejected, QUARANTINE).collect()
    assert sorted([r.kafka_offset for r in kept] + [r.kafka_offset for r in apart]) == list(range(90))
    assert all(r.trade_id for r in kept) and all(r.reasons for r in apart)
    assert {r.batch for r in kept} == {0, 1, 2}
    assert sum(p.numInputRows for p in query.recentProgress) == 60  # of the second run: each batch is read once


def forget(checkpoint, batch):
    """As if the run had stopped before the batch was committed."""
    for name in (f"{batch}", f".{batch}.crc"):
        os.remove(checkpoint / "commits" / name)


def test_late_trades_are_as_many_as_the_engine_counts(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("in-time", "late", "newest", "checkpoint")]
    trades = queries._trade_stream(spark, SF_DIR, late=True).select(*TRADE_FIELDS)
    runner.drain(jobs.start_trades_and_late(trades, *paths))
    late = spark.read.parquet(paths[1])
    log_path = str(tmp_path / "progress")
    with runner.recording(spark, log_path) as log:
        again = queries._trade_stream(spark, SF_DIR, late=True).select(*TRADE_FIELDS)
        unique = dedupe.dedupe_stream(again, WATERMARK)
        sink = {"path": str(tmp_path / "unique"), "checkpoint": str(tmp_path / "unique-checkpoint")}
        log.wait_for(runner.drain(runner.start_table_sink(unique, state_partitions=4, **sink)))
    counted = runner.read_progress(spark, log_path).agg(F.sum("late_rows")).first()[0]
    in_time = jobs.read_batches(spark, paths[0], trades.schema, jobs.TRADE_DATE).count()
    assert late.count() == counted > 0
    assert late.count() + in_time == feeds.trades(spark, SF_DIR).count()
    assert late.where("delay_seconds < 0").isEmpty()


def test_a_repeated_batch_of_late_trades_finds_the_same_limit(spark, tmp_path, at):
    """A batch whose tables were written, but not committed, gives the same rows again."""
    folder, checkpoint = str(tmp_path / "feed"), tmp_path / "checkpoint"
    paths = [str(tmp_path / n) for n in ("in-time", "late", "newest")]
    schema = "trade_id string, event_time timestamp"
    for part in ([("a", at(0)), ("b", at(600))], [("c", at(100)), ("d", at(900)), ("e", None)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = tables.stream_table(spark, folder, spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
        runner.drain(jobs.start_trades_and_late(stream, *paths, str(checkpoint)))
        return sorted_rows(spark.read.parquet(paths[0])), sorted_rows(spark.read.parquet(paths[1]))

    first = run()
    forget(checkpoint, 1)
    assert run() == first
    assert [r.trade_id for r in spark.read.parquet(paths[1]).collect()] == ["c"]


def test_a_live_board_follows_each_batch(spark, tmp_path, at):
    folder, path, checkpoint = str(tmp_path / "feed"), str(tmp_path / "live"), tmp_path / "checkpoint"
    schema = "symbol string, price double, quantity double, event_time timestamp, trade_id string"
    rows = [("AB"[i % 2], 10.0 + i % 17, 1.0 + i % 5, at(i * 37), f"v:{i}") for i in range(300)]
    for n in range(3):
        spark.createDataFrame(rows[n * 100 : n * 100 + 100], schema).coalesce(1).write.mode("append").parquet(folder)

        def run():
            stream = tables.stream_table(spark, folder, spark.createDataFrame([], schema).schema)
            runner.drain(jobs.start_live_candles(stream, path, str(checkpoint), "10 minutes", state_partitions=2))
            return sorted_rows(jobs.read_layer(spark, path, SILVER).drop(jobs.CANDLE_DATE))

        whole = candles.ohlcv(spark.createDataFrame(rows[: n * 100 + 100], schema), "10 minutes")
        assert run() == sorted_rows(whole)
    last = max(int(name) for name in os.listdir(checkpoint / "commits") if name.isdigit())
    forget(checkpoint, last)
    assert run() == sorted_rows(whole)
    board = signals.price_board(jobs.read_layer(spark, path, SILVER), "UTC")
    assert sorted_rows(board) == sorted_rows(signals.price_board(whole, "UTC"))


# ---- digest trees ------------------------------------------------------------------------------------------------
@pytest.fixture
def recorded(spark, tmp_path, at):
    """Raw trades with replays across midnight and their candles, by date, over three months."""
    rows = []
    for i in range(900):
        time = at(i * 8640 - 30)
        rows.append(("AB"[i % 2], 10.0 + i % 17, 0.1 * (i % 7), time, f"v:{i}"))
        if i % 4 == 0:
            rows.append(("AB"[i % 2], 99.0, 0.1, time + dt.timedelta(seconds=60), f"v:{i}"))
    schema = "symbol string, price double, quantity double, event_time timestamp, trade_id string"
    trades = spark.createDataFrame(rows, schema)

    class Recorded:
        bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
        trees = str(tmp_path / "bronze-tree"), str(tmp_path / "silver-tree")
        candles = candles.ohlcv(dedupe.dedupe_batch(trades), "1 hour")

        def store(self, silver):
            dated = trades.withColumn("trade_date", F.to_date("event_time"))
            tables.append_table(dated, self.bronze, ["trade_date"])
            tables.append_table(jobs.dated(silver), self.silver, [jobs.CANDLE_DATE])
            digests.record_digests(self.candles, self.trees[0])
            digests.record_digests(spark.read.parquet(self.silver), self.trees[1])

        def tables(self):
            return spark.read.parquet(self.bronze), spark.read.parquet(self.silver)

        def differences(self, frames=None):
            frames = frames or self.tables()
            return digests.reconcile_by_digests(*frames, *self.trees, "1 hour")

        def expected(self, silver):
            return sorted_rows(quality.reconcile_candles(trades, silver, "1 hour").where("status <> 'equal'"))

    return Recorded()


def test_equal_layers_have_no_differences(recorded):
    recorded.store(recorded.candles)
    assert recorded.differences().collect() == []


def test_differences_are_found_and_other_dates_not_read(spark, recorded):
    silver = recorded.candles.where("NOT (symbol = 'B' AND window_start BETWEEN '2024-03-20 10:00' AND '2024-03-20 20:00')")
    silver = silver.withColumn("volume", F.when(F.to_date("window_start") == "2024-04-10", F.col("volume") + 1e-3).otherwise(F.col("volume")))
    extra = silver.limit(1).withColumns({"window_start": F.lit("2024-07-01 00:00:00").cast("timestamp"), "symbol": F.lit("Z")})
    silver = silver.unionByName(extra)
    recorded.store(silver)
    expected = recorded.expected(silver)
    assert len(expected) > 5
    frames = recorded.tables()
    dates = ("2024-03-19", "2024-03-20", "2024-04-09", "2024-04-10", "2024-06-30", "2024-07-01")
    spoil(recorded.bronze, {f"trade_date={d}" for d in dates})
    spoil(recorded.silver, {f"candle_date={d}" for d in dates})
    for tree in recorded.trees:  # of months that agree, the dates are not read either
        spoil(os.path.join(tree, "dates"), {"month=2024-03-01", "month=2024-04-01", "month=2024-07-01"})
    assert sorted_rows(recorded.differences(frames)) == expected


def test_digests_do_not_depend_on_the_order_of_sums(spark, at):
    rows = [("A", at(i), 1.0, 1.0, 1.0, 1.0, v, 3) for i, v in enumerate((0.1 + 0.2 + 0.3, 0.3 + 0.2 + 0.1))]
    schema = "symbol string, window_start timestamp, open double, high double, low double, close double, volume double, trade_count long"
    def digest(volume):
        frame = spark.createDataFrame([rows[0][:6] + (volume, 3)], schema)
        return digests.candle_digests(frame).first().digest
    assert rows[0][6] != rows[1][6] and digest(rows[0][6]) == digest(rows[1][6]) != digest(0.6001)


def test_a_date_is_recorded_again(spark, recorded):
    wrong = recorded.candles.withColumn("close", F.when(F.to_date("window_start") == "2024-04-10", 0.0).otherwise(F.col("close")))
    recorded.store(wrong)
    assert recorded.differences().select(F.to_date("window_start")).distinct().count() == 1
    day = recorded.candles.where(F.to_date("window_start") == "2024-04-10")
    digests.record_digests(day, recorded.trees[1])
    found = digests.differing_dates(spark, *recorded.trees)
    assert found.collect() == []


# ---- as-of joins -------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("units", [(), ("day",), ("hour", "month"), ("hour", "day", "year")])
def test_asof_join_equals_brute_force(spark, units):
    rng = random.Random(1)

    def time():
        return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(0, 144_000, 30)) if rng.random() < 0.97 else None

    left = [(rng.choice(["a", "b", "c", None]), time(), i) for i in range(300)]
    right = [(rng.choice(["a", "b", None]), time(), i) for i in range(120)]
    frames = spark.createDataFrame(left, "k string, t timestamp, i int"), spark.createDataFrame(right, "k string, rt timestamp, v int")
    for days in (None, 3):
        oldest = None if days is None else F.expr(f"INTERVAL {days} DAYS")
        joined = asof_join(*frames, ["k"], "t", "rt", ["v", "rt"], oldest, units)
        got = {row.i: (row.rt, row.v) for row in joined.collect()}
        assert len(got) == len(left)
        for k, t, i in left:
            best = max(((rt, v) for key, rt, v in right if k is not None and key == k and rt and t and rt <= t), default=(None, None))
            if best[0] and days and best[0] < t - dt.timedelta(days=days):
                best = (None, None)
            assert got[i] == best
    assert asof_join(frames[0], frames[1].limit(0), ["k"], "t", "rt", ["v"], units=units).where("v IS NOT NULL").isEmpty()
    assert asof_join(frames[0].limit(0), frames[1], ["k"], "t", "rt", ["v"], units=units).isEmpty()
    with pytest.raises(ValueError):
        asof_join(frames[0], frames[1], ["k"], "t", "rt", ["k"])


def test_no_task_of_an_asof_join_gets_a_hot_key(spark):
    """Rows meet by key and chunk; what is ordered by the key alone is one row per month."""
    left = spark.range(5000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 3600).alias("t"))
    right = left.withColumnRenamed("t", "rt").withColumn("v", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as shown:
            asof_join(left, right, ["k"], "t", "rt", ["v"]).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    windows = re.findall(r"Window\nInput.*\nArguments: .*?, \[(.*?)\], \[", shown.getvalue())
    assert len(windows) == 3
    by_key = [w for w in windows if "_chunk" not in w]
    assert len(by_key) == 1
    months = asof_join(left, right, ["k"], "t", "rt", ["v"])
    assert months.where("v IS NULL").isEmpty() and months.count() == 5000


# ---- health from the checkpoint, percentiles ---------------------------------------------------------------------
def test_state_and_freshness_of_a_checkpoint(spark, tmp_path, at):
    folder, checkpoint = str(tmp_path / "feed"), str(tmp_path / "checkpoint")
    schema = "symbol string, price double, quantity double, event_time timestamp, trade_id string"
    for n in range(3):
        rows = [("AB"[i % 2], 1.0, 1.0, at(n * 3600 + i * 60), f"v:{n}:{i}") for i in range(50)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = tables.stream_table(spark, folder, spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
    before = dt.datetime.now()
    query = runner.drain(jobs.start_silver(stream, str(tmp_path / "out"), checkpoint, "10 minutes", state_partitions=4))
    rows = health.state_health(spark, checkpoint).collect()
    assert len(rows) == 8  # two operators of four partitions
    watermark = at(2 * 3600 + 49 * 60) - dt.timedelta(minutes=2)
    by_operator = {}
    for row in rows:
        by_operator[row.operator] = by_operator.get(row.operator, 0) + row.state_rows
        assert (row.first_due is None) == (row.state_rows == 0)
        assert row.first_due is None or watermark < row.first_due <= row.last_due
    last = {s.operatorName: s.numRowsTotal for s in query.lastProgress.stateOperators}
    assert by_operator == last and sum(last.values()) > 0
    fresh = health.checkpoint_freshness(spark, checkpoint).first()
    assert fresh.batches == fresh.last_batch + 1 >= 3
    assert before - dt.timedelta(seconds=2) <= fresh.last_commit and 0 <= fresh.seconds_since < 600


def test_percentiles_of_merged_days(spark, at):
    rng = random.Random(6)
    values = [("ab"[i % 2], at(0).date() + dt.timedelta(days=i % 5), rng.lognormvariate(0, 2) + i % 5) for i in range(20_000)]
    frame = spark.createDataFrame([*values, ("a", None, None)], "topic string, day date, value double")
    sketches = quality.daily_sketches(frame)
    assert sketches.count() == 10
    found = quality.percentiles(sketches, (0.1, 0.5, 0.99))
    assert {(r.topic, r.rank, r.n_values) for r in found.collect()} == {(t, q, 10_000) for t in "ab" for q in (0.1, 0.5, 0.99)}
    for row in found.collect():
        own = sorted(v for t, _, v in values if t == row.topic)
        share = sum(v <= row.value for v in own) / len(own)
        assert abs(share - row.rank) <= quality.RANK_ERROR + 1e-4
    assert all(r.rank_error <= quality.RANK_ERROR for r in quality.rank_errors(frame, found).collect())
