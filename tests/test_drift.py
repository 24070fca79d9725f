import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickloom.operators import bronze, drift

DAY = dt.datetime(2024, 3, 1, 12)
FULL = {"symbol": "BTCUSDT", "price": 1.5, "quantity": 2.0, "event_time": 1709294400000, "trade_id": "x:1", "source": "x"}


@pytest.fixture
def messages(spark):
    """Messages out of (topic, day, payload) with the payload as text or as what it says."""

    def build(*rows):
        texts = [
            (topic, DAY + dt.timedelta(days=day), p if p is None or isinstance(p, str) else json.dumps(p))
            for topic, day, p in rows
        ]
        raw = spark.createDataFrame(texts, "topic string, kafka_timestamp timestamp, raw_payload string")
        return drift.with_variant(raw)

    return build


def changes(frame):
    rows = drift.field_changes(drift.payload_shapes(frame)).collect()
    return sorted((r.topic, r.day.day, r.field, r.change, r.types_before, r.types_after, r.messages) for r in rows)


def test_fields_appear_vanish_and_change(messages):
    frame = messages(
        ("t", 0, {"a": 1, "b": "x"}), ("t", 0, {"a": 2.5}),
        ("t", 1, {"a": 3e9, "c": True}), ("t", 1, {"a": 12345678901234567890, "c": False}),
        ("t", 2, {"a": "3", "c": True}), ("t", 2, {"a": 3, "c": True}),
    )
    assert changes(frame) == [
        ("t", 2, "b", "vanished", "STRING", None, 0),
        ("t", 2, "c", "appeared", None, "BOOLEAN", 2),
        ("t", 3, "a", "retyped", "NUMBER", "NUMBER|STRING", 2),
    ]


def test_topics_and_gaps_are_their_own(messages):
    frame = messages(("t", 0, {"a": 1}), ("u", 1, {"b": 1}), ("t", 9, {"a": 1}), ("u", 2, {"a": 1}), (None, 0, {"z": 1}),
                     (None, 1, {"y": 1}))
    assert [row[:4] for row in changes(frame.where("topic IS NOT NULL"))] == [
        ("u", 3, "a", "appeared"), ("u", 3, "b", "vanished")]
    rows = drift.field_changes(drift.payload_shapes(frame.where("topic IS NULL"))).collect()
    assert sorted((r.field, r.change) for r in rows) == [("y", "appeared"), ("z", "vanished")]


def test_null_says_nothing_about_the_type(messages):
    frame = messages(("t", 0, {"a": "x"}), ("t", 1, {"a": None}), ("t", 2, {"a": "y"}), ("t", 3, {"a": None}),
                     ("t", 4, {"a": 1}))
    assert changes(frame) == [("t", 5, "a", "retyped", "STRING", "NUMBER", 1)]


def test_a_field_that_comes_back(messages):
    frame = messages(("t", 0, {"a": 1, "k": 1}), ("t", 1, {"k": 1}), ("t", 2, {"a": "1", "k": 1}))
    assert [row[1:6] for row in changes(frame)] == [
        (2, "a", "vanished", "NUMBER", None), (3, "a", "appeared", None, "STRING")]


def test_nested_changes_and_names_like_types(messages):
    frame = messages(("t", 0, {"a": {"BIGINT": 1, "x y": [1, 2]}}), ("t", 1, {"a": {"BIGINT": 1.5, "x y": ["1"]}}))
    assert [row[2:6] for row in changes(frame)] == [
        ("a", "retyped", "OBJECT<BIGINT: NUMBER, `x y`: ARRAY<NUMBER>>", "OBJECT<BIGINT: NUMBER, `x y`: ARRAY<STRING>>")]


def test_unreadable_and_other_payloads(messages):
    frame = messages(("t", 0, {"a": 1}), ("t", 0, '{"a":'), ("t", 0, None), ("t", 0, ""), ("t", 0, '{"a":1,"a":2}'),
                     ("t", 1, "[1]"), ("t", 2, "null"), ("t", 3, "{"))
    shapes = drift.payload_shapes(frame)
    assert sorted((r.day.day, r.messages, r.unreadable) for r in drift.unreadable(shapes).collect()) == [
        (1, 5, 4), (2, 1, 0), (3, 1, 0), (4, 1, 1)]
    assert [row[1:6] for row in changes(frame)] == [
        (2, "$", "appeared", None, "ARRAY<NUMBER>"), (2, "a", "vanished", "NUMBER", None)]


def test_empty_feed(messages, spark):
    frame = messages(("t", 0, {"a": 1})).limit(0)
    assert changes(frame) == []
    assert drift.unreadable(drift.payload_shapes(frame)).count() == 0
    assert drift.replay_with_rest(frame).count() == 0


def test_schema_of_a_day(messages):
    frame = messages(("t", 0, {"a": 1, "b": "x"}), ("t", 0, {"a": 2, "c": True}), ("t", 0, "{"))
    (row,) = drift.payload_schemas(frame).collect()
    assert row.payload_schema == "OBJECT<a: BIGINT, b: STRING, c: BOOLEAN>"


def test_messages_collapse_before_the_shuffle(messages):
    shapes = drift.payload_shapes(messages(("t", 0, {"a": 1})))
    plan = shapes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2


def test_unknown_fields_survive_a_replay(messages, spark, tmp_path):
    extra = {**FULL, "fee": 0.25, "note": {"by": [1, "é", None]}, "flag": None}
    frame = messages(("t", 0, FULL), ("t", 0, extra), ("t", 0, {**FULL, "trade_id": None, "fee": 1}), ("t", 0, '{"trade'),
                     ("t", 0, None), ("t", 0, {**FULL, "price": "7", "fee": "free"}))
    frame.write.parquet(str(tmp_path / "landed"))
    landed = spark.read.parquet(str(tmp_path / "landed"))
    rows = drift.replay_with_rest(landed)
    known = rows.drop("rest").collect()
    assert sorted(map(str, known)) == sorted(map(str, bronze.reparse_payloads(landed).collect()))
    rests = [json.loads(r.r) for r in rows.select(F.to_json("rest").alias("r")).collect()]
    assert sorted(map(str, rests)) == sorted(map(str, [
        {}, {"fee": 0.25, "flag": None, "note": {"by": [1, "é", None]}}, {"fee": "free"}]))
    later = drift.promote(rows, "fee", "double").select("fee", F.to_json("rest").alias("rest")).collect()
    assert sorted(((r.fee, "fee" in r.rest) for r in later), key=str) == [(0.25, False), (None, False), (None, False)]
