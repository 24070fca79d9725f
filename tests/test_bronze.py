import json

import pytest

from tickloom.operators import bronze
from tickloom.schemas import BRONZE, KAFKA_ENVELOPE
from tickloom.sources import kafka, landing

FULL = {"symbol": "BTCUSDT", "price": 1.5, "quantity": 2.0, "event_time": 1710238272123, "trade_id": "binance:1",
        "source": "binance"}


def without(*names):
    return json.dumps({k: v for k, v in FULL.items() if k not in names})


CASES = {
    "complete": (json.dumps(FULL), []),
    "malformed": ("{oops", ["malformed_json"]),
    "not_an_object": ("3", ["malformed_json"]),
    "no_price": (without("price"), ["missing:price"]),
    "quoted_price": (json.dumps({**FULL, "price": "1.5"}), ["invalid:price"]),
    "numeric_id": (json.dumps({**FULL, "trade_id": 4}), []),
    "no_id": (without("trade_id"), ["missing:trade_id"]),
    "nothing": ("{}", [f"missing:{k}" for k in FULL]),
    "empty": ("", ["empty_payload"]),
    "null": (None, ["empty_payload"]),
}


@pytest.fixture(scope="module")
def parsed(spark, at):
    rows = [(b"k", None if text is None else text.encode(), "crypto-trades-btcusdt", 0, i, at(i))
            for i, (text, _) in enumerate(CASES.values())]
    return bronze.parse_envelope(spark.createDataFrame(rows, KAFKA_ENVELOPE))


def test_reasons(parsed):
    got = {r.kafka_offset: r for r in bronze.message_completeness(parsed).collect()}
    for offset, (name, (_, reasons)) in enumerate(CASES.items()):
        assert got[offset].reasons == reasons, name
        assert got[offset].is_complete == (not reasons), name


def test_admission_rule_is_the_trade_id_alone(parsed):
    admitted = {list(CASES)[r.kafka_offset] for r in bronze.bronze_rows(parsed).collect()}
    assert admitted == {"complete", "no_price", "quoted_price", "numeric_id"}


def test_quarantine_is_the_complement(parsed):
    admitted = {r.kafka_offset for r in bronze.bronze_rows(parsed).collect()}
    rejected = {r.kafka_offset for r in bronze.quarantine_rows(parsed).collect()}
    assert admitted | rejected == set(range(len(CASES))) and not admitted & rejected


def test_bronze_contract_and_values(parsed):
    rows = bronze.bronze_rows(parsed)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in BRONZE]
    row = rows.where("kafka_offset = 0").first()
    assert row.event_time.microsecond == 123000 and row.event_time_ms == FULL["event_time"]
    assert json.loads(row.raw_payload) == FULL


def test_message_is_parsed_once(parsed):
    plan = bronze.bronze_rows(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_landing_replay(spark, parsed, tmp_path):
    landing.save_raw(parsed, "raw_payload", str(tmp_path / "raw"))
    again = bronze.reparse_payloads(landing.read_raw(spark, str(tmp_path / "raw")))
    assert again.count() == bronze.bronze_rows(parsed).count()


def test_dead_letters_keep_the_message_and_its_origin(parsed):
    rejected = bronze.quarantine_rows(parsed)
    rows = kafka.dead_letter_rows(rejected).collect()
    assert len(rows) == rejected.count()
    assert {(r.topic, r.key) for r in rows} == {("crypto-trades-dead-letter", "crypto-trades-btcusdt")}
    by_offset = {json.loads(r.value)["kafka_offset"]: json.loads(r.value) for r in rows}
    malformed = by_offset[list(CASES).index("malformed")]
    assert malformed["raw_payload"] == "{oops" and malformed["reasons"] == ["malformed_json"]
