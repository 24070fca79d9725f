"""Raw trade table: parse the envelope, admit rows with a trade id, set the others aside with their reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.functions.scalar import event_time_from_millis, once
from tickloom.schemas import BRONZE, TRADE_FIELDS, TRADE_MESSAGE

CORRUPT = "_corrupt_record"
_PARSE_SCHEMA = T.StructType(TRADE_MESSAGE.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def parse_envelope(envelope: DataFrame) -> DataFrame:
    """Envelope metadata under table names, the payload as text, and the parsed message ``t``. Narrow, one parse."""
    payload = F.col("value").cast("string")
    return envelope.select(
        "topic",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        payload.alias("raw_payload"),
        once(F.from_json(payload, _PARSE_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT})).alias("t"),
    )


def bronze_rows(parsed: DataFrame) -> DataFrame:
    """Rows of the raw table: the admission rule is a trade id, nothing else."""
    rows = parsed.where(F.col("t.trade_id").isNotNull()).select(
        "topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "raw_payload",
        F.col("t.symbol").alias("symbol"),
        F.col("t.price").alias("price"),
        F.col("t.quantity").alias("quantity"),
        event_time_from_millis(F.col("t.event_time")).alias("event_time"),
        F.col("t.event_time").alias("event_time_ms"),
        F.col("t.trade_id").alias("trade_id"),
        F.col("t.source").alias("source"),
        F.current_timestamp().alias("ingested_at"),
    )
    return rows.select(*BRONZE.fieldNames())


def reject_reasons():
    """Why a message is incomplete, as an array that is empty for a complete one.

    The corrupt-record column marks broken text and wrong types but neither missing fields nor empty input, so each
    required field is tested as well.
    """
    corrupt = F.col(f"t.{CORRUPT}").isNotNull()
    all_null = F.lit(True)
    for field in TRADE_FIELDS:
        all_null = all_null & F.col(f"t.{field}").isNull()
    per_field = F.array(
        *[
            F.when(F.col(f"t.{f}").isNull(), F.when(corrupt, F.lit(f"invalid:{f}")).otherwise(F.lit(f"missing:{f}")))
            for f in TRADE_FIELDS
        ]
    )
    return (
        F.when(F.col("raw_payload").isNull() | (F.trim("raw_payload") == ""), F.array(F.lit("empty_payload")))
        .when(corrupt & all_null, F.array(F.lit("malformed_json")))
        .otherwise(F.array_compact(per_field))
    )


def message_completeness(parsed: DataFrame) -> DataFrame:
    """Each message with its reasons, its completeness, and whether the admission rule lets it in."""
    reasons = parsed.withColumn("reasons", reject_reasons())
    return reasons.select(
        "topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "raw_payload",
        F.col("t.trade_id").alias("trade_id"),
        "reasons",
        (F.size("reasons") == 0).alias("is_complete"),
        F.col("t.trade_id").isNotNull().alias("is_admitted"),
    )


def quarantine_rows(parsed: DataFrame) -> DataFrame:
    """Exactly the messages the raw table does not take, with their reasons."""
    checked = message_completeness(parsed).where(~F.col("is_admitted"))
    return checked.select("topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "raw_payload", "reasons")


def reparse_payloads(raw: DataFrame) -> DataFrame:
    """Unified messages out of kept payload text, for replay after a schema change."""
    parsed = raw.select(once(F.from_json("raw_payload", TRADE_MESSAGE)).alias("t")).select("t.*")
    return parsed.where(F.col("trade_id").isNotNull())
