"""Broker topics as streaming or batch frames, and keyed publishing.

The connector is a separate artifact of Spark. Only these thin adapters need it: everything after them works on the
envelope columns ``key, value, topic, partition, offset, timestamp``, which ``replay_stream`` also gives from files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.scalar import topic_of
from tickloom.schemas import DEAD_LETTER_TOPIC, KAFKA_ENVELOPE, TRADE_FIELDS


def source_options(
    servers: str,
    topics: Sequence[str] | None = None,
    pattern: str | None = None,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the topic scan: an explicit list or a pattern, start position, loss policy and admission control.

    By default nothing is left out: a stream starts at the earliest offset, fails when messages are gone before it has
    read them, and takes all that is there. A cap per trigger must exceed the rate of the feed, or the stream falls
    behind until the broker deletes what it has not read.

    ``min_partitions`` splits busy topic partitions over more tasks. A topic keyed by symbol keeps one symbol on one
    topic partition, so without it a hot symbol is read by a single task.
    """
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or pattern")
    options = {
        "kafka.bootstrap.servers": servers,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if topics is not None:
        options["subscribe"] = ",".join(topics)
    else:
        options["subscribePattern"] = pattern
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic_stream(spark: SparkSession, servers: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(servers, **options)).load()


def read_topic_batch(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Bounded read of the same topics, for backfills; reads from the earliest offset unless told otherwise."""
    return spark.read.format("kafka").options(**source_options(servers, **options)).load()


def replay_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Envelope rows kept as Parquet files, streamed with the columns of the topic scan."""
    reader = spark.readStream.schema(KAFKA_ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def publish_rows(trades: DataFrame) -> DataFrame:
    """Trades as rows to publish: topic from the symbol, key = symbol, value = JSON of the unified message."""
    return trades.select(
        topic_of(F.col("symbol")).alias("topic"),
        F.col("symbol").alias("key"),
        F.to_json(F.struct(*TRADE_FIELDS)).alias("value"),
    )


def dead_letter_rows(rejected: DataFrame) -> DataFrame:
    """Quarantined messages as rows to publish: where each came from, its payload as it was, and the reasons."""
    value = F.struct("topic", "kafka_partition", "kafka_offset", "raw_payload", "reasons")
    return rejected.select(
        F.lit(DEAD_LETTER_TOPIC).alias("topic"), F.col("topic").alias("key"), F.to_json(value).alias("value")
    )


def publish(rows: DataFrame, servers: str) -> None:
    """Send rows of ``topic, key, value``; every in-sync replica must have taken them."""
    writer = rows.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("kafka.acks", "all").save()
