"""Health of a streaming query from its checkpoint alone: nothing of the query has to run, or to have kept its reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

STATE_SCHEMA = "operator_id long, operator string, partition_id int, state_rows long, first_due timestamp, last_due timestamp"


def checkpoint_freshness(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row: batches committed, the last one's number, when it was committed, and the seconds since then.

    Read from the listing of the commit log; its files are not opened.
    """
    commits = spark.read.format("binaryFile").load(f"{checkpoint.rstrip('/')}/commits")
    number = F.regexp_extract("path", r"/(\d+)$", 1).try_cast("long")
    numbered = commits.select(number.alias("batch"), "modificationTime").where("batch IS NOT NULL")
    age = F.unix_micros(F.current_timestamp()) - F.unix_micros("last_commit")
    return numbered.agg(
        F.count("*").alias("batches"), F.max("batch").alias("last_batch"),
        F.max("modificationTime").alias("last_commit"),
    ).withColumn("seconds_since", age / 1e6)


def _due(schema: StructType) -> Column:
    """When the state of a row falls due: the end of its window, or the instant at which it expires; else NULL."""
    key, value = schema["key"].dataType, schema["value"].dataType
    if "window" in key.fieldNames():
        return F.col("key.window.end")
    if "expiresAtMicros" in value.fieldNames():
        return F.timestamp_micros("value.expiresAtMicros")
    return F.lit(None).cast("timestamp")


def state_health(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per operator and state partition: rows of state after the last batch, and the first and last instant one is due.

    Partitions without state have a row, too: they show how evenly keys are spread. A first instant far behind the
    watermark tells of state that is not let go. Of an operator with several stores the first one is read. A query
    without state gives no rows.
    """
    operators = spark.read.format("state-metadata").load(checkpoint)
    operators = operators.select("operatorId", "operatorName", "numPartitions").distinct().collect()  # a plan's operators
    report = spark.createDataFrame([], STATE_SCHEMA)
    for operator in sorted(operators):
        state = spark.read.format("statestore").option("operatorId", operator.operatorId).load(checkpoint)
        due = state.select("partition_id", _due(state.schema).alias("due")).groupBy("partition_id").agg(
            F.count("*").alias("state_rows"), F.min("due").alias("first_due"), F.max("due").alias("last_due")
        )
        partitions = spark.range(operator.numPartitions).select(F.col("id").cast("int").alias("partition_id"))
        rows = partitions.join(due, "partition_id", "left").select(
            F.lit(operator.operatorId).cast("long").alias("operator_id"), F.lit(operator.operatorName).alias("operator"),
            "partition_id", F.coalesce("state_rows", F.lit(0)).alias("state_rows"), "first_due", "last_due",
        )
        report = report.unionByName(rows)
    return report
