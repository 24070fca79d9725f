"""Raw JSON text kept for replay: one message per line, read back and parsed again when a schema changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def save_raw(messages: DataFrame, payload: Column | str, path: str) -> None:
    """Land one payload per line. A raw line break in JSON can only stand between its parts, so it becomes a blank."""
    column = F.col(payload) if isinstance(payload, str) else payload
    messages.select(F.regexp_replace(column, "[\\r\\n]", " ").alias("value")).where(F.col("value").isNotNull()).write.mode("overwrite").text(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "raw_payload")


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
