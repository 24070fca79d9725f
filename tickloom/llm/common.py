"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tickloom.session import materialize

# What a broadcast may hold. A table is broadcast by hint only after its rows were counted against this.
BROADCAST_BYTES = 32 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``; a null text counts as empty. Other columns cannot clash with an operator's own."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name = "_" + name
    return name


def small_enough(df: DataFrame, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a stored frame fits into a broadcast, by its row count."""
    return df.count() * bytes_per_row <= limit


def keep_ids(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is in (``left_anti``: not in) the stored frame ``ids``.

    A list of ids under ``BROADCAST_BYTES`` is sent to the texts; a longer one meets them in a shuffled join.
    """
    ids = ids.select("doc_id")
    return docs.join(F.broadcast(ids) if small_enough(ids, 64) else ids, "doc_id", how)


def global_index(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Number all rows from 0 in the given order, without gaps and without a single task for all rows.

    Rows are dealt by range and sorted within their partitions; the stored positions plus the sum of the sizes of the
    partitions before (one small row each) make the index.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(placed.withColumn("_place", F.monotonically_increasing_id()), "indexed")
    part = F.shiftright("_place", 33).alias("_part")
    sizes = stored.groupBy(part).agg(F.count("*").alias("_rows"))
    bases = sizes.select("_part", (F.sum("_rows").over(W.orderBy("_part")) - F.col("_rows")).alias("_base"))
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    indexed = stored.select("*", part).join(bases, "_part")
    return indexed.withColumn(name, F.col("_base") + within).drop("_part", "_base", "_place")


def documents_of(batches: Iterable[pa.RecordBatch], size: int = 256) -> Iterator[tuple[list, list[str]]]:
    """The ids and texts of Arrow batches in groups of ``size`` rows, so that a task holds few Python texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            part = batch.slice(start, size)
            yield part.column("doc_id").to_pylist(), part.column("text").to_pylist()
