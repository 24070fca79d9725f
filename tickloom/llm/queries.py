"""Registered queries of this subpackage: each operator over the whole of its table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import (
    bpe,
    fingerprints,
    minhash,
    packing,
    passages,
    runs,
    sharding,
    simhash,
    spelling,
    token_counts,
    topk,
    toxicity,
    wavelet,
)
from tickloom.llm.common import read_table
from tickloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERY_STEP = 100  # rows of ``embeddings`` whose vec_id it divides are the stated queries of op8


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(read_table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), digests=True)


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(read_table(spark, sf_dir, "documents")).drop("text_key")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.where(F.col("vec_id") % QUERY_STEP == 0), vectors)


def op9_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    wavelet.write_tokens(read_table(spark, sf_dir, "documents"), path)
    return wavelet.read_tokens(spark, path)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of one document in ten repeat with a period from some word on.

    That word and the period follow from crc32 of the doc_id; rows without doc_id stay as they are.
    """
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    chosen = docs.select(
        "doc_id", "text", F.floor(code / 10).alias("rule"), F.when(code % 10 == 0, words).alias("words")
    )
    n = F.size("words")
    placed = chosen.withColumn("first", F.when(n > 0, F.pmod(F.col("rule"), F.greatest(n, F.lit(1)))).cast("int"))
    left = n - F.col("first")
    ruled = placed.withColumn("period", (1 + F.floor(left / (3 + F.col("rule") % 8))).cast("int"))
    unit = F.slice("words", F.col("first") + 1, F.col("period"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(left / F.col("period")).cast("int"))), F.lit(1), left)
    repeated = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("first")), tail), " ")
    return ruled.select("doc_id", F.coalesce(repeated, "text").alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the runs of every document; the longest run, of equal ones the first, then that of least period."""
    found = runs.periodic_runs(with_repeats(read_table(spark, sf_dir, "documents")))
    lines = F.transform(
        "runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    )
    ranks = F.transform("runs", lambda run: F.struct((-run["length"]).alias("less"), run["start"], run["period"]))
    ranked = F.array_min(ranks)
    longest = found.select("doc_id", "runs", "collapsed", ranked.alias("longest"))
    length = -F.col("longest.less")
    return longest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), length.alias("length"),
        F.col("longest.period").alias("period"), F.floor(1000 * length / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


DIVISOR = 199  # of the checksums that plant misspellings


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.word_counts(read_table(spark, sf_dir, "documents"), divisor=DIVISOR))


QUERIES = (
    op1_packing, op2_sharding, op3_minhash, op4_fingerprints, op5_byte_bpe, op6_passages, op7_toxicity,
    op8_top_k, op9_wavelet_tokens, op10_token_counts, op11_runs, op12_simhash, op13_spelling,
)


def registry() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}


OP8_SQL = """
    WITH vectors AS (
        SELECT vec_id, min(list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE)))) AS parts FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        GROUP BY vec_id
    ), scored AS (
        SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.parts, v.parts) AS BIGINT) AS score
        FROM vectors q JOIN vectors v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score
    FROM scored QUALIFY rank <= 10
"""


def statements() -> dict[str, str]:
    return {"op8_top_k": OP8_SQL}
