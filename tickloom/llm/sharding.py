"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of cells. Every shard has many virtual nodes on it; a row's doc_id hashes to a cell, and its
home is the shard of the next virtual node clockwise. No shard takes more than its share of the rows: what overflows a
full one goes on clockwise to the next shard with room. So counts differ by one at most (the law ``rows``), and only as
many rows leave their home as it is over-full by.

All rows of a cell are told apart by their rank, so the allocation works on counts per cell, whatever the number of
rows: shares of cells are given to shards, and each row finds its shard and slot by its rank within its cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tickloom.llm.common import global_index
from tickloom.session import materialize

SHARDS = 8
CELLS = 4096  # of the ring; bounds the tables of counts and shares
NODES = 64  # virtual nodes of a shard


def ring(spark: SparkSession, shards: int, cells: int = CELLS, nodes: int = NODES) -> DataFrame:
    """For each cell the shards in the order in which they are met clockwise: cell, prefs."""
    points = spark.range(shards * nodes).select(
        F.pmod("id", F.lit(shards)).cast("int").alias("shard"), F.xxhash64("id", F.lit("node")).alias("place")
    )
    owned = points.groupBy(F.pmod("place", F.lit(cells)).alias("at")).agg(F.min_by("shard", "place").alias("shard"))
    nodes_row = owned.agg(F.array_sort(F.collect_list(F.struct("at", "shard"))).alias("ring"))
    clockwise = F.concat(
        F.filter("ring", lambda n: n["at"] >= F.col("cell"))["shard"],
        F.filter("ring", lambda n: n["at"] < F.col("cell"))["shard"],
        F.sequence(F.lit(0), F.lit(shards - 1)),  # a shard whose nodes were all taken comes last
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell")
    return nodes_row.select(every, "ring").select(
        F.col("cell").cast("long").alias("cell"), F.array_distinct(clockwise).alias("prefs")
    )


def shares(counts: DataFrame, shards: int, cells: int = CELLS, nodes: int = NODES) -> DataFrame:
    """Which ranks of a cell go where: cell, first, low, high, shard, base (slot of the rank ``low``).

    ``counts`` (cell, rows, first) has a row per cell that is not empty. Home rows are taken first, in ring order; the
    rest of every over-full home then walks clockwise, cell by cell. At most one row per cell and shard.
    """
    n = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    room = [n // shards + (shard < n % shards) for shard in range(shards)]
    rows = counts.join(ring(counts.sparkSession, shards, cells, nodes), "cell")
    in_order = W.partitionBy("home").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    at_home = (
        rows.withColumn("home", F.col("prefs")[0])
        .withColumn("room", F.get(F.array(*[F.lit(r).cast("long") for r in room]), "home"))
        .withColumn("before", F.coalesce(F.sum("rows").over(in_order), F.lit(0)))
        .withColumn("taken", F.greatest(F.lit(0), F.least("rows", F.col("room") - F.col("before"))).cast("long"))
    )
    at_home = materialize(at_home.select("cell", "first", "rows", "prefs", "home", "taken"), "homes")
    taken = dict(at_home.groupBy("home").agg(F.sum("taken")).collect())  # a number per shard
    free = F.array(*[F.lit(r - taken.get(shard, 0)).cast("long") for shard, r in enumerate(room)])
    rest = at_home.where("rows > taken").agg(
        F.array_sort(F.collect_list(F.struct("cell", "first", "rows", "taken", "prefs"))).alias("rest")
    )
    # one walk over the over-full cells (at most the ring's size), an inner one over the shards clockwise
    walk = """
        aggregate(rest, named_struct('free', free, 'out',
                cast(array() as array<struct<cell: bigint, first: bigint, low: bigint, high: bigint, shard: int>>)),
            (acc, c) -> aggregate(c.prefs, named_struct('free', acc.free, 'out', acc.out, 'low', c.taken),
                (a, s) -> named_struct(
                    'free', transform(a.free, (f, i) -> f - if(i = s, least(f, c.rows - a.low), 0L)),
                    'out', if(least(a.free[s], c.rows - a.low) > 0, concat(a.out, array(named_struct(
                        'cell', c.cell, 'first', c.first, 'low', a.low,
                        'high', a.low + least(a.free[s], c.rows - a.low), 'shard', s))), a.out),
                    'low', a.low + least(a.free[s], c.rows - a.low)),
                a -> named_struct('free', a.free, 'out', a.out)),
            acc -> acc.out)
    """
    moved = rest.withColumn("free", free).select(F.explode(F.expr(walk)).alias("s")).select("s.*")
    homes = at_home.where("taken > 0").select(
        "cell", "first", F.lit(0).cast("long").alias("low"), F.col("taken").alias("high"), F.col("home").alias("shard")
    )
    length = F.col("high") - F.col("low")
    base = F.sum(length).over(W.partitionBy("shard").orderBy("cell", "low")) - length
    return homes.unionByName(moved).withColumn("base", base)


def shard(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS, nodes: int = NODES) -> DataFrame:
    """Per row: doc_id, size (bytes plus 1), text_crc32, law, shard, slot, grown_shard (null under this law).

    A null text has no bytes; rows without doc_id share a cell. Rows of one doc_id are ordered by checksum and size, so
    a doc_id that repeats often is split by rank like any other. Fewer rows than shards leave some empty.
    """
    text = F.col("text")
    keyed = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id"), F.lit(cells)).alias("cell"),
        F.monotonically_increasing_id().alias("row"),
    )
    stored = materialize(keyed, "keyed")  # the texts are read once
    ranked = global_index(stored, ["cell", "doc_id", "text_crc32", "size", "row"], "index")
    counts = ranked.groupBy("cell").agg(F.count("*").alias("rows"), F.min("index").alias("first"))
    given = materialize(shares(counts, shards, cells, nodes), "shares")
    rank = F.col("index") - F.col("first")
    placed = ranked.join(F.broadcast(given), "cell").where((rank >= F.col("low")) & (rank < F.col("high")))
    return placed.select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("base") + rank - F.col("low")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
