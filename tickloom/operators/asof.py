"""Backward as-of join: each row meets the newest row of the other side that is not younger than itself.

Both sides are put in one order by time. A window over a whole key would hold its history in one task, so time is cut into
chunks: within a chunk the last value is carried along by a window, and what stands before the chunk comes from one small
row per chunk, carried across chunks by the same rule with the next larger unit. At the top one row per key and largest
unit is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

UNITS = ("hour", "month")  # a chunk holds one hour's rows of a key, a month's hours, and then the months of a key
_KEY, _TIME, _MINE, _OTHER, _CHUNK = "_key", "_time", "_mine", "_other", "_chunk"


def _carried(left: DataFrame, right: DataFrame, units: Sequence[str], before: bool) -> DataFrame:
    """``left`` (key, time, mine) with ``other``: that of the newest row of ``right`` (key, time, other) up to its time,
    or only ``before`` it. ``right`` has no null keys or times."""
    nothing = F.lit(None)
    left_side = left.select(_KEY, _TIME, _MINE, nothing.cast(right.schema[_OTHER].dataType).alias(_OTHER))
    right_side = right.select(_KEY, _TIME, nothing.cast(left.schema[_MINE].dataType).alias(_MINE), _OTHER)
    # at one instant: those rows first that the others may see, the largest last
    is_left = F.col(_MINE).isNotNull()
    order = [F.col(_TIME), F.when(is_left, F.lit(0 if before else 1)).otherwise(F.lit(1 if before else 0)), F.col(_OTHER)]
    both = left_side.unionByName(right_side)
    keys = [_KEY]
    if units:
        both, keys = both.withColumn(_CHUNK, F.date_trunc(units[0], _TIME)), [_KEY, _CHUNK]
    so_far = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    found = both.withColumn("_found", F.last(_OTHER, ignorenulls=True).over(so_far)).where(is_left)
    if not units:
        return found.select(_KEY, _TIME, _MINE, F.col("_found").alias(_OTHER))
    chunk = F.date_trunc(units[0], _TIME)
    last = right.groupBy(_KEY, chunk.alias(_CHUNK)).agg(F.max(F.struct(_TIME, _OTHER))[_OTHER].alias(_OTHER))
    chunks = left.groupBy(_KEY, chunk.alias(_CHUNK)).agg(F.lit(True).alias(_MINE))
    earlier = _carried(
        chunks.select(_KEY, F.col(_CHUNK).alias(_TIME), _MINE), last.select(_KEY, F.col(_CHUNK).alias(_TIME), _OTHER),
        units[1:], before=True,
    ).select(_KEY, F.col(_TIME).alias(_CHUNK), F.col(_OTHER).alias("_earlier"))
    # rows without a time are in no chunk: they meet nothing
    joined = found.join(earlier, [_KEY, _CHUNK], "left")
    return joined.select(_KEY, _TIME, _MINE, F.coalesce("_found", "_earlier").alias(_OTHER))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    tolerance: Column | None = None,
    units: Sequence[str] = UNITS,
) -> DataFrame:
    """``left`` with ``columns`` of ``right``, from the row of the same ``keys`` with the greatest ``right_time`` that is
    not above ``left_time``; NULL without one, or if it is older than ``tolerance`` (an interval).

    Of several rows of one time that with the largest ``columns`` counts, in their order. Null keys and times match
    nothing. ``units`` (growing, of ``date_trunc``) cut time: rows of one key and smallest unit are ordered in one task,
    so choose one that a task can hold. Each row moves twice, whatever the share of its key.
    """
    clashing = set(columns) & set(left.columns)
    if clashing:
        raise ValueError(f"both sides have {sorted(clashing)}")
    mine = left.select(F.struct(*keys).alias(_KEY), F.col(left_time).alias(_TIME), F.struct(*left.columns).alias(_MINE))
    known = F.col(right_time).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    other = right.where(known).select(
        F.struct(*keys).alias(_KEY), F.col(right_time).alias(_TIME),
        F.struct(F.col(right_time).alias(_TIME), *columns).alias(_OTHER),
    )
    found = _carried(mine, other, units, before=False)
    fresh = F.lit(True) if tolerance is None else F.col(f"{_OTHER}.{_TIME}") >= F.col(_TIME) - tolerance
    return found.select(
        *[F.col(f"{_MINE}.`{c}`").alias(c) for c in left.columns],
        *[F.when(fresh, F.col(f"{_OTHER}.`{c}`")).alias(c) for c in columns],
    )
