"""Payloads whose fields change: kept whole as VARIANT beside the text, compared date by date, replayed without loss.

A table contract finds what a layer lacks; this module finds what the feed itself changed. Text that is no JSON, and
JSON with a field twice, has no variant: such messages count as unreadable and say nothing about fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.functions.scalar import once, utc_date
from tickloom.schemas import TRADE_FIELDS, TRADE_MESSAGE

ROOT = "$"  # the field of a payload that is JSON but no object, an array of coins for instance
# JSON knows one kind of number. How it is stored depends on the digits of a value, so it is no change of the type.
_NUMBER = r"\b(BIGINT|DOUBLE|DECIMAL\(\d+,\d+\))(?=[,>]|$)"
NULL_TYPE = "VOID"


def with_variant(raw: DataFrame) -> DataFrame:
    """The messages with ``payload``: ``raw_payload`` as VARIANT, NULL where it cannot be read."""
    return raw.withColumn("payload", F.try_parse_json("raw_payload"))


def json_type(value: Column) -> Column:
    """Type of a variant, as text: ``NUMBER``, ``STRING``, ``BOOLEAN``, ``ARRAY<...>``, ``OBJECT<...>`` or ``VOID``."""
    return F.regexp_replace(F.schema_of_variant(value), _NUMBER, "NUMBER")


def _fields(payload: Column) -> Column:
    return F.try_variant_get(payload, "$", "map<string,variant>")


def payload_shapes(messages: DataFrame) -> DataFrame:
    """Per topic and date of arrival, each set of fields and types that messages have, and how many have it.

    Needs ``topic``, ``kafka_timestamp`` and ``payload``. ``shape`` is NULL for unreadable messages. Messages collapse to
    their shapes in the map tasks, so what is shuffled depends on the number of shapes and not on that of messages.
    """
    of_object = F.transform(
        F.map_entries(_fields(F.col("payload"))),
        lambda entry: F.struct(entry["key"].alias("field"), json_type(entry["value"]).alias("type")),
    )
    of_other = F.array(F.struct(F.lit(ROOT).alias("field"), json_type(F.col("payload")).alias("type")))
    shape = F.when(F.col("payload").isNotNull(), F.coalesce(of_object, of_other))
    day = utc_date(F.col("kafka_timestamp")).alias("day")
    return messages.select("topic", day, once(shape).alias("shape")).groupBy("topic", "day", "shape").agg(
        F.count("*").alias("messages")
    )


def unreadable(shapes: DataFrame) -> DataFrame:
    """Per topic and date: messages, and those of them that are no readable JSON."""
    return shapes.groupBy("topic", "day").agg(
        F.sum("messages").alias("messages"),
        F.sum(F.when(F.col("shape").isNull(), F.col("messages")).otherwise(0)).alias("unreadable"),
    )


def payload_schemas(messages: DataFrame) -> DataFrame:
    """Per topic and date, the narrowest schema that all its readable payloads fit."""
    day = utc_date(F.col("kafka_timestamp")).alias("day")
    return messages.groupBy("topic", day).agg(F.schema_of_variant_agg("payload").alias("payload_schema"))


def field_changes(shapes: DataFrame) -> DataFrame:
    """Fields that appear, vanish or change type from one date of a topic to the next one with readable messages.

    One row per change: topic, day, field, change (``appeared``, ``vanished`` or ``retyped``), types_before, types_after
    (sorted, joined by a vertical bar), messages (of that day, with the field). The first date of a topic changes
    nothing. A JSON null has no type: a field that is only null on a date keeps the types it had before. A change
    inside a nested object is one of the type of the field that holds it.
    """
    readable = shapes.where(F.col("shape").isNotNull())
    by_day = W.partitionBy("topic").orderBy("day")  # one row per topic and date
    days = readable.select("topic", "day").distinct().select(
        "topic", "day", F.lag("day").over(by_day).alias("day_before"), F.lead("day").over(by_day).alias("day_after")
    )
    typed = readable.select("topic", "day", "messages", F.explode("shape").alias("entry"))
    types = F.array_sort(F.collect_set(F.when(F.col("entry.type") != NULL_TYPE, F.col("entry.type"))))
    fields = typed.groupBy("topic", "day", F.col("entry.field").alias("field")).agg(
        F.sum("messages").alias("messages"), F.array_join(types, "|").alias("seen")
    )
    seen = F.when(F.col("seen") != "", F.col("seen"))
    of_field = W.partitionBy("topic", "field").orderBy("day")  # one row per date
    earlier = of_field.rowsBetween(W.unboundedPreceding, -1)
    followed = fields.join(
        days.select(F.col("topic").alias("_topic"), F.col("day").alias("_day"), "day_before", "day_after"),
        F.col("topic").eqNullSafe(F.col("_topic")) & (F.col("day") == F.col("_day")),
    ).select(
        "topic", "day", "field", "messages", "day_before", "day_after",
        F.lag("day").over(of_field).alias("last_day"),
        F.lead("day").over(of_field).alias("next_day"),
        F.last(seen, ignorenulls=True).over(earlier).alias("types_before"),
        F.coalesce(seen, F.last(seen, ignorenulls=True).over(earlier)).alias("types"),
    )
    nothing = F.lit(None).cast("string")
    kept = F.col("last_day") == F.col("day_before")
    here = (
        F.when(F.col("day_before").isNull(), nothing)
        .when(~F.coalesce(kept, F.lit(False)), F.lit("appeared"))
        .when(F.col("types_before") != F.col("types"), F.lit("retyped"))
    )
    leaves = F.col("day_after").isNotNull() & ~F.coalesce(F.col("next_day") == F.col("day_after"), F.lit(False))
    change = F.struct(
        F.col("day").alias("day"), here.alias("change"),
        F.when(here == "retyped", F.col("types_before")).alias("types_before"), F.col("types").alias("types_after"),
        F.col("messages").alias("messages"),
    )
    gone = F.struct(
        F.col("day_after").alias("day"), F.when(leaves, F.lit("vanished")).alias("change"),
        F.col("types").alias("types_before"), nothing.alias("types_after"), F.lit(0).cast("long").alias("messages"),
    )
    listed = followed.select("topic", "field", F.explode(F.array(change, gone)).alias("found"))
    return listed.where(F.col("found.change").isNotNull()).select("topic", "field", "found.*")


def replay_with_rest(messages: DataFrame) -> DataFrame:
    """Unified messages out of kept payloads, with ``rest``: the fields that the contract does not know, by name.

    The contract's own fields and the admission rule are those of ``bronze.reparse_payloads``. ``rest`` is empty where
    a payload has no other field.
    """
    parsed = once(F.from_json("raw_payload", TRADE_MESSAGE))
    others = F.map_filter(_fields(F.col("payload")), lambda name, _: ~name.isin(*TRADE_FIELDS))
    empty = F.create_map().cast("map<string,variant>")
    rows = messages.select(parsed.alias("t"), F.coalesce(others, empty).alias("rest"))
    return rows.where(F.col("t.trade_id").isNotNull()).select("t.*", "rest")


def promote(rows: DataFrame, field: str, data_type: str) -> DataFrame:
    """A field of ``rest`` as a column of its own, NULL where it is missing or cannot be read as that type."""
    value = F.try_variant_get(F.try_element_at("rest", F.lit(field)), "$", data_type)
    return rows.withColumn(field, value).withColumn("rest", F.map_filter("rest", lambda name, _: name != field))
