"""Typed messages: validation, routing and a generic flat form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake import fixed_values as fv
from paylake.functions.scalars import rows


def is_legacy() -> Column:
    """A message whose ``detail`` is an object, in the nested event shape."""
    return F.coalesce(F.ltrim("detail").startswith("{"), F.lit(False))


def validate(messages: DataFrame, received_at: str | Column) -> DataFrame:
    """Fill envelope defaults and mark messages of an unknown type.

    Ids are filled where rows come from the source: a recomputed task draws the same ones.
    """
    at = F.lit(received_at) if isinstance(received_at, str) else received_at
    return messages.withColumns({
        "is_valid": F.coalesce(F.col("msg_type").isin(*fv.MESSAGE_TYPES), F.lit(False)) | is_legacy(),
        "schema_version": F.coalesce("schema_version", F.lit(fv.DEFAULT_SCHEMA_VERSION)),
        "message_id": F.coalesce("message_id", F.uuid()),
        "timestamp": F.coalesce("timestamp", at),
        "metadata": F.coalesce("metadata", F.lit("{}")),
    })


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The messages to go on with, and those to set aside."""
    return validated.filter("is_valid"), validated.filter(~F.col("is_valid"))


def classify(messages: DataFrame) -> DataFrame:
    """Message type and Bronze route of each message."""
    kind = F.coalesce("msg_type", F.lit(fv.UNKNOWN_MESSAGE))
    return messages.withColumns({
        "msg_kind": F.when(is_legacy(), "event").otherwise(kind),
        "msg_route": F.when(is_legacy(), fv.LEGACY_ROUTE).otherwise(kind),
    })


def flatten_generic(messages: DataFrame, keep: tuple[str, ...] = (), first_keys: int | None = None) -> DataFrame:
    """Fixed columns, the data as JSON text, and all its scalars as a map, or those among the ``first_keys`` keys.

    A map has room for any key; ``promote`` turns chosen keys into columns.
    """
    # One parse per message: the map and its keys are columns of their own.
    parsed = messages.withColumn("_data", F.from_json("data", "map<string, variant>")).withColumn(
        "_keys", F.map_keys("_data")
    )

    def kept(key: Column, value: Column) -> Column:
        scalar = ~F.coalesce(F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.lit(False))
        return scalar if first_keys is None else scalar & F.array_contains(F.slice("_keys", 1, first_keys), key)

    scalars = F.map_filter(F.col("_data"), kept)
    unknown = F.lit(fv.UNKNOWN_MESSAGE)
    return parsed.select(
        F.coalesce("msg_type", unknown).alias("msg_type"),
        F.coalesce("source", unknown).alias("source"),
        F.coalesce("schema_version", F.lit(fv.DEFAULT_SCHEMA_VERSION)).alias("schema_version"),
        "message_id", "timestamp",
        F.coalesce("data", F.lit("{}")).alias("raw_data"),
        F.transform_values(scalars, lambda _, value: value.cast("string")).alias("data_fields"),
        *keep,
    )


def promote(flat: DataFrame, keys: list[str] | dict[str, str]) -> DataFrame:
    """Add ``data_<key>`` columns; a dict also names their types (unreadable values become null)."""
    types = keys if isinstance(keys, dict) else dict.fromkeys(keys, "string")
    return flat.withColumns({
        f"data_{key}": F.try_element_at("data_fields", F.lit(key)).try_cast(kind) for key, kind in types.items()
    })


def stats(messages: DataFrame) -> DataFrame:
    """Message count per type."""
    return classify(messages).groupBy("msg_kind").agg(rows().alias("n"))


def route_counts(messages: DataFrame) -> DataFrame:
    return classify(messages).groupBy("msg_route").agg(rows().alias("n"))
