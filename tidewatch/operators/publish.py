"""Typed rows to keyed messages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_text(fields: list) -> Column:
    """The fields as one JSON object; NULLs are written, so that every name is there."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def encode(
    rows: DataFrame, fields: list[str], *, key: Column | None, topic: Column | str = "topic"
) -> DataFrame:
    """``(topic, key, value)``: the named fields as JSON bytes, the key as UTF-8 or NULL."""
    name = F.col(topic) if isinstance(topic, str) else topic
    key_text = F.lit(None) if key is None else key
    return rows.select(
        name.alias("topic"),
        key_text.cast("string").cast("binary").alias("key"),
        json_text(fields).cast("binary").alias("value"),
    )
