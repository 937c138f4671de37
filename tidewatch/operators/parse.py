"""Bytes to typed rows, with a reject path instead of all-NULL rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_text(records: DataFrame, value: str = "value", text: str = "json") -> DataFrame:
    """The message bytes as UTF-8 text in column ``text``; the other columns stay."""
    rest = [c for c in records.columns if c != value]
    return records.select(F.col(value).cast("string").alias(text), *rest)


def parse_json(records: DataFrame, schema: T.DataType, text: str = "json") -> DataFrame:
    """Parse ``text`` into the struct (or map) column ``d``.

    Text that is no JSON object gives NULL fields, and so does a single field of the wrong
    type. Names are case-sensitive, unknown ones are ignored.

    The one-element ``explode`` keeps every row and has each text parsed exactly once: a plain
    projection would be copied into each later filter, one parse per field tested.
    """
    return records.withColumn("d", F.explode(F.array(F.from_json(text, schema))))


def flatten(parsed: DataFrame) -> DataFrame:
    return parsed.select("d.*")


def missing_fields(columns: dict[str, Column]) -> Column:
    """Names of the columns that are NULL, as one comma-separated text ("" when complete)."""
    names = [F.when(value.isNull(), F.lit(name)) for name, value in columns.items()]
    return F.concat_ws(",", *names)


def split(
    typed: DataFrame, required: tuple[str, ...], text: str = "json"
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)`` by the presence of the required columns.

    Rejects carry the original text and the names of the missing fields. Both sides are
    filters over one plan; a job that writes both should do so from one persisted batch.
    """
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    valid = typed.where(complete).drop(text)
    missing = missing_fields({c: F.col(c) for c in required})
    rejects = typed.where(~complete).select(F.col(text), missing.alias("missing"))
    return valid, rejects


def read_feed(
    records: DataFrame, schema: T.StructType, required: tuple[str, ...]
) -> tuple[DataFrame, DataFrame]:
    """Normalized JSON records to ``(valid typed rows, rejects)``."""
    typed = parse_json(as_text(records), schema).select("json", "d.*")
    return split(typed, required)
