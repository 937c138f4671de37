"""Columns every feed gets before it is analysed or stored."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stamp(
    rows: DataFrame, event_time: Column | None = None, symbol: str | None = "symbol"
) -> DataFrame:
    """Add ``event_time``, the partition date ``fecha`` and the partition symbol ``par``.

    ``event_time`` defaults to the arrival time; pass the feed's own time to make replays
    repeatable. ``symbol=None`` is for the feed that has none.
    """
    time = F.current_timestamp() if event_time is None else event_time
    out = rows.withColumn("event_time", time)
    out = out.withColumn("fecha", F.to_date("event_time"))
    return out if symbol is None else out.withColumn("par", F.col(symbol))
