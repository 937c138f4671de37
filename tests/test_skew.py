"""One series holds nine tenths of the rows; its work must still spread over the tasks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import alerts, indicators, metrics, series
from tidewatch.operators.alerts import Rule


@pytest.fixture(scope="module")
def ticks(spark):
    start = int(dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    at = F.timestamp_micros(F.lit(start) + F.col("id") * 7_300_000)
    return spark.range(0, 40_000).select(
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("symbol"),
        (F.pmod("id", F.lit(17)) + 1.0).alias("price"),
        F.lit(1.0).alias("change_pct"),
        at.alias("event_time"),
    )


def samples(ticks):
    return metrics.gauges(ticks, {"m": "price"}, label="par")


OPERATORS = {
    "moving_average": indicators.moving_average,
    "pump_dump": indicators.pump_dump,
    "grid": lambda t: series.on_grid(samples(t)),
    "rate": lambda t: series.rate(samples(t)),
    "alerts": lambda t: alerts.sustained(
        samples(t), [Rule("r", "m", ">", 9.0, "15 seconds", "info")]),
    "silence": lambda t: alerts.silences(t, limit="7 seconds"),
    "counter": lambda t: metrics.message_counter(
        t.withColumnRenamed("symbol", "topic"), restart="1 hour"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_hot_series_spreads_over_tasks(spark, ticks, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = (
            OPERATORS[name](ticks)
            .groupBy(F.spark_partition_id().alias("task"))
            .count()
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    total = sum(r["count"] for r in sizes)
    assert total > 1000 and len(sizes) == 8
    assert max(r["count"] for r in sizes) < 0.3 * total
