"""Ordered work on metric series: evaluation grid and counter rates.

A series is ``(metric, labels)``; there may be few of them and one may hold most samples, so
no step here orders a whole series in one task. Work is split into time slices per series,
and a slice gets copies of just those neighbouring entries (minutes' worth) that its results
depend on. Samples are reduced on the map side first, so copies and bursts do not pile up.

Samples are ``(metric, labels, ts, value)`` with at most one value per series and time; exact
copies do no harm. ``distinct_samples`` settles feeds that contradict themselves.
"""

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import values as V
from ..functions import at_micros, ceil_to, epoch_micros, floor_to, micros

SERIES = ("metric", "labels")
SLICE = "1 hour"


def keyed(samples: DataFrame) -> DataFrame:
    """Labels as sorted entries, which group, join and hash; time as microseconds."""
    return samples.where(F.col("ts").isNotNull() & F.col("value").isNotNull()).select(
        "metric",
        F.sort_array(F.map_entries("labels")).alias("labels"),
        epoch_micros(F.col("ts")).alias("us"),
        "value",
    )


def distinct_samples(samples: DataFrame) -> DataFrame:
    """One sample per series and time: the largest value."""
    kept = keyed(samples).groupBy(*SERIES, "us").agg(F.max("value").alias("value"))
    return kept.select(
        "metric",
        F.map_from_entries("labels").alias("labels"),
        at_micros(F.col("us"), samples.schema["ts"].dataType).alias("ts"),
        "value",
    )


def held_values(
    samples: DataFrame,
    *,
    step: str = V.EVALUATE_EVERY,
    lookback: str = V.LOOKBACK,
    slice_length: str = SLICE,
) -> DataFrame:
    """``(metric, labels, slice, cell, until, value)``: the grid in run-length form.

    From grid time ``cell`` to grid time ``until``, both inclusive and in microseconds, an
    evaluation sees ``value``: the latest sample, unless older than ``lookback``.
    """
    step, lookback = micros(step), micros(lookback)
    length = max(micros(slice_length), lookback + step)
    cells = (
        keyed(samples)
        .groupBy(*SERIES, ceil_to(F.col("us"), step).alias("cell"))
        .agg(F.max("us").alias("us"), F.max_by("value", "us").alias("value"))
    )
    # A successor further away than the lookback changes nothing, so a slice needs to see
    # only that far into the next one.
    own, earlier = floor_to(F.col("cell"), length), floor_to(
        F.col("cell") - (lookback + step), length
    )
    spread = cells.withColumn("slice", F.explode(F.array_distinct(F.array(own, earlier))))
    in_slice = Window.partitionBy(*SERIES, "slice").orderBy("cell")
    stale = floor_to(F.col("us") + lookback, step)
    until = F.least(F.lead("cell").over(in_slice) - step, stale)
    held = spread.withColumn("until", until).where(own == F.col("slice"))
    return held.where(F.col("until") >= F.col("cell")).select(
        *SERIES, "slice", "cell", "until", "value"
    )


def on_grid(
    samples: DataFrame,
    *,
    step: str = V.EVALUATE_EVERY,
    lookback: str = V.LOOKBACK,
    slice_length: str = SLICE,
) -> DataFrame:
    """``(metric, labels, eval_ts, value)`` at every step of the evaluation grid."""
    held = held_values(samples, step=step, lookback=lookback, slice_length=slice_length)
    times = F.sequence("cell", "until", F.lit(micros(step)))
    like = samples.schema["ts"].dataType
    return held.select(*SERIES, "value", F.explode(times).alias("us")).select(
        "metric",
        F.map_from_entries("labels").alias("labels"),
        at_micros(F.col("us"), like).alias("eval_ts"),
        "value",
    )


def rate(
    samples: DataFrame,
    *,
    window: str = V.RATE_WINDOW,
    step: str = V.EVALUATE_EVERY,
    extrapolate: bool = True,
    unique: bool = False,
    slice_length: str = SLICE,
) -> DataFrame:
    """``(metric, labels, eval_ts, rate)``: per-second increase of counters at each step.

    The samples in ``(t - window, t]`` count; fewer than two give no row. A value below its
    predecessor is a reset, and the predecessor is added back. ``extrapolate`` stretches the
    increase to the window's edges, but at the start never to below zero. Of values that
    contradict each other the largest counts; ``unique`` says that there are none, as in a
    scraped counter, and saves looking.

    Windows and steps are made of cells, the longest span that divides both. Samples are
    shuffled once, by (series, cell), and ordered only inside their cell. Cells then go to the
    slices whose steps see them, and a slice orders cells.
    """
    window, step = micros(window), micros(step)
    length = max(micros(slice_length), window)
    cell = gcd(window, step)

    placed = keyed(samples).withColumn("cell", ceil_to(F.col("us"), cell))
    in_cell = Window.partitionBy(*SERIES, "cell").orderBy("us")
    if not unique:
        by_value = Window.partitionBy(*SERIES, "cell").orderBy("us", "value")
        last_of_time = F.coalesce(F.lead("us").over(by_value) != F.col("us"), F.lit(True))
        placed = placed.withColumn("settled", last_of_time).where("settled").drop("settled")
    dropped = F.when(F.col("value") < F.col("before"), F.col("before")).otherwise(F.lit(0.0))
    drops = placed.withColumn("before", F.lag("value").over(in_cell)).withColumn("drop", dropped)
    cells = drops.groupBy(*SERIES, "cell").agg(
        F.count("*").alias("n"),
        F.min("us").alias("first_us"),
        F.max("us").alias("last_us"),
        F.min_by("value", "us").alias("first_value"),
        F.max_by("value", "us").alias("last_value"),
        F.sum("drop").alias("drops"),
    )

    # Slices hold evaluation steps. A cell goes to each slice with a step that sees it; from
    # there on everything is partitioned by (series, slice).
    first_step = ceil_to(F.col("cell"), step)
    last_step = floor_to(F.col("cell") - cell + window, step)
    slices = F.sequence(floor_to(first_step, length), floor_to(last_step, length), F.lit(length))
    spread = cells.where(first_step <= last_step).withColumn("slice", F.explode(slices))
    in_slice = Window.partitionBy(*SERIES, "slice").orderBy("cell")
    previous = F.lag("last_value").over(in_slice)
    link = F.when(F.col("first_value") < previous, previous).otherwise(F.lit(0.0))
    linked = spread.withColumn("link", link)
    since = F.greatest(first_step, ceil_to(F.col("slice"), step))
    till = F.least(last_step, floor_to(F.col("slice") + length - 1, step))
    seen_at = (
        linked.where(since <= till)
        .withColumn("at", F.explode(F.sequence(since, till, F.lit(step))))
        .groupBy(*SERIES, "slice", "at")
        .agg(
            F.sum("n").alias("n"),
            F.min("first_us").alias("first_us"),
            F.max("last_us").alias("last_us"),
            F.min_by("first_value", "first_us").alias("first_value"),
            F.max_by("last_value", "last_us").alias("last_value"),
            # What the window's first cell lost against the one before it lies outside.
            (F.sum(F.col("drops") + F.col("link")) - F.min_by("link", "first_us")).alias("drops"),
        )
        .where((F.col("n") >= 2) & (F.col("last_us") > F.col("first_us")))
    )
    grown = F.col("last_value") - F.col("first_value") + F.col("drops")
    increased = seen_at.withColumn("increase", grown)
    stretch = _stretch(window) if extrapolate else F.lit(1.0)
    like = samples.schema["ts"].dataType
    return increased.select(
        "metric",
        F.map_from_entries("labels").alias("labels"),
        at_micros(F.col("at"), like).alias("eval_ts"),
        (F.col("increase") * stretch / (window / 1e6)).alias("rate"),
    )


def _stretch(window: int) -> Column:
    """Factor by which the increase between first and last sample grows to the window.

    Each edge is extended by its gap if that is below 1.1 mean sample distances, else by half
    such a distance.
    """
    span = (F.col("last_us") - F.col("first_us")).cast("double")
    mean_gap = span / (F.col("n") - 1)

    def edge(gap: Column) -> Column:
        return F.when(gap < 1.1 * mean_gap, gap).otherwise(mean_gap / 2)

    to_zero = F.when(
        (F.col("increase") > 0) & (F.col("first_value") >= 0),
        span * F.col("first_value") / F.col("increase"),
    )
    head = edge((F.col("first_us") - (F.col("at") - window)).cast("double"))
    tail = edge((F.col("at") - F.col("last_us")).cast("double"))
    return (span + F.least(head, to_zero) + tail) / span
