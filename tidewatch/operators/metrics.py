"""Metric samples: made from feeds, selected, counted, combined."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import values as V
from ..functions import at_micros, ceil_to, epoch_micros, floor_to, micros, time_order
from .series import SLICE, held_values, on_grid, rate


def gauges(
    rows: DataFrame, named: dict[str, str], *, ts: str = "event_time", label: str | None = None,
    of: str = "symbol",
) -> DataFrame:
    """Samples ``(metric, labels, ts, value)``: for every row one per metric -> column."""
    entries = [
        F.struct(F.lit(metric).alias("metric"), F.col(column).cast("double").alias("value"))
        for metric, column in named.items()
    ]
    no_labels = F.create_map().cast("map<string,string>")
    labels = no_labels if label is None else F.create_map(F.lit(label), F.col(of))
    return rows.select(
        F.explode(F.array(*entries)).alias("entry"), labels.alias("labels"), F.col(ts).alias("ts")
    ).select("entry.metric", "labels", "ts", "entry.value")


def tick_gauges(ticks: DataFrame, **args) -> DataFrame:
    named = {V.PRICE_NOW: "price", V.CHANGE_24H: "change_pct", V.VOLUME_24H: "volume_24h"}
    return gauges(ticks, named, label="par", **args)


def market_gauges(market: DataFrame, **args) -> DataFrame:
    named = {
        V.MARKET_CAP: "market_cap", V.MARKET_VOLUME: "volume_24h", V.MARKET_PRICE: "price_usd"
    }
    return gauges(market, named, label="coin", **args)


def sentiment_gauge(sentiment: DataFrame, **args) -> DataFrame:
    return gauges(sentiment, {V.SENTIMENT_INDEX: "value"}, **args)


def last_value(
    rows: DataFrame, values: list[str], *, keys: list[str], ts: str = "event_time",
    tiebreak: str | None = None,
) -> DataFrame:
    """The latest value of each column per label; NULL times never count as latest.

    ``tiebreak``, a BIGINT column, decides between rows of one time.
    """
    order = F.col(ts) if tiebreak is None else time_order(F.col(ts), F.col(tiebreak))
    timed = rows.where(F.col(ts).isNotNull())
    return timed.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])


def message_counts(messages: DataFrame, topic: str = "topic") -> DataFrame:
    """Messages per topic so far."""
    return messages.groupBy(topic).agg(F.count("*").alias("messages"))


def outcome_counts(polls: DataFrame, ok: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """Successful and failed polls; an unknown outcome is a failure."""
    good = F.coalesce(ok, F.lit(False))
    return polls.groupBy(*keys).agg(
        F.count_if(good).alias("ok"), F.count_if(~good).alias("failed")
    )


def message_counter(
    messages: DataFrame,
    *,
    ts: str = "event_time",
    topic: str = "topic",
    every: str = V.EVALUATE_EVERY,
    restart: str | None = None,
    metric: str = V.MESSAGES_TOTAL,
) -> DataFrame:
    """The message counter as a scrape sees it: samples of the running count per topic.

    Sampled every ``every`` where messages came in. ``restart`` sets the counter back to zero
    at multiples of that period. Messages are counted per scrape first; the running sums then
    go over the scrapes of an hour and over the hours, never over messages.
    """
    width, hour = micros(every), micros(SLICE)
    # A restart belongs to the scrape after it: periods are (start, end] like the scrapes.
    before = F.col("cell") - 1
    period = F.lit(0).cast("bigint") if restart is None else floor_to(before, micros(restart))
    cells = (
        messages.where(F.col(ts).isNotNull() & F.col(topic).isNotNull())
        .groupBy(topic, ceil_to(epoch_micros(F.col(ts)), width).alias("cell"))
        .agg(F.count("*").alias("n"))
        .withColumns({"period": period, "slice": floor_to(before, hour)})
        # Said here, or the join below adds it to one of its sides only and the messages
        # are counted twice.
        .where(F.col("slice").isNotNull() & F.col("period").isNotNull())
    )
    # A slice that a restart cuts has a part in either period.
    in_slice = Window.partitionBy(topic, "period", "slice").orderBy("cell")
    hours = Window.partitionBy(topic, "period").orderBy("slice")
    earlier = cells.groupBy(topic, "period", "slice").agg(F.sum("n").alias("n")).select(
        topic, "period", "slice", (F.sum("n").over(hours) - F.col("n")).alias("earlier")
    )
    counted = (
        cells.withColumn("value", F.sum("n").over(in_slice))
        .join(earlier, [topic, "period", "slice"])
        .withColumn("value", F.col("value") + F.col("earlier"))
    )
    like = messages.schema[ts].dataType
    return counted.select(
        F.lit(metric).alias("metric"),
        F.create_map(F.lit("topic"), F.col(topic)).alias("labels"),
        at_micros(F.col("cell"), like).alias("ts"),
        F.col("value").cast("double").alias("value"),
    )


def poll_counters(polls: DataFrame, ok: Column, **scrape) -> DataFrame:
    """Running counts of successful and failed polls as samples, one metric for each outcome.

    Takes the settings of ``message_counter``; an unknown outcome is a failure.
    """
    outcome = F.when(F.coalesce(ok, F.lit(False)), V.POLLS_OK).otherwise(V.POLLS_FAILED)
    counted = message_counter(polls.withColumn("_poll", outcome), topic="_poll", **scrape)
    return counted.select(
        F.col("labels")["topic"].alias("metric"),
        F.create_map().cast("map<string,string>").alias("labels"),
        "ts",
        "value",
    )


def select(
    samples: DataFrame,
    metric: str,
    equal: dict[str, str] | None = None,
    unequal: dict[str, str] | None = None,
) -> DataFrame:
    """Samples of one metric whose labels match; a label that is absent counts as empty."""
    kept = samples.where(F.col("metric") == metric)
    for name, text in (equal or {}).items():
        kept = kept.where(_label(name) == text)
    for name, text in (unequal or {}).items():
        kept = kept.where(_label(name) != text)
    return kept


def _label(name: str) -> Column:
    return F.coalesce(F.col("labels")[name], F.lit(""))


def combine(
    samples: DataFrame,
    left: str,
    right: str,
    op: Callable[[Column, Column], Column],
    **grid,
) -> DataFrame:
    """``(labels, eval_ts, value)``: arithmetic between two metrics with equal labels.

    Both are put on the grid in one pass and stay in run-length form until they have met: the
    runs of both metrics are cut at slice borders, ordered by (labels, slice), and each run is
    paired with the run of the other metric that holds beside it.
    """
    step = micros(grid.get("step", V.EVALUATE_EVERY))
    length = micros(SLICE) // step * step or step
    both = samples.where(F.col("metric").isin(left, right))
    held = held_values(both, **grid)
    slices = F.sequence(floor_to(F.col("cell"), length), floor_to(F.col("until"), length),
                        F.lit(length))
    parts = held.drop("slice").withColumn("slice", F.explode(slices)).select(
        "labels", "slice", "metric", "value",
        F.greatest("cell", "slice").alias("cell"),
        F.least(F.col("until"), F.col("slice") + (length - step)).alias("until"),
    )

    # One shuffle, of runs; the grid is spelled out only after it.
    sides = {"a": left, "b": right}
    of = {n: F.col("metric") == metric for n, metric in sides.items()}
    starts = parts.repartition("labels", "slice").groupBy("labels", "slice", "cell").agg(
        *[F.max(F.when(of[n], F.col(c))).alias(f"{n}_{c}") for n in sides for c in ("until", "value")]
    )
    ordered = Window.partitionBy("labels", "slice").orderBy("cell")
    beside = starts.select(
        "labels",
        "cell",
        *[F.last(c, ignorenulls=True).over(ordered).alias(c) for c in starts.columns[3:]],
        (F.lead("cell").over(ordered) - step).alias("next"),
    )
    paired = beside.where(F.col("a_until").isNotNull() & F.col("b_until").isNotNull()).withColumn(
        "until", F.least("next", "a_until", "b_until")
    )
    times = F.sequence("cell", "until", F.lit(step))
    like = samples.schema["ts"].dataType
    return paired.where(F.col("until") >= F.col("cell")).select(
        "labels", op(F.col("a_value"), F.col("b_value")).alias("value"), F.explode(times).alias("us")
    ).select(
        F.map_from_entries("labels").alias("labels"),
        at_micros(F.col("us"), like).alias("eval_ts"),
        "value",
    )


def across(series: DataFrame, value: str, how: str = "avg") -> DataFrame:
    """Aggregate all series at each time; the labels are gone."""
    return series.groupBy("eval_ts").agg(getattr(F, how)(value).alias(value))


# The panels of the dashboards, over samples of the host and container collectors.


def cpu_by_container(samples: DataFrame, **args) -> DataFrame:
    """Percent of one core per named container."""
    busy = rate(select(samples, V.CONTAINER_CPU, unequal={"name": ""}), **args)
    return busy.select("labels", "eval_ts", (F.col("rate") * 100).alias("value"))


def memory_by_container(samples: DataFrame, **grid) -> DataFrame:
    """Megabytes per named container."""
    used = on_grid(select(samples, V.CONTAINER_MEMORY, unequal={"name": ""}), **grid)
    return used.select("labels", "eval_ts", (F.col("value") / 1024 / 1024).alias("value"))


def host_cpu(samples: DataFrame, **args) -> DataFrame:
    """Percent of the host's cores that are not idle."""
    idle = across(rate(select(samples, V.NODE_CPU, equal={"mode": "idle"}), **args), "rate")
    return idle.select("eval_ts", (100 - F.col("rate") * 100).alias("value"))


def host_memory(samples: DataFrame, **grid) -> DataFrame:
    """Gigabytes in use on the host."""
    return combine(
        samples,
        V.NODE_MEMORY_TOTAL,
        V.NODE_MEMORY_AVAILABLE,
        lambda total, free: (total - free) / 1024 / 1024 / 1024,
        **grid,
    )


def message_rate(samples: DataFrame, **args) -> DataFrame:
    """Published messages per second and topic."""
    return rate(select(samples, V.MESSAGES_TOTAL), **args)
