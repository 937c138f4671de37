"""Grid, rate and arithmetic of metric series on a stream.

Each takes two queries, since Spark lets no operator with state of its own follow an aggregation in
one. The first reduces samples to an entry per series and step (or cell), by a watermarked
aggregation with map-side partial results, and appends an entry to a table once it is final. The
second follows that table with a little state per series: what is held, or the cells of one window.
A series' entries reach it in order, so it holds none of them back. Steps after a series' last entry
come out when the watermark, that of all series, has passed them.

What the state functions emit is small (a run of steps, a cell's rates); steps are spelled out, and
arithmetic is done, by expressions.
"""

import json
from collections.abc import Callable, Iterator, Sequence
from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import values as V
from ..functions import ceil_to, micros
from ..operators.metrics import across
from ..sources.records import table_stream
from .sinks import to_history

STEPS = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("series", T.StringType()),
        T.StructField("step_at", T.TimestampType()),
        T.StructField("last", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
    ]
)
CELLS = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("series", T.StringType()),
        T.StructField("step_at", T.TimestampType()),
        T.StructField("n", T.LongType()),
        T.StructField("first_us", T.LongType()),
        T.StructField("last_us", T.LongType()),
        T.StructField("first_value", T.DoubleType()),
        T.StructField("last_value", T.DoubleType()),
        T.StructField("drops", T.DoubleType()),
    ]
)
_LABELS = "map<string,string>"


def _stepped(samples: DataFrame, step: str, delay: str) -> tuple[DataFrame, Column, Column]:
    """Samples under a watermark, their series as text, and the step that sees them first.

    Steps are (start, end] while windows are [start, end): shifted by the clock's resolution.
    """
    timed = samples.where(F.col("value").isNotNull())
    timed = timed.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    series = F.to_json(F.map_from_entries(F.sort_array(F.map_entries("labels"))))
    return timed, series, F.window("ts", step, step, "1 microsecond")


def _step_at(step: str) -> Column:
    return F.timestamp_micros(ceil_to(F.unix_micros("window.start"), micros(step)))


def last_values(
    samples: DataFrame, *, delay: str = "1 minute", step: str = V.EVALUATE_EVERY
) -> DataFrame:
    """STEPS: the last value of each series per evaluation step; of one time the largest."""
    timed, series, window = _stepped(samples, step, delay)
    order = F.struct("ts", "value")
    last = timed.groupBy(window.alias("window"), "metric", series.alias("series")).agg(
        F.max(order).alias("entry")
    )
    return last.select(
        "metric", "series", _step_at(step).alias("step_at"), F.col("entry.ts").alias("last"),
        "entry.value",
    )


def counter_cells(samples: DataFrame, *, cell: str, delay: str = "1 minute") -> DataFrame:
    """CELLS: what a counter did within each cell; of values of one time the largest counts.

    The samples of a series and cell meet in one row: a scrape interval's worth, so few.
    """
    timed, series, window = _stepped(samples, cell, delay)
    found = F.sort_array(F.collect_set(F.struct(F.unix_micros("ts").alias("us"), "value")))
    grouped = timed.groupBy(window.alias("window"), "metric", series.alias("series")).agg(
        found.alias("found")
    )

    def settled(entry: Column, i: Column) -> Column:
        return F.coalesce(F.get("found", i + 1)["us"] != entry["us"], F.lit(True))

    def dropped(entry: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("kept", i - 1)["value"])
        return F.when(entry["value"] < before, before).otherwise(F.lit(0.0))

    kept = grouped.withColumn("kept", F.filter("found", settled))
    lost = F.aggregate(F.transform("kept", dropped), F.lit(0.0), lambda total, drop: total + drop)
    first, last = F.element_at("kept", 1), F.element_at("kept", -1)
    return kept.select(
        "metric", "series", _step_at(cell).alias("step_at"),
        F.size("kept").cast("long").alias("n"),
        first["us"].alias("first_us"), last["us"].alias("last_us"),
        first["value"].alias("first_value"), last["value"].alias("last_value"),
        lost.alias("drops"),
    )


# --- the following queries ---------------------------------------------------


def held_runs(
    steps: DataFrame,
    metrics: Sequence[str] | None = None,
    *,
    step: str = V.EVALUATE_EVERY,
    lookback: str = V.LOOKBACK,
) -> DataFrame:
    """``(metric, series, first_us, last_us, held)``: runs of steps and the values held in them.

    Without ``metrics`` each series is on its own, ``held`` has its value. With metrics, series of
    equal labels are put side by side, and ``held`` has one value for each metric, in that order, in
    runs at which none is missing or older than ``lookback``.
    """
    width, reach = micros(step), micros(lookback)
    slots = {m: i for i, m in enumerate(metrics or [None])}
    # The watermark's column must get to the state function, so that it may time out.
    timed = steps.withWatermark("step_at", "0 seconds")
    if metrics:
        timed = timed.where(F.col("metric").isin(*metrics))
    rows = timed.select(
        F.lit("").alias("metric") if metrics else F.col("metric"), "series", "step_at",
        F.col("metric").alias("slot"), F.unix_micros("step_at").alias("cell"),
        F.unix_micros("last").alias("us"), "value",
    )

    def carry(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
              ) -> Iterator[pd.DataFrame]:
        runs: list[tuple[int, int, list[float]]] = []
        following, held = json.loads(state.get[0]) if state.exists else (None, [None] * len(slots))

        def fill(until: int) -> None:
            """Emit the steps up to there, as far as every value reaches."""
            nonlocal following
            if None not in held:
                last = min(until, *[reaches for _, reaches in held])
                if following <= last:
                    runs.append((following, last, [value for value, _ in held]))
            following = until + width

        if state.hasTimedOut:
            fill(max(h[1] for h in held if h))
            state.remove()
        else:
            names = ["cell", "slot", "us", "value"]
            found = pd.concat([c[names] for c in chunks]).sort_values("cell", kind="stable")
            entries = list(zip(*(found[c].tolist() for c in names)))
            for i, (cell, slot, us, value) in enumerate(entries):
                if following is None:
                    following = cell
                if following < cell:
                    fill(cell - width)
                held[slots[slot] if metrics else 0] = (value, (us + reach) // width * width)
                if i + 1 == len(entries) or entries[i + 1][0] > cell:
                    fill(cell)
            state.update((json.dumps([following, held]),))
            # A millisecond after the last step that a value held now reaches.
            expiry = max(h[1] for h in held if h) // 1000 + 1
            state.setTimeoutTimestamp(max(expiry, state.getCurrentWatermarkMs() + 1))
        if runs:
            yield pd.DataFrame([(*key, *run) for run in runs],
                               columns=["metric", "series", "first_us", "last_us", "held"])

    return rows.groupBy("metric", "series").applyInPandasWithState(
        carry, "metric string, series string, first_us long, last_us long, held array<double>",
        "held string", "append", GroupStateTimeout.EventTimeTimeout,
    )


def _spelled_out(runs: DataFrame, step: str, value: Column) -> list[Column]:
    times = F.sequence("first_us", "last_us", F.lit(micros(step)))
    return [F.from_json("series", _LABELS).alias("labels"),
            F.explode(F.transform(times, F.timestamp_micros)).alias("eval_ts"),
            value.alias("value")]


def on_grid(steps: DataFrame, *, step: str = V.EVALUATE_EVERY, lookback: str = V.LOOKBACK
            ) -> DataFrame:
    """The rows of ``operators.series.on_grid``, from the stream of a table of ``last_values``."""
    runs = held_runs(steps, step=step, lookback=lookback)
    return runs.select("metric", *_spelled_out(runs, step, F.element_at("held", 1)))


def combine(
    steps: DataFrame, left: str, right: str, op: Callable[[Column, Column], Column], *,
    step: str = V.EVALUATE_EVERY, lookback: str = V.LOOKBACK,
) -> DataFrame:
    """The rows of ``operators.metrics.combine``, from the stream of a table of ``last_values``.

    That table's files must hold series of equal labels together (``start_combined``).
    """
    runs = held_runs(steps, (left, right), step=step, lookback=lookback)
    value = op(F.element_at("held", 1), F.element_at("held", 2))
    return runs.select(*_spelled_out(runs, step, value))


def _per_second(at: int, window: int, inside: list, extrapolate: bool) -> float | None:
    """The rate over the cells of (at - window, at], as ``operators.series.rate`` has it."""
    n = sum(c[1] for c in inside)
    first_us, first_value = inside[0][2], inside[0][4]
    last_us, last_value = inside[-1][3], inside[-1][5]
    if n < 2 or last_us <= first_us:
        return None
    # What the window's first cell lost against the one before it lies outside.
    increase = last_value - first_value + sum(c[6] + c[7] for c in inside) - inside[0][7]
    stretch = 1.0
    if extrapolate:
        span = float(last_us - first_us)
        mean_gap = span / (n - 1)
        head, tail = (gap if gap < 1.1 * mean_gap else mean_gap / 2
                      for gap in (float(first_us - (at - window)), float(at - last_us)))
        if increase > 0 and first_value >= 0:
            head = min(head, span * first_value / increase)
        stretch = (span + head + tail) / span
    return increase * stretch / (window / 1e6)


def rate(
    cells: DataFrame,
    *,
    window: str = V.RATE_WINDOW,
    step: str = V.EVALUATE_EVERY,
    extrapolate: bool = True,
) -> DataFrame:
    """The rows of ``operators.series.rate``, from the stream of a table of ``counter_cells``.

    The cells must be as long as ``rate_cell(window, step)``. The state of a series is the cells of
    one window.
    """
    long, width = micros(window), micros(step)
    rows = cells.withWatermark("step_at", "0 seconds").withColumn(
        "cell", F.unix_micros("step_at")
    )
    names = ["cell", "n", "first_us", "last_us", "first_value", "last_value", "drops"]

    def link(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
             ) -> Iterator[pd.DataFrame]:
        rates: list[tuple[int, float]] = []
        # Cells with what each lost against the one before, and the next step to evaluate.
        kept, following = json.loads(state.get[0]) if state.exists else ([], None)

        def evaluate(until: int) -> None:
            """The steps up to there; none sees a cell after the last one's window."""
            nonlocal kept, following
            last = min(until, kept[-1][0] + long - 1) if kept else following - 1
            for at in range(following, last + 1, width):
                inside = [c for c in kept if at - long < c[0] <= at]
                found = _per_second(at, long, inside, extrapolate) if inside else None
                if found is not None:
                    rates.append((at, found))
            following = max(following, until // width * width + width)
            kept = [c for c in kept if c[0] > following - long]

        if state.hasTimedOut:
            if kept:
                evaluate(kept[-1][0] + long)
            state.remove()
        else:
            found = pd.concat([c[names] for c in chunks]).sort_values("cell")
            for row in zip(*(found[c].tolist() for c in names)):
                if following is None:
                    following = -(-row[0] // width) * width
                evaluate(row[0] - 1)
                reset = bool(kept) and row[4] < kept[-1][5]
                kept.append([*row, kept[-1][5] if reset else 0.0])
                evaluate(row[0])
            state.update((json.dumps([kept, following]),))
            last = max((c[0] for c in kept), default=following)
            state.setTimeoutTimestamp(
                max((last + long) // 1000 + 1, state.getCurrentWatermarkMs() + 1)
            )
        if rates:
            yield pd.DataFrame([(*key, *r) for r in rates],
                               columns=["metric", "series", "us", "rate"])

    found = rows.groupBy("metric", "series").applyInPandasWithState(
        link, "metric string, series string, us long, rate double", "cells string", "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return found.select(
        "metric", F.from_json("series", _LABELS).alias("labels"),
        F.timestamp_micros("us").alias("eval_ts"), "rate",
    )


def rate_cell(window: str = V.RATE_WINDOW, step: str = V.EVALUATE_EVERY) -> str:
    """The longest span that divides both."""
    return f"{gcd(micros(window), micros(step))} microseconds"


# --- wiring ------------------------------------------------------------------


def follow(
    spark: SparkSession,
    entries: DataFrame,
    folder: str,
    judge: Callable[[DataFrame], DataFrame],
    *,
    by: Sequence[str] = ("metric", "series"),
    result: str = "result",
    trigger: dict | None = None,
    files_per_trigger: int | None = 64,
    wait: bool = False,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Keep the entries as a table under ``folder`` and follow it; rows land in its ``result``.

    What is equal in ``by`` has one file in each batch of entries, so that its files come in
    order and ``files_per_trigger`` bounds what one trigger replays after an outage. ``wait`` lets
    the first query finish before the second starts, for runs over what is available.
    """
    kept = to_history(
        entries.repartition(*by), f"{folder}/steps", f"{folder}/checkpoints/steps", (), trigger
    )
    if wait:
        kept.awaitTermination()
    followed = table_stream(spark, f"{folder}/steps", entries.schema, files_per_trigger)
    judged = to_history(
        judge(followed), f"{folder}/{result}", f"{folder}/checkpoints/{result}", (), trigger
    )
    if wait:
        judged.awaitTermination()
    return kept, judged


def start_grid(
    spark: SparkSession, samples: DataFrame, folder: str, *, delay: str = "1 minute",
    step: str = V.EVALUATE_EVERY, lookback: str = V.LOOKBACK, **settings,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Samples to their grid, in ``folder/result``."""
    return follow(
        spark, last_values(samples, delay=delay, step=step), folder,
        lambda steps: on_grid(steps, step=step, lookback=lookback), **settings,
    )


def start_combined(
    spark: SparkSession, samples: DataFrame, folder: str, left: str, right: str,
    op: Callable[[Column, Column], Column], *, delay: str = "1 minute",
    step: str = V.EVALUATE_EVERY, lookback: str = V.LOOKBACK, **settings,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Arithmetic between two metrics of equal labels, in ``folder/result``."""
    both = samples.where(F.col("metric").isin(left, right))
    return follow(
        spark, last_values(both, delay=delay, step=step), folder,
        lambda steps: combine(steps, left, right, op, step=step, lookback=lookback),
        by=("series",), **settings,
    )


def start_rate(
    spark: SparkSession, samples: DataFrame, folder: str, *, delay: str = "1 minute",
    window: str = V.RATE_WINDOW, step: str = V.EVALUATE_EVERY, extrapolate: bool = True,
    **settings,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Counter samples to their rates, in ``folder/result``."""
    cells = counter_cells(samples, cell=rate_cell(window, step), delay=delay)
    return follow(
        spark, cells, folder,
        lambda c: rate(c, window=window, step=step, extrapolate=extrapolate), **settings,
    )


def across_stream(series: DataFrame, value: str, how: str = "avg", *, delay: str) -> DataFrame:
    """``operators.metrics.across`` of a stream of ``(eval_ts, value)``.

    Series reach a step at different times, by as much as what holds their values: ``delay`` must
    cover the rate's window, or the grid's lookback, and the stream must deliver whole batches.
    """
    return across(series.withWatermark("eval_ts", delay), value, how)


def start_across(
    spark: SparkSession, samples: DataFrame, folder: str, how: str = "avg", *,
    window: str = V.RATE_WINDOW, step: str = V.EVALUATE_EVERY, trigger: dict | None = None,
    wait: bool = False, **settings,
) -> list[StreamingQuery]:
    """The rates of all series of the samples aggregated at each step, in ``folder/across``.

    The third query follows the table of rates: each of its batches appears whole.
    """
    started = start_rate(spark, samples, folder, window=window, step=step, trigger=trigger,
                         wait=wait, **settings)
    schema = T.StructType([T.StructField("eval_ts", T.TimestampType()),
                           T.StructField("rate", T.DoubleType())])
    late = f"{micros(window) + micros(step)} microseconds"
    rates = table_stream(spark, f"{folder}/result", schema)
    last = to_history(across_stream(rates, "rate", how, delay=late), f"{folder}/across",
                      f"{folder}/checkpoints/across", (), trigger)
    if wait:
        last.awaitTermination()
    return [*started, last]
