"""Time-window statistics per key, for tables and streams.

A table's rows are first reduced to one partial result per (pane, key), a pane being the longest
span that divides size and slide, and only those partial results are copied into the windows that
contain them. A hot key therefore costs one map-side update per row, not one per row and window.

A stream has the choice. Grouped by ``window`` under a watermark (``late="window"``), a late row
still counts in those of its windows that are open, at the price of a copy of every row for each
window. With ``late="pane"`` rows are aggregated once, into panes that the watermark closes, and a
second aggregation makes windows of closed panes: a row that comes after its pane is closed is
dropped for all windows.
"""

from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import at_micros, ceil_to, epoch_micros, floor_to, micros


@dataclass(frozen=True)
class Stat:
    """One output column: ``kind`` (avg, max, min or stddev) of ``column``."""

    name: str
    kind: str
    column: str

    def direct(self) -> Column:
        return getattr(F, self.kind)(self.column).alias(self.name)


def windowed(
    df: DataFrame,
    stats: list[Stat],
    *,
    time: str,
    key: str,
    size: str,
    slide: str | None = None,
    delay: str | None = None,
    late: str = "window",
) -> DataFrame:
    """``(window_start, window_end, key, *stats)``; NULL times belong to no window.

    ``late`` tells up to when a stream's late rows count, and what they cost (see above).
    """
    if late not in ("window", "pane"):
        raise ValueError(f"late is 'window' or 'pane', not {late!r}")
    if df.isStreaming and late == "pane":
        panes = pane_stream(df, stats, time=time, key=key, pane=pane_length(size, slide),
                            delay=delay)
        return flatten(windows_of_panes(panes, stats, key=key, size=size, slide=slide))
    if df.isStreaming:
        return flatten(windowed_stream(df, stats, time=time, key=key, size=size, slide=slide,
                                       delay=delay))
    table = windowed_table(df, stats, time=time, key=key, size=size, slide=slide)
    return stamped(table, df.schema[time].dataType, size)


def pane_length(*spans: str | None) -> str:
    """The longest span that divides all of these."""
    return f"{gcd(*[micros(s) for s in spans if s])} microseconds"


def windowed_stream(df, stats, *, time, key, size, slide=None, delay=None) -> DataFrame:
    """The same by plain window grouping, with the ``window`` struct kept as stream joins need it.

    Watermarks want a TIMESTAMP, so a stream's TIMESTAMP_NTZ time column is cast.
    """
    timed = _timed(df, time, delay)
    window = F.window(time, size, slide or size)
    return timed.groupBy(window.alias("window"), key).agg(*[s.direct() for s in stats])


def _timed(df: DataFrame, time: str, delay: str | None) -> DataFrame:
    if not df.isStreaming:
        return df
    timed = df.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay) if delay else timed


def pane_stream(df, stats, *, time, key, pane, delay=None, more=()) -> DataFrame:
    """``(pane, key, partial results, *more)``: panes of a stream, each once it is final.

    ``more`` are further aggregates that a pane is to carry.
    """
    panes = _timed(df, time, delay).groupBy(F.window(time, pane).alias("pane"), key)
    return panes.agg(*_pane_columns(stats), *more)


def windows_of_panes(panes, stats, *, key, size, slide=None, at=None) -> DataFrame:
    """``(window, key, *stats)`` of closed panes that divide the windows.

    ``at``, a time within the pane, is that of the ``pane`` column unless given. At most
    size / pane partial results meet in a window, so those of a deviation are kept until its mean
    is known.
    """
    window = F.window(F.window_time("pane") if at is None else at, size, slide or size)
    deviating = _deviating(stats)
    plain = [c for c in _window_columns(stats, squares=False)]
    lists = [
        F.collect_list(F.struct(*[F.col(f"{c}__{part}").alias(part)
                                  for part in ("sum", "n", "squares")])).alias(f"{c}__panes")
        for c in deviating
    ]
    merged = panes.groupBy(window.alias("window"), key).agg(*plain, *lists)
    for c in deviating:
        mean = F.try_divide(F.col(f"{c}__sum"), F.col(f"{c}__n"))
        filled = F.filter(f"{c}__panes", lambda p: p["n"] > 0)
        merged = merged.withColumn(f"{c}__squares", F.aggregate(
            F.transform(filled, lambda p: p["squares"] + p["n"] * F.pow(  # noqa: B023
                p["sum"] / p["n"] - mean, F.lit(2.0))),  # noqa: B023
            F.lit(0.0), lambda total, square: total + square,
        ))
    return merged.select("window", key, *[_single(s).alias(s.name) for s in stats])


def flatten(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by two flat columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def stamped(df: DataFrame, like: T.DataType, size: str) -> DataFrame:
    """Replace the ``start`` microseconds by two flat columns."""
    rest = [c for c in df.columns if c != "start"]
    return df.select(
        at_micros(F.col("start"), like).alias("window_start"),
        at_micros(F.col("start") + micros(size), like).alias("window_end"),
        *rest,
    )


def windowed_table(df, stats, *, time, key, size, slide=None) -> DataFrame:
    """The same for a table, with the window start in epoch microseconds as ``start``.

    Results stay partitioned by (start, key), so a join on those moves nothing.
    """
    size, slide = micros(size), micros(slide or size)
    pane = gcd(size, slide)
    panes = (
        df.where(F.col(time).isNotNull())
        .groupBy(floor_to(epoch_micros(F.col(time)), pane).alias("start"), key)
        .agg(*_pane_columns(stats))
    )
    if size > slide:
        first, last = F.col("pane") + (pane - size), F.col("pane")
        if pane < slide:
            first, last = ceil_to(first, slide), floor_to(last, slide)
        starts = F.sequence(first, last, F.lit(slide))
        copies = panes.withColumnRenamed("start", "pane").withColumn("start", F.explode(starts))
        if deviating := _deviating(stats):
            # The panes of a window, at most size / pane of them, meet once: their means are
            # compared with the window's where they then are aggregated.
            meet = Window.partitionBy("start", key)
            copies = copies.withColumns({f"{c}__mean": F.try_divide(
                F.sum(f"{c}__sum").over(meet), F.sum(f"{c}__n").over(meet)) for c in deviating})
        panes = copies.groupBy("start", key).agg(*_window_columns(stats))
    return panes.select("start", key, *[_single(s).alias(s.name) for s in stats])


# Partial results per pane. A mean needs (sum, count). A deviation needs (sum, count, sum of
# squared distances from the mean) of every pane in the window: merged through the distances of
# the pane means from the window mean, it keeps the digits that a plain sum of squares loses at
# large prices. Extremes merge as themselves.


def _deviating(stats: list[Stat]) -> list[str]:
    return list(dict.fromkeys(s.column for s in stats if s.kind == "stddev"))


def _pane_columns(stats: list[Stat]) -> list[Column]:
    out = {}
    for s in stats:
        c = F.col(s.column)
        if s.kind in ("avg", "stddev"):
            out[f"{s.column}__sum"] = F.sum(c.cast("double"))
            out[f"{s.column}__n"] = F.count(c)
        if s.kind == "stddev":
            out[f"{s.column}__squares"] = F.var_pop(c) * F.count(c)
        if s.kind in ("max", "min"):
            out[f"{s.column}__{s.kind}"] = getattr(F, s.kind)(c)
    return [col.alias(name) for name, col in out.items()]


def _single(s: Stat) -> Column:
    n = F.col(f"{s.column}__n")
    if s.kind == "avg":
        return F.try_divide(F.col(f"{s.column}__sum"), n)
    if s.kind == "stddev":
        return F.when(n > 1, F.sqrt(F.col(f"{s.column}__squares") / (n - 1)))
    return F.col(f"{s.column}__{s.kind}")


def _window_columns(stats: list[Stat], squares: bool = True) -> list[Column]:
    out = {}
    for s in stats:
        total, n = F.col(f"{s.column}__sum"), F.col(f"{s.column}__n")
        if s.kind in ("avg", "stddev"):
            out[f"{s.column}__sum"], out[f"{s.column}__n"] = F.sum(total), F.sum(n)
        if s.kind == "stddev" and squares:
            gap = F.try_divide(total, n) - F.col(f"{s.column}__mean")
            out[f"{s.column}__squares"] = F.sum(F.col(f"{s.column}__squares") + n * gap * gap)
        if s.kind in ("max", "min"):
            out[f"{s.column}__{s.kind}"] = getattr(F, s.kind)(f"{s.column}__{s.kind}")
    return [col.alias(name) for name, col in out.items()]
