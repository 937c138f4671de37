"""The three windowed indicators. Defaults are the production settings.

Every function takes a table or a stream of typed rows with a time column and a key; ``late`` is
that of ``windowed``. The ``of_panes`` forms take what ``tick_panes`` has made of the ticks instead,
so that several indicators share one aggregation of them.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import values as V
from ..functions import classify_move, percent_change, round_to
from .windows import (
    Stat,
    flatten,
    pane_length,
    pane_stream,
    stamped,
    windowed,
    windowed_stream,
    windowed_table,
    windows_of_panes,
)

AVERAGES = [
    Stat("sma_5min", "avg", "price"),
    Stat("price_max", "max", "price"),
    Stat("price_min", "min", "price"),
    Stat("volatility", "stddev", "price"),
    Stat("change_avg", "avg", "change_pct"),
]
MOVES = [
    Stat("change_avg", "avg", "change_pct"),
    Stat("price_max", "max", "price"),
    Stat("price_min", "min", "price"),
]
#: Divides the sizes and slides of all three indicators.
PANE = pane_length("5 minutes", "1 minute", "2 minutes", "30 seconds")


def moving_average(
    ticks: DataFrame,
    *,
    time: str = "event_time",
    key: str = "symbol",
    size: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = "2 minutes",
    late: str = "window",
) -> DataFrame:
    """Moving average, extremes, volatility and mean change per sliding window."""
    return _averages(windowed(ticks, AVERAGES, time=time, key=key, size=size, slide=slide,
                              delay=delay, late=late))


def _averages(out: DataFrame) -> DataFrame:
    return _rounded(out, sma_5min=2, price_max=2, price_min=2, volatility=4, change_avg=4)


def pump_dump(
    ticks: DataFrame,
    *,
    time: str = "event_time",
    key: str = "symbol",
    size: str = "2 minutes",
    slide: str = "30 seconds",
    delay: str = "1 minute",
    limit: float = V.MOVE_LIMIT_PCT,
    basis: str = "change_avg",
    late: str = "window",
) -> DataFrame:
    """Classify each short window as pump, dump or normal.

    ``basis="change_avg"`` judges the mean of the feed's own change figure;
    ``basis="window_range"`` judges the price range inside the window, in percent of its
    minimum (a range has no sign, so it can only report a pump).
    """
    return _moves(windowed(ticks, MOVES, time=time, key=key, size=size, slide=slide, delay=delay,
                           late=late), limit, basis)


def _moves(out: DataFrame, limit: float, basis: str) -> DataFrame:
    judged = {
        "change_avg": round_to(F.col("change_avg"), 4),
        "window_range": percent_change(F.col("price_max"), F.col("price_min")),
    }[basis]
    # Judged before rounding: two decimals of a price below a cent say nothing.
    out = out.withColumn("alerta", classify_move(judged, limit))
    return _rounded(out, change_avg=4, price_max=2, price_min=2)


def local_price(ticks: DataFrame, *, time: str = "event_time", key: str = "symbol",
                size: str = "1 minute", delay: str = "2 minutes",
                name: str = "local_price") -> DataFrame:
    """Mean local price per tumbling window."""
    stats = [Stat(name, "avg", "price")]
    return _rounded(windowed(ticks, stats, time=time, key=key, size=size, delay=delay),
                    **{name: 2})


def global_price(market: DataFrame, *, time: str = "event_time", key: str = "symbol",
                 size: str = "1 minute", delay: str = "2 minutes",
                 name: str = "global_price") -> DataFrame:
    """Mean global price and market capitalization per tumbling window."""
    stats = [Stat(name, "avg", "price_usd"), Stat("market_cap", "avg", "market_cap")]
    return _rounded(windowed(market, stats, time=time, key=key, size=size, delay=delay),
                    **{name: 2, "market_cap": 0})


def price_deviation(
    ticks: DataFrame,
    market: DataFrame,
    *,
    time: str = "event_time",
    key: str = "symbol",
    size: str = "1 minute",
    delay: str = "2 minutes",
    local_name: str = "local_price",
    global_name: str = "global_price",
) -> DataFrame:
    """Deviation of the local from the global price, for windows both feeds have.

    Both sides are aggregated on (window, key) first. On tables the join then finds both
    inputs already partitioned by its keys. On streams the output appears in append mode,
    once the watermark (the slower feed's) has passed the window.
    """
    local = [Stat(local_name, "avg", "price")]
    world = [Stat(global_name, "avg", "price_usd"), Stat("market_cap", "avg", "market_cap")]
    args = dict(time=time, key=key, size=size)
    if ticks.isStreaming or market.isStreaming:
        left = windowed_stream(ticks, local, delay=delay, **args)
        right = windowed_stream(market, world, delay=delay, **args)
        joined = flatten(left.join(right, ["window", key], "inner"))
    else:
        left = windowed_table(ticks, local, **args)
        right = windowed_table(market, world, **args)
        both = left.join(right, ["start", key], "inner")
        joined = stamped(both, ticks.schema[time].dataType, size)
    return _deviations(joined, local_name, global_name)


def _deviations(joined: DataFrame, local_name: str, global_name: str) -> DataFrame:
    joined = _rounded(joined, **{local_name: 2, global_name: 2, "market_cap": 0})
    return joined.withColumn(
        "deviation_pct", percent_change(F.col(local_name), F.col(global_name))
    )


def tick_panes(ticks: DataFrame, *, time: str = "event_time", key: str = "symbol",
               pane: str = PANE, delay: str = "2 minutes") -> DataFrame:
    """A stream's ticks aggregated once for all indicators: ``(pane_end, key, partial results)``.

    A pane appears when the watermark has passed it. Panes are final: rows that come later are
    dropped. Their table is what the ``of_panes`` forms read.
    """
    panes = pane_stream(ticks, AVERAGES, time=time, key=key, pane=pane, delay=delay)
    rest = [c for c in panes.columns if c != "pane"]
    return panes.select(F.col("pane.end").alias("pane_end"), *rest)


def _pane_windows(panes, stats, key, size, slide=None) -> DataFrame:
    """Panes come complete and in order, so a later pane closes a window without further delay.

    They are sorted in by the last instant that they cover.
    """
    last = F.col("pane_end") - F.expr("INTERVAL 1 MICROSECOND")
    timed = panes.withColumn("pane_end", last)
    if panes.isStreaming:
        timed = timed.withWatermark("pane_end", "0 seconds")
    return windows_of_panes(timed, stats, key=key, size=size, slide=slide, at="pane_end")


def moving_average_of_panes(panes: DataFrame, *, key: str = "symbol", size: str = "5 minutes",
                            slide: str = "1 minute") -> DataFrame:
    """``moving_average`` over the table or stream of ``tick_panes``."""
    return _averages(flatten(_pane_windows(panes, AVERAGES, key, size, slide)))


def pump_dump_of_panes(panes: DataFrame, *, key: str = "symbol", size: str = "2 minutes",
                       slide: str = "30 seconds", limit: float = V.MOVE_LIMIT_PCT,
                       basis: str = "change_avg") -> DataFrame:
    """``pump_dump`` over the table or stream of ``tick_panes``."""
    return _moves(flatten(_pane_windows(panes, MOVES, key, size, slide)), limit, basis)


def price_deviation_of_panes(
    panes: DataFrame, market: DataFrame, *, time: str = "event_time", key: str = "symbol",
    size: str = "1 minute", delay: str = "2 minutes", local_name: str = "local_price",
    global_name: str = "global_price",
) -> DataFrame:
    """``price_deviation`` with the ticks' side from the stream of ``tick_panes``."""
    world = [Stat(global_name, "avg", "price_usd"), Stat("market_cap", "avg", "market_cap")]
    left = _pane_windows(panes, [Stat(local_name, "avg", "price")], key, size)
    right = windowed_stream(market, world, time=time, key=key, size=size, delay=delay)
    joined = flatten(left.join(right, ["window", key], "inner"))
    return _deviations(joined, local_name, global_name)


def _rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: round_to(F.col(c), n) for c, n in places.items()})
