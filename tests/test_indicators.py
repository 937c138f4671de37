import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidewatch import values as V
from tidewatch.functions import classify_move, percent_change, round_to
from tidewatch.operators import indicators
from tidewatch.operators.windows import Stat, flatten, windowed, windowed_stream

START = dt.datetime(2024, 5, 1, 12, 0, 0)
TICK = "symbol string, price double, change_pct double, event_time timestamp_ntz"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def ticks(spark, *rows):
    return spark.createDataFrame([(s, p, c, at(t)) for s, p, c, t in rows], TICK)


def test_single_row_window(spark):
    out = indicators.moving_average(ticks(spark, ("A", 10.0, 1.0, 30))).collect()
    assert len(out) == 5
    assert {r.window_start for r in out} == {at(-60 * i) for i in range(5)}
    for r in out:
        assert (r.sma_5min, r.price_max, r.price_min, r.volatility, r.change_avg) == (
            10.0, 10.0, 10.0, None, 1.0
        )
        assert r.window_end - r.window_start == dt.timedelta(minutes=5)


def test_row_on_the_edge_belongs_to_the_window_that_starts_there(spark):
    out = indicators.local_price(ticks(spark, ("A", 1.0, 0.0, 60), ("A", 3.0, 0.0, 59.999999)))
    assert {(r.window_start, r.local_price) for r in out.collect()} == {
        (at(0), 3.0), (at(60), 1.0)
    }


def test_times_before_the_epoch(spark):
    early = spark.createDataFrame([("A", 1.0, 0.0, dt.datetime(1969, 12, 31, 23, 59, 59))], TICK)
    r = indicators.local_price(early).first()
    assert r.window_start == dt.datetime(1969, 12, 31, 23, 59)


def test_null_times_prices_and_symbols(spark):
    rows = spark.createDataFrame(
        [("A", None, 1.0, at(0)), ("A", 2.0, None, at(1)), ("A", 9.0, 9.0, None),
         (None, 5.0, 5.0, at(0))], TICK
    )
    out = {r.symbol: r for r in indicators.local_price(rows).collect()}
    assert out["A"].local_price == 2.0 and out[None].local_price == 5.0
    sma = {r.symbol: r for r in indicators.moving_average(rows).collect()}
    assert (sma["A"].sma_5min, sma["A"].volatility, sma["A"].change_avg) == (2.0, None, 1.0)


def test_exact_bounds_are_normal(spark):
    rows = spark.createDataFrame([(c,) for c in (2.0, -2.0, 2.0001, -2.0001, None)], "c double")
    labels = [r.a for r in rows.select(classify_move(F.col("c")).alias("a")).collect()]
    assert labels == ["normal", "normal", V.PUMP, V.DUMP, "normal"]


def test_pump_dump_basis(spark):
    rows = ticks(spark, ("A", 100.0, 0.5, 0), ("A", 103.0, 0.5, 10))
    assert {r.alerta for r in indicators.pump_dump(rows).collect()} == {"normal"}
    assert {
        r.alerta for r in indicators.pump_dump(rows, basis="window_range").collect()
    } == {V.PUMP}


def test_rounding_is_half_up_and_division_by_zero_is_null(spark):
    rows = spark.createDataFrame(
        [(1.005,), (2.675,), (-1.005,), (float("nan"),), (1e300,), (None,)], "x double"
    )
    out = [r.r for r in rows.select(round_to(F.col("x"), 2).alias("r")).collect()]
    assert out[:3] == [1.01, 2.68, -1.01]
    assert math.isnan(out[3]) and out[4] == 1e300 and out[5] is None
    zero = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert zero.select(percent_change(F.col("a"), F.col("b")).alias("p")).first().p is None


def test_deviation(spark):
    local = ticks(spark, ("A", 102.0, 0.0, 1), ("A", 104.0, 0.0, 2), ("A", 1.0, 0.0, 61),
                  ("Z", 1.0, 0.0, 1), (None, 1.0, 0.0, 1))
    world = spark.createDataFrame(
        [("A", 100.0, 5.4, at(3)), ("Z", 0.0, 1.0, at(3)), (None, 1.0, 1.0, at(3))],
        "symbol string, price_usd double, market_cap double, event_time timestamp_ntz",
    )
    out = {r.symbol: r for r in indicators.price_deviation(local, world).collect()}
    assert set(out) == {"A", "Z"}
    a = out["A"]
    assert (a.window_start, a.local_price, a.global_price, a.market_cap, a.deviation_pct) == (
        at(0), 103.0, 100.0, 5.0, 3.0
    )
    assert out["Z"].deviation_pct is None


def test_a_feed_does_not_deviate_from_itself(spark):
    rnd = random.Random(3)
    local = ticks(spark, *[("A", rnd.uniform(1, 9), 0.0, rnd.uniform(0, 900)) for _ in range(200)])
    world = local.select("symbol", F.col("price").alias("price_usd"),
                         F.lit(1.0).alias("market_cap"), "event_time")
    out = indicators.price_deviation(local, world).collect()
    assert out and all(r.deviation_pct == 0 for r in out)


def near(got, want, **tolerance):
    return got is want if want is None else got == pytest.approx(want, **tolerance)


STATS = [Stat("m", "avg", "price"), Stat("hi", "max", "price"), Stat("lo", "min", "price"),
         Stat("sd", "stddev", "price"), Stat("c", "avg", "change_pct")]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("size,slide", [("5 minutes", "1 minute"), ("2 minutes", "30 seconds"),
                                        ("1 minute", None), ("30 minutes", "1 minute")])
def test_panes_equal_plain_window_grouping(spark, seed, size, slide):
    rnd = random.Random(seed)
    rows = ticks(spark, *[
        (rnd.choice("AAAAB"), rnd.choice([None, rnd.uniform(66999.99, 67000.01)]),
         rnd.choice([None, rnd.gauss(0, 3)]), rnd.uniform(-600, 600))
        for _ in range(400)
    ])
    args = dict(time="event_time", key="symbol", size=size, slide=slide)
    fast = {(r.window_start, r.symbol): r for r in windowed(rows, STATS, **args).collect()}
    plain = flatten(windowed_stream(rows, STATS, **args))
    plain = {(r.window_start, r.symbol): r for r in plain.collect()}
    assert fast.keys() == plain.keys()
    for k, want in plain.items():
        got = fast[k]
        assert (got.window_end, got.hi, got.lo) == (want.window_end, want.hi, want.lo)
        assert near(got.m, want.m, rel=1e-12)
        assert near(got.sd, want.sd, rel=1e-6, abs=1e-9)
        assert near(got.c, want.c, rel=1e-9, abs=1e-12)


def test_constant_high_price_has_no_volatility(spark):
    rows = ticks(spark, *[("A", 67123.4567, 0.0, i) for i in range(300)])
    assert {r.volatility for r in indicators.moving_average(rows).collect()} == {0.0}


def test_invariants(spark):
    rnd = random.Random(11)
    data = [("A", rnd.expovariate(0.1), 0.0, rnd.uniform(0, 1800)) for _ in range(300)]
    out = indicators.moving_average(ticks(spark, *data)).collect()
    for r in out:
        assert r.price_min <= r.sma_5min <= r.price_max
        inside = [p for _, p, _, t in data if r.window_start <= at(t) < r.window_end]
        assert r.sma_5min == pytest.approx(statistics.fmean(inside), abs=0.006)
    # Every row lands in exactly five windows.
    counts = windowed(ticks(spark, *data).withColumn("one", F.lit(1.0)),
                      [Stat("n", "avg", "one")], time="event_time", key="symbol",
                      size="5 minutes", slide="1 minute")
    windows = {r.window_start for r in counts.collect()}
    expected = {
        at(60 * (t // 60 - i)) for _, _, _, t in data for i in range(5)
    }
    assert windows == expected


def test_size_that_is_no_multiple_of_the_slide(spark):
    rows = ticks(spark, ("A", 1.0, 1.0, 0), ("A", 3.0, 1.0, 119))
    out = indicators.moving_average(rows, size="3 minutes", slide="2 minutes")
    assert {(r.window_start, r.sma_5min) for r in out.collect()} == {(at(-120), 1.0), (at(0), 2.0)}
    assert dict(out.dtypes)["window_start"] == "timestamp_ntz"


def test_low_prices_are_judged_before_rounding(spark):
    """0.004 to 0.0049 is up by 22.5 percent, though both round to 0.00."""
    rows = ticks(spark, ("A", 0.004, 0.0, 0), ("A", 0.0049, 0.0, 10))
    out = indicators.pump_dump(rows, basis="window_range").collect()
    assert {(r.price_max, r.price_min, r.alerta) for r in out} == {(0.0, 0.0, V.PUMP)}
