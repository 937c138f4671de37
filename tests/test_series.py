"""Grid, rates and counters against plain Python, whatever the slice length."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewatch import values as V
from tidewatch.operators import metrics, series

ZERO = dt.datetime(2024, 5, 1)
SAMPLE = "metric string, labels map<string,string>, ts timestamp_ntz, value double"


def at(seconds):
    return ZERO + dt.timedelta(seconds=seconds)


def seconds(stamp):
    return (stamp - ZERO).total_seconds()


def samples(spark, rows):
    """(label, seconds, value) rows of one metric."""
    return spark.createDataFrame([("m", {"l": l}, at(t), v) for l, t, v in rows], SAMPLE)


def random_rows(seed, n=300, span=7200, counter=False, grain=1000):
    rnd = random.Random(seed)
    rows, level = [], {"a": 0.0, "b": 0.0}
    times = sorted({(rnd.choice("aaab"), rnd.randrange(span * grain) / grain) for _ in range(n)},
                   key=lambda r: r[1])
    for l, t in times:
        if counter:
            level[l] = 0.0 if rnd.random() < 0.1 else level[l] + rnd.randrange(5)
        else:
            level[l] = rnd.uniform(-5, 5)
        rows.append((l, t, level[l]))
    return rows


def python_grid(rows, step, lookback):
    out = {}
    last_step = max(t for _, t, _ in rows) + lookback + step
    for label in {l for l, _, _ in rows}:
        mine = [(t, v) for l, t, v in rows if l == label]
        at_step = 0
        while at_step <= last_step:
            seen = [(t, v) for t, v in mine if t <= at_step and at_step - t <= lookback]
            if seen:
                out[(label, at_step)] = max(seen)[1]
            at_step += step
    return out


@pytest.mark.parametrize("slice_length", ["1 hour", "6 minutes", "5 days"])
@pytest.mark.parametrize("step,lookback", [(15, 300), (60, 90)])
def test_grid(spark, slice_length, step, lookback):
    rows = random_rows(1) + [("edge", 0.0, 1.0), ("edge", 1000.0, 2.0), ("edge", 1000.001, 3.0)]
    out = series.on_grid(samples(spark, rows), step=f"{step} seconds",
                         lookback=f"{lookback} seconds", slice_length=slice_length)
    got = {(r.labels["l"], seconds(r.eval_ts)): r.value for r in out.collect()}
    assert got == python_grid(rows, step, lookback)
    assert out.count() == len(got)


def test_grid_value_is_gone_after_the_lookback(spark):
    out = series.on_grid(samples(spark, [("a", 0.0, 7.0)])).collect()
    assert sorted(seconds(r.eval_ts) for r in out) == [15.0 * i for i in range(21)]


def test_sample_on_a_step_counts_for_it(spark):
    out = series.on_grid(samples(spark, [("a", 15.0, 1.0), ("a", 15.001, 2.0)])).collect()
    assert {seconds(r.eval_ts): r.value for r in out}[15.0] == 1.0
    assert {seconds(r.eval_ts): r.value for r in out}[30.0] == 2.0


def python_rate(rows, window, step, extrapolate):
    out = {}
    for label in {l for l, _, _ in rows}:
        mine = sorted((t, v) for l, t, v in rows if l == label)
        at_step = 0
        while at_step <= mine[-1][0] + window:
            seen = [(t, v) for t, v in mine if at_step - window < t <= at_step]
            if len(seen) >= 2:
                increase = seen[-1][1] - seen[0][1]
                for (_, a), (_, b) in zip(seen, seen[1:]):
                    if b < a:
                        increase += a
                span = seen[-1][0] - seen[0][0]
                if extrapolate:
                    gap = span / (len(seen) - 1)
                    head, tail = seen[0][0] - (at_step - window), at_step - seen[-1][0]
                    head = head if head < 1.1 * gap else gap / 2
                    tail = tail if tail < 1.1 * gap else gap / 2
                    if increase > 0 and seen[0][1] >= 0:
                        head = min(head, span * seen[0][1] / increase)
                    increase *= (span + head + tail) / span
                out[(label, at_step)] = increase / window
            at_step += step
    return out


@pytest.mark.parametrize("extrapolate", [True, False])
@pytest.mark.parametrize("window,step,slice_length", [
    (60, 15, "1 hour"), (60, 15, "1 minute"), (300, 60, "7 minutes"), (90, 60, "1 hour"),
    (20, 60, "10 minutes"),
])
def test_rate(spark, extrapolate, window, step, slice_length):
    rows = random_rows(2, n=600, counter=True)
    copies = rows + rows[::3]
    out = series.rate(samples(spark, copies), window=f"{window} seconds", step=f"{step} seconds",
                      extrapolate=extrapolate, slice_length=slice_length)
    got = {(r.labels["l"], seconds(r.eval_ts)): r.rate for r in out.collect()}
    want = python_rate(rows, window, step, extrapolate)
    assert got.keys() == want.keys()
    assert out.count() == len(got)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-12)


def test_counter_reset(spark):
    rows = [("a", 10.0, 5.0), ("a", 20.0, 9.0), ("a", 30.0, 2.0), ("a", 40.0, 4.0)]
    out = series.rate(samples(spark, rows), extrapolate=False).collect()
    rates = {seconds(r.eval_ts): r.rate for r in out}
    assert rates[60.0] == pytest.approx(8 / 60)
    assert rates[75.0] == pytest.approx(4 / 60)  # 9, 2, 4: the 9 is only the starting point


def test_extrapolation_stops_where_the_counter_would_be_zero(spark):
    rows = [("a", 15.0, 1.0), ("a", 30.0, 31.0)]
    rate = {seconds(r.eval_ts): r.rate for r in series.rate(samples(spark, rows)).collect()}
    # At the start 0.5 s to zero, at the end a half distance (30 s away).
    assert rate[60.0] == pytest.approx(30 * (15 + 0.5 + 7.5) / 15 / 60)


def test_unique_samples_skip_a_pass_and_agree(spark):
    rows = samples(spark, random_rows(5, counter=True))
    plain, unique = series.rate(rows), series.rate(rows, unique=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, unique.collect()))


def test_contradicting_samples_settle_on_the_largest(spark):
    rows = samples(spark, [("a", 1.0, 3.0), ("a", 1.0, 4.0), ("a", 1.0, 4.0), ("a", 2.0, 1.0)])
    out = series.distinct_samples(rows)
    assert sorted((seconds(r.ts), r.value) for r in out.collect()) == [(1.0, 4.0), (2.0, 1.0)]
    assert out.columns == rows.columns


def test_label_order_does_not_split_a_series(spark):
    rows = spark.createDataFrame(
        [("m", {"a": "1", "b": "2"}, at(1), 1.0), ("m", {"b": "2", "a": "1"}, at(2), 2.0)], SAMPLE
    )
    assert len({str(r.labels) for r in series.on_grid(rows).collect()}) == 1


@pytest.mark.parametrize("restart", [None, "1 hour", "1 day"])
def test_message_counter(spark, restart):
    rnd = random.Random(4)
    rows = [(rnd.choice("xxy"), rnd.uniform(0, 3 * 86400)) for _ in range(500)]
    rows += [("x", 86400.0), ("x", 86400.5)]
    frame = spark.createDataFrame([(l, at(t)) for l, t in rows],
                                  "topic string, event_time timestamp_ntz")
    out = metrics.message_counter(frame, every="5 minutes", restart=restart)
    got = {(r.labels["topic"], seconds(r.ts)): r.value for r in out.collect()}
    period = {None: math.inf, "1 hour": 3600, "1 day": 86400}[restart]
    want = {}
    for topic in "xy":
        for t in {math.ceil(t / 300) * 300 for l, t in rows if l == topic}:
            begin = -math.inf if restart is None else (math.ceil(t / period) - 1) * period
            want[(topic, float(t))] = float(
                sum(1 for l, u in rows if l == topic and begin < u <= t)
            )
    assert got == want


def test_selectors(spark):
    rows = spark.createDataFrame(
        [("m", {"par": "A"}, at(0), 1.0), ("m", {"par": "B"}, at(0), 2.0), ("m", {}, at(0), 3.0),
         ("m", {"par": ""}, at(0), 4.0), ("n", {"par": "A"}, at(0), 5.0)], SAMPLE
    )

    def values(**how):
        return sorted(r.value for r in metrics.select(rows, "m", **how).collect())

    assert values() == [1.0, 2.0, 3.0, 4.0]
    assert values(equal={"par": "A"}) == [1.0]
    assert values(equal={"par": ""}) == [3.0, 4.0]
    assert values(unequal={"par": ""}) == [1.0, 2.0]


def test_last_value_breaks_ties(spark):
    rows = spark.createDataFrame(
        [("A", 1.0, at(5), 1), ("A", 2.0, at(5), 2), ("A", 3.0, at(4), 9), ("A", 4.0, None, 9)],
        "symbol string, price double, event_time timestamp_ntz, id bigint",
    )
    out = metrics.last_value(rows, ["price"], keys=["symbol"], tiebreak="id").collect()
    assert [tuple(r) for r in out] == [("A", 2.0)]


def test_outcomes(spark):
    rows = spark.createDataFrame([(True,), (False,), (None,), (True,)], "ok boolean")
    assert tuple(metrics.outcome_counts(rows, F.col("ok")).first()) == (2, 2)


def test_gauges_and_panels(spark):
    ticks = spark.createDataFrame(
        [("A", 2.0, 3.0, 4.0, at(0))],
        "symbol string, price double, change_pct double, volume_24h double,"
        " event_time timestamp_ntz",
    )
    got = {(r.metric, r.labels["par"], r.value) for r in metrics.tick_gauges(ticks).collect()}
    assert got == {(V.PRICE_NOW, "A", 2.0), (V.CHANGE_24H, "A", 3.0), (V.VOLUME_24H, "A", 4.0)}
    world = ticks.withColumnRenamed("price", "price_usd").withColumn("market_cap", F.lit(9.0))
    assert {(r.metric, r.value) for r in metrics.market_gauges(world).collect()} == {
        (V.MARKET_PRICE, 2.0), (V.MARKET_CAP, 9.0), (V.MARKET_VOLUME, 4.0)
    }
    mood = ticks.select(F.lit(7).alias("value"), "event_time")
    assert [(r.metric, r.labels, r.value) for r in metrics.sentiment_gauge(mood).collect()] == [
        (V.SENTIMENT_INDEX, {}, 7.0)
    ]


def test_host_panels(spark):
    gib = 1024.0**3
    rows = spark.createDataFrame(
        [(V.NODE_MEMORY_TOTAL, {}, at(0), 8 * gib), (V.NODE_MEMORY_AVAILABLE, {}, at(0), 3 * gib),
         (V.NODE_MEMORY_TOTAL, {"host": "b"}, at(0), gib)]
        + [(V.NODE_CPU, {"mode": "idle", "cpu": c}, at(t), t * share)
           for c, share in (("0", 0.5), ("1", 1.0)) for t in range(0, 121, 15)]
        + [(V.NODE_CPU, {"mode": "user", "cpu": "0"}, at(t), 9.0 * t) for t in range(0, 121, 15)]
        + [(V.CONTAINER_MEMORY, {"name": "c"}, at(0), 1024.0**2 * 5)]
        + [(V.CONTAINER_CPU, {"name": n}, at(t), t / 4) for n in ("c", "") for t in (0, 15, 30)],
        SAMPLE,
    )
    memory = metrics.host_memory(rows).collect()
    assert {(str(r.labels), r.value) for r in memory} == {("{}", 5.0)} and len(memory) == 21
    cpu = {seconds(r.eval_ts): r.value for r in metrics.host_cpu(rows).collect()}
    assert cpu[90.0] == pytest.approx(25.0)
    assert {r.value for r in metrics.memory_by_container(rows).collect()} == {5.0}
    busy = metrics.cpu_by_container(rows).collect()
    assert {r.labels["name"] for r in busy} == {"c"}
