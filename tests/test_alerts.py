import datetime as dt
import random

import pytest

from tidewatch import values as V
from tidewatch.operators import alerts
from tidewatch.operators.alerts import Rule

ZERO = dt.datetime(2024, 5, 1)
SAMPLE = "metric string, labels map<string,string>, ts timestamp_ntz, value double"
HIGH = Rule("high", "m", ">", 3.0, "1 minute", "warning")


def at(seconds):
    return ZERO + dt.timedelta(seconds=seconds)


def seconds(stamp):
    return None if stamp is None else (stamp - ZERO).total_seconds()


def samples(spark, rows, metric="m"):
    return spark.createDataFrame([(metric, {"l": l}, at(t), v) for l, t, v in rows], SAMPLE)


def runs(frame, rules=(HIGH,), **args):
    out = alerts.sustained(frame, rules, **args).collect()
    return sorted(
        (r.rule, r.labels.get("l"), seconds(r.pending_at), seconds(r.firing_at),
         seconds(r.resolved_at))
        for r in out
    )


def scrape(*values, every=15.0):
    return [("a", i * every, None if v is None else float(v)) for i, v in enumerate(values)]


def test_short_of_the_hold_does_not_fire(spark):
    assert runs(samples(spark, scrape(4, 4, 4, 4, 1))) == [("high", "a", 0.0, None, 60.0)]


def test_fires_after_the_hold_and_resolves(spark):
    assert runs(samples(spark, scrape(4, 4, 4, 4, 4, 1))) == [("high", "a", 0.0, 60.0, 75.0)]


def test_a_false_evaluation_starts_over(spark):
    assert runs(samples(spark, scrape(4, 4, 3, 4, 4, 1))) == [
        ("high", "a", 0.0, None, 30.0), ("high", "a", 45.0, None, 75.0)
    ]


def test_a_last_value_holds_for_the_lookback_only(spark):
    assert runs(samples(spark, [("a", 0.0, 4.0)])) == [("high", "a", 0.0, 60.0, 315.0)]


def test_absence_ends_a_run(spark):
    assert runs(samples(spark, [("a", 0.0, 4.0), ("a", 330.0, 4.0)])) == [
        ("high", "a", 0.0, 60.0, 315.0), ("high", "a", 330.0, 390.0, 645.0)
    ]


def test_bounds_are_strict_and_nan_or_null_is_not_true(spark):
    dump = Rule("dump", "m", "<", -3.0, "1 minute", "critical")
    frame = samples(spark, scrape(3, -3, None, float("nan")))
    assert runs(frame, (dump, HIGH)) == []


def test_production_rules(spark):
    rows = (
        [(V.CHANGE_24H, {"par": p}, at(15 * i), c) for i in range(8)
         for p, c in (("BTCUSDT", -3.5), ("ETHUSDT", -9.0))]
        + [(V.UP, {"job": "crypto-producer"}, at(15 * i), float(i < 2)) for i in range(8)]
        + [(V.UP, {"job": "other"}, at(0), 0.0)]
    )
    out = alerts.sustained(spark.createDataFrame(rows, SAMPLE)).collect()
    assert {(r.rule, r.severity, seconds(r.pending_at), seconds(r.firing_at)) for r in out} == {
        ("BTCDumpDetectado", "critical", 0.0, 60.0), ("ProductorCaido", "critical", 30.0, 60.0)
    }
    assert {(r.rule, r.value) for r in alerts.threshold(spark.createDataFrame(rows, SAMPLE))
            .collect()} == {("BTCDumpDetectado", -3.5), ("ProductorCaido", 0.0)}


def python_runs(rows, step, lookback, hold, limit):
    out = []
    for label in {l for l, _, _ in rows}:
        mine = [(t, v) for l, t, v in rows if l == label]
        pending = None
        for k in range(int((max(t for t, _ in mine) + lookback) // step) + 3):
            now = k * step
            seen = [s for s in mine if s[0] <= now and now - s[0] <= lookback]
            true = bool(seen) and max(seen)[1] > limit
            if true and pending is None:
                pending = now
            elif not true and pending is not None:
                fires = pending + hold
                out.append(("high", label, float(pending), float(fires) if fires < now else None,
                            float(now)))
                pending = None
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("slice_length", ["5 minutes", "17 minutes", "1 hour", "3 days"])
def test_random_series_in_any_slicing(spark, seed, slice_length):
    rnd = random.Random(seed)
    rows, level = [], 0.0
    for _ in range(400):
        if rnd.random() < 0.1:
            level = rnd.uniform(0, 6)
        rows.append((rnd.choice("aaab"), rnd.randrange(4 * 3600), level))
    rows = [(l, float(t), v) for (l, t), v in {(l, t): v for l, t, v in rows}.items()]
    got = runs(samples(spark, rows), slice_length=slice_length)
    assert sorted(got, key=str) == python_runs(rows, 15, 300, 60, 3.0)


def test_a_run_over_many_slices_is_one(spark):
    rows = [("a", 60.0 * i, 5.0) for i in range(600)] + [("a", 36000.0, 0.0)]
    assert runs(samples(spark, rows)) == [("high", "a", 0.0, 60.0, 36000.0)]


def test_transitions(spark):
    frame = alerts.transitions(alerts.sustained(samples(spark, scrape(4, 4, 4, 4, 4, 1)), (HIGH,)))
    assert sorted((seconds(r.at), r.state) for r in frame.collect()) == [
        (0.0, "pending"), (60.0, "firing"), (75.0, "resolved")
    ]


def feed(spark, rows):
    return spark.createDataFrame([(k, at(t)) for k, t in rows],
                                 "symbol string, event_time timestamp_ntz")


def test_silence_edges(spark):
    rows = [("a", 0.0), ("a", 30.0), ("a", 60.001), ("b", 0.0)]
    out = alerts.silences(feed(spark, rows)).collect()
    assert [(r.symbol, seconds(r.silent_from), seconds(r.silent_until)) for r in out] == [
        ("a", 30.0, 60.001)
    ]


@pytest.mark.parametrize("slice_length", ["30 minutes", "1 hour", "1 day"])
def test_silences_in_any_slicing(spark, slice_length):
    rnd = random.Random(8)
    rows, t = [], 0.0
    for _ in range(500):
        t += rnd.choice([0.0, 1.0, 29.5, 30.0, 31.0, 400.0, 2000.0])
        rows.append((rnd.choice("aaab"), t))
    got = sorted(
        (r.symbol, seconds(r.silent_from), seconds(r.silent_until))
        for r in alerts.silences(feed(spark, rows), slice_length=slice_length).collect()
    )
    want = []
    for key in "ab":
        times = sorted(t for k, t in rows if k == key)
        want += [(key, a, b) for a, b in zip(times, times[1:]) if b - a > 30]
    assert got == sorted(want)


@pytest.mark.parametrize("now,want", [
    (30.0, []), (60.0, []), (60.001, ["b"]), (90.001, ["a", "b"]),
])
def test_open_silences(spark, now, want):
    rows = [("a", 0.0), ("a", 29.0), ("a", 60.0), ("b", 0.0), ("b", 30.0), ("c", 0.0), ("c", 90.0)]
    out = alerts.silences(feed(spark, rows), as_of=at(now)).collect()
    open_ = [r for r in out if r.silent_until is None]
    assert sorted(r.symbol for r in open_) == want
    assert {r.symbol: seconds(r.silent_from) for r in open_}.items() <= {"a": 60.0, "b": 30.0}.items()
    ended = {(r.symbol, seconds(r.silent_from)) for r in out if r.silent_until is not None}
    assert ended == {("a", 29.0), ("c", 0.0)}


def test_health_of_a_dead_producer_fires_the_production_rule(spark):
    rows = feed(spark, [(s, 5.0 * i) for i in range(13) for s in "ab"])
    up = alerts.up_samples(rows, at(150))
    values = {seconds(r.ts): r.value for r in up.collect()}
    assert values == {**{15.0 * i: 1.0 for i in range(5)}, **{15.0 * i: 0.0 for i in range(7, 11)}}
    (alert,) = alerts.sustained(up).collect()
    assert (alert.rule, seconds(alert.pending_at), seconds(alert.firing_at)) == (
        "ProductorCaido", 105.0, 135.0
    )
    assert alert.summary and alert.description
