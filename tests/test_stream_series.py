"""Grid, rate and arithmetic on streams give the rows that tables give, in any instalments."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import at, put
from tidewatch import schemas as S
from tidewatch.operators import metrics
from tidewatch.operators import series as tables
from tidewatch.session import work_folder
from tidewatch.sources import table_stream
from tidewatch.streaming import series, sinks

pytestmark = pytest.mark.usefixtures("narrow_state")
END = 100_000
NUMBERS = "labels map<string,string>, eval_ts timestamp, value double"


def gauge_samples(n=900, seed=5):
    """Two metrics of three series; pauses longer than the lookback, repeated times."""
    rnd, t, rows = random.Random(seed), 0.0, []
    for _ in range(n):
        t += rnd.choice([0.0, 0.3, 7.0, 15.0, 15.0, 40.0, 700.0 if rnd.random() < 0.1 else 3.0])
        rows.append((rnd.choice(["m", "k"]), {"l": rnd.choice("abc")}, at(t), rnd.uniform(0, 9)))
    return rows


def counter_samples(n=900, seed=6):
    """Counters with resets, bursts, pauses and two values at one time."""
    rnd, t, rows, now = random.Random(seed), 0.0, [], {"a": 5.0, "b": 0.0}
    for _ in range(n):
        t += rnd.choice([0.0, 1.0, 5.0, 15.0, 15.0, 80.0, 400.0 if rnd.random() < 0.1 else 2.0])
        label = rnd.choice("aab")
        now[label] = 0.0 if rnd.random() < 0.05 else now[label] + rnd.choice([0.0, 1.0, 3.5])
        rows.append(("m", {"l": label}, at(t), now[label]))
    return rows


def run(spark, rows, instalments, start):
    """Start once for each instalment over one checkpoint; two late markers close everything."""
    folder = work_folder(spark, "series")
    rows = sorted(rows, key=lambda r: r[2])
    for i in range(instalments):
        put(spark, folder, rows[i * len(rows) // instalments:(i + 1) * len(rows) // instalments],
            S.SAMPLE)
        start(table_stream(spark, f"{folder}/in", S.SAMPLE), folder)
    for n in (1, 2):
        put(spark, folder, [("m", {"l": "end"}, at(n * END), 1.0)], S.SAMPLE)
        start(table_stream(spark, f"{folder}/in", S.SAMPLE), folder)
    return folder, spark.createDataFrame(rows, S.SAMPLE)


def shown(frame, value="value"):
    kept = frame.where("labels['l'] <> 'end'")
    return sorted((r.labels["l"], r.eval_ts, round(r[value], 9)) for r in kept.collect())


@pytest.mark.parametrize("instalments", [1, 4])
def test_grid_equals_the_table(spark, instalments):
    rows = [r for r in gauge_samples() if r[0] == "m"]
    folder, table = run(spark, rows, instalments, lambda stream, folder: series.start_grid(
        spark, stream, folder, trigger=sinks.ONCE, wait=True))
    want = tables.on_grid(tables.distinct_samples(table))
    got = spark.read.schema(NUMBERS).parquet(f"{folder}/result")
    assert shown(got) == shown(want) and want.count() > 500


@pytest.mark.parametrize("instalments,lookback", [(1, "5 minutes"), (4, "1 minute")])
def test_difference_equals_the_table(spark, instalments, lookback):
    def less(a, b):
        return a - b

    folder, table = run(
        spark, gauge_samples(), instalments,
        lambda stream, folder: series.start_combined(
            spark, stream, folder, "m", "k", less, lookback=lookback, trigger=sinks.ONCE,
            wait=True),
    )
    want = metrics.combine(tables.distinct_samples(table), "m", "k", less, lookback=lookback)
    got = spark.read.schema(NUMBERS).parquet(f"{folder}/result")
    assert shown(got) == shown(want) and want.count() > 300


@pytest.mark.parametrize("instalments,window,step,extrapolate", [
    (1, "1 minute", "15 seconds", True), (4, "1 minute", "15 seconds", True),
    (3, "90 seconds", "1 minute", False), (2, "20 seconds", "30 seconds", True),
])
def test_rate_equals_the_table(spark, instalments, window, step, extrapolate):
    args = dict(window=window, step=step, extrapolate=extrapolate)
    folder, table = run(spark, counter_samples(), instalments,
                        lambda stream, folder: series.start_rate(
                            spark, stream, folder, trigger=sinks.ONCE, wait=True, **args))
    want = tables.rate(table, **args)
    rows = "labels map<string,string>, eval_ts timestamp, rate double"
    got = spark.read.schema(rows).parquet(f"{folder}/result")
    assert shown(got, "rate") == shown(want, "rate") and want.count() > 100


def test_series_aggregate_at_each_step(spark):
    rows = counter_samples(500)
    folder, table = run(spark, rows, 4, lambda stream, folder: series.start_across(
        spark, stream, folder, trigger=sinks.ONCE, wait=True))
    rates = tables.rate(table)
    last = rates.agg(F.max("eval_ts")).first()[0]
    want = metrics.across(rates, "rate").where(
        F.col("eval_ts") <= F.lit(last) - F.expr("INTERVAL 75 SECONDS"))
    got = spark.read.schema("eval_ts timestamp, rate double").parquet(f"{folder}/across")

    def plain(frame):
        return sorted((r.eval_ts, round(r.rate, 9)) for r in frame.collect())

    assert plain(got) == plain(want) and want.count() > 50


def test_state_is_bounded(spark):
    """A series keeps one window's cells, and nothing once the watermark is past its last."""
    folder = work_folder(spark, "series")
    rows = [("m", {"l": "a"}, at(i), float(i)) for i in range(0, 6000, 5)]
    started = []

    def again(extra):
        put(spark, folder, extra, S.SAMPLE)
        started.append(series.start_rate(
            spark, table_stream(spark, f"{folder}/in", S.SAMPLE), folder, trigger=sinks.ONCE,
            wait=True))

    again(rows)
    again([("m", {"l": "end"}, at(END), 1.0)])
    again([("m", {"l": "end"}, at(2 * END), 1.0)])
    following = [p["stateOperators"][0]["numRowsTotal"] for q in started
                 for p in q[1].recentProgress]
    assert max(following) <= 2 and following[-1] <= 1
    assert spark.read.parquet(f"{folder}/result").where("labels['l'] = 'a'").count() == 403
