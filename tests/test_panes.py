"""Windows made of closed panes, and the job that shares them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import at, bus, dropped, finish, put
from tidewatch.operators import indicators
from tidewatch.operators.windows import Stat, pane_length, windowed, windowed_stream
from tidewatch.session import work_folder
from tidewatch.sources import record_files, table_stream
from tidewatch.streaming import jobs, sinks


pytestmark = pytest.mark.usefixtures("narrow_state")


def shown(frame):
    return sorted(map(str, frame.collect()))


def ticks(n=500, seed=2):
    """Prices that a plain sum of squares would lose the deviation of; some null."""
    rnd = random.Random(seed)
    return [("A" if rnd.random() < 0.8 else "B",
             None if rnd.random() < 0.05 else 1e7 + rnd.uniform(-1, 1),
             rnd.gauss(0, 3), at(rnd.uniform(0, 3600))) for _ in range(n)]


@pytest.mark.parametrize("batches", [1, 4])
def test_chained_panes_equal_the_table(spark, batches):
    folder = work_folder(spark, "test")
    rows = sorted(ticks(), key=lambda r: r[3])
    for make, delay in ((indicators.moving_average, 120), (indicators.pump_dump, 60)):
        target = work_folder(spark, "test")
        for i in range(batches):
            part = rows[i * len(rows) // batches:(i + 1) * len(rows) // batches]
            schema = put(spark, target, part)
            finish(make(table_stream(spark, f"{target}/in", schema), late="pane"), target)
        limit = rows[-1][3] - dt.timedelta(seconds=delay)
        table = spark.createDataFrame(rows, schema)
        want = make(table).where(F.col("window_end") <= F.lit(limit))
        got = spark.read.parquet(f"{target}/out")
        assert shown(got) == shown(want.select(got.columns)) and got.count() > 50, folder


def test_rows_are_not_copied_into_windows(spark):
    folder = work_folder(spark, "test")
    schema = put(spark, folder, ticks(50))
    stream = indicators.moving_average(table_stream(spark, f"{folder}/in", schema), late="pane")
    query = finish(stream, folder)
    plan = query._jsq.explainInternal(False)
    # One copy step, and below it an aggregation that has no other beneath it.
    assert plan.count("Expand") == 1
    assert plan.index("Expand") < plan.rindex("StateStoreSave")
    assert len(query.lastProgress["stateOperators"]) == 2


def test_late_rows_count_up_to_their_panes_end(spark):
    """At a watermark of 480: minute 7 is closed as a pane, though windows with it are open."""
    got = {}
    for late in ("window", "pane"):
        folder = work_folder(spark, "test")
        put(spark, folder, [("A", 1.0, 0.0, at(30)), ("A", 9.0, 0.0, at(600))])

        def run():
            schema = spark.read.parquet(f"{folder}/in").schema
            stream = table_stream(spark, f"{folder}/in", schema)
            return finish(indicators.moving_average(stream, late=late), folder)

        run()
        put(spark, folder, [("A", 5.0, 0.0, at(450)), ("A", 7.0, 0.0, at(485)),
                            ("A", 1.0, 0.0, at(1500))])
        lost = dropped(run())
        rows = spark.read.parquet(f"{folder}/out").collect()
        got[late] = {r.window_end: (r.price_min, r.price_max) for r in rows}
        assert lost >= 1
    assert got["window"][at(540)] == (5.0, 7.0) and got["pane"][at(540)] == (7.0, 7.0)
    assert set(got["window"]) == set(got["pane"])


@pytest.mark.parametrize("size,slide", [("5 minutes", "2 minutes"), ("90 seconds", "1 minute"),
                                        ("1 minute", "1 minute")])
def test_panes_need_not_be_a_slide_long(spark, size, slide):
    """Panes of the longest span that divides both; the same rows as by plain grouping."""
    table = spark.createDataFrame(ticks(), "symbol string, price double, change_pct double, t timestamp")
    stats = [Stat("m", "avg", "price"), Stat("s", "stddev", "price"), Stat("h", "max", "price")]
    args = dict(time="t", key="symbol", size=size, slide=slide)
    got = windowed(table, stats, **args)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    want = windowed_stream(table, stats, **args)

    def rounded(rows, start):
        return sorted(((r[start] if start else r.window.start), r.symbol, round(r.m, 4),
                       None if r.s is None else round(r.s, 4), r.h) for r in rows.collect()
                      if r.m is not None)

    assert rounded(got, "window_start") == rounded(want, None)
    assert pane_length("5 minutes", "2 minutes") == "60000000 microseconds"


def test_unknown_lateness_is_refused(spark):
    table = spark.createDataFrame(ticks(5), "symbol string, price double, change_pct double, event_time timestamp")
    with pytest.raises(ValueError, match="late"):
        indicators.moving_average(table, late="never")


def test_the_job_reads_ticks_once_for_all_indicators(spark):
    folder = work_folder(spark, "job")
    bus(spark, folder)
    read = []

    def source(topics):
        read.append(tuple(topics))
        return record_files(spark, f"{folder}/bus", topics=topics, streaming=True)

    job = jobs.Job(f"{folder}/history", f"{folder}/checkpoints", f"{folder}/results",
                   trigger=sinks.ONCE, shared_panes=True)
    queries = jobs.start(spark, source, job)
    for query in queries.values():
        query.awaitTermination()
    inputs = {n: [s["description"] for s in q.lastProgress["sources"]] for n, q in queries.items()}
    from_bus = sorted(n for n, found in inputs.items() if any("/bus" in d for d in found))
    # One reading for the panes; the deviation's is that of the market.
    assert from_bus == ["coingecko", "deviation", "feargreed", "klines", "panes", "tickers"]
    assert [len(inputs[n]) for n in ("panes", "sma", "pump_dump", "deviation")] == [1, 1, 1, 2]

    ticks = jobs.open_feeds(lambda topics: record_files(spark, f"{folder}/bus", topics=topics))
    limit = at(1195 - 120 - 30)
    for name, make in (("sma", indicators.moving_average), ("pump_dump", indicators.pump_dump)):
        want = make(ticks.tickers.valid())
        got = spark.read.parquet(f"{folder}/results/{name}")
        ended = want.where(F.col("window_end") <= F.lit(limit)).select(got.columns)
        assert shown(got) == shown(ended) and got.count() > 20
    deviation = spark.read.parquet(f"{folder}/results/deviation")
    plain = indicators.price_deviation(
        ticks.tickers.valid(), ticks.market.valid(),
        local_name="local_price", global_name="global_price")
    assert 0 < deviation.count() <= plain.count()


def test_panes_as_a_table_make_the_same_windows(spark):
    """The pane table can be read again later, for instance with other window sizes."""
    folder = work_folder(spark, "test")
    rows = ticks() + [("end", 1.0, 0.0, at(20_000))]
    schema = put(spark, folder, rows)
    panes = indicators.tick_panes(table_stream(spark, f"{folder}/in", schema))
    finish(panes, folder)
    kept = spark.read.parquet(f"{folder}/out")
    table = spark.createDataFrame(rows[:-1], schema)
    for of_panes, direct, sizes in (
        (indicators.moving_average_of_panes, indicators.moving_average, {}),
        (indicators.moving_average_of_panes, indicators.moving_average,
         dict(size="10 minutes", slide="2 minutes")),
        (indicators.pump_dump_of_panes, indicators.pump_dump, {}),
    ):
        want = direct(table, **sizes)
        assert shown(of_panes(kept, **sizes).select(want.columns)) == shown(want)
