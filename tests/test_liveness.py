"""Silences and the producer's health while the feeds lag behind the clock."""

import datetime as dt
import random
import time

import pytest

from tests.test_streaming import at, finish, message, put
from tidewatch import schemas as S
from tidewatch import values as V
from tidewatch.operators import alerts
from tidewatch.operators.alerts import RULES
from tidewatch.session import work_folder
from tidewatch.sources import record_files, table_stream
from tidewatch.streaming import jobs, liveness, sinks
from tidewatch.streaming.alerts import follow_steps

pytestmark = pytest.mark.usefixtures("narrow_state")
CLOCK = "event_time timestamp"


class Watch:
    """Rows and beats, a file each, read one a trigger."""

    def __init__(self, spark):
        self.spark, self.folder = spark, work_folder(spark, "liveness")

    def rows(self, *pairs):
        put(self.spark, f"{self.folder}/rows", [(k, 1.0, 0.0, at(t)) for k, t in pairs])

    def beats(self, *times):
        for t in times:
            put(self.spark, f"{self.folder}/clock", [(at(t),)], CLOCK)

    def listen(self):
        def stream(name):
            path = f"{self.folder}/{name}/in"
            return table_stream(self.spark, path, self.spark.read.parquet(path).schema, 1)

        liveness.start_presence(stream("rows"), stream("clock"), self.folder, trigger=sinks.ONCE
                                ).awaitTermination()
        return liveness.presence_stream(self.spark, self.folder, 1)

    def silences(self, **more):
        finish(liveness.silences(self.listen(), **more), self.folder)
        found = self.spark.read.parquet(f"{self.folder}/out").collect()
        assert all(r.silent_after - r.silent_from == dt.timedelta(seconds=30) for r in found)
        return sorted((r.feed, r.silent_from) for r in found)

    def table(self, until):
        rows = self.spark.read.parquet(f"{self.folder}/rows/in")
        return sorted((r.symbol, r.silent_from)
                      for r in alerts.silences(rows, as_of=at(until)).collect())


@pytest.fixture
def watch(spark):
    return Watch(spark)


def test_backlog_beside_a_clock_that_is_ahead(watch):
    """Ticks 24 to 60 minutes old, a file a trigger, beats at now: every silence is found."""
    for start in (0, 400, 800, 1200, 1600):
        watch.rows(*[("A", start + i) for i in range(0, 200, 10)],
                   *[("B", start + i) for i in range(0, 330, 10)])
    watch.beats(*[3600] * 7)
    got = watch.silences()
    assert got == watch.table(3600) and len(got) == 10


def test_beats_wait_for_rows(watch):
    watch.rows(("A", 0))
    watch.rows(("A", 20))
    watch.beats(5000, 5001, 5002)
    presence = watch.listen()
    assert presence.isStreaming
    kept = watch.spark.read.schema(liveness.PRESENCE).parquet(f"{watch.folder}/presence")
    assert sorted(str(r.beat) for r in kept.collect()) == sorted(
        ["None", "None", str(at(5002))])


def test_feeds_that_lag_behind_one_another(watch):
    """A is read up to minute 60 before B's first row: nothing of B is late."""
    watch.rows(*[("A", t) for t in range(0, 3600, 15)])
    watch.rows(*[("B", t) for t in range(0, 900, 15)])
    watch.rows(*[("B", t) for t in range(1200, 3000, 15)], ("A", 3600))
    watch.beats(*[4000] * 5)
    assert watch.silences() == watch.table(4000) == [
        ("A", at(3600)), ("B", at(885)), ("B", at(2985))
    ]


def test_random_feeds_in_instalments_equal_the_table(watch):
    rnd, t, rows = random.Random(11), 0.0, []
    for _ in range(400):
        t += rnd.choice([1.0, 29.0, 30.0, 31.0, 90.0])
        rows.append((rnd.choice("ab"), t))
    for i in range(0, 400, 134):
        part = rows[i:i + 134]
        rnd.shuffle(part)
        watch.rows(*part)
    watch.beats(*[t + 1000] * 5)
    assert watch.silences() == watch.table(t + 1000)


def test_rows_out_of_order_within_the_delay(watch):
    watch.rows(("A", 0), ("A", 70))
    watch.rows(("A", 40), ("A", 20), ("A", 95))
    watch.rows(("A", 400))
    watch.beats(*[1000] * 5)
    assert watch.silences() == [("A", at(95)), ("A", at(400))]


def test_presence_that_is_written_twice_says_nothing_new(watch):
    watch.rows(("A", 0), ("A", 20))
    watch.beats(*[1000] * 3)
    watch.listen()
    kept = watch.spark.read.schema(liveness.PRESENCE).parquet(f"{watch.folder}/presence")
    names = liveness.PRESENCE.names
    again = watch.spark.createDataFrame(kept.select(names).collect(), liveness.PRESENCE)
    again.coalesce(1).write.parquet(f"{watch.folder}/presence/run=x/batch=9")
    finish(liveness.silences(liveness.presence_stream(watch.spark, watch.folder)), watch.folder)
    found = watch.spark.read.parquet(f"{watch.folder}/out").collect()
    assert [(r.feed, r.silent_from) for r in found] == [("A", at(20))]


def test_health_under_backlog(watch):
    """Down for five minutes within the backlog, and at its end; up while it is being read."""
    for start in (0, 200, 700, 900, 1100):
        watch.rows(*[("A", t) for t in range(start, start + 200, 5)])
    watch.beats(*[3600] * 8)
    on_health = [r for r in RULES if r.metric == V.UP]
    follow_steps(watch.spark, liveness.health(watch.listen()), f"{watch.folder}/up", on_health,
                 trigger=sinks.ONCE, wait=True)
    changes = watch.spark.read.parquet(f"{watch.folder}/up/changes").collect()
    assert {(r.rule, r.state, r.at) for r in changes if r.at > at(30)} == {
        ("ProductorCaido", "pending", at(435)), ("ProductorCaido", "firing", at(465)),
        ("ProductorCaido", "resolved", at(705)), ("ProductorCaido", "pending", at(1335)),
        ("ProductorCaido", "firing", at(1365)),
    }


def test_all_rules_of_the_job_with_backlog_and_the_real_clock(spark):
    """An hour-old backlog, one file a trigger: all of it counts, then the producer is down."""
    folder = work_folder(spark, "job")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    first = now - dt.timedelta(minutes=60)
    shift = (first - at(0)).total_seconds()
    for part in range(4):
        # Minutes 0 to 6, 9 to 15, 18 to 24 and 27 to 33: three silences, and the last.
        rows = [message("btcusdt-ticker", shift + 540 * part + 5 * i, symbol="BTCUSDT", price=1.0,
                        change_pct=-4.0 if part < 2 else 4.0) for i in range(72)]
        spark.createDataFrame(rows, S.RECORD).coalesce(1).write.mode("append").parquet(
            f"{folder}/bus")
    job = jobs.Job(f"{folder}/h", f"{folder}/c", f"{folder}/r", trigger=sinks.every("1 second"))
    started = jobs.start_alerting(
        spark, lambda topics: record_files(spark, f"{folder}/bus", topics=topics, streaming=True,
                                           files_per_trigger=1), job,
    )

    def found(path, schema):
        return spark.read.schema(schema).parquet(f"{folder}/r/{path}").collect()

    changes = "rule string, state string, at timestamp, pending_at timestamp"
    ends = [first + dt.timedelta(seconds=540 * part + 355) for part in range(4)]
    try:
        deadline = time.time() + 150
        while time.time() < deadline:
            time.sleep(2)
            assert all(q.exception() is None for q in started.values())
            try:
                silent = found("silences", "symbol string, silent_from timestamp")
                health = found("alerts-up/changes", changes)
            except Exception:
                continue
            if len(silent) >= 4 and sum(r.state == "firing" for r in health) >= 4:
                break
        gauges = found("alerts/changes", changes)
    finally:
        for query in started.values():
            query.stop()
    assert sorted(r.silent_from for r in silent) == ends
    # Down after each part for longer than half a minute, never before the part's end.
    firing = sorted(r.pending_at for r in health if r.state == "firing" and r.at > first)
    assert len(firing) == 4
    assert all(dt.timedelta(0) < f - e <= dt.timedelta(seconds=46) for f, e in zip(firing, ends))
    assert {(r.rule, r.state) for r in gauges} >= {
        ("BTCDumpDetectado", "firing"), ("BTCPumpDetectado", "firing"),
    }


@pytest.mark.parametrize("policy", ["min", "max"])
def test_deviation_goes_on_without_a_silent_feed_under_max(spark, policy):
    """The market stops at minute 5, ticks go on: what both had waits for it, or does not."""
    folder = work_folder(spark, "policy")
    rows = []
    for i in range(0, 1200, 5):
        rows.append(message("btcusdt-ticker", i, symbol="BTCUSDT", price=101.0))
        if i % 30 == 0 and i < 300:
            rows.append(message(V.MARKET_TOPIC, i, symbol="BTCUSDT", price_usd=100.0,
                                market_cap=2e12))
    spark.createDataFrame(rows, S.RECORD).coalesce(1).write.parquet(f"{folder}/bus")
    job = jobs.Job(f"{folder}/h", f"{folder}/c", f"{folder}/r", watermark_policy=policy,
                   trigger=sinks.ONCE)
    for running in jobs.start(
        spark, lambda topics: record_files(spark, f"{folder}/bus", topics=topics,
                                           streaming=True), job).values():
        running.awaitTermination()
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"
    found = spark.read.schema("window_end timestamp, deviation_pct double").parquet(
        f"{folder}/r/deviation").collect()
    # The market's watermark stands two minutes before 270, the ticks' at 1075.
    ended = {"min": 2, "max": 5}[policy]
    assert sorted(r.window_end for r in found) == [at(60 * (i + 1)) for i in range(ended)]
    assert {r.deviation_pct for r in found} == {1.0}
