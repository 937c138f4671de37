import datetime as dt
import json
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch import values as V
from tidewatch.operators import alerts, indicators, metrics
from tidewatch.operators.alerts import Rule
from tidewatch.operators.enrich import stamp
from tidewatch.session import remove_folder, work_folder, written_folders
from tidewatch.sources import record_files, table_stream, text_messages, whole_documents
from tidewatch.streaming import jobs, sinks
from tidewatch.streaming.alerts import start_alerts

ZERO = dt.datetime(2024, 5, 1)


def at(seconds):
    return ZERO + dt.timedelta(seconds=seconds)


TICK = "symbol string, price double, change_pct double, event_time timestamp"


def put(spark, folder, rows, schema=TICK):
    frame = spark.createDataFrame(rows, schema)
    frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return frame.schema


def finish(stream, folder, partition_by=()):
    query = sinks.to_history(stream, f"{folder}/out", f"{folder}/checkpoint", partition_by,
                             sinks.ONCE)
    query.awaitTermination()
    return query


def dropped(query):
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress
               for o in p["stateOperators"])


def test_late_rows_are_dropped_and_counted(spark):
    folder = work_folder(spark, "test")
    schema = put(spark, folder, [("A", 1.0, 0.0, at(30)), ("A", 9.0, 0.0, at(600))])

    def run():
        stream = indicators.local_price(table_stream(spark, f"{folder}/in", schema))
        return finish(stream, folder)

    assert dropped(run()) == 0
    # The watermark stands at 480: a row of minute 7 is late, one of minute 8 is not.
    put(spark, folder, [("A", 5.0, 0.0, at(450)), ("A", 7.0, 0.0, at(485)),
                        ("A", 1.0, 0.0, at(900))])
    assert dropped(run()) == 1
    got = {(r.window_start, r.local_price) for r in
           spark.read.parquet(f"{folder}/out").collect()}
    assert got == {(at(0), 1.0), (at(480), 7.0), (at(600), 9.0)}


def test_restart_loses_and_repeats_nothing(spark):
    folder = work_folder(spark, "test")
    for part in range(3):
        schema = put(spark, folder,
                     [("A", float(10 * part + i), 0.0, at(i)) for i in range(10)])
        stream = stamp(table_stream(spark, f"{folder}/in", schema), F.col("event_time"))
        finish(stream, folder, V.HISTORY["tickers"])
    rows = spark.read.parquet(f"{folder}/out")
    assert sorted(r.price for r in rows.collect()) == [float(i) for i in range(30)]


def test_streams_equal_tables_behind_the_watermark(spark):
    rnd = random.Random(2)
    folder = work_folder(spark, "test")
    rows = [("A" if rnd.random() < 0.8 else "B", rnd.uniform(99, 101), rnd.gauss(0, 3),
             at(rnd.uniform(0, 3600))) for _ in range(500)]
    schema = put(spark, folder, rows)
    table = spark.read.parquet(f"{folder}/in")
    horizon = max(r[3] for r in rows)
    for make, delay in ((indicators.moving_average, 120), (indicators.pump_dump, 60)):
        target = work_folder(spark, "test")
        finish(make(table_stream(spark, f"{folder}/in", schema)), target)
        got = sorted(map(str, spark.read.parquet(f"{target}/out").collect()))
        limit = horizon - dt.timedelta(seconds=delay)
        want = make(table).where(F.col("window_end") <= F.lit(limit))
        assert got == sorted(map(str, want.collect())) and got


def test_alert_stream_in_instalments_equals_the_table(spark):
    rnd = random.Random(5)
    rules = (Rule("high", "m", ">", 3.0, "1 minute", "warning"),
             Rule("low", "m", "<", 1.0, "10 minutes", "info", {"l": "a"}))
    level, rows = 2.0, []
    for i in range(1200):
        if rnd.random() < 0.08:
            level = rnd.uniform(0, 6)
        if rnd.random() < 0.6:
            rows.append(("m", {"l": rnd.choice("ab")}, at(12 * i + rnd.random()), level))
    # An end marker moves the watermark past everything else; nothing holds for it.
    rows.append(("m", {"l": "end"}, at(12 * 1200 + 3600), 2.0))
    rows.append(("m", {"l": "end"}, at(12 * 1200 + 7200), 2.0))
    folder = work_folder(spark, "test")
    for start in range(0, len(rows), 150):
        put(spark, folder, rows[start:start + 150], S.SAMPLE)
        start_alerts(spark, table_stream(spark, f"{folder}/in", S.SAMPLE), folder, rules,
                     trigger=sinks.ONCE, wait=True)
    got = spark.read.parquet(f"{folder}/changes")
    want = alerts.transitions(alerts.sustained(spark.read.parquet(f"{folder}/in"), rules))

    def plain(frame):
        return sorted((r.rule, r.labels["l"], r.at, r.state, r.pending_at)
                      for r in frame.collect())

    assert plain(got) == plain(want)
    assert {r.state for r in got.collect()} == {"pending", "firing", "resolved"}


def test_silence_stream_finds_what_the_table_has(spark):
    rnd = random.Random(6)
    folder, t, rows = work_folder(spark, "test"), 0.0, []
    for _ in range(300):
        t += rnd.choice([1.0, 29.0, 30.0, 31.0, 90.0])
        rows.append((rnd.choice("ab"), 1.0, 0.0, at(t)))
    schema = put(spark, folder, rows)
    finish(alerts.silences_stream(table_stream(spark, f"{folder}/in", schema)), folder)
    got = {(r.symbol, r.silent_from) for r in spark.read.parquet(f"{folder}/out").collect()}
    want = {(r.symbol, r.silent_from)
            for r in alerts.silences(spark.read.parquet(f"{folder}/in")).collect()}
    limit = at(t) - dt.timedelta(seconds=90)
    assert {w for w in want if w[1] <= limit} == {g for g in got if g in want}
    assert all(g in want or g[1] >= limit - dt.timedelta(minutes=30) for g in got)


def test_complete_mode_rewrites_the_result(spark):
    folder = work_folder(spark, "test")
    for n in (1, 2):
        schema = put(spark, folder, [("A", 1.0, 0.0, at(n))])
        counts = metrics.message_counts(table_stream(spark, f"{folder}/in", schema), "symbol")
        sinks.to_table(counts, f"{folder}/out", f"{folder}/checkpoint", sinks.ONCE
                       ).awaitTermination()
        kept = sinks.read_table(spark, f"{folder}/out", counts.schema)
        assert [tuple(r) for r in kept.collect()] == [("A", n)]


def test_a_crash_while_rewriting_leaves_the_last_result(spark):
    folder = work_folder(spark, "test")
    schema = put(spark, folder, [("A", 1.0, 0.0, at(1))])
    counts = metrics.message_counts(table_stream(spark, f"{folder}/in", schema), "symbol")
    assert sinks.read_table(spark, f"{folder}/out", counts.schema).collect() == []
    sinks.to_table(counts, f"{folder}/out", f"{folder}/c", sinks.ONCE).awaitTermination()
    # A version without the mark of a finished write, as a crash leaves it.
    counts_ = spark.createDataFrame([("B", 9)], counts.schema)
    broken = f"{folder}/out/versions/{'9' * 20}-7"
    counts_.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(broken)
    remove_folder(spark, f"{broken}/_SUCCESS")
    kept = sinks.read_table(spark, f"{folder}/out", counts.schema)
    assert [tuple(r) for r in kept.collect()] == [("A", 1)]


def test_only_the_last_versions_stay(spark):
    folder = work_folder(spark, "test")
    for n in range(1, 6):
        schema = put(spark, folder, [("A", 1.0, 0.0, at(n))])
        counts = metrics.message_counts(table_stream(spark, f"{folder}/in", schema), "symbol")
        sinks.to_table(counts, f"{folder}/out", f"{folder}/c", sinks.ONCE).awaitTermination()
    assert len(written_folders(spark, f"{folder}/out/versions")) == 3


def test_a_fresh_checkpoint_replaces_nothing(spark):
    folder = work_folder(spark, "test")
    for n in (1, 2):
        put(spark, f"{folder}/{n}", [("A", float(n), 0.0, at(n))])
        stream = table_stream(spark, f"{folder}/{n}/in", spark.read.parquet(f"{folder}/{n}/in").schema)
        write = {"all": sinks.batch_writer(f"{folder}/out", ())}
        sinks.fan_out(stream, write, f"{folder}/c{n}", sinks.ONCE).awaitTermination()
    assert sorted(r.price for r in spark.read.parquet(f"{folder}/out").collect()) == [1.0, 2.0]


def test_a_batch_that_runs_again_replaces_itself(spark):
    folder = work_folder(spark, "test")
    schema = put(spark, folder, [("A", 1.0, 0.0, at(1))])
    write = sinks.batch_writer(f"{folder}/out", ())
    failures = [RuntimeError("lost")]

    def once_lost(batch, batch_id):
        write(batch, batch_id)
        if failures:
            raise failures.pop()

    for _ in range(2):
        stream = table_stream(spark, f"{folder}/in", schema)
        query = sinks.fan_out(stream, {"all": once_lost}, f"{folder}/c", sinks.ONCE)
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            assert "lost" in str(error)
    assert spark.read.parquet(f"{folder}/out").count() == 1


@pytest.mark.parametrize("chosen,width", [(None, 20), ("3", 3)])
def test_state_is_as_wide_as_configured_whatever_the_cores(spark, chosen, width):
    folder = work_folder(spark, "test")
    schema = put(spark, folder, [("A", 1.0, 0.0, at(1)), ("A", 1.0, 0.0, at(1000))])
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "20")
    if chosen:
        spark.conf.set("spark.tidewatch.statePartitions", chosen)
    try:
        query = finish(indicators.local_price(table_stream(spark, f"{folder}/in", schema)), folder)
        assert spark.conf.get(name) == "20"
    finally:
        spark.conf.set(name, before)
        spark.conf.unset("spark.tidewatch.statePartitions")
    assert query.recentProgress[0]["stateOperators"][0]["numShufflePartitions"] == width


def test_fan_out_reads_once_and_writes_all(spark):
    folder = work_folder(spark, "test")
    schema = put(spark, folder, [("A", 1.0, 0.0, at(1)), ("B", 2.0, 0.0, at(2))])
    stream = stamp(table_stream(spark, f"{folder}/in", schema), F.col("event_time"))
    query = sinks.fan_out(
        stream,
        {
            "all": sinks.batch_writer(f"{folder}/all", ("par", "fecha")),
            "dear": sinks.batch_writer(f"{folder}/dear", (), lambda b: b.where("price > 1")),
        },
        f"{folder}/checkpoint",
        sinks.ONCE,
    )
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
    assert spark.read.parquet(f"{folder}/all").count() == 2
    assert [r.symbol for r in spark.read.parquet(f"{folder}/dear").collect()] == ["B"]


def test_memory_and_console_sinks(spark, capfd):
    folder = work_folder(spark, "test")
    schema = put(spark, folder, [("A", 1.0, 0.0, at(1))])
    stream = table_stream(spark, f"{folder}/in", schema)
    sinks.to_memory(stream, "kept", f"{folder}/c1").awaitTermination()
    assert spark.table("kept").count() == 1
    sinks.to_console(stream, f"{folder}/c2", trigger=sinks.ONCE).awaitTermination()


def message(topic, seconds, **fields):
    fields = {"timestamp": int(at(seconds).replace(tzinfo=dt.timezone.utc).timestamp() * 1000),
              **fields}
    return (b"k", json.dumps(fields).encode(), topic, at(seconds))


def bus(spark, folder):
    rows = []
    for i in range(0, 1200, 5):
        for topic, symbol, price in (("btcusdt-ticker", "BTCUSDT", 100.0),
                                     ("ethusdt-ticker", "ETHUSDT", 10.0)):
            rows.append(message(topic, i, symbol=symbol, price=price + i % 7, volume_24h=1.0,
                                change_pct=3.0 if symbol == "BTCUSDT" else -0.5))
        if i % 30 == 0:
            rows.append(message(V.MARKET_TOPIC, i, symbol="BTCUSDT", coin="bitcoin",
                                price_usd=100.0, market_cap=2e12, volume_24h=1.0, change_24h=1.0))
            rows.append(message(V.KLINE_TOPIC, i, symbol="BTCUSDT", open=1.0, high=2.0, low=1.0,
                                close=2.0, volume=1.0, closed=i % 60 == 0))
    rows.append((b"FNG", json.dumps({"value": 30, "classification": "Fear", "timestamp": 1,
                                     "timestamp_ms": 1714521600000}).encode(),
                 V.SENTIMENT_TOPIC, at(0)))
    rows.append((None, b"junk", "btcusdt-ticker", at(3)))
    spark.createDataFrame(rows, S.RECORD).coalesce(1).write.parquet(f"{folder}/bus")


@pytest.mark.parametrize("complete", [False, True])
def test_whole_job(spark, complete):
    folder = work_folder(spark, "job")
    bus(spark, folder)
    job = jobs.Job(f"{folder}/history", f"{folder}/checkpoints", f"{folder}/results",
                   complete=complete, trigger=sinks.ONCE)
    queries = jobs.start(
        spark, lambda topics: record_files(spark, f"{folder}/bus", topics=topics, streaming=True),
        job,
    )
    for query in queries.values():
        query.awaitTermination()
    history = {n: spark.read.parquet(job.path(n)) for n in (*V.HISTORY, "rejects")}
    assert {n: h.count() for n, h in history.items()} == {
        "tickers": 480, "klines": 20, "coingecko": 40, "feargreed": 1, "rejects": 1
    }
    assert {str(r.fecha) for r in history["feargreed"].collect()} == {"2024-05-01"}
    assert {r.par for r in history["tickers"].select("par").distinct().collect()} == {
        "BTCUSDT", "ETHUSDT"
    }
    def result(name):
        path = f"{folder}/results/{name}"
        if complete and name != "deviation":
            path = written_folders(spark, f"{path}/versions")[-1]
        return spark.read.parquet(path)

    results = {n: result(n) for n in ("sma", "pump_dump", "deviation")}
    assert {(r.symbol, r.alerta) for r in results["pump_dump"].collect()} == {
        ("BTCUSDT", V.PUMP), ("ETHUSDT", V.NORMAL)
    }
    rows = results["deviation"].collect()
    assert {r.symbol for r in rows} == {"BTCUSDT"}
    assert {V.LOCAL_PRICE, V.GLOBAL_PRICE, "market_cap", "deviation_pct"} < set(
        results["deviation"].columns
    )
    assert all(r[V.GLOBAL_PRICE] == 100.0 and 0 < r.deviation_pct < 7 for r in rows)
    tickers = history["tickers"]
    full = indicators.moving_average(tickers)
    if complete:
        assert results["sma"].count() == full.count()
    else:
        assert results["sma"].count() == full.where(
            F.col("window_end") <= F.lit(at(1195 - 120))).count()


def test_alerting_beside_the_job(spark):
    folder = work_folder(spark, "job")
    rows = [message("btcusdt-ticker", 5 * i, symbol="BTCUSDT", price=1.0, change_pct=change)
            for i, change in enumerate([0.0] * 10 + [4.0] * 30 + [0.0] * 40)]
    rows += [message("btcusdt-ticker", 1000 + 5 * i, symbol="BTCUSDT", price=1.0, change_pct=0.0)
             for i in range(60)]
    spark.createDataFrame(rows, S.RECORD).coalesce(1).write.parquet(f"{folder}/bus")
    job = jobs.Job(f"{folder}/h", f"{folder}/c", f"{folder}/r", trigger=sinks.ONCE)
    started = jobs.start_alerting(
        spark, lambda topics: record_files(spark, f"{folder}/bus", topics=topics, streaming=True),
        job,
    )
    started["silences"].awaitTermination()
    changes = spark.read.parquet(f"{folder}/r/alerts/changes").collect()
    assert {(r.rule, r.state, r.at) for r in changes} == {
        ("BTCPumpDetectado", "pending", at(60)), ("BTCPumpDetectado", "firing", at(120)),
        ("BTCPumpDetectado", "resolved", at(210)),
    }
    silences = spark.read.parquet(f"{folder}/r/silences").collect()
    assert [(r.symbol, r.silent_from) for r in silences] == [("BTCUSDT", at(395))]


def test_production_rules_when_the_producer_dies(spark):
    """Both symbols fall silent for good; the clock goes on and takes the producer down."""
    folder = work_folder(spark, "job")
    rows = [message(f"{s.lower()}-ticker", 5 * i, symbol=s, price=1.0, change_pct=c)
            for i in range(60) for s, c in (("BTCUSDT", -4.0), ("ETHUSDT", 9.0))]
    spark.createDataFrame(rows, S.RECORD).coalesce(1).write.parquet(f"{folder}/bus")
    beats = spark.createDataFrame([(at(10 * i),) for i in range(120)], "event_time timestamp")
    beats.coalesce(1).write.parquet(f"{folder}/beats")
    job = jobs.Job(f"{folder}/h", f"{folder}/c", f"{folder}/r", trigger=sinks.ONCE)
    started = jobs.start_alerting(
        spark, lambda topics: record_files(spark, f"{folder}/bus", topics=topics, streaming=True),
        job, heartbeat=table_stream(spark, f"{folder}/beats", beats.schema),
    )
    started["silences"].awaitTermination()
    gauges = spark.read.parquet(f"{folder}/r/alerts/changes").collect()
    assert {(r.rule, r.state) for r in gauges} >= {
        ("BTCDumpDetectado", "pending"), ("BTCDumpDetectado", "firing")
    }
    health = spark.read.parquet(f"{folder}/r/alerts-up/changes").collect()
    # The last tick is at 295; no window of half a minute holds one from 330 on.
    assert {(r.rule, r.state, r.at) for r in health if r.at > at(60)} == {
        ("ProductorCaido", "pending", at(330)), ("ProductorCaido", "firing", at(360))
    }
    assert {(r.summary, r.description) for r in health} == {
        (r.summary, r.description) for r in alerts.RULES if r.metric == V.UP
    }
    silences = spark.read.parquet(f"{folder}/r/silences").collect()
    assert {(r.symbol, r.silent_from) for r in silences} == {
        ("BTCUSDT", at(295)), ("ETHUSDT", at(295))
    }


def test_each_feed_is_read_once_for_history_and_rejects(spark):
    folder = work_folder(spark, "job")
    bus(spark, folder)
    job = jobs.Job(f"{folder}/history", f"{folder}/checkpoints", f"{folder}/results",
                   trigger=sinks.ONCE)
    queries = jobs.start(
        spark, lambda topics: record_files(spark, f"{folder}/bus", topics=topics, streaming=True),
        job,
    )
    for query in queries.values():
        query.awaitTermination()
    sources = {n: len(q.lastProgress["sources"]) for n, q in queries.items()}
    assert {n: sources[n] for n in V.HISTORY} == dict.fromkeys(V.HISTORY, 1)
    # The other reads are the indicators', which keep state; the deviation has two feeds.
    assert sources == {**dict.fromkeys(V.HISTORY, 1), "sma": 1, "pump_dump": 1, "deviation": 2}


def test_raw_messages_travel_to_the_feeds(spark):
    """Raw text through both halves: publish as files by topic, then read as feeds."""
    folder = work_folder(spark, "raw")

    def raw(name, *texts):
        frame = spark.createDataFrame([(t,) for t in texts], "json string")
        frame.write.parquet(f"{folder}/{name}")
        return table_stream(spark, f"{folder}/{name}", frame.schema)

    exchange = raw(
        "exchange",
        '{"stream":"btcusdt@miniTicker","data":{"s":"BTCUSDT","c":"103.00","o":"100.00",'
        '"v":"12.5","E":1700000000000}}',
        '{"stream":"ethusdt@kline_1m","data":{"k":{"s":"ETHUSDT","o":"1","h":"4","l":"1","c":"3",'
        '"v":"2.5","x":true,"t":1699999980000}}}',
        '{"stream":"ethusdt@miniTicker","data":{"s":"ETHUSDT"}}',
        "junk",
    )
    snapshots = raw("snapshots", '{"bitcoin":{"usd":100.5},"ethereum":{"usd":"x"}}')
    documents = raw(
        "documents",
        '{"data":[{"value":"24","value_classification":"Extreme Fear","timestamp":"1700000000"}]}',
    )
    outcomes = jobs.publish_feeds(exchange, snapshots, documents)
    jobs.start_publishing(
        outcomes, sinks.batch_writer(f"{folder}/bus", ("topic",)), f"{folder}/rejects",
        f"{folder}/c1", sinks.ONCE,
    ).awaitTermination()
    sinks.to_topic_files(jobs.messages(outcomes), f"{folder}/plain", f"{folder}/c2", sinks.ONCE
                         ).awaitTermination()
    assert spark.read.parquet(f"{folder}/plain").count() == 4
    assert sorted(r.missing for r in spark.read.parquet(f"{folder}/rejects").collect()) == [
        "price,volume_24h,timestamp,open", "price_usd", "stream"
    ]
    bus = spark.read.parquet(f"{folder}/bus")
    assert sorted((r.topic, bytes(r.key).decode()) for r in bus.collect()) == [
        ("btcusdt-ticker", "BTCUSDT"), ("coingecko-market", "BTCUSDT"),
        ("crypto-klines", "ETHUSDT"), ("feargreed-index", "FNG"),
    ]
    feeds = jobs.open_feeds(lambda topics: bus.where(F.col("topic").isin(list(topics))))
    assert feeds.tickers.rejects().count() == 0
    tick = feeds.tickers.valid().first()
    assert (tick.par, tick.price, tick.change_pct) == ("BTCUSDT", 103.0, 3.0)
    assert tick.event_time == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert feeds.klines.valid().first().close == 3.0
    assert feeds.market.valid().first().price_usd == 100.5
    assert feeds.sentiment.valid().first().value == 24


def test_arrival_time_stamps_rows_when_read(spark):
    folder = work_folder(spark, "job")
    bus(spark, folder)
    feeds = jobs.open_feeds(lambda topics: record_files(spark, f"{folder}/bus", topics=topics),
                            arrival_time=True)
    assert feeds.tickers.valid().where(F.year("event_time") < 2025).count() == 0
    started = jobs.start(
        spark, lambda topics: record_files(spark, f"{folder}/bus", topics=topics, streaming=True),
        jobs.Job(f"{folder}/h", f"{folder}/c", f"{folder}/r", arrival_time=True,
                 trigger=sinks.ONCE),
    )
    for query in started.values():
        query.awaitTermination()
    # No window is over yet, but the history is there.
    assert spark.read.parquet(f"{folder}/h/tickers").count() == 480
    assert started["sma"].recentProgress[-1]["stateOperators"][0]["numRowsTotal"] > 0


def test_messages_without_a_time(spark):
    sent = spark.createDataFrame(
        [(None, b'{"symbol":"A","price":1}', "btcusdt-ticker", at(0))], S.RECORD
    )

    def source(topics):
        return sent.where(F.col("topic").isin(list(topics)))

    strict = jobs.open_feeds(source)
    assert strict.tickers.valid().count() == 0
    assert [(r.missing, r.feed) for r in strict.tickers.rejects().collect()] == [
        ("timestamp", "tick")
    ]
    assert jobs.open_feeds(source, arrival_time=True).tickers.valid().count() == 1


def test_gauges_and_outcomes_on_a_stream(spark):
    folder = work_folder(spark, "test")
    schema = put(spark, folder, [("A", 1.0, 0.0, at(1)), ("A", 2.0, 0.0, at(9)),
                                 ("B", 3.0, 0.0, at(5))])
    stream = table_stream(spark, f"{folder}/in", schema)
    latest = metrics.last_value(stream, ["price"], keys=["symbol"])
    sinks.to_table(latest, f"{folder}/latest", f"{folder}/c1", sinks.ONCE).awaitTermination()
    kept = sinks.read_table(spark, f"{folder}/latest", latest.schema)
    assert {tuple(r) for r in kept.collect()} == {("A", 2.0), ("B", 3.0)}
    polls = metrics.outcome_counts(stream, F.col("price") > 1)
    sinks.to_table(polls, f"{folder}/polls", f"{folder}/c2", sinks.ONCE).awaitTermination()
    kept = sinks.read_table(spark, f"{folder}/polls", polls.schema)
    assert [tuple(r) for r in kept.collect()] == [(2, 1)]


def test_text_sources(spark, tmp_path):
    (tmp_path / "lines.txt").write_text('{"stream":"x"}\n{"stream":"y"}\n')
    (tmp_path / "doc.json").write_text('{\n"data": []\n}')
    assert text_messages(spark, str(tmp_path / "lines.txt")).count() == 2
    assert whole_documents(spark, str(tmp_path / "doc.json")).count() == 1
    assert text_messages(spark, str(tmp_path), streaming=True).isStreaming
    assert whole_documents(spark, str(tmp_path), streaming=True).columns == ["json"]
