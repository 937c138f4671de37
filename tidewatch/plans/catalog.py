"""Query name -> plan. Each plan takes (spark, sf_dir) and reads whole driver tables."""

import datetime as dt
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from .. import schemas as S
from .. import values as V
from ..functions import from_epoch_millis, from_epoch_seconds, round_to, ticker_topic
from ..operators import alerts, enrich, indicators, metrics, normalize, parse, publish, series
from ..session import throwaway_state, work_folder
from ..sources import (
    read_history,
    record_files,
    table_stream,
    text_messages,
    whole_documents,
)
from ..streaming import jobs, liveness, sinks
from ..streaming import series as live
from ..streaming.alerts import CHANGES, start_alerts
from . import feeds

WIDE = dict(size="1 hour", slide="12 minutes")
HOURLY = dict(window="3 hours", step="1 hour", unique=True)

QUERIES = {}


def query(plan):
    """Register a plan; a stream here runs once over a table and its checkpoint is dropped."""

    @wraps(plan)
    def narrow(spark, sf_dir):
        with throwaway_state(spark):
            return plan(spark, sf_dir)

    QUERIES[plan.__name__] = narrow if plan.__name__.startswith("stream_") else plan
    return plan


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the driver tables have them."""
    instants = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants})


def label(name: str):
    return F.col("labels")[name].alias(name)


# --- windowed indicators ---------------------------------------------------------------


@query
def sma_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.moving_average(feeds.ticks(feeds.events(spark, sf_dir)))


@query
def sma_volatility_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.moving_average(feeds.ticks(feeds.events(spark, sf_dir)), **WIDE)


@query
def sma_volatility_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.moving_average(
        feeds.lineitem_ticks(spark, sf_dir), size="7 days", slide="1 day"
    )


@query
def sma_volatility_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty panes in each window."""
    return indicators.moving_average(
        feeds.ticks(feeds.events(spark, sf_dir)), size="1 hour", slide="1 minute"
    )


@query
def pump_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.pump_dump(feeds.ticks(feeds.events(spark, sf_dir)))


@query
def pump_dump_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.pump_dump(feeds.ticks(feeds.events(spark, sf_dir)), **WIDE)


@query
def pump_dump_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.pump_dump(
        feeds.ticks(feeds.events(spark, sf_dir)), basis="window_range", **WIDE
    )


@query
def local_minute_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.local_price(feeds.ticks(feeds.events(spark, sf_dir)))


@query
def global_minute_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.global_price(feeds.global_feed(feeds.events(spark, sf_dir)))


@query
def price_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour windows: the minutes of this table rarely hold both feeds."""
    rows = feeds.events(spark, sf_dir)
    return indicators.price_deviation(
        feeds.ticks(rows), feeds.global_feed(rows), size="6 hours"
    )


@query
def price_deviation_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.events(spark, sf_dir)
    return indicators.price_deviation(feeds.ticks(rows), feeds.global_feed(rows))


# --- parsing, normalization, enrichment ------------------------------------------------


@query
def change_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.ticks(feeds.events(spark, sf_dir)).select("event_id", "symbol", "change_pct")


@query
def parse_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = feeds.tick_records(feeds.events(spark, sf_dir))
    valid, _ = parse.read_feed(records, S.TICK, S.REQUIRED["tick"])
    stamped = valid.withColumn("event_time", from_epoch_millis(F.col("timestamp")))
    return naive(stamped.select("symbol", "price", "volume_24h", "timestamp", "event_time"))


@query
def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = feeds.tick_records(feeds.events(spark, sf_dir))
    _, rejects = parse.read_feed(records, S.TICK, S.REQUIRED["tick"])
    return rejects


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.events(spark, sf_dir)
    return normalize.route(feeds.exchange_messages(rows).union(feeds.kline_messages(rows)))


def _rejects_by_reason(messages: DataFrame) -> DataFrame:
    outcomes = normalize.exchange_outcomes(messages)
    return jobs.rejects(outcomes).groupBy("missing").agg(F.count("*").alias("messages"))


@query
def route_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickers, _ = normalize.tickers(_routed(spark, sf_dir))
    return tickers


@query
def route_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejects_by_reason(_routed(spark, sf_dir))


@query
def normalize_kline(spark: SparkSession, sf_dir: str) -> DataFrame:
    candles, _ = normalize.klines(_routed(spark, sf_dir))
    return naive(candles.withColumn("event_time", from_epoch_millis(F.col("timestamp"))))


@query
def closed_klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    candles, _ = normalize.klines(_routed(spark, sf_dir))
    return normalize.closed_only(candles).select("symbol", "close", "volume", "timestamp")


@query
def explode_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    polls = feeds.snapshots(feeds.events(spark, sf_dir))
    valid, _ = normalize.market(polls, feeds.COINS, F.col("polled"))
    return valid


@query
def sentiment_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feeds.sentiment_documents(feeds.events(spark, sf_dir))
    valid, _ = normalize.sentiment(documents, F.col("polled"))
    return naive(valid.withColumn("event_time", from_epoch_seconds(F.col("timestamp"))))


@query
def sentiment_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feeds.sentiment_documents(feeds.events(spark, sf_dir))
    _, rejects = normalize.sentiment(documents, F.col("polled"))
    return rejects.groupBy("json", "missing").agg(F.count("*").alias("documents"))


@query
def classify_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.events(spark, sf_dir).withColumn("value", feeds.lot())
    return rows.select("event_id", "value", X.classify_sentiment(F.col("value")).alias("band"))


@query
def topic_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = ticker_topic(F.upper("event_type"))
    return feeds.events(spark, sf_dir).select("event_id", topic.alias("topic"))


@query
def encode_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.ticks(feeds.events(spark, sf_dir)).withColumn(
        "topic", ticker_topic(F.col("symbol"))
    )
    messages = publish.encode(rows, ["symbol", "event_id", "user_id"], key=F.col("symbol"))
    return messages.select(
        "topic", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


@query
def enrich_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.events(spark, sf_dir).withColumnRenamed("event_type", "symbol")
    stamped = enrich.stamp(rows.select("event_id", "symbol", "ts"), F.col("ts"))
    return stamped.drop("ts")


# --- history ---------------------------------------------------------------------------


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.ticks(feeds.events(spark, sf_dir))
    path = work_folder(spark, "history")
    stamped = enrich.stamp(rows, F.col("event_time"))
    sinks.write_history(stamped, path, V.HISTORY["tickers"])
    return read_history(spark, path, stamped.schema)


@query
def history_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir).groupBy("par", "fecha").agg(
        F.count("*").alias("ticks"), round_to(F.avg("price"), 2).alias("price_avg")
    )


@query
def history_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One symbol's second week: two partition filters and one pushed value filter."""
    first, last = (F.lit(day).cast("date") for day in ("2024-01-08", "2024-01-14"))
    week = F.col("fecha").between(first, last)
    return (
        _history(spark, sf_dir)
        .where((F.col("par") == "purchase") & week & (F.col("price") > 20))
        .select("event_id", "par", "fecha", "price")
    )


# --- texts and documents: written as files, read by the raw sources ---------------------


@query
def text_messages_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages, one a line."""
    folder = work_folder(spark, "lines")
    feeds.exchange_messages(feeds.events(spark, sf_dir)).write.text(folder)
    return _rejects_by_reason(normalize.route(text_messages(spark, folder)))


def _as_documents(spark: SparkSession, documents: DataFrame, purpose: str) -> DataFrame:
    folder = work_folder(spark, purpose)
    documents.select("json").write.option("maxRecordsPerFile", 1).text(folder)
    return whole_documents(spark, folder)


@query
def snapshot_documents_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots, one a file."""
    polls = _as_documents(spark, feeds.snapshots(feeds.events(spark, sf_dir)), "snapshots")
    valid, _ = normalize.market(polls, feeds.COINS, F.lit(0).cast("bigint"))
    return valid.drop("timestamp")


@query
def sentiment_documents_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment documents, one a file."""
    hourly = feeds.sentiment_documents(feeds.hourly(feeds.events(spark, sf_dir)))
    valid, _ = normalize.sentiment(_as_documents(spark, hourly, "sentiment"), F.lit(0).cast("bigint"))
    return valid.select("value", "classification", "timestamp")


@query
def failed_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls that failed left no document; those of the others are unaffected."""
    polls = feeds.patchy_snapshots(feeds.events(spark, sf_dir))
    valid, _ = normalize.market(polls, feeds.COINS, F.col("polled"))
    return valid


@query
def poll_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots without a time of their own carry that of the query."""
    polls = feeds.snapshots(feeds.events(spark, sf_dir))
    valid, _ = normalize.market(polls, feeds.COINS)
    is_now = F.col("timestamp") == X.now_millis()
    return valid.select("symbol", "price_usd", is_now.alias("is_now"))


@query
def arrival_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a time are stamped when they are read."""
    rows = feeds.events(spark, sf_dir).withColumnRenamed("event_type", "symbol")
    stamped = enrich.stamp(rows.select("event_id", "symbol"))
    is_now = F.col("event_time") == F.current_timestamp()
    return stamped.select("event_id", "par", is_now.alias("is_now"))


# --- counters, gauges, series ----------------------------------------------------------


@query
def message_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = normalize.exchange_outcomes(_routed(spark, sf_dir))
    return metrics.message_counts(jobs.messages(outcomes))


@query
def ok_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.outcome_counts(feeds.events(spark, sf_dir), F.col("event_type") != "error")


@query
def last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.last_value(
        feeds.ticks(feeds.events(spark, sf_dir)),
        ["price", "change_pct", "volume_24h"],
        keys=["symbol"],
        tiebreak="event_id",
    )


@query
def message_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = feeds.counter(feeds.events(spark, sf_dir))
    return samples.select("metric", label("topic"), "ts", "value")


@query
def message_counter_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Never restarted, scraped at the usual interval."""
    ticks = feeds.ticks(feeds.events(spark, sf_dir)).withColumn(
        "topic", ticker_topic(F.col("symbol"))
    )
    return metrics.message_counter(ticks).select(label("topic"), "ts", "value")


@query
def poll_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors as failed polls, all other events as good ones."""
    polls = feeds.events(spark, sf_dir)
    good = F.col("event_type") != "error"
    counted = metrics.poll_counters(polls, good, ts="ts", every="10 minutes", restart="1 day")
    return counted.select("metric", "ts", "value")


@query
def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = feeds.samples(feeds.events(spark, sf_dir))
    return samples.select("metric", label("par"), "ts", "value")


@query
def metric_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = feeds.samples(feeds.events(spark, sf_dir))
    kept = metrics.select(samples, V.PRICE_NOW, equal={"par": "purchase"})
    return kept.select("metric", label("par"), "ts", "value")


@query
def metric_select_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = metrics.select(feeds.samples(feeds.events(spark, sf_dir)), V.CHANGE_24H)
    return kept.select(label("par"), "ts", "value")


@query
def metric_select_unequal(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = feeds.container_memory(feeds.events(spark, sf_dir))
    kept = metrics.select(samples, V.CONTAINER_MEMORY, unequal={"name": ""})
    return kept.select(label("name"), "ts", "value")


@query
def metric_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = metrics.select(feeds.samples(feeds.events(spark, sf_dir)), V.PRICE_NOW)
    return series.on_grid(samples).select(label("par"), "eval_ts", "value")


@query
def metric_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = metrics.message_rate(feeds.counter(feeds.events(spark, sf_dir)), **HOURLY)
    return rates.select(
        label("topic"), "eval_ts", round_to(F.col("rate"), 8).alias("rate")
    )


@query
def metric_rate_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = metrics.message_rate(
        feeds.counter(feeds.events(spark, sf_dir)), extrapolate=False, **HOURLY
    )
    return rates.select(
        label("topic"), "eval_ts", round_to(F.col("rate"), 8).alias("rate")
    )


@query
def metric_rate_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel's own window and step; most minutes hold too few messages to have a rate."""
    counter = feeds.counter(feeds.events(spark, sf_dir), V.EVALUATE_EVERY)
    rates = metrics.message_rate(counter, unique=True)
    return rates.select(
        label("topic"), "eval_ts", round_to(F.col("rate"), 8).alias("rate")
    )


@query
def metric_rate_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    idle = feeds.idle_counter(feeds.events(spark, sf_dir))
    return metrics.host_cpu(idle, **HOURLY).select(
        "eval_ts", round_to(F.col("value"), 6).alias("value")
    )


@query
def metric_container_cpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    busy = feeds.busy_counter(feeds.events(spark, sf_dir))
    return metrics.cpu_by_container(busy, **HOURLY).select(
        label("name"), "eval_ts", round_to(F.col("value"), 6).alias("value")
    )


@query
def metric_container_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = metrics.memory_by_container(
        feeds.container_memory(feeds.events(spark, sf_dir)), step="5 minutes", lookback="1 hour"
    )
    return used.select(label("name"), "eval_ts", round_to(F.col("value"), 9).alias("value"))


@query
def metric_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = metrics.host_memory(
        feeds.host_memory(feeds.events(spark, sf_dir)), step="15 minutes", lookback="1 hour"
    )
    scaled = F.col("value") * 1024 * 1024 * 1024
    return used.select(label("par"), "eval_ts", round_to(scaled, 4).alias("value"))


# --- alerts ----------------------------------------------------------------------------


@query
def threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = alerts.threshold(feeds.samples(feeds.events(spark, sf_dir)), feeds.RULES)
    return hits.select("rule", "severity", "metric", label("par"), "ts", "value")


@query
def sustained_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.sustained(feeds.samples(feeds.events(spark, sf_dir)), feeds.RULES)
    return found.select(
        "rule", "severity", label("par"), "pending_at", "firing_at", "resolved_at"
    )


@query
def sustained_alerts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.sustained(
        feeds.samples(feeds.events(spark, sf_dir)),
        feeds.RULES,
        step="1 minute",
        lookback="3 hours",
        slice_length="6 hours",
    )
    return found.select(
        "rule", "severity", label("par"), "pending_at", "firing_at", "resolved_at"
    )


@query
def feed_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.silences(feeds.ticks(feeds.events(spark, sf_dir)), limit="1 hour")


@query
def feed_silence_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usual limit of half a minute."""
    return alerts.silences(feeds.ticks(feeds.events(spark, sf_dir)))


@query
def feed_silence_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seen two hours after the last event: every feed is silent still."""
    rows = feeds.events(spark, sf_dir)
    return alerts.silences(feeds.ticks(rows), limit="1 hour", as_of=feeds.look(rows))


@query
def producer_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.events(spark, sf_dir)
    up = alerts.up_samples(
        rows, feeds.look(rows), ts="ts", limit="10 minutes", step="1 minute"
    )
    return up.select("metric", label("job"), "ts", "value")


@query
def alert_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each change of state with what is to be told about it."""
    found = alerts.sustained(feeds.samples(feeds.events(spark, sf_dir)), feeds.RULES)
    return alerts.transitions(found).select(
        "rule", label("par"), "state", "at", "summary", "description"
    )


# --- streams: the table is read as a stream, results are read back from the sink --------


def _finished(spark: SparkSession, stream: DataFrame, purpose: str, partition_by=()) -> DataFrame:
    folder = work_folder(spark, purpose)
    out = f"{folder}/out"
    sinks.to_history(
        stream, out, f"{folder}/checkpoint", partition_by, sinks.ONCE
    ).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_sma_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = indicators.moving_average(feeds.ticks(feeds.event_stream(spark, sf_dir)), **WIDE)
    return naive(_finished(spark, stream, "sma"))


@query
def stream_sma_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = indicators.moving_average(feeds.ticks(feeds.event_stream(spark, sf_dir)), **WIDE)
    folder = work_folder(spark, "sma-complete")
    sinks.to_table(
        stream, f"{folder}/out", f"{folder}/checkpoint", sinks.ONCE
    ).awaitTermination()
    return naive(sinks.read_table(spark, f"{folder}/out", stream.schema))


@query
def stream_pump_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = indicators.pump_dump(feeds.ticks(feeds.event_stream(spark, sf_dir)))
    return naive(_finished(spark, stream, "pump-dump"))


@query
def stream_sma_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are aggregated once, into panes, and closed panes into windows."""
    stream = indicators.moving_average(
        feeds.ticks(feeds.event_stream(spark, sf_dir)), late="pane", **WIDE
    )
    return naive(_finished(spark, stream, "sma-panes"))


@query
def stream_pump_dump_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = indicators.pump_dump(feeds.ticks(feeds.event_stream(spark, sf_dir)), late="pane")
    return naive(_finished(spark, stream, "pump-dump-panes"))


@query
def stream_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.event_stream(spark, sf_dir)
    stream = indicators.price_deviation(
        feeds.ticks(rows), feeds.global_feed(rows), size="6 hours"
    )
    return naive(_finished(spark, stream, "deviation"))


@query
def stream_deviation_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faster feed's watermark counts: windows do not wait for the ticks, an hour behind."""
    rows = feeds.event_stream(spark, sf_dir)
    stream = indicators.price_deviation(
        feeds.ticks(rows), feeds.global_feed(rows), size="6 hours"
    )
    with jobs.watermark_policy(spark, "max"):
        return naive(_finished(spark, stream, "deviation-max"))


@query
def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks below ten arrive after all others: most find their window closed.

    Two runs of one query over one checkpoint, so this is a restart as well.
    """
    rows = feeds.events(spark, sf_dir)
    folder = work_folder(spark, "late")
    late = F.col("value") < 10
    for wave in (rows.where(~late), rows.where(late)):
        wave.write.mode("append").parquet(f"{folder}/in")
        stream = indicators.moving_average(
            feeds.ticks(table_stream(spark, f"{folder}/in", rows.schema)), delay="10 days", **WIDE
        )
        sinks.to_history(
            stream, f"{folder}/out", f"{folder}/checkpoint", (), sinks.ONCE
        ).awaitTermination()
    return naive(spark.read.schema(stream.schema).parquet(f"{folder}/out"))


@query
def stream_message_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = feeds.ticks(feeds.event_stream(spark, sf_dir)).withColumn(
        "topic", ticker_topic(F.col("symbol"))
    )
    folder = work_folder(spark, "counts")
    stream = metrics.message_counts(ticks)
    sinks.to_table(
        stream, f"{folder}/out", f"{folder}/checkpoint", sinks.ONCE
    ).awaitTermination()
    return sinks.read_table(spark, f"{folder}/out", stream.schema)


@query
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "alerts")
    start_alerts(
        spark,
        feeds.samples(feeds.event_stream(spark, sf_dir)),
        folder,
        feeds.RULES,
        step="1 minute",
        lookback="3 hours",
        trigger=sinks.ONCE,
        wait=True,
    )
    changes = spark.read.schema(CHANGES).parquet(f"{folder}/changes")
    return naive(changes.select("rule", "severity", label("par"), "state", "at", "pending_at"))


def _sample_stream(spark: SparkSession, samples: DataFrame, folder: str) -> DataFrame:
    """Samples, and what ends them, as files that a stream reads."""
    closed = feeds.with_end(samples)
    closed.write.parquet(f"{folder}/samples")
    return table_stream(spark, f"{folder}/samples", closed.schema)


def _series_result(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    found = spark.read.schema(schema).parquet(folder)
    return naive(found.where(F.col("labels")["end"].isNull()))


@query
def stream_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation grid by timers: the last value is carried on until it is too old."""
    folder = work_folder(spark, "grid")
    samples = metrics.select(feeds.samples(feeds.events(spark, sf_dir)), V.PRICE_NOW)
    live.start_grid(spark, _sample_stream(spark, samples, folder), folder, trigger=sinks.ONCE,
                    wait=True)
    rows = "labels map<string,string>, eval_ts timestamp, value double"
    return _series_result(spark, f"{folder}/result", rows).select(label("par"), "eval_ts", "value")


@query
def stream_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter rates from cells that are linked as they come in; the counter restarts daily."""
    folder = work_folder(spark, "rate")
    counter = feeds.counter(feeds.events(spark, sf_dir))
    live.start_rate(spark, _sample_stream(spark, counter, folder), folder, window="3 hours",
                    step="1 hour", trigger=sinks.ONCE, wait=True)
    rows = "labels map<string,string>, eval_ts timestamp, rate double"
    return _series_result(spark, f"{folder}/result", rows).select(
        label("topic"), "eval_ts", round_to(F.col("rate"), 8).alias("rate")
    )


@query
def stream_rate_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The host's busy share: rates of all processors, then their mean at each step."""
    folder = work_folder(spark, "rate-avg")
    idle = metrics.select(feeds.idle_counter(feeds.events(spark, sf_dir)), V.NODE_CPU,
                          equal={"mode": "idle"})
    live.start_across(spark, _sample_stream(spark, idle, folder), folder, window="3 hours",
                      step="1 hour", trigger=sinks.ONCE, wait=True)
    means = spark.read.schema("eval_ts timestamp, rate double").parquet(f"{folder}/across")
    busy = (100 - F.col("rate") * 100).alias("value")
    return naive(means.select("eval_ts", round_to(busy, 6).alias("value")))


@query
def stream_metric_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metrics' values side by side in one state, subtracted where both are held."""
    folder = work_folder(spark, "diff")
    samples = _sample_stream(spark, feeds.host_memory(feeds.events(spark, sf_dir)), folder)
    live.start_combined(
        spark, samples, folder, V.NODE_MEMORY_TOTAL, V.NODE_MEMORY_AVAILABLE,
        lambda total, free: total - free, step="15 minutes", lookback="1 hour",
        trigger=sinks.ONCE, wait=True,
    )
    rows = "labels map<string,string>, eval_ts timestamp, value double"
    return _series_result(spark, f"{folder}/result", rows).select(
        label("par"), "eval_ts", round_to(F.col("value"), 4).alias("value")
    )


@query
def stream_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = alerts.silences_stream(
        feeds.ticks(feeds.event_stream(spark, sf_dir)), limit="1 hour"
    )
    return naive(_finished(spark, stream, "silence"))


@query
def stream_producer_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feeds stop at once; the clock goes on for a day."""
    rows = feeds.event_stream(spark, sf_dir)
    stream = alerts.silences_stream(
        feeds.ticks(rows), limit="1 hour", heartbeat=feeds.beats(rows)
    )
    return naive(_finished(spark, stream, "down"))


@query
def stream_lagging_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds that are read a fifth at a time beside a clock that is days ahead of them."""
    rows = feeds.events(spark, sf_dir)
    folder = work_folder(spark, "lagging")
    ends = [F.lit(dt.datetime(2024, 1, day)) for day in (7, 13, 19, 25)]
    fifth = sum((F.col("ts") >= end).cast("int") for end in ends)
    for i in range(5):
        rows.where(fifth == i).coalesce(1).write.mode("append").parquet(f"{folder}/rows")
    # A beat a trigger; the last ones find nothing more to read.
    now = rows.agg((F.max("ts") + F.expr("INTERVAL 3 DAYS")).alias("event_time"))
    clock = now.select(F.explode(F.array_repeat("event_time", 8)).alias("event_time"))
    clock.repartition(8).write.option("maxRecordsPerFile", 1).parquet(f"{folder}/clock")

    def slowly(name, schema):
        return table_stream(spark, f"{folder}/{name}", schema, files_per_trigger=1)

    liveness.start_presence(
        feeds.ticks(slowly("rows", rows.schema)), slowly("clock", clock.schema), folder,
        limit="1 hour", trigger=sinks.ONCE,
    ).awaitTermination()
    found = liveness.silences(liveness.presence_stream(spark, folder, 1), limit="1 hour")
    return naive(_finished(spark, found, "lagging-silences"))


@query
def stream_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triggered by the clock, and stopped after all there is has been processed."""
    stream = feeds.ticks(feeds.event_stream(spark, sf_dir)).select("event_id", "symbol")
    folder = work_folder(spark, "clocked")
    running = sinks.to_history(
        stream, f"{folder}/out", f"{folder}/checkpoint", (), sinks.every("1 second")
    )
    running.processAllAvailable()
    running.stop()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


@query
def stream_console(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by type, printed whole; what comes back is how many rows went in."""
    counts = feeds.event_stream(spark, sf_dir).groupBy("event_type").count()
    shown = sinks.to_console(
        counts, f"{work_folder(spark, 'console')}/checkpoint", "complete", sinks.ONCE
    )
    shown.awaitTermination()
    rows = sum(p["numInputRows"] for p in shown.recentProgress)
    return spark.createDataFrame([(rows,)], "rows long")


@query
def stream_parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.ticks(feeds.event_stream(spark, sf_dir))
    stamped = enrich.stamp(rows, F.col("event_time"))
    written = _finished(spark, stamped, "sink", V.HISTORY["tickers"])
    return written.select("event_id", "par", "fecha", "price", "change_pct")


@query
def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages in, keyed messages out to one directory per topic, rejects beside them."""
    raw = feeds.exchange_messages(feeds.event_stream(spark, sf_dir))
    folder = work_folder(spark, "publish")
    jobs.start_publishing(
        jobs.publish_feeds(raw),
        sinks.batch_writer(f"{folder}/bus", ("topic",)),
        f"{folder}/rejects",
        f"{folder}/checkpoint",
        sinks.ONCE,
    ).awaitTermination()
    bus = spark.read.schema("topic string, key binary, value binary").parquet(f"{folder}/bus")
    sent = parse.parse_json(parse.as_text(bus), S.TICK).select(
        "topic",
        F.col("key").cast("string").alias("key"),
        "d.timestamp",
        "d.price",
        F.lit("").alias("missing"),
    )
    kept = spark.read.schema("json string, missing string").parquet(f"{folder}/rejects")
    return sent.unionByName(kept.select("missing"), allowMissingColumns=True)


@query
def stream_run_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job over ticks alone, waiting for any of its queries, then for the others."""
    folder = work_folder(spark, "any")
    feeds.tick_records(feeds.events(spark, sf_dir)).write.parquet(f"{folder}/bus")

    def source(topics):
        stream = record_files(spark, f"{folder}/bus", streaming=True)
        return stream if topics == V.TICKER_TOPICS else stream.where(F.col("topic").isin(*topics))

    job = jobs.Job(f"{folder}/history", f"{folder}/checkpoints", f"{folder}/results",
                   trigger=sinks.ONCE)
    jobs.run(spark, source, job)
    for running in spark.streams.active:
        running.awaitTermination()
    kept = read_history(spark, job.path("tickers"), S.TICK).where("par IS NOT NULL")
    bad = spark.read.schema("json string, missing string").parquet(job.path("rejects"))
    return kept.select("symbol", "price").unionByName(bad.select("missing"), True)


@query
def stream_job_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: raw documents to bus files, and from there every feed to its history."""
    rows = feeds.events(spark, sf_dir)
    folder = work_folder(spark, "job")
    outcomes = jobs.publish_feeds(
        feeds.exchange_messages(rows).union(feeds.kline_messages(rows)),
        feeds.snapshots(rows),
        feeds.sentiment_documents(rows),
        symbols=feeds.COINS,
        polled=F.col("polled"),
    )
    messages = jobs.messages(outcomes).withColumn("timestamp", F.current_timestamp())
    messages.write.parquet(f"{folder}/bus")

    def source(topics):
        stream = record_files(spark, f"{folder}/bus", streaming=True)
        if topics == V.TICKER_TOPICS:
            return stream.where(F.col("topic").endswith("-ticker"))
        return stream.where(F.col("topic").isin(list(topics)))

    job = jobs.Job(f"{folder}/history", f"{folder}/checkpoints", f"{folder}/results",
                   trigger=sinks.ONCE)
    for running in jobs.start(spark, source, job).values():
        running.awaitTermination()
    counts = [
        spark.read.parquet(job.path(name))
        .groupBy(F.lit(name).alias("feed"), *_pair(partition), "fecha")
        .agg(F.count("*").alias("messages"))
        for name, partition in V.HISTORY.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def stream_history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's ticks as a SQL table: several batches, the closed days of which are merged."""
    folder = work_folder(spark, "table")
    ordered = feeds.tick_records(feeds.events(spark, sf_dir)).repartitionByRange(4, "timestamp")
    ordered.write.parquet(f"{folder}/bus")

    def source(topics):
        stream = record_files(spark, f"{folder}/bus", streaming=True, files_per_trigger=1)
        return stream if topics == V.TICKER_TOPICS else stream.where(F.col("topic").isin(*topics))

    job = jobs.Job(f"{folder}/history", f"{folder}/checkpoints", f"{folder}/results",
                   trigger=sinks.ONCE)
    started = jobs.start_histories(spark, jobs.open_feeds(source), job, ("tickers",))
    for running in started.values():
        running.awaitTermination()
    jobs.compact_histories(spark, job, dt.date(2024, 1, 16))
    name = f"ticks_{folder.rsplit('-', 1)[1]}"
    jobs.open_history(spark, job, "tickers", name)
    return spark.sql(
        "SELECT par, fecha, count(*) AS ticks, sum(volume_24h) AS volume,"
        f" max(price) AS price_max FROM {name} GROUP BY par, fecha"
    )


def _pair(partition):
    known = "par" in partition
    return [F.col("par") if known else F.lit(None).cast("string").alias("par")]
