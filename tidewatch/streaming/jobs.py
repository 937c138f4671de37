"""The production job: four feeds in, four histories and three indicators out."""

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from .. import values as V
from ..functions import from_epoch_millis
from ..operators import alerts, indicators, metrics, normalize, publish
from ..operators.enrich import stamp
from ..operators.parse import as_text, parse_json, split
from ..session import prepare
from ..sources.history import history_table, read_history
from ..sources.records import table_stream
from . import liveness, sinks
from .alerts import follow_steps, start_alerts, up_steps

Source = Callable[[Sequence[str]], DataFrame]


@dataclass(frozen=True)
class Job:
    """Settings. Folders must be on storage that all executors share.

    ``arrival_time=True`` stamps rows when they are read; by default the messages' own time
    counts, so that a replay gives the same result. ``complete=True`` reports the first two
    indicators whole at every trigger, at the price of state that never shrinks.
    ``watermark_policy="max"`` lets the deviation go on while one of its feeds is silent, but
    then drops what that feed delivers late; ``min`` waits for it. With ``shared_panes`` the ticks
    are read and aggregated once for all indicators, into a table of final panes that these follow;
    they then drop what comes after its pane is closed, and report one pane later.
    """

    history: str
    checkpoints: str
    results: str | None = None
    arrival_time: bool = False
    complete: bool = False
    watermark_policy: str = "min"
    trigger: dict | None = None
    shared_panes: bool = False

    def path(self, name: str) -> str:
        return f"{self.history.rstrip('/')}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoints.rstrip('/')}/{name}"


@dataclass(frozen=True)
class Feed:
    """One feed's messages as parsed, good and bad ones together, and how to tell them apart."""

    kind: str
    parsed: DataFrame
    required: tuple[str, ...]
    time: str
    symbol: str | None
    arrival_time: bool

    def valid(self, parsed: DataFrame | None = None) -> DataFrame:
        """Typed and stamped rows, of the stream or of a batch of it."""
        rows, _ = split(self.parsed if parsed is None else parsed, self.required)
        return stamp(rows, None if self.arrival_time else from_epoch_millis(F.col(self.time)),
                     self.symbol)

    def rejects(self, parsed: DataFrame | None = None) -> DataFrame:
        _, bad = split(self.parsed if parsed is None else parsed, self.required)
        return bad.withColumn("feed", F.lit(self.kind))


@dataclass(frozen=True)
class Feeds:
    tickers: Feed
    klines: Feed
    market: Feed
    sentiment: Feed


def open_feeds(source: Source, arrival_time: bool = False) -> Feeds:
    """Read the topics through ``source(topics)``, be it a bus or files.

    Where the messages' own time counts, one without it is rejected.
    """

    def feed(topics, schema, kind, time="timestamp", symbol="symbol"):
        required = S.REQUIRED[kind] + (() if arrival_time else (time,))
        parsed = parse_json(as_text(source(topics)), schema).select("json", "d.*")
        return Feed(kind, parsed, required, time, symbol, arrival_time)

    return Feeds(
        feed(V.TICKER_TOPICS, S.TICK, "tick"),
        feed((V.KLINE_TOPIC,), S.KLINE, "kline"),
        feed((V.MARKET_TOPIC,), S.MARKET, "market"),
        feed((V.SENTIMENT_TOPIC,), S.SENTIMENT, "sentiment", "timestamp_ms", None),
    )


def publish_feeds(
    exchange: DataFrame | None = None,
    snapshots: DataFrame | None = None,
    documents: DataFrame | None = None,
    *,
    symbols: dict[str, str] = V.COIN_SYMBOLS,
    polled: Column | None = None,
) -> DataFrame:
    """Raw messages (column ``json``) to ``(topic, key, value, json, missing)``.

    Rows with an empty ``missing`` are messages for the bus, each for its own topic; the others
    are rejects. ``polled`` is the time of a snapshot or document in milliseconds, now unless
    given. The exchange feed, by far the largest, is read and parsed once.
    """
    parts = []

    def add(feed: tuple[DataFrame, DataFrame], schema: T.StructType, key: Column) -> None:
        valid, rejects = feed
        no_text, nothing = F.lit(None).cast("string"), F.lit(None).cast("binary")
        parts.append(
            publish.encode(valid, schema.names, key=key).select(
                "*", no_text.alias("json"), F.lit("").alias("missing")
            )
        )
        parts.append(
            rejects.select(
                no_text.alias("topic"), nothing.alias("key"), nothing.alias("value"), "json",
                "missing",
            )
        )

    if exchange is not None:
        parts.append(normalize.exchange_outcomes(normalize.route(exchange)))
    if snapshots is not None:
        add(normalize.market(snapshots, symbols, polled), S.MARKET, F.col("symbol"))
    if documents is not None:
        add(normalize.sentiment(documents, polled), S.SENTIMENT, F.lit(V.SENTIMENT_KEY))
    return reduce(DataFrame.union, parts)


def messages(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("missing") == "").select("topic", "key", "value")


def rejects(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("missing") != "").select("json", "missing")


def start_publishing(
    outcomes: DataFrame,
    send: Callable[[DataFrame, int], None],
    rejects_path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Send the messages and keep the rejects, both from one reading of the sources.

    ``send`` is ``sinks.topic_sender(servers)`` or a ``sinks.batch_writer``. A batch that failed
    is sent again, so the bus gets every message at least once.
    """
    branches = {
        "messages": lambda batch, batch_id: send(messages(batch), batch_id),
        "rejects": sinks.batch_writer(rejects_path, (), rejects),
    }
    return sinks.fan_out(outcomes, branches, checkpoint, trigger, "publish")


def indicator_streams(feeds: Feeds) -> dict[str, DataFrame]:
    tickers = feeds.tickers.valid()
    return {
        "sma": indicators.moving_average(tickers),
        "pump_dump": indicators.pump_dump(tickers),
        "deviation": indicators.price_deviation(
            tickers, feeds.market.valid(), local_name=V.LOCAL_PRICE, global_name=V.GLOBAL_PRICE
        ),
    }


def start_histories(spark: SparkSession, feeds: Feeds, job: Job,
                    names: Sequence[str] = tuple(V.HISTORY)) -> dict[str, StreamingQuery]:
    """Start the histories of these names, and beside each the rejects of its feed."""
    histories = {
        "tickers": (feeds.tickers, feeds.tickers.valid),
        "klines": (feeds.klines, lambda rows: normalize.closed_only(feeds.klines.valid(rows))),
        "coingecko": (feeds.market, feeds.market.valid),
        "feargreed": (feeds.sentiment, feeds.sentiment.valid),
    }
    queries = {}
    for name in names:
        feed, kept = histories[name]
        branches = {
            "history": sinks.batch_writer(job.path(name), V.HISTORY[name], kept),
            "rejects": sinks.batch_writer(job.path("rejects"), ("feed",), feed.rejects),
        }
        queries[name] = sinks.fan_out(
            feed.parsed, branches, job.checkpoint(name), job.trigger, name
        )
    return queries


def pane_indicators(panes: DataFrame, feeds: Feeds) -> dict[str, DataFrame]:
    """The same from the stream of a pane table."""
    return {
        "sma": indicators.moving_average_of_panes(panes),
        "pump_dump": indicators.pump_dump_of_panes(panes),
        "deviation": indicators.price_deviation_of_panes(
            panes, feeds.market.valid(), local_name=V.LOCAL_PRICE, global_name=V.GLOBAL_PRICE
        ),
    }


def start_panes(spark: SparkSession, feeds: Feeds, job: Job) -> tuple[StreamingQuery, DataFrame]:
    """Start the aggregation of the ticks into panes; the second result follows their table.

    A run over what is available has all its panes before those who follow start.
    """
    panes = indicators.tick_panes(feeds.tickers.valid())
    folder = f"{(job.results or job.history).rstrip('/')}/panes"
    query = sinks.to_history(
        panes.coalesce(1), folder, job.checkpoint("panes"), (),
        job.trigger or sinks.every("30 seconds"), "panes",
    )
    if job.trigger == sinks.ONCE:
        query.awaitTermination()
    return query, table_stream(spark, folder, panes.schema)


def start(spark: SparkSession, source: Source, job: Job) -> dict[str, StreamingQuery]:
    """Start every query; the names are those of the histories and indicators.

    Each feed is read and parsed once for both its history and its rejects (those of all feeds
    land in ``rejects``). Indicators keep state and are queries of their own.
    """
    prepare(spark)
    feeds = open_feeds(source, job.arrival_time)
    queries = start_histories(spark, feeds, job)
    if job.shared_panes:
        queries["panes"], panes = start_panes(spark, feeds, job)
        streams = pane_indicators(panes, feeds)
    else:
        streams = indicator_streams(feeds)
    for name, stream in streams.items():
        complete = job.complete and name != "deviation"
        with watermark_policy(spark, job.watermark_policy):
            queries[name] = _report(stream, name, job, complete)
    if job.results is None:
        queries["sentiment"] = sinks.to_console(
            feeds.sentiment.valid(), job.checkpoint("sentiment"), trigger=job.trigger
            or sinks.every("60 seconds"), name="sentiment",
        )
    return queries


@contextmanager
def watermark_policy(spark: SparkSession, policy: str) -> Iterator[None]:
    """Of several watermarks of a query started inside, the least (``min``) or the greatest counts."""
    name = "spark.sql.streaming.multipleWatermarkPolicy"
    before = spark.conf.get(name, "min")
    spark.conf.set(name, policy)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def history_schemas() -> dict[str, T.StructType]:
    """The columns of each history, as the job writes them."""
    kinds = {"tickers": S.TICK, "klines": S.KLINE, "coingecko": S.MARKET, "feargreed": S.SENTIMENT}
    known = {"par": T.StringType(), "fecha": T.DateType(), "event_time": T.TimestampType()}
    return {
        name: T.StructType([
            *schema.fields, T.StructField("event_time", known["event_time"]),
            *[T.StructField(column, known[column]) for column in V.HISTORY[name]],
        ])
        for name, schema in kinds.items()
    }


def open_history(spark: SparkSession, job: Job, name: str, table: str | None = None) -> DataFrame:
    """One of the job's histories; as an external table for SQL where ``table`` names one."""
    schema = history_schemas()[name]
    if table is None:
        return read_history(spark, job.path(name), schema)
    return history_table(spark, table, job.path(name), schema, V.HISTORY[name])


def compact_histories(spark: SparkSession, job: Job, before: dt.date) -> dict[str, int]:
    """Merge the closed days of all histories; may run beside the job, once a day for instance."""
    return {
        name: sinks.compact_history(spark, job.path(name), schema, V.HISTORY[name], before)
        for name, schema in history_schemas().items()
    }


def clock(spark: SparkSession) -> DataFrame:
    """A heartbeat: the time of day, once a second."""
    beats = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return beats.select(F.col("timestamp").alias("event_time"))


def start_alerting(
    spark: SparkSession,
    source: Source,
    job: Job,
    rules: Sequence[alerts.Rule] = alerts.RULES,
    heartbeat: DataFrame | None = None,
) -> dict[str, StreamingQuery]:
    """Start the rules over the tickers' gauges and the producer's health, and the watch for
    silent feeds.

    Changes of alert state land in ``<results>/alerts/changes`` and, for the rules on whether
    the producer is up, in ``<results>/alerts-up/changes``; silences in ``<results>/silences``.
    Feeds that stop all at once are only noticed by a clock that goes on. It is the time of day,
    held back while there is backlog to read (``liveness``); a run over what is available, whose times
    may be long past, has none by itself. A ``heartbeat`` (column ``event_time``) given in its place is
    taken as it comes: it must be in step with the feeds.
    """
    prepare(spark)
    tickers = open_feeds(source, job.arrival_time).tickers.valid()
    once = job.trigger == sinks.ONCE
    folder = f"{(job.results or job.history).rstrip('/')}"
    settings = dict(trigger=job.trigger or sinks.every(V.EVALUATE_EVERY), wait=once)
    on_health = [r for r in rules if r.metric == V.UP]
    on_gauges = [r for r in rules if r.metric != V.UP]
    queries = {}
    if on_gauges:
        queries["steps"], queries["changes"] = start_alerts(
            spark, metrics.tick_gauges(tickers), f"{folder}/alerts", on_gauges, **settings
        )
    up = None
    if heartbeat is None and not once:
        queries["presence"] = liveness.start_presence(
            tickers, clock(spark), folder, trigger=settings["trigger"]
        )
        presence = liveness.presence_stream(spark, folder)
        silent = liveness.silences(presence).withColumnRenamed("feed", "symbol")
        up = liveness.health(presence)
    else:
        silent = alerts.silences_stream(tickers, heartbeat=heartbeat)
        if heartbeat is not None:
            up = up_steps(tickers, heartbeat)
    if on_health and up is not None:
        queries["up_steps"], queries["up_changes"] = follow_steps(
            spark, up, f"{folder}/alerts-up", on_health, **settings
        )
    queries["silences"] = sinks.to_history(
        silent, f"{folder}/silences", job.checkpoint("silences"), (), settings["trigger"],
        "silences",
    )
    return queries


def _report(stream: DataFrame, name: str, job: Job, complete: bool) -> StreamingQuery:
    checkpoint = job.checkpoint(name)
    trigger = job.trigger or sinks.every("60 seconds" if name == "deviation" else "30 seconds")
    if job.results is None:
        mode = "complete" if complete else "append"
        return sinks.to_console(stream, checkpoint, mode, trigger, name)
    path = f"{job.results.rstrip('/')}/{name}"
    if complete:
        return sinks.to_table(stream, path, checkpoint, trigger, name)
    return sinks.to_history(stream, path, checkpoint, (), trigger, name)


def run(spark: SparkSession, source: Source, job: Job) -> None:
    """Start everything and wait until one query ends or fails."""
    spark.streams.resetTerminated()  # or one that ended earlier would count
    start(spark, source, job)
    spark.streams.awaitAnyTermination()
