"""The driver tables seen as market feeds.

``events`` becomes ticks (symbol = event_type, price = value), a global feed (the opening
prices, an hour later), raw JSON messages, snapshots, sentiment documents, metric samples.
Everything is derived from the whole table by column expressions.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import values as V
from ..functions import percent_change, ticker_topic, time_order
from ..operators import metrics
from ..operators.alerts import Rule
from ..sources import table_stream


EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream; the pattern lets it be a single file as well as a folder."""
    return table_stream(spark, f"{sf_dir}/events.parque[t]", EVENTS)


def lot() -> Column:
    """The ``k`` number (0 to 99) inside the ``props`` JSON."""
    return F.get_json_object("props", "$.k").cast("bigint")


def open_price() -> Column:
    """An opening price within five percent of the event's value."""
    return F.col("value") * (1050 - F.col("k")) / 1000


def ticks(rows: DataFrame) -> DataFrame:
    priced = rows.select("event_id", "ts", "user_id", "event_type", "value", lot().alias("k"))
    return priced.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.col("user_id").cast("double").alias("volume_24h"),
        percent_change(F.col("value"), open_price()).alias("change_pct"),
        F.col("ts").alias("event_time"),
        "event_id",
        "user_id",
    )


def global_feed(rows: DataFrame) -> DataFrame:
    """The opening prices, quoted an hour later: many minutes have one of the two feeds only."""
    quoted = rows.select("ts", "event_type", "value", lot().alias("k"))
    return quoted.select(
        F.col("event_type").alias("symbol"),
        open_price().alias("price_usd"),
        # A power of two: the product is exact, and no mean of it ends in one half.
        (F.col("value") * 2.0**20).alias("market_cap"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("event_time"),
    )


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger tick table: three symbols, so every one of them is hot."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_returnflag").alias("symbol"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("change_pct"),
        F.col("l_shipdate").alias("event_time"),
    )


# Raw messages. Numbers go out as text, as the exchange sends them. Two defects are built in:
# a ``k`` below 10 makes the price unreadable, one from 90 up cuts the message short.


def _defective(whole: Column) -> Column:
    return F.when(F.col("k") >= 90, F.left(whole, F.lit(30))).otherwise(whole)


def _price_text() -> Column:
    return F.when(F.col("k") < 10, "n/a").otherwise(F.col("value").cast("string"))


def _millis() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def exchange_messages(rows: DataFrame) -> DataFrame:
    """One raw mini ticker per event; sign-ups become a stream kind nobody reads."""
    stream = F.concat(
        F.lower("event_type"),
        F.when(F.col("event_type") == "signup", "@depth").otherwise("@miniTicker"),
    )
    data = F.struct(
        F.col("event_type").alias("s"),
        _price_text().alias("c"),
        open_price().cast("string").alias("o"),
        F.col("user_id").cast("string").alias("v"),
        _millis().alias("E"),
    )
    with_k = rows.withColumn("k", lot())
    return with_k.select(
        _defective(F.to_json(F.struct(stream.alias("stream"), data.alias("data")))).alias("json")
    )


def candles(rows: DataFrame) -> DataFrame:
    """Hourly candles of the events; an hour with two or more events is closed."""
    order = time_order(F.col("ts"), F.col("event_id"))
    return rows.groupBy(
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"), "event_type"
    ).agg(
        F.min_by("value", order).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", order).alias("close"),
        F.sum("user_id").cast("double").alias("volume"),
        (F.count("*") >= 2).alias("closed"),
    )


def kline_messages(rows: DataFrame) -> DataFrame:
    """One raw candle message per hour and event type."""
    text = {f: F.col(f).cast("string") for f in ("open", "high", "low", "close", "volume")}
    k = F.struct(
        F.col("event_type").alias("s"),
        text["open"].alias("o"),
        text["high"].alias("h"),
        text["low"].alias("l"),
        text["close"].alias("c"),
        text["volume"].alias("v"),
        F.col("closed").alias("x"),
        F.unix_millis("hour").alias("t"),
    )
    stream = F.concat(F.lower("event_type"), F.lit("@kline_1m"))
    message = F.struct(stream.alias("stream"), F.struct(k.alias("k")).alias("data"))
    return candles(rows).select(F.to_json(message).alias("json"))


def tick_records(rows: DataFrame) -> DataFrame:
    """Normalized ticks as message-bus rows, with the defects above."""
    price = F.when(F.col("k") < 10, '"n/a"').otherwise(F.col("value").cast("string"))
    message = F.concat(
        F.lit('{"symbol":"'), F.col("event_type"),
        F.lit('","price":'), price,
        F.lit(',"volume_24h":'), F.col("user_id").cast("string"),
        F.lit(',"extra":true,"timestamp":'), _millis().cast("string"), F.lit("}"),
    )
    return rows.withColumn("k", lot()).select(
        F.col("event_type").cast("binary").alias("key"),
        _defective(message).cast("binary").alias("value"),
        F.concat(F.lower("event_type"), F.lit("-ticker")).alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


# Two of the five event types play the coins of the global feed.
COINS = {"view": "VIEWUSD", "purchase": "PURCHASEUSD"}


def snapshots(rows: DataFrame) -> DataFrame:
    """One snapshot per hour: every event type's last event, fields missing where k < 50."""
    order = time_order(F.col("ts"), F.col("event_id"))
    latest = rows.withColumn("k", lot()).groupBy(
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"), "event_type"
    ).agg(F.max_by("value", order).alias("value"), F.max_by("k", order).alias("k"))
    full = F.col("k") >= 50
    quote = F.struct(
        F.col("value").alias("usd"),
        F.when(full, F.col("value") * 1e6).alias("usd_market_cap"),
        F.when(full, F.col("k")).alias("usd_24h_vol"),
    )
    # At most one entry per event type, and there are five of those.
    by_type = F.map_from_entries(F.collect_list(F.struct("event_type", quote)))
    return latest.groupBy("hour").agg(by_type.alias("quotes")).select(
        F.to_json("quotes").alias("json"), F.unix_millis("hour").alias("polled")
    )


def sentiment_documents(rows: DataFrame) -> DataFrame:
    """One document per event; where ``k`` is 90 or more it carries no entry at all."""
    entry = F.concat(
        F.lit('{"value":"'), lot().cast("string"),
        F.lit('","value_classification":"'), F.col("event_type"),
        F.lit('","timestamp":"'), F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"),
        F.lit('"}'),
    )
    body = F.when(lot() < 90, entry).otherwise("")
    return rows.select(
        F.concat(F.lit('{"data":['), body, F.lit("]}")).alias("json"), _millis().alias("polled")
    )


def hourly(rows: DataFrame) -> DataFrame:
    """The last event of each hour."""
    order = time_order(F.col("ts"), F.col("event_id"))
    names = ["event_type", "props", "ts"]
    return rows.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour")).agg(
        *[F.max_by(c, order).alias(c) for c in names]
    )


def patchy_snapshots(rows: DataFrame) -> DataFrame:
    """The snapshots, with every fourth hour's poll failed: it left no document."""
    failed = F.pmod(F.col("polled") / 3_600_000, F.lit(4)) == 0
    return snapshots(rows).withColumn("json", F.when(~failed, F.col("json")))


def look(rows: DataFrame) -> dt.datetime:
    """A moment two hours after the last event."""
    last = rows.agg(F.max("ts")).first()[0]
    return (last or dt.datetime(1970, 1, 1)) + dt.timedelta(hours=2)


def beats(rows: DataFrame) -> DataFrame:
    """A clock that ticks on for a day after the feeds have stopped."""
    return rows.select((F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("event_time"))


# Metric samples: gauges of the ticks, and the message counter as scraped every few minutes
# by a producer that restarts daily.


def samples(rows: DataFrame) -> DataFrame:
    return metrics.tick_gauges(ticks(rows))


def container_memory(rows: DataFrame) -> DataFrame:
    """A gauge whose label is absent for the sign-ups."""
    named = ticks(rows).withColumn("name", F.nullif(F.col("symbol"), F.lit("signup")))
    return metrics.gauges(named, {V.CONTAINER_MEMORY: "price"}, label="name", of="name")


def host_memory(rows: DataFrame) -> DataFrame:
    """A ``k`` of 50 or more reports the total, a smaller one what is available."""
    metric = F.when(lot() >= 50, V.NODE_MEMORY_TOTAL).otherwise(V.NODE_MEMORY_AVAILABLE)
    return rows.select(
        metric.alias("metric"),
        F.create_map(F.lit("par"), F.col("event_type")).alias("labels"),
        "ts",
        "value",
    )


def counter(rows: DataFrame, every: str = "10 minutes") -> DataFrame:
    named = ticks(rows).withColumn("topic", ticker_topic(F.col("symbol")))
    return metrics.message_counter(named, every=every, restart="1 day")


def idle_counter(rows: DataFrame) -> DataFrame:
    """The counter again, as the idle time of one processor per topic."""
    labels = F.create_map(F.lit("mode"), F.lit("idle"), F.lit("cpu"), F.col("labels")["topic"])
    return counter(rows).select(
        F.lit(V.NODE_CPU).alias("metric"), labels.alias("labels"), "ts", "value"
    )


def busy_counter(rows: DataFrame) -> DataFrame:
    """The counter again, as processor time of one container per topic."""
    labels = F.create_map(F.lit("name"), F.col("labels")["topic"])
    return counter(rows).select(
        F.lit(V.CONTAINER_CPU).alias("metric"), labels.alias("labels"), "ts", "value"
    )


def with_end(rows: DataFrame) -> DataFrame:
    """Samples and two more of a series of its own, long after: they move a stream's clock on."""
    after = F.explode(F.array(F.expr("INTERVAL 30 DAYS"), F.expr("INTERVAL 60 DAYS")))
    later = rows.agg(F.max("ts").alias("ts"), F.first("metric").alias("metric")).select(
        "metric", F.create_map(F.lit("end"), F.lit("end")).alias("labels"), "ts",
        after.alias("after"), F.lit(0.0).alias("value"),
    )
    return rows.select("metric", "labels", "ts", "value").union(
        later.select("metric", "labels", F.col("ts") + F.col("after"), "value")
    )


RULES = (
    Rule("Dump", V.CHANGE_24H, "<", -3.0, "1 minute", "critical", {"par": "view"},
         "views fall", "views are down by more than 3 percent"),
    Rule("Pump", V.CHANGE_24H, ">", 3.0, "6 minutes", "warning", {"par": "purchase"},
         "purchases rise", "purchases are up by more than 3 percent"),
    Rule("Cheap", V.PRICE_NOW, "<", 10.0, "2 hours", "info", {}, "cheap", "less than ten"),
)
