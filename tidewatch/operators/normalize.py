"""Raw documents of the outside world to the four normalized feeds.

Each function returns ``(valid, rejects)``: a message that lacks a field, or whose number
does not parse, is set aside with its text and the names of the fields at fault, and the rest
goes on.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .. import values as V
from ..functions import now_millis, percent_change, ticker_topic, to_bigint, to_double
from .parse import missing_fields, parse_json, split
from .publish import json_text


def route(messages: DataFrame, text: str = "json") -> DataFrame:
    """Parse raw exchange messages once and mark the kind of each.

    ``kind`` is ``ticker``, ``kline``, ``unreadable`` (no JSON object) or, for any other
    stream, NULL. Readability is only looked into where no stream name was found.
    """
    parsed = parse_json(messages, S.RAW_EXCHANGE, text)
    stream = F.col("d.stream")
    kind = (
        F.when(stream.contains(V.TICKER_MARKER), "ticker")
        .when(stream.contains(V.KLINE_MARKER), "kline")
        .when(stream.isNull() & F.from_json(text, S.TEXT_MAP).isNull(), "unreadable")
    )
    return parsed.withColumn("kind", kind)


def unreadable(routed: DataFrame, text: str = "json") -> DataFrame:
    """Messages that are no JSON object, in the shape of the other rejects."""
    return routed.where(F.col("kind") == "unreadable").select(
        F.col(text), F.lit("stream").alias("missing")
    )


def _ticker() -> dict[str, Column]:
    m = F.col("d.data")
    close, opened = to_double(m["c"]), to_double(m["o"])
    return {
        "symbol": m["s"],
        "price": close,
        "volume_24h": to_double(m["v"]),
        "change_pct": percent_change(close, opened),
        "timestamp": m["E"],
        "open": opened,
    }


def _kline() -> dict[str, Column]:
    k = F.col("d.data.k")
    return {
        "symbol": k["s"],
        "open": to_double(k["o"]),
        "high": to_double(k["h"]),
        "low": to_double(k["l"]),
        "close": to_double(k["c"]),
        "volume": to_double(k["v"]),
        "closed": k["x"],
        "timestamp": k["t"],
    }


# A ticker without percentage is one whose open is zero; it needs the open itself.
_TICKER_NEEDS = ("symbol", "price", "volume_24h", "timestamp", "open")
_KLINE_NEEDS = tuple(S.KLINE.names)


def tickers(routed: DataFrame, text: str = "json") -> tuple[DataFrame, DataFrame]:
    """Mini tickers: price, volume and the change between the message's open and close."""
    typed = routed.where(F.col("kind") == "ticker").select(
        text, *[v.alias(name) for name, v in _ticker().items()]
    )
    valid, rejects = split(typed, _TICKER_NEEDS, text)
    return valid.drop("open").withColumn("topic", ticker_topic(F.col("symbol"))), rejects


def klines(routed: DataFrame, text: str = "json") -> tuple[DataFrame, DataFrame]:
    """Candles, open and closed ones alike."""
    typed = routed.where(F.col("kind") == "kline").select(
        text, *[v.alias(name) for name, v in _kline().items()]
    )
    valid, rejects = split(typed, _KLINE_NEEDS, text)
    return valid.withColumn("topic", F.lit(V.KLINE_TOPIC)), rejects


def exchange_outcomes(routed: DataFrame, text: str = "json") -> DataFrame:
    """``(topic, key, value, json, missing)`` of every message that is not ignored, in one pass.

    ``missing`` is empty for a message that can be sent and names the fields at fault otherwise.
    The rows are those of ``tickers``, ``klines`` and ``unreadable``, encoded.
    """
    ticker, kline = _ticker(), _kline()
    is_ticker, is_kline = F.col("kind") == "ticker", F.col("kind") == "kline"
    missing = (
        F.when(is_ticker, missing_fields({c: ticker[c] for c in _TICKER_NEEDS}))
        .when(is_kline, missing_fields({c: kline[c] for c in _KLINE_NEEDS}))
        .otherwise("stream")
    )
    symbol = F.when(is_ticker, ticker["symbol"]).otherwise(kline["symbol"])
    topic = F.when(is_ticker, ticker_topic(symbol)).otherwise(V.KLINE_TOPIC)
    body = F.when(
        is_ticker, json_text([ticker[c].alias(c) for c in S.TICK.names])
    ).otherwise(json_text([kline[c].alias(c) for c in S.KLINE.names]))
    return routed.where(F.col("kind").isNotNull()).select(
        topic.alias("topic"),
        symbol.cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.col(text).alias("json"),
        missing.alias("missing"),
    )


def closed_only(candles: DataFrame) -> DataFrame:
    """Closed candles; open ones and those of unknown state are dropped."""
    return candles.where(F.col("closed"))


def market(
    snapshots: DataFrame,
    symbols: dict[str, str] = V.COIN_SYMBOLS,
    timestamp: Column | None = None,
    text: str = "json",
) -> tuple[DataFrame, DataFrame]:
    """Global snapshots, one JSON object per poll, to one row per known coin.

    Snapshots of failed polls are NULL and skipped. Coins outside ``symbols`` are cut from
    the map before it is exploded, and the symbols are looked up in a literal map: there is no
    join. A missing number, also an explicit null, is 0; one that does not parse sends the coin
    to the rejects.
    """
    polled = snapshots.where(F.col(text).isNotNull()).withColumn(
        "timestamp", now_millis() if timestamp is None else timestamp
    )
    parsed = parse_json(polled, S.TEXT_MAP, text)
    no_object = parsed.where(F.col("d").isNull()).select(text, F.lit("snapshot").alias("missing"))

    symbol_of = F.create_map(*[F.lit(x) for pair in symbols.items() for x in pair])
    known = F.map_filter("d", lambda coin, _: coin.isin(list(symbols)))
    quotes = parsed.select("timestamp", F.explode(known).alias("coin", text)).withColumn(
        "symbol", symbol_of[F.col("coin")]
    )
    quote = F.col("d")
    fields = {
        "price_usd": quote["usd"],
        "market_cap": quote["usd_market_cap"],
        "volume_24h": quote["usd_24h_vol"],
        "change_24h": quote["usd_24h_change"],
    }
    # A quote that is no object has no numbers, not even missing ones.
    numbers = {
        name: F.when(quote.isNotNull(), to_double(F.coalesce(v, F.lit("0"))))
        for name, v in fields.items()
    }
    typed = parse_json(quotes, S.TEXT_MAP, text).select(
        text, "symbol", "coin", *[v.alias(name) for name, v in numbers.items()], "timestamp"
    )
    valid, bad = split(typed, tuple(fields), text)
    return valid.withColumn("topic", F.lit(V.MARKET_TOPIC)), no_object.unionByName(bad)


def sentiment(
    documents: DataFrame, timestamp_ms: Column | None = None, text: str = "json"
) -> tuple[DataFrame, DataFrame]:
    """Sentiment documents: the first entry of each, its numbers read from text."""
    entry = F.get(F.col("d.data"), F.lit(0))
    typed = parse_json(documents.where(F.col(text).isNotNull()), S.RAW_SENTIMENT, text).select(
        text,
        to_bigint(entry["value"]).alias("value"),
        entry["value_classification"].alias("classification"),
        to_bigint(entry["timestamp"]).alias("timestamp"),
        (now_millis() if timestamp_ms is None else timestamp_ms).alias("timestamp_ms"),
    )
    valid, rejects = split(typed, ("value", "classification", "timestamp"), text)
    return valid.withColumn("topic", F.lit(V.SENTIMENT_TOPIC)), rejects
