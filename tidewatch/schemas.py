"""Declared schemas. Nothing is inferred; prices are DOUBLE so no digit is lost."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TEXT, _NUMBER, _WHOLE, _FLAG = StringType(), DoubleType(), LongType(), BooleanType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# Normalized feeds.
TICK = _struct(symbol=_TEXT, price=_NUMBER, volume_24h=_NUMBER, change_pct=_NUMBER,
               timestamp=_WHOLE)
KLINE = _struct(symbol=_TEXT, open=_NUMBER, high=_NUMBER, low=_NUMBER, close=_NUMBER,
                volume=_NUMBER, closed=_FLAG, timestamp=_WHOLE)
MARKET = _struct(symbol=_TEXT, coin=_TEXT, price_usd=_NUMBER, market_cap=_NUMBER,
                 volume_24h=_NUMBER, change_24h=_NUMBER, timestamp=_WHOLE)
SENTIMENT = _struct(value=_WHOLE, classification=_TEXT, timestamp=_WHOLE, timestamp_ms=_WHOLE)

# Raw documents as the outside world sends them; their numbers mostly arrive as text.
_CANDLE = _struct(s=_TEXT, o=_TEXT, h=_TEXT, l=_TEXT, c=_TEXT, v=_TEXT, x=_FLAG, t=_WHOLE)
RAW_EXCHANGE = _struct(
    stream=_TEXT, data=_struct(s=_TEXT, c=_TEXT, o=_TEXT, v=_TEXT, E=_WHOLE, k=_CANDLE)
)
RAW_SENTIMENT = _struct(
    data=ArrayType(_struct(value=_TEXT, value_classification=_TEXT, timestamp=_TEXT))
)

# Any JSON object, values left as text. A snapshot is one: coin id -> quote, field -> number.
TEXT_MAP = MapType(_TEXT, _TEXT)

# A message-bus row, whichever adapter it came from.
RECORD = _struct(key=BinaryType(), value=BinaryType(), topic=_TEXT, timestamp=TimestampType())

# Metric samples.
SAMPLE = _struct(metric=_TEXT, labels=TEXT_MAP, ts=TimestampType(), value=_NUMBER)

# Columns without which a normalized row is of no use.
REQUIRED = {
    "tick": ("symbol", "price"),
    "kline": ("symbol", "close"),
    "market": ("symbol", "price_usd"),
    "sentiment": ("value",),
}
