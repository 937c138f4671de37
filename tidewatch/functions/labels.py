"""Classification and naming expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import values as V


def classify_move(change: Column, limit: float = V.MOVE_LIMIT_PCT) -> Column:
    """Pump above ``limit``, dump below ``-limit``; the bounds themselves and NULL are normal."""
    return (
        F.when(change > limit, V.PUMP).when(change < -limit, V.DUMP).otherwise(V.NORMAL)
    )


def classify_sentiment(value: Column) -> Column:
    """Name of the sentiment band of an index value; NULL stays NULL."""
    named = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, name in V.SENTIMENT_BANDS:
        named = named.when(value <= upper, name)
    return named.otherwise(V.SENTIMENT_TOP)


def ticker_topic(symbol: Column) -> Column:
    return F.concat(F.lower(symbol), F.lit("-ticker"))
