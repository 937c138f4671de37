"""Column expressions shared by the operators. All run inside the JVM."""

from .labels import classify_move, classify_sentiment, ticker_topic
from .numbers import percent_change, round_to, to_bigint, to_double
from .times import (
    at_micros,
    ceil_to,
    epoch_micros,
    floor_to,
    from_epoch_millis,
    from_epoch_seconds,
    micros,
    now_millis,
    time_order,
)

__all__ = [
    "at_micros",
    "ceil_to",
    "classify_move",
    "classify_sentiment",
    "epoch_micros",
    "floor_to",
    "from_epoch_millis",
    "from_epoch_seconds",
    "micros",
    "now_millis",
    "percent_change",
    "round_to",
    "time_order",
    "ticker_topic",
    "to_bigint",
    "to_double",
]
