"""Alert rules over metric samples: thresholds, sustained conditions, silent feeds."""

import datetime as dt
import operator
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import values as V
from ..functions import at_micros, ceil_to, epoch_micros, floor_to, micros
from .series import SLICE, held_values

_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
_COMPARE = {">": operator.gt, "<": operator.lt, "==": operator.eq}


@dataclass(frozen=True)
class Rule:
    """Fires when ``metric`` with these labels compares true for at least ``hold``."""

    name: str
    metric: str
    op: str
    threshold: float
    hold: str
    severity: str
    labels: dict[str, str] = field(default_factory=dict)
    summary: str = ""
    description: str = ""

    def applies(self, labels: Column) -> Column:
        """Whether a sample is of this rule's series; expects the column ``metric``."""
        same = [F.coalesce(labels[k], F.lit("")) == v for k, v in self.labels.items()]
        return reduce(operator.and_, same, F.col("metric") == self.metric)

    def holds(self, value: Column) -> Column:
        """The comparison; Spark would take NaN for the largest number."""
        return _COMPARE[self.op](value, F.lit(self.threshold)) & ~F.isnan(value)


# --- fixed values: the alert rules in production -----------------------------
RULES = (
    Rule("BTCDumpDetectado", V.CHANGE_24H, "<", -3.0, "1 minute", "critical",
         {"par": "BTCUSDT"}, "💥 DUMP detectado en BTC",
         "BTC ha caído más de un 3% en las últimas 24h"),
    Rule("BTCPumpDetectado", V.CHANGE_24H, ">", 3.0, "1 minute", "warning",
         {"par": "BTCUSDT"}, "🚀 PUMP detectado en BTC",
         "BTC ha subido más de un 3% en las últimas 24h"),
    Rule("ProductorCaido", V.UP, "==", 0.0, "30 seconds", "critical",
         {"job": V.PRODUCER}, "🔴 Productor Binance caído",
         "El productor no responde desde hace más de 30 segundos"),
)


def matching(rules: Sequence[Rule], labels: Column) -> Column:
    """Array of (rule, severity, hold, holds) structs of the rules a sample falls under.

    Expects the columns ``metric`` and ``value``; ``labels`` is a map.
    """
    entries = []
    for rule in rules:
        entry = F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.severity).alias("severity"),
            F.lit(micros(rule.hold)).cast("bigint").alias("hold"),
            rule.holds(F.col("value")).alias("holds"),
        )
        entries.append(F.when(rule.applies(labels), entry))
    return F.filter(F.array(*entries), lambda e: e.isNotNull())


def with_texts(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the summary and description of each row's rule, for whoever is told."""

    def text(attribute: str) -> Column:
        pairs = [F.lit(x) for r in rules for x in (r.name, getattr(r, attribute))]
        return F.create_map(*pairs)[F.col("rule")] if pairs else F.lit("")

    return rows.withColumns({t: text(t) for t in ("summary", "description")})


def under_rules(samples: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Only the series some rule looks at; the filter on the metric reaches the scan."""
    looked_at = reduce(operator.or_, [r.applies(F.col("labels")) for r in rules])
    return samples.where(F.col("metric").isin(sorted({r.metric for r in rules})) & looked_at)


def threshold(samples: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Samples that meet a rule's condition, held or not."""
    hits = under_rules(samples, rules).withColumn(
        "hit", F.explode(matching(rules, F.col("labels")))
    )
    found = hits.where("hit.holds").select(
        "hit.rule", "hit.severity", "metric", "labels", "ts", "value"
    )
    return with_texts(found, rules)


def sustained(
    samples: DataFrame,
    rules: Sequence[Rule] = RULES,
    *,
    step: str = V.EVALUATE_EVERY,
    lookback: str = V.LOOKBACK,
    slice_length: str = SLICE,
) -> DataFrame:
    """One row per run of evaluations at which a rule's condition is true without a break.

    ``(rule, severity, labels, pending_at, firing_at, resolved_at, summary, description)``;
    ``firing_at`` is NULL for a run shorter than the rule's hold. A false evaluation ends a run, as does one that
    finds no sample young enough.

    Runs are formed within a slice of the series. Only the first and the last run of a slice
    can touch a neighbour, so only those two are ordered over the whole series.
    """
    width = micros(step)
    held = held_values(
        under_rules(samples, rules), step=step, lookback=lookback, slice_length=slice_length
    )
    hits = held.withColumn(
        "hit", F.explode(matching(rules, F.map_from_entries("labels")))
    ).where("hit.holds")
    true_spans = hits.select("metric", "labels", "slice", "hit.*", "cell", "until")

    # With the series among the keys the spans stay where the grid step left them.
    who = ["metric", "labels", "rule", "severity", "hold"]
    in_slice = _runs(true_spans, [*who, "slice"], width)
    ordered = Window.partitionBy(*who, "slice").orderBy("cell")
    outermost = (F.row_number().over(ordered) == 1) | (F.lead("cell").over(ordered).isNull())
    # Runs inside a slice are whole and stay where they are; the outermost runs of all slices
    # come together under one part number.
    parted = in_slice.withColumn("part", F.when(~outermost, F.col("slice")))
    whole = _runs(parted, [*who, "part"], width)

    like = samples.schema["ts"].dataType
    fires = F.col("cell") + ceil_to(F.col("hold"), width)
    found = whole.select(
        "rule",
        "severity",
        F.map_from_entries("labels").alias("labels"),
        at_micros(F.col("cell"), like).alias("pending_at"),
        at_micros(F.when(fires <= F.col("until"), fires), like).alias("firing_at"),
        at_micros(F.col("until") + width, like).alias("resolved_at"),
    )
    return with_texts(found, rules)


def _runs(spans: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Merge spans of grid times that follow one another without a gap."""
    ordered = Window.partitionBy(*keys).orderBy("cell")
    starts = F.coalesce(F.col("cell") > F.lag("until").over(ordered) + width, F.lit(True))
    numbered = spans.withColumn("starts", starts.cast("int")).withColumn(
        "run", F.sum("starts").over(ordered)
    )
    return (
        numbered.groupBy(*keys, "run")
        .agg(F.min("cell").alias("cell"), F.max("until").alias("until"))
        .drop("run")
    )


def transitions(alerts: DataFrame) -> DataFrame:
    """``(rule, severity, labels, state, at, pending_at, summary, description)`` per change."""
    states = [
        F.struct(F.lit("pending").alias("state"), F.col("pending_at").alias("at")),
        F.struct(F.lit("firing").alias("state"), F.col("firing_at").alias("at")),
        F.struct(F.lit("resolved").alias("state"), F.col("resolved_at").alias("at")),
    ]
    changes = alerts.withColumn("change", F.explode(F.array(*states)))
    return changes.where(F.col("change.at").isNotNull()).select(
        "rule", "severity", "labels", "change.state", "change.at", "pending_at", "summary",
        "description",
    )


def silences(
    rows: DataFrame,
    *,
    key: str = "symbol",
    ts: str = "event_time",
    limit: str = V.SILENCE_LIMIT,
    slice_length: str = SLICE,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """``(key, silent_from, silent_until)``: pauses of a feed longer than ``limit``.

    ``as_of`` is the time at which one looks, in UTC if it names no zone: a feed that has said
    nothing for longer than the limit by then is silent still, and its ``silent_until`` is NULL.
    Without it only silences that have ended are found.

    A pause longer than the limit cannot lie within a stretch as long as the limit. So rows
    are first reduced to the first and last time per stretch, on the map side; the pauses are
    then found between stretches. A pause may cross many slices: the first and last stretch
    of every slice are ordered over the whole key, the others within their slice.
    """
    width = micros(limit)
    length = max(micros(slice_length), 60 * width)
    us = epoch_micros(F.col(ts))
    stretches = (
        rows.where(F.col(ts).isNotNull())
        .groupBy(key, floor_to(us, width).alias("stretch"))
        .agg(F.min(us).alias("first"), F.max(us).alias("last"))
        .withColumn("slice", floor_to(F.col("stretch"), length))
    )
    in_slice = Window.partitionBy(key, "slice").orderBy("stretch")
    inside = stretches.withColumn("next", F.lead("first").over(in_slice)).withColumn(
        "outermost", (F.row_number().over(in_slice) == 1) | F.col("next").isNull()
    )
    over_slices = Window.partitionBy(
        key, F.when(~F.col("outermost"), F.col("slice"))
    ).orderBy("stretch")
    following = F.coalesce(F.col("next"), F.lead("first").over(over_slices))
    now = F.lit(None).cast("bigint")
    if as_of is not None:
        zoned = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
        now = F.lit((zoned - _EPOCH) // dt.timedelta(microseconds=1)).cast("bigint")
    like = rows.schema[ts].dataType
    return (
        inside.withColumn("next", following)
        .where(F.coalesce("next", now) - F.col("last") > width)
        .select(
            key,
            at_micros(F.col("last"), like).alias("silent_from"),
            at_micros(F.col("next"), like).alias("silent_until"),
        )
    )


def silences_stream(
    rows: DataFrame,
    *,
    key: str = "symbol",
    ts: str = "event_time",
    limit: str = V.SILENCE_LIMIT,
    delay: str = "1 minute",
    heartbeat: DataFrame | None = None,
) -> DataFrame:
    """``(key, silent_from, silent_after)``: beginnings of silences, from a stream.

    A session that has closed is a feed that fell silent: its last row at ``silent_from``, no
    other one up to and including ``silent_after``. Emitted when the watermark passes that.
    Only rows move the watermark, so if all feeds may stop at once, as those of one producer do,
    a ``heartbeat`` must go on: a stream with the time column ``ts`` alone.
    """
    beat = F.lit(False).alias("beat")
    timed = rows.select(key, F.col(ts).cast("timestamp").alias(ts), beat)
    if heartbeat is not None:
        nobody = F.lit(None).cast(rows.schema[key].dataType).alias(key)
        timed = timed.union(
            heartbeat.select(nobody, F.col(ts).cast("timestamp").alias(ts), ~beat)
        )
    sessions = (
        timed.withWatermark(ts, delay)
        .groupBy(F.session_window(ts, limit).alias("session"), key, "beat")
        .agg(F.max(ts).alias("silent_from"), F.max("beat").alias("beaten"))
    )
    # A filter on the key itself would be pushed below the watermark, which needs the beats.
    return sessions.where(~F.col("beaten")).select(
        key, "silent_from", F.col("session.end").alias("silent_after")
    )


def up_samples(
    rows: DataFrame,
    as_of: dt.datetime,
    *,
    job: str = V.PRODUCER,
    ts: str = "event_time",
    limit: str = V.SILENCE_LIMIT,
    step: str = V.EVALUATE_EVERY,
) -> DataFrame:
    """Samples ``(metric, labels, ts, value)`` of a job's health, from what it delivered.

    1 at each step before which a row came, 0 at each step at which none had come for longer
    than ``limit``, up to ``as_of``.
    """
    width, like = micros(step), rows.schema[ts].dataType
    us = epoch_micros(F.col(ts))
    alive = rows.where(F.col(ts).isNotNull()).groupBy(ceil_to(us, width).alias("us")).agg(
        F.lit(1.0).alias("value")
    )
    # The job is silent when all that it delivers is.
    whole = rows.select(F.lit(job).alias("job"), ts)
    gaps = silences(whole, key="job", ts=ts, limit=limit, as_of=as_of)
    zoned = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
    end = F.coalesce(
        epoch_micros(F.col("silent_until")) - 1,
        F.lit((zoned - _EPOCH) // dt.timedelta(microseconds=1)),
    )
    first = floor_to(epoch_micros(F.col("silent_from")) + micros(limit), width) + width
    down = gaps.select(first.alias("first"), floor_to(end, width).alias("last")).where(
        "first <= last"
    )
    dead = down.select(
        F.explode(F.sequence("first", "last", F.lit(width))).alias("us"), F.lit(0.0).alias("value")
    )
    return alive.union(dead).select(
        F.lit(V.UP).alias("metric"),
        F.create_map(F.lit("job"), F.lit(job)).alias("labels"),
        at_micros(F.col("us"), like).alias("ts"),
        "value",
    )
