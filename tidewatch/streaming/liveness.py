"""Silent feeds on a stream that may lag behind: a clock that waits for its input.

Only a clock notices that everything has stopped. But the time of day, put beside rows that are an
hour behind it, moves a watermark past them: they would be dropped as late, and a producer be
called down that only has not been read yet. So the clock is held back. A first query writes, for
each trigger, when each feed was heard (first and last time per stretch, so a few rows however many
came in), and a beat of the clock only if the trigger read no row at all: a source always hands
over what it has, so nothing was left to read then. While rows come, they are the clock.

Who follows that table needs no watermark over the feeds. Each feed has a clock of its own, its
latest row or the last beat, whichever is later: feeds that lag behind one another lose nothing.
"""

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import values as V
from ..functions import epoch_micros, floor_to, micros
from ..sources.records import table_stream
from .sinks import batch_writer, fan_out

PRESENCE = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("first", T.TimestampType()),
        T.StructField("last", T.TimestampType()),
        T.StructField("beat", T.TimestampType()),
    ]
)


def heard(batch: DataFrame, limit: str) -> DataFrame:
    """PRESENCE rows of a trigger's ``(feed, ts, beat)`` rows: of rows where beat is false the first
    and last time of each feed and stretch, or if there are none the latest beat."""
    us = epoch_micros(F.col("ts"))
    none = F.lit(None).cast("timestamp")
    seen = batch.where("NOT beat AND ts IS NOT NULL").groupBy(
        "feed", floor_to(us, micros(limit)).alias("stretch")
    ).agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    idle = batch.agg(
        F.max(F.when(F.col("beat"), F.col("ts"))).alias("at"), F.count_if(~F.col("beat")).alias("n")
    ).where("n = 0 AND at IS NOT NULL")
    return seen.select("feed", "first", "last", none.alias("beat")).union(
        idle.select(F.lit(None).cast("string"), none, none, "at")
    )


def start_presence(
    rows: DataFrame,
    clock: DataFrame,
    folder: str,
    *,
    key: str = "symbol",
    ts: str = "event_time",
    limit: str = V.SILENCE_LIMIT,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write who was heard when, from the feeds' rows and a clock (column ``ts``), to a table.

    Both are read by one query, so that a trigger's rows and beats are of the same moment. A batch
    that runs again may leave its rows twice, which says nothing new.
    """
    def timed(frame: DataFrame, feed, beat: bool) -> DataFrame:
        return frame.select(feed.cast("string").alias("feed"),
                            F.col(ts).cast("timestamp").alias("ts"), F.lit(beat).alias("beat"))

    both = timed(rows, F.col(key), False).union(timed(clock, F.lit(None), True))
    write = batch_writer(f"{folder}/presence", (), lambda batch: heard(batch, limit).coalesce(1))
    return fan_out(both, {"presence": write}, f"{folder}/checkpoints/presence", trigger, "presence")


def presence_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = 64
                    ) -> DataFrame:
    """The table as a stream, in the order in which it was written."""
    return table_stream(spark, f"{folder}/presence/run=*/batch=*", PRESENCE, files_per_trigger)


def _timed(presence: DataFrame, feed) -> DataFrame:
    """PRESENCE for a state function: (feed, clock, beat, first_us, last_us), clock for beats.

    Beats alone move the watermark; rows, whose column is null, are never late for it. A filter
    that leaves the beats out would be pushed below the watermark, so they stay, as groups apart.
    """
    return presence.withWatermark("beat", "0 seconds").select(
        feed.alias("feed"), F.col("feed").isNull().alias("clock"), "beat",
        F.unix_micros("first").alias("first_us"), F.unix_micros("last").alias("last_us"),
    )


def _spans(chunks: Iterator[pd.DataFrame]) -> list[list[int]]:
    found = pd.concat([c[["first_us", "last_us"]] for c in chunks])
    return [[int(a), int(b)] for a, b in found.itertuples(index=False)]


def _joined(spans: list[list[int]], gap: int) -> list[list[int]]:
    """Spans in order, those no more than ``gap`` apart as one."""
    joined: list[list[int]] = []
    for first, last in sorted(spans):
        if joined and first - joined[-1][1] <= gap:
            joined[-1][1] = max(joined[-1][1], last)
        else:
            joined.append([first, last])
    return joined


def silences(presence: DataFrame, *, limit: str = V.SILENCE_LIMIT, delay: str = "1 minute"
             ) -> DataFrame:
    """``(feed, silent_from, silent_after)``: beginnings of pauses longer than ``limit``.

    As ``operators.alerts.silences_stream`` has them. A pause is reported when the feed's clock is
    ``delay`` past ``silent_after``; rows of a feed that come later than that, by its own latest
    row, are left out. The state of a feed is what it said within the last delay.
    """
    gap, slack = micros(limit), micros(delay)
    rows = _timed(presence, F.coalesce("feed", F.lit("")))

    def listen(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
               ) -> Iterator[pd.DataFrame]:
        if key[1]:  # beats have done what they are for
            return
        spans = json.loads(state.get[0]) if state.exists else []
        latest = max((last for _, last in spans), default=None)
        now = state.getCurrentWatermarkMs() * 1000
        if not state.hasTimedOut:
            fresh = _spans(chunks)
            spans += [s for s in fresh if latest is None or s[1] >= latest - slack]
        if not spans:
            return
        clock = max(now, max(last for _, last in spans))
        joined = _joined(spans, gap)
        over = [last for _, last in joined if last + gap + slack <= clock]
        kept = [s for s in joined if s[1] + gap + slack > clock]
        if kept:
            state.update((json.dumps(kept),))
            state.setTimeoutTimestamp((max(s[1] for s in kept) + gap + slack) // 1000 + 1)
        elif state.exists:
            state.remove()
        if over:
            yield pd.DataFrame([(key[0], at) for at in over], columns=["feed", "us"])

    found = rows.groupBy("feed", "clock").applyInPandasWithState(
        listen, "feed string, us long", "spans string", "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return found.select(
        "feed", F.timestamp_micros("us").alias("silent_from"),
        F.timestamp_micros(F.col("us") + gap).alias("silent_after"),
    )


def health(
    presence: DataFrame,
    *,
    job: str = V.PRODUCER,
    limit: str = V.SILENCE_LIMIT,
    delay: str = "1 minute",
    step: str = V.EVALUATE_EVERY,
) -> DataFrame:
    """The health of the job whose feeds these are, at each step, in the shape of ``up_steps``.

    1 if any feed was heard within ``limit``, else 0. A step comes out when the job's clock, its
    latest row or beat, is ``delay`` past it: so a pause in the backlog is seen as it was, and
    nothing is down just because it has not been read. Feeds of one job that lag by more than the
    delay behind one another count as far as they are in time. Steps begin with the first row.
    """
    gap, slack, width = micros(limit), micros(delay), micros(step)

    def judge(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
              ) -> Iterator[pd.DataFrame]:
        if key[1]:
            return
        spans, following = json.loads(state.get[0]) if state.exists else ([], None)
        if not state.hasTimedOut:
            spans += _spans(chunks)
        spans = _joined(spans, gap)
        clock = max(state.getCurrentWatermarkMs() * 1000, spans[-1][1])
        until = (clock - slack) // width * width
        if following is None:
            following = -(-spans[0][0] // width) * width
        runs = []
        for first, last in spans:
            up_from = max(following, -(-first // width) * width)
            # The last step that sees the span: the largest below last + limit.
            up_to = -(-(last + gap) // width) * width - width
            if following < up_from and following <= until:
                runs.append((following, min(until, up_from - width), 0.0))
            if up_from <= min(up_to, until):
                runs.append((up_from, min(up_to, until), 1.0))
            following = max(following, min(until, max(up_to, up_from - width)) + width)
        if following <= until:
            runs.append((following, until, 0.0))
            following = until + width
        # The latest span tells from when on the job is silent; those before are settled.
        kept = [s for s in spans[:-1] if s[1] + gap > following] + spans[-1:]
        state.update((json.dumps([kept, following]),))
        state.setTimeoutTimestamp(
            max((following + slack) // 1000 + 1, state.getCurrentWatermarkMs() + 1)
        )
        if runs:
            yield pd.DataFrame(runs, columns=["first_us", "last_us", "value"])

    runs = _timed(presence, F.lit("")).groupBy("feed", "clock").applyInPandasWithState(
        judge, "first_us long, last_us long, value double", "spans string", "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    steps = F.sequence("first_us", "last_us", F.lit(width))
    each = runs.select("value", F.explode(F.transform(steps, F.timestamp_micros)).alias("step_at"))
    return each.select(
        F.lit(V.UP).alias("metric"),
        F.to_json(F.create_map(F.lit("job"), F.lit(job))).alias("series"),
        "step_at",
        F.col("step_at").alias("last"),
        "value",
    )
