"""Sustained alerts on a stream: the one operator that needs state of its own.

Two queries, because Spark lets no such operator follow an aggregation. The first reduces the
samples to one value per series and evaluation step, by an ordinary watermarked aggregation
with map-side partial results, and appends each step once it is final to a table. The second
follows that table. It sees a few values per series and trigger however many samples came in,
in order, so it holds nothing back: its state per rule and series is the current run and the
reach of the last value.
"""

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import values as V
from ..functions import ceil_to, micros
from ..operators.alerts import RULES, Rule, matching, under_rules, with_texts
from .series import follow, last_values

CHANGES = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("state", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("pending_at", T.TimestampType()),
        T.StructField("summary", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)
_STATE = "run_start long, run_end long, open_until long, holds boolean, fired boolean"
_OUTPUT = (
    "rule string, severity string, series string, state string, at_us long, pending_us long"
)


def step_values(
    samples: DataFrame,
    rules: Sequence[Rule] = RULES,
    *,
    delay: str = "1 minute",
    step: str = V.EVALUATE_EVERY,
) -> DataFrame:
    """The last value of each series per evaluation step, for the metrics under rules."""
    return last_values(under_rules(samples, rules), delay=delay, step=step)


def sustained_changes(
    steps: DataFrame,
    rules: Sequence[Rule] = RULES,
    *,
    step: str = V.EVALUATE_EVERY,
    lookback: str = V.LOOKBACK,
) -> DataFrame:
    """The columns of ``transitions``, a row as each change becomes certain.

    ``steps`` must deliver a series' later steps in later triggers or files, as the table of
    ``step_values`` does. The rows are those of ``transitions(sustained(...))``, short of what the watermark
    has not passed yet.
    """
    width, reach = micros(step), micros(lookback)
    labels = F.from_json("series", "map<string,string>")
    judged = (
        steps.withWatermark("step_at", "0 seconds")
        .withColumn("hit", F.explode(matching(rules, labels)))
        .select(
            "hit.rule",
            "hit.severity",
            ceil_to(F.col("hit.hold"), width).alias("hold"),
            "hit.holds",
            "series",
            "step_at",
            F.unix_micros("step_at").alias("cell"),
            F.unix_micros("last").alias("us"),
        )
    )

    def replay(
        key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        rule, severity, series, hold = *key[:3], int(key[3])
        changes: list[tuple[str, int, int]] = []
        run_start, run_end, open_until, holds, fired = (
            state.get if state.exists else (None, None, None, False, False)
        )

        def close_value(last_seen: int) -> None:
            """The last value was seen up to ``last_seen``; the run grows if it held."""
            nonlocal run_end, fired
            if holds:
                run_end = last_seen
                fires = run_start + hold
                if not fired and fires <= run_end:
                    fired = True
                    changes.append(("firing", fires, run_start))

        def end_run() -> None:
            nonlocal run_start, run_end, fired
            if run_start is not None:
                changes.append(("resolved", run_end + width, run_start))
            run_start, run_end, fired = None, None, False

        if state.hasTimedOut:
            close_value(open_until)
            end_run()
            state.remove()
        else:
            parts = [c[["cell", "us", "holds"]] for c in chunks]
            cells = pd.concat(parts).sort_values("cell")
            for cell, us, now_holds in zip(*(cells[c].tolist() for c in cells.columns)):
                if open_until is not None:
                    close_value(min(cell - width, open_until))
                    if run_start is not None and (not now_holds or run_end + width < cell):
                        end_run()
                open_until, holds = (us + reach) // width * width, now_holds
                if holds and run_start is None:
                    run_start = run_end = cell
                    changes.append(("pending", cell, cell))
            if run_start is None:
                state.remove()
            else:
                state.update((run_start, run_end, open_until, holds, fired))
                # A millisecond after the step that could still continue the run.
                expiry = (open_until + width) // 1000 + 1
                state.setTimeoutTimestamp(max(expiry, state.getCurrentWatermarkMs() + 1))
        if changes:
            yield pd.DataFrame(
                [(rule, severity, series, *change) for change in changes],
                columns=["rule", "severity", "series", "state", "at_us", "pending_us"],
            )

    changes = judged.groupBy("rule", "severity", "series", "hold").applyInPandasWithState(
        replay, _OUTPUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    named = changes.select(
        "rule",
        "severity",
        labels.alias("labels"),
        "state",
        F.timestamp_micros("at_us").alias("at"),
        F.timestamp_micros("pending_us").alias("pending_at"),
    )
    return with_texts(named, rules)


def up_steps(
    rows: DataFrame,
    heartbeat: DataFrame,
    *,
    job: str = V.PRODUCER,
    ts: str = "event_time",
    limit: str = V.SILENCE_LIMIT,
    delay: str = "1 minute",
    step: str = V.EVALUATE_EVERY,
) -> DataFrame:
    """The health of a job at each step, in the shape of ``step_values``: 1 if a row came
    within ``limit``, else 0.

    ``heartbeat``, a stream with the time column ``ts``, goes on when the job stops: its rows
    move the watermark and open the steps at which there is nothing else. ``limit`` must be a
    multiple of the step.
    """

    def timed(frame: DataFrame, alive: bool) -> DataFrame:
        return frame.select(F.col(ts).cast("timestamp").alias("ts"), F.lit(alive).alias("alive"))

    both = timed(rows, True).union(timed(heartbeat, False)).withWatermark("ts", delay)
    window = F.window("ts", limit, step, "1 microsecond")
    seen = both.groupBy(window.alias("window")).agg(F.max("alive").alias("alive"))
    step_at = F.timestamp_micros(F.unix_micros("window.end") - 1)
    return seen.select(
        F.lit(V.UP).alias("metric"),
        F.to_json(F.create_map(F.lit("job"), F.lit(job))).alias("series"),
        step_at.alias("step_at"),
        step_at.alias("last"),
        F.when(F.col("alive"), 1.0).otherwise(0.0).alias("value"),
    )


def start_alerts(
    spark: SparkSession,
    samples: DataFrame,
    folder: str,
    rules: Sequence[Rule] = RULES,
    *,
    delay: str = "1 minute",
    step: str = V.EVALUATE_EVERY,
    **settings,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both queries under ``folder``; the changes land in ``folder/changes``."""
    steps = step_values(samples, rules, delay=delay, step=step)
    return follow_steps(spark, steps, folder, rules, step=step, **settings)


def follow_steps(
    spark: SparkSession,
    steps: DataFrame,
    folder: str,
    rules: Sequence[Rule] = RULES,
    *,
    step: str = V.EVALUATE_EVERY,
    lookback: str = V.LOOKBACK,
    trigger: dict | None = None,
    files_per_trigger: int = 64,
    wait: bool = False,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Keep the steps (``step_values`` or ``up_steps``) as a table and follow it by the rules.

    ``files_per_trigger`` and ``wait`` are those of ``series.follow``.
    """
    return follow(
        spark, steps, folder,
        lambda followed: sustained_changes(followed, rules, step=step, lookback=lookback),
        result="changes", trigger=trigger, files_per_trigger=files_per_trigger, wait=wait,
    )
