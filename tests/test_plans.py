"""What the physical plans of the batch queries must and must not contain."""

import pytest

import __spark_entry__ as entry
from tidewatch.plans.catalog import QUERIES

BATCH = sorted(n for n in QUERIES if not n.startswith(("stream_", "history_")))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_cross_join_or_global_window(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for bad in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin",
                "SinglePartition", "CollectLimit"):
        if name == "ok_error_counts" and bad == "SinglePartition":
            continue  # one row in the end: partial counts meet in one place
        assert bad not in text, bad


def test_scan_reads_only_what_is_used(spark, sf_dir):
    text = plan(entry.queries()["local_minute_price"](spark, sf_dir))
    columns = "struct<ts:timestamp_ntz,event_type:string,value:double>"
    assert f"ReadSchema: {columns}" in text


def test_messages_are_parsed_once(spark, sf_dir):
    assert plan(entry.queries()["parse_ticks"](spark, sf_dir)).count("from_json(") == 1


def test_aggregations_start_on_the_map_side(spark, sf_dir):
    text = plan(entry.queries()["sma_volatility"](spark, sf_dir))
    assert text.count("partial_sum") >= 2 and "SortAggregate" not in text
    assert "ObjectHashAggregate" not in text


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns[:3] == ["window_start", "window_end", "symbol"] and frame.count() > 0


def test_many_panes_keep_the_pane_plan(spark, sf_dir):
    """Raw rows are never copied into windows, however many panes a window has."""
    text = plan(QUERIES["sma_volatility_panes"](spark, sf_dir))
    assert "Expand" not in text and text.count("partial_sum") >= 2


def test_snapshots_are_looked_up_without_a_join(spark, sf_dir):
    assert "Join" not in plan(QUERIES["explode_snapshot"](spark, sf_dir))


@pytest.mark.parametrize("name", ["last_value", "normalize_kline"])
def test_latest_values_are_hash_aggregates(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "HashAggregate" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["route_rejects", "message_counts"])
def test_outcomes_come_of_one_parse(spark, sf_dir, name):
    """Once to type the message, once to tell whether one without a stream is JSON at all."""
    text = plan(QUERIES[name](spark, sf_dir))
    assert text.count("Generate explode(array(from_json(") <= 2  # a ticker and a candle source


def test_rate_shuffles_samples_once(spark):
    from tidewatch.operators import series

    samples = spark.sql(
        "SELECT 'm' AS metric, map('a', 'b') AS labels, timestamp_seconds(id) AS ts,"
        " CAST(id AS DOUBLE) AS value FROM range(10)"
    )
    text = plan(series.rate(samples))
    # Of samples by cell, and of cells by slice; steps stay where they are.
    assert text.count("Exchange hashpartitioning") == 2


def test_combined_metrics_meet_as_runs(spark, sf_dir):
    text = plan(QUERIES["metric_diff"](spark, sf_dir))
    # The grid's sequence is spelled out above the last exchange.
    assert text.index("Generate explode(sequence(cell") < text.index("Exchange")
