import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch import session
from tidewatch import values as V
from tidewatch.operators.enrich import stamp
from tidewatch.session import work_folder
from tidewatch.sources import history_table, kafka_options, kafka_records, read_history
from tidewatch.streaming import sinks


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def history(spark):
    rows = spark.createDataFrame(
        [(s, float(i), 1.0, 0.0, 1_700_000_000_000 + i * 3_600_000)
         for i in range(100) for s in ("BTCUSDT", "ETHUSDT")], S.TICK
    )
    path = work_folder(spark, "history")
    stamped = stamp(rows, F.timestamp_millis("timestamp"))
    sinks.write_history(stamped, path, V.HISTORY["tickers"])
    return path, stamped.schema


def test_round_trip_and_pruning(spark, history):
    path, schema = history
    frame = read_history(spark, path, schema)
    assert frame.count() == 200
    day = frame.where((F.col("par") == "BTCUSDT") & (F.col("fecha") == dt.date(2023, 11, 15))
                      & (F.col("price") > 5)).select("price")
    text = plan(day)
    filters = text[text.index("PartitionFilters"):]
    assert "par" in filters and "fecha" in filters
    assert "GreaterThan(price,5.0)" in text
    assert "ReadSchema: struct<price:double>" in text
    assert day.count() == 20


def test_external_table(spark, history):
    path, schema = history
    spark.sql("DROP TABLE IF EXISTS ticker_history")
    table = history_table(spark, "ticker_history", path, schema, V.HISTORY["tickers"])
    assert table.where("par = 'ETHUSDT'").count() == 100
    assert "PartitionFilters: [isnotnull(par" in plan(table.where("par = 'ETHUSDT'"))


def test_rebalanced_write_makes_few_files(spark, history):
    path, schema = history
    files = read_history(spark, path, schema).select(F.input_file_name()).distinct().count()
    assert files <= 2 * 6


def test_kafka_options():
    assert kafka_options("h:1", ["a", "b"]) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest"
    }
    more = dict(starting="earliest", max_per_trigger=5, min_partitions=64)
    assert kafka_options("h:1", ["a"], **more) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5", "minPartitions": "64",
    }


def test_kafka_without_connector_says_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_records(spark, "localhost:1", ["a"])


class Session:
    """The two settings a work folder depends on."""

    def __init__(self, master, shared):
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.sparkContext = self
        self.master = master


def test_work_folder_is_the_shared_one(monkeypatch):
    monkeypatch.setattr(session, "_made", [])  # nothing there to clear up
    cluster = Session("spark://h:7077", "hdfs://n/shared/")
    assert work_folder(cluster, "x").startswith("hdfs://n/shared/tidewatch/x-")
    assert work_folder(cluster, "x") != work_folder(cluster, "x")
    assert "/tidewatch/x-" in work_folder(Session("local[2]", None), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Session("spark://h:7077", None), "x")
