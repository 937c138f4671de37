"""The job's history as a table: manifest, compaction, catalog."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import bus, put
from tidewatch import values as V
from tidewatch.operators.enrich import stamp
from tidewatch.session import get_text, names_in, put_text, remove_folder, work_folder
from tidewatch.sources import history_table, live_leaves, read_history, record_files, table_stream
from tidewatch.streaming import jobs, sinks

pytestmark = pytest.mark.usefixtures("narrow_state")
DAY = dt.date(2024, 5, 1)
KEYS = ("par", "fecha")


def shown(frame, *names):
    return sorted(map(str, frame.select(*(names or sorted(frame.columns))).collect()))


def tick(day, n, symbol="A"):
    at = dt.datetime(2024, 5, 1) + dt.timedelta(days=day, seconds=n)
    return (symbol, float(n), 0.0, at)


class History:
    """A history of five batches over three days, one file a batch."""

    def __init__(self, spark):
        self.spark, self.folder = spark, work_folder(spark, "history")
        self.path = f"{self.folder}/out"
        for n in range(5):
            self.land([tick(n // 2, n), tick(n // 2, 10 + n, "1"), tick(0, 20 + n, "A")])

    def land(self, rows):
        schema = put(self.spark, self.folder, rows)
        stream = table_stream(self.spark, f"{self.folder}/in", schema)
        stamped = stamp(stream, F.col("event_time"))
        self.schema = stamped.schema
        sinks.fan_out(stamped, {"all": sinks.batch_writer(self.path, KEYS)},
                      f"{self.folder}/c", sinks.ONCE).awaitTermination()

    def compact(self, days):
        return sinks.compact_history(self.spark, self.path, self.schema, KEYS,
                                     DAY + dt.timedelta(days=days))

    def rows(self, **more):
        return read_history(self.spark, self.path, self.schema, **more)

    def everything(self):
        return stamp(self.spark.read.parquet(f"{self.folder}/in"), F.col("event_time"))

    def runs(self):
        return {leaf.values()["run"].split("-")[0] == "closed"
                for leaf in live_leaves(self.spark, self.path)}


@pytest.fixture
def history(spark):
    return History(spark)


def same(history, frame=None):
    want = history.everything()
    assert shown((frame or history.rows()).select(want.columns)) == shown(want)


def test_compaction_keeps_every_row_and_leaves_one_folder_a_partition(history):
    same(history)
    before = len(live_leaves(history.spark, history.path))
    assert history.compact(2) > 0
    same(history)
    leaves = live_leaves(history.spark, history.path)
    closed = [f for f in leaves if f.values()["run"].startswith("closed")]
    # Days 0 and 1 of both symbols; the newest batch, with a late row of day 0, stays.
    assert len({f.partition() for f in closed}) == len(closed) == 4
    assert len(leaves) < before
    assert history.compact(2) == 0
    same(history)


def test_old_batches_cost_nothing(history):
    history.compact(3)
    history.land([tick(3, 99)])
    history.compact(3)
    history.compact(3)
    leaves = live_leaves(history.spark, history.path)
    merged = [f for f in leaves if f.values()["fecha"] < "2024-05-04"]
    assert all(f.values()["run"].startswith("closed") for f in merged)
    # Neither listed nor there: files, notes and folders of the first batches are gone.
    assert all("run=closed" in f or "fecha=2024-05-04" in f for f in history.rows().inputFiles())
    notes = [n for n in names_in(history.spark, f"{history.path}/_manifest") if "add-" in n]
    assert len(notes) == 1
    same(history)


def test_late_rows_of_closed_days_are_merged_later(history):
    history.compact(2)
    history.land([tick(0, 77), tick(5, 1)])
    history.land([tick(6, 1)])
    same(history)
    assert history.compact(2) >= 2
    same(history)
    parts = [f.partition() for f in live_leaves(history.spark, history.path)]
    assert parts.count((("par", "A"), ("fecha", "2024-05-01"))) == 1


def test_readers_of_merged_folders_may_end(history):
    planned = history.rows()
    history.compact(2)
    same(history, planned)


def test_unfinished_batches_and_losing_compactions_do_not_count(spark, history):
    half = history.everything().limit(2)
    sinks.write_history(half, f"{history.path}/run=x/batch=9", KEYS)
    same(history)
    name = f"{history.path}/_manifest/snapshot-{1:020d}.json"
    assert put_text(spark, name, '{"closed": [], "merged": []}')
    assert not put_text(spark, name, "other") and "closed" in get_text(spark, name)
    # Another compaction has taken the next number while this one was writing.
    taken = f"{history.path}/_manifest/snapshot-{2:020d}.json"

    def write(rows, folder):
        sinks.write_history(rows, folder, KEYS)
        put_text(spark, taken, '{"closed": [], "merged": []}')

    from tidewatch.sources.history import compact

    assert compact(spark, history.path, history.schema, KEYS, dt.date(2025, 1, 1), write) == 0
    same(history)


def test_a_batch_that_runs_again_counts_once(spark, history):
    run = next(n for n in names_in(spark, history.path) if n.startswith("run="))[4:]
    rows = read_history(spark, f"{history.path}/run={run}/batch=4", history.schema)
    rows = spark.createDataFrame(rows.select(history.schema.names).collect(), history.schema)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", run)
    try:
        sinks.batch_writer(history.path, KEYS)(rows, 4)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    same(history)


def test_the_table_is_the_history(spark, history):
    name = f"h_{history.folder.rsplit('-', 1)[1]}"

    def table():
        return history_table(spark, name, history.path, history.schema, KEYS)

    same(history, table())
    history.compact(2)
    same(history, table())
    history.land([tick(0, 55), tick(9, 1, "it's 100%")])
    same(history, table())
    history.compact(99)
    history.compact(99)
    same(history, table())
    one = spark.sql(f"SELECT price FROM {name} WHERE par = '1' AND fecha = DATE'2024-05-02'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(par" in plan
    assert len(one.inputFiles()) == 1
    assert sorted(r.price for r in one.collect()) == [12.0, 13.0]


def test_folders_can_be_left_out_before_they_are_listed(history):
    only = history.rows(only=lambda v: v["par"] == "1" and v["fecha"] == "2024-05-01")
    assert all("par=1/fecha=2024-05-01" in f for f in only.inputFiles())
    assert sorted(r.price for r in only.collect()) == [10.0, 11.0]


def test_null_partitions_are_kept(spark):
    folder = work_folder(spark, "history")
    frame = spark.createDataFrame([(None, None, 1.0), ("a", DAY, 2.0)],
                                  "par string, fecha date, price double")
    for batch in (0, 1):
        sinks.batch_writer(folder, KEYS)(frame, batch)
    for _ in range(2):
        got = read_history(spark, folder, frame.schema)
        assert shown(got) == shown(frame.union(frame).select(got.columns))
        name = f"n_{folder.rsplit('-', 1)[1]}"
        assert history_table(spark, name, folder, frame.schema, KEYS).count() == 4
        sinks.compact_history(spark, folder, frame.schema, KEYS, dt.date(2030, 1, 1))


def test_all_histories_of_a_job(spark):
    folder = work_folder(spark, "job")
    bus(spark, folder)
    job = jobs.Job(f"{folder}/history", f"{folder}/checkpoints", f"{folder}/results",
                   trigger=sinks.ONCE)

    def source(topics):
        return record_files(spark, f"{folder}/bus", topics=topics, streaming=True)

    for running in jobs.start_histories(spark, jobs.open_feeds(source), job).values():
        running.awaitTermination()
    for _ in range(2):
        for name in V.HISTORY:
            rows = jobs.open_history(spark, job, name)
            table = jobs.open_history(spark, job, name, f"{name}_{folder.rsplit('-', 1)[1]}")
            assert shown(table.select(rows.columns)) == shown(rows) and rows.count() > 0
        assert set(jobs.compact_histories(spark, job, dt.date(2030, 1, 1))) == set(V.HISTORY)
    # Folders without a manifest are read as they are.
    remove_folder(spark, f"{job.path('klines')}/_manifest")
    assert read_history(spark, job.path("klines"), jobs.history_schemas()["klines"]).count() == 20
