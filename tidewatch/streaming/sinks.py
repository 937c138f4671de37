"""Where results go. Every query gets a checkpoint; triggers are a parameter."""

import datetime as dt
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..session import remove_folder, state_partitions, written_folders
from ..sources.history import compact, forget_batch, note_batch

ONCE = {"availableNow": True}


def every(span: str) -> dict[str, str]:
    return {"processingTime": span}


def _writer(stream: DataFrame, checkpoint: str, mode: str, trigger: dict, name: str | None
            ) -> DataStreamWriter:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger)


def _start(writer: DataStreamWriter, stream: DataFrame) -> StreamingQuery:
    with state_partitions(stream.sparkSession):
        return writer.start()


def to_history(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append to a partitioned Parquet history, exactly once."""
    writer = _writer(stream, checkpoint, "append", trigger or every("1 minute"), name)
    return _start(
        writer.format("parquet").option("path", path).partitionBy(*partition_by), stream
    )


def to_console(
    stream: DataFrame,
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Print whole rows, untruncated."""
    writer = _writer(stream, checkpoint, mode, trigger or every("30 seconds"), name)
    return _start(writer.format("console").option("truncate", False), stream)


def to_memory(stream: DataFrame, name: str, checkpoint: str, mode: str = "append",
              trigger: dict | None = None) -> StreamingQuery:
    """An in-memory table on the driver: for small results and tests only."""
    writer = _writer(stream, checkpoint, mode, trigger or ONCE, name)
    return _start(writer.format("memory"), stream)


def to_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """The whole result of a ``complete`` query, written anew at each trigger.

    Each trigger writes a version of its own. It counts once it is complete, so readers
    (``read_table``) always find a whole result and a crash leaves the last one. The two
    versions before it stay for those who still read them.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = f"{path}/versions"
        earlier = written_folders(spark, versions)
        stamp = time.time_ns()
        if earlier:  # later than the last one, whatever the clock says
            stamp = max(stamp, int(earlier[-1].rsplit("/", 1)[1].split("-")[0]) + 1)
        batch.write.parquet(f"{versions}/{stamp:020d}-{batch_id}")
        for old in earlier[:-2]:
            remove_folder(spark, old)

    writer = _writer(stream, checkpoint, "complete", trigger or every("30 seconds"), name)
    return _start(writer.foreachBatch(replace), stream)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The latest whole result that ``to_table`` has written; no rows before the first."""
    written = written_folders(spark, f"{path}/versions")
    if not written:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(written[-1])


def to_topics(
    messages: DataFrame,
    servers: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Publish ``(topic, key, value)`` rows, each to the topic it names. Needs the connector."""
    writer = _writer(messages, checkpoint, "append", trigger or every("1 second"), name)
    return _start(
        writer.format("kafka").option("kafka.bootstrap.servers", servers), messages
    )


def topic_sender(servers: str) -> Callable[[DataFrame, int], None]:
    """A branch for ``fan_out`` that sends ``(topic, key, value)`` rows. Needs the connector."""

    def send(batch: DataFrame, _: int) -> None:
        batch.write.format("kafka").option("kafka.bootstrap.servers", servers).save()

    return send


def to_topic_files(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """The same rows as files, one directory per topic."""
    return to_history(messages, path, checkpoint, ("topic",), trigger, name)


def fan_out(
    stream: DataFrame,
    branches: dict[str, Callable[[DataFrame, int], None]],
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Read the source once per trigger and hand the parsed batch to several writers.

    For row-wise branches only: windowed indicators keep state and are queries of their own.
    After a failure the whole batch runs again, so writers should be idempotent per batch id.
    """

    def write_all(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for write in branches.values():
                write(kept, batch_id)
        finally:
            kept.unpersist()

    writer = _writer(stream, checkpoint, "append", trigger or every("1 minute"), name)
    return _start(writer.foreachBatch(write_all), stream)


def batch_writer(
    path: str, partition_by: Sequence[str], select: Callable[[DataFrame], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """A branch for ``fan_out``: each batch of a query writes a directory of its own.

    A batch that runs again replaces what it left. The query's id is part of the path: it stays
    as long as the checkpoint, so a query that starts over never touches what another one wrote.
    Unlike the plain file sink it joins small files and splits hot directories. A finished batch is
    noted in the history's manifest, by which ``read_history`` and ``history_table`` go.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if select is None else select(batch)
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "table"
        forget_batch(batch.sparkSession, path, run, batch_id)
        write_history(rows, f"{path}/run={run}/batch={batch_id}", partition_by, mode="overwrite")
        note_batch(batch.sparkSession, path, run, batch_id, len(partition_by))

    return write


def compact_history(spark: SparkSession, path: str, schema: T.StructType,
                    partition_by: Sequence[str], before: dt.date) -> int:
    """Merge what batches left in partitions of days before ``before``, into few, even files."""
    return compact(spark, path, schema, partition_by, before,
                   lambda rows, folder: write_history(rows, folder, partition_by))


def write_history(rows: DataFrame, path: str, partition_by: Sequence[str], mode: str = "append"
                  ) -> None:
    """Write a table into a history with few, evenly sized files.

    The rebalance hint groups rows by partition before writing, splits a directory that holds
    much of the data over several tasks, and joins small ones (adaptive execution).
    """
    evened = rows.hint("rebalance", *partition_by)
    evened.write.mode(mode).partitionBy(*partition_by).parquet(path)
