"""Message rows ``(key, value, topic, timestamp)`` from a bus or from files.

The operators never see which one it was, nor whether it streams.
"""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RECORD


def kafka_options(
    servers: str,
    topics: Iterable[str],
    *,
    starting: str = "latest",
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. ``min_partitions`` lets one hot topic partition feed several tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_records(
    spark: SparkSession, servers: str, topics: Iterable[str], *, streaming: bool = True, **more
) -> DataFrame:
    """Subscribe to one or several topics. Needs the Kafka connector on the class path.

    A batch read starts at ``earliest`` unless told otherwise: ``latest`` is an empty range.
    """
    if not streaming:
        more = {"starting": "earliest", **more}
    reader = spark.readStream if streaming else spark.read
    source = reader.format("kafka").options(**kafka_options(servers, topics, **more)).load()
    return source.select(*RECORD.names)


def record_files(
    spark: SparkSession,
    path: str,
    *,
    topics: Iterable[str] | None = None,
    streaming: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of message rows, the stand-in for (or an archive of) a bus."""
    rows = table_stream(spark, path, RECORD, files_per_trigger) if streaming else (
        spark.read.schema(RECORD).parquet(path)
    )
    return rows if topics is None else rows.where(F.col("topic").isin(list(topics)))


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A Parquet table as a stream of its files, oldest first."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def text_messages(spark: SparkSession, path: str, *, streaming: bool = False) -> DataFrame:
    """One raw JSON message per line, in column ``json``."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path).withColumnRenamed("value", "json")


def whole_documents(spark: SparkSession, path: str, *, streaming: bool = False) -> DataFrame:
    """One raw JSON document per file, as polled, in column ``json``."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path, wholetext=True).withColumnRenamed("value", "json")
