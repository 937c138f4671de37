"""Helpers shared by the operators: words, tables, bounded Arrow batches, cut lineage."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_folder

#: Word breaks: space and \x09-\x0D, which are also what bytes.split() breaks at.
BREAKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Maximal runs of characters other than word breaks; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), "")


def word_count(text: Column) -> Column:
    """Number of words, counted where a word begins; null has none."""
    marked = F.concat(F.lit(" "), F.translate(F.coalesce(text, F.lit("")), BREAKS, " " * 6))
    return F.regexp_count(marked, F.lit(r"\x20(?!\x20|$)")).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def batches(spark: SparkSession, rows: int, size: int = 32 << 20) -> None:
    """Bound what one Arrow batch holds, by rows and by bytes, for the Python stages."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")


def cut(df: DataFrame) -> DataFrame:
    """The frame as a reliable checkpoint in the folder that all executors share."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(work_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def own_names(df: DataFrame, **derived: Column) -> DataFrame:
    """Add the derived columns, replacing input columns whose names clash (in any case)."""
    taken = {name.lower() for name in derived}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in derived.items()])


def sized(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """A checkpointed frame, marked for broadcast if it has few rows, else as it is."""
    return F.broadcast(df) if df.count() <= most_rows else df


def shielded(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame under column names that nothing derived clashes with, and these by name."""
    inner = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*inner.values()), inner


def restored(df: DataFrame, inner: dict[str, str], **fresh: Column) -> DataFrame:
    """Back to the names before shielded(), with fresh values for some columns."""
    return df.select(*[fresh.get(c, F.col(at)).alias(c) for c, at in inner.items()])


def with_text(df: DataFrame, inner: dict[str, str], text: str, fresh: Column) -> DataFrame:
    """restored() with a new text; ``n_chars``, where there is one, follows it."""
    values = {text: fresh}
    if "n_chars" in inner:
        values["n_chars"] = F.coalesce(F.length(fresh), F.lit(0)).cast("long")
    return restored(df, inner, **values)
