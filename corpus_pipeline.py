"""From raw documents to token ids, in five stages that each see all their predecessor kept.

Rows of run(): one for each copy in the mix, with the columns of documents, the packed ``ids``
(little-endian unsigned 32-bit integers) and ``n_tokens``. Each stage is written as Parquet in
the folder the executors share and read again, so that a lost executor costs one stage's tasks.
"""

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import bpe, mixing, pii, quality, simhash
from tidewatch.session import remove_folder, work_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove failing lines; documents that fail or lose too much go."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind of data in place of each span."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw and repeat documents until each source has its share of words."""
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the ids of each text; in smaller blocks than alone, as the stages share the workers."""
    return bpe.encode(docs, rows=512, remembered=100_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("encoding", encoding),
]

#: SQL can't express the fingerprints' hash, the trained classifier or the tokenizer; the tests
#: hold run() against a plain Python version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        folder = work_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        if before:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(folder), folder
    return docs
