"""Small tables for the operators' tests."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def documents(spark, rows):
    """Rows of (doc_id, text) or longer tuples, padded with nulls."""
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], DOCS)


def table_rows(sf_dir, name):
    import pyarrow.parquet as pq

    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


#: Texts that tend to break things.
ODD_TEXTS = [
    None, "", " ", "\n\n \t", "word", "a b", "a b c", "the same line\nthe same line\n",
    "naïve café 🙂🙂 中文   x", "\x00\x01 control", "x" * 70_000, "a b " * 20_000,
    "1 " * 5_000, "  two  spaces   three\r\n\tand tabs ", "é" * 3_000,
]
