"""Token counts as an exact length histogram.

Each document adds its encoded length; documents of one length are one row from the first
partial aggregate on, so what is shuffled is bounded by the number of different lengths. Suffix
sums then answer, for every context limit, how many documents and tokens are at least as long
and how many tokens remain when longer documents are truncated. Sums run within blocks of
lengths and over the blocks' totals, never over all lengths in one task.
"""

import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import batches, cut, own_names

BLOCK = 256


def lengths(
    docs: DataFrame,
    *,
    text: str = "text",
    path: str = bpe.RANKS,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """The documents with ``n_tokens``; null and empty texts have 0."""
    batches(docs.sparkSession, 2048)
    return own_names(docs, n_tokens=bpe.length_column(F.col(f"`{text}`"), path, pattern))


def histogram(docs: DataFrame, *, text: str = "text", **encoding) -> DataFrame:
    """(n_tokens, n_docs); no rows for an empty table. Other columns are not read."""
    only = docs.select(F.col(f"`{text}`").alias("text"))
    return lengths(only, **encoding).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """For each length L that occurs: documents and tokens in all texts at least, and below, L.

    ``docs_from``, ``tokens_from``: documents of at least L tokens and their tokens.
    ``truncated_tokens``: tokens left if every document is cut after L tokens.
    ``total_docs``, ``total_tokens``: of all documents. ``first_rank`` and ``last_rank``: the
    places, from 1, that documents of this length take when ordered by length, which answers
    quantiles.
    """
    # Read twice below: the encoding must not be.
    sums = cut(counts.select(
        "n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("n_tokens") / BLOCK).alias("block"),
    ))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = sums.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t")).select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(every).alias("total_docs"),
        F.sum("t").over(every).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    docs_from = F.sum("n_docs").over(inside) + F.col("docs_after")
    tokens_from = F.sum("tokens").over(inside) + F.col("tokens_after")
    summed = sums.join(blocks, "block").select(
        "n_tokens", "n_docs", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"),
        "total_docs", "total_tokens",
    )
    below = F.col("total_docs") - F.col("docs_from")
    truncated = F.col("total_tokens") - F.col("tokens_from") + F.col("docs_from") * F.col("n_tokens")
    return summed.select(
        "*",
        truncated.alias("truncated_tokens"),
        (below + 1).alias("first_rank"),
        (below + F.col("n_docs")).alias("last_rank"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length that at least this share of documents keeps to."""
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    place = F.greatest(F.ceil(F.col("share") * F.col("total_docs")), F.lit(1))
    return sums.select("*", wanted).filter(place.between(F.col("first_rank"), F.col("last_rank"))).select(
        "share", "n_tokens"
    )


def truncated(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, tokens): tokens left when every document is cut after ``limit`` tokens."""
    wanted = F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("limit")
    least = F.min_by(
        F.struct("docs_from", "tokens_from"), F.when(F.col("n_tokens") >= F.col("limit"), F.col("n_tokens"))
    )
    totals = sums.select("*", wanted).groupBy("limit").agg(
        least.alias("at"), F.max("total_tokens").alias("total")
    )
    over = F.col("total") - F.col("at.tokens_from") + F.col("at.docs_from") * F.col("limit")
    return totals.select("limit", F.coalesce(over, F.col("total")).alias("tokens"))
