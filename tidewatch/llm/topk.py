"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are quantised to integers and taken as sparse rows of (term, weight), a term being a
dimension. The candidates are cut into blocks, each an inverted index from term to the block's
rows that have it. A query scatters its weights term by term into a dense array with one score
for each row of the block; of every block the best k are picked by partition selection, and a
last step merges the blocks' picks. Nothing is pruned, so the result is exact.

Queries and candidates both grow with the table and their product is the work. It is dealt out
as tiles of one block of queries by one block of candidates, of bounded size; a tile's output is
k rows for each of its queries.
"""


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Rows of a block of queries, and of candidates.
QUERIES, CANDIDATES = 512, 4096


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as double; null if the vector is unusable."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(usable, whole)


def _score_type(queries: np.ndarray, rows: np.ndarray) -> type:
    """The narrowest integer that no sum of products can leave."""

    def norm(x: np.ndarray) -> float:
        return float(np.sqrt((x.astype(float) ** 2).sum(axis=1).max(initial=0)))

    most = norm(queries) * norm(rows) * 1.0001 + 1
    return next((t for t in (np.int16, np.int32) if most < np.iinfo(t).max), np.int64)


def postings(rows: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """For each term, the rows that have it (all of them, as a slice) and their weights."""
    found = []
    for term in range(rows.shape[1]):
        weight = np.ascontiguousarray(rows[:, term])
        at = np.flatnonzero(weight)
        found.append((slice(None), weight) if 8 * len(at) > 7 * len(weight) else (at, weight[at]))
    return found


def scores(query: np.ndarray, index, out: np.ndarray) -> np.ndarray:
    """Scatter one sparse query into the dense score array."""
    out[:] = 0
    for term in np.flatnonzero(query).tolist():
        at, weight = index[term]
        out[at] += query[term] * weight
    return out


def _select(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id, in no order."""
    if len(score) <= k:
        return np.arange(len(score))
    least = np.partition(score, len(score) - k)[len(score) - k]
    above = np.flatnonzero(score > least)
    equal = np.flatnonzero(score == least)
    need = k - len(above)
    if len(equal) > need:
        equal = equal[np.argpartition(ids[equal], need - 1)[:need]]
    return np.concatenate((above, equal))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()) if len(column) else np.zeros((0, 0), np.int64)


def _tile(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        # Vectors of different lengths share the terms both have.
        for _, some in queries.groupby(queries["vector"].map(len)):
            asked = _matrix(some["vector"])
            parts = [(_matrix(r["vector"]), r["vec_id"].to_numpy()) for _, r in rows.groupby(rows["vector"].map(len))]
            for matrix, ids in parts:
                terms = min(asked.shape[1], matrix.shape[1])
                kind = _score_type(asked, matrix)
                index = postings(matrix[:, :terms].astype(kind))
                score = np.zeros(len(ids), kind)
                for query_id, query in zip(some["vec_id"].to_numpy(), asked[:, :terms].astype(kind)):
                    scores(query, index, score)
                    own = np.flatnonzero(ids == query_id)
                    best = _select(score, ids, k + len(own))
                    best = best[ids[best] != query_id]
                    out.append(pd.DataFrame(
                        {"query_id": query_id, "vec_id": ids[best], "score": score[best].astype(np.int64)}
                    ))
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        return pd.concat([empty, *out], ignore_index=True)

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    scale: int = 64,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other vectors, fewer if there are fewer.

    Scores are integer inner products of the quantised vectors, ties go to the smaller id.
    Vectors that are null, or hold null or non-finite components, take no part, nor do rows
    without a key. Rows that repeat key and vector count once; different vectors of one key are
    separate candidates, none of them a candidate of its own key's queries, and their queries
    rank together. Vectors of different lengths are compared over the dimensions both have; an
    empty vector scores 0. Products beyond 64 bits wrap around.
    """
    spark = vectors.sparkSession
    given = vectors.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"),
        quantised(F.col(f"`{vector}`"), scale).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).dropna(subset=["vec_id", "vector"])
    known = cut(given.dropDuplicates(["vec_id", "vector"]))
    sizes = known.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    blocks = max(1, -(-sizes.n // CANDIDATES))
    groups = max(1, -(-sizes.q // QUERIES))

    # A tile is a block of candidates and a block of queries; each row goes to all its tiles.
    spread = F.xxhash64("vec_id")
    block = F.pmod(spread, F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(groups)).cast("int")
    rows = known.select(
        "vec_id", "vector", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    )
    queries = known.filter("asks").select(
        "vec_id", "vector", group.alias("group"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    picked = (
        queries.groupBy("group", "block")
        .cogroup(rows.groupBy("group", "block"))
        .applyInPandas(_tile(k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = picked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


