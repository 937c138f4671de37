import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import topk

from .helpers import table_rows


def plain(rows, is_query, k, scale=64):
    known = []
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = tuple(math.floor(scale * float(np.float32(x))) for x in vector)
        if (vec_id, whole) not in known:
            known.append((vec_id, whole))
    out = {}
    for q, v in known:
        if is_query(q):
            scored = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in known if i != q]
            out.setdefault(q, []).extend(scored)
    return {(q, n + 1, i, -s) for q, found in out.items() for n, (s, i) in enumerate(sorted(found)[:k])}


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_against_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in table_rows(sf_dir, "embeddings")]
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = topk.top_k(vectors, F.col("vec_id") % 20 == 0).collect()
    assert len(got) == len({(r.query_id, r.rank) for r in got})
    assert set(map(tuple, got)) == plain(rows, lambda i: i % 20 == 0, 20)


@pytest.mark.parametrize("candidates,queries", [(3, 2), (7, 100), (1000, 1)])
def test_tiles_do_not_matter(spark, monkeypatch, candidates, queries):
    monkeypatch.setattr(topk, "CANDIDATES", candidates)
    monkeypatch.setattr(topk, "QUERIES", queries)
    dice = random.Random(2)
    # Few values: many ties; zeros: sparse rows.
    rows = [(i, [dice.choice([0.0, 0.0, 0.5, -0.25]) for _ in range(6)]) for i in range(40)]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 3 == 0, k=5).collect()
    assert set(map(tuple, got)) == plain(rows, lambda i: i % 3 == 0, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]),
        (5, [inf, 1.0]), (6, []), (7, [0.0, -1.0]), (None, [9.0, 9.0]), (8, [3.0]), (9, [1.0, 2.0]),
    ]
    docs = frame(spark, rows).selectExpr("*", "1 AS score", "2 AS asks", "3 AS vector", "4 AS block")
    got = topk.top_k(docs, F.col("vec_id") % 2 == 0, k=20).collect()
    assert {(r.query_id, r.vec_id) for r in got if r.query_id == 0} == {(0, i) for i in (1, 6, 7, 8, 9)}
    first = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == 0)
    # 64 * (1, 2) times itself, ties to the smaller id; the short vector shares one dimension.
    assert first[:3] == [(1, 1, 64 * 64 * 5), (2, 9, 64 * 64 * 5), (3, 8, 64 * 64 * 3)]
    assert {r.query_id for r in got} == {0, 6, 8}


def test_large_weights_keep_their_sums(spark):
    rows = [(0, [500.0, -500.0]), (1, [500.0, 1.0]), (2, [2.0**25, 2.0**25]), (3, [0.5, 0.25])]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") == 0, k=3).collect()
    assert set(map(tuple, got)) == plain(rows, lambda i: i == 0, 3)


def test_no_rows_and_no_queries(spark):
    assert topk.top_k(frame(spark, []), F.lit(True)).collect() == []
    assert topk.top_k(frame(spark, [(1, [1.0])]), F.col("vec_id") == 2).collect() == []
    assert topk.top_k(frame(spark, [(1, [1.0])]), F.lit(True)).collect() == []
