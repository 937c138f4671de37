import random
from collections import Counter, defaultdict

import pytest

from tidewatch.llm import mixing

from .helpers import ODD_TEXTS, documents, table_rows


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by handing out the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        mass = sum(weight[s] for s in free)
        over = [s for s in free if weight[s] / mass * left > most * sizes[s]]
        if not over:
            return {**full, **{s: weight[s] / mass * left for s in free}}
        for s in over:
            full[s] = most * sizes[s]
        left = share * sum(sizes.values()) - sum(full.values())


def check(rows, given, weights=(3, 1, 2)):
    """Contract of the allotted rows; returns the words each source gives."""
    count = lambda t: len((t or "").encode().split())
    sizes, longest, taken = Counter(), Counter(), Counter()
    for _, text, source in given:
        sizes[source] += count(text)
        longest[source] = max(longest[source], count(text))
    want = plain_targets(sizes, weights)
    assert len(rows) == len(given)
    for r in rows:
        assert r.size == count(r.text) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6, s
    return taken


def test_targets_of_the_table(spark, sf_dir):
    given = [(r["doc_id"], r["text"], r["source"]) for r in table_rows(sf_dir, "documents")]
    check(mixing.allot(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect(), given)


@pytest.mark.parametrize("buckets", [1, 16, 1 << 14])
@pytest.mark.parametrize("seed", [1, 2])
def test_hot_sources_and_any_bucket_count(spark, monkeypatch, buckets, seed):
    monkeypatch.setattr(mixing, "BUCKETS", buckets)
    dice = random.Random(seed)
    names = ["hot"] * 6 + ["b", "ä", "", None, "zz"]
    rows = [(i, "w " * int(dice.paretovariate(1) * 3), None, dice.choice(names)) for i in range(600)]
    got = mixing.allot(documents(spark, rows)).collect()
    check(got, [(r[0], r[1], r[3]) for r in rows])


def test_reruns_agree_and_seeds_differ(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = sorted(mixing.allot(docs).select("doc_id", "taken").collect())
    assert first == sorted(mixing.allot(docs.repartition(5)).select("doc_id", "taken").collect())
    assert first != sorted(mixing.allot(docs, seed=8).select("doc_id", "taken").collect())


def test_inclusion_grows_with_the_square_root_of_the_size(spark):
    rows = [(i, "w " * (100 if i % 2 else 25), None, "s") for i in range(4000)] + [
        (10_000 + i, "w " * 50, None, "t") for i in range(4000)
    ]
    mean = defaultdict(list)
    for r in mixing.allot(documents(spark, rows), weights=(1, 9)).collect():
        mean[r.source, r.size].append(r.copies)
    share = {k: sum(v) / len(v) for k, v in mean.items()}
    assert share["s", 100] / share["s", 25] == pytest.approx(2, rel=0.12)
    assert share["t", 50] == 2


def test_mix_repeats_documents(spark):
    rows = [(i, f"text number {i} " * (i % 7 + 1), "en", f"s{i % 3}", i) for i in range(90)]
    docs = documents(spark, rows).selectExpr("*", "1 AS size", "2 AS target", "3 AS _lot", "4 AS copies")
    out = mixing.mix(docs)
    assert out.dtypes == docs.dtypes
    copies = {r.doc_id: r.copies for r in mixing.allot(documents(spark, rows)).collect()}
    assert Counter(r.doc_id for r in out.collect()) == Counter({i: c for i, c in copies.items() if c})


def test_odd_rows(spark):
    rows = [(i, t, None, "abc"[i % 3]) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "a b c", None, None), (None, "a b c", None, None), (None, None, None, None)]
    docs = documents(spark, rows).selectExpr("*", "1 AS rank", "2 AS Taken", "3 AS _source", "4 AS last", "5 AS factor")
    got = mixing.allot(docs).collect()
    assert len(got) == len(rows)
    twins = [r.copies for r in got if r.source is None and r.text]
    assert twins[0] == twins[1]
    assert mixing.allot(documents(spark, [])).collect() == []
    empty = mixing.allot(documents(spark, [(1, None, None, "s"), (2, "", None, "t")])).collect()
    assert [(r.taken, r.target) for r in empty] == [(0, 0.0)] * 2


def test_a_source_of_many_sizes_takes_linear_time(spark):
    """The factors of 100,000 different sizes in one source, a row for each size."""
    import time

    histogram = spark.range(1, 100_001).selectExpr("'hot' AS source", "id AS size", "1L AS n").union(
        spark.sql("SELECT null, 10L, 5L"))
    sizes = histogram.groupBy("source").agg({"size": "sum"}).toDF("source", "source_size")
    goals = mixing.targets(sizes)
    start = time.perf_counter()
    found = {r.source: r for r in mixing._factors(histogram, goals, 2).collect()}
    assert time.perf_counter() - start < 30
    target = 2 * sum(range(1, 100_001))
    assert found["hot"].target <= target and set(found) == {"hot", None}
    pull = [int(1024 * size**0.5) for size in range(1, 100_001)]
    factor = found["hot"].factor
    drawn = sum(min(2, factor * p) * size for size, p in enumerate(pull, 1))
    assert drawn == pytest.approx(found["hot"].target, rel=1e-9)


@pytest.mark.parametrize("block", [1, 3, 1 << 20])
def test_blocks_of_sizes_change_nothing(spark, monkeypatch, block):
    dice = random.Random(3)
    rows = [(i, "w " * dice.randint(0, 400), None, dice.choice("aab")) for i in range(300)]
    docs = documents(spark, rows)
    want = sorted(mixing.allot(docs).select("doc_id", "taken").collect())
    monkeypatch.setattr(mixing, "BLOCK", block)
    assert sorted(mixing.allot(docs).select("doc_id", "taken").collect()) == want
