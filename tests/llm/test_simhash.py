import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tidewatch.llm import simhash
from tidewatch.llm.components import components

from .helpers import ODD_TEXTS, documents, table_rows


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    grams = [words[i : i + width] for i in range(len(words) - width + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, distance):
    """Position to the least position reachable, by comparing all pairs."""
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints(spark, sf_dir):
    texts = [r["text"] for r in table_rows(sf_dir, "documents")][:60] + [t for t in ODD_TEXTS if len(t or "") < 9000]
    for text in texts:
        assert simhash.fingerprint(text and text.encode()) == plain_fingerprint(text)


def test_long_texts_are_counted_in_slices(monkeypatch):
    text = " ".join(str(i * i) for i in range(500)).encode()
    want = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_SLICE", 7)
    assert simhash.fingerprint(text) == want == plain_fingerprint(text.decode())


def test_gray_rank():
    rank = simhash.gray_rank(np.arange(64, dtype=np.uint64))
    ordered = np.argsort(rank)
    assert all(int(a ^ b).bit_count() == 1 for a, b in zip(ordered, ordered[1:]))


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_partners_meet_under_some_choice(distance):
    masks = simhash.block_masks(distance)
    dice = random.Random(1)
    for _ in range(300):
        flips = sum(1 << b for b in dice.sample(range(64), distance))
        assert any(flips & m == 0 for m in masks)


def crowd(seed, n, centres, spread):
    """Fingerprints around a few centres, some of them far away."""
    dice = random.Random(seed)
    middle = [dice.getrandbits(64) for _ in range(centres)]
    found = set()
    while len(found) < n:
        x = dice.choice(middle)
        for _ in range(dice.randint(0, spread)):
            x ^= 1 << dice.randrange(64)
        found.add(x)
    return sorted(found)


@pytest.mark.parametrize("seed,n,centres,spread", [(1, 300, 1, 3), (2, 400, 4, 7), (3, 250, 250, 1), (4, 60, 1, 2)])
def test_index_finds_every_link_of_a_group(seed, n, centres, spread):
    prints = np.array(crowd(seed, n, centres, spread), np.uint64)
    group = np.zeros(n, np.int64)
    a, b = simhash.link_groups(prints, group, np.zeros(n, np.uint64), 2)
    place = {int(p): i for i, p in enumerate(prints)}
    forest = simhash.Forest(n)
    forest.union(np.array([place[int(x)] for x in a], int), np.array([place[int(x)] for x in b], int))
    assert len(a) < n  # a forest, not all pairs
    assert forest.label.tolist() == classes([int(p) for p in prints], 2)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_of_a_table(spark, distance):
    prints = crowd(9, 500, 20, 6)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = components(simhash.link(df, distance=distance)).collect()
    got = defaultdict(set)
    for r in found:
        got[r.root].add(r.node)
    want = defaultdict(set)
    for p, c in zip(prints, classes(prints, distance)):
        want[c].add(signed(p))
    assert sorted(map(sorted, got.values())) == sorted(sorted(s) for s in want.values() if len(s) > 1)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    rows = components(spark.createDataFrame([*edges, *edges], "u long, v long")).collect()
    got = {r.node: r.root for r in rows}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}} and len(rows) == len(got)
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_query_against_brute_force(spark, sf_dir):
    from tidewatch.llm.queries import QUERIES

    docs = sorted((r["doc_id"], r["text"]) for r in table_rows(sf_dir, "documents"))
    prints = [plain_fingerprint(t) for _, t in docs]
    label = classes(prints, 2)
    want = {d: (f"{p:016x}", docs[c][0]) for (d, _), p, c in zip(docs, prints, label)}
    rows = QUERIES["op8_simhash"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want and len(rows) == len(docs)


LONG = " ".join(f"word{i}" for i in range(200))


def test_odd_rows(spark):
    rows = [
        (5, None), (3, ""), (9, " \n"), (None, LONG), (8, LONG), (8, LONG), (7, LONG.upper()),
        (None, "nobody knows my key"), (1, "other words entirely here"),
    ]
    docs = documents(spark, rows).selectExpr("*", "1 AS fp", "2 AS fingerprint", "3 AS component_id")
    got = sorted(simhash.near_duplicates(docs).collect(), key=str)
    assert len(got) == len(rows)
    by_id = {r.doc_id: r.component_id for r in got}
    assert [by_id[i] for i in (5, 3, 9, 8, 7, 1)] == [3, 3, 3, 7, 7, 1]
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["7", "None"]
    assert {r.fingerprint for r in got if r.doc_id in (3, 5, 9)} == {"0" * 16}
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def test_keep_first_keeps_one_of_each(spark):
    rows = [
        (5, None), (3, ""), (None, LONG), (8, LONG, "a"), (8, LONG, "b"), (7, LONG.upper()),
        (None, "nobody knows my key"), (None, "nobody knows my key"), (1, "other words entirely here"),
    ]
    docs = documents(spark, rows).selectExpr("*", "1 AS _doc", "2 AS FP")
    out = simhash.keep_first(docs)
    assert out.dtypes == docs.dtypes
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert kept == sorted([(3, ""), (7, LONG.upper()), (None, "nobody knows my key"), (1, rows[-1][1])], key=str)
    twice = simhash.keep_first(documents(spark, [(4, LONG, "a"), (4, LONG, "b"), (6, LONG)])).collect()
    assert [r.doc_id for r in twice] == [4]
    assert simhash.keep_first(documents(spark, [])).collect() == []
