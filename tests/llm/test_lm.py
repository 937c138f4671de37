import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import lm

from .helpers import ODD_TEXTS, documents, table_rows


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def plain(rows):
    """Contract columns of (doc_id, text) rows, without the model's score."""
    counts = Counter(w for i, t in rows if not fold(i) for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        words = tokens(t)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        out.append((i, len(words), sum(counts[w] > 0 for w in words), total, base))
    return out


def compare(got, want):
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9)


def scored(docs, **parameters):
    return lm.score(docs, lm.held_out(F.col("doc_id"), 5, 1), **parameters)


@pytest.mark.parametrize("common", [200_000, 50, 0])
def test_base_scores(spark, sf_dir, common):
    rows = [(r["doc_id"], r["text"]) for r in table_rows(sf_dir, "documents")]
    got = scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), common=common).collect()
    compare(got, plain(rows))


def test_scores_do_not_depend_on_the_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    one = {r.doc_id: r.score for r in scored(docs).collect()}
    other = {r.doc_id: r.score for r in scored(docs.repartition(7)).collect()}
    assert one.keys() == other.keys()
    for i, s in one.items():
        assert s == pytest.approx(other[i], rel=1e-9) and s < 0


def language(seed, n):
    """Texts whose next word follows from the last two."""
    dice, rows = random.Random(seed), []
    for i in range(n):
        words = ["a"]
        for _ in range(60):
            follows = {"ab": "c", "bc": "a", "ca": "d"}.get("".join(words[-2:]))
            words.append(follows if follows and dice.random() < 0.9 else dice.choice("abcd"))
        rows.append((i, " ".join(words)))
    return rows


def test_contexts_help_on_held_out_texts(spark):
    docs = documents(spark, language(1, 400))
    by_depth = {}
    for depth in (0, 1, 2):
        held = [r for r in scored(docs, depth=depth).collect() if fold(r.doc_id)]
        by_depth[depth] = sum(r.score for r in held)
        if not depth:
            assert all(r.score == r.base_score for r in held)
    assert by_depth[2] > by_depth[1] + 50 > by_depth[0] + 100


def tree_of(texts, depth=2, least=1e-6):
    """The tree as _grow builds it, from plain counts."""
    import numpy as np

    split = [tokens(t)[:-1] for t in texts]
    counts = Counter(w for t in texts for w in tokens(t))
    mass = sum(counts.values()) + 0.5 * (len(counts) + 1)
    # One word stays outside the symbols.
    symbols = sorted(counts, key=lambda w: -counts[w])[:-1]
    base = np.array([(counts[w] + 0.5) / mass for w in symbols])
    tree = lm.Tree({w: i for i, w in enumerate(symbols, 1)}, np.concatenate(([1 - base.sum()], base, [1.0])))
    contexts = [(s,) for s in range(1, tree.size) if s != tree.ids.get(lm.END)]
    for _ in range(depth):
        tree.add(contexts)
        symbols_, _ = tree.flat(split)
        *_, context = tree.contexts(symbols_)
        at = np.flatnonzero(context >= 0)
        codes, n = np.unique(context[at] * tree.size + symbols_[at], return_counts=True)
        totals = np.bincount(context[at], minlength=len(tree.levels[-1].contexts)).astype(float)
        tree.learn(codes[n >= 2], n[n >= 2].astype(float), totals)
        known = set(tree.levels[-1].contexts)
        grown = [known_ + (s,) for known_ in known for s in range(1, tree.size - 1)]
        contexts = [g for g in grown if g[1:] in known]
    return tree


def test_next_symbol_distributions_sum_to_one():
    import numpy as np

    texts = [t for _, t in language(2, 80)]
    tree = tree_of(texts)
    retained = defaultdict(int)
    for words in (["a"], ["a", "b"], ["b", "c"], ["c", "a"], ["d", "d", "a", "b"], []):
        head = [tree.begin, *[tree.ids.get(w.encode(), 0) for w in words]]
        total = 0.0
        for symbol in range(tree.size - 1):
            gain = tree.gains(np.array([*head, symbol]))[-1]
            total += tree.base[symbol] * 10**gain
        assert total == pytest.approx(1, abs=1e-6), words
        retained[len(words)] += 1
    assert any(len(level.codes) for level in tree.levels)


def test_divergence_test_drops_contexts_that_tell_nothing():
    dice = random.Random(3)
    noise = tree_of([" ".join(dice.choices("abcdefgh", k=50)) for _ in range(200)])
    told = tree_of([t for _, t in language(4, 200)])
    kept = [sum(len(level.codes) > 0 for level in t.levels) for t in (noise, told)]
    assert len(noise.levels[1].codes) < len(told.levels[1].codes) and kept[1] == 2


def test_odd_rows(spark):
    rows = [*enumerate(ODD_TEXTS), (None, "a b c"), (None, "a b c"), (None, None), (3, "A B"), (3, "A B")]
    docs = documents(spark, rows).selectExpr("*", "1 AS word", "2 AS score", "3 AS N_known", "4 AS key")
    compare(scored(docs).collect(), plain(rows))
    assert scored(documents(spark, [])).collect() == []


def test_no_training_rows(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    for r in lm.score(docs, F.lit(True)).collect():
        assert r.n_known == 0 and r.train_tokens == 0 and r.score == r.base_score == 0


def plain_scores(rows, depth, least=10, entry=2):
    """The model's scores by dictionaries of word tuples."""
    train = [tokens(t) for i, t in rows if not fold(i)]
    counts = Counter(w for words in train for w in words)
    mass = sum(counts.values()) + 0.5 * (len(counts) + 1)
    rest, stored = {}, {}
    padded = [["<", *words] for words in train]

    def chance(context, word):
        if not context:
            return (counts[word] + 0.5) / mass
        if context in rest and word in stored[context]:
            return stored[context][word]
        return rest.get(context, 1) * chance(context[1:], word)

    for d in range(1, depth + 1):
        follows = defaultdict(Counter)
        for words in padded:
            for i in range(d, len(words)):
                follows[tuple(words[i - d : i])][words[i]] += 1
        level = {}
        for context, after in follows.items():
            total, listed = sum(after.values()), {w: n for w, n in after.items() if n >= entry}
            if total < least or not listed:
                continue
            prior = {w: chance(context[1:], w) for w in listed}
            kinds, expected = len(listed) + 1, min(sum(prior.values()), 1 - 1e-9)
            test = sum(n * math.log(n / total / prior[w]) for w, n in listed.items())
            others = 1 - sum(listed.values()) / total
            if others > 1e-12:
                test += total * others * math.log(others / (1 - expected))
            if 2 * test > kinds + 4 * math.sqrt(2 * kinds):
                smooth = {w: (n + kinds * prior[w]) / (total + kinds) for w, n in listed.items()}
                level[context] = smooth, max(1 - sum(smooth.values()), 1e-12) / (1 - expected)
        for context, (smooth, left) in level.items():
            stored[context], rest[context] = smooth, left
    out = []
    for i, t in rows:
        words = ["<", *tokens(t)]
        steps = ((tuple(words[max(0, k - depth) : k]), words[k]) for k in range(1, len(words)))
        out.append((i, sum(math.log10(chance(c, w)) for c, w in steps)))
    return out


@pytest.mark.parametrize("cached", [0, 60, 1_000_000])
def test_tables_equal_dictionaries(spark, sf_dir, cached):
    rows = language(5, 150) + [
        (1000 + r["doc_id"], r["text"]) for r in table_rows(sf_dir, "documents")[:60]
    ]
    got = {r.doc_id: r.score for r in scored(documents(spark, rows), depth=2, cached=cached).collect()}
    for i, want in plain_scores(rows, 2):
        assert got[i] == pytest.approx(want, rel=1e-9), i


def test_the_bars_do_not_rise_with_the_corpus(spark):
    dice = random.Random(6)
    noise = [(i, " ".join(str(dice.randrange(3000)) for _ in range(500))) for i in range(900)]
    passage = [(i, "one rare passage") for i in range(1000, 1020)]
    by_id = {r.doc_id: r for r in scored(documents(spark, noise + passage)).collect()}
    held = next(i for i, _ in passage if fold(i))
    assert by_id[held].train_tokens > 300_000
    assert by_id[held].score > by_id[held].base_score + 5


@pytest.mark.parametrize("group", [64 << 20, 8 * 67 * 40])
def test_levels_grow_until_nothing_is_open(spark, group):
    dice, rows = random.Random(7), []
    for i in range(600):
        words = []
        for _ in range(12):
            first = dice.choice("xy")
            shared = "a b c" if dice.random() < 0.8 else dice.choice(["a b d", "e b c", "e f c"])
            words += [first, *shared.split(), first.upper() + "1" if shared == "a b c" else "z"]
        rows.append((i, " ".join(words)))
    docs = documents(spark, rows)
    got = {r.doc_id: r.score for r in scored(docs, group=group).collect()}
    for i, want in plain_scores(rows, 62):
        assert got[i] == pytest.approx(want, rel=1e-9), i
    short = {r.doc_id: r.score for r in scored(docs, depth=3).collect()}
    held = [i for i, _ in rows if fold(i)]
    assert sum(got[i] for i in held) > sum(short[i] for i in held) + 50


def test_a_length_that_retains_nothing_does_not_end_the_tree(spark):
    """The next word depends on the word four before it, those between are the same for all."""
    dice, rows = random.Random(8), []
    for i in range(500):
        words = []
        for _ in range(10):
            first = dice.choice(["x", "y"])
            words += [first, "m", "m", "m", first.upper()]
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.score for r in scored(documents(spark, rows)).collect()}
    for i, want in plain_scores(rows, 51):
        assert got[i] == pytest.approx(want, rel=1e-9), i


def test_near_copies_grow_far(spark):
    """Long texts with few changed words keep contexts open over many lengths."""
    dice = random.Random(9)
    text = [f"w{dice.randrange(40)}" for _ in range(150)]
    rows = []
    for i in range(120):
        rows.append((i, " ".join(w if dice.random() > 0.02 else f"c{dice.randrange(5)}" for w in text)))
    got = {r.doc_id: r.score for r in scored(documents(spark, rows), least=5, depth=None).collect()}
    for i, want in plain_scores(rows, 151, least=5):
        assert got[i] == pytest.approx(want, rel=1e-9), i


def test_hashes_of_places_are_those_of_their_words():
    import numpy as np
    import pyarrow as pa

    from tidewatch.llm import suffix_tree

    bodies = pa.array([b"x a b c", b"b a", b"a b c a"], pa.binary())
    kinds, codes, starts = suffix_tree.numbered(bodies)
    one = suffix_tree.Places(suffix_tree.hashes_of(kinds)[codes], starts)
    assert starts.tolist() == [0, 6, 10] and len(codes) == 16
    by_words = defaultdict(set)
    for end in range(len(one.words)):
        for length in range(1, one.before[end] + 2):
            words = tuple(one.words[end - length + 1 : end + 1].tolist())
            by_words[words].add(int(one.hashes(np.array([end]), length)[0]))
    assert all(len(h) == 1 for h in by_words.values())
    assert len({h for found in by_words.values() for h in found}) == len(by_words)


def test_words_and_their_hashes():
    import pyarrow as pa

    from tidewatch.llm import suffix_tree

    every = bytes(range(256))
    texts = [b" A\x0bb\x0c C ", b"", b"  \t", None, every, "\u00c0 \u2003y Z".encode(), b"x" * 5000 + b" x"]
    kinds, codes, starts = suffix_tree.spelled(pa.array(texts, pa.binary()))
    for i, text in enumerate(texts):
        end = starts[i + 1] if i + 1 < len(starts) else len(codes)
        got = [kinds[c].as_py() for c in codes[starts[i] : end].tolist()]
        assert got == (text or b"").lower().split()
    # Of every length, with and without zeros at the end, wherever they stand in an array.
    words = [b"", *[b"a" * n + tail for n in range(1, 120) for tail in (b"", b"\0", b"b")]]
    hashes = suffix_tree.word_hashes(pa.array(words, pa.binary()))
    assert len(set(hashes.tolist())) == len(set(words)) == len(words)
    for start in (0, 1, 57, 300):
        part = suffix_tree.word_hashes(pa.array(words, pa.binary()).slice(start, 9))
        assert part.tolist() == hashes[start : start + 9].tolist()
    assert not len(suffix_tree.word_hashes(pa.array([], pa.binary())))


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_values_of_hashes(n):
    import numpy as np

    from tidewatch.llm import suffix_tree

    dice = np.random.default_rng(n)
    hashes = np.unique(dice.integers(0, 2**64, n, np.uint64))
    hashes[-1:] = 2**64 - 1  # also the last one there is
    values = suffix_tree.Values(dice.permutation(hashes), np.arange(float(len(hashes))))
    asked = np.concatenate((hashes, hashes + np.uint64(1), dice.integers(0, 2**64, 50, np.uint64)))
    at, hit = values.places(asked)
    assert hit.tolist() == np.isin(asked, hashes).tolist() and len(values) == len(hashes)
    assert values.hashes[at[hit]].tolist() == asked[hit].tolist()


def test_tables_go_once_nothing_reads_them(spark, monkeypatch):
    import os

    from tidewatch.llm import suffix_tree

    made, folders, most = suffix_tree.stored, {}, []

    def there():
        return [purpose for folder, purpose in folders.items() if os.path.exists(folder)]

    def stored(df, purpose, used=None):
        one = made(df, purpose, used)
        folders[one.inputFiles()[0].removeprefix("file:").replace("///", "/").rsplit("/", 1)[0]] = purpose
        most.append(there())
        return one

    monkeypatch.setattr(suffix_tree, "stored", stored)
    monkeypatch.setattr(lm, "stored", stored)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    got = scored(documents(spark, language(10, 60)))
    assert sorted(there()) == ["model", "token-counts"] and spark.conf.get(name) == before
    assert all(found.count("encoded") <= 2 for found in most) and len(most) > 12
    assert all(len({"transitions", "encoded"} & set(found)) < 2 or found.count("transitions") == 1 for found in most)
    assert got.count() == 60


def test_values_come_to_the_driver_in_parts(spark, monkeypatch):
    import pickle

    import numpy as np
    from pyspark.sql.classic.dataframe import DataFrame

    from tidewatch.llm import suffix_tree

    rows, to_arrow, most = documents(spark, language(17, 150)), DataFrame.toArrow, []

    def arrived(df):
        found = to_arrow(df)
        if "v" in df.columns:
            most.append(sum(len(v) // 8 if isinstance(v, bytes) else 1 for v in found["v"].to_pylist()))
        return found

    made, near = suffix_tree.Values.ordered, []
    monkeypatch.setattr(DataFrame, "toArrow", arrived)
    monkeypatch.setattr(
        suffix_tree.Values, "ordered", lambda *arrays: (near.append(made(*arrays)), near[-1])[1]
    )
    scored(rows, least=4).count()
    # About a quarter at a time, by the first two bits.
    assert len(near) == len(most) == 4 and sum(most) > 100 and max(most) < 0.4 * sum(most)
    assert [len(part) for part in near] == most
    for i, part in enumerate(near):
        again = pickle.loads(pickle.dumps(part))
        assert (np.diff(part.hashes.astype(object)) > 0).all() and (part.hashes[:-1] >> np.uint64(62) == i).all()
        asked = np.concatenate([part.hashes[:-1], part.hashes[:-1] + np.uint64(1)])
        values, hit = suffix_tree.looked_up(near[:i] + [again, None], asked)
        assert hit.tolist() == np.isin(asked, part.hashes[:-1]).tolist()
        assert values[: len(part)].tolist() == part.values[:-1].tolist() and not values[~hit].any()


def test_only_sequences_that_may_be_joined_are_sent(spark):
    import numpy as np
    import pyarrow as pa

    from tidewatch.llm import suffix_tree

    dice = np.random.default_rng(5)
    hashes = np.unique(dice.integers(0, 2**64, 200_000, np.uint64))
    known, other = hashes[::2], hashes[1::2]
    frame = spark.createDataFrame(pa.table({"h": known.view(np.int64)}))
    bits = suffix_tree.sieve(frame)
    assert suffix_tree.passed(bits, known).all()
    assert suffix_tree.passed(bits, other).mean() < 0.001
    assert not suffix_tree.passed(suffix_tree.sieve(frame.limit(0)), hashes).any()

    kinds, codes, starts = suffix_tree.numbered(pa.array([b"a b c a b", b"b c"], pa.binary()))
    block = suffix_tree.Places(suffix_tree.hashes_of(kinds)[codes], starts)
    near, full = [], np.full(1 << 20, ~np.uint64(0))
    pair = block.hashes(np.array([2]), 2)  # a b, twice in the first text
    beyond = suffix_tree.sieve(spark.createDataFrame(pa.table({"h": pair.view(np.int64)})))
    gains, sent = lm._gains(block, near, full, full, beyond, 3)
    assert [x.tolist() for x in sent] == [[0], pair.tolist(), [2]] and not gains.any()
    # With nothing to join, as all values are near, nothing is sent.
    beyond = suffix_tree.sieve(frame.limit(0))
    assert not any(len(x) for x in lm._gains(block, near, full, full, beyond, 3)[1])


def shuffled_rows(plan):
    """Rows that the exchanges of a plan that ran have written."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return shuffled_rows(plan.executedPlan())
    if "QueryStage" in name:
        return shuffled_rows(plan.plan())
    found = plan.metrics().get("shuffleRecordsWritten")
    children = plan.children()
    below = sum(shuffled_rows(children.apply(i)) for i in range(children.size()))
    return below + (found.get().value() if found.isDefined() else 0)


def test_words_and_sequences_move_in_parts(spark):
    """Not a row for each: time and rows of the lookups went up with what memory does not hold."""
    dice = random.Random(18)
    rows = [(i, " ".join(str(dice.randrange(400)) for _ in range(300))) for i in range(200)]
    got = scored(documents(spark, rows).coalesce(2), cached=0, common=0, least=2)
    by_id = {r.doc_id: r for r in got.collect()}
    assert 0 < shuffled_rows(got._jdf.queryExecution().executedPlan()) < 1000
    for i, want in plain_scores(rows, 64, least=2):
        assert by_id[i].score == pytest.approx(want, rel=1e-9), i
    compare([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in by_id.values()], plain(rows))
    parts = lm.token_parts(documents(spark, rows))
    assert parts.count() <= lm._TOKEN_SPOTS
    want = Counter(w for _, t in rows for w in tokens(t))
    assert {bytes(r.word): r.c for r in lm.token_counts(documents(spark, rows)).collect()} == want


def test_bitmaps_grow_with_what_they_hold(spark):
    """Of a fixed size they were full at some GB, and every place was asked for at every length."""
    import numpy as np
    import pyarrow as pa

    from tidewatch.llm import suffix_tree

    dice = np.random.default_rng(19)
    hashes = np.unique(dice.integers(0, 2**64, 200_000, np.uint64))
    known, other = hashes[::2], hashes[1::2]
    frame = spark.createDataFrame(pa.table({"h": known.view(np.int64)}))
    one = spark.createDataFrame(pa.table({"h": [known[:7].tobytes(), known[7:].tobytes()]}))
    for size, least in ((None, 1 << 26), (100_000_000, 1 << 28)):
        for made, test in ((suffix_tree.bitmap, suffix_tree.may), (suffix_tree.sieve, suffix_tree.passed)):
            bits = made(frame, size)
            assert bits.nbytes * 8 >= least and (made(one, size) == bits).all()
            assert test(bits, known).all() and test(bits, other).mean() < 0.01
