import random

import numpy as np
import pytest

from tidewatch.llm import toxicity

from .helpers import ODD_TEXTS, documents

NICE = [f"w{i}" for i in range(400)]
BAD = {"en": ["grumble", "snarl"], "de": ["grollwort", "zankwort"]}


def corpus(n, seed):
    """Texts of harmless words; toxic ones hold a few bad ones, in German inflected."""
    dice = random.Random(seed)
    rows = []
    for i in range(n):
        lang = dice.choice(["en", "de"])
        words = dice.choices(NICE, k=dice.randint(5, 120))
        toxic = int(dice.random() < 0.25)
        for _ in range(3 * toxic):
            bad = dice.choice(BAD[lang]) + (dice.choice(["", "en", "ung", "heit"]) if lang == "de" else "")
            words.insert(dice.randint(0, len(words)), dice.choice([bad, bad.upper() + "!", bad + ","]))
        rows.append((i, " ".join(words), lang, toxic))
    return rows


def accuracy(net, rows):
    score = net.scores([r[1] for r in rows])
    return ((score >= 0.3) == np.array([r[3] for r in rows])).mean()


@pytest.fixture(scope="module")
def net():
    rows = corpus(1200, 1)
    target = np.array([float(r[3]) for r in rows])
    return toxicity.train([r[1] for r in rows], target, np.ones(len(rows)), [r[2] for r in rows])


def test_held_out_accuracy(net):
    assert accuracy(net, corpus(600, 2)) > 0.97


def test_scores_are_probabilities_and_do_not_depend_on_the_batch(net):
    texts = [r[1] for r in corpus(50, 3)] + ["", " ", "x" * 10_000]
    together = net.scores(texts)
    assert ((together >= 0) & (together <= 1)).all()
    alone = np.concatenate([net.scores([t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)
    assert len(net.scores([])) == 0


def test_whole_texts_count(net):
    clean = " ".join(random.Random(4).choices(NICE, k=20_000))
    assert net.scores([clean])[0] < 0.3 <= net.scores([clean + " grumble snarl grumble"])[0]


def test_memory_that_overflows(net, monkeypatch):
    texts = [r[1] for r in corpus(20, 5)]
    want = net.scores(texts)
    monkeypatch.setattr(toxicity, "_REMEMBERED", 3)
    assert np.allclose([net.scores([t])[0] for t in texts], want, atol=1e-5)


def test_calibration_brings_the_true_share_back():
    dice = np.random.default_rng(0)
    logit = dice.normal(0, 2, 4000)
    target = (dice.random(4000) < 1 / (1 + np.exp(-(1.5 * logit - 2)))).astype(float)
    scale, shift = toxicity._calibrate(logit, target, np.ones(4000))
    assert abs(scale - 1.5) < 0.2 and abs(shift + 2) < 0.25


def test_a_threshold_for_each_language():
    score, target = np.array([0.9, 0.8, 0.4, 0.2]), np.array([1.0, 1.0, 0.0, 0.0])
    assert 0.4 < toxicity._threshold(score, target, np.ones(4)) < 0.8


def test_fit_and_score(spark):
    rows = corpus(600, 6)
    docs = documents(spark, [r[:3] for r in rows]).repartition(3)
    labels = [(r[0], r[3]) for r in rows if r[0] % 3] + [(1, None), (None, 1), (10**9, 1)]
    fitted = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), positives=150, negatives=300)
    got = toxicity.score(docs.selectExpr("*", "1 AS Score", "2 AS flagged"), fitted).collect()
    held = [r for r in got if r.doc_id % 3 == 0]
    truth = {r[0]: r[3] for r in rows}
    assert np.mean([(r.score >= 0.3) == truth[r.doc_id] for r in held]) > 0.93
    other_lang = toxicity.score(docs.selectExpr("doc_id", "text", "'xx' AS lang"), fitted).collect()
    assert {r.doc_id: r.score for r in other_lang} == {r.doc_id: r.score for r in got}


def test_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = documents(spark, [*enumerate(ODD_TEXTS), (None, "x"), (None, "x")])
    net = toxicity.fit(docs, none)
    got = toxicity.score(docs, net).collect()
    assert len(got) == len(ODD_TEXTS) + 2 and all(0 <= r.score < 0.3 and not r.flagged for r in got)
    one_kind = toxicity.fit(docs, spark.createDataFrame([(4, 1), (5, 1)], "doc_id long, toxic int"))
    assert toxicity.score(docs, one_kind).count() == len(got)
    assert toxicity.score(documents(spark, []), net).collect() == []


def test_repeated_and_long_documents_leave_the_sample_whole(spark, monkeypatch):
    rows = [(i, t, lang) for i, t, lang, _ in corpus(60, 8)]
    given = [*rows, *[(7, f"copy {k}", "en") for k in range(300)]]
    given += [(1000 + i, "w1 " * 100, "en") for i in range(200)]
    labels = spark.createDataFrame(
        [(i, i % 2) for i in [*range(60), *range(1000, 1200)]], "doc_id long, toxic int"
    )
    seen, made = [], type(labels).toPandas
    monkeypatch.setattr(type(labels), "toPandas", lambda df: seen.append(made(df)) or seen[-1])
    taken = []
    monkeypatch.setattr(toxicity, "train", lambda texts, *_: taken.extend(texts))
    longest = max(len(t) for _, t, _ in rows)
    docs = documents(spark, [r for r in given if len(r[1]) <= longest] + [(i, "x" * (longest + 1), "en") for i in range(2000, 2100)])
    more = spark.createDataFrame([(i, i % 2) for i in range(2000, 2100)], "doc_id long, toxic int")
    toxicity.fit(docs, labels.union(more), positives=130, negatives=130, longest=longest)
    assert len(taken) == 260 and max(map(len, taken)) <= longest
    assert max(map(len, seen)) <= 260


def test_every_labelled_text_trains_wholly(spark):
    """All texts are long; no part of them is drawn."""
    dice, rows = random.Random(10), []
    for i in range(400):
        words = dice.choices(NICE, k=4500)
        for _ in range(5 * (i % 2)):
            words[dice.randrange(4500)] = "grumble"
        rows.append((i, " ".join(words), "en", i % 2))
    assert min(len(r[1]) for r in rows) > 20_000
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows if r[0] % 5], "doc_id long, toxic int")
    net = toxicity.fit(documents(spark, [r[:3] for r in rows]), labels)
    score = net.scores([r[1] for r in rows if r[0] % 5 == 0])
    assert score[1::2].min() > score[::2].max()


def test_blocks_hold_every_document_once(spark, monkeypatch):
    """With its share of the weight where rows repeat; averaged over small blocks the network still tells."""
    rows = corpus(300, 11)
    docs = documents(spark, [r[:3] for r in rows] + [rows[0][:3]] * 50 + [(None, "x", "en")])
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(0, None), (10**9, 1)], "doc_id long, toxic int")
    seen, made = [], toxicity._learned
    monkeypatch.setattr(toxicity, "_learned", lambda labelled: seen.append(labelled) or made(labelled, 120))
    net = toxicity.fit(docs, labels)
    assert np.allclose(sum(r.weight for r in seen[0].collect()), 300)
    sizes = [len(r.lang) for r in seen[0].mapInArrow(toxicity._encoded(120), toxicity._ENCODED).collect()]
    assert sum(sizes) == 350 and max(sizes) == 120
    assert accuracy(net, corpus(200, 12)) > 0.93
