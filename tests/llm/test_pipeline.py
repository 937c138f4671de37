"""The pipeline against a plain version of its stages."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tidewatch.llm import bpe, pii, simhash

from .helpers import documents
from .test_quality import plain as quality_counts
from .test_simhash import classes, plain_fingerprint


def corpus(n=120):
    dice, rows = random.Random(5), []
    words = [f"word{i}" for i in range(900)]
    for i in range(n):
        body = [" ".join(dice.choices(words, k=12)) + "." for _ in range(8)]
        if i % 10 == 0:
            body.insert(3, "Home | News | Jobs | Contact")
        if i % 9 == 0:
            body.insert(2, f"Write to user{i}@mail.example.com now, or call +1 (614) 555-8001 soon.")
        if i % 11 == 0:
            body = [" | ".join(dice.choices(words, k=9)) for _ in range(12)]
        rows.append((i, "\n".join(body), "en", f"src{i % 4}", None))
    rows += [(1000 + i, rows[i][1], "en", f"src{i % 4}", None) for i in range(0, 40, 3)]  # copies
    rows += [(2000, None), (2001, ""), (None, rows[5][1]), (2002, "short"), (1, rows[1][1], "en", "src1", None)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    documents(spark, corpus()).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_against_a_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        steps[name] = stage(spark, docs, folder)
        assert steps[name].dtypes == docs.dtypes
        docs = steps[name]
    rows = {k: [tuple(r) for r in v.collect()] for k, v in steps.items()}

    good = []
    for i, text, *rest in corpus():
        lines = (text or "").split("\n")
        left = [x for x in lines if " | " not in x]
        solid = lambda x: len("".join("".join(x).split()))
        if not quality_counts(text)[-1] and solid(left) >= 0.5 * solid(lines):
            good.append((i, "\n".join(left)))
    assert Counter(r[:2] for r in rows["quality_rules"]) == Counter(good)

    prints = [plain_fingerprint(t) for _, t in good]
    groups = {}
    for (i, _), c in zip(good, classes(prints, 2)):
        groups.setdefault(c, []).append(i)
    first = [min((i for i in g if i is not None), default=None) for g in groups.values()]
    assert Counter(r[0] for r in rows["near_duplicates"]) == Counter(first)

    before = {r[0]: r[1] for r in rows["near_duplicates"]}
    for i, text, _, _, n_chars in rows["personal_data"]:
        assert pii.base_spans(text) == [] and n_chars == len(text)
        if not pii.base_spans(before[i]):
            assert text == before[i]
    assert any("[EMAIL]" in r[1] and "[PHONE]" in r[1] for r in rows["personal_data"])

    kept = {r[0]: r for r in rows["personal_data"]}
    copies = Counter(rows["mixture"])
    assert copies and all(n <= 2 and kept[r[0]] == r for r, n in copies.items())


def test_run_ends_with_ids(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "n_tokens"]
    encoder = bpe.Encoder(bpe.RANKS, public_tokenizers.PATTERN)
    rows = out.collect()
    assert rows and [bytes(r.ids) for r in rows] == encoder.encode([r.text for r in rows])
    assert all(r.n_tokens == len(np.frombuffer(r.ids, "<u4")) for r in rows)


def test_empty_and_odd_documents(spark, tmp_path):
    for name, rows in (("none", []), ("odd", [(None, None), (None, ""), (1, "x" * 5000), (1, "x" * 5000)])):
        path = str(tmp_path / name)
        documents(spark, rows).write.parquet(f"{path}/documents.parquet")
        assert corpus_pipeline.run(spark, path).collect() == []


def test_stage_takes_clashing_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr(
        "*", "1 AS size", "2 AS cleaned", "3 AS _text", "4 AS kept", "5 AS fp", "6 AS _copy"
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    assert {tuple(r)[5:] for r in docs.collect()} == {(1, 2, 3, 4, 5, 6)}
    assert simhash.block_masks(2)
