import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import bpe, lengths

from .helpers import ODD_TEXTS, documents, table_rows


@pytest.fixture(scope="module")
def library():
    with open(bpe.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(bpe.RANKS, public_tokenizers.PATTERN)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("aabeiorstnh ht \n\t'é中🙂1.,-_"), max_size=60), max_size=8))
def test_same_ids_as_the_library(own, library, texts):
    assert list(map(ids, own.encode(texts))) == [library.encode_ordinary(t) for t in texts]


def test_overlapping_pairs(own, library):
    texts = ["a" * n for n in range(40)] + ["ab" * 50, "=" * 99, "ha" * 33 + "h", "\n" * 7 + " x"]
    assert list(map(ids, own.encode(texts))) == [library.encode_ordinary(t) for t in texts]


def test_another_pattern(library):
    pattern = r"\S+|\s+"
    ranks = library._mergeable_ranks
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["one two, three. four's\nfive 6", "naïve\nwords.", " a  b "]
    got = bpe.Encoder(bpe.RANKS, pattern).encode(texts)
    assert list(map(ids, got)) == [other.encode_ordinary(t) for t in texts]


def test_memory_that_overflows(library):
    own = bpe.Encoder(bpe.RANKS, public_tokenizers.PATTERN, remembered=5)
    for texts in (["one two three four five six seven", "one"], ["two eight nine", "ten one"]):
        assert list(map(ids, own.encode(texts))) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("few", [0, 1000])
def test_one_by_one_and_in_vectors(library, monkeypatch, few):
    monkeypatch.setattr(bpe, "_FEW", few)
    fresh = bpe.Encoder(bpe.RANKS, public_tokenizers.PATTERN)
    texts = [t or "" for t in ODD_TEXTS]
    assert list(map(ids, fresh.encode(texts))) == [library.encode_ordinary(t) for t in texts]


def test_pieces_of_irregular_order_are_encoded_plainly(library):
    vocab = bpe.vocabulary(bpe.RANKS)
    for piece in (" internationalisation", " thththth", "中文字"):
        assert vocab.plain(piece.encode()) == library.encode_ordinary(piece)


def test_round_trip_of_the_table(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] for r in table_rows(sf_dir, "documents")}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for r in bpe.decode(bpe.encode(docs)).collect():
        assert ids(r.ids) == library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(r.ids) // 4 and bytes(r.decoded).decode() == texts[r.doc_id]


def test_odd_rows(spark):
    docs = documents(spark, [*enumerate(ODD_TEXTS), (None, "x"), (None, "x")])
    docs = docs.selectExpr("*", "5 AS ids", "6 AS N_Tokens", "7 AS decoded")
    rows = bpe.decode(bpe.encode(docs)).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    for r in rows:
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(documents(spark, [])).collect() == []
    assert bpe.decode(spark.createDataFrame([(None,)], "ids binary")).first().decoded is None


def test_query_digests(spark, sf_dir, library):
    from tidewatch.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in table_rows(sf_dir, "documents")}
    for r in QUERIES["op9_bpe"](spark, sf_dir).collect():
        packed = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
        assert r.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --- length histogram ------------------------------------------------------------------


def test_histogram_against_brute_force(spark, sf_dir, library):
    sizes = [len(library.encode_ordinary(r["text"])) for r in table_rows(sf_dir, "documents")]
    sums = lengths.suffix_sums(lengths.histogram(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    rows = {r.n_tokens: r for r in sums.collect()}
    assert set(rows) == set(sizes)
    ordered = sorted(sizes)
    for limit, r in rows.items():
        assert r.n_docs == sizes.count(limit)
        assert r.docs_from == sum(s >= limit for s in sizes)
        assert r.tokens_from == sum(s for s in sizes if s >= limit)
        assert r.truncated_tokens == sum(min(s, limit) for s in sizes)
        assert (r.total_docs, r.total_tokens) == (len(sizes), sum(sizes))
        assert ordered[r.first_rank - 1] == ordered[r.last_rank - 1] == limit
    answers = {r.share: r.n_tokens for r in lengths.quantiles(sums, [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for share, length in answers.items():
        assert length == ordered[max(-(-int(share * 1000) * len(sizes) // 1000), 1) - 1]
    limits = [0, 1, 100, 1000, 10**6]
    for r in lengths.truncated(sums, limits).collect():
        assert r.tokens == sum(min(s, r.limit) for s in sizes)


def test_suffix_sums_do_not_depend_on_the_block(spark, monkeypatch):
    counts = spark.createDataFrame([(0, 2), (1, 1), (7, 3), (8, 1), (20, 5)], "n_tokens long, n_docs long")
    want = sorted(lengths.suffix_sums(counts).collect())
    for block in (1, 3, 8):
        monkeypatch.setattr(lengths, "BLOCK", block)
        assert sorted(lengths.suffix_sums(counts).collect()) == want


def test_histogram_of_odd_rows(spark):
    docs = documents(spark, [(1, None), (1, None), (None, ""), (2, "a b")]).withColumnRenamed("lang", "n_docs")
    assert sorted(map(tuple, lengths.histogram(docs).collect())) == [(0, 3), (2, 1)]
    assert lengths.suffix_sums(lengths.histogram(documents(spark, []))).collect() == []
