"""One query for each operator over its whole table, with production parameters."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_folder
from . import (
    bpe,
    lengths,
    lm,
    merkle,
    mixing,
    pii,
    quality,
    simhash,
    spelling,
    topk,
    toxicity,
    urls,
    warc,
)
from .common import lower_ascii, table

QUERIES = {}


def query(plan):
    QUERIES[plan.__name__] = plan
    return plan


@query
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2("base", 256).alias("base_sha256"), "spans",
    )


@query
def op3_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.suffix_sums(lengths.histogram(table(spark, sf_dir, "documents")))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held = lm.held_out(F.col("doc_id"), 4, 2)
    network = toxicity.fit(docs.filter(~held), labels.filter(~held))
    return toxicity.score(docs, network).select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "flagged",
    )


@query
def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query
def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = lm.held_out(F.col("doc_id"), 5, 1)
    scored = lm.score(docs, held)
    return scored.select("*", held.alias("held_out"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.allot(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.decode(bpe.encode(docs).drop("text"))
    return done.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.assess(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lost",
    )


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.runs(table(spark, sf_dir, "documents"))
    found = spelling.variants(spelling.counted(spelling.misspelled(runs)))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document in five is tampered with after the tree was built."""
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(touched, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    proven = merkle.manifest(table(spark, sf_dir, "documents"), tampered={"text": text})
    return proven.drop("source")


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "warc")
    warc.write(warc.deduplicated(table(spark, sf_dir, "pages")), folder)
    return warc.archived(spark, folder)
