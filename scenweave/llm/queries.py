"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    hard_negatives, language_id, mixing, ngram_join, packing, periodic_runs, permutation_index, quality_classifier, quality_rules, secrets,
    sharding, url_filter, warc,
)
from .common import table

TOKENIZER = "word_bpe_49k.json"
SHARDS = 8
NEIGHBOURS, EVERY = 20, 20
ANCHORS, POSITIVES, NEGATIVES = 100, 5, 10


def op1_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every page through WARC files into a content-addressed store and back."""
    return warc.archive_pages(spark, table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_secret_links(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents, weak parts where they complete each other."""
    return secrets.digests(secrets.find_secrets(table(spark, folder, "documents")))


def secret_links_planted(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents with parts of credentials put before their texts, at distances that depend on the document."""
    doc, name = F.col("doc_id"), F.col("doc_id").cast("string")
    times = lambda word, n: F.repeat(F.lit(word), F.pmod(doc, F.lit(n)).cast("int"))
    secret = F.substring(F.concat(F.md5(name), F.md5(F.concat(name, F.lit("x")))), 1, 37)
    parts = [
        F.when(doc % 3 == 0, "").otherwise(F.concat(F.lit("é"), times("pad ", 90))),
        F.when(doc % 2 == 0, F.concat(F.lit("AKIA"), F.upper(F.substring(F.md5(name), 1, 16)))).otherwise(""), times(" 漢", 160),
        F.when(doc % 5 < 3, F.concat(F.lit(" aws_secret_access_key=aB"), secret, F.lit("/ "))).otherwise(" "), times("filler", 70),
        F.when(doc % 7 < 4, F.concat(F.lit(" https://Box"), name, F.lit(".S3.amazonaws.com/a "))).otherwise(""),
    ]
    docs = table(spark, folder, "documents").withColumn("text", F.concat(*parts, F.coalesce("text", F.lit(""))))
    return secrets.digests(secrets.find_secrets(docs))


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How often the mix of sources takes each document."""
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op4_page_languages(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every page."""
    return language_id.identify(table(spark, folder, "pages"), table(spark, folder, "documents"))


def op5_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest vectors of every twentieth one."""
    vectors = table(spark, folder, "embeddings")
    return permutation_index.nearest(vectors, vectors.filter(F.col("vec_id") % EVERY == 0), NEIGHBOURS)


def op6_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Quality rules on all documents."""
    return quality_rules.judge(table(spark, folder, "documents"))


def op7_ngram_components(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near-duplicates among all documents."""
    return ngram_join.near_duplicates(table(spark, folder, "documents"))


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences."""
    return packing.pack_documents(
        table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), with_tokens=False
    ).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_bounded_ring(spark: SparkSession, folder: str) -> DataFrame:
    """All documents dealt to shards."""
    return sharding.shard(table(spark, folder, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_preference_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score of every document."""
    docs = table(spark, folder, "documents")
    return quality_classifier.scored(docs, table(spark, folder, "labels")).select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of all documents, a tenth of which repeat one period from a word on."""
    docs = table(spark, folder, "documents").select("doc_id", periodic_runs.with_period(F.col("text"), F.col("doc_id")).alias("text"))
    return periodic_runs.digests(periodic_runs.find_runs(docs))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, a seventh of the labels moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, ANCHORS, POSITIVES, NEGATIVES)


def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's address."""
    return url_filter.judge(table(spark, folder, "pages"))


QUERIES = {
    f.__name__: f for f in (
        op1_warc_archive, op2_secret_links, secret_links_planted, op3_source_mix, op4_page_languages, op5_permutation_index, op6_divergence_rules,
        op7_ngram_components, op8_best_fit_packing, op9_bounded_ring, op10_preference_scores, op11_periodic_runs,
        op12_hard_negatives, op13_url_filter,
    )
}
