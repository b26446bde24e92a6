"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenweave.llm import mixing, ngram_join, packing, quality_classifier, secrets
from scenweave.llm.common import stage, table

TOKENIZER = "word_bpe_49k.json"
#: Earlier stages leave their memory to the same workers, so the tokenizer's table of words is smaller here.
MOST_WORDS = 250_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier learned from the labels does not reject."""
    labels = table(spark, sf_dir, "labels")
    return quality_classifier.scored(docs, labels).filter(F.col("predicted") == 1).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near-duplicates."""
    return ngram_join.one_of_each(docs)


def credentials(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what looks like a credential replaced by a mark."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and their place in it."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), most_words=MOST_WORDS)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", credentials),
    ("mixing sources", mix),
    ("packing", pack),
]

#: SQL can express neither the learned classifier nor a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
