"""Languages of web pages by fusion of evidence.

Four kinds of evidence speak for a language: the visible text (likelihood of its byte trigrams, counted over all documents
of each declared language), the language its markup declares, the suffix of its address, and what else its host and domain
serve. Bayes' rule multiplies them: the logarithm of the text's likelihood, of the likelihood of the declaration, and of the
prior of the host, which leans on that of its domain, that on its suffix's, and that on the prior of all pages. The tables of
declarations and priors are grouped counts of what the pages' texts alone say, and a page leaves its own count out.

Null handling: a NULL html has no text and no declaration, a NULL url no host; what is missing adds nothing, and where all is missing
the prior of all pages remains. Documents without language or text train nothing. Repeated pages count as often as they come;
pages without id are judged like others. Without any training text the result has NULL languages. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import slices, stage

BINS = 1 << 14
#: A text says no more than this many trigrams would, as neighbouring ones are not independent.
MOST_TRIGRAMS = 200
#: Pages' worth of the next wider group's prior in a group's own.
LEAN = 5.0
_HIDDEN = re.compile(rb"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z0-9#]+;")
#: Fixed: letters of either case count alike, all else but high bytes is one blank.
_FOLD = np.full(256, 32, dtype=np.uint32)
for _b in range(97, 123):
    _FOLD[_b] = _FOLD[_b - 32] = _b
_FOLD[128:] = np.arange(128, 256)


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bin, number of the text) of all byte trigrams that are not blank."""
    sizes = np.array([len(t) + 3 for t in texts], dtype=np.int64)
    data = _FOLD[np.frombuffer(b"".join(t + b"   " for t in texts), dtype=np.uint8)]
    code = data[:-2] * np.uint32(0x1000193) ^ data[1:-1] * np.uint32(0x85EBCA6B) ^ data[2:] * np.uint32(0xC2B2AE35)
    of = np.repeat(np.arange(len(texts)), sizes)[:-2]
    some = (data[:-2] != 32) | (data[1:-1] != 32)
    code = code ^ (code >> np.uint32(15))
    return (code[some] * np.uint32(0x9E3779B1)) >> np.uint32(18), of[some]


def train(docs: DataFrame) -> DataFrame:
    """``lang, bin, n`` over all documents: each task adds up its own before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), pc.fill_null(batch.column(1), "").cast(pa.binary())
            names = sorted({x for x in langs if x is not None})
            number = np.array([names.index(x) if x is not None else -1 for x in langs])
            for low, n in slices(pc.binary_length(texts).to_numpy(), 4_000_000):
                bins, of = trigrams(texts.slice(low, n).to_pylist())
                lang = number[low + of]
                table = np.bincount(lang[lang >= 0] * BINS + bins[lang >= 0], minlength=len(names) * BINS)
                for i, name in enumerate(names):
                    sums[name] = sums.get(name, 0) + table[i * BINS : (i + 1) * BINS]
        for name, table in sums.items():
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(table[at], pa.int64())], names=["lang", "bin", "n"]
            )

    counted = docs.filter("lang is not null and text is not null").select("lang", "text").mapInArrow(count, "lang string, bin int, n long")
    return counted.groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def visible(html: bytes) -> bytes:
    return _HIDDEN.sub(b" ", html)


def text_likelihoods(pages: DataFrame, model: DataFrame) -> tuple[DataFrame, list[str]]:
    """``page_id, url, declared`` and ``loglik``, an entry per language; the languages. The model has BINS numbers each."""
    table = model.toArrow().to_pandas()
    names = sorted(table["lang"].unique())
    log = np.full((BINS, len(names)), 0.5)
    log[table["bin"], [names.index(x) for x in table["lang"]]] += table["n"]
    log = np.log(log / log.sum(0))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = pc.fill_null(batch.column(3), "").cast(pa.binary())
            out = np.zeros((batch.num_rows, len(names)))
            for low, n in slices(pc.binary_length(html).to_numpy(), 4_000_000):
                bins, of = trigrams([visible(x) for x in html.slice(low, n).to_pylist()])
                size = np.bincount(of, minlength=n)
                for j in range(len(names)):
                    out[low : low + n, j] = np.bincount(of, log[bins, j], n) * np.minimum(1, MOST_TRIGRAMS / np.maximum(size, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(list(out), pa.list_(pa.float64()))], names=["page_id", "url", "declared", "loglik"]
            )

    declared = F.nullif(F.lower(F.regexp_extract(
        F.coalesce("html", F.lit("")), r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1)), F.lit(""))
    chosen = pages.select("page_id", "url", declared.alias("declared"), "html")
    return chosen.mapInArrow(judge, "page_id long, url string, declared string, loglik array<double>"), names


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """``page_id, declared, host, text_lang, lang, probability``: one row per page."""
    judged, names = text_likelihoods(pages, stage(train(docs), "trigrams"))
    if not names:
        return pages.select(
            "page_id", F.lit(None).cast("string").alias("declared"), host_of(F.col("url")).alias("host"),
            *[F.lit(None).cast("string").alias(c) for c in ("text_lang", "lang")], F.lit(None).cast("double").alias("probability"))
    count = range(len(names))
    best = lambda a: F.array_position(a, F.array_max(a)).cast("int") - 1
    host = host_of(F.col("url"))
    judged = stage(
        judged.withColumns({"host": host, "guess": best(F.col("loglik"))}).withColumns({
            "domain": F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), "suffix": F.regexp_extract("host", r"([^.]+)$", 1),
        }), "judged")
    one = lambda i: F.coalesce(F.sum((F.col("guess") == i).cast("long")), F.lit(0))
    counts = lambda by, name: stage(judged.groupBy(by).agg(F.array(*[one(i) for i in count]).alias(name)), name).withColumnRenamed(by, f"_{by}")
    every = judged.agg(F.array(*[one(i) for i in count]).alias("n")).first()["n"]
    prior = [(n + 1.0) / (sum(every) + len(names)) for n in every]
    joined = judged
    for by in ("suffix", "domain", "host", "declared"):
        table = counts(by, f"n_{by}")
        joined = joined.join(table, F.col(by).eqNullSafe(F.col(f"_{by}")), "left").drop(f"_{by}")
    own = lambda i: F.when(F.col("guess") == i, 1.0).otherwise(0.0)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x) - 1
    terms = []
    for i in count:
        p = F.lit(prior[i])
        for by in ("suffix", "domain", "host"):
            p = F.when(F.coalesce(F.col(by), F.lit("")) == "", p).otherwise(
                (F.get(F.col(f"n_{by}"), F.lit(i)) - own(i) + LEAN * p) / (total(F.col(f"n_{by}")) + LEAN))
        # How often pages of this language declare what this page declares, against one page that declares anything.
        told = (F.get(F.col("n_declared"), F.lit(i)) - own(i) + 0.5) / F.lit(every[i] + 1.0)
        terms.append(F.get(F.col("loglik"), F.lit(i)) + F.log(p) + F.when(F.col("declared").isNull(), 0.0).otherwise(F.log(told)))
    fused = joined.withColumn("fused", F.array(*terms)).withColumn("top", F.array_max("fused"))
    langs = F.array(*[F.lit(n) for n in names])
    return fused.select(
        "page_id", "declared", "host", F.get(langs, F.col("guess")).alias("text_lang"), F.get(langs, best(F.col("fused"))).alias("lang"),
        (1 / F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))).alias("probability"),
    )
