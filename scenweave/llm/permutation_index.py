"""Approximate nearest neighbours by a permutation index.

A bounded sample of the vectors (the ``pivots`` smallest hashes) serves as pivots. Every vector is represented by the order of its
``prefix`` nearest pivots and posted, with the place it gives each, in those pivots' inverted files. A query reads the
files of its own nearest pivots and sums, per vector, what the footrule distance of the two orders leaves of its largest value. As
orders tell the angle alone and the measure is the inner product, that sum is taken times the vector's length; the
best ``share`` of the vectors, ``at_least`` many, are ranked anew by the true measure on the original vectors.

Vectors are dealt by hash to blocks of about ``BLOCK`` rows, each with its own inverted files, and queries to sets of about
``QUERIES``; each pair of both is one task's work, bounded however many rows are alike, and yields the nearest of the block. Equal
scores go to the smaller id; at the edge of the candidates too the smaller ids come first, so copies of one vector are found in order.

Null handling: vectors that are NULL, zero, without components, or hold NULL or non-finite components take no part; nor do rows
without id. Only vectors of one length have an inner product, so each length has pivots and blocks of its own. Rows that repeat an id are searched as they come, a query never finds its own id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import parts_for, stage

PIVOTS, PREFIX = 128, 32
SHARE, AT_LEAST = 0.3, 1000
BLOCK, QUERIES = 16_000, 800


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers, and not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """For each vector its nearest pivots (largest cosine), in order."""
    near = vectors @ pivots.T
    near = near / np.maximum(np.linalg.norm(pivots, axis=1), 1e-300)
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix]


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Lengths relative to the longest vector, in steps of a millionth, so that those that differ by rounding alone are equal."""
    peak = np.abs(vectors).max(axis=1)
    size = np.log(peak) + np.log(np.linalg.norm(vectors / peak[:, None], axis=1))
    return np.exp(np.round(size - size.max(), 6))


class InvertedFiles:
    """Per pivot the rows that have it among their nearest ones, and the place they give it."""

    def __init__(self, order: np.ndarray, n_pivots: int) -> None:
        self.rows, self.prefix = order.shape
        by = np.argsort(order.ravel(), kind="stable")
        bounds = np.searchsorted(order.ravel()[by], np.arange(n_pivots + 1))
        row, place = by // self.prefix, (by % self.prefix).astype(np.int32)
        self.posts = [(row[a:b], place[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]

    def near(self, order: np.ndarray) -> np.ndarray:
        """For each row the largest footrule distance less its own: a shared pivot saves prefix minus the difference of places,
        one that only one of them has nothing."""
        gain = np.zeros(self.rows, dtype=np.int32)
        for i, pivot in enumerate(order.tolist()):
            row, place = self.posts[pivot]
            gain[row] += 2 * np.minimum(self.prefix - place, self.prefix - i)
        return gain


def _search(k: int, pivots_of: dict[int, np.ndarray], most: int, share: float, at_least: int):
    def search(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out, pivots = [], pivots_of[key[0]]
        prefix = min(most, len(pivots))
        if len(vectors) and len(queries):
            vectors = vectors.sort_values("vec_id", kind="stable", ignore_index=True)
            ids, x = vectors["vec_id"].to_numpy(), np.array(vectors["embedding"].tolist(), dtype=np.float64)
            q_ids, q = queries["vec_id"].to_numpy(), np.array(queries["embedding"].tolist(), dtype=np.float64)
            files, asked = InvertedFiles(orders(x, pivots, prefix), len(pivots)), orders(q, pivots, prefix)
            length = lengths(x)
            wanted = min(len(ids), max(at_least, int(np.ceil(share * len(ids))), k + 1))
            for i in range(len(q_ids)):
                gain = files.near(asked[i]) * length
                edge = np.partition(gain, len(ids) - wanted)[len(ids) - wanted]
                rows = np.flatnonzero(gain > edge)
                rows = np.concatenate([rows, np.flatnonzero(gain == edge)[: wanted - len(rows)]])
                rows = rows[ids[rows] != q_ids[i]]
                score = x[rows] @ q[i]
                if len(rows) > k:  # what may be among the k best is added up anew, term by term
                    low = np.partition(score, len(rows) - k)[len(rows) - k]
                    rows = rows[score >= low - 1e-9 * (1 + np.abs(low))]
                score = np.cumsum(x[rows] * q[i], axis=1)[:, -1] if len(rows) else score
                best = np.lexsort((ids[rows], -score))[:k]
                out.append(pd.DataFrame({"query_id": q_ids[i], "vec_id": ids[rows][best], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return search


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int, n_pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE,
    at_least: int = AT_LEAST, block: int = BLOCK, each: int = QUERIES,
) -> DataFrame:
    """The ``k`` nearest of ``vectors`` found for each of ``queries`` (both ``vec_id, embedding``), by largest inner product:
    ``query_id, rank, vec_id, score``."""
    spark = vectors.sparkSession
    of_length = lambda df: df.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        "vec_id", "embedding", F.size("embedding").alias("length"))
    whole, asked = stage(of_length(vectors), "vectors"), stage(of_length(queries), "queries")
    count = lambda df: {r["length"]: r["count"] for r in df.groupBy("length").count().collect()}
    n_asked = count(asked)
    n_rows = {length: n for length, n in count(whole).items() if length in n_asked}
    if not n_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # The sample: at most ``n_pivots`` distinct vectors of each length, whatever the size of the table.
    hashed = whole.filter(F.col("length").isin(sorted(n_rows))).withColumn("h", F.xxhash64("embedding")).dropDuplicates(["length", "h"])
    first = hashed.withColumn("r", F.row_number().over(W.partitionBy("length").orderBy("h"))).filter(F.col("r") <= n_pivots)
    sample: dict[int, list] = {}
    for r in first.orderBy("length", "h").select("length", "embedding").collect():
        sample.setdefault(r["length"], []).append(r["embedding"])
    pivots = {length: np.array(some, dtype=np.float64) for length, some in sample.items()}

    def per_length(counts: dict[int, int], each: int) -> Column:
        table = F.create_map(*[F.lit(x) for length in sorted(n_rows) for x in (length, parts_for(counts[length], each))])
        return F.try_element_at(table, F.col("length"))

    n_blocks, n_sets = per_length(n_rows, block), per_length(n_asked, each)
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "embedding"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    known = F.col("length").isin(sorted(n_rows))
    left = whole.filter(known).withColumn("block", deal(n_blocks)).withColumn("part", every(n_sets))
    right = asked.filter(known).withColumn("part", deal(n_sets)).withColumn("block", every(n_blocks))
    keys = ["length", "block", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _search(k, pivots, prefix, share, at_least), "query_id long, vec_id long, score double"
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
