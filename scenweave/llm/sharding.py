"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at ``nodes`` places of a ring, every key (the document id) at one. A key belongs to the next place clockwise; if
that shard is full, it goes on to the next shard clockwise that has room. Capacities are the load factor times the mean; with
factor 1 they add up to the number of rows, so counts are at most one apart.

Keys between two places share the order in which shards follow, so only the number of keys of each arc matters for who
overflows: ``fill`` runs over shards times nodes numbers. Keys are then told apart by their rank in the arc. Ranks come from counts per cell
of the ring (about ``CELL`` keys each, summed with map-side combining) and a rank within the cell; no window holds more.

Null handling: a NULL id is a key like any other, a NULL text has no bytes. Rows that repeat an id lie together on the ring, in order of
their texts' checksums. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage

NODES = 64
CELL = 1000
#: Bits of a place on the ring.
BITS = 52


def ring(shards: int, nodes: int = NODES) -> tuple[np.ndarray, list[list[int]]]:
    """(places in order, for each the shards clockwise from there). A shard's places do not depend on the number of shards."""
    places = sorted(
        (int(hashlib.md5(f"shard-{s}-{v}".encode()).hexdigest()[: BITS // 4], 16), s) for s in range(shards) for v in range(nodes)
    )
    owners = [s for _, s in places]
    return np.array([p for p, _ in places], dtype=np.int64), [
        list(dict.fromkeys(owners[i:] + owners[:i])) for i in range(len(owners))
    ]


def fill(counts: dict[int, int], follow: list[list[int]], shards: int, load_factor: float) -> list[tuple[int, int, int, int, int]]:
    """(arc, shard, first rank, rank after the last, first slot): who takes which keys of each arc.

    In the first round arcs are asked in ring order for their own shard, in the next ones for what is left over, clockwise.
    """
    total = sum(counts.values())
    if load_factor == 1:
        room = [total // shards + (s < total % shards) for s in range(shards)]
    else:
        room = [int(np.ceil(load_factor * total / shards))] * shards
    taken, used, out = dict.fromkeys(counts, 0), [0] * shards, []
    for turn in range(shards):
        for arc in sorted(counts):
            shard = follow[arc][turn]
            n = min(counts[arc] - taken[arc], room[shard] - used[shard])
            if n > 0:
                out.append((arc, shard, taken[arc], taken[arc] + n, used[shard]))
                taken[arc] += n
                used[shard] += n
    return out


def place_of(key: Column) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def shard(docs: DataFrame, shards: int, nodes: int = NODES, load_factor: float = 1.0) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: ``size`` is bytes plus 1, slots are gapless from 0 in each shard."""
    spark = docs.sparkSession
    if load_factor < 1:
        raise ValueError("a load factor below 1 leaves rows without a shard")
    places, follow = ring(shards, nodes)
    body = F.coalesce("text", F.lit("")).cast("binary")

    @F.pandas_udf("int")
    def arc_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(places, place.to_numpy()) % len(places))

    keyed = stage(
        docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
        .withColumn("place", place_of(F.col("doc_id"))).withColumn("arc", arc_of("place")),
        "keys",
    )
    n = keyed.count()
    keyed = keyed.withColumn("cell", F.floor(F.col("place") / F.lit((1 << BITS) // max(1, n // CELL))))
    cells = stage(keyed.groupBy("arc", "cell").agg(F.count("*").alias("n")), "cells")
    # One number per arc, shards times nodes at most.
    counts = {r["arc"]: r["n"] for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    quotas = spark.createDataFrame(fill(counts, follow, shards, load_factor), "arc int, shard int, low long, high long, slot long")
    before = W.partitionBy("arc").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = stage(cells.select("arc", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "starts")
    order = W.partitionBy("arc", "cell").orderBy("place", F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    ranked = keyed.withColumn("rank", F.row_number().over(order) - 1).join(starts, ["arc", "cell"]).withColumn("rank", F.col("rank") + F.col("start"))
    return ranked.join(F.broadcast(quotas), "arc").filter("rank >= low and rank < high").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("rank") - F.col("low")).alias("slot")
    )
