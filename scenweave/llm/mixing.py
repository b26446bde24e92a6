"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: its share by weight of a total, at most ``cap`` times its own size, the excess
shared anew by weight. The target over the size is the number of copies expected of each document of the source. Its whole
part is certain; for the rest a document has inclusion odds p / (1 - p), and the documents of a source are ranked by random
odds u / (1 - u) over inclusion odds. The first ones get one more copy, until the words taken are as near the target as whole
documents allow.

A source may hold any share of the rows, so no window runs over a source. Ranks are cut into cells, cells into finer cells,
and words are summed per cell with map-side combining; running sums are taken over at most ``CELLS`` rows, and rows are ordered
only within the one fine cell in which a source's target is reached.

Null handling: a NULL source is a source of its own (the last), a NULL text has no words. Documents without words are taken
with no words. The random number comes from the document id and the text, so reruns agree; equal rows are exchangeable. Other
columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage, word_count

CELLS = 1024
#: Weights of the sources in order, repeating (fixed values).
WEIGHTS = (3, 1, 2)
#: The mix has this many words for each word there is.
TOTAL = 1.5
CAP = 2


def uniform(*columns: Column, seed: int = 0) -> Column:
    """A number between 0 and 1, both excluded, from 48 bits of the MD5 of the columns."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, cap: int = CAP) -> DataFrame:
    """``source, n, source_size`` and more, with ``weight``, ``target`` and ``place``; one row per source, NULL last.

    Water filling in closed form: in order of size over weight, the first k sources are capped, k being the smallest number
    that leaves the next one's share within its cap.
    """
    everything = W.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    array = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("place", F.row_number().over(by_name))
    ranked = ranked.withColumn("weight", F.element_at(array, (F.col("place") - 1) % len(weights) + 1))
    fill = everything.orderBy((cap * F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    ranked = ranked.withColumns({
        "rest": F.lit(total) * F.sum("source_size").over(everything) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
        "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "turn": F.row_number().over(fill),
    }).withColumn("fits", F.col("rest") * F.col("weight") <= cap * F.col("source_size") * F.col("open"))
    first = F.min(F.when(F.col("fits"), F.struct("turn", "rest", "open"))).over(everything)
    return ranked.withColumn("level", first).select(
        *sizes.columns, "weight", "place",
        F.when(F.col("level").isNull() | (F.col("turn") < F.col("level.turn")), (cap * F.col("source_size")).cast("double"))
        .otherwise(F.col("level.rest") * F.col("weight") / F.col("level.open")).alias("target"),
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, cap: int = CAP, seed: int = 0,
    document_weight: str | None = None, cells: int = CELLS,
) -> DataFrame:
    """Documents (``doc_id, text, source``) with ``size, source_size, target, copies, taken, u`` in place of the text.

    ``copies``, at most ``cap``, is the number of times the mix takes the document; ``taken`` is ``copies * size``.
    ``u`` is the random number, which tells texts under one id apart. ``document_weight`` names a column of positive weights by which the documents of a source expect copies (else alike);
    with it a source stays below its target where documents would need more copies than the next whole number.
    """
    sized = stage(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            (F.lit(1.0) if document_weight is None else F.col(document_weight).cast("double")).alias("w"),
            uniform(F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")), seed=seed).alias("u"),
        ),
        "sized",
    )
    sizes = sized.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("w")).alias("weighed")
    )
    targets = stage(source_targets(sizes, weights, total, cap), "targets").withColumnRenamed("source", "name")

    # Copies expected; their whole part is certain, the rest gives the odds of one more. A document without a rest ranks last.
    expected = F.when(F.col("weighed") > 0, F.least(F.lit(float(cap)), F.col("target") / F.col("weighed") * F.col("w"))).otherwise(0.0)
    odds = lambda e: (e - F.floor(e)) / (1 - (e - F.floor(e)))
    mean = F.when(F.col("weighed") > 0, F.least(F.lit(float(cap)), F.col("target") / F.col("weighed"))).otherwise(0.0)
    # Relative to the odds of weight 1, ranks fill 0..1 evenly however rare a source is in the mix.
    random = F.col("u") / (1 - F.col("u")) * (odds(mean) / odds(expected))
    rank = F.when(odds(expected) > 0, random / (1 + random)).otherwise(1.0)
    ranked = stage(
        sized.join(targets, sized["source"].eqNullSafe(targets["name"])).drop("name")
        .withColumns({"whole": F.floor(expected), "rank": rank})
        .withColumn("cell", F.least(F.floor(F.col("rank") * cells), F.lit(cells - 1)))
        .withColumn("fine", F.least(F.floor((F.col("rank") * cells - F.col("cell")) * cells), F.lit(cells - 1)))
        .withColumn("open", F.when(F.col("whole") < cap, F.col("size")).otherwise(0)),
        "ranked",
    )

    # The cell of each source, then the fine cell of it, in which the words taken reach the target.
    by = W.partitionBy("place")
    summed = ranked.groupBy("place", "cell").agg(
        F.sum("open").alias("words"), F.sum(F.col("whole") * F.col("size")).alias("certain"), F.max("target").alias("target")
    )
    reached = _reached(summed.withColumn("need", F.col("target") - F.sum("certain").over(by)), "cell")
    at = stage(reached.select("place", F.col("cell").alias("at_cell"), "need"), "cells")
    inside = ranked.join(at, "place").filter("cell = at_cell").groupBy("place", "fine").agg(
        F.sum("open").alias("words"), F.max("need").alias("need")
    )
    reached = _reached(inside, "fine").select("place", F.col("fine").alias("at_fine"), F.col("need").alias("need_fine"))
    at = stage(at.drop("need").join(reached, "place", "left"), "fine-cells")

    whole = ranked.join(at, "place", "left").withColumn(
        "side", F.when(F.col("at_cell").isNull(), F.when(F.col("target") > F.col("whole") * F.col("source_size"), 1).otherwise(-1))
        .otherwise(F.coalesce(F.nullif(F.signum(F.col("at_cell") - F.col("cell")), F.lit(0.0)), F.signum(F.col("at_fine") - F.col("fine"))))
    )
    order = by.orderBy("rank", "u", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(W.unboundedPreceding, -1)
    last = whole.filter("side = 0").withColumn("before", F.coalesce(F.sum("open").over(order), F.lit(0)))
    last = last.withColumn("more", (F.col("whole") < cap) & (F.col("before") + F.col("open") / 2 <= F.col("need_fine"))).drop("before")
    rest = whole.filter("side <> 0").withColumn("more", (F.col("whole") < cap) & (F.col("side") > 0))
    copies = (F.col("whole") + F.col("more").cast("int")).cast("long")
    return rest.unionByName(last).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "u"
    )


def repeat_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; rows equal in id and text alike often (the least of theirs)."""
    number = uniform(F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")), seed=options.get("seed", 0))
    copies = mix(docs, **options).groupBy(F.col("doc_id").alias("_id"), F.col("u").alias("_u")).agg(F.min("copies").alias("_copies"))
    copies = stage(copies.filter("_copies > 0"), "copies")
    keyed = docs.withColumn("_number", number)
    joined = keyed.join(copies, keyed["doc_id"].eqNullSafe(copies["_id"]) & (F.col("_number") == F.col("_u")))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*docs.columns)


def _reached(summed: DataFrame, step: str) -> DataFrame:
    """The first step of each place at which the running words reach ``need``, with the need that is left before it."""
    before = W.partitionBy("place").orderBy(step).rowsBetween(W.unboundedPreceding, -1)
    return (
        summed.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .filter("need > 0 and before < need and before + words >= need")
        .withColumn("need", F.col("need") - F.col("before"))
    )
