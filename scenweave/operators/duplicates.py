"""Duplicate observations: statistics, marking and resolution.

One key may hold any share of the rows, so no task ever gets a whole group. A
group is cut into *chunks* of consecutive input rows: the leading order columns
plus the upper bits of the last one. A chunk has at most ``2 ** chunk_bits``
rows because positions are unique. Rows are shuffled once, by key and chunk.
Totals per key come from one summary row per chunk, and so does the number of
rows before each chunk, which turns a position within a chunk into one within
the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import DUPLICATE_PREFIX, IAMC_KEYS

KEYS = ["source_model", *IAMC_KEYS, "year"]
CHUNK_BITS = 20
_GROUP = ["_h", "_k"]


def _measures(value: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(value).alias("n_values"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    ]


def _identical() -> Column:
    """The non-null values of a group are all the same one."""
    return (F.col("n_values") > 0) & (F.col("low") == F.col("high"))


def duplicate_stats(df: DataFrame, keys: Sequence[str] = KEYS, value: str = "value") -> DataFrame:
    """Rows, non-null values and value range per key (combined before the shuffle)."""
    return df.groupBy(*keys).agg(*_measures(value))


def duplicate_counters(
    df: DataFrame, keys: Sequence[str] = KEYS, value: str = "value", scope: str = "source_model"
) -> DataFrame:
    """Per ``scope``: rows in duplicate groups, rows to remove, rows to rename."""
    n, many = F.col("n"), F.col("n") > 1
    same = F.coalesce(_identical(), F.lit(False))

    def rows(hit: Column, count: Column) -> Column:
        return F.sum(F.when(hit, count).otherwise(0))

    return duplicate_stats(df, keys, value).groupBy(scope).agg(
        rows(many, n).alias("duplicates"),
        rows(many & same, n - 1).alias("removed"),
        rows(many & ~same, n).alias("renamed"),
    )


def _chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], bits: int) -> DataFrame:
    """Rows by key and chunk.

    The struct key lets NULL equal NULL in a join. Its hash goes in front of it
    wherever rows are sorted: comparing one number nearly always decides.
    """
    *coarse, fine = order
    rest = [c for c in df.columns if c not in keys]
    return df.select(
        F.xxhash64(*keys).alias("_h"),
        F.struct(*keys).alias("_k"),
        F.struct(*coarse, F.shiftright(F.col(fine).cast("bigint"), bits).alias("_part")).alias("_chunk"),
        *rest,
    ).repartition(*_GROUP, "_chunk")


def _chunk_totals(rows: DataFrame, value: str | None, fine: str) -> DataFrame:
    """Per key and chunk: totals of the whole group and the rows before the chunk."""
    measures = _measures(value) if value else [F.count(F.lit(1)).alias("n")]
    # Sorting by the position too keeps both uses of the shuffled rows alike,
    # so that Spark runs that shuffle once.
    per_chunk = rows.groupBy(*_GROUP, "_chunk").agg(*measures, F.min(fine).alias("_first"))
    ordered = Window.partitionBy(*_GROUP).orderBy("_chunk", "_first")
    group = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    totals = {"_before": F.coalesce(F.sum("n").over(before), F.lit(0)), "n": F.sum("n").over(group)}
    if value:
        totals |= {
            "n_values": F.sum("n_values").over(group),
            "low": F.min("low").over(group),
            "high": F.max("high").over(group),
        }
    return per_chunk.withColumns(totals)


def mark_duplicates(
    df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ("ord",),
    into: str = "is_duplicate", chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Flag every row of a group of more than one; NULL equals NULL."""
    columns = df.columns
    rows = _chunked(df, keys, order, chunk_bits)
    totals = _chunk_totals(rows, None, order[-1]).select(*_GROUP, "_chunk", (F.col("n") > 1).alias(into))
    joined = rows.join(totals, [*_GROUP, "_chunk"])
    return joined.select(*[F.col(f"_k.{c}") if c in keys else F.col(c) for c in columns], into)


def resolve_duplicates(
    df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ("ord",),
    value: str = "value", rename: str = "region", null_policy: str = "reference",
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Keep one row of identical duplicates, number the contradicting ones.

    A group with a single distinct non-null value keeps its first row. Any
    other group of several rows, also one without values, keeps all of them
    with ``rename`` turned into ``dup_<name>_<position in input order>``.
    In a group of one value and NULLs the first row may be the NULL;
    ``null_policy="prefer_value"`` takes the value instead.

    Gives ``keys`` and ``value``. ``order`` are integer columns whose
    combination is unique, and the same each time the rows are computed.
    """
    if null_policy not in ("reference", "prefer_value"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    fine = order[-1]
    needed = [c for c in dict.fromkeys([*keys, value, *order])]
    rows = _chunked(df.select(*needed), keys, order, chunk_bits)
    totals = _chunk_totals(rows, value, fine)

    one_value = F.coalesce(_identical(), F.lit(False))
    if null_policy == "reference":
        # With NULLs in the group the first row decides, which takes the rows.
        one_value = one_value & (F.col("n_values") == F.col("n"))
    settled = (F.col("n") == 1) | one_value

    def fields(name: Column | None = None) -> list[Column]:
        return [
            name.alias(c) if name is not None and c == rename else F.col(f"_k.{c}").alias(c) for c in keys
        ]

    # A settled group needs no row: its key and its value are in the totals.
    plain = totals.filter(settled & (F.col("_before") == 0)).select(*fields(), F.col("high").alias(value))

    opened = totals.filter(~settled).select(
        *_GROUP, "_chunk", "_before", F.coalesce(_identical(), F.lit(False)).alias("_same")
    )
    in_chunk = Window.partitionBy(*_GROUP, "_chunk").orderBy(fine)
    contested = rows.join(opened, [*_GROUP, "_chunk"]).withColumn(
        "_at", F.col("_before") + F.row_number().over(in_chunk)
    )
    name = F.coalesce(F.col(f"_k.{rename}"), F.lit(""))
    numbered = F.concat(F.lit(DUPLICATE_PREFIX), name, F.lit("_"), F.col("_at").cast("string"))
    kept = contested.filter(~F.col("_same") | (F.col("_at") == 1)).select(
        *fields(F.when(F.col("_same"), F.col(f"_k.{rename}")).otherwise(numbered)), F.col(value)
    )
    return plain.unionByName(kept)
