"""Reports of keys the dictionaries do not cover."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unmapped(
    df: DataFrame,
    targets: Mapping[str, tuple[str, str]],
    unit: str = "unit",
    scope: Sequence[str] = (),
    order: Sequence[str] = (),
    unit_label: str = "Units",
    flags: Mapping[str, Column] | None = None,
    among: Column | None = None,
) -> DataFrame:
    """Keys without translation, for any number of looked-up columns in one pass.

    ``targets`` maps a label to (source column, looked-up column). Gives per
    scope, label and key the unit seen first in input order, the number of
    distinct units and of rows, and the position of the first row. Rows without
    a miss never reach the shuffle, and the others are combined before it, so
    its size follows the missing keys.

    ``among`` restricts the misses to some rows. ``flags`` are counted in the
    same pass: rows where one holds are counted under its name, without a key.
    """
    scope, order = list(scope), list(order)
    has_unit = unit in df.columns
    misses = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(target).isNull() if among is None else among & F.col(target).isNull(),
                    F.struct(
                        F.lit(label).alias("label"),
                        F.col(source).cast("string").alias("key"),
                        (F.col(unit) if has_unit and source != unit and label != unit_label
                         else F.lit(None)).cast("string").alias("unit"),
                    ),
                )
                for label, (source, target) in targets.items()
            ],
            *[
                F.when(flag, F.struct(F.lit(name).alias("label"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("unit")))
                for name, flag in (flags or {}).items()
            ],
        )
    )
    anything = F.lit(False)
    for _, target in targets.values():
        anything = anything | F.col(target).isNull()
    for flag in (flags or {}).values():
        anything = anything | flag
    pairs = (
        df.filter(anything)
        .select(*scope, *order, F.explode(misses).alias("miss"))
        .select(*scope, *order, "miss.*")
    )
    if not order:
        pairs, order = pairs.withColumn("_at", F.lit(0)), ["_at"]
    *coarse, fine = order
    by_pair = [*scope, "label", "key", "unit"]
    # The plain minimum of one number is hash-aggregated, that of a struct is
    # not: reduce within each block first, compare whole positions after that.
    counted = pairs.groupBy(*by_pair, *coarse).agg(F.min(fine).alias(fine), F.count(F.lit(1)).alias("n"))
    if coarse:
        counted = counted.groupBy(*by_pair).agg(
            F.min(F.struct(*order)).alias("first"), F.sum("n").alias("n")
        )
    else:
        counted = counted.select(*by_pair, F.struct(fine).alias("first"), "n")
    return counted.groupBy(*scope, "label", "key").agg(
        F.min_by("unit", F.struct("first", "unit")).alias("unit"),
        F.count(F.lit(1)).alias("units"),
        F.sum("n").alias("n"),
        F.min("first").alias("first"),
    )


def unmapped_set(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Distinct non-null values of a column that the dictionary lacks, sorted."""
    found = df.select(F.col(column).alias("key")).filter(F.col("key").isNotNull()).distinct()
    known = dictionary.select(F.col("source").alias("key"))
    return found.join(known, "key", "left_anti").orderBy("key")
