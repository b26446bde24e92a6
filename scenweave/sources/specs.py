"""The overview of source tables: which file, which sheet, which variable columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import LEGACY_SPEC_COLUMNS, SPEC_COLUMNS
from ..plans.staging import stage


def load_specs(df: DataFrame, legacy: bool = False) -> DataFrame:
    """Specification table with blanks for missing cells and its row order in ``seq``.

    A column ``Encoding`` (``ISO-8859-1``) may say how a delimited file is
    written, UTF-8 otherwise.
    """
    wanted = [*SPEC_COLUMNS, "Encoding"] + (LEGACY_SPEC_COLUMNS if legacy else [])
    required = [c for c in wanted if c not in ("Sheet name", "Unit", "Encoding")]
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise KeyError(f"overview has no column {', '.join(map(repr, absent))}")
    present = [c for c in wanted if c in df.columns]
    filled = df.select(
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in present],
        *[F.lit("").alias(c) for c in wanted if c not in present],
    )
    return filled.withColumn("seq", F.monotonically_increasing_id())


def number(df: DataFrame, order: Sequence[str], into: str, name: str) -> DataFrame:
    """Rows with a number that grows with ``order``, written once so that it stays."""
    return stage(df.orderBy(*order).withColumn(into, F.monotonically_increasing_id()), name)


def spec_summary(
    specs: DataFrame,
    file_keys: Sequence[str] = ("File location", "File name", "Source model"),
    model: str = "Source model",
) -> DataFrame:
    """Number of source tables, distinct files and models, in two steps of small groups."""
    per_file = specs.groupBy(*file_keys).agg(F.count(F.lit(1)).alias("specs"))
    per_model = per_file.groupBy(model).agg(F.sum("specs").alias("specs"), F.count(F.lit(1)).alias("files"))
    return per_model.agg(
        F.coalesce(F.sum("specs"), F.lit(0)).alias("specs"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.count(F.lit(1)).alias("models"),
    )
