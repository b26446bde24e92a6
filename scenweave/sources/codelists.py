"""Codelist files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.codelist import render_codelist


def read_codelist(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated codelist; cells may hold line breaks. ``seq`` is the row order."""
    df = spark.read.options(
        header="true", sep=";", quote='"', escape='"', multiLine="true", encoding="UTF-8"
    ).csv(path)
    return df.withColumn("seq", F.monotonically_increasing_id())


def write_codelist(df: DataFrame, path: str, escape: bool = False) -> None:
    """Write the lines in order, as text files that are read in the order of their names."""
    lines = render_codelist(df, escape=escape)
    lines.orderBy("seq", "line_no").select("line").write.mode("overwrite").text(path)


def export_codelist(spark: SparkSession, source: str, path: str, escape: bool = False) -> None:
    write_codelist(read_codelist(spark, source), path, escape)
