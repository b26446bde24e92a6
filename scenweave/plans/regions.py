"""The region table with full region names."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ..operators.lookup import Dictionary
from ..operators.regions import normalize_regions, region_coverage, region_misses
from ..sources.dictionaries import read_dictionary_table
from ..sources.sinks import write_regions


class RegionTable(NamedTuple):
    table: DataFrame
    coverage: DataFrame
    misses: DataFrame


def convert_regions(
    spark: SparkSession, path: str, countries: DataFrame | Dictionary, out: str | None = None,
    column: str = "source_region", keep: tuple[str, ...] = (), **options,
) -> RegionTable:
    """Name the regions of a stored table and write it to ``<table>_regions_fullname``.

    ``options`` go to :func:`normalize_regions`. Other columns of the table
    stay; ``target_region`` is replaced.
    """
    table = read_dictionary_table(spark, path, keep=keep)
    if column not in table.columns:
        raise KeyError(f"region table has no column {column!r}")
    named = normalize_regions(table.drop("target_region"), countries, column, **options)
    stem = path.rstrip("/").rsplit("/", 1)
    target = out or "/".join([*stem[:-1], stem[-1].rsplit(".", 1)[0] + "_regions_fullname"])
    write_regions(named.orderBy("seq").drop("seq"), target)
    return RegionTable(named, region_coverage(named, column), region_misses(named, column))
