"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import IAMC_KEYS
from ..operators.issues import render_report
from ..operators.reshape import pivot_years
from ..plans.staging import stage


def write_iamc(
    long: DataFrame, path: str, layout: str = "long", years: Sequence[int] | None = None,
    on_duplicate: str = "quarantine",
) -> None:
    """Write a harmonised table, one folder per source model.

    ``long`` is the form to keep: Parquet, read by model. ``wide`` is CSV with
    one column per year of the whole run. ``per_model`` delivers one folder
    ``pyam_<model>`` per source model with that model's years only.
    """
    if layout == "long":
        _by_model(long).write.mode("overwrite").partitionBy("source_model").parquet(path)
    elif layout == "wide":
        table = pivot_years(long, years=years, on_duplicate=on_duplicate)
        _by_model(table).sortWithinPartitions(*IAMC_KEYS).write.mode("overwrite").partitionBy(
            "source_model"
        ).option("header", "true").csv(path)
    elif layout == "per_model":
        _write_per_model(long, path, on_duplicate)
    else:
        raise ValueError(f"unknown layout {layout!r}")


def _by_model(df: DataFrame) -> DataFrame:
    """Few files per model: Spark merges small partitions and splits a large model's."""
    return df.hint("rebalance", "source_model")


def _write_per_model(long: DataFrame, path: str, on_duplicate: str) -> None:
    """A folder per model with the years of that model.

    Models with the same set of years have the same columns and are written by
    one job, which deals its rows to the folders of their models; these are
    then moved to their place.
    """
    spark = long.sparkSession
    seen = long.filter(F.col("year").isNotNull()).select("source_model", "year").distinct()
    # A model's years are as few as a table can have columns.
    sets = stage(seen.groupBy("source_model").agg(F.sort_array(F.collect_set("year")).alias("years")), "years")
    for i, row in enumerate(sets.select("years").distinct().orderBy("years").collect()):
        models = sets.filter(F.col("years") == F.array(*map(F.lit, row["years"]))).select("source_model")
        part = long.join(models, "source_model", "left_semi")
        table = pivot_years(part, years=row["years"], on_duplicate=on_duplicate)
        folder = f"{path.rstrip('/')}/_years-{i}"
        table.orderBy("source_model", *IAMC_KEYS).write.mode("overwrite").partitionBy("source_model").option("header", "true").csv(folder)
        _move_models(spark, folder, path)


def _move_models(spark: SparkSession, folder: str, path: str) -> None:
    """Move ``folder/source_model=x`` to ``path/pyam_x`` for all models, without a look at their files."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in system.listStatus(hadoop.Path(folder)):
        name = status.getPath().getName()
        if name.startswith("source_model="):
            target = hadoop.Path(path, "pyam_" + name.removeprefix("source_model="))
            system.delete(target, True)
            system.rename(status.getPath(), target)
    system.delete(hadoop.Path(folder), True)


def write_report(issues: DataFrame, path: str) -> None:
    """Write the run report as text lines in order."""
    lines = render_report(issues).select(F.coalesce("line", F.lit("")).alias("line"))
    lines.write.mode("overwrite").text(path)


def write_regions(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)

