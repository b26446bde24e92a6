"""The given tables written out as delivered files, to run the jobs that start from files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenweave import load_specs
from scenweave.plans.staging import stage_folder
from scenweave.sources.files import list_files

from . import views as v


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the shared one."""
    return f"{stage_folder(spark)}/delivery-{uuid.uuid4().hex}"


def deliver(spark: SparkSession, sf: str) -> str:
    """Results as CSV files per model whose names follow the order of the rows."""
    folder = new_folder(spark)
    rows = v.results(spark, sf).select(
        "ord", F.col("scenario").alias("scen"), F.col("region").alias("AREA"),
        F.substring_index("original_variable", "|", 1).alias("Kind"),
        F.substring_index("original_variable", "|", -1).alias("Part No"),
        F.col("unit").alias("Unit"), F.col("year").alias("TIME"), F.col("value").alias("VAL"), "source_model",
    )
    (
        rows.repartitionByRange("ord").sortWithinPartitions("ord")
        .write.mode("overwrite").partitionBy("source_model").option("header", "true").option("sep", ";").csv(folder)
    )
    return folder


def overview(spark: SparkSession, folder: str) -> DataFrame:
    """One specification per delivered file, in the order of their names."""
    files = list_files(spark, folder).filter(F.col("path").endswith(".csv"))
    place = F.substring_index("path", "/", 1)
    return load_specs(
        files.orderBy("path").select(
            place.alias("File location"), F.substring_index("path", "/", -1).alias("File name"),
            F.substring_index(place, "=", -1).alias("Source model"), F.lit("").alias("Sheet name"),
            F.lit(";").alias("Separator"), F.lit("Kind|Part No").alias("Variable column"),
        )
    )
