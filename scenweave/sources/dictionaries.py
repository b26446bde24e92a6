"""Dictionary tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import DICTIONARY_COLUMNS
from ..operators.columns import nullify_tokens
from ..operators.lookup import load_dictionary


def read_dictionary_table(
    spark: SparkSession, path: str, sep: str = ",", keep: Sequence[str] = ()
) -> DataFrame:
    """A dictionary sheet stored as CSV or Parquet, with its row order in ``seq``.

    Cells that spell a missing value are NULL, but for the ``keep`` columns.
    """
    if path.rstrip("/").lower().endswith(".parquet"):
        df = spark.read.parquet(path)
        order = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    else:
        df = spark.read.options(header="true", sep=sep, quote='"', escape='"').csv(path)
        order = F.struct(
            F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
        )
    df = df.select("*", order.alias("seq"))
    return nullify_tokens(df, keep=keep)


def load_dictionaries(tables: Mapping[str, DataFrame], seq: str = "seq") -> dict[str, DataFrame]:
    """The five dictionaries from tables under their published column names."""
    loaded = {}
    for name, (source, target, factor) in DICTIONARY_COLUMNS.items():
        if name not in tables:
            raise KeyError(f"no dictionary {name!r}")
        table = tables[name]
        loaded[name] = load_dictionary(table, source, target, factor, [seq] if seq in table.columns else None)
    return loaded
