"""Years to columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import IAMC_KEYS
from ..plans.staging import stage
from .lookup import BROADCAST_ROWS, salted_join


def distinct_years(df: DataFrame, year: str = "year") -> list[int]:
    """Years of a table, ascending (runs a job; each becomes a column, so there are as few as a table can have columns)."""
    return sorted(r[0] for r in df.select(year).filter(F.col(year).isNotNull()).distinct().collect())


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def pivot_years(
    df: DataFrame, keys: Sequence[str] = IAMC_KEYS, years: Sequence[int] | None = None,
    year: str = "year", value: str = "value", scope: str | None = "source_model",
    on_duplicate: str = "quarantine", sort: bool = False,
) -> DataFrame:
    """One row per key and one column per year.

    A cell with two rows is an error of its ``scope``: all rows of that scope
    are withheld (``quarantine``), the job fails (``raise``) or the larger
    value is taken (``ignore``). The check is part of the one aggregation that
    builds the columns, so the whole pivot is one shuffle. To withhold scopes,
    its result is written to the shared folder and read again.
    """
    if on_duplicate not in ("quarantine", "raise", "ignore"):
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    years = list(years) if years is not None else distinct_years(df, year)
    by = list(dict.fromkeys([*([scope] if scope else []), *keys]))
    names = [str(y) for y in years]
    cells = [F.max(F.when(F.col(year) == y, F.col(value))).alias(n) for y, n in zip(years, names)]
    used = [F.count(F.when(F.col(year) == y, 1)) for y in years]
    crowded = (F.greatest(*used) if len(used) > 1 else used[0] if used else F.lit(0)) > 1
    table = df.groupBy(*by).agg(*cells, crowded.alias("_crowded"))
    if on_duplicate == "quarantine" and scope:
        # Written once: the failing scopes are counted from one column of it, and usually there is none to leave out.
        table = stage(table.withColumn("_scope", F.struct(scope)), "pivot")
        failed = table.filter("_crowded").select("_scope").distinct()
        n = failed.count()
        if 0 < n <= BROADCAST_ROWS:
            table = table.join(F.broadcast(failed), "_scope", "left_anti")
        elif n:
            table = salted_join(table, failed, ["_scope"], "left_anti", spread=by)
    elif on_duplicate == "raise":
        table = table.withColumn(
            "_crowded", F.when(F.col("_crowded"), F.raise_error("duplicate cell in pivot")).otherwise(False)
        ).filter(~F.col("_crowded"))
    table = table.select(*by, *names)
    return table.orderBy(*by) if sort else table


def pivot_sum(
    df: DataFrame, keys: Sequence[str] = IAMC_KEYS, years: Sequence[int] | None = None,
    year: str = "year", value: str = "value", sort: bool = False,
) -> DataFrame:
    """Sum per key and year, one column per year.

    Rows with a NULL key or year leave; a cell of NULLs only is 0, a cell
    without rows NULL.
    """
    df = df.dropna("any", subset=[*keys, year])
    years = list(years) if years is not None else distinct_years(df, year)
    cells = [
        F.when(
            F.count(F.when(F.col(year) == y, 1)) > 0,
            F.coalesce(F.sum(F.when(F.col(year) == y, F.col(value))), F.lit(0.0)),
        ).alias(str(y))
        for y in years
    ]
    table = df.groupBy(*keys).agg(*cells) if cells else df.select(*keys).distinct()
    return table.orderBy(*keys) if sort else table
