"""Projections and filters on one result table. All of them are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import CANONICAL, COLUMN_ALIASES, NA_TOKENS
from ..functions.text import as_text, join_parts, nullify, parse_rule, py_strip, to_number, to_year


class SpecError(ValueError):
    """A source cannot be read as its specification says."""


def alias_choice(
    names: Sequence[str], aliases: Mapping[str, Sequence[str]] = COLUMN_ALIASES
) -> dict[str, int]:
    """Position of the column that each canonical name takes; case-sensitive."""
    chosen = {}
    for canonical, variants in aliases.items():
        hit = next((v for v in variants if v in names), None)
        if hit is not None:
            chosen[canonical] = list(names).index(hit)
    return chosen


def canonicalize(
    df: DataFrame, aliases: Mapping[str, Sequence[str]] = COLUMN_ALIASES
) -> DataFrame:
    """Rename the first known spelling of each canonical column.

    A further column already carrying the canonical name (``Unit`` next to
    ``unit``) gives way to the chosen one.
    """
    names = df.columns
    chosen = alias_choice(names, aliases)
    taken = {i: c for c, i in chosen.items()}
    by_position = df.toDF(*[f"c{i}" for i in range(len(names))])
    return by_position.select(
        *[
            F.col(f"c{i}").alias(taken.get(i, name))
            for i, name in enumerate(names)
            if i in taken or name not in chosen
        ]
    )


def found_columns(df: DataFrame) -> list[str]:
    """Canonical columns a table has."""
    return [c for c in CANONICAL if c in df.columns]


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def drop_blank_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("all", subset=list(columns or df.columns))


def nullify_tokens(
    df: DataFrame, tokens: Sequence[str] = NA_TOKENS, keep: Sequence[str] = ()
) -> DataFrame:
    """NULL for missing-value spellings in text columns.

    ``keep=("region",)`` leaves a column alone, e.g. for the country code NA.
    """
    texts = {f.name for f in df.schema if f.dataType.typeName() == "string"} - set(keep)
    return df.select(
        *[nullify(F.col(f"`{n}`"), tokens).alias(n) if n in texts else F.col(f"`{n}`") for n in df.columns]
    )


def compose_variable(
    df: DataFrame,
    rule: str,
    sep: str = "|",
    null_text: str = "",
    trim: bool = True,
    into: str = "original_variable",
    originals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Variable name from the columns that ``rule`` names, joined by ``sep``.

    ``originals`` maps headers from before the renaming to the present ones,
    so that a rule may name either.
    """
    types = {f.name: f.dataType for f in df.schema}
    parts = [p if p in types else (originals or {}).get(p, p) for p in parse_rule(rule)]
    absent = [p for p in parts if p not in types]
    if absent:
        raise SpecError(f"no column {', '.join(map(repr, absent))}")
    texts = [as_text(F.col(f"`{p}`"), types[p]) for p in parts]
    return df.withColumn(into, variable_text(texts, sep, null_text, trim))


def variable_text(parts: Sequence[Column], sep: str, null_text: str, trim: bool) -> Column:
    if len(parts) > 1:
        text = join_parts(parts, sep, null_text)
    else:
        # A lone column has no filler where the parts of a joined name have one.
        text = F.coalesce(parts[0], F.lit("")) if trim else parts[0]
    return py_strip(text) if trim else text


def type_measures(df: DataFrame, value: str = "value", year: str = "year") -> DataFrame:
    """DOUBLE value and INT year; ``bad_value``/``bad_year`` flag what did not convert.

    A text value turns NULL and the row stays. A year that is missing or no
    whole number cannot become a year column: callers set such rows apart.
    """
    types = {f.name: f.dataType for f in df.schema}
    text = F.lit(None) if types[value].typeName() != "string" else F.lower(value)
    # Numbers first, flags on top of them: each cell is parsed once.
    parsed = df.withColumns(
        {
            "_number": to_number(F.col(value), types[value]),
            "_year": to_number(F.col(year), types[year]),
            "_text": F.nullif(F.nullif(text, F.lit("nan")), F.lit("-nan")),
        }
    )
    return parsed.withColumns(
        {
            value: F.col("_number"),
            year: to_year(F.col("_year")),
            "bad_value": F.col("_text").isNotNull() & F.col("_number").isNull(),
            "bad_year": to_year(F.col("_year")).isNull(),
        }
    ).drop("_number", "_year", "_text")


def project_spec(
    df: DataFrame,
    scenario: str,
    region: str,
    year: str,
    value: str,
    model: str | None = None,
    unit_column: str | None = None,
    unit: str | None = None,
) -> DataFrame:
    """Columns under the names a specification gives, with defaults for model and unit.

    ``model`` names a column where there is one of that name, and is the model
    itself otherwise.
    """
    def need(name: str) -> Column:
        if name not in df.columns:
            raise SpecError(f"no column {name!r}")
        return F.col(f"`{name}`")

    if model:
        model_column = need(model) if model in df.columns else F.lit(model)
    else:
        model_column = F.lit("Unknown Model")
    unit_value = need(unit_column) if unit_column else F.lit(unit or "undefined")
    named = {
        "scenario": need(scenario), "region": need(region), "year": need(year),
        "value": need(value), "model": model_column, "unit": unit_value,
    }
    rest = [c for c in ("variable", "original_variable") if c in df.columns]
    return df.select(*[c.alias(n) for n, c in named.items()], *rest)


def require(df: DataFrame, columns: Sequence[str] = ("variable", "region", "scenario")) -> DataFrame:
    return df.dropna("any", subset=list(columns))


def to_iamc_long(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return df.select(*carry, "model", "scenario", "region", "variable", "unit", "year", "value")


def unpivot_values(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str] | None = None,
    name: str = "year", value: str = "value",
) -> DataFrame:
    """One row per id and column; null cells stay."""
    columns = list(columns or [c for c in df.columns if c not in ids])
    return df.unpivot(list(ids), columns, name, value)


def union_sources(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def first_per_group(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row of each group."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.col(order)).alias("first"))
        .select(*keys, *[F.col("first").getField(c).alias(c) for c in rest])
    )
