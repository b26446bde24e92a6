"""Region codes to region names."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import CUSTOM_REGIONS
from ..functions.text import pct, py_strip
from .lookup import Dictionary, attach

#: Up to so many name patterns are constants of one projection; more are looked up by the letters that they need.
FEW_PATTERNS = 16
#: Letters of an index entry.
GRAM = 3


def country_codes(countries: DataFrame, codes: Sequence[str], name: str) -> DataFrame:
    """Lookup of every code spelling to the country name.

    ``countries`` has one row per country, e.g. the ISO 3166 list with its
    two-letter, three-letter and numeric codes. A code of several countries
    names none of them.
    """
    spelled = countries.select(
        F.col(name).alias("target"),
        F.explode(F.array(*[F.upper(py_strip(F.col(c).cast("string"))) for c in codes])).alias("source"),
    )
    return (
        spelled.filter(F.col("source").isNotNull() & (F.col("source") != ""))
        .groupBy("source")
        .agg(F.min("target").alias("target"), F.max("target").alias("last"))
        .select("source", F.when(F.col("target") == F.col("last"), F.col("target")).alias("target"))
    )


def _pattern_match(name: Column, patterns: Mapping[str, str]) -> Column:
    """Name of the one country whose pattern fits; the patterns are constants of one projection."""
    hits = F.array_distinct(
        F.array_compact(
            F.array(*[F.when(name.rlike(f"(?i){p}"), F.lit(target)) for p, target in patterns.items()])
        )
    )
    return F.when(F.size(hits) == 1, F.try_element_at(hits, F.lit(1)))


def needed_grams(pattern: str) -> set[str] | None:
    """Letter groups of which every name that fits the pattern has one, in lower case; None if nothing is needed.

    Only what must be there counts: runs of plain characters outside of options
    and repetitions. Of several runs the longest is taken, of alternatives
    one each.
    """
    if re.search(r"\\Q|\(\?[A-Za-z]*x", pattern):
        return None  # other rules hold in quoted and spaced patterns
    # What any parser of such patterns must tell apart: an escape, a class, a quantifier, a group, a plain character.
    tokens = re.findall(r"\\.|\[\^?\]?(?:\\.|[^\]])*\]|\{\d+(?:,\d*)?\}[?+]?|[*+?][?+]?|\(\?(?:[:=!>]|<[=!]|[A-Za-z-]+[:)])|.", pattern, re.DOTALL)
    alternatives, runs, depth, run = [], [], 0, ""

    def close() -> None:
        nonlocal run
        runs.append(run)
        run = ""

    for i, token in enumerate(tokens):
        after = tokens[i + 1] if i + 1 < len(tokens) else ""
        if token.startswith("("):
            close()
            if not token.endswith(")"):
                depth += 1
        elif token == ")":
            close()
            depth -= 1
        elif depth:
            continue  # what stands in a group may be one of several things
        elif token == "|":
            close()
            alternatives.append(runs)
            runs = []
        elif after[:1] in ("*", "?") or after.startswith("{"):
            close()
        elif len(token) == 1 and token not in ".^$*+?":
            run += token.lower()
            if after[:1] == "+":
                close()
        elif len(token) == 2 and token[0] == "\\" and not token[1].isalnum():
            run += token[1]
        else:
            close()
    close()
    alternatives.append(runs)
    longest = [max(runs, key=len) for runs in alternatives]
    # Lower case of other letters differs between programs, so only ASCII is relied upon.
    parts = [max(re.split(r"[^\x00-\x7f]", run), key=len) for run in longest]
    return {part[:GRAM] for part in parts} if all(len(part) >= GRAM for part in parts) else None


def pattern_names(names: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """``source, target`` for each name (column ``source``, distinct) that the patterns of exactly one target fit.

    Patterns are posted under letters that they need; a name meets those of its
    own letters only, and is held against these alone. Patterns that need no
    letters are held against every name.
    """
    spark = names.sparkSession
    grams = {p: needed_grams(p) for p in patterns}
    posted = [(g, p, patterns[p]) for p, needed in grams.items() for g in sorted(needed or ())]
    free = {p: t for p, t in patterns.items() if grams[p] is None}
    index = spark.createDataFrame(posted, "gram string, pattern string, target string")
    lower = F.lower("source")
    each = F.transform(F.sequence(F.lit(1), F.length(lower) - (GRAM - 1)), lambda i: F.substr(lower, i, F.lit(GRAM)))
    met = (
        names.filter(F.length("source") >= GRAM).select("source", F.explode(F.array_distinct(each)).alias("gram"))
        .join(F.broadcast(index), "gram")  # as many entries as the caller gave patterns
        .filter(F.rlike("source", F.concat(F.lit("(?i)"), "pattern"))).select("source", "target")
    )
    if free:
        hits = F.array_compact(F.array(*[F.when(F.col("source").rlike(f"(?i){p}"), F.lit(t)) for p, t in free.items()]))
        met = met.union(names.select("source", F.explode(hits)))
    one = met.groupBy("source").agg(F.min("target").alias("target"), F.max("target").alias("last"))
    return one.filter(F.col("target") == F.col("last")).select("source", "target")


def normalize_regions(
    df: DataFrame,
    countries: DataFrame | Dictionary,
    column: str = "source_region",
    into: str = "target_region",
    custom: Mapping[str, str] = CUSTOM_REGIONS,
    patterns: Mapping[str, str] | None = None,
    on_miss: str = "null",
) -> DataFrame:
    """Own region names first, then country codes, then name patterns.

    Codes compare without regard to case. ``on_miss="passthrough"`` keeps a
    name that nothing fits; a blank cell stays NULL either way. A name that
    the patterns of two countries fit names none of them.
    """
    if on_miss not in ("null", "passthrough"):
        raise ValueError(f"unknown on_miss {on_miss!r}")
    name = F.when(py_strip(F.col(column)) != "", py_strip(F.col(column)))
    rows = df.withColumn("_name", name).withColumn("_code", F.upper("_name"))
    rows = attach(rows, countries, "_code", {"target": "_country"})
    found = [F.col("_country")]
    if custom:
        table = F.create_map(*[F.lit(x) for entry in custom.items() for x in entry])
        found.insert(0, F.try_element_at(table, F.col("_name")))
    if patterns and len(patterns) <= FEW_PATTERNS:
        found.append(_pattern_match(F.col("_name"), patterns))
    elif patterns:
        open_ = rows.filter(F.coalesce(*found).isNull() & F.col("_name").isNotNull())
        names = open_.select(F.col("_name").alias("source")).distinct()
        rows = attach(rows, pattern_names(names, patterns), "_name", {"target": "_fitted"})
        found.append(F.col("_fitted"))
    if on_miss == "passthrough":
        found.append(F.col("_name"))
    return rows.withColumn(into, F.coalesce(*found)).drop("_name", "_code", "_country", "_fitted")


def region_coverage(df: DataFrame, column: str = "source_region", into: str = "target_region") -> DataFrame:
    """Filled cells, converted ones and their percentage."""
    return df.agg(
        F.count_if(F.col(column).isNotNull() & (F.col(column) != "")).alias("total"),
        F.count(into).alias("converted"),
    ).withColumn("percent", pct(F.col("converted"), F.col("total")))


def region_misses(df: DataFrame, column: str = "source_region", into: str = "target_region") -> DataFrame:
    """Distinct names without a region, sorted."""
    missing = df.filter(F.col(into).isNull() & F.col(column).isNotNull())
    return missing.select(column).distinct().orderBy(column)


def custom_shadows(countries: DataFrame, custom: Mapping[str, str] = CUSTOM_REGIONS) -> DataFrame:
    """Country codes that an own region name of the same spelling hides."""
    hidden = reduce(lambda a, b: a | b, [F.col("source") == c.upper() for c in custom], F.lit(False))
    return countries.filter(hidden)
