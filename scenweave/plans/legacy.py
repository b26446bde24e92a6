"""The older conversion: one map per source, sums instead of duplicate handling.

It differs from the present one in parameters only: parts joined by `` | ``
with ``nan`` for a missing one, untrimmed; regions kept where the map lacks
them; several rows of one cell added up.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import IAMC_KEYS, ORDER
from ..operators.columns import require, union_sources
from ..operators.issues import issue, unmapped_issues
from ..operators.lookup import BROADCAST_ROWS, Dictionary, map_by_spec, map_lenient, measure, salted_join
from ..operators.reshape import pivot_sum
from ..operators.unmapped import unmapped
from ..sources.specs import load_specs, number
from ..sources.tables import (
    ReadStyle, ScanPlan, layouts_of, locate_specs, no_issues, position, quoted, rule_parts, scan_all, unreadable, visible_names,
)

LEGACY_STYLE = ReadStyle(sep=" | ", null_text="nan", trim=False, blank_rows=True)


class LegacyRun(NamedTuple):
    long: DataFrame | None
    issues: DataFrame


def legacy_rows(
    rows: DataFrame, mapping: DataFrame, regions: DataFrame | Dictionary | None = None,
    spec: Sequence[str] = ("spec_id",),
) -> DataFrame:
    """Translate variables by the map of their own source, and regions where one is known.

    ``spec`` are the columns that tell sources apart; ``mapping`` has the ones
    its entries are valid for.
    """
    mapped = map_by_spec(rows, mapping, spec=[c for c in spec if c in mapping.columns])
    if regions is not None:
        mapped = map_lenient(mapped, "region", regions)
    return mapped.select(*spec, *IAMC_KEYS, "year", "value")


def legacy_wide(
    long: DataFrame, spec: Sequence[str] = ("spec_id",), years: Sequence[int] | None = None,
    sort: bool = False,
) -> DataFrame:
    """Sums per cell, each source by itself."""
    return pivot_sum(long, [*spec, *IAMC_KEYS], years=years, sort=sort)


def write_legacy(long: DataFrame, path: str) -> None:
    """Write the wide table, one folder ``output=pyam_<model>-<file>`` per source."""
    wide = legacy_wide(long, ["spec_id", "output"]).drop("spec_id")
    wide.hint("rebalance", "output").write.mode("overwrite").partitionBy("output").option("header", "true").csv(path)


def plan_legacy(located: DataFrame) -> ScanPlan:
    """Work out each source's columns, which are those the specification names."""
    df = located.withColumn("seen", visible_names(legacy=True)).withColumn("problem", unreadable())
    named = {
        "scenario": F.col("Source Scenario"), "region": F.col("Source Region"), "year": F.col("Source Year"), "value": F.col("Source Value"),
        "unit": F.nullif("Source Unit", F.lit("")), "model": F.col("Source model"),
    }
    needed = F.array_compact(F.array(*[c for n, c in named.items() if n != "model"]))
    df = df.withColumn("rule", rule_parts(F.col("Variable column"))).withColumns({
        "parts": F.transform("rule", lambda p: position(F.col("seen"), p)),
        "positions": F.array(*[position(F.col("seen"), c) for c in named.values()]),
    }).withColumn("missing", F.filter(F.concat("rule", needed), lambda n: position(F.col("seen"), n).isNull()))
    fine = F.col("problem").isNull()
    keyed, layouts = layouts_of(df.withColumn("usable", fine & (F.size("missing") == 0)), list(named))
    issues = issue(
        keyed.withColumnsRenamed({"Source model": "source_model", "File name": "file"}),
        {"when": ~fine, "stage": "read", "severity": "error", "message": F.col("problem")},
        {"when": fine & (F.size("missing") > 0), "stage": "columns", "severity": "error",
         "message": F.concat(F.lit("no column "), quoted(F.col("missing")), F.lit(", source skipped"))},
    ).distinct()
    return ScanPlan(keyed, layouts, issues)


def harmonize_legacy(
    spark: SparkSession, root: str, specs: DataFrame, regions: DataFrame | None = None,
    style: ReadStyle = LEGACY_STYLE,
) -> LegacyRun:
    """Convert the tables of a legacy overview, which holds the variable map as well.

    Rows of the overview for the same file and model belong together; the
    first of them says how the file is read. Every row that does not reach the
    result is in the report: by its variable, or counted by what it lacks.
    """
    overview = specs if "seq" in specs.columns else load_specs(specs, legacy=True)
    by = ["File location", "File name", "Source model"]
    heads = number(
        overview.groupBy(*by).agg(F.min_by(F.struct(*[c for c in overview.columns if c not in by]), "seq").alias("head")).select(*by, "head.*"),
        by, "spec_id", "specs")
    mapping = overview.join(heads.select("spec_id", *by), by).select(
        "spec_id", F.col("Variable value (original)").alias("source"), F.col("Variable name (new)").alias("target"), "seq")
    blank = lambda name, text: F.when(F.col(name) == "", text).otherwise(F.col(name))
    located = locate_specs(spark, root, heads.withColumns({
        "model_text": blank("Source model", "Unknown Model"), "unit_text": blank("Unit", "undefined"),
        "output": F.concat(F.lit("pyam_"), "Source model", F.lit("-"), F.regexp_replace("File name", r"\.[^.]*$", "")),
    }))
    plan = plan_legacy(located)
    carry = {
        "source_model": "Source model", "file": "File name", "output": "output",
        "model_text": "model_text", "unit_text": "unit_text",
    }
    scans, read, refused = scan_all(spark, plan, carry, style)
    planned = union_sources([plan.issues, refused])
    if not scans:
        return LegacyRun(None, planned)
    rows = union_sources([
        scan.withColumns({
            name: F.col(name) if dict(layout.roles)[name] >= 0 else F.col(f"{name}_text") for name in ("model", "unit")
        }) for layout, scan in scans
    ])
    map_regions = measure(regions) if regions is not None else None
    long = legacy_rows(rows.filter(~F.col("bad_row")), mapping, map_regions, ["spec_id", "output"])

    flagged = _flag_variables(rows, mapping)
    good = flagged.filter(~F.col("bad_row"))
    scope = ["source_model", "spec_id", "file"]
    misses = unmapped(good, {"Variables": ("original_variable", "_known")}, scope=scope, order=ORDER)
    kept = no_issues(spark)
    if map_regions is not None:
        known = map_regions.frame.select(F.col("source").alias("key"))
        found = (
            require(good, ["_known"]).filter(F.col("region").isNotNull())
            .groupBy(*scope, F.col("region").alias("key")).agg(F.count(F.lit(1)).alias("n"))
            .join(known, "key", "left_anti")
        )
        kept = issue(found, {"stage": "Regions", "severity": "warning", "message": F.concat("key", F.lit(" (kept)"))})
    sources = plan.sources.filter(F.col("layout").isin(read)).withColumnsRenamed({"Source model": "source_model", "File name": "file"})
    return LegacyRun(long, union_sources([planned, unmapped_issues(misses), kept, legacy_issues(flagged, sources.select(*scope).distinct())]))


def legacy_issues(flagged: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: rows left out or changed, by reason, and whether anything is left."""
    good = ~F.col("bad_row")
    mapped = good & F.col("_known").isNotNull()
    whole = F.col("model").isNotNull() & F.col("scenario").isNotNull() & F.col("region").isNotNull() & F.col("unit").isNotNull()
    counts = flagged.groupBy("spec_id").agg(
        F.count_if(mapped).alias("kept"), F.count_if("bad_row").alias("bad_row"), F.count_if(good & F.col("bad_text")).alias("bad_text"),
        F.count_if(mapped & F.col("bad_value")).alias("bad_value"), F.count_if(mapped & F.col("bad_year")).alias("bad_year"),
        F.count_if(mapped & ~F.col("bad_year") & ~whole).alias("no_key"),
    )

    def kind(place: int, count: str, text: str, severity: str) -> dict:
        message = F.concat(F.col(count).cast("string"), F.lit(text))
        return {"when": F.col(count) > 0, "stage": "values", "severity": severity, "message": message, "n": F.col(count), "row": place}

    return issue(
        sources.join(counts, "spec_id", "left"),
        kind(0, "bad_row", " rows have more fields than the header and are left out", "error"),
        kind(1, "bad_value", " values are no numbers and count as missing", "warning"),
        kind(2, "bad_year", " rows have no whole-number year and are left out", "error"),
        kind(3, "bad_text", " rows hold characters that are not written in the encoding of the file", "error"),
        kind(4, "no_key", " rows lack model, scenario, region or unit and are left out", "error"),
        {"when": F.coalesce("kept", F.lit(0)) == 0, "stage": "empty", "severity": "info", "message": F.concat(F.lit("no valid data in "), "file")},
    )


def _flag_variables(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mark rows whose variable the map of their source has."""
    known = mapping.select(
        "spec_id", F.col("source").alias("original_variable"), F.lit(True).alias("_known")
    ).distinct()
    on = ["spec_id", "original_variable"]
    if known.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(known), on, "left")
    return salted_join(rows, known, on, spread=ORDER)
