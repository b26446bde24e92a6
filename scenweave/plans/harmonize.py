"""From delivered tables to one harmonised table and the report on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import COLUMN_ALIASES, IAMC_KEYS, ORDER
from ..operators.columns import union_sources
from ..operators.duplicates import CHUNK_BITS, KEYS, duplicate_counters, resolve_duplicates
from ..operators.issues import issue, unmapped_issues
from ..operators.lookup import Dictionary, attach, map_model, measure_all
from ..operators.reshape import assert_unique, distinct_years, pivot_years
from ..operators.unmapped import unmapped
from ..sources.specs import load_specs, number
from ..sources.tables import ReadStyle, all_rows, locate_specs, plan_scans, scan_all
from .staging import stage

TARGETS = {
    "Variables": ("original_variable", "_variable"),
    "Regions": ("region", "_region"),
    "Scenarios": ("scenario", "_scenario"),
    "Units": ("unit", "_unit"),
}


@dataclass(frozen=True)
class Harmonized:
    """A harmonised table; the parts of its report are planned when asked for.

    ``can_collide`` tells whether a region of the dictionary can be mistaken
    for a numbered duplicate.
    """

    looked_up: DataFrame
    data: DataFrame
    order: tuple[str, ...]
    scope: tuple[str, ...]
    null_policy: str
    chunk_bits: int
    can_collide: bool

    @cached_property
    def long(self) -> DataFrame:
        """The result."""
        return resolve_duplicates(
            self.data, KEYS, self.order, null_policy=self.null_policy, chunk_bits=self.chunk_bits
        )

    @cached_property
    def misses(self) -> DataFrame:
        """Keys the dictionaries lack, from all rows, also those that leave."""
        return unmapped(good_rows(self.looked_up), TARGETS, scope=self.scope, order=self.order)

    @cached_property
    def counters(self) -> DataFrame:
        """Duplicate rows per source model."""
        return duplicate_counters(self.data, KEYS)


def look_up(rows: DataFrame, dictionaries: Mapping[str, DataFrame | Dictionary]) -> DataFrame:
    """Add the translations next to the source names, so that the report sees both."""
    rows = attach(rows, dictionaries["variables"], "original_variable", {"target": "_variable"})
    rows = attach(rows, dictionaries["regions"], "region", {"target": "_region"})
    rows = attach(rows, dictionaries["scenarios"], "scenario", {"target": "_scenario"})
    rows = attach(rows, dictionaries["units"], "unit", {"target": "_unit", "factor": "_factor"})
    if "model" not in rows.columns:
        rows = map_model(rows, dictionaries["models"]).drop("model_known")
    return rows


def good_rows(rows: DataFrame) -> DataFrame:
    """Without the rows that the scan could not take apart."""
    return rows.filter(~F.col("bad_row")) if "bad_row" in rows.columns else rows


def mapped_rows(looked_up: DataFrame, order: Sequence[str], keep_original_unit: bool = False) -> DataFrame:
    """Rows all of whose keys have a translation, in canonical form."""
    unit = F.coalesce("_unit", "unit") if keep_original_unit else F.col("_unit")
    value = F.col("value").cast("double") * F.coalesce("_factor", F.lit(1.0))
    return good_rows(looked_up).filter(
        F.col("_variable").isNotNull() & F.col("_region").isNotNull() & F.col("_scenario").isNotNull()
        & F.col("year").isNotNull()
    ).select(
        "source_model", "model",
        F.col("_scenario").alias("scenario"), F.col("_region").alias("region"),
        F.col("_variable").alias("variable"), unit.alias("unit"), "year",
        # A NaN would count as a value of its own among duplicates.
        F.when(~F.isnan(value), value).alias("value"),
        *order,
    )


def harmonize_rows(
    rows: DataFrame,
    dictionaries: Mapping[str, DataFrame | Dictionary],
    order: Sequence[str] = ORDER,
    scope: Sequence[str] = ("source_model",),
    keep_original_unit: bool = False,
    null_policy: str = "reference",
    chunk_bits: int = CHUNK_BITS,
    stage_rows: bool = False,
) -> Harmonized:
    """Harmonise a table of canonical rows.

    ``rows`` has ``source_model, scenario, region, unit, year, value,
    original_variable``, the ``order`` columns and the ``scope`` columns by
    which missing keys are reported. With ``stage_rows`` the looked-up rows are
    written to the shared folder once; the result and the report then both
    start from there and the sources are read a single time.
    """
    pending = {n: d for n, d in dictionaries.items() if not isinstance(d, Dictionary)}
    measured = {**dictionaries, **(measure_all(pending) if pending else {})}
    looked_up = look_up(rows, measured)
    if stage_rows:
        looked_up = stage(looked_up, "looked-up")
    data = mapped_rows(looked_up, order, keep_original_unit)
    return Harmonized(
        looked_up, data, tuple(order), tuple(scope), null_policy, chunk_bits,
        can_collide=measured["regions"].dup_targets > 0,
    )


def to_wide(
    result: Harmonized | DataFrame, years: Sequence[int] | None = None, sort: bool = False
) -> DataFrame:
    """One column per year.

    After the duplicates are resolved two rows can only meet in one cell if a
    region of the dictionary is itself called ``dup_...``. Only then the
    pivot looks for it and withholds the model.
    """
    if isinstance(result, Harmonized):
        # Each key keeps a row, so the years are known before the duplicates are resolved.
        years = distinct_years(result.data) if years is None else years
        policy = "quarantine" if result.can_collide else "ignore"
        return pivot_years(result.long, years=years, on_duplicate=policy, sort=sort)
    return pivot_years(result, years=years, sort=sort)


def pivot_issues(long: DataFrame) -> DataFrame:
    """Models that cannot be turned into a wide table."""
    failed = assert_unique(long, ["source_model", *IAMC_KEYS, "year"]).groupBy("source_model").agg(
        F.count(F.lit(1)).alias("n")
    )
    text = F.concat(F.col("n").cast("string"), F.lit(" cells with several rows, no wide table for "), "source_model")
    return issue(failed, {"stage": "pivot", "severity": "error", "message": text, "n": F.col("n")})


def duplicate_issues(counters: DataFrame) -> DataFrame:
    def kind(place: int, count: str, text: str, severity: str = "warning") -> dict:
        message = F.concat(F.col(count).cast("string"), F.lit(text))
        return {"when": F.col(count) > 0, "stage": "duplicates", "severity": severity, "message": message,
                "n": F.col(count), "row": place}

    none = {"when": F.col("duplicates") == 0, "stage": "duplicates", "severity": "info",
            "message": "no duplicates", "n": 0, "row": 0}
    return issue(
        counters, none,
        kind(1, "duplicates", " rows in duplicate groups"),
        kind(2, "removed", " identical rows removed", "info"),
        kind(3, "renamed", " differing rows renamed"),
    )


#: Kinds of rows that are counted per source.
ROW_KINDS = ("kept", "bad_row", "bad_value", "bad_year", "bad_text")


def counted_rows(looked_up: DataFrame, scope: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Missing keys, and rows of each of ``ROW_KINDS`` per source, from one pass over the looked-up rows, written once.

    Keys are missed by all good rows, also by those that leave.
    """
    good = ~F.col("bad_row")
    kept = good & F.col("_variable").isNotNull() & F.col("_region").isNotNull() & F.col("_scenario").isNotNull()
    flags = {"kept": kept, "bad_row": F.col("bad_row")} | {k: good & F.col(k) for k in ROW_KINDS[2:]}
    found = stage(unmapped(looked_up, TARGETS, scope=scope, order=order, flags={f"#{k}": v for k, v in flags.items()}, among=good), "counted")
    counts = found.filter(F.col("label").startswith("#")).groupBy("spec_id").agg(
        *[F.sum(F.when(F.col("label") == f"#{k}", F.col("n"))).alias(k) for k in ROW_KINDS])
    return found.filter(~F.col("label").startswith("#")), counts


def source_issues(counts: DataFrame, specs: DataFrame) -> DataFrame:
    """Per source that was read: cells that did not convert, no rows left, model not in the dictionary."""
    survives = F.coalesce("kept", F.lit(0)) > 0

    def kind(place: int, count: str, text: str, severity: str) -> dict:
        message = F.concat(F.col(count).cast("string"), F.lit(text))
        return {"when": F.col(count) > 0, "stage": "values", "severity": severity, "message": message,
                "n": F.col(count), "row": place}

    return issue(
        specs.join(counts, "spec_id", "left"),
        kind(0, "bad_row", " rows have more fields than the header and are left out", "error"),
        kind(1, "bad_value", " values are no numbers and count as missing", "warning"),
        kind(2, "bad_year", " rows have no whole-number year and are left out", "error"),
        kind(3, "bad_text", " rows hold characters that are not written in the encoding of the file", "error"),
        {"when": ~survives, "stage": "empty", "severity": "info", "message": F.concat(F.lit("no valid data in "), "file")},
        {"when": survives & ~F.col("model_known"), "stage": "model", "severity": "warning",
         "message": F.concat(F.lit("source model "), "source_model", F.lit(" is not in the dictionary"))},
    )


@dataclass(frozen=True)
class Run:
    """Result of a run on files. ``harmonized`` is None if no source could be read.

    ``planned`` are the issues found before any row was read, ``specs`` the
    sources that were read and ``absent`` the keys (``spec_id, label``) that a
    source has no column for.
    """

    harmonized: Harmonized | None
    planned: DataFrame
    specs: DataFrame
    absent: DataFrame

    @property
    def long(self) -> DataFrame | None:
        return self.harmonized.long if self.harmonized else None

    @cached_property
    def issues(self) -> DataFrame:
        """Everything the run has to report: one pass over the looked-up rows, and one over the mapped ones for duplicates."""
        result = self.harmonized
        if result is None:
            return self.planned
        missed, counts = counted_rows(result.looked_up, result.scope, result.order)
        misses = missed.join(self.specs.select("spec_id", "file"), "spec_id").join(self.absent, ["spec_id", "label"], "left_anti")
        return union_sources([
            self.planned,
            source_issues(counts, self.specs),
            unmapped_issues(misses),
            duplicate_issues(result.counters),
        ] + ([pivot_issues(result.long)] if result.can_collide else []))


def harmonize(
    spark: SparkSession,
    root: str,
    specs: DataFrame,
    dictionaries: Mapping[str, DataFrame],
    aliases: Mapping[str, Sequence[str]] = COLUMN_ALIASES,
    style: ReadStyle = ReadStyle(),
    strict_names: bool = False,
    keep_original_unit: bool = False,
    null_policy: str = "reference",
    chunk_bits: int = CHUNK_BITS,
    stage_rows: bool = False,
) -> Run:
    """Harmonise the tables that an overview lists below ``root``.

    ``dictionaries`` are loaded ones. Planning reads the file list and the
    headers, and writes what it found about each source; the rows themselves
    are read when the result is written. The overview may have any length:
    it stays a table, of which the driver sees the distinct layouts. A source
    with a blank variable rule has variables as columns.
    """
    numbered = number(specs if "seq" in specs.columns else load_specs(specs), ["seq"], "spec_id", "specs")
    measured = measure_all(dictionaries)
    # The model is a property of the source: translated once per source, not per row.
    known = map_model(numbered, measured["models"], "Source model")
    plan = plan_scans(locate_specs(spark, root, known), aliases, strict_names, measured["variables"].frame)
    scans, read, refused = scan_all(spark, plan, {"source_model": "Source model", "model": "model"}, style)
    named = plan.sources.withColumnsRenamed({"Source model": "source_model", "File name": "file"})
    titles = issue(
        named.select("spec_id", "source_model", "file").distinct(), {"stage": "source", "severity": "info"})
    used = named.filter(F.col("layout").isin(read)) if read else named.limit(0)
    none = lambda role, label: F.when(~F.array_contains("found", role), F.lit(label))
    absent = used.select("spec_id", F.explode(F.array_compact(F.array(none("region", "Regions"), none("scenario", "Scenarios")))).alias("label"))
    result = None
    if scans:
        result = harmonize_rows(
            all_rows(scans), measured, ORDER, ("source_model", "spec_id"), keep_original_unit, null_policy, chunk_bits, stage_rows)
    return Run(
        result, union_sources([titles, plan.issues, refused]), used.select("spec_id", "source_model", "file", "model_known").distinct(),
        absent.distinct())
