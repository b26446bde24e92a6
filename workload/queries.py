"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenweave import catalog_files, harmonize, harmonize_rows, legacy_rows, legacy_wide, to_wide
from scenweave import operators as op
from scenweave.functions import as_text, issue_text, one_line, pct, py_strip
from scenweave.operators.duplicates import KEYS
from scenweave.operators.issues import unmapped_issues
from scenweave.plans.harmonize import TARGETS, duplicate_issues, look_up, mapped_rows
from scenweave.sources.files import derive_source_model, locate
from scenweave.sources.specs import spec_summary

from . import deliveries
from . import views as v
from .jobs import JOBS

Query = Callable[[SparkSession, str], DataFrame]

PATTERNS = {r"^nation\W*0*7$": "Seven", r"^nation\W*1[0-9]$": "Teens", r"^nation\W*12$": "Twelve"}


# --- dictionaries -----------------------------------------------------------

def dictionary_last_wins(spark, sf):
    part = v.table(spark, sf, "part").withColumn("target", F.nullif("p_type", F.lit("PROMO")))
    return op.load_dictionary(part, "p_name", "target", seq=["p_partkey"])


def dictionary_units(spark, sf):
    part = v.table(spark, sf, "part").select(
        F.nullif("p_brand", F.lit("Brand#3")).alias("b"), F.nullif("p_type", F.lit("PROMO")).alias("t"),
        F.nullif("p_size", F.lit(7)).cast("double").alias("f"), "p_partkey",
    )
    return op.load_dictionary(part, "b", "t", "f", ["p_partkey"])


def dictionary_summary(spark, sf):
    return op.dictionary_summary({
        "parts": dictionary_last_wins(spark, sf),
        "units": dictionary_units(spark, sf),
        "regions": v.regions(spark, sf),
    })


# --- lookups ----------------------------------------------------------------

def map_strict_region(spark, sf):
    return op.map_strict(v.results(spark, sf), "region", v.regions(spark, sf), "Regions").rows.select(
        "ord", "source_model", "region", "value"
    )


def map_strict_issues(spark, sf):
    misses = op.map_strict(
        v.results(spark, sf), "region", v.regions(spark, sf), "Regions", scope=["source_model"], order=["ord"]
    ).issues
    return misses.select("source_model", "label", "key", "unit", "units", "n", F.col("first.ord").alias("first_ord"))


def map_lenient_region(spark, sf):
    return op.map_lenient(v.results(spark, sf), "region", v.regions(spark, sf)).select("ord", "region", "value")


def map_by_spec(spark, sf):
    rows = v.results(spark, sf)
    return op.map_by_spec(rows, spec_map(spark, sf), spec=["source_model"]).select("ord", "source_model", "variable", "value")


def spec_map(spark, sf):
    """A variable map per model, the last row of a key winning: built from the results themselves."""
    return v.results(spark, sf).select(
        "source_model", F.col("original_variable").alias("source"),
        F.when(F.col("unit") != "x", F.concat_ws("/", "original_variable", "unit")).alias("target"),
        F.col("ord").alias("seq"),
    )


def map_model_fallback(spark, sf):
    rows = v.results(spark, sf)
    return op.map_model(rows, v.inline(spark, v.MODELS_BLANK)).select("ord", "source_model", "model", "model_known")


def convert_units(spark, sf):
    return op.convert_units(v.results(spark, sf), v.units(spark)).select("ord", "unit", "value")


def convert_units_keep(spark, sf):
    return op.convert_units(v.results(spark, sf), v.units(spark), keep_original_unit=True).select("ord", "unit", "value")


# --- reports ----------------------------------------------------------------

def unmapped_report(spark, sf):
    looked_up = look_up(v.results(spark, sf), op.measure_all(v.dictionaries(spark, sf)))
    return op.unmapped(looked_up, TARGETS, scope=["source_model"], order=["ord"]).select(
        "source_model", "label", "key", "unit", "units", "n", F.col("first.ord").alias("first_ord"),
        issue_text(F.col("key"), F.col("unit")).alias("line"),
    )


def report_lines(spark, sf):
    result = harmonize_rows(v.results(spark, sf), v.dictionaries(spark, sf), ["ord"])
    issues = op.union_sources([unmapped_issues(result.misses), duplicate_issues(result.counters)])
    return op.render_report(issues).select("source_model", "step", F.col("row").cast("bigint").alias("row"), "line")


def unmapped_set(spark, sf):
    known = v.regions(spark, sf).filter(F.col("target").isNotNull())
    return op.unmapped_set(v.results(spark, sf), "region", known)


# --- projections ------------------------------------------------------------

def compose_variable(spark, sf):
    part = v.table(spark, sf, "part").withColumns({
        "p_type": F.concat(F.lit(" \t"), "p_type"),
        "p_name": F.concat(F.nullif("p_name", F.lit("red widget")), F.lit(" ")),
    })
    return op.compose_variable(part, "p_type | p_name|p_brand").select("p_partkey", "original_variable")


def compose_variable_single(spark, sf):
    part = v.table(spark, sf, "part").withColumn("p_name", F.nullif("p_name", F.lit("red widget")))
    part = part.withColumn("p_name", F.concat(F.lit("  "), "p_name", F.lit("\n")))
    return op.compose_variable(part, " p_name ").select("p_partkey", "original_variable")


def compose_variable_legacy(spark, sf):
    part = v.table(spark, sf, "part").withColumn("p_name", F.nullif("p_name", F.lit("red widget")))
    return op.compose_variable(part, "p_type|p_name|p_size", " | ", "nan", False).select("p_partkey", "original_variable")


def canonicalize_columns(spark, sf):
    orders = v.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order"), F.col("o_orderpriority").alias("Source Scenario"),
        F.col("o_orderstatus").alias("AREA"), F.year("o_orderdate").alias("TIME"),
        F.col("o_totalprice").alias("growth"), F.lit("EUR").alias("Unit"), F.col("o_custkey").alias("Code"),
    )
    return op.canonicalize(orders).select("order", "scenario", "region", "year", "value", "unit", "Code")


def trim_headers(spark, sf):
    orders = v.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias(" key "), F.col("o_orderstatus").alias("status\t"),
    )
    return op.trim_headers(orders)


def nullify_tokens(spark, sf):
    events = v.table(spark, sf, "events")
    injected = events.select(
        "event_id",
        F.element_at(F.array(*map(F.lit, ["NA", "n/a", "", "<NA>", "kept", "na"])), (F.col("event_id") % 6 + 1).cast("int")).alias("a"),
        F.nullif("event_type", F.lit("view")).alias("b"),
        F.when(F.col("event_id") % 2 == 0, "NA").otherwise("DE").alias("region"),
    )
    cleaned = op.nullify_tokens(injected, keep=["region"])
    return op.drop_blank_rows(cleaned, ["a", "b"])


def type_measures(spark, sf):
    events = v.table(spark, sf, "events")
    k = F.col("event_id") % 5
    typed = op.type_measures(events.select(
        "event_id",
        F.when(k == 0, "n.a.").when(k == 1, F.concat(F.lit(" "), (F.col("user_id") * 3).cast("string"))).when(k == 2, "1e3")
        .when(k == 3, "5d").alias("value"),
        F.when(k == 0, "2020.0").when(k == 1, "2020.5").when(k == 2, "later").when(k == 3, "2030").alias("year"),
    ))
    return typed


def as_text_numbers(spark, sf):
    line = v.table(spark, sf, "lineitem")
    number = F.floor(F.col("l_extendedprice")).cast("double") * F.element_at(
        F.array(*map(F.lit, [1.0, 1e3, 1e6])), (F.col("l_partkey") % 3 + 1).cast("int"))
    typed = line.select("l_orderkey", "l_linenumber", "l_partkey", number.alias("x"))
    return typed.select("l_orderkey", "l_linenumber", "l_partkey", as_text(F.col("x"), typed.schema["x"].dataType).alias("text"))


def project_spec_defaults(spark, sf):
    orders = v.table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    given = dict(scenario="o_orderpriority", region="o_orderstatus", year="y", value="o_totalprice")
    shapes = [
        ("literal", op.project_spec(orders, **given, model="MODEL X", unit="EUR")),
        ("column", op.project_spec(orders, **given, model="o_orderstatus", unit_column="o_orderpriority")),
        ("default", op.project_spec(orders, **given)),
    ]
    return op.union_sources([df.withColumn("shape", F.lit(name)) for name, df in shapes])


def iamc_projection(spark, sf):
    rows = v.plain(spark, sf, nulls=True)
    return op.to_iamc_long(op.require(rows.withColumn("region", F.nullif("region", F.lit("NATION_3")))), ["ord"])


def unpivot_values(spark, sf):
    line = v.table(spark, sf, "lineitem")
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return op.unpivot_values(
        line.select(*ids, "l_quantity", "l_extendedprice", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_tax"),
        ids, name="variable",
    )


def union_sources(spark, sf):
    orders = v.table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("region"), F.lit("EUR").alias("unit"), F.col("o_totalprice").alias("value"))
    events = v.plain(spark, sf).select("unit", "value", "region")
    return op.union_sources([orders, events])


def first_per_group(spark, sf):
    return op.first_per_group(v.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"),
                              ["o_custkey"], "o_orderkey")


# --- duplicates -------------------------------------------------------------

def mark_duplicates(spark, sf):
    return op.mark_duplicates(v.plain(spark, sf, nulls=True)).select("ord", "unit", "is_duplicate")


def duplicate_stats(spark, sf):
    return op.duplicate_stats(v.plain(spark, sf, nulls=True))


def duplicate_counters(spark, sf):
    return op.duplicate_counters(v.plain(spark, sf))


def resolve_duplicates(spark, sf):
    return op.resolve_duplicates(v.plain(spark, sf))


def resolve_duplicates_nulls(spark, sf):
    return op.resolve_duplicates(v.plain(spark, sf, nulls=True))


def resolve_duplicates_prefer_value(spark, sf):
    return op.resolve_duplicates(v.plain(spark, sf, nulls=True), null_policy="prefer_value")


# --- reshaping --------------------------------------------------------------

def pivot_strict(spark, sf):
    return op.pivot_years(op.resolve_duplicates(v.plain(spark, sf, nulls=True)), years=v.YEARS)


def pivot_quarantine(spark, sf):
    """Totals per key and year in two models, single rows in the third: that one fails."""
    rows = v.plain(spark, sf)
    summed = rows.groupBy(*KEYS).agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("n"))
    doubled = rows.filter(F.col("source_model") == "MODEL_2").select(*KEYS, "value")
    return op.pivot_years(summed.drop("n").unionByName(doubled), years=v.YEARS)


def pivot_sum(spark, sf):
    return op.pivot_sum(v.plain(spark, sf, nulls=True), years=v.YEARS)


def pivot_sum_lineitem(spark, sf):
    years = op.distinct_years(v.table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year")))
    return op.pivot_sum(v.star(spark, sf), years=years)


def assert_unique(spark, sf):
    return op.assert_unique(v.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- regions ----------------------------------------------------------------

def countries(spark, sf):
    nation = v.table(spark, sf, "nation").select(
        F.concat(F.lit("n"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("two"),
        F.concat(F.lit("Na"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0")).alias("shared"),
        F.col("n_nationkey").cast("string").alias("number"),
        "n_name",
    )
    return op.country_codes(nation, ["two", "shared", "number"], "n_name")


def region_codes(spark, sf):
    """Customers with a region code in several spellings, own codes and misses."""
    key = F.col("c_nationkey")
    code = (
        F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit(" N"), F.lpad(key.cast("string"), 2, "0"), F.lit(" ")))
        .when(F.col("c_custkey") % 7 == 1, key.cast("string"))
        .when(F.col("c_custkey") % 7 == 2, F.element_at(F.array(*map(F.lit, ["EUR", "NAM", "LAM", "eur"])), (key % 4 + 1).cast("int")))
        .when(F.col("c_custkey") % 7 == 3, F.concat(F.lit("Nation-"), key.cast("string")))
        .when(F.col("c_custkey") % 7 == 4, F.concat(F.lit("NA0"), (key % 5).cast("string")))
        .when(F.col("c_custkey") % 7 == 5, "  ")
    )
    return v.table(spark, sf, "customer").select("c_custkey", code.alias("source_region"))


def _normalized(spark, sf, **options):
    return op.normalize_regions(region_codes(spark, sf), countries(spark, sf), patterns=PATTERNS, **options)


def normalize_regions(spark, sf):
    return _normalized(spark, sf)


def normalize_regions_passthrough(spark, sf):
    return _normalized(spark, sf, on_miss="passthrough")


#: A pattern per customer number below a bound: more than fit into one projection, some of them ambiguous.
MANY_PATTERNS = {rf"^customer#0*{i}$": f"Customer {i}" for i in range(1, 40)} | {r"^customer#0*(7|8|9)$": "Seven to nine", r"[a-z]+#0*12$": "Twelve"}


def normalize_regions_indexed(spark, sf):
    """Names against many patterns, by the letters that these need."""
    names = v.table(spark, sf, "customer").select(F.col("c_name").alias("source_region"), F.col("c_custkey").alias("i"))
    return op.normalize_regions(names, countries(spark, sf), patterns=MANY_PATTERNS).select("i", "target_region")


def country_codes(spark, sf):
    return countries(spark, sf)


def region_coverage(spark, sf):
    return op.region_coverage(_normalized(spark, sf))


def region_misses(spark, sf):
    return op.region_misses(_normalized(spark, sf))


# --- files and lists --------------------------------------------------------

def _paths(spark, sf):
    """A delivery tree named after the documents."""
    doc = F.col("doc_id").cast("string")
    path = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(doc, F.lit(".CSV")))
        .when(F.col("doc_id") % 4 == 1, F.concat("source", F.lit("/"), doc, F.lit(".csv")))
        .when(F.col("doc_id") % 4 == 2, F.concat("source", F.lit("/run "), "lang", F.lit("/v1.2/"), doc, F.lit(".csv")))
        .otherwise(F.concat("source", F.lit("/"), "lang", F.lit(".xlsx/Sheet "), doc, F.lit(".parquet")))
    )
    return v.table(spark, sf, "documents").select("doc_id", path.alias("path"))


def derive_source_models(spark, sf):
    return _paths(spark, sf).select("doc_id", derive_source_model(F.col("path"), "root").alias("source_model"))


def locate_files(spark, sf):
    return locate(_paths(spark, sf), "root").select(
        "doc_id", "source_model", "file_location", "file_name", "sheet_name", "format")


def spec_counts(spark, sf):
    return spec_summary(v.table(spark, sf, "documents"), ["source", "lang"], "source")


def codelist_lines(spark, sf):
    part = v.table(spark, sf, "part").select(
        F.col("p_partkey").alias("seq"), F.concat(F.col("p_name"), F.lit("\n"), "p_brand").alias("variable name"),
        F.nullif("p_type", F.lit("PROMO")).alias("Sub-Sector Name"), F.col("p_size").alias("Unit"), F.col("p_brand").alias("source:"),
    )
    return op.render_codelist(part)


def text_functions(spark, sf):
    text = F.col("text")
    return v.table(spark, sf, "documents").select(
        "doc_id", F.md5(py_strip(F.concat(F.lit(" \t\n"), text, F.lit(" \n ")))).alias("stripped"),
        F.md5(one_line(text)).alias("one_line"),
        pct(F.col("n_chars"), F.col("n_chars") + F.col("doc_id")).alias("share"),
    )


# --- whole jobs -------------------------------------------------------------

def harmonize_e2e(spark, sf):
    return harmonize_rows(v.results(spark, sf), v.dictionaries(spark, sf), ["ord"]).long


def harmonize_mapped(spark, sf):
    looked_up = look_up(v.results(spark, sf), op.measure_all(v.dictionaries(spark, sf)))
    return mapped_rows(looked_up, ["ord"])


def harmonize_wide(spark, sf):
    return to_wide(harmonize_rows(v.results(spark, sf), v.dictionaries(spark, sf), ["ord"]), years=result_years(spark, sf))


def result_years(spark, sf):
    """Years of the delivery, read from the one column that gives them."""
    return op.distinct_years(v.results(spark, sf))


def harmonize_duplicate_report(spark, sf):
    return harmonize_rows(v.results(spark, sf), v.dictionaries(spark, sf), ["ord"]).counters


def harmonize_legacy_e2e(spark, sf):
    rows = v.plain(spark, sf).drop("variable").withColumn("original_variable", F.concat_ws(" | ", "scenario", "unit"))
    mapping = rows.select(
        "source_model", F.col("original_variable").alias("source"),
        F.when(F.col("unit") != "x", F.upper("original_variable")).alias("target"), F.col("ord").alias("seq"),
    )
    return legacy_wide(legacy_rows(rows, mapping, v.regions(spark, sf), ["source_model"]), ["source_model"], years=v.YEARS)


def harmonize_files(spark, sf):
    """The whole run, from CSV files that hold the results."""
    folder = deliveries.deliver(spark, sf)
    return harmonize(spark, folder, deliveries.overview(spark, folder), v.dictionaries(spark, sf)).long


def harmonize_files_misses(spark, sf):
    folder = deliveries.deliver(spark, sf)
    run = harmonize(spark, folder, deliveries.overview(spark, folder), v.dictionaries(spark, sf))
    return run.harmonized.misses.groupBy("source_model", "label", "key").agg(F.sum("n").alias("n"))


def catalog(spark, sf):
    found = catalog_files(spark, deliveries.deliver(spark, sf))
    return found.select("source_model", "file_location", "sheet_name", "column_names").distinct()


ALL: dict[str, Query] = {
    f.__name__: f
    for f in [
        dictionary_last_wins, dictionary_units, dictionary_summary,
        map_strict_region, map_strict_issues, map_lenient_region, map_by_spec, map_model_fallback,
        convert_units, convert_units_keep, unmapped_report, report_lines, unmapped_set,
        compose_variable, compose_variable_single, compose_variable_legacy, canonicalize_columns,
        trim_headers, nullify_tokens, type_measures, as_text_numbers, project_spec_defaults,
        iamc_projection, unpivot_values, union_sources, first_per_group,
        mark_duplicates, duplicate_stats, duplicate_counters, resolve_duplicates,
        resolve_duplicates_nulls, resolve_duplicates_prefer_value,
        pivot_strict, pivot_quarantine, pivot_sum, pivot_sum_lineitem, assert_unique,
        country_codes, normalize_regions, normalize_regions_passthrough, normalize_regions_indexed, region_coverage, region_misses,
        derive_source_models, locate_files, spec_counts, codelist_lines, text_functions,
        harmonize_mapped, harmonize_e2e, harmonize_wide, harmonize_duplicate_report, harmonize_legacy_e2e,
        harmonize_files, harmonize_files_misses, catalog,
    ]
} | JOBS
