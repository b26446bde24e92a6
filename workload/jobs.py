"""Queries that run whole jobs on files: the given tables are delivered first, then read back by the job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scenweave import (
    catalog_files, convert_regions, export_codelist, harmonize, harmonize_legacy, harmonize_rows, load_specs, write_catalog, write_iamc,
    write_legacy, write_report,
)
from scenweave import operators as op
from scenweave.plans.staging import new_folder
from scenweave.sources.files import list_files

from . import views as v

#: Files per model into which the results are dealt: over a thousand in all, and few.
BUCKETS, FEW = 400, 40
#: Columns and separator of the three layouts among them.
LAYOUTS = (
    (("scen", "AREA", "Kind", "Part No", "Unit", "TIME", "VAL"), ","),
    (("TIME", "VAL", "Unit", "Kind", "Part No", "AREA", "scen"), ";"),
    (("note", "Part No", "Kind", "scen", "AREA", "TIME", "VAL", "Unit"), ","),
)


def delivered(spark: SparkSession, sf: str) -> DataFrame:
    """Results under the headers that a model gives them."""
    return v.results(spark, sf).select(
        "ord", "source_model", F.col("scenario").alias("scen"), F.col("region").alias("AREA"),
        F.substring_index("original_variable", "|", 1).alias("Kind"), F.substring_index("original_variable", "|", -1).alias("Part No"),
        F.col("unit").alias("Unit"), F.col("year").alias("TIME"), F.col("value").alias("VAL"), F.lit("x").alias("note"),
    )


def specs(df: DataFrame, separator: str | Column = ",", encoding: str = "") -> DataFrame:
    """An overview of tables given as ``location, name, model, sheet``, in their order."""
    sep = separator if isinstance(separator, Column) else F.lit(separator)
    return load_specs(df.select(
        F.col("location").alias("File location"), F.col("name").alias("File name"), F.col("model").alias("Source model"),
        F.col("sheet").alias("Sheet name"), sep.alias("Separator"), F.lit("Kind|Part No").alias("Variable column"),
        F.lit(encoding).alias("Encoding"),
    ))


def many_files(spark: SparkSession, sf: str, buckets: int = FEW) -> tuple[str, DataFrame]:
    """A file per model and bucket of rows, in three layouts, and their overview. Names of buckets follow the order of the rows."""
    folder = new_folder(spark, "many")
    rows = delivered(spark, sf)
    last = rows.agg(F.max("ord")).first()[0] or 0
    rows = rows.withColumn("bucket", F.lpad(F.floor(F.col("ord") * buckets / F.lit(last + 1)).cast("string"), 5, "0"))
    for i, (columns, sep) in enumerate(LAYOUTS):
        some = rows.filter(F.col("bucket").cast("int") % len(LAYOUTS) == i).select("ord", "source_model", "bucket", *columns)
        some.repartition(8, "bucket").sortWithinPartitions("source_model", "bucket", "ord").drop("ord").write.partitionBy(
            "source_model", "bucket").option("header", "true").option("sep", sep).csv(f"{folder}/layout {i}")
    part = lambda name: F.regexp_extract("path", f"{name}=([^/]*)", 1)
    files = list_files(spark, folder).filter(F.col("path").endswith(".csv")).withColumns({"model": part("source_model"), "bucket": part("bucket")})
    ordered = files.orderBy("model", "bucket", "path").select(
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("location"), F.regexp_extract("path", "[^/]*$", 0).alias("name"), "model", F.lit("").alias("sheet"))
    sep = reduce(lambda a, i: F.when(F.col("location").startswith(f"layout {i}/"), LAYOUTS[i][1]).otherwise(a), range(len(LAYOUTS)), F.lit(None))
    return folder, specs(ordered, sep)


def harmonize_many_files(spark, sf):
    """Over a thousand small files in three layouts: the plan has three scans."""
    folder, overview = many_files(spark, sf, BUCKETS)
    return harmonize(spark, folder, overview, v.dictionaries(spark, sf)).long


def harmonize_many_files_found(spark, sf):
    """What the run says about the columns of each source, by model and message."""
    folder, overview = many_files(spark, sf)
    issues = harmonize(spark, folder, overview, v.dictionaries(spark, sf)).issues
    return issues.filter("stage in ('source', 'columns')").groupBy("source_model", "stage", "severity", "message").agg(F.count("*").alias("n"))


def catalog_layouts(spark, sf):
    """The catalog of many files: names of columns, and the number of files of each model that have them."""
    folder, _ = many_files(spark, sf)
    found = catalog_files(spark, folder)
    return found.groupBy(F.col("source_model").alias("layout"), F.regexp_extract("file_location", "source_model=([^/]*)", 1).alias("model"), "column_names").agg(
        F.count("*").alias("files"))


def written_catalog(spark, sf):
    """The catalog as it is delivered, read back."""
    folder, _ = many_files(spark, sf)
    path = new_folder(spark, "catalog")
    write_catalog(catalog_files(spark, folder), path)
    back = spark.read.option("header", True).csv(path)
    return back.groupBy(F.col("Source model").alias("layout"), F.col("Column names").alias("names")).agg(F.count("*").alias("files"))


def harmonize_parts(spark, sf):
    """Folders of parts as Spark writes them: a model each in Parquet, JSON and ORC."""
    folder, rows = new_folder(spark, "parts"), delivered(spark, sf).drop("note")
    kinds = ("parquet", "json", "orc")
    for i, kind in enumerate(kinds):
        some = rows.filter(F.col("source_model") == f"MODEL_{i}").repartitionByRange(4, "ord").sortWithinPartitions("ord")
        some.drop("source_model", "ord").write.format(kind).save(f"{folder}/all/result.{kind}")
    tables = spark.createDataFrame([("all", f"result.{k}", f"MODEL_{i}", "") for i, k in enumerate(kinds)], "location string, name string, model string, sheet string")
    return harmonize(spark, folder, specs(tables.coalesce(1)), v.dictionaries(spark, sf)).long


def harmonize_sheets(spark, sf):
    """Workbooks: a folder per model that holds a sheet of parts for each scenario; the overview names every sheet."""
    folder, rows = new_folder(spark, "books"), delivered(spark, sf).drop("note")
    sheets = sorted(v.EVENT_TYPES)
    for name in sheets:
        some = rows.filter(F.col("scen") == name).repartitionByRange(2, "ord").sortWithinPartitions("ord").withColumn("Unnamed: 0", F.col("ord"))
        for i in range(3):
            some.filter(F.col("source_model") == f"MODEL_{i}").drop("source_model", "ord").write.parquet(f"{folder}/M{i}/book.xlsx/{name}.parquet")
    tables = spark.createDataFrame([(f"M{i}", "book.xlsx", f"MODEL_{i}", n) for i in range(3) for n in sheets],
                                   "location string, name string, model string, sheet string")
    return harmonize(spark, folder, specs(tables.coalesce(1)), v.dictionaries(spark, sf)).long


def harmonize_columns(spark, sf):
    """Variables as columns: a file per model and two variables beside a column that is none."""
    folder, rows = new_folder(spark, "columns"), delivered(spark, sf)
    wide = rows.select("ord", "source_model", "scen", "AREA", F.col("VAL").alias("click|0"), "note", (2 * F.col("VAL")).alias("view|1"), "Unit", "TIME")
    wide.repartitionByRange(4, "ord").sortWithinPartitions("ord").drop("ord").write.partitionBy("source_model").option("header", "true").csv(folder)
    files = list_files(spark, folder).filter(F.col("path").endswith(".csv")).orderBy("path").select(
        F.substring_index("path", "/", 1).alias("location"), F.substring_index("path", "/", -1).alias("name"),
        F.regexp_extract("path", "source_model=([^/]*)", 1).alias("model"), F.lit("").alias("sheet"))
    return harmonize(spark, folder, specs(files).withColumn("Variable column", F.lit("")), v.dictionaries(spark, sf)).long


def _latin(spark: SparkSession, sf: str) -> str:
    """Results whose scenarios begin with a letter beyond ASCII, in Latin-1."""
    folder = new_folder(spark, "latin")
    rows = delivered(spark, sf).withColumn("scen", F.concat(F.lit("ö"), "scen")).drop("note")
    rows.repartitionByRange(4, "ord").sortWithinPartitions("ord").drop("ord").write.partitionBy("source_model").options(
        header="true", encoding="ISO-8859-1").csv(folder)
    return folder


def _latin_run(spark: SparkSession, sf: str, encoding: str):
    folder = _latin(spark, sf)
    files = list_files(spark, folder).filter(F.col("path").endswith(".csv")).orderBy("path").select(
        F.substring_index("path", "/", 1).alias("location"), F.substring_index("path", "/", -1).alias("name"),
        F.regexp_extract("path", "source_model=([^/]*)", 1).alias("model"), F.lit("").alias("sheet"))
    scenarios = v.inline(spark, [(f"ö{a}", b, c) for a, b, c in v.SCENARIOS])
    return harmonize(spark, folder, specs(files, ",", encoding), v.dictionaries(spark, sf) | {"scenarios": scenarios})


def harmonize_encoding(spark, sf):
    """Files whose encoding the overview declares."""
    return _latin_run(spark, sf, "ISO-8859-1").long


def harmonize_wrong_encoding(spark, sf):
    """Rows that are not written in UTF-8, counted per model where no encoding is declared."""
    issues = _latin_run(spark, sf, "").issues.filter("message like '%not written in the encoding%'")
    return issues.groupBy("source_model").agg(F.sum("n").alias("n"))


def quarantined_rows(spark, sf):
    """Cells that do not convert and rows too long, from files that hold some: counted per model."""
    folder = new_folder(spark, "odd")
    cells = delivered(spark, sf).drop("note").withColumn("TIME", F.when(F.col("ord") % 11 == 0, "soon").otherwise(F.col("TIME").cast("string"))).withColumn(
        "VAL", F.when(F.col("ord") % 7 == 0, "many").otherwise(F.col("VAL").cast("string")))
    names = [c for c in cells.columns if c not in ("ord", "source_model")]
    line = F.concat(F.concat_ws(",", *[F.col(f"`{n}`") for n in names]), F.when(F.col("ord") % 13 == 0, ",more").otherwise(""))
    head = spark.createDataFrame([(-1, f"MODEL_{i}", ",".join(names)) for i in range(3)], "ord long, source_model string, line string")
    lines = head.union(cells.select("ord", "source_model", line.alias("line")))
    # One file per model, so that each begins with its header.
    lines.repartition("source_model").sortWithinPartitions("source_model", "ord").drop("ord").write.partitionBy("source_model").option("lineSep", "\n").text(folder)
    # Spark names text files .txt: the tables are delivered under the name of their format.
    copy = new_folder(spark, "odd-csv")
    for i in range(3):
        spark.read.text(f"{folder}/source_model=MODEL_{i}").coalesce(1).write.text(f"{copy}/M{i}/all.csv")
    tables = spark.createDataFrame([(f"M{i}", "all.csv", f"MODEL_{i}", "") for i in range(3)], "location string, name string, model string, sheet string")
    issues = harmonize(spark, copy, specs(tables.coalesce(1)), v.dictionaries(spark, sf)).issues.filter("stage = 'values'")
    return issues.groupBy("source_model", "severity", F.expr("regexp_replace(message, '^[0-9]+ ', '')").alias("message")).agg(F.sum("n").alias("n"))


# --- what is written ----------------------------------------------------------


def written_long(spark, sf):
    """The long form as it is written, read back."""
    path = new_folder(spark, "long")
    write_iamc(_results(spark, sf), path)
    return spark.read.parquet(path).select("source_model", "model", "scenario", "region", "variable", "unit", "year", "value")


def written_wide(spark, sf):
    """The wide form as it is written, read back."""
    path = new_folder(spark, "wide")
    write_iamc(_results(spark, sf), path, "wide")
    back = spark.read.option("header", True).csv(path)
    return back.select(*[F.col(f"`{c}`").cast("double") if c.isdigit() else F.col(c) for c in back.columns])


def written_per_model(spark, sf):
    """The folders of single models, read back: number of rows and sum per model."""
    path = new_folder(spark, "models")
    write_iamc(_results(spark, sf), path, "per_model")
    each = []
    for i in range(3):
        back = spark.read.option("header", True).csv(f"{path}/pyam_MODEL_{i}")
        years = [F.coalesce(F.sum(F.col(f"`{c}`").cast("double")), F.lit(0.0)) for c in back.columns if c.isdigit()]
        each.append(back.agg(F.count("*").alias("n"), F.round(reduce(lambda a, b: a + b, years), 3).alias("total")).withColumn("source_model", F.lit(f"MODEL_{i}")))
    return reduce(DataFrame.union, each)


def _results(spark, sf):
    return harmonize_rows(v.results(spark, sf), v.dictionaries(spark, sf), ["ord"]).long


def written_report(spark, sf):
    """Lines of the report of a run on files, read back, with their number."""
    folder, overview = many_files(spark, sf)
    path = new_folder(spark, "report")
    write_report(harmonize(spark, folder, overview, v.dictionaries(spark, sf)).issues, path)
    return spark.read.text(path).filter("value like '=== %' or value like '% rows removed' or value like '% rows renamed'").select(F.col("value").alias("line"))


def written_codelist(spark, sf):
    """A codelist delivered as a table and exported: its lines, counted."""
    source, path = new_folder(spark, "parts-list"), new_folder(spark, "codelist")
    v.table(spark, sf, "part").select(
        F.concat(F.col("p_name"), F.lit("\n"), "p_brand").alias("variable name"), F.nullif("p_type", F.lit("PROMO")).alias("Sub-Sector Name"),
        F.col("p_size").alias("Unit"),
    ).write.options(header="true", sep=";", escape='"').csv(source)
    export_codelist(spark, source, path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def written_regions(spark, sf):
    """The region table with full names: written, read back."""
    source, path = new_folder(spark, "regions"), new_folder(spark, "named")
    codes = v.table(spark, sf, "customer").select(F.concat(F.lit("N"), (F.col("c_nationkey") * 2).cast("string")).alias("source_region"), F.col("c_custkey").alias("note"))
    codes.write.option("header", True).csv(source)
    countries = op.country_codes(
        v.table(spark, sf, "nation").select("n_name", F.concat(F.lit("n"), "n_nationkey").alias("code")), ["code"], "n_name")
    convert_regions(spark, source, countries, out=path, keep=("source_region",))
    return spark.read.option("header", True).csv(path).select("source_region", F.col("note").cast("long").alias("note"), "target_region")


# --- the older conversion -----------------------------------------------------


def _legacy(spark: SparkSession, sf: str):
    folder = new_folder(spark, "legacy")
    rows = delivered(spark, sf).drop("note", "Part No").withColumn("TIME", F.when(F.col("ord") % 17 == 0, "soon").otherwise(F.col("TIME").cast("string")))
    rows.repartitionByRange(2, "ord").sortWithinPartitions("ord").drop("ord").write.partitionBy("source_model").option("header", "true").csv(folder)
    files = list_files(spark, folder).filter(F.col("path").endswith(".csv"))
    names = F.explode(F.array(*(F.struct(F.lit(f"{s} | {u}").alias("a"), F.lit(f"{s} | {u}".upper()).alias("b")) for s in v.EVENT_TYPES for u in ("t", "kt", "EJ"))))
    overview = files.select(
        F.substring_index("path", "/", 1).alias("File location"), F.substring_index("path", "/", -1).alias("File name"),
        F.regexp_extract("path", "source_model=([^/]*)", 1).alias("Source model"), F.lit(",").alias("Separator"), F.lit("Kind|Unit").alias("Variable column"),
        F.lit("scen").alias("Source Scenario"), F.lit("AREA").alias("Source Region"), F.lit("TIME").alias("Source Year"), F.lit("VAL").alias("Source Value"),
        F.lit("Unit").alias("Source Unit"), names.alias("m"),
    ).select("*", F.col("m.a").alias("Variable value (original)"), F.col("m.b").alias("Variable name (new)")).drop("m")
    return harmonize_legacy(spark, folder, load_specs(overview, legacy=True), v.regions(spark, sf))


def legacy_files(spark, sf):
    """The older conversion from files: sums per cell and source, added up over the files of a model."""
    path = new_folder(spark, "legacy-out")
    write_legacy(_legacy(spark, sf).long, path)
    back = spark.read.option("header", True).csv(path)
    years = [c for c in back.columns if c.isdigit()]
    return back.groupBy("model", "scenario", "region", "variable", "unit").agg(*[F.sum(F.col(f"`{y}`").cast("double")).alias(y) for y in years])


def legacy_report(spark, sf):
    """What the older conversion leaves out, per model."""
    issues = _legacy(spark, sf).issues.filter("n is not null and stage in ('values', 'Variables') and message not like '% not in the dictionary:'")
    label = F.when(F.col("stage") == "values", F.expr("regexp_replace(message, '^[0-9]+ ', '')")).otherwise(F.col("key"))
    return issues.groupBy("source_model", "stage", label.alias("what")).agg(F.sum("n").alias("n"))


JOBS = {
    f.__name__: f for f in (
        harmonize_many_files, harmonize_many_files_found, catalog_layouts, written_catalog, harmonize_parts, harmonize_sheets, harmonize_columns, harmonize_encoding,
        harmonize_wrong_encoding, quarantined_rows, written_long, written_wide, written_per_model, written_report, written_codelist,
        written_regions, legacy_files, legacy_report,
    )
}
