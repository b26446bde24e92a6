"""Scans of result tables.

The overview stays a table: files are found by a join, and what each of them
says about its columns is worked out by expressions. Only distinct layouts
reach the driver. Files that are alike in format, separator, width and column
roles are read by one scan and joined to their specification, so the plan grows
with the number of layouts, not of files, and no file is read under the
header of another: Spark applies one header to all files of a scan by position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import COLUMN_ALIASES
from ..functions.paths import one_spelling
from ..functions.text import as_text, nullify, py_strip
from ..operators.columns import type_measures, union_sources, variable_text
from ..operators.issues import SCHEMA, issue
from ..operators.lookup import BROADCAST_ROWS
from ..plans.staging import stage
from .files import TABLE_KEYS, load_path, located_files, read_headers

ROLES = ("scenario", "region", "year", "value", "unit")
#: Bits of a row's place that hold the place of its block in its file; the part of a table of several files is above.
PART_BITS = 42


@dataclass(frozen=True)
class Layout:
    """What files must share to be read in one scan.

    ``roles`` gives the column position of scenario, region and the others, -1
    where the file has no such column; ``parts`` the positions of the variable
    columns. ``fields`` are names and types where columns are found by name,
    ``variables`` positions and names of columns that are variables themselves.
    """

    format: str
    separator: str | None
    encoding: str | None
    width: int
    fields: tuple[tuple[str, str], ...]
    roles: tuple[tuple[str, int], ...]
    parts: tuple[int, ...]
    variables: tuple[tuple[int, str], ...] = ()


@dataclass(frozen=True)
class ReadStyle:
    """How text cells become keys."""

    sep: str = "|"
    null_text: str = ""
    trim: bool = True
    blank_rows: bool = False
    multi_line: bool = False
    keep_tokens: tuple[str, ...] = ()


@dataclass(frozen=True)
class ScanPlan:
    """Sources as a table: one row per specification and file, with ``layout`` (NULL if it is not read) and
    the issues found. ``layouts`` tells what the layouts are."""

    sources: DataFrame
    layouts: dict[str, Layout]
    issues: DataFrame


def locate_specs(spark: SparkSession, root: str, specs: DataFrame) -> DataFrame:
    """Specifications (``spec_id`` and the columns of the overview) with the files they name and their columns' names.

    A table of several parts gives one row per part, numbered in ``part``; a
    specification without file stays, with a NULL ``file_path``.
    """
    place = F.regexp_replace(F.replace(F.col("File location"), F.lit("\\"), F.lit("/")), "^/+|/+$", "")
    wanted = specs.select(
        "spec_id", place.alias("location"), F.col("File name").alias("name"), F.col("Sheet name").alias("sheet"),
        F.col("Separator").alias("sep"), F.nullif(F.upper("Encoding"), F.lit("")).alias("encoding"),
    )
    files = stage(located_files(spark, root).filter(F.col("format").isNotNull()), "files")
    sheets = files.groupBy("file_location", "file_name").agg(F.min("sheet_name").alias("first_sheet"))
    named = (
        wanted.join(sheets, (F.col("location") == F.col("file_location")) & (F.col("name") == F.col("file_name")))
        .select("spec_id", "file_location", "file_name", "sep", "encoding",
                F.when((F.col("sheet") == "") | ~F.lower("name").rlike(r"\.xlsx?$"), F.col("first_sheet"))
                .otherwise(F.col("sheet")).alias("sheet_name"))
    )
    located = named.join(files.select("file_path", "length", "format", *TABLE_KEYS, "in_parts"), TABLE_KEYS)
    by_name = F.col("format").isin("parquet", "orc") & F.col("in_parts")
    found = stage(
        located.withColumns({
            "part": F.row_number().over(W.partitionBy("spec_id").orderBy("file_path")) - 1,
            # Parts that a reader finds by name are alike: the first one tells their schema.
            "told_by": F.when(by_name, F.min("file_path").over(W.partitionBy("spec_id"))).otherwise(F.col("file_path")),
        }).select(
            "spec_id", "file_path", "length", "format", "in_parts", "part", "told_by",
            F.when(F.col("format") == "csv", F.when(F.col("sep") == "", ",").otherwise(F.col("sep"))).alias("separator"),
            F.when(F.col("format") == "csv", F.col("encoding")).alias("encoding"),
        ), "found")
    headers = read_headers(found.select(F.col("told_by").alias("file_path"), "format", "separator", "encoding", "length"))
    on = (found["told_by"] == headers["file_path"]) & found["separator"].eqNullSafe(headers["separator"]) & (
        found["encoding"].eqNullSafe(headers["encoding"]))
    described = found.join(headers, on, "left").select(found["*"], "names", "types", "failure")
    # Records of a JSON table may lack keys in one part and have them in another.
    of_all = (F.col("format") == "json") & F.col("in_parts")
    first = described.filter(of_all).select("spec_id", "part", F.posexplode("names").alias("at", "name")).groupBy("spec_id", "name").agg(
        F.min(F.struct("part", "at")).alias("first"))
    all_names = first.groupBy("spec_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("first", "name"))), lambda x: x["name"]).alias("all_names"))
    whole = described.join(all_names, "spec_id", "left").withColumns({
        "names": F.coalesce("all_names", "names"),
        "types": F.coalesce(F.transform("all_names", lambda _: F.lit("json")), "types"),
        "failure": F.when(F.col("all_names").isNull(), F.col("failure")),
    })
    told = whole.drop("all_names", "in_parts", "length", "told_by")
    return stage(specs.drop("Separator", "Encoding").join(told, "spec_id", "left"), "sources")


def visible_names(legacy: bool = False) -> Column:
    """Headers that roles and rules may name; NULL in the place of an index column."""
    if legacy:
        # One legacy delivery carries a row index in front.
        has_index = F.col("File name").contains("250424")
        return F.transform("names", lambda n, i: F.when(~(has_index & (i == 0)), py_strip(n)))
    is_sheet = F.lower("File name").endswith(".xlsx")
    return F.transform("names", lambda n: F.when(~(is_sheet & (n == "Unnamed: 0")), n))


def rule_parts(rule: Column) -> Column:
    """Column names of a variable rule such as ``Variable|Sector|Carrier``."""
    return F.transform(F.split(rule, r"\|", -1), py_strip)


def position(names: Column, name: Column) -> Column:
    """Place of a name, from 0; NULL where there is none."""
    return F.nullif(F.array_position(names, name), F.lit(0)).cast("int") - 1


def quoted(names: Column) -> Column:
    return F.array_join(F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", ")


def unreadable() -> Column:
    """Why a source cannot be read; NULL if it can."""
    name = F.col("File name")
    known = F.lower(name).rlike(r"\.(csv|xlsx?|parquet|orc|jsonl?)$")
    # A workbook that is no folder of tables stays what it is: of no known format.
    return (
        F.when(~known | (F.lower(name).endswith(".xls") & F.col("file_path").isNull()), F.concat(F.lit("unknown format, skipped: "), name))
        .when(F.col("file_path").isNull(), F.concat(F.lit("cannot read "), name, F.lit(": no such table")))
        .when(F.col("failure").isNotNull() | (F.coalesce(F.size("names"), F.lit(0)) <= 0),
              F.concat(F.lit("cannot read "), name, F.lit(": "), F.coalesce("failure", F.lit("no columns"))))
    )


def layouts_of(sources: DataFrame, roles: Sequence[str]) -> tuple[DataFrame, dict[str, Layout]]:
    """Sources with the key of their layout, and the distinct layouts. ``positions`` are those of ``roles``."""
    by_name = F.col("format") != "csv"
    described = F.struct(
        "format", "separator", F.when(~by_name, F.coalesce("encoding", F.lit("UTF-8"))).alias("encoding"), F.size("names").alias("width"),
        F.when(by_name, F.arrays_zip("names", "types")).alias("fields"), "positions", "parts",
        (F.col("variables") if "variables" in sources.columns else F.array().cast("array<struct<at: int, name: string>>")).alias("variables"),
    )
    keyed = stage(
        sources.withColumn("described", described)
        .withColumn("layout", F.when(F.col("usable"), F.sha2(F.to_json("described"), 256))), "layouts")
    found = keyed.filter("layout is not null").groupBy("layout").agg(F.any_value("described").alias("d")).select("layout", "d.*").collect()
    layouts = {
        r["layout"]: Layout(
            r["format"], r["separator"], r["encoding"], r["width"], tuple((f["names"], f["types"]) for f in r["fields"] or ()),
            tuple(zip(roles, (-1 if p is None else p for p in r["positions"]), strict=True)), tuple(r["parts"]),
            tuple((x["at"], x["name"]) for x in r["variables"] or ()),
        )
        for r in found
    }
    return keyed.drop("described", "positions", "parts"), layouts


def _with_variables(df: DataFrame, dictionary: DataFrame | None) -> DataFrame:
    """Sources without a variable rule have variables as columns: those beside the roles whose header the dictionary translates.

    Adds ``variables`` (position and name) and ``strangers``, the other headers.
    """
    none = F.array().cast("array<struct<at: int, name: string>>")
    if dictionary is None:
        return df.withColumns({"variables": none, "strangers": none})
    roles = F.map_values("chosen")
    headers = F.filter(F.transform("seen", lambda n, i: F.struct(i.alias("at"), py_strip(n).alias("name"))),
                       lambda x: x["name"].isNotNull() & ~F.coalesce(F.array_contains(roles, x["at"]), F.lit(False)))
    each = df.filter(F.col("wide") & F.col("names").isNotNull()).select("spec_id", "file_path", F.explode(headers).alias("h"))
    known = dictionary.filter("target is not null").select(F.col("source").alias("_source"))
    told = each.join(known, F.col("h.name") == F.col("_source"), "left").groupBy("spec_id", "file_path").agg(*(
        F.sort_array(F.collect_list(F.when(hit, F.col("h")))).alias(name)
        for name, hit in (("variables", F.col("_source").isNotNull()), ("strangers", F.col("_source").isNull()))))
    return df.join(told, ["spec_id", "file_path"], "left").withColumns({c: F.coalesce(c, none) for c in ("variables", "strangers")})


def plan_scans(
    located: DataFrame, aliases: Mapping[str, Sequence[str]] = COLUMN_ALIASES, strict_names: bool = False, variables: DataFrame | None = None,
) -> ScanPlan:
    """Work out each source's columns; set those apart that cannot be read.

    A source with a blank variable rule has variables as columns, if the
    dictionary of ``variables`` is given.
    """
    canonical = list(aliases)
    first = {c: F.coalesce(*[position(F.col("seen"), F.lit(v)) for v in variants]) for c, variants in aliases.items()}
    df = located.withColumn("seen", visible_names()).withColumn("problem", unreadable())
    df = df.withColumn("chosen", F.map_from_arrays(F.array(*map(F.lit, canonical)), F.array(*first.values())))

    def at(name: Column) -> Column:
        by_header, by_role = position(F.col("seen"), name), F.try_element_at("chosen", name)
        if strict_names:
            taken = F.array_contains(F.map_values("chosen"), by_header)
            return F.coalesce(by_role, F.when(~F.coalesce(taken, F.lit(False)), by_header))
        return F.coalesce(by_header, by_role)

    role = lambda name: F.try_element_at("chosen", F.lit(name))
    wide = (py_strip(F.col("Variable column")) == "") & F.lit(variables is not None)
    df = _with_variables(df.withColumn("wide", wide), variables)
    df = df.withColumn("rule", F.when(F.col("wide"), F.array().cast("array<string>")).otherwise(rule_parts(F.col("Variable column"))))
    df = df.withColumn("parts", F.transform("rule", at))
    df = df.withColumns({
        "missing": F.filter("rule", lambda p: at(p).isNull()),
        "found": F.array_compact(F.array(*[F.when(role(r).isNotNull(), F.lit(r)) for r in ROLES])),
        "doubled": F.filter(F.array(*map(F.lit, canonical)), lambda c: position(F.col("seen"), c) != F.try_element_at("chosen", c)),
        "needed": F.array_compact(F.array(*[
            F.when(role(r).isNull() & (~F.col("wide") if r == "value" else F.lit(True)), F.lit(r)) for r in ("unit", "value", "year")])),
        "positions": F.array(*[F.when(~F.col("wide"), role(r)) if r == "value" else role(r) for r in ROLES]),
    })
    fine = F.col("problem").isNull()
    complete = fine & (F.size("missing") == 0)
    bare = F.col("wide") & (F.size("variables") == 0)
    df = df.withColumn("usable", complete & (F.size("needed") == 0) & ~bare)
    keyed, layouts = layouts_of(df, ROLES)
    said = keyed.withColumnsRenamed({"Source model": "source_model", "File name": "file"})
    issues = issue(
        said,
        {"when": ~fine, "stage": "read", "severity": "error", "message": F.col("problem")},
        {"when": fine & (F.size("missing") > 0), "stage": "columns", "severity": "error",
         "message": F.concat(F.lit("no column "), quoted(F.col("missing")), F.lit(", source skipped"))},
        {"when": complete, "stage": "columns", "severity": "found", "message": F.concat(F.lit("columns: "), F.array_join("found", ", "))},
        {"when": complete & (F.size("doubled") > 0), "stage": "columns", "severity": "warning",
         "message": F.concat(F.array_join("doubled", ", "), F.lit(" given twice, the first spelling is used"))},
        *[{"when": complete & ~F.array_contains("found", r), "stage": "columns", "severity": "warning",
           "message": F.lit(f"no column for {r}")} for r in ("region", "scenario")],
        {"when": complete & (F.size("needed") > 0), "stage": "columns", "severity": "error",
         "message": F.concat(F.lit("no column for "), F.array_join("needed", ", "), F.lit(", source skipped"))},
        {"when": complete & bare, "stage": "columns", "severity": "error", "message": F.lit("no column is a variable of the dictionary, source skipped")},
        {"when": complete & ~bare & (F.size("strangers") > 0), "stage": "Variables", "severity": "warning", "n": F.size("strangers"),
         "message": F.concat(F.lit("columns that are no variables of the dictionary: "), quoted(F.transform("strangers", lambda x: x["name"])))},
    ).distinct()
    return ScanPlan(keyed, layouts, issues)


def _open(spark: SparkSession, layout: Layout, paths: Sequence[str], style: ReadStyle) -> tuple[DataFrame, list[Column], Column]:
    """Rows of the files, their columns by position and the overflow test."""
    if layout.format == "csv":
        # One field more than the header shows a row that is too long. The
        # last field is never selected: the reader then fills short rows
        # with NULL instead of treating them as malformed.
        fields = [f"c{i}" for i in range(layout.width)] + ["over", "pad"]
        df = (
            spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in fields]))
            .options(header="true", sep=layout.separator, quote='"', escape='"', encoding=layout.encoding,
                     multiLine=str(style.multi_line).lower(), maxColumns=str(max(20480, layout.width + 2)))
            .csv(list(paths))
        )
        return df, [F.col(f"c{i}") for i in range(layout.width)], F.col("over").isNotNull()
    names = [n for n, _ in layout.fields]
    if layout.format == "json":
        df = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).json(list(paths))
    else:
        df = spark.read.format(layout.format).load(list(paths))
    return df, [F.col(f"`{n}`") for n in names], F.lit(False)


def scan_group(
    spark: SparkSession, layout: Layout, sources: DataFrame, paths: Sequence[str], carry: Mapping[str, str], style: ReadStyle = ReadStyle(),
) -> DataFrame:
    """Rows of all sources of one layout, with canonical columns and input positions.

    ``paths`` has a file for each row of ``sources``, so it also tells their
    number. ``carry`` maps output columns to columns of ``sources``. These are joined
    to the rows by file: broadcast up to a number of them, by a shuffle beyond it.
    """
    df, cells, overflow = _open(spark, layout, [load_path(u) for u in dict.fromkeys(paths)], style)
    kinds = [f.dataType for f in df.schema][: len(cells)]

    def text(i: int, name: str = "") -> Column:
        if not isinstance(kinds[i], T.StringType):
            return as_text(cells[i], kinds[i])
        return cells[i] if name in style.keep_tokens else nullify(cells[i])

    def typed(i: int) -> Column:
        return nullify(cells[i]) if isinstance(kinds[i], T.StringType) else cells[i]

    columns = {}
    for name, i in layout.roles:
        if i < 0:
            columns[name] = F.lit(None).cast("string")
        else:
            columns[name] = typed(i) if name in ("year", "value") else text(i, name)
    if not layout.variables:
        columns["original_variable"] = variable_text(
            [text(i) for i in layout.parts], style.sep, style.null_text, style.trim
        )
    used = list(dict.fromkeys([*(i for _, i in layout.roles if i >= 0), *layout.parts, *(i for i, _ in layout.variables)]))
    if layout.format == "csv" and not style.blank_rows:
        first = list(dict.fromkeys([*used, *range(len(cells))]))
        df = df.filter(F.coalesce(*[nullify(cells[i]) for i in first], F.lit(None).cast("string")).isNotNull())
    # Bytes that are no text of the declared encoding arrive as the replacement character.
    broken = [cells[i].contains("�") for i in used if layout.format == "csv"]
    place = (
        {"block": F.lit(0).cast("bigint"), "row": F.col("_metadata.row_index")}
        if layout.format == "parquet"
        else {"block": F.col("_metadata.file_block_start"), "row": F.monotonically_increasing_id()}
    )
    rows = df.select(
        one_spelling(F.col("_metadata.file_path")).alias("file_path"),
        *[c.alias(n) for n, c in place.items()],
        *[c.alias(n) for n, c in columns.items()],
        overflow.alias("bad_row"),
        (F.coalesce(reduce(lambda a, b: a | b, broken), F.lit(False)) if broken else F.lit(False)).alias("bad_text"),
        # Text in a text table, numbers in a typed one; several kinds of columns meet as text.
        *[(typed(i) if layout.format == "csv" else text(i)).alias(f"v{i}") for i, _ in layout.variables],
    )
    if layout.variables:
        rows = _unpivoted(rows, layout)
    rows = type_measures(rows)
    attributes = sources.select("file_path", "part", "spec_id", *[F.col(f"`{c}`").alias(n) for n, c in carry.items()])
    small = len(paths) <= BROADCAST_ROWS
    # Beyond the bound rows are shuffled by file; Spark splits a large file's share at run time.
    joined = rows.join(F.broadcast(attributes) if small else attributes, "file_path")
    return joined.withColumn("block", F.col("block") + F.shiftleft(F.col("part").cast("long"), PART_BITS)).select(
        "spec_id", *carry, *[c for c in rows.columns if c != "file_path"])


def _unpivoted(rows: DataFrame, layout: Layout) -> DataFrame:
    """A row per variable column. Their place counts where two columns have one variable."""
    pairs = F.array(*[F.struct(F.lit(name).alias("original_variable"), F.col(f"v{i}").alias("value")) for i, name in layout.variables])
    rest = [c for c in rows.columns if c not in ("value", *(f"v{i}" for i, _ in layout.variables))]
    long = rows.select(*rest, F.posexplode(pairs).alias("nth", "pair"))
    place = F.shiftleft("row", len(layout.variables).bit_length()) + F.col("nth")
    return long.withColumn("row", place).select(*rest, "pair.*")


def scan_all(
    spark: SparkSession, plan: ScanPlan, carry: Mapping[str, str], style: ReadStyle = ReadStyle()
) -> tuple[list[tuple[Layout, DataFrame]], list[str], DataFrame]:
    """One scan per layout, the layouts read, and issues of those that the reader refuses."""
    paths: dict[str, list[str]] = {key: [] for key in plan.layouts}
    # Readers take a list of files, which Spark keeps on the driver in any case.
    for r in plan.sources.filter("layout is not null").select("layout", "file_path").collect():
        paths[r["layout"]].append(r["file_path"])
    scans, read, refused = [], [], {}
    for key in sorted(plan.layouts):
        layout = plan.layouts[key]
        try:
            of_layout = plan.sources.filter(F.col("layout") == key)
            scans.append((layout, scan_group(spark, layout, of_layout, sorted(paths[key]), carry, style)))
            read.append(key)
        except AnalysisException as error:
            refused[key] = error.getCondition()
    failed = spark.createDataFrame(list(refused.items()), "layout string, condition string")
    told = plan.sources.join(F.broadcast(failed), "layout").withColumnsRenamed({"Source model": "source_model", "File name": "file"})
    message = F.concat(F.lit("cannot read "), F.col("file"), F.lit(": "), F.col("condition"))
    return scans, read, issue(told, {"stage": "read", "severity": "error", "message": message}).distinct()


def no_issues(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def all_rows(scans: Sequence[tuple[Layout, DataFrame]]) -> DataFrame:
    return union_sources([rows for _, rows in scans])
