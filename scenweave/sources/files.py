"""The catalog of delivered files, and the names of their columns.

Files are listed and read by Spark alone, so any file system that Spark can open will do. Names of columns come from

* the first record of a delimited file. Small files are read in one scan; of each larger one the first lines only, by a
  ``limit`` that ends its task early. A record that is not closed within ``HEAD_LINES`` lines is an issue of that file;
* the keys of all records of a JSON file, in order of appearance, by one aggregation that combines in the tasks;
* the schema of a Parquet or ORC file, of one part where a table is a folder of parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..fixed import CATALOG_COLUMNS
from ..functions.paths import TABLE_SUFFIX, decode_uri, file_format, file_name, first_dir, one_spelling, parent_dir, rel_path, stem, suffix
from ..plans.staging import new_folder, stage

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
# A workbook is a folder that carries its name and holds one table per sheet.
_BOOK = r"(?i)^(?:(.*)/)?([^/]+\.xlsx?)/([^/]+)$"

#: Lines among which the first record must end, and files up to this size are read in one scan.
HEAD_LINES, SMALL_FILE = 64, 1 << 20
#: Larger files whose first lines are read by one job, and jobs at a time.
HEADS_A_JOB, JOBS = 32, 8

HEADER_SCHEMA = (
    "file_path string, separator string, encoding string, names array<string>, types array<string>, failure string"
)
TABLE_KEYS = ["file_location", "file_name", "sheet_name"]


def plain_root(root: str) -> str:
    return re.sub(r"/+", "/", re.sub(_SCHEME, "", unquote(root) if "://" in root else root)).rstrip("/")


def whole_root(spark: SparkSession, root: str) -> str:
    """The root with its file system and its full path, as Spark would resolve it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()


def list_files(spark: SparkSession, root: str, empty: bool = False) -> DataFrame:
    """Every file below ``root``; contents are not read.

    Names starting with ``_`` or ``.`` are hidden from Spark and stay out. It
    lists files without a byte but does not read them: with ``empty`` they are
    added, from its own list of files.
    """
    whole = whole_root(spark, root)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(load_path(whole))
    files = found.select(one_spelling(F.col("_metadata.file_path")).alias("file_path"), "length")
    if empty:
        names = spark.createDataFrame([(n,) for n in found.inputFiles()], "file_path string").select(one_spelling(F.col("file_path")).alias("file_path"))
        files = files.unionByName(names.join(files, "file_path", "left_anti").withColumn("length", F.lit(0).cast("bigint")))
    plain = F.regexp_replace(decode_uri(F.col("file_path")), _SCHEME, "")
    return files.withColumn("path", rel_path(plain, plain_root(whole))).filter(F.col("path").isNotNull())


def derive_source_model(path: Column, root_name: str) -> Column:
    """First folder below the root; the root's own name for files directly in it."""
    folder = first_dir(path)
    return F.when(folder != "", folder).otherwise(F.lit(root_name))


def locate(files: DataFrame, root_name: str) -> DataFrame:
    """Model, location, file and sheet of each table file.

    A folder that carries the name of a table (``result.parquet/part-0.parquet``)
    is one table of several parts: they share location, file and sheet.
    """
    parent = parent_dir(F.col("path"))
    in_parts = suffix(parent).isin(*TABLE_SUFFIX)
    path = F.when(in_parts, parent).otherwise(F.col("path"))
    book = F.regexp_extract(path, _BOOK, 2)
    sheet_file = F.regexp_extract(path, _BOOK, 3)
    in_book = book != ""
    # A sheet's workbook is what lies directly in a model folder.
    place = F.when(in_book, parent_dir(parent_dir(path))).otherwise(parent_dir(path))
    return files.withColumns(
        {
            "source_model": derive_source_model(
                F.when(in_book, F.regexp_replace(path, r"/[^/]*$", "")).otherwise(path), root_name
            ),
            "file_location": place,
            "file_name": F.when(in_book, book).otherwise(file_name(path)),
            "sheet_name": F.when(in_book, stem(sheet_file)).otherwise(F.lit("")),
            "format": file_format(path),
            "in_book": in_book,
            "suffix": suffix(path),
            "in_parts": in_parts,
        }
    )


def located_files(spark: SparkSession, root: str, empty: bool = False) -> DataFrame:
    return locate(list_files(spark, root, empty), plain_root(whole_root(spark, root)).rsplit("/", 1)[-1])


def load_path(uri: str) -> str:
    """Path of one file for a reader, which would take brackets as wildcards."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text([load_path(p) for p in paths]).select(
        one_spelling(F.col("_metadata.file_path")).alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").cast("binary").alias("line"))


def _first_lines(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The first lines of each file, numbered: ``file_path, n, line``."""
    order = W.partitionBy("file_path").orderBy("block", "row")
    # Readers take a list of files, which Spark keeps on the driver in any case.
    sizes = [(r["file_path"], r["length"]) for r in files.select("file_path", "length").distinct().collect()]
    small = [path for path, length in sizes if length is not None and length <= SMALL_FILE]
    large = [path for path, length in sizes if length is None or length > SMALL_FILE]
    columns = ["file_path", "n", "line"]
    found = spark.createDataFrame([], "file_path string, n int, line binary")
    if small:
        found = found.union(_lines(spark, small).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= HEAD_LINES).select(columns))
    if large:
        whole, folder = _unsplit(spark), new_folder(spark, "heads")

        def head(start: int) -> None:
            each = [_lines(whole, [p]).limit(HEAD_LINES) for p in large[start : start + HEADS_A_JOB]]
            reduce(DataFrame.union, each).write.parquet(f"{folder}/from-{start}")

        with ThreadPoolExecutor(JOBS) as pool:
            list(pool.map(head, range(0, len(large), HEADS_A_JOB)))
        heads = spark.read.schema("file_path string, block bigint, row bigint, line binary").parquet(f"{folder}/*")
        found = found.union(heads.withColumn("n", F.row_number().over(order)).select(columns))
    return found


def _unsplit(spark: SparkSession) -> SparkSession:
    """A session that reads each file in one task, which a limit then ends."""
    whole = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if whole.conf.isModifiable(name) or not name.startswith("spark."):
            whole.conf.set(name, value)
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        whole.conf.set(name, str(1 << 40))
    return whole


def _first_records(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``file_path, record``: the first lines up to the one after which all quotes are closed; NULL if there is none."""
    lines = _first_lines(spark, files)
    quotes = F.octet_length("line") - F.octet_length(F.replace(F.col("line").cast("string"), F.lit('"')))
    upto = W.partitionBy("file_path").orderBy("n")
    open_ = F.sum(quotes).over(upto) % 2
    numbered = lines.withColumn("open", open_)
    last = F.min(F.when(F.col("open") == 0, F.col("n")))
    ends = numbered.groupBy("file_path").agg(last.alias("last"), F.sort_array(F.collect_list(F.struct("n", "line"))).alias("lines"))
    kept = F.filter("lines", lambda x: x["n"] <= F.col("last"))
    hexed = F.array_join(F.transform(kept, lambda x: F.hex(x["line"])), "0A")
    return ends.select("file_path", F.when(F.col("last").isNotNull(), F.unhex(hexed)).alias("record"))


def _delimited(spark: SparkSession, files: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Names of the columns of delimited files, which come with ``separator`` and ``encoding``."""
    wanted = list(candidates)

    def named(cells: list[str]) -> list[str]:
        seen: dict[str, int] = {}
        names: list[str] = []
        for i, cell in enumerate(cells):
            name = base = cell if cell != "" else f"Unnamed: {i}"
            while name in names or (name != base and name in cells):
                seen[base] = seen.get(base, 0) + 1
                name = f"{base}.{seen[base]}"
            names.append(name)
        return names

    def describe(record: bytes | None, separator: str | None, encoding: str | None) -> tuple:
        import csv
        import io

        if record is None:
            return separator, None, None, f"no end of the first record within {HEAD_LINES} lines"
        record, failure = record.removeprefix(b"\xef\xbb\xbf").rstrip(b"\r\n"), None
        try:
            text = record.decode(encoding or "utf-8")
        except UnicodeDecodeError as error:
            text, failure = record.decode("latin-1"), str(error)
        except LookupError:
            return separator, None, None, f"unknown encoding {encoding}"
        if not separator:
            unquoted = re.sub(r'"[^"]*"', "", text)
            separator = max(wanted, key=unquoted.count)
        cells = next(csv.reader(io.StringIO(text), delimiter=separator), []) if text else []
        return separator, named(cells), ["text"] * len(cells), failure or (None if cells else "no columns")

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for uri, separator, encoding, known, record in zip(*(batch[c] for c in ("file_path", "separator", "encoding", "known", "record"))):
                try:
                    found = describe(bytes(record) if record is not None else None, separator or None, encoding or None) if known else (
                        separator, [], [], "no columns")
                except Exception as error:  # one odd header must not end the job
                    found = separator, None, None, str(error) or type(error).__name__
                rows.append((uri, found[0], encoding, *found[1:]))
            yield pd.DataFrame(rows, columns=["file_path", "separator", "encoding", "names", "types", "failure"])

    records = _first_records(spark, files).withColumn("known", F.lit(True))
    asked = files.select("file_path", "separator", "encoding").distinct()
    # A file without lines has no record.
    return asked.join(records, "file_path", "left").withColumn("known", F.coalesce("known", F.lit(False))).mapInPandas(headers, HEADER_SCHEMA)


def _json_names(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Keys of all records of JSON files, in order of appearance."""
    paths = [r["file_path"] for r in files.select("file_path").distinct().collect()]
    keys = F.json_object_keys(F.ltrim(F.col("line").cast("string"), F.lit("\ufeff \t")))
    each = _lines(spark, paths).select("file_path", "block", "row", F.posexplode(keys).alias("at", "key"))
    first = each.groupBy("file_path", "key").agg(F.min(F.struct("block", "row", "at")).alias("first"))
    found = first.groupBy("file_path").agg(F.transform(F.sort_array(F.collect_list(F.struct("first", "key"))), lambda x: x["key"]).alias("names"))
    asked = files.select("file_path", "separator", "encoding").distinct()
    names = F.coalesce("names", F.array().cast("array<string>"))
    return asked.join(found, "file_path", "left").select(
        "file_path", "separator", "encoding", names.alias("names"), F.transform(names, lambda _: F.lit("json")).alias("types"),
        F.when(F.size(names) == 0, "no columns").alias("failure"))


def _schemas(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Names and types of Parquet and ORC files, as Spark's readers find them."""
    def schema(row) -> tuple:
        try:
            fields = spark.read.format(row["format"]).load(load_path(row["file_path"])).schema
            return (row["file_path"], [f.name for f in fields], [f.dataType.simpleString() for f in fields], None)
        except Exception as error:  # one unreadable file must not end the job
            return (row["file_path"], None, None, str(error).strip().split("\n")[0][:200] or type(error).__name__)

    asked = files.select("file_path", "format").distinct().collect()
    with ThreadPoolExecutor(JOBS) as pool:
        rows = list(pool.map(schema, asked))
    found = spark.createDataFrame(rows, "file_path string, names array<string>, types array<string>, failure string")
    return files.select("file_path", "separator", "encoding").distinct().join(found, "file_path")


def read_headers(files: DataFrame, candidates: Sequence[str] = (";", ",", "\t")) -> DataFrame:
    """Column names of each file, from its first record, its records or its schema.

    ``files`` has ``file_path``, ``format`` and ``separator``, and may have
    ``encoding`` and ``length``; a NULL separator is chosen among ``candidates``
    by the number of times it occurs, a NULL encoding is UTF-8. What is
    returned is written once: one row per file, separator and encoding.
    """
    spark = files.sparkSession
    for name, kind in (("encoding", "string"), ("length", "bigint")):
        if name not in files.columns:
            files = files.withColumn(name, F.lit(None).cast(kind))
    wanted = files.select(one_spelling(F.col("file_path")).alias("file_path"), "format", "separator", "encoding", "length").distinct()
    files = spark.createDataFrame(wanted.toArrow())
    kinds = {r["format"] for r in files.select("format").distinct().collect()}
    found = spark.createDataFrame([], HEADER_SCHEMA)
    if "csv" in kinds:
        found = found.unionByName(_delimited(spark, files.filter("format = 'csv'"), candidates))
    if "json" in kinds:
        found = found.unionByName(_json_names(spark, files.filter("format = 'json'")))
    if kinds & {"parquet", "orc"}:
        found = found.unionByName(_schemas(spark, files.filter("format in ('parquet', 'orc')")))
    return stage(found, "headers")


def catalog_files(
    spark: SparkSession, root: str, candidates: Sequence[str] = (";", ",", "\t")
) -> DataFrame:
    """One row per table file, sheet or folder of parts, with its column names.

    An unreadable table keeps its row, with no column names; so does an empty one.
    """
    files = located_files(spark, root, empty=True).filter(F.col("format").isNotNull())
    # One part stands for a table of several, but JSON parts have the names of all.
    found = stage(files.withColumn("separator", F.lit(None).cast("string")), "catalog")
    headers = read_headers(_one_part(found), candidates).select("file_path", "names")
    names = found.join(headers, "file_path").select(*TABLE_KEYS, "names").groupBy(*TABLE_KEYS).agg(_joined_names().alias("names"))
    return found.select("source_model", *TABLE_KEYS).distinct().join(names, TABLE_KEYS, "left").select(
        "source_model", *TABLE_KEYS, F.coalesce(F.array_join("names", ", "), F.lit("")).alias("column_names"))


def _one_part(files: DataFrame) -> DataFrame:
    """One file of each table but JSON, whose names are those of all records."""
    json, rest = files.filter("format = 'json'"), files.filter("format <> 'json'")
    best = rest.groupBy(*TABLE_KEYS).agg(F.min_by(F.struct(*files.columns), F.struct(F.col("length") == 0, "file_path")).alias("f"))
    return best.select("f.*").select(files.columns).unionByName(json)


def _joined_names() -> Column:
    """Names of the parts of a table, in order of appearance."""
    return F.array_distinct(F.flatten(F.collect_list("names")))


def write_catalog(catalog: DataFrame, path: str) -> bool:
    """Write the catalog under its published headings; nothing when it is empty."""
    if catalog.isEmpty():
        return False
    named = catalog.select(
        *[F.col(c).alias(n) for c, n in zip(
            ["source_model", "file_location", "file_name", "sheet_name", "column_names"], CATALOG_COLUMNS)]
    )
    named.orderBy("File location", "File name", "Sheet name").write.mode("overwrite").option("header", "true").csv(path)
    return True
