"""Whole runs on delivered files: the golden case and the file handling around it."""

import pytest

from scenweave import (
    catalog_files,
    convert_regions,
    harmonize,
    harmonize_legacy,
    legacy_wide,
    load_specs,
    read_dictionary_table,
    spec_summary,
    to_wide,
    write_catalog,
    write_iamc,
    write_legacy,
    write_report,
)
from scenweave.operators import load_dictionary, render_report

SPEC = "`File location` string, `File name` string, `Source model` string, `Sheet name` string, Separator string, `Variable column` string"

FILE_1 = """scenario,region,Kind,Good,unit,year,value,comment
base,AT,Prod,Steel,kt,2020,1.0,x
base,AT,Prod,Steel,kt,2030,2.0,
base,DE,Prod,Steel,t,2020,5.0,
base,DE,Prod,Steel,t,2020,5.0,
base,DE,Prod,Steel,t,2030,6.0,
,,,,,,,
"""
FILE_2 = """Scenario;AREA;Kind;Good;Unit;TIME;VAL
base;DE;Prod;Steel;t;2030;7.0
base;XX;Prod;Steel;t;2020;9.0
base;AT;Prod;Ghost;t;2020;9.0
base;AT;Prod;Alu;furlong;2020;4.0
base;FR;Prod;Alu;t;2020;
base;FR;Prod;Alu;t;2020;3.0
base;ES;Prod;Alu;t;2020;NA
base;ES;Prod;Alu;t;2020.0;
"""
GOLDEN = [
    ("M1", "Base", "Austria", "Production|Aluminium", None, 4.0, None),
    ("M1", "Base", "Austria", "Production|Steel", "Mt", 0.001, 0.002),
    ("M1", "Base", "France", "Production|Aluminium", "t", None, None),
    ("M1", "Base", "Germany", "Production|Steel", "t", 5.0, None),
    ("M1", "Base", "dup_Germany_1", "Production|Steel", "t", None, 6.0),
    ("M1", "Base", "dup_Germany_2", "Production|Steel", "t", None, 7.0),
    ("M1", "Base", "dup_Spain_1", "Production|Aluminium", "t", None, None),
    ("M1", "Base", "dup_Spain_2", "Production|Aluminium", "t", None, None),
]


def put(root, path, text):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(text if isinstance(text, bytes) else text.encode())


def overview(spark, *rows):
    return load_specs(spark.createDataFrame(list(rows), SPEC))


@pytest.fixture
def delivery(tmp_path):
    put(tmp_path, "1b M1/run [v2] + x/one.csv", FILE_1)
    put(tmp_path, "1b M1/run [v2] + x/two.CSV", FILE_2)
    return tmp_path


SPECS = [
    ("1b M1\\run [v2] + x", "one.csv", "M1", "", "", "Kind|Good"),
    ("1b M1/run [v2] + x", "two.CSV", "M1", None, ";", " Kind | Good "),
]


@pytest.mark.parametrize(("stage_rows", "chunk_bits"), [(False, 0), (True, 20)])
def test_golden(spark, delivery, dictionaries, rows, stage_rows, chunk_bits):
    run = harmonize(
        spark, str(delivery), overview(spark, *SPECS), dictionaries(), stage_rows=stage_rows, chunk_bits=chunk_bits
    )
    wide = to_wide(run.harmonized).drop("source_model")
    assert wide.columns == ["model", "scenario", "region", "variable", "unit", "2020", "2030"]
    assert rows(wide) == sorted(GOLDEN, key=repr)
    lines = [r["line"] for r in render_report(run.issues).collect()]
    assert lines == [
        "=== M1 ===",
        "--- one.csv ---",
        "source model M1 is not in the dictionary",
        "--- two.CSV ---",
        "1 Variables not in the dictionary:",
        "Prod|Ghost - t",
        "1 Regions not in the dictionary:",
        "XX - t",
        "1 Units not in the dictionary:",
        "furlong",
        "source model M1 is not in the dictionary",
        "8 rows in duplicate groups",
        "2 identical rows removed",
        "4 differing rows renamed",
    ]


def test_colliding_region_withholds_its_model_only(spark, delivery, dictionaries, rows):
    put(delivery, "1b M1/more.csv", "scenario,region,variable,unit,year,value\nbase,D1,Prod|Steel,t,2030,8\n")
    put(delivery, "M2/clean.csv", "scenario,region,variable,unit,year,value\nbase,AT,Prod|Steel,t,2030,8\n")
    specs = [*SPECS, ("1b M1", "more.csv", "M1", "", "", "variable"), ("M2", "clean.csv", "M2", "", "", "variable")]
    run = harmonize(spark, str(delivery), overview(spark, *specs), dictionaries([("D1", "dup_Germany_1")]))
    assert run.harmonized.can_collide
    assert rows(to_wide(run.harmonized)) == [("M2", "M2", "Base", "Austria", "Production|Steel", "t", None, 8.0)]
    failed = run.issues.filter("stage = 'pivot'").collect()
    assert [(r["source_model"], r["n"]) for r in failed] == [("M1", 1)]


def test_two_models_with_one_target_are_not_compared(spark, tmp_path, dictionaries, rows):
    text = "scenario,region,variable,unit,year,value\nbase,AT,Prod|Steel,t,2030,8\n"
    put(tmp_path, "A/x.csv", text)
    put(tmp_path, "B/x.csv", text)
    specs = [("A", "x.csv", "A", "", "", "variable"), ("B", "x.csv", "B", "", "", "variable")]
    run = harmonize(spark, str(tmp_path), overview(spark, *specs), dictionaries(models=[("A", "Z"), ("B", "Z")]))
    assert [r[:2] for r in rows(run.long)] == [("A", "Z"), ("B", "Z")]


def test_files_that_cannot_be_used_are_set_apart(spark, tmp_path, dictionaries, rows):
    head = "scenario,region,variable,unit,year,value\n"
    put(tmp_path, "M/good.csv", head + "base,AT,Prod|Steel,t,2030,8,,\nbase,AT,Prod|Alu,t,2030,8,9\nbase,AT,Prod|Alu,t\n"
        + "base,AT,Prod|Alu,t,2040,n.a.\nbase,AT,Prod|Alu,t,soon,1\nbase,AT,Prod|Alu,t,2020.5,1\n")
    put(tmp_path, "M/no unit.csv", "scenario,region,variable,year,value\nbase,AT,Prod|Steel,2030,8\n")
    put(tmp_path, "M/no region.csv", "scenario,variable,unit,year,value\nbase,Prod|Nil,t,2030,8\n")
    put(tmp_path, "M/empty.csv", "")
    put(tmp_path, "M/latin.csv", "scenario,region,variable,unit,year,value,Größe\n".encode("latin-1"))
    put(tmp_path, "M/nothing.csv", head + "base,ZZ,Prod|Steel,t,2030,8\n")
    put(tmp_path, "M/table.xls", "x")
    names = ["good.csv", "no unit.csv", "no region.csv", "empty.csv", "latin.csv", "nothing.csv", "table.xls", "absent.csv"]
    specs = [("M", n, "M", "", "", "variable") for n in names] + [("M", "good.csv", "M", "", "", "variable|Part")]
    run = harmonize(spark, str(tmp_path), overview(spark, *specs), dictionaries())
    assert rows(run.long.select("variable", "year", "value")) == [
        ("Production|Aluminium", 2040, None), ("Production|Steel", 2030, 8.0)]
    said = {(r["file"], r["stage"], r["n"]) for r in run.issues.filter("stage not in ('source', 'duplicates') and severity <> 'found'").collect()}
    assert said == {
        ("good.csv", "values", 1), ("good.csv", "values", 3), ("good.csv", "model", None),
        ("good.csv", "columns", None), ("no unit.csv", "columns", None), ("no region.csv", "columns", None),
        ("no region.csv", "Variables", 1), ("no region.csv", "empty", None),
        ("empty.csv", "read", None), ("latin.csv", "read", None), ("table.xls", "read", None),
        ("absent.csv", "read", None), ("nothing.csv", "Regions", 1), ("nothing.csv", "empty", None),
    }


def test_headers_that_differ_in_case_or_order(spark, tmp_path, dictionaries, rows):
    put(tmp_path, "M/a.csv", "region,scenario,Unit,unit,variable,Value,year\nAT,base,t,ignored,Prod|Alu,1,2020\n")
    put(tmp_path, "M/b.csv", "scenario,region,Unit,unit,variable,Value,year\nbase,DE,kt,ignored,Prod|Alu,1,2020\n")
    specs = [("M", n, "M", "", "", "variable") for n in ("a.csv", "b.csv")]
    run = harmonize(spark, str(tmp_path), overview(spark, *specs), dictionaries())
    assert rows(run.long.select("region", "unit", "value")) == [("Austria", "t", 1.0), ("Germany", "Mt", 0.001)]
    assert run.issues.filter("message like '%given twice%'").count() == 2


def test_one_file_under_two_rules_and_renamed_parts(spark, tmp_path, dictionaries, rows):
    put(tmp_path, "M/a.csv", "scenario,Region,Unit,A,B,Value,Year\nbase,AT,t,Prod|Alu,Prod|Steel,1,2020\n")
    specs = [("M", "a.csv", "M", "", "", "A"), ("M", "a.csv", "M", "", "", "B"), ("M", "a.csv", "M", "", "", "Region|A")]
    run = harmonize(spark, str(tmp_path), overview(spark, *specs), dictionaries())
    assert rows(run.long.select("variable")) == [("Production|Aluminium",), ("Production|Steel",)]
    assert run.issues.filter("key is not null or message = 'AT|Prod|Alu - t'").count() == 1
    strict = harmonize(spark, str(tmp_path), overview(spark, *specs), dictionaries(), strict_names=True)
    assert strict.issues.filter("stage = 'columns' and message like \"no column 'Region'%\"").count() == 1


def test_sheets_of_a_workbook_folder(spark, tmp_path, dictionaries, rows):
    table = spark.createDataFrame(
        [(0, "base", "AT", 1.5, True, "t", 2020, 2.0), (1, "base", "DE", 1e20, False, "t", 2030, float("nan"))],
        "`Unnamed: 0` int, scenario string, region string, a double, b boolean, unit string, year int, value double",
    )
    import pyarrow.parquet as pq

    (tmp_path / "M/book.xlsx").mkdir(parents=True)
    pq.write_table(table.toArrow(), tmp_path / "M/book.xlsx/Data.parquet")
    pq.write_table(table.toArrow(), tmp_path / "M/book.xlsx/Other.parquet")
    regions = dictionaries()
    regions["variables"] = load_dictionary(
        spark.createDataFrame([("1.5|True", "x"), ("1e+20|False", "y")], "s string, t string"), "s", "t")
    run = harmonize(spark, str(tmp_path), overview(
        spark, ("M", "book.xlsx", "M", "Other", "", "a|b"), ("M", "book.xlsx", "N", "", "", "a|b"),
        ("M", "book.xlsx", "N", "Data", "", "Unnamed: 0|b")), regions)
    assert rows(run.long.select("source_model", "variable", "value")) == [
        ("M", "x", 2.0), ("M", "y", None), ("N", "x", 2.0), ("N", "y", None)]
    assert run.issues.filter("stage = 'columns' and severity = 'error'").count() == 1
    assert rows(catalog_files(spark, str(tmp_path)).select("file_name", "sheet_name", "column_names")) == [
        ("book.xlsx", s, "Unnamed: 0, scenario, region, a, b, unit, year, value") for s in ("Data", "Other")]


def test_other_formats(spark, tmp_path, dictionaries, rows):
    import pyarrow as pa
    from pyarrow import orc

    table = pa.table({"scenario": ["base", "base"], "region": ["AT", "DE"], "variable": ["Prod|Alu"] * 2,
                      "unit": ["t", "kt"], "year": [2020, 2020], "value": [1.0, 2.0]})
    (tmp_path / "M/book.xlsx").mkdir(parents=True)
    orc.write_table(table, tmp_path / "M/book.xlsx/A.orc")
    lines = [f'{{"scenario":"base","region":"{r}","variable":"Prod|Alu","unit":"t","year":2030,"value":{v}}}' for r, v in (("AT", 3), ("FR", "null"))]
    put(tmp_path, "M/book.xlsx/B.json", "\n".join(lines) + "\n")
    specs = [("M", "book.xlsx", "M", sheet, "", "variable") for sheet in ("A", "B", "C")]
    run = harmonize(spark, str(tmp_path), overview(spark, *specs), dictionaries())
    assert rows(run.long.select("region", "year", "value")) == [
        ("Austria", 2020, 1.0), ("Austria", 2030, 3.0), ("France", 2030, None), ("Germany", 2020, 0.002)]
    assert run.issues.filter("stage = 'read'").count() == 1


def test_catalog(spark, delivery, rows, tmp_path):
    put(delivery, "top.csv", "﻿a;b,c;\"d;e\"\n1;2;3\n")
    put(delivery, "M/deep/er/t.csv", "x\ty,z,,z\n")
    put(delivery, "M/deep/blank.csv", "\n")
    put(delivery, "M/quoted.csv", '"a,b,c";"x\ny"\n1;2\n')
    put(delivery, "M/latin.csv", "Größe,b\n".encode("latin-1"))
    put(delivery, "M/notes.txt", "x\n")
    put(delivery, "M/real.xlsx", "not a folder")
    catalog = catalog_files(spark, str(delivery))
    header = "Scenario, AREA, Kind, Good, Unit, TIME, VAL"
    assert rows(catalog) == sorted([
        ("1b M1", "1b M1/run [v2] + x", "one.csv", "", "scenario, region, Kind, Good, unit, year, value, comment"),
        ("1b M1", "1b M1/run [v2] + x", "two.CSV", "", header),
        ("M", "M", "latin.csv", "", "Größe, b"),
        ("M", "M/deep", "blank.csv", "", ""),
        ("M", "M", "quoted.csv", "", "a,b,c, x\ny"),
        ("M", "M/deep/er", "t.csv", "", "x\ty, z, Unnamed: 2, z.1"),
        (delivery.name, "", "top.csv", "", "a, b,c, d;e"),
    ], key=repr)
    out = tmp_path / "catalog"
    assert write_catalog(catalog, str(out))
    assert spark.read.option("header", True).csv(str(out)).columns == [
        "Source model", "File location", "File name", "Sheet name", "Column names"]
    (tmp_path / "bare").mkdir()
    assert not write_catalog(catalog_files(spark, str(tmp_path / "bare")), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_input_order_survives_splits(spark, tmp_path, dictionaries, rows):
    """Numbers of duplicates follow the file, however it is cut into splits."""
    n = 20000
    lines = [f"base,AT,Prod|Steel,t,2020,{i}" for i in range(n)]
    put(tmp_path, "M/big.csv", "scenario,region,variable,unit,year,value\n" + "\n".join(lines) + "\n")
    put(tmp_path, "M/a small.csv", "scenario,region,variable,unit,year,value\nbase,AT,Prod|Steel,t,2020,-1\n")
    specs = [("M", "big.csv", "M", "", "", "variable"), ("M", "a small.csv", "M", "", "", "variable")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        run = harmonize(spark, str(tmp_path), overview(spark, *specs), dictionaries(), chunk_bits=7)
        got = {r["region"]: r["value"] for r in run.long.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {f"dup_Austria_{i + 1}": float(i) for i in range(n)} | {f"dup_Austria_{n + 1}": -1.0}
    assert got == want


def test_written_forms(spark, delivery, dictionaries, rows, tmp_path):
    put(delivery, "M2/clean.csv", "scenario,region,variable,unit,year,value\nbase,AT,Prod|Steel,t,2035,8\n")
    run = harmonize(spark, str(delivery), overview(spark, *SPECS, ("M2", "clean.csv", "M2", "", "", "variable")), dictionaries())
    write_iamc(run.long, str(tmp_path / "long"))
    long = spark.read.parquet(str(tmp_path / "long"))
    assert rows(long.select(run.long.columns)) == rows(run.long)
    write_iamc(long, str(tmp_path / "wide"), "wide")
    wide = spark.read.option("header", True).csv(str(tmp_path / "wide"))
    assert {"2020", "2030", "2035", "source_model"} <= set(wide.columns) and wide.count() == 9
    write_iamc(long, str(tmp_path / "split"), "per_model")
    one = spark.read.option("header", True).csv(str(tmp_path / "split/pyam_M2"))
    assert [tuple(r) for r in one.collect()] == [("M2", "Base", "Austria", "Production|Steel", "t", "8.0")]
    assert one.columns[-1] == "2035"
    write_report(run.issues, str(tmp_path / "report"))
    text = [r[0] for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert text[0] == "=== M1 ===" and "--- clean.csv ---" in text


def test_dictionary_files_and_summary(spark, tmp_path, rows):
    put(tmp_path, "units.csv", "source_unit,target_unit,conversion_factor\nkt,t,1000\nkt,NA,5\nt,t,\n")
    table = read_dictionary_table(spark, str(tmp_path / "units.csv"))
    units = load_dictionary(table, "source_unit", "target_unit", "conversion_factor", ["seq"])
    assert rows(units) == [("kt", "t", 1000.0), ("t", "t", 1.0)]
    with pytest.raises(KeyError):
        load_dictionary(table, "source_unit", "target_unit", "factor")
    specs = overview(spark, *SPECS, ("x", "one.csv", "M2", "", "", "v"), ("x", "one.csv", "M2", "2", "", "v"))
    assert rows(spec_summary(specs)) == [(4, 3, 2)]


def test_region_table(spark, tmp_path, rows):
    put(tmp_path, "regions.csv", "source_region,note,target_region\nEUR,x,\nde,y,old\n ,z,\nNA,,\nQQ,,\n")
    codes = spark.createDataFrame([("DE", "Germany"), ("NA", "Namibia")], "source string, target string")
    path = str(tmp_path / "regions.csv")
    done = convert_regions(spark, path, codes, keep=("source_region",))
    out = spark.read.option("header", True).csv(str(tmp_path / "regions_regions_fullname"))
    assert rows(out.select("note", "target_region").filter("note is not null")) == [("x", "Europe"), ("y", "Germany"), ("z", None)]
    assert done.coverage.first().asDict() == {"total": 5, "converted": 3, "percent": 60.0}
    assert [r[0] for r in done.misses.collect()] == [" ", "QQ"]
    assert convert_regions(spark, path, codes, out=str(tmp_path / "o")).coverage.first()["converted"] == 2
    with pytest.raises(KeyError):
        convert_regions(spark, path, codes, column="region")


def test_legacy(spark, tmp_path, rows):
    put(tmp_path, "M/a 250424.csv", "idx, Kind ,Good,R,S,Y,V,U\n0,P,Steel,AT,s,2020,1,t\n1,P,Steel,AT,s,2020,2,t\n"
        "2,P,,AT,s,2020,4,t\n3,P,Alu,DE,s,2030,,t\n4,P,Alu,,s,2030,7,t\n5,Q,x,AT,s,2020,9,t\n")
    put(tmp_path, "M/b.csv", "model,Kind,R,S,Y,V\nmine,k,AT,s,2020,1\n")
    legacy = SPEC + (", `Variable value (original)` string, `Variable name (new)` string, `Source Scenario` string, "
                     "`Source Region` string, `Source Year` string, `Source Value` string, `Source Unit` string, Unit string")
    common = ("S", "R", "Y", "V")
    first = ("M", "a 250424.csv", "Model A", "", "", "Kind|Good")
    specs = spark.createDataFrame([
        (*first, "P | Steel", "Steel", *common, "U", None), (*first, "P | nan", "Total", *common, "U", None),
        (*first, "P | Alu", "Alu", *common, "U", None),
        ("M", "b.csv", "model", "", "", "Kind", "k", "K", *common, None, None),
        ("M", "b.csv", "", "", "", "Kind", "k", "K", *common, None, "kg"),
        ("M", "b.csv", "none", "", "", "Kind", "other", "K", *common, None, "kg"),
        ("M", "b.csv", "bad", "", "", "idx", "k", "K", *common, None, "kg"),
        (*first[:2], "by index", *first[3:5], "idx", "0", "zero", *common, "U", None),
    ], legacy)
    regions = load_dictionary(spark.createDataFrame([("AT", "Austria")], "s string, t string"), "s", "t")
    run = harmonize_legacy(spark, str(tmp_path), load_specs(specs, legacy=True), regions)
    write_legacy(run.long, str(tmp_path / "out"))
    out = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert {r["output"] for r in out.collect()} == {"pyam_Model A-a 250424", "pyam_model-b", "pyam_-b"}
    assert rows(legacy_wide(run.long).drop("spec_id")) == sorted([
        ("Model A", "s", "Austria", "Steel", "t", 3.0, None),
        ("Model A", "s", "Austria", "Total", "t", 4.0, None),
        ("Model A", "s", "DE", "Alu", "t", None, 0.0),
        ("Unknown Model", "s", "Austria", "K", "kg", 1.0, None),
        ("mine", "s", "Austria", "K", "undefined", 1.0, None),
    ], key=repr)
    said = {(r["source_model"], r["stage"], r["message"]) for r in run.issues.collect()}
    assert said == {
        ("Model A", "Variables", "1 Variables not in the dictionary:"), ("Model A", "Variables", "Q | x - t"),
        ("Model A", "Regions", "DE (kept)"), ("Model A", "values", "1 rows lack model, scenario, region or unit and are left out"),
        ("none", "Variables", "1 Variables not in the dictionary:"), ("none", "Variables", "k - kg"),
        ("none", "empty", "no valid data in b.csv"),
        ("bad", "columns", "no column 'idx', source skipped"), ("by index", "columns", "no column 'idx', source skipped"),
    }


def test_headers_of_odd_quotes_repeated_names_and_late_json_columns(spark, tmp_path):
    import time

    from scenweave.sources.files import read_headers

    (tmp_path / "quote.csv").write_text('a,5" pipe,c\n' + "1,2,3\n" * 2_000_000)
    (tmp_path / "large.csv").write_text('"a,b","c\nd"\n' + "1,2\n" * 2_000_000)
    (tmp_path / "names.csv").write_text("a,a,a.1\n1,2,3\n")
    (tmp_path / "late.json").write_text('{"x": 1}\n\n{"x": 2, "region": "AT"}\n')
    files = spark.createDataFrame(
        [(f"file://{tmp_path}/{n}", k, ",") for n, k in (("quote.csv", "csv"), ("large.csv", "csv"), ("names.csv", "csv"), ("late.json", "json"))],
        "file_path string, format string, separator string",
    )
    start = time.time()
    got = {r["file_path"].rsplit("/", 1)[1]: r for r in read_headers(files).collect()}
    assert time.time() - start < 60
    names = got["names.csv"]["names"]
    assert len(set(names)) == 3 and names[0] == "a" and names[2] == "a.1"
    assert got["large.csv"]["names"] == ["a,b", "c\nd"]
    assert got["late.json"]["names"] == ["x", "region"]
    assert got["quote.csv"]["names"] is None and "no end of the first record" in got["quote.csv"]["failure"]


HEAD = "scenario,region,variable,unit,year,value\n"


def test_relative_root_and_look_alike_folders(spark, tmp_path, dictionaries, rows, monkeypatch):
    """A root is the folder itself, not whatever path holds its name; the JVM keeps the folder that it was started in."""
    import os

    put(tmp_path, "data/M/a.csv", HEAD + "base,AT,Prod|Steel,t,2030,8\n")
    put(tmp_path, "data/M/data/b.csv", HEAD + "base,DE,Prod|Steel,t,2030,9\n")
    relative = os.path.relpath(tmp_path / "data", spark._jvm.java.lang.System.getProperty("user.dir"))
    specs = [("M", "a.csv", "M", "", "", "variable"), ("M/data", "b.csv", "M", "", "", "variable")]
    for root in (relative, f"file://{tmp_path}/data/"):
        run = harmonize(spark, root, overview(spark, *specs), dictionaries())
        assert rows(run.long.select("region", "value")) == [("Austria", 8.0), ("Germany", 9.0)]
    assert rows(catalog_files(spark, relative).select("source_model", "file_location")) == [("M", "M"), ("M", "M/data")]


def test_folders_of_parts(spark, tmp_path, dictionaries, rows):
    """What Spark has written is one table, in each format; keys of JSON records may be missing in a part."""
    table = spark.createDataFrame(
        [("base", "AT", "Prod|Steel", "t", 2000 + i, float(i)) for i in range(40)],
        "scenario string, region string, variable string, unit string, year int, value double")
    for kind in ("parquet", "orc", "json"):
        table.repartition(4, "year").write.format(kind).save(str(tmp_path / f"M/all.{kind}"))
    table.repartition(3).write.option("header", True).csv(str(tmp_path / "M/all.csv"))
    table.coalesce(1).write.parquet(str(tmp_path / "M/book.xlsx/Sheet.parquet"))
    put(tmp_path, "M/late.json/part-0.json", '{"scenario":"base","region":"AT","variable":"Prod|Steel","year":2020,"value":1}\n')
    put(tmp_path, "M/late.json/part-1.json", '{"scenario":"base","region":"DE","variable":"Prod|Steel","year":2020,"value":1,"unit":"kt"}\n')
    whole = ["all.parquet", "all.orc", "all.json", "all.csv", "book.xlsx"]
    specs = [("M", name, name, "Sheet" if name == "book.xlsx" else "", "", "variable") for name in [*whole, "late.json"]]
    run = harmonize(spark, str(tmp_path), overview(spark, *specs), dictionaries())
    assert rows(run.long.filter("model <> 'late.json'").select("model", "year", "value")) == sorted(
        ((name, 2000 + i, float(i)) for name in whole for i in range(40)), key=repr)
    assert run.issues.filter("severity = 'found'").count() == 6
    assert rows(run.long.filter("model = 'late.json'").select("region", "unit", "value")) == [("Austria", None, 1.0), ("Germany", "Mt", 0.001)]
    listed = rows(catalog_files(spark, str(tmp_path)).select("file_name", "sheet_name", "column_names"))
    columns = "scenario, region, variable, unit, year, value"
    assert listed == sorted([
        *[(f"all.{k}", "", columns) for k in ("csv", "json", "orc", "parquet")], ("book.xlsx", "Sheet", columns),
        ("late.json", "", "scenario, region, variable, year, value, unit")])


def test_parts_keep_the_order_of_their_names(spark, tmp_path, dictionaries):
    for i in range(3):
        put(tmp_path, f"M/x.csv/part-{i}.csv", HEAD + "".join(f"base,AT,Prod|Steel,t,2020,{10 * i + k}\n" for k in range(5)))
    run = harmonize(spark, str(tmp_path), overview(spark, ("M", "x.csv", "M", "", "", "variable")), dictionaries())
    got = {r["region"]: r["value"] for r in run.long.collect()}
    assert got == {f"dup_Austria_{5 * i + k + 1}": float(10 * i + k) for i in range(3) for k in range(5)}


def test_encodings(spark, tmp_path, dictionaries, rows):
    text = "scenario,region,variable,unit,year,value\nbase,Österreich,Prod|Steel,t,2030,8\nbase,AT,Prod|Steel,t,2030,9\n"
    put(tmp_path, "M/latin.csv", text.encode("latin-1"))
    put(tmp_path, "M/header.csv", text.replace("unit", "unité,unit").replace("t,20", "t,t,20").encode("latin-1"))
    put(tmp_path, "M/plain.csv", text)
    spec = SPEC + ", Encoding string"
    told = [("M", n, "M", "", "", "variable", e) for n, e in (
        ("latin.csv", "iso-8859-1"), ("latin.csv", None), ("header.csv", "ISO-8859-1"), ("header.csv", ""), ("plain.csv", "UTF-8"), ("plain.csv", "klingon"))]
    run = harmonize(spark, str(tmp_path), load_specs(spark.createDataFrame(told, spec)), dictionaries([("Österreich", "Austria")]), chunk_bits=0)
    assert run.long.filter("region like '%Austria%'").count() == 7
    said = {(r["spec_id"], r["stage"], r["severity"], r["n"]) for r in run.issues.filter("stage in ('read', 'values')").collect()}
    assert len(said) == 3
    assert {(stage, n) for _, stage, _, n in said} == {("values", 1), ("read", None)}
    assert run.issues.filter("message like '%unknown encoding KLINGON%'").count() == 1
    assert run.issues.filter("message like '%not written in the encoding%'").count() == 1


def test_thousands_of_files_in_one_plan(spark, tmp_path, dictionaries, rows):
    """The plan depends on layouts, not on files, and no list of specifications is bounded."""
    import re

    heads = [HEAD, "region,scenario,variable,unit,year,value\n", "variable;unit;scenario;region;year;value\n"]
    lines = ["base,AT,Prod|Steel,t,2030,{}\n", "AT,base,Prod|Steel,t,2030,{}\n", "Prod|Steel;t;base;AT;2030;{}\n"]

    def build(n, folder):
        for i in range(n):
            put(folder, f"M{i % 7}/f{i}.csv", heads[i % 3] + lines[i % 3].format(i))
        specs = [(f"M{i % 7}", f"f{i}.csv", f"M{i}", "", ";" if i % 3 == 2 else "", "variable") for i in range(n)]
        return harmonize(spark, str(folder), overview(spark, *specs), dictionaries())

    small, large = build(6, tmp_path / "small"), build(2000, tmp_path / "large")
    assert rows(large.long.select("source_model", "value")) == sorted(((f"M{i}", float(i)) for i in range(2000)), key=repr)
    nodes = [len(re.findall("FileScan|Scan |Join|Exchange", r.long._jdf.queryExecution().executedPlan().toString())) for r in (small, large)]
    assert nodes[0] == nodes[1]
    assert large.issues.filter("stage = 'source'").count() == 2000


def test_empty_files_are_in_the_catalog(spark, tmp_path, rows):
    put(tmp_path, "M/none.csv", "")
    put(tmp_path, "M/some.csv", "a,b\n")
    assert rows(catalog_files(spark, str(tmp_path)).select("file_name", "column_names")) == [("none.csv", ""), ("some.csv", "a, b")]


def test_legacy_reports_every_row_it_leaves_out(spark, tmp_path, rows):
    body = "P,AT,s,2020,1,t\nP,AT,s,2020,1,t,more\nP,AT,s,soon,1,t\nP,AT,s,2020,many,t\nP,,s,2020,1,t\nQ,AT,s,2020,1,t\n"
    put(tmp_path, "M/a.csv", "K,R,S,Y,V,U\n" + body)
    put(tmp_path, "M/bad.parquet", "no such thing")
    legacy = SPEC + (", `Variable value (original)` string, `Variable name (new)` string, `Source Scenario` string, "
                     "`Source Region` string, `Source Year` string, `Source Value` string, `Source Unit` string, Unit string")
    rest = ("K", "P", "Steel", "S", "R", "Y", "V", "U", None)
    specs = spark.createDataFrame([("M", "a.csv", "A", "", "", *rest), ("M", "bad.parquet", "A", "", "", *rest)], legacy)
    run = harmonize_legacy(spark, str(tmp_path), specs)
    assert rows(legacy_wide(run.long).drop("spec_id")) == [("A", "s", "AT", "Steel", "t", 1.0)]
    said = {(r["file"], r["message"].split(" ", 1)[1] if r["n"] else r["stage"], r["n"]) for r in run.issues.collect()}
    assert said == {
        ("a.csv", "rows have more fields than the header and are left out", 1), ("a.csv", "rows have no whole-number year and are left out", 1),
        ("a.csv", "values are no numbers and count as missing", 1), ("a.csv", "rows lack model, scenario, region or unit and are left out", 1),
        ("a.csv", "Variables not in the dictionary:", 1), ("a.csv", "- t", 1), ("bad.parquet", "read", None),
    }


def test_per_model_runs_a_job_per_set_of_years(spark, tmp_path):
    """Many models with two sets of years: two writes, a folder per model with its own years, rows in order."""
    n = 300
    long = spark.range(n * 4).selectExpr(
        "concat('m ', id % 300) as source_model", "concat('m ', id % 300) as model", "'s' as scenario", "concat('r', id) as region", "'v' as variable",
        "'u' as unit", "cast(if(id % 300 < 100, 2020, 2030) + id % 2 as int) as year", "cast(id as double) as value")
    before = spark._jvm.java.lang.System.nanoTime()
    write_iamc(long, str(tmp_path / "out"), "per_model")
    assert spark._jvm.java.lang.System.nanoTime() - before < 120e9
    folders = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert folders == sorted(f"pyam_m {i}" for i in range(n))
    for i in (7, 250):
        back = spark.read.option("header", True).csv(str(tmp_path / f"out/pyam_m {i}"))
        years = [str((2020 if i < 100 else 2030) + i % 2)]
        assert back.columns == ["model", "scenario", "region", "variable", "unit", *years]
        assert [r["region"] for r in back.collect()] == sorted(f"r{i + 300 * k}" for k in range(4))


def test_variables_as_columns(spark, tmp_path, dictionaries, rows):
    import pyarrow as pa
    import pyarrow.parquet as pq

    put(tmp_path, "M/wide.csv", "scenario,region,Unit,year,Prod|Steel,note, Prod|Alu ,Prod|Steel.x\nbase,AT,kt,2020,1,a,2,7\nbase,DE,t,2030,x,b,NA,7\n,,,,,,,\n")
    put(tmp_path, "M/none.csv", "scenario,region,unit,year,a,b\nbase,AT,t,2020,1,2\n")
    put(tmp_path, "M/no year.csv", "scenario,region,unit,Prod|Steel\nbase,AT,t,1\n")
    table = pa.table({"scenario": ["base"], "region": ["FR"], "unit": ["t"], "year": [2020], "Prod|Steel": [3], "Prod|Alu": [1.5]})
    pq.write_table(table, tmp_path / "M/typed.parquet")
    specs = [("M", n, "M", "", "", " ") for n in ("wide.csv", "none.csv", "no year.csv", "typed.parquet")]
    run = harmonize(spark, str(tmp_path), overview(spark, *specs), dictionaries())
    assert rows(run.long.select("region", "variable", "unit", "year", "value")) == [
        ("Austria", "Production|Aluminium", "Mt", 2020, 0.002), ("Austria", "Production|Steel", "Mt", 2020, 0.001),
        ("France", "Production|Aluminium", "t", 2020, 1.5), ("France", "Production|Steel", "t", 2020, 3.0),
        ("Germany", "Production|Aluminium", "t", 2030, None), ("Germany", "Production|Steel", "t", 2030, None)]
    said = {(r["file"], r["stage"], r["n"], r["message"]) for r in run.issues.filter("stage in ('Variables', 'values') or severity = 'error'").collect()}
    assert said == {
        ("wide.csv", "Variables", 2, "columns that are no variables of the dictionary: 'note', 'Prod|Steel.x'"),
        ("wide.csv", "values", 1, "1 values are no numbers and count as missing"),
        ("none.csv", "columns", None, "no column is a variable of the dictionary, source skipped"),
        ("no year.csv", "columns", None, "no column for year, source skipped"),
    }


def test_sources_are_read_once_for_result_and_report(spark, delivery, dictionaries):
    """With staged rows neither the result nor the report goes back to the files; misses and counts come from one pass."""
    run = harmonize(spark, str(delivery), overview(spark, *SPECS), dictionaries(), stage_rows=True)
    for df in (run.long, run.issues):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan csv" not in plan and "FileScan parquet" in plan
    assert {r["stage"] for r in run.issues.collect()} >= {"source", "columns", "Variables", "Regions", "Units", "model", "duplicates"}
