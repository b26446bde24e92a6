"""Rules that decide results, one small case each, and the distributed paths against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scenweave import export_codelist, read_codelist
from scenweave import operators as op
from scenweave.functions import as_text, attribute_key, nullify, parse_rule, pct, py_strip, to_number, to_year
from scenweave.operators import lookup
from scenweave.operators.duplicates import KEYS, _chunked

RESULT = "ord long, source_model string, model string, scenario string, region string, variable string, unit string, year int, value double"


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")


def applied(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


# --- text and numbers -------------------------------------------------------

def test_strip_is_that_of_unicode(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [s + " a b" + s + "\n" for s in spaces] + ["", "  ", "x"]
    assert applied(column(spark, texts), py_strip(F.col("x"))) == [t.strip() for t in texts]


def test_numbers_keep_their_spelling(spark):
    numbers = [0.0, -0.0, 1.0, 1.5, 123456789.0, 1e20, -2.5e-7, 1e-4, 0.00012345, 1e15, 1e16, 12345678.25, 1e-3,
               9999999.0, 1e7, 1.25e100, float("inf"), 9007199254740993.0, 0.1 + 0.2]
    df = column(spark, numbers, "double")
    assert applied(df, as_text(F.col("x"), df.schema["x"].dataType)) == [repr(x) for x in numbers]
    flags = column(spark, [True, False, None], "boolean")
    assert applied(flags, as_text(F.col("x"), flags.schema["x"].dataType)) == ["True", "False", None]


def test_number_and_year_cells(spark):
    cells = ["1", " 2.5 ", "1e3", "1d", "2.F", "inf", "nan", "x", "0x1p3", "", None, "2020.0", "2020.5", "-7"]
    got = applied(column(spark, cells), to_number(F.col("x")))
    assert got == [1.0, 2.5, 1000.0, None, None, float("inf"), None, None, None, None, None, 2020.0, 2020.5, -7.0]
    years = applied(column(spark, cells), to_year(to_number(F.col("x"))))
    assert years == [1, None, 1000, None, None, None, None, None, None, None, None, 2020, None, -7]


def test_small_helpers(spark):
    assert parse_rule(" A | B|C ") == ["A", "B", "C"] and parse_rule(" A ") == ["A"] and parse_rule(None) == [""]
    assert attribute_key("Sub-Sector Name") == "subsector_name"
    assert applied(column(spark, ["NA", "na", "", None, "<NA>"]), nullify(F.col("x"))) == [None, "na", None, None, None]
    assert applied(column(spark, [1, 0], "int"), pct(F.col("x"), F.col("x") * 3)) == [33.3, 0.0]


# --- columns ----------------------------------------------------------------

def test_first_known_spelling_wins(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "growth int, Value int, area int, other int")
    assert op.canonicalize(df).columns == ["growth", "value", "region", "other"]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        both = spark.createDataFrame([("kt", "t")], "Unit string, unit string")
        got = op.canonicalize(both)
        assert got.columns == ["unit"] and got.first()[0] == "kt"
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_composed_variable_keeps_the_place_of_a_null(spark):
    df = spark.createDataFrame([(" a", None, "b "), (None, None, None)], "x string, y string, z string")
    assert [r[-1] for r in op.compose_variable(df, "x|y|z").collect()] == ["a||b", "||"]
    assert [r[-1] for r in op.compose_variable(df, " x ").collect()] == ["a", ""]
    assert [r[-1] for r in op.compose_variable(df, "x|y", " | ", "nan", False).collect()] == [" a | nan", "nan | nan"]
    assert [r[-1] for r in op.compose_variable(df, "x", trim=False).collect()] == [" a", None]
    with pytest.raises(op.SpecError):
        op.compose_variable(df, "x|w")


def test_unpivot_undoes_pivot(spark, rows):
    data = [(i, "M", "M", "s", f"R{i % 5}", "v", "t", 2000 + i // 5, float(i)) for i in range(20)]
    df = spark.createDataFrame(data, RESULT)
    wide = op.pivot_years(df)
    back = op.unpivot_values(wide, ["source_model", "model", "scenario", "region", "variable", "unit"])
    assert rows(back.select("region", F.col("year").cast("int"), "value")) == rows(df.select("region", "year", "value"))


# --- dictionaries -----------------------------------------------------------

def entries(spark, *pairs):
    return spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], "s string, t string, seq int")


def test_last_entry_wins_even_blank_and_null_never_matches(spark, rows):
    d = op.load_dictionary(entries(spark, ("k", "x"), ("k", None), ("a", "1"), ("a", "2"), (None, "null")), "s", "t", seq=["seq"])
    df = spark.createDataFrame([(1, "k", "t"), (2, "a", "t"), (3, None, "t"), (4, "A", None), (5, " a", None)], "i int, region string, unit string")
    assert rows(op.map_strict(df, "region", d, "Regions").rows) == [(2, "2", "t")]
    assert rows(op.map_lenient(df, "region", d).select("i", "region")) == [(1, "k"), (2, "2"), (3, None), (4, "A"), (5, " a")]
    model = op.map_model(df.withColumn("source_model", F.col("region")), d)
    assert rows(model.select("i", "model", "model_known")) == [
        (1, None, True), (2, "2", True), (3, None, False), (4, "A", False), (5, " a", False)]


def test_two_units_of_one_missing_key(spark):
    df = spark.createDataFrame([(2, "k", "t"), (1, "k", "kt"), (3, "k", "t"), (4, None, None)], "ord int, region string, unit string")
    d = op.load_dictionary(entries(spark, ("a", "b")), "s", "t", seq=["seq"])
    got = op.map_strict(df, "region", d, "Regions", order=["ord"]).issues.drop("first").orderBy("key")
    assert [tuple(r) for r in got.collect()] == [("Regions", None, None, 1, 1), ("Regions", "k", "kt", 2, 3)]


@pytest.mark.parametrize("limit", [0, 500_000])
def test_lookups_agree_beyond_the_broadcast_bound(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", limit)
    # A third of the rows has one key; the dictionary fills several Arrow batches.
    names = ["hot" if i % 3 == 0 else f"k{i % 15000}" for i in range(30000)]
    df = spark.createDataFrame([(i, k, "kt", 1.0) for i, k in enumerate(names)], "ord int, region string, unit string, value double")
    pairs = [("hot", "H")] + [(f"k{i}", f"T{i}" if i % 7 else None) for i in range(14000)]
    d = op.measure(op.load_dictionary(entries(spark, *pairs), "s", "t", seq=["seq"]))
    assert d.small == (limit > 0) and d.rows == 14001
    table = dict(pairs)
    strict = op.map_strict(df, "region", d, "Regions").rows
    assert ("_salt" in strict._jdf.queryExecution().toString()) == (not d.small)
    want = Counter(table[k] for k in names if table.get(k))
    assert Counter(r["region"] for r in strict.select("region").collect()) == want
    lenient = op.map_lenient(df, "region", d)
    assert Counter(r["region"] for r in lenient.select("region").collect()) == Counter(table.get(k) or k for k in names)
    spec = spark.createDataFrame([(1, k, t, i) for i, (k, t) in enumerate(pairs)], "spec_id int, source string, target string, seq int")
    by_spec = op.map_by_spec(df.withColumn("spec_id", F.lit(1)), spec, "region")
    assert Counter(r["variable"] for r in by_spec.select("variable").collect()) == want


# --- duplicates -------------------------------------------------------------

def brute_force(data, prefer_value=False):
    groups = {}
    for row in sorted(data):
        groups.setdefault(row[1:8], []).append(row[8])
    out = []
    for key, values in groups.items():
        distinct = {x for x in values if x is not None}
        if len(values) == 1 or len(distinct) == 1:
            first = next(iter(distinct)) if prefer_value and distinct else values[0]
            out.append((*key, first))
        else:
            out += [(*key[:3], f"dup_{key[3]}_{i}", *key[4:], x) for i, x in enumerate(values, 1)]
    return sorted(out, key=repr)


def skewed(n, seed=1):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        hot = rng.random() < 0.4
        region = "R0" if hot else f"R{rng.randrange(n // 3)}"
        unit = rng.choice(["t", None]) if not hot else None
        value = rng.choice([None, 1.0, 1.0, 2.0]) if not hot else float(i)
        data.append((i, "M" if hot else rng.choice("MN"), "X", "s", region, "v", unit, 2020, value))
    return data


@pytest.mark.parametrize("bits", [0, 3, 20])
@pytest.mark.parametrize("policy", ["reference", "prefer_value"])
def test_resolution_against_brute_force(spark, rows, bits, policy):
    data = skewed(3000)
    df = spark.createDataFrame(data, RESULT).repartition(7)
    got = op.resolve_duplicates(df, chunk_bits=bits, null_policy=policy)
    assert rows(got.select(*RESULT_KEYS, "value")) == brute_force(data, policy == "prefer_value")


RESULT_KEYS = [c.split()[0] for c in RESULT.split(", ")[1:8]]


def test_no_task_gets_a_whole_hot_group(spark):
    df = spark.createDataFrame(skewed(3000), RESULT)
    sizes = _chunked(df, KEYS, ["ord"], 5).groupBy("_k", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2**5
    assert op.duplicate_stats(df).agg(F.max("n")).first()[0] > 1000


def test_several_order_columns(spark, rows):
    data = skewed(600)
    df = spark.createDataFrame(data, RESULT).withColumns(
        {"spec_id": (F.col("ord") / 200).cast("int"), "block": (F.col("ord") / 50).cast("long"), "row": F.col("ord") % 50})
    got = op.resolve_duplicates(df.drop("ord"), order=["spec_id", "block", "row"], chunk_bits=2)
    assert rows(got.select(*RESULT_KEYS, "value")) == brute_force(data)
    marked = op.mark_duplicates(df, order=["spec_id", "block", "row"], chunk_bits=2)
    counts = Counter(r[1:8] for r in data)
    assert {r["ord"]: r["is_duplicate"] for r in marked.collect()} == {r[0]: counts[r[1:8]] > 1 for r in data}


def test_counters_add_up(spark):
    data = skewed(2000, seed=5)
    df = spark.createDataFrame(data, RESULT)
    c = op.duplicate_counters(df).agg(F.sum("removed"), F.sum("renamed"), F.sum("duplicates")).first()
    long = op.resolve_duplicates(df)
    assert long.count() == 2000 - c[0]
    assert long.filter(F.col("region").startswith("dup_")).count() == c[1]
    assert op.assert_unique(long, KEYS).isEmpty()


def test_rows_are_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame(skewed(500), RESULT).write.parquet(path)
    long = op.resolve_duplicates(spark.read.parquet(path))
    long.collect()
    plan = long._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") >= 1
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_result_does_not_depend_on_partitions(spark, rows):
    df = spark.createDataFrame(skewed(800, seed=3), RESULT)
    want = rows(op.resolve_duplicates(df))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert rows(op.resolve_duplicates(df.repartition(11), chunk_bits=4)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


# --- pivots -----------------------------------------------------------------

def test_pivot_policies(spark, rows):
    data = [(1, "A", "A", "s", "R", "v", None, 2020, 1.0), (2, "A", "A", "s", "R", "v", None, 2020, 2.0),
            (3, "B", "B", "s", "R", "v", None, 2030, None), (4, "B", "B", "s", "R", "v", None, 2020, 5.0)]
    df = spark.createDataFrame(data, RESULT)
    assert rows(op.pivot_years(df)) == [("B", "B", "s", "R", "v", None, 5.0, None)]
    nameless = df.withColumn("source_model", F.nullif("source_model", F.lit("A")))
    assert rows(op.pivot_years(nameless)) == [("B", "B", "s", "R", "v", None, 5.0, None)]
    assert op.pivot_years(df, on_duplicate="ignore").count() == 2
    with pytest.raises(Exception, match="duplicate cell"):
        op.pivot_years(df, on_duplicate="raise").collect()
    assert op.pivot_years(df.filter("ord = 3")).columns[-1] == "2030"
    assert op.pivot_years(df.limit(0)).columns == ["source_model", "model", "scenario", "region", "variable", "unit"]


def test_sums_drop_null_keys_and_show_zero_for_no_values(spark, rows):
    data = [(1, "A", "A", "s", "R", "v", "t", 2020, None), (2, "A", "A", "s", "R", "v", "t", 2020, None),
            (3, "A", "A", "s", None, "v", "t", 2020, 1.0), (4, "A", "A", "s", "Q", "v", "t", 2030, 1.5), (5, "A", "A", "s", "Q", "v", "t", 2030, 2.0)]
    df = spark.createDataFrame(data, RESULT)
    assert rows(op.pivot_sum(df)) == [("A", "s", "Q", "v", "t", None, 3.5), ("A", "s", "R", "v", "t", 0.0, None)]


# --- regions and codelists --------------------------------------------------

def test_region_names(spark, rows):
    world = spark.createDataFrame([("NA", "NAM", 516, "Namibia"), ("DE", "DEU", 276, "Germany"), ("XX", "DEU", 1, "Other")],
                                  "a string, b string, c int, name string")
    codes = op.country_codes(world, ["a", "b", "c"], "name")
    df = spark.createDataFrame([(x,) for x in ["NAM", "na", " DE ", "276", "DEU", "Germany", "german-ish", "", "  ", None, "zz"]], "source_region string")
    patterns = {"german": "Germany", "^germany$": "Germany", "ish$": "Ireland"}
    got = op.normalize_regions(df, codes, patterns=patterns)
    assert dict(got.collect()) == {
        "NAM": "North America", "na": "Namibia", " DE ": "Germany", "276": "Germany", "DEU": None,
        "Germany": "Germany", "german-ish": None, "": None, "  ": None, None: None, "zz": None}
    assert op.region_coverage(got).first().asDict() == {"total": 9, "converted": 5, "percent": 55.6}
    assert [r[0] for r in op.region_misses(got).collect()] == ["", "  ", "DEU", "german-ish", "zz"]
    kept = dict(op.normalize_regions(df, codes, on_miss="passthrough").collect())
    assert kept["zz"] == "zz" and kept["  "] is None
    from scenweave.operators.regions import custom_shadows

    assert [r[0] for r in custom_shadows(codes).collect()] == ["NAM"]


def test_codelist_file(spark, tmp_path):
    source = tmp_path / "list.csv"
    source.write_bytes('﻿variable name;Sub-Sector Name;source:;Unit\n"A|B";"two\nlines; ""q""";s;t\nC;;x;\n'.encode())
    export_codelist(spark, str(source), str(tmp_path / "out"))
    text = [r[0] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert text == ["- A|B:", '    subsector_name: two, lines; "q"', "  - source:: s", "    unit: t",
                    "- C:", "    subsector_name: ", "  - source:: x", "    unit: "]
    escaped = op.render_codelist(read_codelist(spark, str(source)), escape=True).orderBy("seq", "line_no")
    assert escaped.first()["line"] == '- "A|B":' and '"two, lines; \\"q\\""' in escaped.collect()[1]["line"]


def test_a_factor_that_is_no_number_leaves_the_unit_unmapped(spark):
    from scenweave.operators import load_dictionary

    units = spark.createDataFrame(
        [("a", "t", "1,000", 0), ("b", "t", "1000x", 1), ("c", "t", "", 2), ("d", "t", None, 3), ("e", "t", "2.5", 4), ("f", "t", "NA", 5)],
        "s string, t string, f string, seq int",
    )
    got = {r["source"]: r["factor"] for r in load_dictionary(units, "s", "t", "f", ["seq"]).collect()}
    assert got == {"c": 1.0, "d": 1.0, "e": 2.5, "f": 1.0}


def test_a_malformed_last_factor_does_not_revive_an_earlier_one(spark, rows):
    from scenweave.operators import malformed_factors

    units = spark.createDataFrame(
        [("t", "t", "2", 0), ("t", "t", "1,000", 1), ("kg", "t", "x", 2), ("kg", "t", "0.001", 3), ("g", "t", "", 4), ("u", None, "x", 5)],
        "s string, t string, f string, seq int")
    assert rows(op.load_dictionary(units, "s", "t", "f", ["seq"])) == [("g", "t", 1.0), ("kg", "t", 0.001)]
    told = malformed_factors(units, "s", "t", "f", ["seq"]).collect()
    assert [(r["key"], r["severity"], r["message"]) for r in told] == [("t", "error", "factor 1,000 of t is no number, the unit counts as missing")]


def test_only_hot_keys_of_a_large_dictionary_are_repeated(spark, rows, monkeypatch):
    from scenweave.operators import lookup

    n = 9000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 500)).alias("region"), F.col("id").alias("ord"))
    entries = [("hot", "H", 0)] + [(f"k{i}", f"R{i}", i + 1) for i in range(400)]
    table = op.load_dictionary(spark.createDataFrame(entries, "s string, t string, seq int"), "s", "t", seq=["seq"])
    want = rows(lookup.map_lenient(df, "region", table))
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 10)
    assert not lookup.measure(table).small
    assert rows(lookup.map_lenient(df, "region", table)) == want
    keyed = df.withColumnRenamed("region", "_key")
    hot = lookup.hot_keys(keyed, ["_key"])
    # The hot key and the rows without a key: a third of the rows each, on 8 tasks.
    assert sorted(hot.values()) == [3, 3]
    side = table.withColumnRenamed("source", "_key")
    joined = lookup.salted_join(keyed, side, ["_key"], "inner", hot=hot)
    assert joined.count() == sum(1 for r in want if r[1] is not None and r[0] != "x" and (r[0] in ("H",) or str(r[0]).startswith("R")))
    per_task = keyed.withColumn("salt", F.pmod(F.xxhash64("_key", "ord"), F.lit(3))).filter("_key = 'hot'").groupBy("salt").count().collect()
    assert len(per_task) == 3 and max(r["count"] for r in per_task) < 1200


def test_withheld_scopes_plan_one_pivot(spark, rows):
    from scenweave.operators import pivot_years

    df = spark.createDataFrame(
        [(f"m{i % 5}", f"m{i % 5}", "s", f"r{i}", "v", "u", 2020 + i % 3, float(i)) for i in range(60)] + [("m3", "m3", "s", "r3", "v", "u", 2020, 1.0)] * 2,
        "source_model string, model string, scenario string, region string, variable string, unit string, year int, value double")
    out = pivot_years(df)
    assert {r[0] for r in rows(out.select("source_model"))} == {"m0", "m1", "m2", "m4"} and out.count() == 48
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") <= 2 and "SortMergeJoin" not in plan
    assert pivot_years(df.filter("source_model <> 'm3'")).count() == 48


def test_needed_letters_of_patterns():
    from scenweave.operators.regions import needed_grams

    assert needed_grams(r"^viet.?nam") == {"vie"}
    assert needed_grams(r"korea|\bdprk\b") == {"kor", "dpr"}
    assert needed_grams(r"^(?=.*rep).*congo.*$") == {"con"}
    assert needed_grams(r"united.?states|u\.s") == {"uni", "u.s"}
    assert needed_grams(r"us|usa") is None and needed_grams(r"[ab]+") is None and needed_grams("") is None
    assert needed_grams(r"(north|south) korea") == {" ko"}
    assert needed_grams(r"abcd{0,2}xy") == {"abc"} and needed_grams(r"abc?xyz") == {"xyz"} and needed_grams(r"ab+cde") == {"cde"}
    assert needed_grams(r"cura[cç]ao") == {"cur"} and needed_grams("\u00e5land") == {"lan"}


def test_indexed_patterns_equal_all_patterns(spark, rows):
    import random

    from scenweave.operators.regions import FEW_PATTERNS

    rnd = random.Random(3)
    stems = ["nigeria", "niger", "guinea", "papua new guinea", "equatorial guinea", "korea", "dominica", "dominican republic", "congo", "mali", "somalia",
             "oman", "romania", "india", "indiana", "samoa", "american samoa", "sudan", "south sudan", "virgin islands", "\u00e5land", "cote d'ivoire"]
    patterns = {rf"^{w}$" if i % 3 == 0 else rf"\b{w}\b" if i % 3 == 1 else w: w.title() for i, w in enumerate(stems)}
    patterns |= {r"dem.*congo|drc": "DR Congo", r"^u\.?s\.?a?\.?$": "United States", r"(north|dem).*korea": "North Korea", r"niger(?!ia)": "Niger (only)"}
    assert len(patterns) > FEW_PATTERNS
    names = [w for w in stems] + [f"{rnd.choice(['the', 'Rep. of', 'old', ''])} {w.upper() if rnd.random() < 0.3 else w}{rnd.choice(['', ' land', 's'])}"
                                  for w in stems for _ in range(6)] + ["U.S.A.", "us", "usa", "", None, "x", "DRC", "dem rep congo", "\u00c5land"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, source_region string")
    countries = spark.createDataFrame([("ZZ", "Nowhere")], "source string, target string")
    few = {}
    for low in range(0, len(patterns), 10):
        part = dict(list(patterns.items())[low : low + 10])
        for n, t in rows(op.normalize_regions(df, countries, patterns=part, custom={}).select("i", "target_region")):
            hits = {v for p, v in part.items() if names[n] is not None and names[n].strip() and re_fits(spark, p, names[n].strip())}
            assert t == (hits.pop() if len(hits) == 1 else None)
            few.setdefault(n, set()).update(v for p, v in part.items() if names[n] is not None and names[n].strip() and re_fits(spark, p, names[n].strip()))
    got = dict(rows(op.normalize_regions(df, countries, patterns=patterns, custom={}).select("i", "target_region")))
    assert got == {n: next(iter(h)) if len(h) == 1 else None for n, h in few.items()} and sum(v is not None for v in got.values()) > 40


def re_fits(spark, pattern, name):
    return spark._jvm.java.util.regex.Pattern.compile(f"(?i){pattern}").matcher(name).find()
