"""The given tables as scenario results and dictionaries, for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenweave.operators import load_dictionary

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _values(rows) -> str:
    def lit(x):
        return "NULL" if x is None else repr(x) if not isinstance(x, str) else "'" + x.replace("'", "''") + "'"

    return "VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)


# A repeated key, a blank target, two keys with one target, an absent key.
VARIABLES = [
    (f"{e}|{k}", f"Activity|{e.title()}|{min(k, 1) if e == 'purchase' else k}", 10 * i + k)
    for i, e in enumerate(EVENT_TYPES) for k in range(4) if (e, k) != ("error", 3)
] + [("click|0", "Activity|Clicks", 90), ("view|2", None, 91)]
SCENARIOS = [
    ("click", "Old", 0), ("click", "Base", 1), ("view", "Base", 2), ("purchase", "High", 3),
    ("signup", "Low", 4), ("error", "Low", 5),
]
MODELS = [("MODEL_0", "Model A", 0), ("MODEL_1", "Model A", 1)]
MODELS_BLANK = [("MODEL_0", "Model A", 0), ("MODEL_1", "Model B", 1), ("MODEL_1", None, 2)]
UNITS = [
    ("kt", "Mt", 1e-3, 0), ("t", "old", 5.0, 1), ("t", "t", None, 2), ("EJ", "PJ", 1000.0, 3), ("EJ", None, 7.0, 4),
]

SIMPLE = "SELECT CAST(a AS {s}) AS source, CAST(b AS {s}) AS target, CAST(c AS INT) AS seq FROM ({v}) AS t(a, b, c)"
WITH_FACTOR = (
    "SELECT CAST(a AS {s}) AS source, CAST(b AS {s}) AS target, CAST(f AS DOUBLE) AS factor, "
    "CAST(c AS INT) AS seq FROM ({v}) AS t(a, b, f, c)"
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def results(spark: SparkSession, sf: str, nulls: bool = False) -> DataFrame:
    """``events`` as a long result table; ``nulls`` turns unit x and value 0 into NULL."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int") % 4
    unit = F.element_at(F.array(*map(F.lit, ("t", "kt", "EJ", "x"))), (F.col("event_id") % 4 + 1).cast("int"))
    value = F.floor(F.col("value") / 8).cast("double")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("ord"),
        F.concat(F.lit("MODEL_"), (F.col("user_id") % 3).cast("string")).alias("source_model"),
        F.col("event_type").alias("scenario"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("region"),
        F.concat("event_type", F.lit("|"), k.cast("string")).alias("original_variable"),
        (F.nullif(unit, F.lit("x")) if nulls else unit).alias("unit"),
        (F.col("event_id") % 7 * 5 + 2020).cast("int").alias("year"),
        (F.nullif(value, F.lit(0.0)) if nulls else value).alias("value"),
    )


def plain(spark: SparkSession, sf: str, nulls: bool = False) -> DataFrame:
    """Results under their own names as a harmonised table, to look at one operator."""
    return results(spark, sf, nulls).select(
        "ord", "source_model", F.col("source_model").alias("model"), "scenario", "region",
        F.col("original_variable").alias("variable"), "unit", "year", "value",
    )


def region_rows(spark: SparkSession, sf: str) -> DataFrame:
    """nation -> region: an outdated row per nation first, a blank target for one region."""
    joined = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    old = F.struct(F.concat(F.lit("old "), "r_name").alias("target"), (F.col("n_nationkey") - 1000).alias("seq"))
    new = F.struct(F.nullif("r_name", F.lit("MIDDLE EAST")).alias("target"), F.col("n_nationkey").alias("seq"))
    return joined.select(F.col("n_name").alias("source"), F.explode(F.array(old, new)).alias("e")).select("source", "e.*")


def _inline(spark: SparkSession, rows, template=SIMPLE) -> DataFrame:
    return spark.sql(template.format(s="STRING", v=_values(rows)))


def regions(spark: SparkSession, sf: str) -> DataFrame:
    return load_dictionary(region_rows(spark, sf), "source", "target", seq=["seq"])


def inline(spark: SparkSession, rows) -> DataFrame:
    return load_dictionary(_inline(spark, rows), "source", "target", seq=["seq"])


def units(spark: SparkSession) -> DataFrame:
    return load_dictionary(_inline(spark, UNITS, WITH_FACTOR), "source", "target", "factor", ["seq"])


def dictionaries(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "variables": inline(spark, VARIABLES),
        "regions": regions(spark, sf),
        "models": inline(spark, MODELS),
        "scenarios": inline(spark, SCENARIOS),
        "units": units(spark),
    }


def star(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with its order, customer and nation as a long result table."""
    line, order = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    joined = (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(
        F.col("c_mktsegment").alias("source_model"),
        F.col("c_mktsegment").alias("model"),
        F.col("o_orderpriority").alias("scenario"),
        F.col("n_name").alias("region"),
        F.concat_ws("|", "l_returnflag", "l_linestatus").alias("variable"),
        F.lit("units").alias("unit"),
        F.year("l_shipdate").alias("year"),
        F.col("l_quantity").alias("value"),
    )


# --- the same in SQL --------------------------------------------------------

RESULTS_SQL = """r AS (
  SELECT event_id AS ord, 'MODEL_' || CAST(user_id % 3 AS VARCHAR) AS source_model, event_type AS scenario,
         'NATION_' || CAST(user_id % 25 AS VARCHAR) AS region,
         event_type || '|' || CAST(CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 4 AS VARCHAR) AS original_variable,
         CASE event_id % 4 WHEN 0 THEN 't' WHEN 1 THEN 'kt' WHEN 2 THEN 'EJ' ELSE 'x' END AS unit,
         CAST(2020 + 5 * (event_id % 7) AS INTEGER) AS year, CAST(floor(value / 8) AS DOUBLE) AS value
  FROM events)"""
NULLS_SQL = RESULTS_SQL.replace("r AS (", "r0 AS (", 1) + """,
r AS (SELECT * REPLACE (nullif(unit, 'x') AS unit, nullif(value, 0) AS value) FROM r0)"""
PLAIN_SQL = """m AS (
  SELECT ord, source_model, source_model AS model, scenario, region, original_variable AS variable, unit, year, value
  FROM r)"""
REGION_ROWS_SQL = """region_rows AS (
  SELECT n_name AS source, 'old ' || r_name AS target, n_nationkey - 1000 AS seq
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT n_name, nullif(r_name, 'MIDDLE EAST'), n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def last_wins_sql(name: str, rows: str, where: str = "source IS NOT NULL") -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (seq, rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY seq DESC) AS rn FROM {rows} WHERE {where}) WHERE rn = 1)"""


def inline_sql(name: str, rows) -> str:
    raw = "(" + SIMPLE.format(s="VARCHAR", v=_values(rows)) + ")"
    return last_wins_sql(name, raw)


UNITS_SQL = last_wins_sql(
    "d_unit", "(" + WITH_FACTOR.format(s="VARCHAR", v=_values(UNITS)) + ")",
    "source IS NOT NULL AND target IS NOT NULL",
)
REGIONS_SQL = REGION_ROWS_SQL + ",\n" + last_wins_sql("d_region", "region_rows")
DICTIONARIES_SQL = ",\n".join(
    [inline_sql("d_variable", VARIABLES), REGIONS_SQL, inline_sql("d_model", MODELS),
     inline_sql("d_scenario", SCENARIOS), UNITS_SQL]
)
MAPPED_SQL = """m AS (
  SELECT r.ord, r.source_model, CASE WHEN dm.source IS NULL THEN r.source_model ELSE dm.target END AS model,
         ds.target AS scenario, dr.target AS region, dv.target AS variable, du.target AS unit, r.year,
         r.value * coalesce(du.factor, 1.0::DOUBLE) AS value
  FROM r LEFT JOIN d_variable dv ON dv.source = r.original_variable
         LEFT JOIN d_region dr ON dr.source = r.region
         LEFT JOIN d_scenario ds ON ds.source = r.scenario
         LEFT JOIN d_unit du ON du.source = r.unit
         LEFT JOIN d_model dm ON dm.source = r.source_model
  WHERE dv.target IS NOT NULL AND dr.target IS NOT NULL AND ds.target IS NOT NULL)"""
KEYS_SQL = "source_model, model, scenario, region, variable, unit, year"
RESOLVED_SQL = f"""ranked AS (
  SELECT *, count(*) OVER w AS n, count(value) OVER w AS nv, min(value) OVER w AS low, max(value) OVER w AS high,
         row_number() OVER (PARTITION BY {KEYS_SQL} ORDER BY ord) AS rn
  FROM m WINDOW w AS (PARTITION BY {KEYS_SQL})),
resolved AS (
  SELECT source_model, model, scenario,
         CASE WHEN n = 1 OR coalesce(nv > 0 AND low = high, false) THEN region
              ELSE 'dup_' || region || '_' || CAST(rn AS VARCHAR) END AS region,
         variable, unit, year, value
  FROM ranked WHERE n = 1 OR rn = 1 OR NOT coalesce(nv > 0 AND low = high, false))"""
YEARS = [2020 + 5 * i for i in range(7)]


def cells_sql(expression: str, years=YEARS) -> str:
    return ", ".join(expression.format(y=y) + f' AS "{y}"' for y in years)
