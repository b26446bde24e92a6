"""The queries in SQL, over the same tables."""

from __future__ import annotations

from . import views as v
from .jobs import FEW, LAYOUTS
from .views import (
    DICTIONARIES_SQL, KEYS_SQL, MAPPED_SQL, NULLS_SQL, PLAIN_SQL, REGIONS_SQL, RESOLVED_SQL, RESULTS_SQL,
    UNITS_SQL, cells_sql, inline_sql, last_wins_sql,
)


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


PART_SQL = "part_rows AS (SELECT p_name AS source, nullif(p_type, 'PROMO') AS target, p_partkey AS seq FROM part)"
PART_UNITS_SQL = """unit_rows AS (
  SELECT nullif(p_brand, 'Brand#3') AS source, nullif(p_type, 'PROMO') AS target,
         coalesce(CAST(nullif(p_size, 7) AS DOUBLE), 1.0::DOUBLE) AS factor, p_partkey AS seq FROM part)"""
D_PART = last_wins_sql("d_part", "part_rows")
D_PART_UNITS = last_wins_sql("d_part_units", "unit_rows", "source IS NOT NULL AND target IS NOT NULL")
EMPTY_AS_NULL = "(" + ", ".join(
    "'" + t + "'" for t in
    ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
     "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]) + ")"
SPACE = r"^\s+|\s+$"

# Rows without a translation, as (source_model, label, key, unit, ord).
MISSES_SQL = """misses AS (
  SELECT source_model, 'Variables' AS label, original_variable AS key, unit, ord FROM r
  WHERE NOT EXISTS (SELECT 1 FROM d_variable d WHERE d.source = original_variable AND d.target IS NOT NULL)
  UNION ALL
  SELECT source_model, 'Regions', region, unit, ord FROM r
  WHERE NOT EXISTS (SELECT 1 FROM d_region d WHERE d.source = region AND d.target IS NOT NULL)
  UNION ALL
  SELECT source_model, 'Scenarios', scenario, unit, ord FROM r
  WHERE NOT EXISTS (SELECT 1 FROM d_scenario d WHERE d.source = scenario AND d.target IS NOT NULL)
  UNION ALL
  SELECT source_model, 'Units', unit, NULL, ord FROM r
  WHERE NOT EXISTS (SELECT 1 FROM d_unit d WHERE d.source = unit AND d.target IS NOT NULL))"""
GROUPED_MISSES_SQL = """report AS (
  SELECT source_model, label, key, arg_min(coalesce(unit, '~'), ord) AS unit_text,
         count(DISTINCT coalesce(unit, '~')) AS units, count(*) AS n, min(ord) AS first_ord
  FROM misses GROUP BY source_model, label, key)"""
REPORT_FIELDS = "source_model, label, key, nullif(unit_text, '~') AS unit, units, n, first_ord"
LINE = "CASE WHEN unit_text = '~' THEN key ELSE key || ' - ' || unit_text END"

COUNTERS_SQL = f"""stats AS (
  SELECT {KEYS_SQL}, count(*) AS n, count(value) AS n_values, min(value) AS low, max(value) AS high
  FROM m GROUP BY {KEYS_SQL}),
counters AS (
  SELECT source_model, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicates,
         CAST(sum(CASE WHEN n > 1 AND coalesce(n_values > 0 AND low = high, false) THEN n - 1 ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN n > 1 AND NOT coalesce(n_values > 0 AND low = high, false) THEN n ELSE 0 END) AS BIGINT) AS renamed
  FROM stats GROUP BY source_model)"""
WIDE_CELLS = cells_sql("max(value) FILTER (WHERE year = {y})")
SUM_CELL = "CASE WHEN count(*) FILTER (WHERE year = {y}) > 0 THEN coalesce(sum(value) FILTER (WHERE year = {y}), 0) END"
IAMC = "model, scenario, region, variable, unit"
WIDE_SQL = f"SELECT source_model, {IAMC}, {WIDE_CELLS} FROM resolved GROUP BY source_model, {IAMC}"
MAPPED_ALL = [RESULTS_SQL, DICTIONARIES_SQL, MAPPED_SQL]

# Years of l_shipdate; the query finds them itself.
SHIP_YEARS = range(1995, 2002)

SPEC_MAP_SQL = """pairs AS (
  SELECT source_model, original_variable AS source,
         CASE WHEN unit <> 'x' THEN original_variable || '/' || unit END AS target, ord AS seq FROM r),
d_spec AS (
  SELECT source_model, source, target FROM (
    SELECT *, row_number() OVER (PARTITION BY source_model, source ORDER BY seq DESC) AS rn FROM pairs) WHERE rn = 1)"""

COUNTRY_SQL = """spelled AS (
  SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS source, n_name AS target FROM nation
  UNION ALL SELECT 'NA' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0'), n_name FROM nation
  UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name FROM nation),
d_country AS (
  SELECT source, CASE WHEN min(target) = max(target) THEN min(target) END AS target FROM spelled GROUP BY source)"""
CODES_SQL = """codes AS (
  SELECT c_custkey, CASE c_custkey % 7
    WHEN 0 THEN ' N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || ' '
    WHEN 1 THEN CAST(c_nationkey AS VARCHAR)
    WHEN 2 THEN CASE c_nationkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'NAM' WHEN 2 THEN 'LAM' ELSE 'eur' END
    WHEN 3 THEN 'Nation-' || CAST(c_nationkey AS VARCHAR)
    WHEN 4 THEN 'NA0' || CAST(c_nationkey % 5 AS VARCHAR)
    WHEN 5 THEN '  ' END AS source_region
  FROM customer)"""
OWN = {"EUR": "Europe", "NAM": "North America", "LAM": "Latin America"}
NORMAL_SQL = f"""named AS (SELECT *, nullif(trim(source_region), '') AS name FROM codes),
normal AS (
  SELECT c_custkey, source_region, name,
    coalesce(CASE name {' '.join(f"WHEN '{k}' THEN '{t}'" for k, t in OWN.items())} END, d.target,
      CASE WHEN regexp_matches(name, '(?i)^nation[^a-zA-Z0-9_]*0*7$') THEN 'Seven'
           WHEN regexp_matches(name, '(?i)^nation[^a-zA-Z0-9_]*12$') THEN NULL
           WHEN regexp_matches(name, '(?i)^nation[^a-zA-Z0-9_]*1[0-9]$') THEN 'Teens' END) AS target_region
  FROM named LEFT JOIN d_country d ON d.source = upper(name))"""
NORMAL_ALL = [COUNTRY_SQL, CODES_SQL, NORMAL_SQL]

PATHS_SQL = """paths AS (
  SELECT doc_id, CASE doc_id % 4
    WHEN 0 THEN CAST(doc_id AS VARCHAR) || '.CSV'
    WHEN 1 THEN source || '/' || CAST(doc_id AS VARCHAR) || '.csv'
    WHEN 2 THEN source || '/run ' || lang || '/v1.2/' || CAST(doc_id AS VARCHAR) || '.csv'
    ELSE source || '/' || lang || '.xlsx/Sheet ' || CAST(doc_id AS VARCHAR) || '.parquet' END AS path
  FROM documents)"""

SQL = {
    "dictionary_last_wins": with_(PART_SQL, D_PART, select="SELECT source, target FROM d_part"),
    "dictionary_units": with_(PART_UNITS_SQL, D_PART_UNITS, select="SELECT source, target, factor FROM d_part_units"),
    "dictionary_summary": with_(PART_SQL, D_PART, PART_UNITS_SQL, D_PART_UNITS, REGIONS_SQL, select="""
        SELECT 'parts' AS dictionary, count(*) AS entries FROM d_part
        UNION ALL SELECT 'units', count(*) FROM d_part_units
        UNION ALL SELECT 'regions', count(*) FROM d_region"""),
    "map_strict_region": with_(RESULTS_SQL, REGIONS_SQL, select="""
        SELECT ord, source_model, d.target AS region, value FROM r JOIN d_region d ON d.source = r.region
        WHERE d.target IS NOT NULL"""),
    "map_strict_issues": with_(RESULTS_SQL, DICTIONARIES_SQL, MISSES_SQL, GROUPED_MISSES_SQL,
                               select=f"SELECT {REPORT_FIELDS} FROM report WHERE label = 'Regions'"),
    "map_lenient_region": with_(RESULTS_SQL, REGIONS_SQL, select="""
        SELECT ord, coalesce(d.target, r.region) AS region, value FROM r LEFT JOIN d_region d ON d.source = r.region"""),
    "map_by_spec": with_(RESULTS_SQL, SPEC_MAP_SQL, select="""
        SELECT ord, r.source_model, d.target AS variable, value
        FROM r JOIN d_spec d ON d.source_model = r.source_model AND d.source = r.original_variable
        WHERE d.target IS NOT NULL"""),
    "map_model_fallback": with_(RESULTS_SQL, inline_sql("d_model", v.MODELS_BLANK), select="""
        SELECT ord, source_model, CASE WHEN d.source IS NULL THEN source_model ELSE d.target END AS model,
               d.source IS NOT NULL AS model_known
        FROM r LEFT JOIN d_model d ON d.source = r.source_model"""),
    "convert_units": with_(RESULTS_SQL, UNITS_SQL, select="""
        SELECT ord, d.target AS unit, value * coalesce(d.factor, 1.0::DOUBLE) AS value
        FROM r LEFT JOIN d_unit d ON d.source = r.unit"""),
    "convert_units_keep": with_(RESULTS_SQL, UNITS_SQL, select="""
        SELECT ord, coalesce(d.target, r.unit) AS unit, value * coalesce(d.factor, 1.0::DOUBLE) AS value
        FROM r LEFT JOIN d_unit d ON d.source = r.unit"""),
    "unmapped_report": with_(RESULTS_SQL, DICTIONARIES_SQL, MISSES_SQL, GROUPED_MISSES_SQL,
                             select=f"SELECT {REPORT_FIELDS}, {LINE} AS line FROM report"),
    "report_lines": with_(*MAPPED_ALL, MISSES_SQL, GROUPED_MISSES_SQL, COUNTERS_SQL, """steps AS (
        SELECT unnest(['Variables', 'Regions', 'Scenarios', 'Units']) AS label, unnest([3, 4, 5, 6]) AS step)""", select=f"""
        SELECT DISTINCT source_model, -1 AS step, -1::BIGINT AS "row", '=== ' || source_model || ' ===' AS line FROM r
        UNION ALL SELECT source_model, step, -1::BIGINT,
               CAST(sum(units) AS VARCHAR) || ' ' || label || ' not in the dictionary:'
               FROM report JOIN steps USING (label) GROUP BY source_model, label, step
        UNION ALL SELECT source_model, step, first_ord, {LINE} FROM report JOIN steps USING (label)
        UNION ALL SELECT source_model, 10, 0, 'no duplicates' FROM counters WHERE duplicates = 0
        UNION ALL SELECT source_model, 10, 1, duplicates || ' rows in duplicate groups' FROM counters WHERE duplicates > 0
        UNION ALL SELECT source_model, 10, 2, removed || ' identical rows removed' FROM counters WHERE removed > 0
        UNION ALL SELECT source_model, 10, 3, renamed || ' differing rows renamed' FROM counters WHERE renamed > 0"""),
    "unmapped_set": with_(RESULTS_SQL, REGIONS_SQL, select="""
        SELECT region AS key FROM r EXCEPT SELECT source FROM d_region WHERE target IS NOT NULL"""),
    "compose_variable": """
        SELECT p_partkey, p_type || '|' || coalesce(nullif(p_name, 'red widget') || ' ', '') || '|' || p_brand AS original_variable
        FROM part""",
    "compose_variable_single": "SELECT p_partkey, coalesce(nullif(p_name, 'red widget'), '') AS original_variable FROM part",
    "compose_variable_legacy": """
        SELECT p_partkey, p_type || ' | ' || coalesce(nullif(p_name, 'red widget'), 'nan') || ' | ' || CAST(p_size AS VARCHAR)
               AS original_variable FROM part""",
    "canonicalize_columns": """
        SELECT o_orderkey AS "order", o_orderpriority AS scenario, o_orderstatus AS region,
               CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS value, 'EUR' AS unit, o_custkey AS "Code"
        FROM orders""",
    "trim_headers": "SELECT o_orderkey AS key, o_orderstatus AS status FROM orders",
    "nullify_tokens": f"""
        SELECT event_id, CASE WHEN a IN {EMPTY_AS_NULL} THEN NULL ELSE a END AS a,
               nullif(event_type, 'view') AS b, region
        FROM (SELECT *, CASE event_id % 6 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN '<NA>'
                WHEN 4 THEN 'kept' ELSE 'na' END AS a, CASE event_id % 2 WHEN 0 THEN 'NA' ELSE 'DE' END AS region FROM events)
        WHERE a NOT IN {EMPTY_AS_NULL} OR event_type <> 'view'""",
    "type_measures": """
        SELECT event_id, CASE event_id % 5 WHEN 1 THEN CAST(user_id * 3 AS DOUBLE) WHEN 2 THEN CAST(1000 AS DOUBLE) END AS value,
               CAST(CASE event_id % 5 WHEN 0 THEN 2020 WHEN 3 THEN 2030 END AS INTEGER) AS year,
               event_id % 5 IN (0, 3) AS bad_value, event_id % 5 NOT IN (0, 3) AS bad_year
        FROM events""",
    "as_text_numbers": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               CAST(CAST(floor(l_extendedprice) AS BIGINT) * CASE l_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 1000 ELSE 1000000 END
                    AS VARCHAR) || '.0' AS text FROM lineitem""",
    "project_spec_defaults": """
        SELECT o_orderpriority AS scenario, o_orderstatus AS region, CAST(year(o_orderdate) AS INTEGER) AS year,
               o_totalprice AS value, s.model_text AS model, s.unit_text AS unit, s.shape FROM orders,
             (VALUES ('literal', 'MODEL X', 'EUR'), ('default', 'Unknown Model', 'undefined')) AS s(shape, model_text, unit_text)
        UNION ALL SELECT o_orderpriority, o_orderstatus, CAST(year(o_orderdate) AS INTEGER), o_totalprice,
               o_orderstatus, o_orderpriority, 'column' FROM orders""",
    "iamc_projection": with_(NULLS_SQL, PLAIN_SQL, select=f"""
        SELECT ord, {IAMC}, year, value FROM m WHERE region <> 'NATION_3'"""),
    "unpivot_values": " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '{c}' AS variable, {e} AS value FROM lineitem"
        for c, e in [("l_quantity", "l_quantity"), ("l_extendedprice", "l_extendedprice"),
                     ("l_discount", "nullif(l_discount, 0)"), ("l_tax", "l_tax")]),
    "union_sources": with_(RESULTS_SQL, select="""
        SELECT o_orderstatus AS region, 'EUR' AS unit, o_totalprice AS value FROM orders
        UNION ALL SELECT region, unit, value FROM r"""),
    "first_per_group": """
        SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "mark_duplicates": with_(NULLS_SQL, PLAIN_SQL, select=f"""
        SELECT ord, unit, count(*) OVER (PARTITION BY {KEYS_SQL}) > 1 AS is_duplicate FROM m"""),
    "duplicate_stats": with_(NULLS_SQL, PLAIN_SQL, COUNTERS_SQL, select="SELECT * FROM stats"),
    "duplicate_counters": with_(RESULTS_SQL, PLAIN_SQL, COUNTERS_SQL, select="SELECT * FROM counters"),
    "resolve_duplicates": with_(RESULTS_SQL, PLAIN_SQL, RESOLVED_SQL, select="SELECT * FROM resolved"),
    "resolve_duplicates_nulls": with_(NULLS_SQL, PLAIN_SQL, RESOLVED_SQL, select="SELECT * FROM resolved"),
    "resolve_duplicates_prefer_value": with_(
        NULLS_SQL, PLAIN_SQL, RESOLVED_SQL.replace("variable, unit, year, value\n", "variable, unit, year, CASE WHEN low = high THEN low ELSE value END AS value\n"),
        select="SELECT * FROM resolved"),
    "pivot_strict": with_(NULLS_SQL, PLAIN_SQL, RESOLVED_SQL, select=WIDE_SQL),
    "pivot_quarantine": with_(RESULTS_SQL, PLAIN_SQL, select=f"""
        SELECT source_model, {IAMC}, {WIDE_CELLS} FROM m WHERE source_model <> 'MODEL_2' GROUP BY source_model, {IAMC}"""),
    "pivot_sum": with_(NULLS_SQL, PLAIN_SQL, select=f"""
        SELECT {IAMC}, {cells_sql(SUM_CELL)} FROM m WHERE unit IS NOT NULL GROUP BY {IAMC}"""),
    "pivot_sum_lineitem": with_("""m AS (
        SELECT c_mktsegment AS model, o_orderpriority AS scenario, n_name AS region,
               l_returnflag || '|' || l_linestatus AS variable, 'units' AS unit, year(l_shipdate) AS year, l_quantity AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey)""", select=f"""
        SELECT {IAMC}, {cells_sql(SUM_CELL, SHIP_YEARS)} FROM m GROUP BY {IAMC}"""),
    "assert_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "country_codes": with_(COUNTRY_SQL, select="SELECT source, target FROM d_country"),
    "normalize_regions": with_(*NORMAL_ALL, select="SELECT c_custkey, source_region, target_region FROM normal"),
    "normalize_regions_passthrough": with_(*NORMAL_ALL, select="""
        SELECT c_custkey, source_region, coalesce(target_region, name) AS target_region FROM normal"""),
    "region_coverage": with_(*NORMAL_ALL, select="""
        SELECT count(*) FILTER (WHERE source_region <> '') AS total, count(target_region) AS converted,
               round(100.0::DOUBLE * count(target_region) / count(*) FILTER (WHERE source_region <> ''), 1) AS percent
        FROM normal"""),
    "region_misses": with_(*NORMAL_ALL, select="""
        SELECT DISTINCT source_region FROM normal WHERE target_region IS NULL AND source_region IS NOT NULL"""),
    "derive_source_models": with_(PATHS_SQL, select="""
        SELECT doc_id, CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) ELSE 'root' END AS source_model FROM paths"""),
    "locate_files": """
        SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'root' ELSE source END AS source_model,
               CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN source WHEN 2 THEN source || '/run ' || lang || '/v1.2' ELSE source END
                 AS file_location,
               CASE doc_id % 4 WHEN 0 THEN doc_id || '.CSV' WHEN 3 THEN lang || '.xlsx' ELSE doc_id || '.csv' END AS file_name,
               CASE doc_id % 4 WHEN 3 THEN 'Sheet ' || doc_id ELSE '' END AS sheet_name,
               CASE doc_id % 4 WHEN 3 THEN 'parquet' ELSE 'csv' END AS format
        FROM documents""",
    "spec_counts": """
        SELECT count(*) AS specs, (SELECT count(*) FROM (SELECT DISTINCT source, lang FROM documents)) AS files,
               count(DISTINCT source) AS models FROM documents""",
    "codelist_lines": """
        SELECT p_partkey AS seq, 0 AS line_no, '- ' || p_name || ', ' || p_brand || ':' AS line FROM part
        UNION ALL SELECT p_partkey, 1, '    subsector_name: ' || coalesce(nullif(p_type, 'PROMO'), '') FROM part
        UNION ALL SELECT p_partkey, 2, '    unit: ' || p_size FROM part
        UNION ALL SELECT p_partkey, 3, '  - source:: ' || p_brand FROM part""",
    "text_functions": rf"""
        SELECT doc_id, md5(regexp_replace(text, '{SPACE}', '', 'g')) AS stripped,
               md5(replace(text, chr(10), ', ')) AS one_line,
               round(100.0::DOUBLE * n_chars / (n_chars + doc_id), 1) AS share FROM documents""",
    "normalize_regions_indexed": """
        SELECT c_custkey AS i, CASE WHEN k IN (7, 8, 9) OR k = 12 THEN NULL WHEN k BETWEEN 1 AND 39 THEN 'Customer ' || k END AS target_region
        FROM (SELECT c_custkey, CAST(regexp_extract(c_name, '#0*([0-9]+)$', 1) AS BIGINT) AS k FROM customer)""",
    "harmonize_mapped": with_(*MAPPED_ALL, select="SELECT * FROM m"),
    "harmonize_e2e": with_(*MAPPED_ALL, RESOLVED_SQL, select="SELECT * FROM resolved"),
    "harmonize_files": with_(*MAPPED_ALL, RESOLVED_SQL, select="SELECT * FROM resolved"),
    "harmonize_files_misses": with_(RESULTS_SQL, DICTIONARIES_SQL, MISSES_SQL, select="""
        SELECT source_model, label, key, count(*) AS n FROM misses GROUP BY source_model, label, key"""),
    "catalog": with_(RESULTS_SQL, select="""
        SELECT DISTINCT 'source_model=' || source_model AS source_model, 'source_model=' || source_model AS file_location,
               '' AS sheet_name, 'ord, scen, AREA, Kind, Part No, Unit, TIME, VAL' AS column_names FROM r"""),
    "harmonize_wide": with_(*MAPPED_ALL, RESOLVED_SQL, select=WIDE_SQL),
    "harmonize_duplicate_report": with_(*MAPPED_ALL, COUNTERS_SQL, select="SELECT * FROM counters"),
    "harmonize_legacy_e2e": with_(RESULTS_SQL, PLAIN_SQL, REGIONS_SQL, f"""keyed AS (
        SELECT *, scenario || ' | ' || unit AS original_variable FROM m),
        pairs AS (SELECT source_model, original_variable AS source,
                    CASE WHEN unit <> 'x' THEN upper(original_variable) END AS target, ord AS seq FROM keyed),
        d_spec AS (SELECT source_model, source, target FROM (
            SELECT *, row_number() OVER (PARTITION BY source_model, source ORDER BY seq DESC) AS rn FROM pairs) WHERE rn = 1),
        l AS (SELECT k.source_model, k.model, k.scenario, coalesce(d.target, k.region) AS region, s.target AS variable,
                     k.unit, k.year, k.value
              FROM keyed k JOIN d_spec s ON s.source_model = k.source_model AND s.source = k.original_variable
                   LEFT JOIN d_region d ON d.source = k.region WHERE s.target IS NOT NULL)""", select=f"""
        SELECT source_model, {IAMC}, {cells_sql(SUM_CELL)} FROM l GROUP BY source_model, {IAMC}"""),
}

# --- jobs on files ------------------------------------------------------------

BUCKETED_SQL = f"""b AS (
  SELECT source_model, CAST(floor(ord * {FEW}.0::DOUBLE / ((SELECT max(ord) FROM r) + 1)) AS INTEGER) % {len(LAYOUTS)} AS layout,
         CAST(floor(ord * {FEW}.0::DOUBLE / ((SELECT max(ord) FROM r) + 1)) AS INTEGER) AS bucket FROM r),
files AS (SELECT DISTINCT source_model, layout, bucket FROM b)"""
NAMES_SQL = "CASE layout " + " ".join(f"WHEN {i} THEN '{', '.join(columns)}'" for i, (columns, _) in enumerate(LAYOUTS)) + " END"
RESOLVED_ROWS = with_(*MAPPED_ALL, RESOLVED_SQL, select="SELECT * FROM resolved")

SQL |= {
    "harmonize_many_files": RESOLVED_ROWS,
    "harmonize_parts": RESOLVED_ROWS,
    "harmonize_encoding": RESOLVED_ROWS,
    "written_long": RESOLVED_ROWS,
    "written_wide": SQL["harmonize_wide"],
    "harmonize_sheets": RESOLVED_ROWS,
    "harmonize_columns": with_(RESULTS_SQL.replace("r AS (", "r0 AS (", 1), """r AS (
        SELECT * REPLACE (2 * ord + j AS ord, CASE j WHEN 0 THEN 'click|0' ELSE 'view|1' END AS original_variable, value * (1 + j) AS value)
        FROM (SELECT r0.*, j FROM r0, (VALUES (0), (1)) t(j)))""".replace("SELECT *", "SELECT * EXCLUDE (j)", 1), DICTIONARIES_SQL, MAPPED_SQL, RESOLVED_SQL,
        select="SELECT * FROM resolved"),
    "harmonize_many_files_found": with_(RESULTS_SQL, BUCKETED_SQL, select="""
        SELECT source_model, 'source' AS stage, 'info' AS severity, NULL AS message, count(*) AS n FROM files GROUP BY source_model
        UNION ALL
        SELECT source_model, 'columns', 'found', 'columns: scenario, region, year, value, unit', count(*) FROM files GROUP BY source_model"""),
    "catalog_layouts": with_(RESULTS_SQL, BUCKETED_SQL, select=f"""
        SELECT 'layout ' || layout AS layout, source_model AS model, {NAMES_SQL} AS column_names, count(*) AS files
        FROM files GROUP BY layout, source_model"""),
    "written_catalog": with_(RESULTS_SQL, BUCKETED_SQL, select=f"""
        SELECT 'layout ' || layout AS layout, {NAMES_SQL} AS names, count(*) AS files FROM files GROUP BY layout"""),
    "harmonize_wrong_encoding": with_(RESULTS_SQL, select="SELECT source_model, count(*) AS n FROM r GROUP BY source_model"),
    "quarantined_rows": with_(RESULTS_SQL, select="""
        SELECT source_model, 'error' AS severity, 'rows have more fields than the header and are left out' AS message, count(*) AS n
        FROM r WHERE ord % 13 = 0 GROUP BY source_model
        UNION ALL SELECT source_model, 'warning', 'values are no numbers and count as missing', count(*)
        FROM r WHERE ord % 13 <> 0 AND ord % 7 = 0 GROUP BY source_model
        UNION ALL SELECT source_model, 'error', 'rows have no whole-number year and are left out', count(*)
        FROM r WHERE ord % 13 <> 0 AND ord % 11 = 0 GROUP BY source_model"""),
    "written_per_model": with_(*MAPPED_ALL, RESOLVED_SQL, select=f"""
        SELECT count(*) AS n, round(sum(total), 3) AS total, source_model FROM (
          SELECT source_model, {IAMC}, coalesce(sum(value), 0)::DOUBLE AS total FROM resolved GROUP BY source_model, {IAMC}) GROUP BY source_model"""),
    "written_report": with_(*MAPPED_ALL, COUNTERS_SQL, select="""
        SELECT '=== ' || source_model || ' ===' AS line FROM counters
        UNION ALL SELECT removed || ' identical rows removed' FROM counters WHERE removed > 0
        UNION ALL SELECT renamed || ' differing rows renamed' FROM counters WHERE renamed > 0"""),
    "written_codelist": """
        SELECT line, count(*) AS n FROM (
          SELECT '- ' || p_name || ', ' || p_brand || ':' AS line FROM part
          UNION ALL SELECT '    subsector_name: ' || coalesce(nullif(p_type, 'PROMO'), '') FROM part
          UNION ALL SELECT '    unit: ' || p_size FROM part) GROUP BY line""",
    "written_regions": """
        SELECT 'N' || (c_nationkey * 2) AS source_region, c_custkey AS note, n_name AS target_region
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey * 2""",
    "legacy_files": with_(RESULTS_SQL, REGIONS_SQL, f"""l AS (
        SELECT r.source_model AS model, scenario, coalesce(d.target, region) AS region,
               upper(split_part(original_variable, '|', 1) || ' | ' || unit) AS variable, unit, year, value
        FROM r LEFT JOIN d_region d ON d.source = region WHERE unit <> 'x' AND ord % 17 <> 0)""", select=f"""
        SELECT {IAMC}, {cells_sql(SUM_CELL)} FROM l GROUP BY {IAMC}"""),
    "legacy_report": with_(RESULTS_SQL, select="""
        SELECT source_model, 'values' AS stage, 'rows have no whole-number year and are left out' AS what, count(*) AS n
        FROM r WHERE unit <> 'x' AND ord % 17 = 0 GROUP BY source_model
        UNION ALL SELECT source_model, 'Variables', split_part(original_variable, '|', 1) || ' | ' || unit, count(*)
        FROM r WHERE unit = 'x' GROUP BY ALL"""),
}
