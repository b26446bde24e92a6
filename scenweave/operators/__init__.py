"""Operators on DataFrames."""

from .codelist import render_codelist
from .columns import (
    SpecError,
    canonicalize,
    compose_variable,
    drop_blank_rows,
    first_per_group,
    found_columns,
    nullify_tokens,
    project_spec,
    require,
    to_iamc_long,
    trim_headers,
    type_measures,
    union_sources,
    unpivot_values,
)
from .duplicates import duplicate_counters, duplicate_stats, mark_duplicates, resolve_duplicates
from .issues import render_report
from .lookup import (
    Dictionary,
    convert_units,
    dictionary_summary,
    load_dictionary,
    malformed_factors,
    map_by_spec,
    map_lenient,
    map_model,
    map_strict,
    measure,
    measure_all,
)
from .regions import country_codes, normalize_regions, region_coverage, region_misses
from .reshape import assert_unique, distinct_years, pivot_sum, pivot_years
from .unmapped import unmapped, unmapped_set

__all__ = [
    "Dictionary", "SpecError", "assert_unique", "canonicalize", "compose_variable", "convert_units",
    "country_codes", "dictionary_summary", "distinct_years", "drop_blank_rows", "duplicate_counters",
    "duplicate_stats", "first_per_group", "found_columns", "load_dictionary", "malformed_factors", "map_by_spec",
    "map_lenient", "map_model", "map_strict", "mark_duplicates", "measure", "measure_all",
    "normalize_regions", "nullify_tokens", "pivot_sum", "pivot_years", "project_spec",
    "region_coverage", "region_misses", "render_codelist", "render_report", "require",
    "resolve_duplicates", "to_iamc_long", "trim_headers", "type_measures", "union_sources",
    "unmapped", "unmapped_set", "unpivot_values",
]
