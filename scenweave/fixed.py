"""Names, tokens and limits that decide results."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Accepted spellings of the five canonical columns, first match wins.
COLUMN_ALIASES = {
    "scenario": ["scenario", "Scenario", "Scenario name", "Source Scenario", "scen", "SCEN1"],
    "region": ["region", "Region", "Region name", "Source Region", "area", "AREA"],
    "year": ["year", "Year", "TIME", "Source Year", "Period"],
    "value": ["value", "Value", "Source Value", "VAL", "growth"],
    "unit": ["Unit", "unit"],
}

# Cell texts that mean "missing" in delimited files.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Region codes that are not country codes; they take precedence over those.
CUSTOM_REGIONS = {
    "ACE": "Asia (Eastern)",
    "AEA": "Africa (Eastern)",
    "ASE": "Asia (Southeast)",
    "ASO": "Asia (Southern)",
    "AWE": "Africa (Western)",
    "CHI": "China",
    "EUR": "Europe",
    "NAM": "North America",
    "LAM": "Latin America",
    "MEA": "Middle East & Africa",
}

# Columns of the overview of source tables, the dictionaries and the catalog.
SPEC_COLUMNS = ["File location", "File name", "Source model", "Sheet name", "Separator", "Variable column"]
LEGACY_SPEC_COLUMNS = [
    "Variable value (original)", "Variable name (new)", "Source Scenario", "Source Region",
    "Source Year", "Source Value", "Source Unit", "Unit",
]
DICTIONARY_COLUMNS = {
    "variables": ("names mapping", "DE variable name", None),
    "regions": ("source_region", "target_region", None),
    "models": ("source_models", "target_models", None),
    "scenarios": ("source_scenario", "target_scenario", None),
    "units": ("source_unit", "target_unit", "conversion_factor"),
}
CATALOG_COLUMNS = ["Source model", "File location", "File name", "Sheet name", "Column names"]

# Prefix of the region name of contradicting observations.
DUPLICATE_PREFIX = "dup_"
# ----------------------------------------------------------------------------

CANONICAL = ["scenario", "region", "year", "value", "unit"]
IAMC_KEYS = ["model", "scenario", "region", "variable", "unit"]
ORDER = ["spec_id", "block", "row"]
