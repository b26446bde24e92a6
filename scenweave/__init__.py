"""Harmonisation of scenario result tables on Spark."""

from .plans.harmonize import Harmonized, Run, harmonize, harmonize_rows, pivot_issues, to_wide
from .plans.legacy import LegacyRun, harmonize_legacy, legacy_rows, legacy_wide, write_legacy
from .plans.regions import RegionTable, convert_regions
from .sources.codelists import export_codelist, read_codelist, write_codelist
from .sources.dictionaries import load_dictionaries, read_dictionary_table
from .sources.files import catalog_files, write_catalog
from .sources.sinks import write_iamc, write_regions, write_report
from .sources.specs import load_specs, spec_summary

__all__ = [
    "Harmonized", "LegacyRun", "RegionTable", "Run", "catalog_files", "convert_regions", "export_codelist", "harmonize",
    "harmonize_legacy", "harmonize_rows", "legacy_rows", "legacy_wide", "load_dictionaries",
    "load_specs", "pivot_issues", "read_codelist", "read_dictionary_table", "spec_summary",
    "to_wide", "write_catalog", "write_codelist", "write_iamc", "write_legacy", "write_regions", "write_report",
]
