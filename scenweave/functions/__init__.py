"""Column expressions shared by the operators."""

from .paths import file_format, first_dir, parent_dir, rel_path, stem, suffix
from .text import (
    as_text,
    attribute_key,
    issue_text,
    join_parts,
    nullify,
    one_line,
    parse_rule,
    pct,
    py_strip,
    to_number,
    to_year,
)

__all__ = [
    "as_text", "attribute_key", "file_format", "first_dir", "issue_text", "join_parts", "nullify",
    "one_line", "parent_dir", "parse_rule", "pct", "py_strip", "rel_path", "stem", "suffix",
    "to_number", "to_year",
]
