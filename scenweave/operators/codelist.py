"""Variable codelists as text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import attribute_key, one_line


def _quoted(c: Column) -> Column:
    escaped = F.regexp_replace(c, r'(["\\])', r"\\$1")
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def render_codelist(
    df: DataFrame, order: Sequence[str] = ("seq",), columns: Sequence[str] | None = None,
    escape: bool = False,
) -> DataFrame:
    """Lines of a codelist, with the place of the row and of the line in it.

    The first column names the item, the others are its attributes.
    """
    columns = list(columns or [c for c in df.columns if c not in order])
    head, *attributes = columns
    show = _quoted if escape else lambda c: c

    def cell(name: str) -> Column:
        return show(one_line(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))))

    lines = [F.concat(F.lit("- "), cell(head), F.lit(":"))]
    for name in attributes:
        key = attribute_key(name)
        indent = "  - " if key == "source:" else "    "
        lines.append(F.concat(F.lit(f"{indent}{key}: "), cell(name)))
    return df.select(*order, F.posexplode(F.array(*lines)).alias("line_no", "line"))
