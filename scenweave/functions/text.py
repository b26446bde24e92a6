"""Text and number expressions. Everything is a built-in Spark expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import NA_TOKENS

_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def py_strip(c: Column) -> Column:
    """Remove Unicode white space from both ends (``trim`` removes the blank only)."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def parse_rule(rule: str | None) -> list[str]:
    """Column names of a variable rule such as ``Variable|Sector|Carrier``."""
    text = (rule or "").strip()
    return [part.strip() for part in text.split("|")] if "|" in text else [text]


def join_parts(parts: Sequence[Column], sep: str = "|", null_text: str = "") -> Column:
    """Join parts; a null part still takes its place, unlike in ``concat_ws``."""
    return F.concat_ws(sep, *[F.coalesce(p, F.lit(null_text)) for p in parts])


def as_text(c: Column, data_type: T.DataType | None = None) -> Column:
    """Text of a cell, numbers and booleans in the spelling of a result table.

    ``1e20`` becomes ``1e+20`` and ``123456789.0`` keeps its digits, where a
    plain cast gives ``1.0E20`` and ``1.23456789E8``.
    """
    if data_type is None or isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    if not isinstance(data_type, (T.DoubleType, T.FloatType)):
        return c.cast("string")
    raw = c.cast("string")
    size = F.abs(c)
    digits = F.regexp_replace(raw.try_cast("decimal(38,21)").cast("string"), r"0+$", "")
    digits = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.substring_index(raw, "E", 1), r"\.0$", "")
    power = F.substring_index(raw, "E", -1).try_cast("int")
    exponent = F.concat(
        F.when(power < 0, "e-").otherwise("e+"),
        F.when(F.abs(power) < 10, "0").otherwise(""),
        F.abs(power).cast("string"),
    )
    return (
        F.when(F.isnan(c), F.lit(None).cast("string"))
        .when(size == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
        .when((c == 0) | ((size >= 1e-3) & (size < 1e7)), raw)
        .when((size >= 1e-4) & (size < 1e16), digits)
        .otherwise(F.concat(mantissa, exponent))
    )


def nullify(c: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """NULL for cells that spell a missing value."""
    return F.when(~c.isin(*tokens), c)


def to_number(c: Column, data_type: T.DataType | None = None) -> Column:
    """DOUBLE of a cell, NULL where it is no number; NaN becomes NULL."""
    if data_type is not None and not isinstance(data_type, T.StringType):
        number = c.try_cast("double")
        return F.when(~F.isnan(number), number)
    # Java also parses "1d", "1f" and "0x1p3", which no result table means as a number.
    number = F.when(~c.rlike(r"(?i)x|[0-9.][df]\s*$"), c.try_cast("double"))
    return F.when(~F.isnan(number), number)


def to_year(number: Column) -> Column:
    """INT year of a number; NULL where it is no whole one."""
    return F.when(number == F.floor(number), number.try_cast("int"))


def one_line(c: Column) -> Column:
    """Replace line breaks inside a cell."""
    return F.replace(c, F.lit("\n"), F.lit(", "))


def attribute_key(name: str) -> str:
    """Attribute name of a codelist heading: ``Sub-Sector Name`` -> ``subsector_name``."""
    return name.lower().replace(" ", "_").replace("-", "")


def pct(part: Column, whole: Column) -> Column:
    """Percentage to one decimal, 0 of nothing."""
    return F.coalesce(F.round(F.try_divide(part * F.lit(100.0), whole), 1), F.lit(0.0))


def issue_text(key: Column, unit: Column | None = None) -> Column:
    """Report line of a missing key, with its unit where there is one."""
    shown = F.coalesce(key, F.lit("<NA>"))
    if unit is None:
        return shown
    return F.when(unit.isNotNull(), F.concat(shown, F.lit(" - "), unit)).otherwise(shown)
