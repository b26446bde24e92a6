"""Expressions on file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Suffixes of files that hold a table.
TABLE_SUFFIX = (".csv", ".parquet", ".orc", ".json", ".jsonl")


def decode_uri(c: Column) -> Column:
    """Plain path of a percent-encoded one; a plus sign is no blank in a path."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def one_spelling(uri: Column) -> Column:
    """``file:/x`` for ``file:///x``: Spark gives either, by how a file was listed."""
    return F.regexp_replace(uri, r"^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def rel_path(path: Column, root: str) -> Column:
    """Path below ``root``, which is given whole and decoded; NULL for a path elsewhere."""
    start = root.rstrip("/") + "/"
    return F.when(path.startswith(start), F.substring(path, F.lit(len(start) + 1), F.length(path)))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_dir(path: Column) -> Column:
    """Everything before the last slash, ``''`` where there is none."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def first_dir(path: Column) -> Column:
    """First folder of a relative file path, ``''`` for a file in the root."""
    return F.regexp_extract(path, r"^([^/]*)/", 1)


def suffix(path: Column) -> Column:
    """Lower-cased suffix with its dot, ``''`` without one."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def file_format(path: Column) -> Column:
    """Reader for a file name; NULL where no reader fits."""
    ext = suffix(path)
    return (
        F.when(ext == ".csv", "csv")
        .when(ext == ".parquet", "parquet")
        .when(ext == ".orc", "orc")
        .when(ext.isin(".json", ".jsonl"), "json")
    )
