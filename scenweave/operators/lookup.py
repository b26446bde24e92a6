"""Dictionary joins.

A dictionary is measured before it is broadcast. One that is over the bound is
joined by a shuffle in which each source key that holds more than a task's
share of the rows is spread over several tasks; its entry alone is repeated.
NULL never matches.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import NamedTuple

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import DUPLICATE_PREFIX, ORDER
from ..functions.text import nullify
from .issues import issue
from .unmapped import unmapped

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class Dictionary:
    """``source``, ``target`` and for units ``factor``; one row per source."""

    frame: DataFrame
    rows: int
    size: int
    # Targets that look like a numbered duplicate.
    dup_targets: int = 0

    @property
    def small(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.size <= BROADCAST_BYTES


class Mapped(NamedTuple):
    rows: DataFrame
    issues: DataFrame


def _last_entries(
    df: DataFrame, source: str, target: str, factor: str | None = None, seq: Sequence[str] | None = None
) -> DataFrame:
    """The last row of each source: ``source``, its ``entry``, and whether the ``written`` factor spells a number."""
    absent = [c for c in (source, target, factor) if c and c not in df.columns]
    if absent:
        raise KeyError(f"dictionary has no column {', '.join(map(repr, absent))}")
    position = F.struct(*seq) if seq else F.monotonically_increasing_id()
    entry, spelled, written = [F.col(f"`{target}`").cast("string").alias("target")], F.lit(True), F.lit(None).cast("string")
    if factor:
        number, written = F.col(f"`{factor}`").try_cast("double"), F.col(f"`{factor}`").cast("string")
        spelled = number.isNotNull() | F.coalesce(nullify(F.trim(written)), F.lit("")).eqNullSafe("")
        entry.append(F.coalesce(F.nanvl(number, F.lit(None)), F.lit(1.0)).alias("factor"))
    rows = df.select(
        F.col(f"`{source}`").cast("string").alias("source"),
        F.struct(F.struct(*entry).alias("entry"), spelled.alias("spelled"), written.alias("written")).alias("row"),
        position.alias("seq"),
    ).filter(F.col("source").isNotNull())
    if factor:
        rows = rows.filter(F.col("row.entry.target").isNotNull())
    return rows.groupBy("source").agg(F.max_by("row", "seq").alias("row")).select("source", "row.*")


def load_dictionary(
    df: DataFrame, source: str, target: str, factor: str | None = None,
    seq: Sequence[str] | None = None,
) -> DataFrame:
    """Reduce a dictionary table to one row per source: the last one wins.

    A blank target on the last row leaves the key unmapped. In a unit table
    rows without source or target are passed over first; a last row whose
    factor is a text that spells no number leaves its unit unmapped (see
    :func:`malformed_factors`), even where an earlier row spells one. A blank
    factor counts as 1. ``seq`` names the columns that give the order of the
    rows; without it the order of the table is taken.
    """
    return _last_entries(df, source, target, factor, seq).filter("spelled").select("source", "entry.*")


def malformed_factors(
    df: DataFrame, source: str, target: str, factor: str, seq: Sequence[str] | None = None
) -> DataFrame:
    """Issues of a unit table: one per unit whose last row has a factor that spells no number."""
    odd = _last_entries(df, source, target, factor, seq).filter(~F.col("spelled"))
    message = F.concat(F.lit("factor "), "written", F.lit(" of "), "source", F.lit(" is no number, the unit counts as missing"))
    return issue(odd, {"stage": "Units", "severity": "error", "key": F.col("source"), "message": message})


def measure_all(frames: Mapping[str, DataFrame]) -> dict[str, Dictionary]:
    """Measure dictionaries, and pin those within the bound.

    A pinned dictionary is a constant of the plans it is used in: its files
    are read once however many steps look keys up, and the result and the
    report see the same entries. One over the bound stays a table.
    """
    tagged = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [frame.withColumn("name", F.lit(name)) for name, frame in frames.items()],
    ).persist()
    try:
        size = F.octet_length("source") + F.coalesce(F.octet_length("target"), F.lit(0)) + F.lit(32)
        measured = {
            r["name"]: r
            for r in tagged.groupBy("name").agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum(size).alias("size"),
                F.count_if(F.col("target").startswith(DUPLICATE_PREFIX)).alias("dup_targets"),
            ).collect()
        }
        found = {
            n: Dictionary(f, measured[n]["rows"], measured[n]["size"], measured[n]["dup_targets"])
            if n in measured else Dictionary(f, 0, 0)
            for n, f in frames.items()
        }
        small = [n for n, d in found.items() if d.small]
        pinned = tagged.filter(F.col("name").isin(small)).toArrow() if small else None
    finally:
        tagged.unpersist()
    for name in small:
        frame = frames[name]
        # One chunk: Spark stops reading an Arrow table at an empty one.
        entries = pinned.filter(pc.field("name") == name).select(frame.columns).combine_chunks()
        found[name] = replace(found[name], frame=frame.sparkSession.createDataFrame(entries, frame.schema))
    return found


def measure(frame: DataFrame | Dictionary) -> Dictionary:
    return frame if isinstance(frame, Dictionary) else measure_all({"dictionary": frame})["dictionary"]


def dictionary_summary(dictionaries: Mapping[str, DataFrame]) -> DataFrame:
    """Entries per dictionary, after the reduction."""
    counts = [
        frame.agg(F.lit(name).alias("dictionary"), F.count(F.lit(1)).alias("entries"))
        for name, frame in dictionaries.items()
    ]
    return reduce(DataFrame.union, counts)


def hot_keys(df: DataFrame, on: Sequence[str]) -> dict[int, int]:
    """Keys that hold more than a task's share of the rows, as hashes, with the number of tasks they are to be spread over.

    One pass over the key columns, with a sketch of fixed size per task. The
    numbers add up to less than twice the number of tasks.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = f"approx_top_k(k, {min(2 * tasks, 50_000)}, {min(max(20 * tasks, 10_000), 1_000_000)})"
    found = df.select(F.xxhash64(*on).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.expr(top).alias("top")).first()
    share = max(1.0, found["n"] / tasks)
    return {r["item"]: math.ceil(r["count"] / share) for r in found["top"] or () if r["count"] > share}


def salted_join(
    df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left",
    spread: Sequence[str] | None = None, hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Shuffle join in which hot keys of ``df`` are spread over several tasks.

    ``side`` has to be unique on ``on``; only its entries for hot keys are
    repeated, once per task of theirs. All other keys meet in one task each.
    The salt is a hash of the row, so a task that runs again gives the same one.
    """
    hot = hot_keys(df, on) if hot is None else hot
    salts = F.lit(1)
    if hot:
        table = F.create_map(*[F.lit(x) for entry in hot.items() for x in entry])
        salts = F.coalesce(F.try_element_at(table, F.xxhash64(*on)), F.lit(1))
    salt = F.pmod(F.xxhash64(*(spread or df.columns)), salts).cast("int")
    repeated = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return df.withColumn("_salt", salt).join(repeated, [*on, "_salt"], how).drop("_salt")


def attach(
    df: DataFrame, dictionary: DataFrame | Dictionary, column: str, fields: Mapping[str, str],
    how: str = "left", known: str | None = None,
) -> DataFrame:
    """Look ``column`` up and add the dictionary ``fields`` (name there -> name here).

    ``known`` adds a flag telling an absent key from a blank target.
    """
    dictionary = measure(dictionary)
    picked = [F.col("source").alias("_key")] + [F.col(n).alias(a) for n, a in fields.items()]
    if known:
        picked.append(F.lit(True).alias(known))
    side = dictionary.frame.select(*picked)
    rows = df.withColumn("_key", F.col(column))
    if dictionary.small:
        joined = rows.join(F.broadcast(side), "_key", how)
    else:
        spread = [c for c in ORDER if c in df.columns]
        joined = salted_join(rows, side, ["_key"], how, spread=spread or None)
    joined = joined.drop("_key")
    return joined.withColumn(known, F.coalesce(F.col(known), F.lit(False))) if known else joined


def _replace(df: DataFrame, column: str, value: Column, helpers: Sequence[str], into: str | None) -> DataFrame:
    return df.withColumn(into or column, value).drop(*helpers)


def map_strict(
    df: DataFrame, column: str, dictionary: DataFrame | Dictionary, label: str,
    drop_unmapped: bool = True, into: str | None = None,
    scope: Sequence[str] = (), order: Sequence[str] = (),
) -> Mapped:
    """Translate a column and list the keys without translation.

    With ``drop_unmapped`` rows without one leave; else they stay with NULL.
    """
    dictionary = measure(dictionary)
    if column not in df.columns:
        raise KeyError(f"no column {column!r} to map {label}")
    looked_up = attach(df, dictionary, column, {"target": "_target"})
    rows = looked_up.filter(F.col("_target").isNotNull()) if drop_unmapped else looked_up
    rows = _replace(rows, column, F.col("_target"), ["_target"], into)
    misses = unmapped(looked_up, {label: (column, "_target")}, scope=scope, order=order)
    return Mapped(rows, misses)


def map_lenient(df: DataFrame, column: str, dictionary: DataFrame | Dictionary) -> DataFrame:
    """Translate a column; keep the source name where there is no translation."""
    joined = attach(df, dictionary, column, {"target": "_target"})
    return _replace(joined, column, F.coalesce("_target", column), ["_target"], None)


def map_model(df: DataFrame, dictionary: DataFrame | Dictionary, column: str = "source_model") -> DataFrame:
    """Add ``model`` and ``model_known``; an absent key keeps its source name.

    A key that is present with a blank target gives a NULL model.
    """
    joined = attach(df, dictionary, column, {"target": "_target"}, known="model_known")
    target = F.when(F.col("model_known"), F.col("_target")).otherwise(F.col(column))
    return joined.withColumn("model", target).drop("_target")


def map_by_spec(
    df: DataFrame, mapping: DataFrame, column: str = "original_variable",
    into: str = "variable", spec: Sequence[str] = ("spec_id",), seq: str = "seq",
) -> DataFrame:
    """Translate with a map that holds within one specification only; drop the rest.

    ``mapping`` has the specification columns, ``source``, ``target`` and
    ``seq``; the last row of a key wins.
    """
    compact = (
        mapping.filter(F.col("source").isNotNull())
        .groupBy(*spec, "source")
        .agg(F.max_by("target", seq).alias(into))
        .filter(F.col(into).isNotNull())
    )
    size = compact.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length("source") + F.octet_length(into) + 32), F.lit(0)).alias("size"),
    ).first()
    on = [*spec, "_key"]
    rows = df.drop(into).withColumn("_key", F.col(column))
    side = compact.withColumnRenamed("source", "_key")
    if Dictionary(compact, size["rows"], size["size"]).small:
        return rows.join(F.broadcast(side), on, "inner").drop("_key")
    return salted_join(rows, side, on, "inner").drop("_key")


def convert_units(
    df: DataFrame, dictionary: DataFrame | Dictionary, keep_original_unit: bool = False
) -> DataFrame:
    """Rescale values and rename units in one join.

    A unit that is not in the table keeps the value; its name becomes NULL
    unless ``keep_original_unit``.
    """
    joined = attach(df, dictionary, "unit", {"target": "_target", "factor": "_factor"})
    name = F.coalesce("_target", "unit") if keep_original_unit else F.col("_target")
    return joined.withColumns(
        {"value": F.col("value") * F.coalesce("_factor", F.lit(1.0)), "unit": name}
    ).drop("_target", "_factor")
