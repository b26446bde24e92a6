"""The run report: one table of typed issues and its text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import issue_text

# Order of the steps within one source.
STAGES = {
    "source": 0, "read": 1, "columns": 2, "Variables": 3, "Regions": 4, "Scenarios": 5, "Units": 6,
    "values": 7, "empty": 8, "model": 9, "duplicates": 10, "pivot": 11,
}
SCHEMA = (
    "source_model string, spec_id bigint, file string, stage string, severity string, "
    "key string, unit string, n bigint, message string, block bigint, row bigint"
)
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def issue(df: DataFrame, *kinds: dict) -> DataFrame:
    """Issue rows of several kinds from one pass over a table.

    A kind gives ``when``, and columns of the issue table; those it does not
    give are taken from the table or NULL.
    """
    types = dict(c.split() for c in SCHEMA.split(", "))

    def row(kind: dict) -> Column:
        fields = []
        for name in COLUMNS:
            given = kind.get(name, F.col(name) if name in df.columns else None)
            fields.append((given if isinstance(given, Column) else F.lit(given)).cast(types[name]).alias(name))
        return F.when(kind.get("when", F.lit(True)), F.struct(*fields))

    rows = F.array_compact(F.array(*[row(k) for k in kinds]))
    return df.select(F.explode(rows).alias("issue")).select("issue.*")


def unmapped_issues(misses: DataFrame) -> DataFrame:
    """A heading with the number of (key, unit) pairs, then one line per key.

    Both come from one pass, as two grouping sets.
    """
    by = [F.col(c) for c in ("source_model", "spec_id", "file", "label") if c in misses.columns]
    position = misses.select("first.*").columns
    whole = [*by, F.col("key"), F.col("unit"), F.col("first")]
    lines = misses.groupingSets([whole, by], *whole).agg(
        F.sum("units").alias("units"), F.sum("n").alias("n"), F.grouping("key").alias("heading")
    )
    heading = F.col("heading") == 1
    count = F.concat(F.col("units").cast("string"), F.lit(" "), F.col("label"), F.lit(" not in the dictionary:"))
    block = F.col("first.block") if "block" in position else F.lit(0)
    return issue(
        lines.withColumn("stage", F.col("label")),
        {
            "severity": "warning",
            "message": F.when(heading, count).otherwise(issue_text(F.col("key"), F.col("unit"))),
            "n": F.when(heading, F.col("units")).otherwise(F.col("n")),
            "block": F.when(heading, -1).otherwise(block),
            "row": F.when(heading, -1).otherwise(F.col(f"first.{position[-1]}")),
        },
    )


def render_report(issues: DataFrame) -> DataFrame:
    """Lines of the report in the order of models, sources, steps and input rows.

    The columns found in each source are in the issue table only.
    """
    issues = issues.filter(F.col("severity") != "found")
    order = F.coalesce(
        *[F.when(F.col("stage") == s, F.lit(i)) for s, i in STAGES.items()], F.lit(len(STAGES))
    )
    title = F.struct(F.lit(-1).cast("bigint").alias("spec_id"), F.lit(-1).alias("step"), F.lit(-1).cast("bigint").alias("block"),
                     F.lit(-1).cast("bigint").alias("row"), F.concat(F.lit("=== "), "source_model", F.lit(" ===")).alias("line"))
    line = F.struct(
        F.coalesce("spec_id", F.lit(2**63 - 1)).alias("spec_id"),
        order.alias("step"),
        F.coalesce("block", F.lit(0)).alias("block"),
        F.coalesce("row", F.lit(0)).alias("row"),
        F.when(F.col("stage") == "source", F.concat(F.lit("--- "), "file", F.lit(" ---")))
        .otherwise(F.col("message")).alias("line"),
    )
    # Every issue brings the title of its model along; one of them is kept.
    both = issues.select("source_model", F.explode(F.array(title, line)).alias("e")).select("source_model", "e.*")
    return (
        both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("times"))
        .withColumn("times", F.when(F.col("spec_id") == -1, 1).otherwise(F.col("times")))
        .select(*both.columns, F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_"))
        .drop("_")
        .orderBy("source_model", "spec_id", "step", "block", "row", "line")
    )
