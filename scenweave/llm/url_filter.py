"""URL filters: rules on hosts and paths first, gradient-boosted trees on lexical features for what no rule fits.

1. Host and path are cut out of the address. A rule (host, path, verdict) fits its host, all of its subdomains, and paths that start
   with its own; of several the longest wins. Rules are a parameter, so they become one expression, without a join.
2. Features of an address, all in steps fixed beforehand so that they depend on the address alone: length of address and host,
   labels of the host, depth of the path, share of digits, entropy of the characters, parameters, length of the query, hyphens,
   and statistics of the host's suffix (its last label): its share of all addresses, and the smoothed share of blocked ones
   among those labelled. The first part of the path has the same statistics. Suffixes with less than a thousandth of the addresses
   count as one, so there are at most a thousand others and the table of suffixes is bounded whatever the data. Statistics
   combine in the tasks before they are shuffled.
3. Labelled addresses are those that a rule fits. They are counted per combination of feature steps (at most ``SAMPLE`` addresses, chosen by
   hash when there are more), and trees are grown on these counts: each level of a tree is one aggregation of gradients per
   (node, feature, step), of which the driver reads at most 4 nodes x 13 features x 64 steps rows and takes the best splits. A
   tree is an expression of ``CASE WHEN``; the model is their sum.
4. An address without rule is blocked if the model gives it ``THRESHOLD`` or more.

Gradients are summed as whole numbers, so neither partitions nor their order change a split; equal splits go to the first feature
and the smallest step. Without labelled addresses, or with labels of one kind only, the model is the smoothed share of blocked ones.

Null handling: NULL addresses and those without ``://`` have an empty host and path, no rule fits them, and they are judged by the
model like all others (a NULL address has the features of an empty one). Ids are carried along only. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: (host, path, verdict) of the rules of the registered query (fixed values).
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
TREES, DEPTH, RATE = 12, 3, 0.4
SHRINK, LEAST_WEIGHT = 1.0, 1.0
SAMPLE = 200_000
THRESHOLD = 0.5
#: Suffixes with a smaller share of the addresses count as one.
RARE = 0.001
#: Weight of the overall share in a suffix's share of blocked addresses.
SMOOTH = 20
#: Gradients are summed in units of this.
UNIT = 1 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; path: what follows up to ``?`` or ``#``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; NULL if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The longest comes to stand outermost, so that it is asked first.
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _steps(value: Column, most: int) -> Column:
    return F.least(F.floor(value), F.lit(most)).cast("int")


def _entropy(text: Column) -> Column:
    """Bits per character: runs of equal characters are counted along the sorted ones."""
    n = F.length(text)
    step = lambda s, c: F.when(
        s["c"] == c, F.struct(c.alias("c"), (s["n"] + 1).alias("n"), s["sum"].alias("sum"))
    ).otherwise(F.struct(c.alias("c"), F.lit(1).alias("n"), (s["sum"] + s["n"] * F.log2(s["n"])).alias("sum")))
    start = F.struct(F.lit("").alias("c"), F.lit(1).alias("n"), F.lit(0.0).alias("sum"))
    total = F.aggregate(F.array_sort(F.split(text, "")), start, step, lambda s: s["sum"] + s["n"] * F.log2(s["n"]))
    return F.when(n > 1, F.greatest(F.log2(n) - total / n, F.lit(0.0))).otherwise(0.0)


#: Name of each lexical feature and its largest step.
LEXICAL = {
    "f_length": 63, "f_host_length": 63, "f_labels": 15, "f_depth": 15, "f_digits": 32, "f_entropy": 63, "f_parameters": 15, "f_query_length": 63,
    "f_hyphens": 15,
}
KEYS = ("suffix", "head")
STATISTICS = {f"f_{key}_{what}": 40 for key in KEYS for what in ("share", "blocked")}
FEATURES = list(LEXICAL) + list(STATISTICS)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Feature steps that depend on the address alone."""
    size = F.length(url)
    log_steps = lambda x: 4 * F.log2(x + 1)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    raw = {
        "f_length": log_steps(size), "f_host_length": log_steps(F.length(host)),
        "f_labels": F.when(host == "", 0).otherwise(F.size(F.split(host, r"\.", -1))),
        "f_depth": F.regexp_count(path, F.lit("/[^/]")), "f_digits": 32 * F.regexp_count(url, F.lit("[0-9]")) / F.greatest(size, F.lit(1)),
        "f_entropy": 8 * _entropy(url), "f_parameters": F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("[^&]+"))),
        "f_query_length": log_steps(F.length(query)), "f_hyphens": F.regexp_count(url, F.lit("-")),
    }
    return {name: _steps(value, LEXICAL[name]).alias(name) for name, value in raw.items()}


def described(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``page_id, url, host, path, rule, said`` (the rule's verdict), ``suffix``, ``head`` and the lexical feature steps."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = host_and_path(url)
    cut = pages.select("page_id", url.alias("url"), host.alias("host"), path.alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    features = lexical(F.col("url"), F.col("host"), F.col("path"))
    return cut.select(
        "page_id", "url", "host", "path", rule.alias("rule"), said.alias("said"), F.substring_index("host", ".", -1).alias("suffix"),
        F.regexp_extract("path", r"^/([^/]*)", 1).alias("head"), *features.values(),
    )


def with_statistics(pages: DataFrame, key: str) -> DataFrame:
    """Pages with the statistics of their ``key`` (suffix or head), those of the rare ones together where theirs is rare.

    The table of the others has at most ``1 / RARE`` rows by construction, so it is broadcast.
    """
    each = stage(pages.groupBy(key).agg(
        F.count("*").alias("n"), F.count("said").alias("labelled"), F.count_if(F.col("said") == "block").alias("blocked")), f"{key}-counts")
    whole = each.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "labelled", "blocked"))).first()
    overall = (whole["blocked"] + 1) / (whole["labelled"] + 2)
    steps = {
        f"f_{key}_share": -4 * F.log2(F.sum("n") / F.lit(whole["n"])),
        f"f_{key}_blocked": 40 * (F.sum("blocked") + SMOOTH * overall) / (F.sum("labelled") + SMOOTH),
    }
    known = each.groupBy(F.when(F.col("n") >= RARE * whole["n"], F.col(key)).alias("name")).agg(
        *(_steps(value, STATISTICS[name]).alias(name) for name, value in steps.items()))
    rare = known.filter("name is null").first() or dict.fromkeys(steps, 0)
    named = F.broadcast(known.filter("name is not null").withColumnRenamed("name", key))
    return pages.join(named, key, "left").withColumns({name: F.coalesce(name, F.lit(rare[name])) for name in steps})


def _weights(n: Column, y: Column, margin: Column) -> tuple[Column, Column]:
    """Gradient and curvature of the logistic loss, as whole numbers."""
    p = 1 / (1 + F.exp(-margin))
    whole = lambda x: F.round(x * UNIT).cast("long")
    return n * whole(p - y), n * whole(p * (1 - p))


def _gain(g: int, h: int) -> float:
    return g / UNIT * g / (h + SHRINK * UNIT)


def _best_splits(rows: list, features: Sequence[str], totals: dict[int, tuple[int, int]]) -> dict[int, tuple[str, int]]:
    """Per node the best (feature, step): steps up to it go left. ``totals`` gets the sums of the nodes and of their children."""
    sums: dict[int, dict[str, list[tuple[int, int, int]]]] = {}
    for r in rows:
        sums.setdefault(r["node"], {}).setdefault(r["feature"], []).append((r["step"], r["g"], r["h"]))
    best = {}
    for node, by_feature in sums.items():
        g_all, h_all = totals[node] = tuple(sum(s[i] for s in by_feature[features[0]]) for i in (1, 2))
        top = 1e-6
        for feature in features:
            g = h = 0
            for step, dg, dh in sorted(by_feature[feature])[:-1]:
                g, h = g + dg, h + dh
                if min(h, h_all - h) >= LEAST_WEIGHT * UNIT:
                    gain = _gain(g, h) + _gain(g_all - g, h_all - h) - _gain(g_all, h_all)
                    if gain > top:
                        top, best[node] = gain, (feature, step)
                        totals[2 * node], totals[2 * node + 1] = (g, h), (g_all - g, h_all - h)
    return best


def grow(cells: DataFrame, features: Sequence[str] = tuple(FEATURES), trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> tuple[float, list[Column]]:
    """(margin to start from, trees): boosted on ``cells``, that is ``n`` rows with label ``y`` (0 or 1) per combination of feature steps."""
    whole = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("n") * F.col("y")), F.lit(0)).alias("blocked")).first()
    share = (whole["blocked"] + 1) / (whole["n"] + 2)
    start, grown = math.log(share / (1 - share)), []
    if not 0 < whole["blocked"] < whole["n"]:
        return start, grown
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("step")) for f in features)))
    for _ in range(trees):
        g, h = _weights(F.col("n"), F.col("y"), F.lit(start) + reduce(lambda a, b: a + b, grown, F.lit(0.0)))
        rows = cells.select(*features, g.alias("g"), h.alias("h"))
        node, splits, totals, open_ = F.lit(1), {}, {}, [1]
        for _ in range(depth):
            sums = rows.select(node.alias("node"), "g", "h", each.alias("x")).filter(F.col("node").isin(open_)).groupBy(
                "node", "x.feature", "x.step").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            best = _best_splits(sums, features, totals)
            splits |= best
            open_ = [c for n in sorted(best) for c in (2 * n, 2 * n + 1)]
            for n, (feature, step) in sorted(best.items()):
                node = F.when(node == n, F.when(F.col(feature) <= step, 2 * n).otherwise(2 * n + 1)).otherwise(node)
            if not best:
                break
        grown.append(_tree(1, splits, {n: -rate * g / (h + SHRINK * UNIT) for n, (g, h) in totals.items()}))
    return start, grown


def _tree(node: int, splits: dict[int, tuple[str, int]], leaves: dict[int, float]) -> Column:
    if node not in splits:
        return F.lit(leaves[node])
    feature, step = splits[node]
    return F.when(F.col(feature) <= step, _tree(2 * node, splits, leaves)).otherwise(_tree(2 * node + 1, splits, leaves))


def train(pages: DataFrame, sample: int = SAMPLE) -> Column:
    """Chance that an address is blocked, from described pages with all statistics: an expression of their feature steps."""
    labelled = pages.filter(F.col("said").isNotNull())
    n = pages.agg(F.count("said")).first()[0]
    if n > sample:
        labelled = labelled.filter(F.pmod(F.xxhash64("url", "page_id"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    cells = labelled.groupBy(*FEATURES, (F.col("said") == "block").cast("int").alias("y")).agg(F.count("*").alias("n"))
    start, trees = grow(stage(cells, "url-cells"))
    return 1 / (1 + F.exp(-(F.lit(start) + reduce(lambda a, b: a + b, trees, F.lit(0.0)))))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Per page ``page_id, host, path, rule, verdict, score``: the model's chance to be blocked is ``score``, for all pages."""
    whole = reduce(with_statistics, KEYS, described(pages, rules))
    score = train(whole, sample)
    by_model = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return whole.withColumn("score", score).select("page_id", "host", "path", "rule", F.coalesce("said", by_model).alias("verdict"), "score")
