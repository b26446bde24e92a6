"""Secrets in texts: spans of three strong patterns, and weak candidates that count only next to a complementary part.

An access identifier, a secret and an endpoint of one service are often kept near each other. A bare 40-character token or a
host name alone says nothing; within ``SCOPE`` code points of a part of another kind it completes a credential. The parts of
each text are joined to each other by interval: in passes over the parts in order of position, windows carry the nearest part of
each kind on either side, so the work is linear in the parts and no pairs are made. A candidate is reported when
such a part lies within the scope, which holds for the nearest if it holds for any. A secret and an endpoint that overlap, as a
token in the path of an address does, are one part and do not complete each other.

Spans are code point positions, end exclusive. NULL and empty texts have no spans. Links depend on the text alone, so rows that
repeat it, and rows without id, get the same ones. All work is done by built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage

#: Pattern, group that has a least length, that length. Letters of the first one's words match in either case.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of 20 (24) or more is what its first 20 (24) characters begin, so the least length can be part of the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGNED_AT_LEAST = 6
#: Weak candidates: a bare token of 40 characters as cloud secrets have, also right after the ``=`` of an assignment, and the
#: address of a service, whose host may be of any length and in letters of either case.
SECRET = r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"(?<![A-Za-z0-9.-])(?i:(?:https?://)?[a-z0-9.-]+\.amazonaws\.com)(?:/[A-Za-z0-9._/-]*)?"
#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "secret", "endpoint")
#: Code points between two parts of one credential, at most.
SCOPE = 300


def before_each(values: Column, combine) -> Column:
    """For each whole number of an array what those before it come to, by ``combine`` (sum, greatest) from 0 on.

    An array that grows entry by entry is copied each time. Here entries are taken in about as many parts as a part has
    entries, so n of them cost n times the square root of n copies at most.
    """
    def heads(part: Column, start: Column) -> Column:
        return F.aggregate(
            part, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct(combine(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def parts(all_: Column) -> Column:
        each = F.ceil(F.sqrt(F.size(all_))).cast("int")
        at = F.sequence(F.lit(0), F.ceil(F.size(all_) / F.greatest(each, F.lit(1))).cast("int") - 1)
        return F.when(F.size(all_) > 0, F.transform(at, lambda i: F.slice(all_, i * each + 1, each))).otherwise(F.array().cast("array<array<int>>"))

    def joined(cut: Column) -> Column:
        starts = heads(F.transform(cut, lambda part: F.aggregate(part, F.lit(0), combine)), F.lit(0))
        return F.flatten(F.zip_with(cut, starts, heads))

    # Bound to variables, so that each is worked out once.
    bound = F.transform(F.array(values), lambda all_: F.get(F.transform(F.array(parts(all_)), joined), 0))
    return F.get(bound, 0)


def found(
    text: Column, pattern: str, kind: str, group: int = 0, at_least: int = 0, holds: tuple[str, ...] = (), fold: bool = False,
) -> Column:
    """Array of ``(start, end, kind)``, from the pieces between matches and the matches themselves.

    ``holds``: every match has one of these strings, so that texts without any are done by a plain search;
    with ``fold``, in letters of either case.
    """
    k = F.lit(KINDS.index(kind))
    regex = F.lit(pattern)
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, regex, F.lit(0))
    # One number more than there are matches: the last piece has none behind it.
    lengths = F.zip_with(F.transform(pieces, F.char_length), F.transform(hits, F.char_length), lambda p, h: F.struct(p.alias("p"), h.alias("h")))
    ends = F.get(F.transform(F.array(F.filter(lengths, lambda x: x["h"].isNotNull())), lambda known: F.zip_with(
        known, before_each(F.transform(known, lambda x: x["p"] + x["h"]), lambda a, x: a + x),
        lambda x, at: F.struct((at + x["p"]).alias("s"), (at + x["p"] + x["h"]).alias("e"), k.alias("k")))), 0)
    if at_least:
        value = F.regexp_extract_all(text, regex, F.lit(group))
        ends = F.transform(
            F.filter(F.arrays_zip(ends.alias("span"), value.alias("value")), lambda x: F.char_length(x["value"]) >= at_least),
            lambda x: x["span"],
        )
    none = F.array().cast("array<struct<s:int,e:int,k:int>>")
    can = F.lit(not holds)
    for part in holds:
        can = can | F.contains(F.lower(text) if fold else text, F.lit(part))
    return F.when(F.coalesce(can & text.rlike(pattern), F.lit(False)), ends).otherwise(none)


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans in their order, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_md5`` and the arrays ``base`` (strong spans, ordered) and ``weak``, from one reading of each text.

    Secrets are looked for only in texts that have an access identifier or an endpoint; elsewhere nothing could complete them.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    strong = docs.select("doc_id", text.alias("text")).withColumns({
        "assign": found(F.col("text"), ASSIGN, "assign", 2, ASSIGNED_AT_LEAST, (":", "=")),
        "access": found(F.col("text"), ACCESS, "access", holds=("AKIA",)),
        "hex": found(F.col("text"), HEX, "hex"),
        "endpoint": found(F.col("text"), ENDPOINT, "endpoint", holds=(".amazonaws.com",), fold=True),
    })
    none = F.array().cast("array<struct<s:int,e:int,k:int>>")
    completed = (F.size("access") > 0) | (F.size("endpoint") > 0)
    by_start = lambda a: F.transform(
        F.array_sort(F.transform(a, lambda x: F.struct(x["s"], x["k"], x["e"]))), lambda x: F.struct(x["s"], x["e"], x["k"]))
    return strong.select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"),
        *[F.size(c).cast("long").alias(f"n_{c}") for c in ("assign", "access", "hex")],
        by_start(F.concat("assign", "access", "hex")).alias("base"),
        F.when(completed, F.concat(found(F.col("text"), SECRET, "secret"), "endpoint")).otherwise(none).alias("weak"),
    )


def link(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id, text_md5, linked``: weak candidates that lie within ``scope`` of a part of another kind of the same text.

    The interval join: parts are ordered by position within a text, and each candidate meets the nearest identifier on either side
    and the nearest candidate of the other kind that ends before it or starts after it. Spans of a kind are disjoint, so only the
    nearest one of a kind can overlap a candidate; it comes with the one beyond it, which then is the nearest.
    """
    parts = scanned.filter(F.size("weak") > 0).select(
        "doc_id", "text_md5",
        F.explode(F.concat(F.filter("base", lambda x: x["k"] == KINDS.index("access")), "weak")).alias("part"),
    ).select("doc_id", "text_md5", "part.*").distinct()
    # All windows run from their first row on; a frame that ends at the last row would be read again for every row.
    text, first = W.partitionBy("doc_id", "text_md5"), W.unboundedPreceding
    onward, backward, by_end = text.orderBy("s", "k"), text.orderBy(F.desc("s"), F.desc("k")), text.orderBy(F.desc("e"), F.desc("k"))
    is_ = lambda kind: F.col("k") == KINDS.index(kind)
    last = lambda kind, value, order: F.last(F.when(is_(kind), value), True).over(order.rowsBetween(first, -1))
    near = parts.withColumns({
        "ended": last("access", F.col("e"), onward),
        "starts": last("access", F.col("s"), backward),
        "e_before": F.when(is_("secret"), last("secret", F.col("e"), onward)).when(is_("endpoint"), last("endpoint", F.col("e"), onward)),
        "s_after": F.when(is_("secret"), last("secret", F.col("s"), by_end)).when(is_("endpoint"), last("endpoint", F.col("s"), by_end)),
    })
    either = lambda value, order: F.when(is_("secret"), last("endpoint", value, order)).when(is_("endpoint"), last("secret", value, order))
    near = near.withColumns({
        "before": either(F.struct("e", "e_before"), onward), "after": either(F.struct("s", "s_after"), by_end),
    })
    ended = F.when(F.col("before.e") <= F.col("s"), F.col("before.e")).otherwise(F.col("before.e_before"))
    starts = F.when(F.col("after.s") >= F.col("e"), F.col("after.s")).otherwise(F.col("after.s_after"))
    linked = near.filter(~is_("access") & (
        (F.col("s") - F.col("ended") <= scope) | (F.col("starts") - F.col("e") <= scope) | (F.col("s") - ended <= scope) | (starts - F.col("e") <= scope)
    ))
    return linked.groupBy("doc_id", "text_md5").agg(F.collect_list(F.struct("s", "k", "e")).alias("linked"))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base, spans`` (arrays of ``s, e, k``) and ``text_md5``."""
    scanned = stage(scan(docs), "scanned")
    linked = link(scanned, scope).withColumnRenamed("doc_id", "id").withColumnRenamed("text_md5", "md5")
    on = scanned["doc_id"].eqNullSafe(linked["id"]) & (scanned["text_md5"] == linked["md5"])
    alone = scanned.filter(F.size("weak") == 0).withColumn("spans", F.col("base"))
    every = F.concat(
        F.transform("base", lambda x: F.struct(x["s"], x["k"], x["e"])),
        F.coalesce("linked", F.array().cast("array<struct<s:int,k:int,e:int>>")),
    )
    joined = scanned.filter(F.size("weak") > 0).join(linked, on, "left").drop("id", "md5").withColumn(
        "spans", F.transform(F.array_sort(every), lambda x: F.struct(x["s"], x["e"], x["k"]))
    ).drop("linked")
    return alone.unionByName(joined).drop("weak")


def redact(docs: DataFrame, mark: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """The same rows with every span (linked ones too) replaced by ``mark``; ``n_chars`` follows where it exists.

    Spans that overlap are replaced as one. Texts without spans stay as they are, NULL included.
    """
    with_md5 = docs.withColumn("_md5", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    found_ = find_secrets(docs, scope).filter(F.size("spans") > 0).select(
        F.col("doc_id").alias("_id"), F.col("text_md5").alias("_key"), F.col("spans").alias("_spans")).distinct()
    found_ = stage(found_, "spans")
    joined = with_md5.join(found_, with_md5["doc_id"].eqNullSafe(found_["_id"]) & (F.col("_md5") == F.col("_key")), "left")
    # Fixed width makes a piece's place its position times four; a mark of that width keeps one at its beginning.
    wide, bom = F.encode(F.col("text"), "UTF-32"), F.unhex(F.lit("0000FEFF"))
    piece = lambda of, at, to: F.decode(F.concat(bom, F.substring(of, 4 * at + 1, 4 * (to - at))), "UTF-32")
    until = before_each(F.transform("_spans", lambda x: x["e"]), lambda a, x: F.greatest(a, x))
    last = F.array_max(F.transform("_spans", lambda x: x["e"]))
    clean = F.get(F.transform(F.array(wide), lambda of: F.concat(
        F.array_join(F.zip_with("_spans", until, lambda x, at: F.when(x["s"] >= at, F.concat(piece(of, at, x["s"]), F.lit(mark))).otherwise("")), ""),
        piece(of, last, F.char_length("text")))), 0)
    out = joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))
    return out.select(*docs.columns)


def digests(found_: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return found_.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
    )
