"""Quality rules: counts of a text, and its divergence from what texts of its language look like.

Two histograms of each document, of character classes and of the most common words of its language, are compared with the
language's own, summed over all documents that pass the plain rules, by Jensen-Shannon distance (base 2, from 0 to 1). A
histogram counts only above a least length: a short text has no distribution to speak of.

Languages without a word list, and NULL, use the classes alone; each has its own reference. NULL and empty texts have no words
and fail the plain rule. Repeated rows are judged alike, and each counts in the reference. Other columns are ignored. All work
is done by built-in functions, document by document; only the histograms (a few numbers each) leave a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, stage

#: The most common function words of each language (fixed values).
COMMON = {
    "en": "the of and to in a is that it for was on are as with be by this or an at from not".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par plus pas au sur ne se avec".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más".split(),
}
#: Character classes (fixed values); what is in none of them is ``other``.
CLASSES = {
    "lower": "a-z", "upper": "A-Z", "digit": "0-9", "stop": ".,;:'\"()?-", "symbol": "#*$%&|<>", "shout": "!", "high": "\\x{80}-\\x{10FFFF}",
}
WINDOW = 5
LEAST_WORDS = 10
REPEATED_PERCENT = 20
#: A document is kept while its distances are at most these; a histogram of fewer characters or words is not judged.
MOST_CLASSES, LEAST_CHARS = 0.2, 200
MOST_WORDS, LEAST_COMMON = 0.45, 50


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words in windows that occur twice or more, over an array of words. Windows are compared by 64-bit hash.

    Hashes without an equal are the rule, and answered at once; else they are sorted with their places, those with an equal
    neighbour are kept, and each adds the words up to the next such window, a window's length at most.
    """
    places = F.sequence(F.lit(1), F.size(words) - (window - 1))
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + (k - 1)) for k in range(window)]))
    return F.when(F.size(words) < window, F.array().cast("array<bigint>")).otherwise(hashes)


def _marked(hashes: Column) -> Column:
    """Places of the windows that have an equal, in order, from an array of hashes."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return placed


def count_rules(docs: DataFrame) -> DataFrame:
    """``doc_id, lang``, the counts of the plain rules, and the histograms ``classes`` and ``common`` (arrays of counts)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    one = docs.select("doc_id", "lang", text.alias("text")).withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    two = one.withColumn("hashes", repeated_words(F.col("words"))).withColumn(
        "placed", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), _marked(F.col("hashes")))
    )
    equal = lambda x, n: F.coalesce(F.get(F.col("placed"), n)["h"] == x["h"], F.lit(False))
    three = two.withColumn("placed", F.array_sort(F.transform(
        F.filter("placed", lambda x, n: equal(x, n - 1) | equal(x, n + 1)), lambda x: x["i"])))
    steps = F.transform("placed", lambda i, n: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("placed"), n + 1) - i, F.lit(WINDOW))))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    four = three.withColumn("lines", lines).withColumn("joined", F.array_join("words", ""))
    left = lambda c: F.char_length(F.regexp_replace("joined", f"[^{c}]+", "")).cast("long")
    listed = F.array_join(F.filter(F.transform("words", F.lower), lambda w: F.array_contains(_list(), w)), "  ")
    five = four.select(
        "doc_id", "lang",
        F.size("words").cast("long").alias("n_words"),
        F.char_length("joined").cast("long").alias("word_chars"),
        left(CLASSES["symbol"]).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array(*[left(c) for c in CLASSES.values()]).alias("classes"),
        F.concat(F.lit(" "), listed, F.lit(" ")).alias("listed"),
    )
    # Words of the list stand between two spaces each, so taking one out shortens the text by its length and two.
    one_word = lambda w: ((F.char_length("listed") - F.char_length(F.replace("listed", F.concat(F.lit(" "), w, F.lit(" "))))) / (
        F.char_length(w) + 2)).cast("long")
    return five.withColumn("common", F.when(F.size(_list()) > 0, F.transform(_list(), one_word))).drop("listed")


def _list() -> Column:
    lists = F.create_map(*[x for k, v in COMMON.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in v]))])
    return F.coalesce(F.element_at(lists, F.coalesce(F.col("lang"), F.lit(""))), F.array().cast("array<string>"))


def references(counted: DataFrame) -> DataFrame:
    """One row per language: the sums of the documents' histograms."""
    sums = lambda c, n: F.array(*[F.coalesce(F.sum(F.get(F.col(c), F.lit(i))), F.lit(0)) for i in range(n)])
    longest = max(map(len, COMMON.values()))
    return counted.groupBy("lang").agg(
        sums("classes", len(CLASSES)).alias("ref_classes"), sums("common", longest).alias("ref_common"),
        F.sum("word_chars").alias("ref_chars"), F.sum("n_words").alias("ref_words"),
    )


def js_distance(counts: Column, total: Column, ref: Column, ref_total: Column) -> Column:
    """Jensen-Shannon distance of two histograms, each completed by what its counts leave of its total."""
    summed = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda acc, x: acc + x)
    p = F.concat(counts, F.array(total - summed(counts)))
    q = F.concat(F.slice(ref, F.lit(1), F.size(counts)), F.array(ref_total - summed(F.slice(ref, F.lit(1), F.size(counts)))))
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda x, y: F.struct((x / total).alias("x"), (y / ref_total).alias("y")))
    js = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + part(t["x"], (t["x"] + t["y"]) / 2) + part(t["y"], (t["x"] + t["y"]) / 2))
    return F.sqrt(F.greatest(js / 2, F.lit(0.0)))


def measure(counted: DataFrame, ref: DataFrame) -> DataFrame:
    """Counted documents with ``class_distance`` and ``word_distance`` from their language's reference, NULL where not judged."""
    ref = ref.withColumnRenamed("lang", "ref_lang")
    joined = counted.join(ref, counted["lang"].eqNullSafe(ref["ref_lang"]), "left")
    return joined.withColumns({
        "class_distance": F.when((F.col("word_chars") >= LEAST_CHARS) & (F.col("ref_chars") > 0), js_distance(
            F.col("classes"), F.col("word_chars"), F.col("ref_classes"), F.col("ref_chars"))),
        "word_distance": F.when(F.col("common").isNotNull() & (F.col("n_words") >= LEAST_COMMON) & (F.col("ref_words") > 0), js_distance(
            F.col("common"), F.col("n_words"), F.col("ref_common"), F.col("ref_words"))),
    }).select(*counted.columns, "class_distance", "word_distance")


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: the counts, ``base_failed``, both distances (NULL where not judged) and ``kept``."""
    counted = stage(
        count_rules(docs).withColumn(
            "base_failed",
            (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")),
        ),
        "counted",
    )
    first = measure(counted, stage(references(counted.filter(~F.col("base_failed"))), "references"))
    # Odd documents leave the reference: it is summed again over the half of each language that lies nearest to the first one.
    limits = first.filter("not base_failed").groupBy("lang").agg(F.percentile_approx("class_distance", 0.5, 1000).alias("limit"))
    near = first.join(stage(limits.withColumnRenamed("lang", "near_lang"), "limits"), F.col("lang").eqNullSafe(F.col("near_lang")))
    near = near.filter(~F.col("base_failed") & (F.coalesce("class_distance", F.lit(2.0)) <= F.coalesce("limit", F.lit(2.0))))
    distances = measure(counted, stage(references(near), "references"))
    fits = (F.coalesce("class_distance", F.lit(0.0)) <= MOST_CLASSES) & (F.coalesce("word_distance", F.lit(0.0)) <= MOST_WORDS)
    return distances.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & fits).alias("kept"), "class_distance", "word_distance",
    )
