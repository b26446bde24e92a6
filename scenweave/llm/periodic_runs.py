"""Periodic runs of words, found by an enhanced suffix array of each text.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends, here one of at least ``LEAST`` words and
``TIMES`` periods. The work on one text, done for a slice of texts at a time (a few MB), is:

1. Words become numbers of their text, so that no suffix ever equals one of another text; each text ends in a number of its own.
   The suffix array comes by doubling: the ranks of all pieces of 1, 2, 4, ... words, only repeated pieces being sorted further.
2. The ranks of all lengths give the common prefix of neighbours in the array (LCP), from the longest length down.
3. A place of the LCP array with value ``d`` joins what lies left and right of it, up to smaller values: the LCP intervals, without
   nodes of a tree. The suffixes ``i`` of the smaller side ask whether those at ``i + d`` and ``i - d`` have their rank on the other
   side (ISA membership). If so, both share exactly ``d`` words: a square of period ``d`` that cannot move on to the right.
4. Such a square is rotated to the left as far as the words agree, again by the ranks of all lengths. Each run is found by its last
   square, once for each multiple of its period that fits twice; of equal stretches the smallest period stays.

A suffix lies on a smaller side at most log(n) times, so a text of n words takes n log(n) steps. Memory is about 4 bytes a word and
doubling, plus 100: texts share nothing, so one text (or a few MB of short ones) bounds a task, whatever the number of rows.

Null handling: NULL texts, and texts without words, have no runs and an empty remainder. Rows are judged each on its own: NULL or
repeated ids do not matter. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, slices, word_count

LEAST, TIMES = 6, 4
SLICE_BYTES = 2_000_000
#: Suffixes asked at a time.
TOGETHER = 2_000_000

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def ranks_by_doubling(symbols: np.ndarray) -> list[np.ndarray]:
    """For lengths 1, 2, 4, ... the rank of the piece that begins at each place; equal pieces have equal ranks, the last ranks are
    those of the suffixes. The array must end in a number of its own, and so must each part whose pieces are not to run on."""
    order = np.argsort(symbols, kind="stable")
    new = np.concatenate([[True], symbols[order][1:] != symbols[order][:-1]])
    rank = np.empty(len(symbols), dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(symbols)), 0))
    levels, step = [rank], 1
    # Only pieces that occur again are sorted further; they end before the number that closes their part.
    alone = new & np.concatenate([new[1:], [True]])
    open_ = order[~alone]
    while len(open_):
        key = rank[open_].astype(np.int64) * len(symbols) + rank[open_ + step]
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        old = rank[open_]
        first = np.concatenate([[True], old[1:] != old[:-1]])
        new = np.concatenate([[True], key[1:] != key[:-1]])
        places = np.arange(len(open_))
        rank = rank.copy()
        rank[open_] = old + np.maximum.accumulate(np.where(new, places, 0)) - np.maximum.accumulate(np.where(first, places, 0))
        levels.append(rank)
        open_ = open_[~(new & np.concatenate([new[1:], [True]]))]
        step *= 2
    return levels


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of symbols that the suffixes at ``a`` and ``b`` share."""
    shared = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        shared += (levels[k][a + shared] == levels[k][b + shared]).astype(np.int64) << k
    return shared


def common_before(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of symbols that agree before ``a`` and ``b``, backwards."""
    shared = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        left, right = a - shared - (1 << k), b - shared - (1 << k)
        fits = (left >= 0) & (right >= 0)
        shared += (fits & (levels[k][np.maximum(left, 0)] == levels[k][np.maximum(right, 0)])).astype(np.int64) << k
    return shared


def bounds(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For places ``at`` the last one to the left with a smaller value, and the first to the right with a value no larger.

    ``lcp`` begins and ends with a value below all others. Each place jumps over what is known not to stop it.
    """
    found = []
    for step, stops in ((-1, np.less), (1, np.less_equal)):
        near = np.arange(len(lcp)) + step
        near[[0, -1]] = 0, len(lcp) - 1
        open_ = at
        while len(open_):
            open_ = open_[~stops(lcp[near[open_]], lcp[open_])]
            near[open_] = near[near[open_]]
        found.append(near[at])
    return found[0], found[1]


def last_squares(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares whose halves stop agreeing right behind them."""
    isa = levels[-1].astype(np.int64)
    n = len(isa)
    sa = np.empty(n, dtype=np.int64)
    sa[isa] = np.arange(n)
    lcp = np.zeros(n + 1, dtype=np.int64)
    lcp[[0, n]] = -1
    near = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    lcp[near] = common_prefix(levels, sa[near - 1], sa[near])
    left, right = bounds(lcp, near)
    depth, below, above = lcp[near], near - left, right - near
    small, begin = np.minimum(below, above), np.where(below <= above, left, near)
    starts, periods = [], []
    ends = np.cumsum(small)
    low = 0
    while low < len(near):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + TOGETHER, "right")))
        node = np.repeat(np.arange(low, high), small[low:high])
        i = sa[np.arange(len(node)) - np.repeat(np.cumsum(small[low:high]) - small[low:high], small[low:high]) + begin[node]]
        d = depth[node]
        # The other side of the place in the array.
        from_, to = np.where(below <= above, near, left)[node], np.where(below <= above, right, near)[node]
        for j, first in ((i + d, i), (i - d, i - d)):
            inside = (j >= 0) & (j < n)
            rank = isa[np.where(inside, j, 0)]
            hit = inside & (rank >= from_) & (rank < to)
            starts.append(first[hit])
            periods.append(d[hit])
        low = high
    return np.concatenate([[], *starts]).astype(np.int64), np.concatenate([[], *periods]).astype(np.int64)


def runs_of(symbols: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, smallest period) of all runs of at least ``least`` symbols and ``times`` (2 or more) periods, in order."""
    levels = ranks_by_doubling(symbols)
    start, period = last_squares(levels)
    end = start + 2 * period
    start = start - common_before(levels, start, start + period)
    kept = end - start >= np.maximum(least, times * period)
    start, end, period = start[kept], end[kept], period[kept]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    by = np.lexsort((period, start))
    return start[by], (end - start)[by], period[by]


def _slice(texts: list[str | None], least: int, times: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(runs, number of words, words without repeated periods) of each text."""
    find = re.compile(WORD).findall
    lists = [find(t) if t else [] for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    words = np.empty(int(counts.sum()), dtype=object)
    words[:] = [w for words_ in lists for w in words_]
    codes, names = pd.factorize(words)
    owner = np.repeat(np.arange(len(lists)), counts)
    first = np.cumsum(counts + 1) - (counts + 1)
    symbols = np.empty(len(words) + len(lists), dtype=np.int64)
    place = np.arange(len(words)) + owner
    # The text in the high part; the number that ends a text is the largest of it.
    symbols[place] = owner * (len(names) + 1) + codes
    symbols[first + counts] = np.arange(len(lists)) * (len(names) + 1) + len(names)
    start, length, period = runs_of(symbols, least, times) if len(lists) else (np.zeros(0, np.int64),) * 3
    text = np.searchsorted(first, start, "right") - 1
    change = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    dropped = np.cumsum(change)[:-1] > 0
    kept = []
    for t, (words_, a) in enumerate(zip(lists, first.tolist(), strict=True)):
        out = dropped[a : a + len(words_)]
        kept.append(" ".join(words_ if not out.any() else [w for w, x in zip(words_, out.tolist(), strict=True) if not x]))
    offsets = np.searchsorted(text, np.arange(len(lists) + 1))
    values = pa.StructArray.from_arrays([pa.array(start - first[text]), pa.array(length), pa.array(period)], fields=list(_RUN))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), pa.array(counts), pa.array(kept, pa.string())


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per document: ``doc_id, n_words, runs`` (by start, then period; words numbered from 0) and ``collapsed``, the words that no
    run repeats after its first period, joined by one space."""
    id_type = docs.schema["doc_id"].dataType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, n in slices(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(), slice_bytes):
                runs, counts, kept = _slice(batch.column(1).slice(low, n).to_pylist(), least, times)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, n), counts, runs, kept], names=["doc_id", "n_words", "runs", "collapsed"]
                )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        search, f"doc_id {id_type.simpleString()}, n_words long, runs {RUNS}, collapsed string"
    )


def longest(runs: Column) -> Column:
    """The run of greatest length, of equal ones that with the smallest start, then period; NULL without runs."""
    key = lambda r: F.struct(-r["length"], r["start"], r["period"])
    best = F.array_min(F.transform(runs, key))
    return F.when(F.size(runs) > 0, F.struct(best["start"].alias("start"), (-best["col1"]).alias("length"), best["period"].alias("period")))


def with_period(text: Column, key: Column) -> Column:
    """The words of a text, joined by one space; a tenth of the texts, by the checksum of ``key``, repeat one period from a word on.

    With ``h`` the checksum and ``g = h / 10``: if ``h % 10 = 0``, each word ``i >= a`` becomes word ``a + (i - a) % p``, where
    ``a = g % n`` and ``p = 1 + (n - a) / (3 + g % 8)``. All other texts, and those without words or key, stay as they are.
    """
    h, n = F.crc32(key.cast("string").cast("binary")), F.greatest(word_count(text), F.lit(1))
    g = F.floor(h / 10)
    a = g % n
    plan = F.struct(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"), a.alias("a"), (F.floor((n - a) / (g % 8 + 3)) + 1).alias("p")
    )

    def word(s: Column, i: Column) -> Column:
        return F.get(s["words"], F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int"))

    # The plan is bound to a variable, so that it is made once a text and not once a word.
    made = F.transform(F.array(plan), lambda s: F.array_join(
        F.transform(F.sequence(F.lit(0).cast("long"), F.size(s["words"]).cast("long") - 1), lambda i: word(s, i)), " "))
    return F.when((h % 10 == 0) & F.coalesce(text.rlike(WORD), F.lit(False)), F.get(made, 0)).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """What ``find_runs`` returns in columns of fixed size: number of runs, the longest one, and digests of the rest."""
    top = longest(F.col("runs"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"),
        F.col("top.period").alias("period"), F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
