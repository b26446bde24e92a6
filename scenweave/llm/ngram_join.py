"""Near-duplicates by an exact Jaccard join on word n-grams: rare-first prefixes, length, positional and suffix filters.

1. Texts become sets of 64-bit shingle hashes, a slice of documents (a few MB of text) at a time. The slice's hashes go to
   counting tasks by hash; one that several documents of the slice share goes once, with its count, so a shingle that a third
   of all documents hold is one entry per slice.
2. Counting tasks return to each slice those hashes that two or more documents hold, with their number. All others can meet no
   partner: they are the rarest, and fill the front of a document's order without ever being posted.
3. In order of rarity, two documents with similarity t share one of their first n - ceil(t n) + 1 shingles. What of
   this prefix is left after the unshared ones is posted; most documents post nothing. Overlaps only involve shared
   shingles, so their list is all that verification needs.
4. Equal sets are one class, and lists with equal members are one list. In each list every class meets the one with least
   that is not shared; links found so give classes of a group one label. Then only classes of different labels that still share a list are
   paired, if what their labels have in common leaves room for a link, so most of the pairs of a group of thousands of near
   copies are never made, and no link between groups is left out. Pairs pass the length and the positional filter, count in
   the list of the rarest shingle that both hold, are made distinct, and are verified once, behind a bound from counts per hash
   range (suffix filter). Sets of one group that are similar to none of it are still paired where these bounds leave room.

Null handling: NULL texts and texts without words have an empty set, link with nothing and are components of their own. Rows
without id get no component. Rows that repeat an id are one document: it has the links of all its texts. Other columns are
ignored. Slices are numbered by partition, so the input should be a table or file scan, whose partitions do not change.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import parts_for, settled, slices, stage

SHINGLE = 5
#: Similarity as a fraction: OVER / UNDER.
OVER, UNDER = 3, 4
SLICE_BYTES = 2_000_000
#: Bytes of text for each counting task, about 1.3 million shingles and 100 MB of its memory; on larger executors more is better, as
#: slices times tasks is the number of rows shuffled.
BYTES_PER_COUNT = 8_000_000
SEVERAL = 0xFFFF
#: Steps to which the part of a set that is not shared is told apart.
FINE = 240

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Inverse of the odd number above modulo 2^64.
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, text it lies in) of texts that begin at ``starts`` in ``data``.

    A word's hash is a difference of running sums of bytes times powers, brought back to power 0.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    space = _SPACE[data]
    first = np.zeros(n + 1, dtype=bool)
    first[starts] = True
    before = np.concatenate([[True], space[:-1]]) | first[:-1]
    after = np.concatenate([space[1:], [True]]) | first[1:]
    begin, end = np.flatnonzero(~space & before), np.flatnonzero(~space & after)
    power = np.full(n, _ODD, dtype=np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((_LOWER[data] + np.uint64(1)) * power, dtype=np.uint64)])
    back = np.full(n, _INVERSE, dtype=np.uint64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    size = (end + 1 - begin).astype(np.uint64)
    return mixed((sums[end + 1] - sums[begin]) * back[begin] + size * np.uint64(0xD6E8FEB86659FD93)), np.searchsorted(starts, begin, "right") - 1


def shingle_sets(words: np.ndarray, bounds: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text; a shorter text is one shingle, one without words none."""
    whole = np.zeros(0, np.uint64)
    if len(words) >= k:
        rolled = words[: len(words) - k + 1].copy()
        for i in range(1, k):
            rolled = rolled * _ODD + words[i : len(words) - k + 1 + i]
        whole = mixed(rolled)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            s = np.sort(whole[a : b - k + 1])
            sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            h = np.uint64(b - a)
            for w in words[a:b]:
                h = mixed(np.array([h * _ODD + w], dtype=np.uint64))[0]
            sets.append(np.array([h], dtype=np.uint64))
        else:
            sets.append(whole[:0])
    return sets


def text_sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """Shingle sets of some texts. A text longer than a slice is hashed piece by piece, cut at white space."""
    offsets = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))]).astype(np.int64)
    data = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), dtype=np.uint8)
    with np.errstate(over="ignore"):
        if len(texts) > 1 or len(data) <= SLICE_BYTES:
            full = np.flatnonzero(np.diff(offsets))  # empty texts have no place in the data
            words, of = word_hashes(data, offsets[full])
            counts = np.bincount(full[of] if len(of) else of, minlength=len(texts))
        else:
            cuts, space = [0], np.flatnonzero(_SPACE[data])
            while len(data) - cuts[-1] > SLICE_BYTES:
                at = np.searchsorted(space, cuts[-1] + SLICE_BYTES)
                if at == len(space):
                    break
                cuts.append(int(space[at]) + 1)
            pieces = [word_hashes(data[a:b], np.zeros(1, np.int64))[0] for a, b in zip(cuts, [*cuts[1:], len(data)])]
            words = np.concatenate(pieces)
            counts = np.array([len(words)])
        return shingle_sets(words, np.concatenate([[0], np.cumsum(counts)]), k)


def packed(hashes: np.ndarray) -> bytes:
    """Sorted hashes in little more than 6 bytes each: their low 48 bits, and the steps of the 16 above in unary."""
    if not len(hashes):
        return b""
    high = (hashes >> np.uint64(48)).astype(np.int64)
    bits = np.zeros(len(hashes) + int(high[-1] - high[0]), np.uint8)
    bits[high - high[0] + np.arange(len(hashes))] = 1
    low = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return high[:1].astype("<u2").tobytes() + low.tobytes() + np.packbits(bits).tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    """The ``n`` hashes that ``packed`` wrote."""
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.zeros((n, 8), np.uint8)
    hashes[:, :6] = np.frombuffer(data, np.uint8, 6 * n, 2).reshape(n, 6)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, -1, 2 + 6 * n))) - np.arange(n) + np.frombuffer(data, "<u2", 1)[0]
    hashes[:, 6:] = high.astype("<u2").view(np.uint8).reshape(n, 2)
    return hashes.view("<u8").ravel()


TO_COUNT = "bucket int, batch long, hashes binary, places binary, counts binary, docs binary"
FROM_COUNT = "batch long, hashes binary, places binary, counts binary, docs binary"
SETS = "doc_id long, n_shingles long, digest binary, shared binary, counts binary"
LISTS = "node long, n long, s long, prefix array<long>, shared binary"


def _send(n_buckets: int):
    """A slice's rows for the counting tasks, and one row with its documents, which passes through them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            sizes = pc.binary_length(texts).to_numpy()
            for low, n in slices(np.maximum(sizes, SLICE_BYTES // (SEVERAL - 1) + 1), SLICE_BYTES):
                sets = text_sets(texts.slice(low, n))
                lengths = np.array([len(s) for s in sets], dtype=np.int64)
                hashes = np.concatenate(sets)
                place = np.repeat(np.arange(n, dtype=np.uint16), lengths)
                order = np.argsort(hashes, kind="stable")
                hashes, place = hashes[order], place[order]
                head = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
                count = np.diff(np.append(head, len(hashes)))
                many = np.repeat(count > 1, count)
                ids = batch.column(0).slice(low, n)
                docs = b"".join([
                    np.array([n, many.sum()], "<i8").tobytes(), pc.fill_null(ids, 0).to_numpy().astype("<i8").tobytes(),
                    ids.is_valid().to_numpy(zero_copy_only=False).astype("u1").tobytes(), lengths.astype("<i8").tobytes(),
                    *[hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                    place[many].astype("<u2").tobytes(), packed(hashes[many]),
                ])
                rows = [(number % n_buckets, number, None, None, None, docs)]
                # Tasks count ranges of hashes, so what a task gets of a slice is one sorted piece.
                hashes, place = hashes[head], np.where(count > 1, SEVERAL, place[head]).astype("<u2")
                cuts = np.searchsorted((hashes >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32), np.arange(n_buckets + 1, dtype=np.uint64))
                for b in np.flatnonzero(np.diff(cuts)).tolist():
                    of = slice(cuts[b], cuts[b + 1])
                    several = count[of][count[of] > 1].astype("<u4")
                    rows.append((b, number, packed(hashes[of]), place[of].tobytes(), several.tobytes(), None))
                number += 1
                yield _batch(rows, TO_COUNT)

    return send


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields]
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes that two or more documents hold, with that number, back to the slices they came from."""
    number, hashes, places, counts = [], [], [], []
    for batch in batches:
        for _, slice_, h, p, c, docs in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if docs is not None:
                yield _batch([(slice_, None, None, None, docs)], FROM_COUNT)
                continue
            p = np.frombuffer(p, "<u2")
            several = np.ones(len(p), "<u4")
            several[p == SEVERAL] = np.frombuffer(c, "<u4")
            number.append((slice_, len(p)))
            hashes.append(unpacked(h, len(p)))
            places.append(p)
            counts.append(several)
    if not hashes:
        return
    h, p, c = np.concatenate(hashes), np.concatenate(places), np.concatenate(counts)
    del hashes, places, counts
    order = np.argsort(h, kind="stable")
    s = h[order]
    head = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    total = np.add.reduceat(c[order].astype(np.int64), head)
    every = np.empty(len(h), np.int64)
    every[order] = np.repeat(total, np.diff(np.append(head, len(h))))
    at, rows = 0, []
    for slice_, n in number:
        keep = np.flatnonzero(every[at : at + n] > 1) + at
        at += n
        if len(keep):
            rows.append((slice_, packed(h[keep]), p[keep].tobytes(), every[keep].astype("<u4").tobytes(), None))
        if len(rows) >= 256:
            yield _batch(rows, FROM_COUNT)
            rows = []
    if rows:
        yield _batch(rows, FROM_COUNT)


def posted(size: int, shared: int) -> int:
    """How many shared shingles the prefix of a set holds behind those that are its own."""
    return size - -(-OVER * size // UNDER) + 1 - (size - shared)


def _rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes with the shingles that other classes hold too (counted more often than the class has copies), rarest first."""
    for batch in batches:
        rows = []
        for node, n, copies, shared, counts in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            h, c = np.frombuffer(shared, "<u8"), np.frombuffer(counts, "<u4")
            h, c = h[c > copies], c[c > copies]
            left = posted(n, len(h))
            if left > 0 and len(h):
                rows.append((node, n, len(h), h[np.lexsort((h, c))[:left]].view(np.int64), h.tobytes()))
        yield _batch(rows, LISTS)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document, with ``shared`` hashes in order and their ``counts`` where something of its prefix is shared."""
    parts: dict[int, list] = {}
    tables: dict[int, bytes] = {}
    for batch in batches:
        for slice_, h, p, c, docs in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if docs is not None:
                tables[slice_] = docs
            else:
                parts.setdefault(slice_, []).append((unpacked(h, len(p) // 2), np.frombuffer(p, "<u2"), np.frombuffer(c, "<u4")))
    for slice_, docs in tables.items():
        n, n_many = np.frombuffer(docs, "<i8", 2).tolist()
        at = 16
        ids = np.frombuffer(docs, "<i8", n, at)
        known = np.frombuffer(docs, "u1", n, at + 8 * n)
        sizes = np.frombuffer(docs, "<i8", n, at + 9 * n)
        at += 17 * n
        digests = [docs[at + 16 * i : at + 16 * i + 16] for i in range(n)]
        at += 16 * n
        many, many_at = unpacked(docs[at + 2 * n_many :], n_many), np.frombuffer(docs, "<u2", n_many, at)
        got = parts.pop(slice_, [])
        h, p, c = (np.concatenate([g[i] for g in got]) if got else np.zeros(0, t) for i, t in enumerate(("<u8", "<u2", "<u4")))
        one = p != SEVERAL
        several = np.argsort(h[~one])
        count_of = c[~one][several][np.searchsorted(h[~one][several], many)] if n_many else np.zeros(0, "<u4")
        h, p, c = np.concatenate([h[one], many]), np.concatenate([p[one], many_at]), np.concatenate([c[one], count_of])
        order = np.argsort(p, kind="stable")
        h, c = h[order], c[order]
        bounds = np.searchsorted(p[order], np.arange(n + 1))
        rows = []
        for i, size in enumerate(sizes.tolist()):
            a, b = bounds[i], bounds[i + 1]
            shared = counts = None
            if size and posted(size, b - a) > 0:
                rare = np.argsort(h[a:b])
                shared, counts = h[a:b][rare].tobytes(), c[a:b][rare].astype("<u4").tobytes()
            rows.append((ids[i] if known[i] else None, size, digests[i], shared, counts))
        yield _batch(rows, SETS)


def shared_shingles(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, digest, shared, counts`` of every document, from one reading of the texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    n = parts_for(size, BYTES_PER_COUNT)
    return (
        docs.select("doc_id", "text").mapInArrow(_send(n), TO_COUNT).repartition(n, "bucket")
        .mapInArrow(_count, FROM_COUNT).repartition(n, "batch").mapInArrow(_prefixes, SETS)
    )


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets are similar, from the lists of shared shingles of both."""
    cuts = (np.arange(1, 16, dtype=np.uint64) << np.uint64(60)).astype(np.uint64)
    for batch in batches:
        a, b, na, nb, sa, sb = (column.to_pylist() for column in batch.columns)
        keep = []
        for i in range(len(a)):
            x, y = np.frombuffer(sa[i], "<u8"), np.frombuffer(sb[i], "<u8")
            ranges = [np.diff(np.concatenate([[0], np.searchsorted(v, cuts), [len(v)]])) for v in (x, y)]
            need = OVER * (na[i] + nb[i])
            if (OVER + UNDER) * int(np.minimum(*ranges).sum()) >= need:
                if (OVER + UNDER) * len(np.intersect1d(x, y, assume_unique=True)) >= need:
                    keep.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, pa.int64()) for v in (
                [a[i] for i in keep], [b[i] for i in keep], [FINE * (8 * na[i] - len(sa[i])) // len(sa[i]) for i in keep])],
            names=["a", "b", "level"],
        )


def _with_lists(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` with sizes and lists of shared shingles. Both lists travel once per pair."""
    side = lambda c: classes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("shared").alias(f"s{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb")


def verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are similar, with the level of ``a``."""
    return _with_lists(pairs, classes).mapInArrow(_overlaps, "a long, b long, level long")


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sa, sb = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
        common = [len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True)) for x, y in zip(sa, sb, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common, pa.int64())], names=["a", "b", "common"])


def overlaps(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b, common``: how many shared shingles both sets of a pair ``a, b`` hold."""
    return _with_lists(pairs, classes).mapInArrow(_common, "a long, b long, common long")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node with a link: large and small stars by turns, until nothing changes.

    Each turn lowers every node's neighbours to the smallest one among them; stars of any size are reduced before they are
    joined, and turns grow with the logarithm of the longest chain.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    state = edges.agg(F.count("*"), F.sum("v"), F.bit_xor(F.xxhash64("u", "v"))).first()
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(stage(least, "least"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.filter("u <> v").distinct(), "large")
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum("v"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def several_texts(sets: DataFrame) -> DataFrame | None:
    """``doc_id, digest, n_shingles`` of ids that repeat with different texts, each text once; None where no id does."""
    of = F.xxhash64("digest", "n_shingles")
    ids = sets.filter("doc_id is not null").groupBy("doc_id").agg(F.min(of).alias("low"), F.max(of).alias("high"))
    ids = stage(ids.filter("low < high").select("doc_id"), "several-texts")
    if ids.isEmpty():
        return None
    return stage(sets.select("doc_id", "digest", "n_shingles").join(ids, "doc_id", "left_semi").distinct(), "their-texts")


def similar(sets: DataFrame, repeated: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(``digest, node, copies``: classes of equal sets by their smallest document; ``node, component`` of linked ones).

    Ids that repeat with different texts (``repeated``) are nodes too, linked to the classes of all their texts.
    """
    classes = stage(
        sets.filter("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(
            F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.count("*").alias("copies"),
            F.first("shared").alias("shared"), F.first("counts").alias("counts"),
        ), "classes")
    listed = stage(classes.filter("shared is not null").select("node", "n", "copies", "shared", "counts").mapInArrow(_rarest, LISTS), "lists")
    posts = stage(listed.select(
        "node", "n", "s", F.floor(FINE * (F.col("n") - F.col("s")) / F.col("s")).alias("level"),
        F.floor(F.log("n") / F.log(F.lit(UNDER / OVER)) + 1e-9).alias("band"), F.posexplode("prefix").alias("k", "hash"),
    ), "posts")
    # Lists with the same members, such as those of all shingles of a passage, give the same pairs: the rarest is kept.
    bits = lambda seed: F.sum(F.xxhash64("node", F.lit(seed)).bitwiseAND((1 << 40) - 1))
    lists = posts.groupBy("hash").agg(
        F.min(F.struct("level", "node", "n", "s", "k")).alias("pivot"), F.count("*").alias("members"), bits(0).alias("x"), bits(1).alias("y"))
    lists = lists.filter("members > 1").groupBy("members", "x", "y").agg(F.min(F.struct("pivot.k", "hash", "pivot")).alias("kept"))
    members = stage(posts.join(lists.select("kept.hash", "kept.pivot"), "hash"), "members")

    long_enough = f"{OVER} * greatest(na, nb) <= {UNDER} * least(na, nb)"
    # All that two sets do not share is apart, and they have no more in common than what either shares with any.
    placed = (
        f"{OVER + UNDER} * (least(ka, kb) + 1 + least(sa - ka - 1, sb - kb - 1)) >= {OVER} * (na + nb) "
        f"and {UNDER - OVER} * least(sa, sb) >= {OVER} * (na - sa + nb - sb)"
    )
    side = lambda df, c: df.withColumnsRenamed({"node": c, "n": f"n{c}", "s": f"s{c}", "k": f"k{c}"})
    of_pivot = [F.col(f"pivot.{x}").alias(y) for x, y in (("node", "a"), ("n", "na"), ("s", "sa"), ("k", "ka"))]
    first = side(members, "b").select(*of_pivot, "b", "nb", "sb", "kb").filter("a <> b").filter(long_enough).filter(placed)
    tried = stage(first.select("a", "b").distinct(), "pivot-pairs")
    found = stage(verified(tried, listed), "links")
    # A label is a node of the same component. Pivots are the classes with least that is not shared, to which all similar
    # ones of a group are similar, and steps towards such classes lead the group to one.
    near = stage(found.groupBy(F.col("b").alias("node")).agg(F.min(F.struct("level", "a"))["a"].alias("label")), "near")
    step = near.select(F.col("node").alias("label"), F.col("label").alias("next"))
    labels = near
    for _ in range(2):
        labels = labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    labels = stage(labels, "labels")
    own = overlaps(labels.select(F.col("node").alias("a"), F.col("label").alias("b")), listed)
    own = stage(own.withColumnsRenamed({"a": "node", "b": "label", "common": "own"}), "own")

    # Lists whose classes have several labels: pairs across labels are left. Of what they share at most s is common and all that
    # they do not share is apart, so their levels (what is not shared over s, in FINE steps) add up to a third.
    known = members.drop("pivot").join(own, "node", "left")
    known = known.withColumns({"label": F.coalesce("label", "node"), "extra": F.coalesce(F.col("s") - F.col("own"), F.lit(0))})
    known = stage(known.drop("own"), "labelled")
    several = known.groupBy("hash").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    mixed_ = stage(known.join(several.select("hash"), "hash", "left_semi"), "mixed-lists")
    # A pair counts in the list of the rarest shingle that both hold only. All that either holds before it is apart, so no more
    # is common than what either has left from there on.
    kinds = mixed_.groupBy("hash", "label", "level", "band").agg(
        F.max("extra").alias("extra"), F.min("n").alias("least"), F.max(F.col("s") - F.col("k")).alias("left"))
    kinds = stage(kinds, "kinds")
    names = ("label", "level", "band")
    renamed = lambda df, c: df.withColumnsRenamed({x: f"{x}_{c}" for x in (*names, "extra", "least", "left")})
    across = renamed(kinds, "a").join(renamed(kinds, "b"), "hash").filter(
        f"label_a < label_b and level_a + level_b <= {FINE // 3} and abs(band_a - band_b) <= 1").filter(
        f"{OVER + UNDER} * least(left_a, left_b) >= {OVER} * (least_a + least_b)").drop("left_a", "left_b")
    # What two sets have in common lies in both labels, or in what one of them shares with any set but not with its own label.
    # So labels are compared once, and a group of copies is not paired with sets that its label is not similar to.
    met = stage(overlaps(across.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct(), listed), "label-pairs")
    met = met.withColumnsRenamed({"a": "label_a", "b": "label_b"})
    enough = f"{OVER + UNDER} * (common + extra_a + extra_b) >= {OVER} * "
    on = lambda c: ["hash", *[f"{x}_{c}" for x in names]]
    rest = across.join(met, ["label_a", "label_b"]).filter(enough + "(least_a + least_b)").drop("extra_a", "extra_b")
    rest = rest.join(renamed(side(mixed_, "a"), "a"), on("a")).join(renamed(side(mixed_, "b"), "b"), on("b"))
    rest = rest.filter(long_enough).filter(placed).filter(f"{OVER + UNDER} * least(sa - ka, sb - kb) >= {OVER} * (na + nb)").filter(enough + "(na + nb)")
    rest = stage(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs").join(
        tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    links = found.unionByName(verified(rest, listed)).select("a", "b")
    if repeated is not None:
        of_id = repeated.filter("n_shingles > 0").join(classes.select("digest", "node"), "digest").filter("node < doc_id")
        links = links.union(of_id.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct())

    # Nodes with one label are one node to the components.
    named = lambda df, c: df.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")), c, "left")
    merged = stage(named(named(links, "a"), "b").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")), "merged")
    groups = components(merged).withColumnRenamed("node", "label")
    itself = lambda df, c: df.select(F.col(c).alias("node"), F.col(c).alias("label"))
    nodes = labels.union(itself(labels, "label")).union(itself(merged, "a")).union(itself(merged, "b")).distinct()
    keyed = stage(nodes.join(groups, "label", "left").select("node", F.coalesce("component", "label").alias("key")), "keyed")
    least = stage(keyed.groupBy("key").agg(F.min("node").alias("component")), "components")
    return classes, keyed.join(least, "key").select("node", "component").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per document, with the smallest document id reachable by links."""
    sets = stage(shared_shingles(docs), "sets")
    repeated = several_texts(sets)
    classes, groups = similar(sets, repeated)
    # A document alone in its class and component is its own component, and needs no join.
    labels = stage(
        classes.select("digest", "node", "copies").join(groups, "node", "left").filter("copies > 1 or component < node")
        .select("digest", F.coalesce("component", "node").alias("component")), "groups")
    found = sets.select("doc_id", "n_shingles", "digest").join(labels, "digest", "left")
    if repeated is not None:  # a row without words has the component of its id's other texts
        other = repeated.filter("n_shingles = 0").select("doc_id").distinct().join(groups, F.col("doc_id") == F.col("node"))
        other = stage(other.select(F.col("doc_id").alias("id"), F.col("component").alias("other")), "without-words")
        bare = found.filter("n_shingles = 0").join(other, F.col("doc_id") == F.col("id"), "left").withColumn("component", F.col("other"))
        found = found.filter("n_shingles > 0").unionByName(bare.select(found.columns))
    else:
        found = found.withColumn("component", F.when(F.col("n_shingles") > 0, F.col("component")))
    return found.select(
        "doc_id", "n_shingles", F.when(F.col("component").isNotNull(), F.least("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are the smallest document of their component. Rows without id stay; of rows that repeat an id one does."""
    kept = settled(docs.sparkSession, lambda: near_duplicates(docs).filter("doc_id = component_id").select("doc_id").distinct(), "kept")
    chosen = docs.join(kept, "doc_id", "left_semi").withColumn(
        "_place", F.row_number().over(W.partitionBy("doc_id").orderBy(F.md5(F.col("text").cast("binary")))))
    return chosen.filter("_place = 1").select(*docs.columns).unionByName(docs.filter("doc_id is null"))
