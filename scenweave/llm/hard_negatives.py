"""Hard negatives from blocks of vectors along a Hilbert curve, chosen by zone maps.

1. Components become whole numbers, ``floor(scale * x)``. The dimensions of greatest variance (``CURVE_DIMS``, by sums over all rows)
   give each vector its place on a Hilbert curve. Rows are sorted by (length of the vector, label, place) and written as Parquet, one
   record per block of about ``BLOCK_BYTES``: ids, labels and components of consecutive rows, and the block's zone map, that is
   the least and greatest value of each component and of the label. Copies of one vector spread over as many blocks as they need.
2. Anchors are packed into tiles in the same order. Within its own block an anchor finds a first bound for its positives.
3. A search gives each anchor windows of scores and looks for the best rows within. Interval arithmetic on a zone map bounds the
   scores of a block: ``sum(max(a * low, a * high))`` from above. A block is read for an anchor only if its labels fit and
   its bounds meet a window. Tiles meet zone maps in chunks of ``ZONES``, then the anchors' vectors travel to the blocks that
   they must read, so that a block is shuffled once, however many anchors read it.
4. Three searches follow each other: positives (the window is open above); one promising block per anchor and chunk, which narrows
   the windows from below to the tenth score found; and all other blocks that still meet a window. All results are exact: a
   block left out holds no row that could be among the first.

A task holds some blocks and tiles at a time, whatever the number of rows, labels or equal vectors. Vectors without clusters leave
zone maps little to tell apart: then each anchor reads all blocks, in blocks, as a brute-force search would.

Null handling: rows with a NULL label, a NULL vector or NULL or non-finite components take no part. Only vectors of one length have an
inner product, so each length is searched on its own; vectors without components score 0. A row without id is no anchor; it is a
candidate, and comes last among ties. Rows that share an anchor's id are that anchor, not other rows of it; otherwise repeated rows are
candidates each. Repeated anchors give their rows once each. Scores are exact up to 2^53, beyond it as near as double precision is,
within the range of ``long``. Other columns are ignored. With ties the smaller id comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import parts_for, stage

CURVE_DIMS, CURVE_BITS = 12, 5
BLOCK_BYTES = 1 << 20
TILE, ZONES = 256, 512
#: Blocks of a partition while they are written, of 4096 rows of 64 components.
BLOCKS_EACH = 16

ROWS = "dim int, n int, ids binary, no_id binary, labels binary, vectors binary"
BLOCKS = f"block long, {ROWS}, low binary, high binary, label_low long, label_high long"
TILES = "tile long, dim int, n int, keys binary, ids binary, labels binary, vectors binary, windows binary"
NEEDS = "block long, dim int, n int, keys binary, ids binary, labels binary, vectors binary, windows binary"
HITS = "key long, slot int, score long, vec_id long"
LONG_MOST = float(2**63 - 1024)
#: Components are cut to this, far beyond what can be told apart in an inner product.
MOST = 1e150
#: A block's number holds its partition above so many bits, a row's key its block above as many.
BITS = 20


def usable(vector: Column) -> Column:
    """Whether all components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates below ``2 ** bits``.

    From the highest bit down, each coordinate's bit tells how the lower bits of the cube below are mirrored (all bits of the first
    coordinate inverted) or turned (exchanged with the first's); the Gray code of what remains is the place.
    """
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for b in range(bits - 1, 0, -1):
        under = (1 << b) - 1
        for i in range(dims):
            on = (x[:, i] >> b) & 1 == 1
            other = (x[:, 0] ^ x[:, i]) & under
            x[:, 0] ^= np.where(on, under, other)
            x[:, i] ^= np.where(on, 0, other)
    place, parity = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            parity ^= (x[:, i] >> b) & 1
            place = (place << 1) | parity
    return place


def _matrix(raw: bytes, n: int, dim: int) -> np.ndarray:
    """Components of a block: 32-bit numbers where these are exact, else 64-bit ones."""
    kind = np.float64 if n * dim and len(raw) == 8 * n * dim else np.float32
    return np.frombuffer(raw, kind).reshape(n, dim).astype(np.float64)


def _bytes(x: np.ndarray) -> bytes:
    return x.astype(np.float32 if not x.size or np.abs(x).max() <= 1 << 24 else np.float64).tobytes()


def _record(rows: dict[str, list], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(rows[n], kinds[k]) for n, k in fields], names=[n for n, _ in fields])


def _table(schema: str) -> dict[str, list]:
    return {f.split()[0]: [] for f in schema.split(", ")}


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as doubles within the range of ``long``."""
    return np.clip(a @ b.T, -LONG_MOST, LONG_MOST)


def _of_length(column: pa.Array, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their components as whole numbers) of the vectors of each length."""
    lengths, first = pc.list_value_length(column).to_numpy(), np.zeros(len(column), dtype=np.int64)
    first[1:] = np.cumsum(lengths)[:-1]
    with np.errstate(over="ignore"):
        values = np.floor(np.clip(scale * column.flatten().to_numpy(), -MOST, MOST))
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        yield dim, rows, values[first[rows, None] + np.arange(dim)]


def _spread(vectors: DataFrame, scale: int) -> tuple[int, dict[int, list[tuple[int, float, float]]]]:
    """Number of rows, and per length the dimensions of greatest variance with mean and standard deviation."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for dim, rows, x in _of_length(batch.column(0), scale):
                kept = total.setdefault(dim, [0, np.zeros(dim), np.zeros(dim)])
                kept[0] += len(rows)
                kept[1] += x.sum(axis=0)
                kept[2] += (x * x).sum(axis=0)
        for dim, (n, s, q) in total.items():
            columns = np.full(dim + 1, dim, np.int32), np.arange(-1, dim, dtype=np.int32), np.full(dim + 1, n), np.append(0, s), np.append(0, q)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["dim", "at", "n", "s", "q"])

    found = vectors.select("x").mapInArrow(sums, "dim int, at int, n long, s double, q double")
    found = found.groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    mean = F.col("s") / F.col("n")
    var = F.greatest(F.col("q") / F.col("n") - mean * mean, F.lit(0.0))
    found = found.select("dim", "at", "n", mean.alias("mean"), F.sqrt(var).alias("sd"))
    order = W.partitionBy("dim").orderBy(F.desc("sd"), "at")
    rows = found.withColumn("r", F.row_number().over(order)).filter((F.col("r") <= CURVE_DIMS) | (F.col("at") < 0)).orderBy("dim", "r").collect()
    spread: dict[int, list[tuple[int, float, float]]] = {}
    for r in rows:
        if r["at"] >= 0:
            spread.setdefault(r["dim"], []).append((r["at"], r["mean"], r["sd"]))
    return sum(r["n"] for r in rows if r["at"] < 0), spread


def _placed(vectors: DataFrame, spread: dict[int, list[tuple[int, float, float]]], scale: int) -> DataFrame:
    """Rows with whole components and their place on the curve of their length."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, x in _of_length(batch.column(2), scale):
                at = np.zeros(len(rows), dtype=np.int64)
                if chosen := spread.get(dim):
                    dims, mean, sd = zip(*chosen, strict=True)
                    steps = np.clip((x[:, list(dims)] - np.array(mean)) / np.maximum(sd, 1e-9), -2, 2)
                    at = hilbert(np.minimum((steps + 2) / 4 * (1 << CURVE_BITS), (1 << CURVE_BITS) - 1), CURVE_BITS)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * dim, pa.int32()), pa.array(x.ravel()))
                some = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), vectors, pa.array(np.full(len(rows), dim, np.int32)), pa.array(at)],
                    names=["vec_id", "label", "x", "dim", "at"],
                )

    return vectors.select("vec_id", "label", "x").mapInArrow(place, "vec_id long, label long, x array<double>, dim int, at long")


def _blocks(placed: DataFrame, rows: int, block_bytes: int) -> DataFrame:
    """One record per block of consecutive rows of one length."""

    def block(parts: list[pa.RecordBatch], number: int, dim: int) -> pa.RecordBatch:
        part = pa.Table.from_batches(parts).combine_chunks()
        ids, labels = part["vec_id"].combine_chunks(), part["label"].to_numpy()
        x = part["x"].combine_chunks().flatten().to_numpy().reshape(len(labels), dim)
        return _record({
            "block": [number], "dim": [dim], "n": [len(labels)], "ids": [pc.fill_null(ids, 0).to_numpy().tobytes()],
            "no_id": [np.asarray(ids.is_null()).tobytes()], "labels": [labels.tobytes()], "vectors": [_bytes(x)],
            "low": [x.min(axis=0).tobytes()], "high": [x.max(axis=0).tobytes()],
            "label_low": [labels.min()], "label_high": [labels.max()],
        }, BLOCKS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, kept, count, dim = TaskContext.get().partitionId() << BITS, [], 0, 0
        for batch in batches:
            dims, low = batch.column(3).to_numpy(), 0
            while low < len(dims):
                if count and dim != dims[low]:
                    yield block(kept, number, dim)
                    number, kept, count = number + 1, [], 0
                dim = int(dims[low])
                size = max(64, block_bytes // (4 * max(1, dim)))
                n = min(size - count, int(np.searchsorted(dims, dim, "right")) - low)
                kept.append(batch.slice(low, n))
                low, count = low + n, count + n
                if count == size:
                    yield block(kept, number, dim)
                    number, kept, count = number + 1, [], 0
        if count:
            yield block(kept, number, dim)

    keys = ["dim", "label", "at", "vec_id", "nth"]
    # Rows alike in all else are told apart by their place in the input.
    dealt = placed.withColumn("nth", F.monotonically_increasing_id() % 1024)
    dealt = dealt.repartitionByRange(parts_for(rows, BLOCKS_EACH * 4096), *keys).sortWithinPartitions(*keys)
    return dealt.select("vec_id", "label", "x", "dim").mapInArrow(pack, BLOCKS)


def _tiles(blocks: DataFrame, every: int, k: int, each: int) -> DataFrame:
    """Anchors in tiles, each with one window: from the ``k``-th score of its label in its own block, open above."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << BITS, 0
        kept: list[tuple] = []
        rows = 0

        def tile() -> pa.RecordBatch:
            keys, ids, labels, x, windows = (np.concatenate(part) for part in zip(*kept, strict=True))
            return _record({
                "tile": [base + number], "dim": [x.shape[1]], "n": [len(ids)], "keys": [keys.tobytes()], "ids": [ids.tobytes()],
                "labels": [labels.tobytes()], "vectors": [_bytes(x)], "windows": [windows.tobytes()],
            }, TILES)

        for batch in batches:
            for r in batch.to_pylist():
                ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                at = np.flatnonzero((ids % every == 0) & ~np.frombuffer(r["no_id"], bool))
                if kept and (kept[0][3].shape[1] != r["dim"] or rows + len(at) > each):
                    yield tile()
                    number, rows, kept = number + 1, 0, []
                x = _matrix(r["vectors"], r["n"], r["dim"])
                for low in range(0, len(at), each):
                    some = at[low : low + each]
                    score = _scores(x[some], x)
                    score[(labels[some, None] != labels) | ((ids[some, None] == ids) & ~np.frombuffer(r["no_id"], bool))] = -np.inf
                    windows = np.full((len(some), 1, 2), np.inf)
                    windows[:, 0, 0] = np.partition(score, r["n"] - k, axis=1)[:, r["n"] - k] if r["n"] >= k else -np.inf
                    kept.append(((r["block"] << BITS) + some, ids[some], labels[some], x[some], windows))
                    rows += len(some)
                    if len(at) > each:
                        yield tile()
                        number, rows, kept = number + 1, 0, []
        if kept and rows:
            yield tile()

    wide = blocks.select("block", "dim", "n", "ids", "no_id", "labels", "vectors")
    return wide.mapInArrow(gather, TILES).filter("n > 0")


def _needs(tiles: DataFrame, zones: DataFrame, same: bool, promising: bool) -> DataFrame:
    """The anchors that must read a block: those whose windows its bounds meet. With ``promising`` only one block per anchor and
    chunk of zones is taken, that with the greatest upper bound."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n, dim = r["n"], r["dim"]
                labels, windows = np.frombuffer(r["labels"], np.int64), np.frombuffer(r["windows"]).reshape(n, -1, 2)
                a = _matrix(r["vectors"], n, dim)
                low = np.frombuffer(b"".join(r["lows"])).reshape(-1, dim) if dim else np.zeros((len(r["blocks"]), 0))
                high = np.frombuffer(b"".join(r["highs"])).reshape(-1, dim) if dim else low
                up, down = np.maximum(a, 0), np.minimum(a, 0)
                # Sums of whole numbers are exact; beyond 2^53 some room is left for rounding.
                most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
                room = np.where(np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T < 2.0**52, 0, np.inf)
                most, least = most + room, least - room
                first, last = np.array(r["label_lows"]), np.array(r["label_highs"])
                mine = labels[:, None]
                wanted = (first <= mine) & (mine <= last) if same else (first != mine) | (last != mine)
                meets = np.zeros(wanted.shape, dtype=bool)
                for w in range(windows.shape[1]):
                    from_, to = windows[:, w, 0, None], windows[:, w, 1, None]
                    meets |= (most >= from_) & (least <= to) & (from_ <= to)
                wanted &= meets
                if promising:
                    best = np.where(wanted, most, -np.inf).argmax(axis=1)
                    wanted &= best[:, None] == np.arange(wanted.shape[1])
                keys, ids = np.frombuffer(r["keys"], np.int64), np.frombuffer(r["ids"], np.int64)
                rows = _table(NEEDS)
                for b in np.flatnonzero(wanted.any(axis=0)):
                    at = np.flatnonzero(wanted[:, b])
                    for name, value in (
                        ("block", r["blocks"][b]), ("dim", dim), ("n", len(at)), ("keys", keys[at].tobytes()), ("ids", ids[at].tobytes()),
                        ("labels", labels[at].tobytes()), ("vectors", _bytes(a[at])), ("windows", windows[at].tobytes()),
                    ):
                        rows[name].append(value)
                    if len(rows["block"]) == 64:
                        yield _record(rows, NEEDS)
                        rows = _table(NEEDS)
                if rows["block"]:
                    yield _record(rows, NEEDS)

    chunks = zones.groupBy("dim").agg(F.min("chunk").alias("first"), F.max("chunk").alias("last"))
    spread = tiles.join(chunks, "dim").withColumn("chunk", F.explode(F.sequence("first", "last")))
    return spread.join(zones, ["dim", "chunk"]).select(
        "dim", "n", "keys", "ids", "labels", "vectors", "windows", "blocks", "lows", "highs", "label_lows", "label_highs"
    ).mapInArrow(bound, NEEDS)


def _read(needs: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """The first ``k`` rows of each window in each block read."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, no_id = np.frombuffer(r["c_ids"], np.int64), np.frombuffer(r["c_no_id"], bool)
                labels, x = np.frombuffer(r["c_labels"], np.int64), _matrix(r["c_vectors"], r["c_n"], r["dim"])
                n = r["n"]
                keys, own = np.frombuffer(r["keys"], np.int64), np.frombuffer(r["ids"], np.int64)
                mine, windows = np.frombuffer(r["labels"], np.int64), np.frombuffer(r["windows"]).reshape(n, -1, 2)
                all_ = _scores(_matrix(r["vectors"], n, r["dim"]), x)
                rows: list[list] = [[], [], [], []]
                for i in range(n):
                    fits = ((labels == mine[i]) if same else (labels != mine[i])) & (no_id | (ids != own[i]))
                    for w in range(windows.shape[1]):
                        at = np.flatnonzero(fits & (all_[i] >= windows[i, w, 0]) & (all_[i] <= windows[i, w, 1]))
                        if len(at) > k:  # those that beat or equal the k-th score
                            s = all_[i, at]
                            at = at[s >= np.partition(s, len(s) - k)[len(s) - k]]
                        at = at[np.lexsort((ids[at], no_id[at], -all_[i, at]))[:k]]
                        rows[0].extend([keys[i]] * len(at))
                        rows[1].extend([w] * len(at))
                        rows[2].extend(int(v) for v in all_[i, at].tolist())
                        rows[3].extend(None if no else v for v, no in zip(ids[at].tolist(), no_id[at].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64())],
                    names=["key", "slot", "score", "vec_id"],
                )

    cells = blocks.select("block", *(F.col(c).alias(f"c_{c}") for c in ("n", "ids", "no_id", "labels", "vectors")))
    hits = needs.join(cells, "block").select(
        "dim", "n", "keys", "ids", "labels", "vectors", "windows", "c_n", "c_ids", "c_no_id", "c_labels", "c_vectors"
    ).mapInArrow(score, HITS)
    order = W.partitionBy("key", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _with_windows(tiles: DataFrame, windows: DataFrame) -> DataFrame:
    """Tiles whose anchors have the windows of a table ``key, slot, low, high`` instead of their own; anchors without any leave."""

    def renew(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                new: dict[int, list] = {}
                for w in r["new"]:
                    new.setdefault(w["key"], []).append((w["slot"], w["low"], w["high"]))
                keys = np.frombuffer(r["keys"], np.int64)
                at = np.array([i for i, key in enumerate(keys.tolist()) if key in new], dtype=np.int64)
                # Anchors with fewer windows than others get empty ones.
                made = np.tile([np.inf, -np.inf], (len(at), max(slot for w in new.values() for slot, _, _ in w) + 1, 1))
                for i, key in enumerate(keys[at].tolist()):
                    for slot, low, high in new[key]:
                        made[i, slot] = low, high
                ids, labels = np.frombuffer(r["ids"], np.int64)[at], np.frombuffer(r["labels"], np.int64)[at]
                yield _record({
                    "tile": [r["tile"]], "dim": [r["dim"]], "n": [len(at)], "keys": [keys[at].tobytes()], "ids": [ids.tobytes()],
                    "labels": [labels.tobytes()], "vectors": [_bytes(_matrix(r["vectors"], r["n"], r["dim"])[at])], "windows": [made.tobytes()],
                }, TILES)

    # A tile has a bounded number of anchors, an anchor as many windows as positives.
    new = windows.groupBy("tile").agg(F.collect_list(F.struct("key", "slot", "low", "high")).alias("new"))
    return tiles.join(new, "tile").mapInArrow(renew, TILES)


def _anchors(tiles: DataFrame) -> DataFrame:
    """``tile, key, anchor_id``, one row per anchor."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, keys, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                keys = np.frombuffer(keys, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), tile)), pa.array(keys), pa.array(np.frombuffer(ids, np.int64))], names=["tile", "key", "anchor_id"]
                )

    return tiles.select("tile", "keys", "ids").mapInArrow(unpack, "tile long, key long, anchor_id long")


def mine(
    vectors: DataFrame, every: int, positives: int, negatives: int, low: tuple[int, int] = (3, 10), high: tuple[int, int] = (9, 10),
    scale: int = 256, block_bytes: int = BLOCK_BYTES, tile: int = TILE, zones: int = ZONES,
) -> DataFrame:
    """For each anchor (``vec_id`` divisible by ``every``) and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels that score at least ``low`` and at most ``high`` (fractions) of the positive.

    ``vectors``: ``vec_id, embedding, label``. Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    clean = vectors.filter(F.col("label").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("x")
    )
    rows, spread = _spread(clean, scale)
    blocks = stage(_blocks(_placed(clean, spread, scale), rows, block_bytes), "blocks")
    # Consecutive partitions of the sorted blocks share a chunk of the zone map.
    numbered = blocks.select("block", "dim", "low", "high", "label_low", "label_high").withColumn(
        "chunk", F.floor(F.shiftright("block", BITS) / max(1, zones // BLOCKS_EACH)))
    maps = stage(numbered.groupBy("dim", "chunk").agg(F.sort_array(F.collect_list(
        F.struct("block", "low", "high", "label_low", "label_high"))).alias("z")).select(
        "dim", "chunk", F.col("z.block").alias("blocks"), F.col("z.low").alias("lows"), F.col("z.high").alias("highs"),
        F.col("z.label_low").alias("label_lows"), F.col("z.label_high").alias("label_highs")), "zones")
    tiles = stage(_tiles(blocks, every, positives, tile), "tiles")
    anchors = _anchors(tiles)
    found = stage(
        _read(_needs(tiles, maps, True, False), blocks, True, positives)
        .join(anchors, "key").select("tile", "key", "anchor_id", (F.col("rank") - 1).alias("slot"), "vec_id", "score"), "positives")
    # The window of a positive, in whole numbers: from the fraction rounded up to the fraction rounded down.
    exact = lambda end, part: F.expr(f"cast({end}(cast(score as decimal(20, 0)) * {part[0]} / {part[1]}) as double)")
    windows = found.select("tile", "key", "slot", exact("ceil", low).alias("low"), exact("floor", high).alias("high"))
    windows = windows.filter(F.col("low") <= F.col("high"))
    open_ = _with_windows(tiles, windows)
    first = _read(_needs(open_, maps, False, True), blocks, False, negatives)
    # Only a window with as many rows as are wanted is narrowed.
    tenth = first.filter(F.col("rank") == negatives).select("key", "slot", F.col("score").cast("double").alias("found"))
    narrow = windows.join(tenth, ["key", "slot"], "left").withColumn("low", F.greatest("low", F.coalesce("found", "low"))).drop("found")
    taken = _read(_needs(_with_windows(tiles, stage(narrow, "windows")), maps, False, False), blocks, False, negatives)
    return taken.withColumnRenamed("score", "negative_score").withColumnRenamed("vec_id", "negative_id").join(
        found.select("key", "slot", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), ["key", "slot"]
    ).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
