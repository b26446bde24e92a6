"""Packing by best fit decreasing.

Documents become token ids; overlong ones are cut into full windows first, the rest of each document is packed: pieces are
taken by decreasing length, and a segment tree indexed by remaining capacity finds the tightest open window that still fits.

Pieces are dealt to independent bins of work by a hash of their content's place (document and start), about ``PIECES_EACH``
rests each, so that no task packs more however large the input is; each leaves a few windows with room. The order in which a task
packs is (length descending, document, start, checksum), so a task that runs again packs alike.

Null handling: a NULL text counts as empty and gives the end id alone; a NULL document id is a key of its own. Repeated rows
are packed as often as they come. Other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import once_per_worker, parts_for, slices, stage

WINDOW = 4096
END_ID = 2
PIECES_EACH = 4_000
#: Texts encoded at a time, and what a worker's table of words may hold: some 150 MB of it, whatever the data.
SLICE_BYTES = 4_000_000
MOST_WORDS, MOST_BYTES = 1_000_000, 24_000_000

PIECES = "doc_id long, start long, length long, tokens binary, doc_tokens long"


class WordIds:
    """Ids of texts, word by word: what lies between ASCII white space is encoded once and then looked up.

    The tokenizer drops white space and no rule of it looks across any, so a text's ids are those of its words in order. New
    words are encoded many at a time, a token belonging to the word its place lies in. When the table holds more than ``most``
    words, or ``MOST_BYTES`` of them, its most frequent half stays.
    """

    def __init__(self, path: str, most: int = MOST_WORDS) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.encoder, self.most = Tokenizer.from_file(path), most
        self.empty()

    def forget(self) -> None:
        """Keep the most frequent half of the words, none if these are too long. What was seen long ago counts half."""
        half = min(self.most, len(self.number)) // 2
        kept = np.sort(np.argpartition(-self.seen, half)[:half])
        count = self.count[kept]
        starts = np.cumsum(count) - count
        self.ids = self.ids[np.repeat(self.first[kept] - starts, count) + np.arange(count.sum())]
        self.first, self.count, self.seen = starts.astype(np.int32), count, self.seen[kept] // 2
        new = np.full(len(self.number), -1)
        new[kept] = np.arange(len(kept))
        self.number = {w: i for w, i in zip(self.number, new.tolist(), strict=True) if i >= 0}
        self.bytes = sum(map(len, self.number))
        if self.bytes > MOST_BYTES // 2:
            self.empty()

    def empty(self) -> None:
        self.number: dict[bytes, int] = {}
        self.first, self.count, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, "<u4")
        self.seen, self.bytes = np.zeros(0, np.int32), 0

    def learn(self, words: list[bytes], together: int = 2000) -> None:
        counts, ids = [], []
        for low in range(0, len(words), together):
            some = [w.decode("utf-8", "replace") for w in words[low : low + together]]
            starts = np.cumsum([0, *[len(w) + 1 for w in some[:-1]]])
            coded = self.encoder.encode(" ".join(some), add_special_tokens=False)
            at = np.array(coded.offsets, dtype=np.int64).reshape(-1, 2)[:, 0]
            counts.append(np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(some)))
            ids.append(np.array(coded.ids, dtype="<u4"))
        known, count = len(self.number), np.concatenate(counts)
        self.number.update(zip(words, range(known, known + len(words))))
        self.first = np.concatenate([self.first, (len(self.ids) + np.cumsum(count) - count).astype(np.int32)])
        self.count, self.ids = np.concatenate([self.count, count.astype(np.int32)]), np.concatenate([self.ids, *ids])
        self.seen, self.bytes = np.concatenate([self.seen, np.zeros(len(words), np.int32)]), self.bytes + sum(map(len, words))

    def __call__(self, texts: pa.Array, end_id: int) -> list[np.ndarray]:
        """Ids of each text, followed by ``end_id``."""
        split = pc.ascii_split_whitespace(texts)
        words = pc.dictionary_encode(split.flatten())
        bytes_ = words.dictionary.cast(pa.binary()).to_pylist()
        new = [w for w in bytes_ if w not in self.number]
        if new:
            self.learn(new)
        indices = words.indices.to_numpy()
        of_words = np.fromiter(map(self.number.__getitem__, bytes_), np.int64, len(bytes_))
        self.seen[of_words] += np.bincount(indices, minlength=len(bytes_)).astype(np.int32)
        numbers = of_words[indices]
        count = self.count[numbers]
        ends = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        flat = self.ids[np.repeat(self.first[numbers] - ends[:-1], count) + np.arange(ends[-1])]
        bounds = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])]
        if len(self.number) > self.most or self.bytes > MOST_BYTES:
            self.forget()
        end = np.array([end_id], dtype="<u4")
        return [np.concatenate([flat[a:b], end]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def token_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, most_words: int = MOST_WORDS) -> DataFrame:
    """Each document's ids (little-endian unsigned 32-bit, the end id last) in one pass, cut into full windows and a rest.

    ``most_words`` bounds the table of words of a worker: a smaller one takes less memory and more time.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = once_per_worker(f"{most_words} word ids of {tokenizer}", lambda: WordIds(tokenizer, most_words))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for low, n in slices(pc.binary_length(texts).to_numpy(), SLICE_BYTES):
                rows: list[list] = [[], [], [], [], []]
                for doc, ids in zip(batch.column(0).slice(low, n).to_pylist(), coder(texts.slice(low, n), end_id), strict=True):
                    for start in range(0, len(ids), window):
                        part = ids[start : start + window]
                        for to, value in zip(rows, (doc, start, len(part), part.tobytes(), len(ids)), strict=True):
                            to.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r, k) for r, k in zip(rows, kinds)], names=[c.split()[0] for c in PIECES.split(", ")]
                )

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset in it) of pieces given by decreasing length.

    Leaf ``c`` of the tree counts open windows with ``c`` places left, an inner node those below it. The tightest window for a
    piece is the first non-empty leaf at or right of its length, found in one climb and one descent.
    """
    size = 1 << int(window).bit_length()
    tree = [0] * (2 * size)
    open_at: list[list[int]] = [[] for _ in range(size)]
    room: list[int] = []
    number, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)

    def change(leaf: int, by: int) -> None:
        node = leaf + size
        while node:
            tree[node] += by
            node >>= 1

    for i, length in enumerate(lengths.tolist()):
        node = length + size
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node > 1:
                node += 1
                while node < size:
                    node = 2 * node if tree[2 * node] else 2 * node + 1
        if node > 1:
            left = node - size
            bin_ = open_at[left].pop()
            change(left, -1)
        else:
            left, bin_ = window, len(room)
            room.append(window)
        number[i], offset[i] = bin_, window - left
        room[bin_] = left - length
        if left > length:
            open_at[left - length].append(bin_)
            change(left - length, 1)
    return number, offset


def place(pieces: DataFrame, keys: list[str], window: int = WINDOW, each: int = PIECES_EACH) -> DataFrame:
    """Pieces (``length`` up to ``window``) with ``sequence_id`` and ``offset``; all other columns stay.

    ``keys`` order equal lengths. A full window is a sequence of its own in any order of packing, so it only gets a number.
    """
    n = parts_for(pieces.filter(F.col("length") < window).count(), each)
    spread = pieces.withColumn("bin", F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", *keys], ascending=[False, *[True] * len(keys)], kind="stable", ignore_index=True)
        number, offset = best_fit(rows["length"].to_numpy(), window)
        # The bin's number in the high bits: no two bins share a sequence.
        return rows.assign(sequence_id=rows["bin"].to_numpy().astype("int64") * (1 << 40) + number, offset=offset).drop(columns="bin")

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return spread.groupBy("bin").applyInPandas(pack, f"{fields}, sequence_id long, offset long")


KEYS = ["doc_id", "start", "ids_crc32"]


def pack_documents(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, with_tokens: bool = True, most_words: int = MOST_WORDS,
) -> DataFrame:
    """Packed pieces: ``doc_id, start, length, tokens, doc_tokens, ids_crc32, sequence_id, offset``.

    Without ``tokens`` only their checksum leaves the task that made them, and packing moves a few numbers per piece.
    """
    pieces = token_pieces(docs, tokenizer, window, end_id, most_words).withColumn("ids_crc32", F.crc32("tokens"))
    return place(stage(pieces if with_tokens else pieces.drop("tokens"), "pieces"), KEYS, window)
