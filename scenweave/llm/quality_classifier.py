"""A quality classifier learned from preferences, by the Bradley-Terry model.

Any labelled good document is preferred to any labelled bad one. The model gives a document a score that is linear in features of
its text, and the probability of a preference is the logistic function of the difference of two scores; the weights minimise the
logistic loss over pairs, on differences of features. The threshold is the quantile of the learned scores that the share of
bad labels names, and scores are spread around it so that it stands at ``THRESHOLD``.

At most ``MOST_LABELLED`` labelled documents (those with the smallest hashes of their ids) are learned from; everything else covers
all documents. Features come from whole texts. Null handling: NULL and empty texts have features (all of them 0) and a score;
labels that are NULL or repeated for one id (the smallest counts) are no problem; without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Bounds of what is learned from: labelled documents, and pairs of them.
MOST_LABELLED, PAIRS = 20_000, 200_000
THRESHOLD = 0.3
FOLDS = 5
RIDGE = 1e-3

#: Classes of bytes (fixed values); all other ones are class 0.
CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:?'\"()-", b"#*$%&<>", b"|", b"!",
    bytes(range(128, 256)),
)
_CLASS = np.zeros(256, dtype=np.int64)
for _i, _c in enumerate(CLASSES):
    _CLASS[list(_c)] = _i + 1
N_CLASSES = len(CLASSES) + 1
#: A class, a word ratio and so on, each as it is and by its square root.
N_FEATURES = 2 * (N_CLASSES + 6)


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text, all from 0 to about 1."""
    texts = pc.fill_null(texts, "").cast(pa.binary())
    out = np.zeros((len(texts), N_CLASSES + 6))
    for low, n in slices(pc.binary_length(texts).to_numpy(), 4_000_000):
        some = texts.slice(low, n).to_pylist()
        sizes = np.array([len(t) for t in some], dtype=np.int64)
        data = np.frombuffer(b"".join(some), dtype=np.uint8)
        counts = np.bincount(_CLASS[data] + np.repeat(np.arange(n) * N_CLASSES, sizes), minlength=n * N_CLASSES).reshape(n, N_CLASSES)
        out[low : low + n, :N_CLASSES] = counts / np.maximum(sizes, 1)[:, None]
        for i, text in enumerate(some):
            words = text.split()
            if words:
                lines = [x for x in text.split(b"\n") if x]
                w = len(words)
                out[low + i, N_CLASSES:] = (
                    len(set(words)) / w, len(set(lines)) / len(lines), min(1.0, w / len(lines) / 100), min(1.0, np.log1p(w) / 12),
                    min(1.0, (len(text) - w) / w / 20), len(set(zip(words, words[1:]))) / w,
                )
    return np.concatenate([out, np.sqrt(out)], axis=1)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class Model:
    """Weights of the standardised features, and the line that brings scores to 0..1."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float, slope: float) -> None:
        self.mean, self.scale, self.weights, self.cut, self.slope = mean, scale, weights, cut, slope

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights
        return logistic(self.slope * (z - self.cut) + np.log(THRESHOLD / (1 - THRESHOLD)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 0) -> Model | None:
    """The model of features and labels; None where one of the labels is missing."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return None
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps on the mean of log(1 + exp(-d w)) and a ridge
        p = logistic(-(d @ w))
        gradient = -(d * p[:, None]).mean(0) + RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    score = z @ w
    cut = float(np.quantile(score, len(bad) / len(y)))
    spread = float(np.median(score[good]) - np.median(score[bad]))
    return Model(mean, scale, w, cut, 6 / spread if spread > 1e-9 else 1.0)


def learn(docs: DataFrame, labels: DataFrame, target: str = "quality", most: int = MOST_LABELLED) -> Model | None:
    """The model of the labelled documents that are not held out. The sample has at most ``most`` rows, and so may be broadcast."""
    sample = (
        labels.filter(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min(target).alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )

    def measure(batches):
        for batch in batches:
            x = features(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"]
            )

    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")
    # An id that repeats counts once, and is reduced before anything reaches the driver, however many rows have it.
    each = found.mapInArrow(measure, "doc_id long, y int, x array<double>").groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x"))
    rows = each.toArrow().to_pandas().sort_values("doc_id")
    if rows.empty:
        return None
    return fit(np.array(rows["x"].tolist()), rows["y"].to_numpy())


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    The names are overwritten where ``docs`` has them.
    """
    model = learn(docs, labels)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model(features(texts)) if model else np.full(len(texts), 0.5))

    return docs.withColumn("score", score("text")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
