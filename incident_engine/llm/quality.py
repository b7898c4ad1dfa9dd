"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Every token (a word or a run of marks, case kept) falls into one of ``BUCKETS`` buckets by hash, and
each document has a sparse random index vector. A bucket's vector is the sum of the index vectors of
the documents it occurs in, over the whole corpus: tasks add up their share, Spark adds up the
tasks, and the vectors, whose number is fixed, are scaled to unit length. A document is the mean of
its tokens' vectors beside a random projection of the tokens themselves and its log length. A
network of one hidden layer is fitted by numpy on at most ``TRAIN_ROWS`` labelled documents, chosen
by hash, and its logits are divided by a temperature fitted on a part kept out of training.

Null and empty texts have zero vectors and get the network's score of those.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, materialize, mix, narrow
from .toxicity import sample

TRAIN_ROWS = 20_000
BUCKETS, SIZE, INDEXED = 4096, 32, 4
HIDDEN, EPOCHS, STEP, DECAY = 32, 40, 0.01, 1e-4

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_PROJECT = np.where(mix(np.arange(BUCKETS * SIZE, dtype=np.uint64)) & np.uint64(1), 1.0, -1.0) \
    .astype(np.float32).reshape(BUCKETS, SIZE) / np.float32(np.sqrt(SIZE))


def buckets(text: str | None) -> np.ndarray:
    found = _TOKEN.findall(text or "")
    return np.fromiter(map(crc32, map(str.encode, found)), np.int64, len(found)) & (BUCKETS - 1)


def index_vector(text: str) -> np.ndarray:
    """Places and signs of a document's index vector, from a hash of its text: copies share it."""
    hashes = mix(np.arange(INDEXED, dtype=np.uint64) + np.uint64(crc32(text.encode()) << 8))
    return np.stack([(hashes % np.uint64(SIZE)).astype(np.int64),
                     np.where(hashes >> np.uint64(63), 1, -1)])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """BUCKETS x SIZE unit vectors from all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS * SIZE)
        for batch in batches:
            for text in batch["text"].to_pylist():
                used = np.unique(buckets(text))
                if len(used):
                    for place, sign in index_vector(text).T:
                        sums[used * SIZE + place] += sign
        rows = sums.reshape(BUCKETS, SIZE)
        at = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32())] + [pa.array(rows[at, i]) for i in range(SIZE)],
            names=["bucket", *(f"v{i}" for i in range(SIZE))])

    each = ", ".join(f"v{i} double" for i in range(SIZE))
    summed = narrow(docs).select("text").mapInArrow(run, f"bucket int, {each}").groupBy("bucket") \
        .agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(SIZE)])
    out = np.zeros((BUCKETS, SIZE), np.float32)
    for row in summed.collect():  # at most BUCKETS rows
        out[row["bucket"]] = row[1:]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


class Pooling:
    def __init__(self, vectors: np.ndarray):
        self.table = np.concatenate([vectors, _PROJECT], axis=1).astype(np.float32)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        found = [buckets(t) for t in texts]
        out = np.zeros((len(texts), 2 * SIZE + 1), np.float32)
        for i, at in enumerate(found):
            if len(at):
                counts = np.bincount(at)
                used = np.flatnonzero(counts)
                out[i, :-1] = counts[used].astype(np.float32) @ self.table[used] / len(at)
                out[i, -1] = np.log1p(len(at)) / 5
        return out


class Network:
    """Two layers, fitted by Adam on the log loss; then a temperature on rows kept apart."""

    def __init__(self, x: np.ndarray, y: np.ndarray, apart: np.ndarray):
        rng = np.random.default_rng(7)
        fit = ~apart if (~apart).any() else np.ones(len(y), bool)
        self.mean = x[fit].mean(axis=0) if fit.any() else np.zeros(x.shape[1])
        self.scale = x[fit].std(axis=0) + 1e-4 if fit.any() else np.ones(x.shape[1])
        self.w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 1)), np.zeros(1)]
        self.temperature = 1.0
        xs, ys = (x[fit] - self.mean) / self.scale, y[fit]
        first = [np.zeros_like(w) for w in self.w]
        second = [np.zeros_like(w) for w in self.w]
        step = 0
        for _ in range(EPOCHS if len(ys) else 0):
            for at in np.array_split(rng.permutation(len(ys)), max(1, len(ys) // 128)):
                step += 1
                hidden = np.tanh(xs[at] @ self.w[0] + self.w[1])
                p = 1 / (1 + np.exp(-(hidden @ self.w[2] + self.w[3])[:, 0]))
                d = ((p - ys[at]) / len(at))[:, None]
                back = d @ self.w[2].T * (1 - hidden**2)
                for i, g in enumerate((xs[at].T @ back + DECAY * self.w[0], back.sum(axis=0),
                                       hidden.T @ d + DECAY * self.w[2], d.sum(axis=0))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    self.w[i] -= STEP * (first[i] / (1 - 0.9**step)) / (
                        np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        if apart.any():
            logits, truth = self.logits(x[apart]), y[apart]
            grid = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
            loss = [np.logaddexp(0, np.where(truth == 1, -logits, logits) / t).mean() for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w[0] + self.w[1])
        return (hidden @ self.w[2] + self.w[3])[:, 0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


class Model:
    def __init__(self, pooling: Pooling, network: Network):
        self.pooling, self.network = pooling, network

    def score(self, texts: list[str | None]) -> np.ndarray:
        return self.network.probability(self.pooling(texts))


def train(docs: DataFrame, labels: DataFrame, held: tuple[int, int] = (4, 2),
          rows: int = TRAIN_ROWS) -> Model:
    pooling = Pooling(word_vectors(docs))
    shared = docs.sparkSession.sparkContext.broadcast(pooling)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = shared.value(batch["text"].to_pylist()).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["label"], pa.array(list(x), pa.list_(pa.float64()))],
                names=["doc_id", "label", "x"])

    chosen = materialize(sample(docs, labels, "quality", held, rows).select(
        "doc_id", "label", "text").mapInArrow(measure, "doc_id long, label int, x array<double>"),
        "quality-sample")
    rows_ = sorted(chosen.collect())  # at most ``rows`` vectors
    x = np.array([r["x"] for r in rows_]).reshape(len(rows_), 2 * SIZE + 1)
    y = np.array([r["label"] for r in rows_], float)
    apart = np.array([fold_of(r["doc_id"], 5) == 0 for r in rows_], bool)
    return Model(pooling, Network(x, y, apart))
