"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features are densities and counts of lexicon words (also with look-alike characters put back),
second-person words near them, capitals, punctuation and obfuscation. The lexicon is learned from
the training rows: words whose share of toxic texts is high even at the lower end of its
confidence interval. Training uses at most ``TRAIN_ROWS`` labelled rows, chosen by hash; their
features, a few numbers each, are fitted on the driver. Scoring is one pass without a shuffle.

Null and empty texts get the score of a text without any word. Labels other than 0 and 1 are
not used; a row without a label, or without a text, trains nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, fold_of, materialize, narrow, text_hash

#: Bounds of the training sample and of the lexicon, and the decision threshold.
TRAIN_ROWS, LEXICON_WORDS, THRESHOLD = 20_000, 400, 0.7
TREES, DEPTH, RATE, BINS, LEAST = 120, 3, 0.12, 32, 8

_TOKEN = re.compile(r"[^\W_]+(?:['@$!*.\-_01345789]+[^\W_]+)*|[^\w\s]+")
_LOOKS = str.maketrans("01345789@$!", "oieastbgasi")
#: Second-person pronouns of the four languages of the corpus.
_YOU = frozenset("you your yours yourself u ur tu te ti toi vous votre vos ton du dich dir dein "
                 "deine ihr euch usted ustedes vosotros su".split())
NEAR = 6

FEATURES = ("strong", "strong_density", "weighted", "weighted_density", "heaviest", "distinct",
            "hidden", "hidden_density", "you_density", "you_near", "capital_share",
            "capital_words", "shout_hits", "exclaim_density", "mark_density", "inside_marks",
            "digit_words", "log_words")


def words(text: str) -> list[str]:
    return _TOKEN.findall(text)


def plain(word: str) -> str:
    """The word with look-alike characters put back and marks between letters taken out."""
    return re.sub(r"[^a-z]", "", word.translate(_LOOKS)) if not word.isalpha() else word


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    found = words(text or "")
    n = len(found)
    lower = [w.lower() for w in found]
    at, weights, shouted, hidden = [], [], 0, 0
    odd = [i for i, w in enumerate(lower) if not w.isalpha()]
    get = lexicon.get
    for i, word in enumerate(lower):
        weight = get(word)
        if weight is not None:
            at.append(i)
            weights.append(weight)
            shouted += found[i].isupper()
    inside = digits = marks = exclaim = 0
    for i in odd:
        word = lower[i]
        if not word[0].isalnum():
            marks += len(word)
            exclaim += word.count("!")
            continue
        has_digit = any(c.isdigit() for c in word)
        digits += has_digit and any(c.isalpha() for c in word)
        inside += not word.isalnum()
        back = plain(word)
        if back != word and (weight := get(back)) is not None:
            hidden += 1
            at.append(i)
            weights.append(weight)
    you = [i for i, w in enumerate(lower) if w in _YOU]
    near = sum(any(abs(i - j) <= NEAR for j in you) for i in at) if you and at else 0
    capital = sum(map(str.isupper, found))
    letters = text or ""
    upper = sum(map(str.isupper, letters)) if len(letters) < 4096 else \
        sum(c.isupper() for c in letters)
    each = 100 / max(n, 20)
    return [len(at), len(at) * each, sum(weights), sum(weights) * each, max(weights, default=0.0),
            len({lower[i] for i in at}), hidden, hidden * each, len(you) * each, near,
            upper / max(len(letters), 1), capital * each, shouted, exclaim * each, marks * each,
            inside * each, digits * each, log(1 + n)]


def learn_lexicon(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int,
                  size: int = LEXICON_WORDS) -> dict[str, float]:
    """Words (word, toxic texts, clean texts) that speak for toxicity, with their log odds."""
    kept = []
    for word, toxic, clean in counts:
        # compare shares within each label, so that the mix of labels does not matter
        a, b = toxic / max(n_toxic, 1), clean / max(n_clean, 1)
        n, p = toxic + clean, a / (a + b) if a + b else 0.0
        low = (p + 2 / n - 2 * sqrt(p * (1 - p) / n + 1 / n**2)) / (1 + 4 / n)
        if toxic >= 3 and low > 0.6:
            kept.append((low, word, log((a + 0.5 / max(n_toxic, 1)) / (b + 0.5 / max(n_clean, 1)))))
    return {word: weight for _, word, weight in sorted(kept, reverse=True)[:size]}


class Trees:
    """Boosted regression trees for the log loss, split on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else
                     np.zeros(0) for c in x.T]
        binned = self._bin(x)
        share = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.5
        self.start, self.trees = log(share / (1 - share)), []
        raw = np.full(len(y), self.start)
        for _ in range(TREES if len(y) else 0):
            p = 1 / (1 + np.exp(-raw))
            tree: list = []
            self._grow(binned, y - p, p * (1 - p), np.arange(len(y)), 0, tree)
            self.trees.append(tree)
            raw += self._walk(tree, binned)

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, i], side="left")
                         for i, c in enumerate(self.cuts)], axis=1)

    def _grow(self, binned, grad, hess, at, depth, tree) -> int:
        node = len(tree)
        g, h = grad[at].sum(), hess[at].sum()
        tree.append((-1, 0, 0, 0, RATE * g / (h + 1.0)))
        if depth == DEPTH or len(at) < 2 * LEAST:
            return node
        best = (1e-6, None, None)
        for f in range(binned.shape[1]):
            col = binned[at, f]
            gs = np.cumsum(np.bincount(col, grad[at], BINS + 1))[:-1]
            hs = np.cumsum(np.bincount(col, hess[at], BINS + 1))[:-1]
            ns = np.cumsum(np.bincount(col, minlength=BINS + 1))[:-1]
            gain = gs**2 / (hs + 1) + (g - gs)**2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(ns < LEAST) | (len(at) - ns < LEAST)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], f, k)
        if best[1] is not None:
            left = binned[at, best[1]] <= best[2]
            a = self._grow(binned, grad, hess, at[left], depth + 1, tree)
            b = self._grow(binned, grad, hess, at[~left], depth + 1, tree)
            tree[node] = (best[1], best[2], a, b, 0.0)
        return node

    @staticmethod
    def _walk(tree, binned) -> np.ndarray:
        table = np.array([t[:4] for t in tree], np.int64)
        value = np.array([t[4] for t in tree])
        node, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
        for _ in range(DEPTH):
            f, cut, a, b = table[node].T
            inner = f >= 0
            node = np.where(inner, np.where(binned[rows, np.maximum(f, 0)] <= cut, a, b), node)
        return value[node]

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned = self._bin(x)
        return self.start + sum((self._walk(t, binned) for t in self.trees), np.zeros(len(x)))


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the non-decreasing least-squares fit, by pooling adjacent violators. One row of
    each label is added at the ends, so that no score is surer than the rows allow."""
    order = np.argsort(raw, kind="stable")
    xs = np.concatenate(([-np.inf], raw[order], [np.inf]))
    pools: list[list[float]] = []
    for x, v in zip(xs, np.concatenate(([1 - 1e-9], y[order], [1e-9])), strict=True):
        pools.append([v, 1.0, x, x])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            v2, n2, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + v2, pools[-1][1] + n2, pools[-1][2], hi]
    pools = pools[:]
    knots = [(x, p[0] / p[1]) for p in pools for x in (p[2], p[3]) if np.isfinite(x)]
    if not knots:
        return np.zeros(1), np.full(1, y.mean() if len(y) else 0.5)
    xs, ys = zip(*knots, strict=True)
    return np.array(xs), np.array(ys)


class Model:
    def __init__(self, lexicon: dict[str, float], rows: list[tuple[int, list[float]]],
                 ids: list[int | None]):
        self.lexicon = lexicon
        x = np.array([r[1] for r in rows]).reshape(len(rows), len(FEATURES))
        y = np.array([r[0] for r in rows], float)
        # out-of-fold raw scores calibrate; the trees that score are fitted on all rows
        part = np.array([fold_of(i, 4) for i in ids], np.int64)
        raw = np.zeros(len(y))
        for p in range(4):
            if (part == p).any():
                raw[part == p] = Trees(x[part != p], y[part != p]).raw(x[part == p])
        self.trees = Trees(x, y)
        self.knots = isotonic(raw, y)

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in texts]).reshape(-1, len(FEATURES))
        return np.interp(self.trees.raw(x), *self.knots)


def sample(docs: DataFrame, labels: DataFrame, label: str, held: tuple[int, int],
           rows: int) -> DataFrame:
    """(doc_id, text, label) of labelled rows outside the held-out fold: all, or a share chosen by
    the hash of the id such that ``rows`` are expected."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col(f"`{label}`").cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    modulus, left_out = held
    known = known.filter(fold(known, modulus) != left_out)
    count = known.count()
    if count > rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < (rows << 20) // count)
    return narrow(docs).join(known, "doc_id").filter("text is not null")


def train(docs: DataFrame, labels: DataFrame, held: tuple[int, int] = (3, 1),
          rows: int = TRAIN_ROWS) -> Model:
    chosen = materialize(sample(docs, labels, "toxic", held, rows), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(),
                                   strict=True):
                seen[label].update({w.lower() for w in words(text) if w[0].isalnum()})
        for label, counter in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counter), pa.string()),
                 pa.array([label] * len(counter), pa.int32()),
                 pa.array(list(counter.values()), pa.int64())], names=["word", "label", "n"])

    n_toxic = chosen.filter("label = 1").count()
    n_clean = chosen.count() - n_toxic
    table = chosen.select("text", "label").mapInArrow(count, "word string, label int, n long") \
        .groupBy("word").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("t"),
                             F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("c"))
    strong = table.filter((F.col("t") >= 3) & (F.col("t") * max(n_clean, 1)
                                               > 1.5 * F.col("c") * max(n_toxic, 1)))
    # an order by the share of toxic texts, smoothed, leaves what the lexicon may take
    top = strong.orderBy(((F.col("t") + 0.5) * n_clean / ((F.col("c") + 0.5) * max(n_toxic, 1)))
                         .desc(), F.col("t").desc(), "word").limit(4 * LEXICON_WORDS)
    lexicon = learn_lexicon([tuple(r) for r in top.collect()], n_toxic, n_clean)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["label"],
                 pa.array([features(t, lexicon) for t in batch["text"].to_pylist()],
                          pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    rows_ = sorted(chosen.select("doc_id", "label", "text").mapInArrow(
        measure, "doc_id long, label int, x array<double>").collect())
    return Model(lexicon, [(r["label"], r["x"]) for r in rows_], [r["doc_id"] for r in rows_])


def score(docs: DataFrame, model, held: tuple[int, int], threshold: float = THRESHOLD,
          id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted per row, with ``keyed`` also the hash of its text.
    ``model`` has ``score(texts)``."""
    modulus, left_out = held
    shared = docs.sparkSession.sparkContext.broadcast(model)
    more = ["hash"] if keyed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            scores = np.clip(shared.value.score(batch["text"].to_pylist()), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([fold_of(i, modulus) == left_out for i in ids], pa.bool_()),
                 pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32)),
                 *[batch[x] for x in more]],
                names=["doc_id", "held_out", "score", "predicted", *more])

    rows = narrow(docs, id_col, text_col)
    return (rows.withColumn("hash", text_hash()) if keyed else rows).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
        + ", hash binary" * keyed)
