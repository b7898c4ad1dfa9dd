"""Benchmark decontamination by winnowing.

Every ``GRAM`` words in a row have a hash; of each ``WINDOW`` hashes in a row the smallest is
kept (the leftmost of equals). A span of GRAM + WINDOW - 1 = 10 words that a document shares with
an item thus keeps the same hash on both sides. Kept hashes of documents are joined with those of
the items, and each hit is extended along its diagonal to all runs of at least ten equal words, so
equal hashes of other words do no harm. Items of fewer words are looked up whole.

The items are read in blocks of bounded size, each broadcast on its own: all documents are held
against all blocks, with one block at a time in a worker's memory. Documents never move.

Null or wordless documents have no words and no hit; null or wordless items match nothing; items
with a null id mark words but are not listed; an id given twice counts once.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, narrow, text_hash, words_of

SPAN, GRAM = 10, 5
WINDOW = SPAN - GRAM + 1
#: Bytes of item texts in one broadcast block.
BLOCK_BYTES = 16 << 20

_RESULT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
           "contaminated boolean")


def gram_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` word ids in a row."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = out * np.uint64(0x9E3779B97F4A7C15) + ids[i:i + n].astype(np.uint64)
    return mix(out)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions kept: the leftmost smallest hash of each ``window`` in a row."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at = hashes[:n].copy(), np.arange(n)
    for i in range(1, window):
        less = hashes[i:i + n] < least
        least[less] = hashes[i:i + n][less]
        at[less] = np.flatnonzero(less) + i
    return np.unique(at)


class Items:
    """Fingerprints of one block of items."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.words: dict[bytes, int] = {}
        self.names, self.ids = [], []
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        kept = []
        for name, text in rows:
            words = words_of(text)
            if not words:
                continue
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in words])
            item = len(self.names)
            self.names.append(name)
            self.ids.append(ids)
            if len(ids) < SPAN:
                self.short[len(ids)][int(gram_hashes(ids, len(ids))[0])].append(item)
            else:
                hashes = gram_hashes(ids, GRAM)
                at = winnow(hashes, WINDOW)
                kept.append((hashes[at], np.full(len(at), item), at))
        self.hashes, self.item, self.at = (
            np.concatenate(x) for x in zip(*kept, strict=True)) if kept else (
            np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int))
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.item, self.at = self.hashes[order], self.item[order], self.at[order]
        self.lengths = sorted(self.short)

    def search(self, words: list[bytes], hit: np.ndarray, found: set) -> None:
        """Marks the hit words of one document and adds the items' ids."""
        get = self.words.get
        ids = np.array([get(w, 0) for w in words], np.int64)
        for size in self.lengths:
            hashes, table = gram_hashes(ids, size), self.short[size]
            keys = np.fromiter(table, np.uint64, len(table))
            for at in np.flatnonzero(np.isin(hashes, keys)):
                for item in table[int(hashes[at])]:
                    if np.array_equal(ids[at:at + size], self.ids[item]):
                        hit[at:at + size] = True
                        found.add(self.names[item])
        if len(ids) < SPAN or not len(self.hashes):
            return
        hashes = gram_hashes(ids, GRAM)
        kept = winnow(hashes, WINDOW)
        first = np.searchsorted(self.hashes, hashes[kept], "left")
        last = np.searchsorted(self.hashes, hashes[kept], "right")
        diagonals = set()
        for i in np.flatnonzero(last > first):
            part = slice(first[i], last[i])
            diagonals.update(zip(self.item[part].tolist(), (kept[i] - self.at[part]).tolist(),
                                 strict=True))
        for item, shift in diagonals:
            other = self.ids[item]
            lo, hi = max(0, shift), min(len(ids), shift + len(other))
            same = np.concatenate(([0], ids[lo:hi] == other[lo - shift:hi - shift], [0]))
            edge = np.flatnonzero(np.diff(same))
            for a, b in zip(edge[::2], edge[1::2], strict=True):
                if b - a >= SPAN:
                    hit[lo + a:lo + b] = True
                    found.add(self.names[item])


def _blocks(items: DataFrame, block_bytes: int) -> list:
    rows = narrow(items, "item_id", names=("item_id", "text")).filter("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    spark, part = items.sparkSession, F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [spark.sparkContext.broadcast([tuple(r) for r in rows.filter(part == i).collect()])
            for i in range(n)]


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", block_bytes: int = BLOCK_BYTES,
                  keyed: bool = False) -> DataFrame:
    """One row per document: n_words, n_hit (words inside an occurring window), n_items and
    items_sha256 of the items with such windows, and contaminated; with ``keyed`` also the hash of
    its text."""
    blocks = _blocks(items, block_bytes)
    more = ["hash"] if keyed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Items(blocks[0].value)
        for batch in batches:
            texts = [words_of(t) for t in batch["text"].to_pylist()]
            hits = [np.zeros(len(w), bool) for w in texts]
            found = [set() for _ in texts]
            for block in blocks:
                if len(blocks) > 1:
                    index = Items(block.value)
                for words, hit, names in zip(texts, hits, found, strict=True):
                    index.search(words, hit, names)
            listed = [sorted(str(x) for x in names if x is not None) for names in found]
            n_hit = [int(h.sum()) for h in hits]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(w) for w in texts], pa.int64()),
                 pa.array(n_hit, pa.int64()), pa.array([len(x) for x in listed], pa.int64()),
                 pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in listed],
                          pa.string()),
                 pa.array([n > 0 for n in n_hit], pa.bool_()), *[batch[x] for x in more]],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                       *more])

    rows = narrow(docs, id_col, text_col)
    return (rows.withColumn("hash", text_hash()) if keyed else rows).mapInArrow(
        run, _RESULT + ", hash binary" * keyed)
