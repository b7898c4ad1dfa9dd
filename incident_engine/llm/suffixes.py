"""Removal of long repeated passages with a logarithmic family of sparse suffix arrays.

A string of 400 bytes that occurs twice is found through an anchor inside it: of its 64-byte
strings the one with the smallest hash. Equal strings of 400 bytes have the same anchor at the same
place, so suffixes need to be indexed at anchors only, about one per 170 bytes.

*Index family.* Texts come in batches. A batch's suffix array holds its anchors' suffixes, cut at
64 bytes and kept as fingerprints in sorted order with the number of times they occur. A new batch
is merge-scanned against each existing level: suffixes found in a level, or twice in the batch, are
possible matches. Then the batch becomes a level, and levels of equal size merge into one of double
size, so each suffix is rewritten log(batches) times. Levels are tables in the shared folder.

*Exact check.* Around each anchor with a partner, all 400-byte strings that choose it are judged by
their place relative to the anchor, in blocks of 64 places. Strings of a block share a core; blocks
whose core has no partner are done. If the whole extent of a block occurs elsewhere, all its strings
do. What is left, the edges of shared passages, is settled string by string. All these are counts
over hashes, combined before each shuffle; no pairs are formed, whatever the number of copies.

Fingerprints are 64 bits with the anchor's context (128 for cores), so a chance collision is
possible in theory. Copies of a whole text are worked on once. Null texts are empty, equal ids are
told apart by their texts, an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_engine.session import drop_tables, tables_noted

from .common import materialize, mix, narrow

LENGTH, GRAM, PLACES = 400, 64, 64
#: A shorter string has shorter suffixes at its anchors, so that these stay as far apart.
LEAST, GRAM_SHARE = 128, 6
#: Batches in which a table is added to the family.
BATCHES = 4
#: Bytes of a text worked on at a time.
_CHUNK = 1 << 20
_MUL = 0x9E3779B97F4A7C15
_NONE = -(1 << 62)


def _powers(base: int) -> np.ndarray:
    out = np.full(_CHUNK + 2 * LENGTH + 1, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


_POWER, _INVERSE = _powers(_MUL), _powers(pow(_MUL, -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def gram_of(length: int) -> int:
    return min(GRAM, length // GRAM_SHARE)


def window_hashes(data: bytes, size: int) -> np.ndarray:
    """Hash of each ``size`` bytes in a row."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if n > _CHUNK:
        return np.concatenate([window_hashes(data[i:i + _CHUNK + size - 1], size)
                               for i in range(0, n, _CHUNK)])
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[np.frombuffer(data, np.uint8)] * _POWER[:len(data)], out=sums[1:])
        return mix((sums[size:] - sums[:-size]) * _INVERSE[:n])


def _sliding_min(keys: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` keys in a row."""
    n = len(keys) - size + 1
    pad = -len(keys) % size
    grid = np.concatenate((keys, np.full(pad, np.iinfo(keys.dtype).max, keys.dtype)))
    grid = grid.reshape(-1, size)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[size - 1:size - 1 + n])


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchor positions of a text, the first and last string start that choose each, and the
    fingerprint of the anchor's bytes. Every start from 0 to len - ``length`` belongs to one anchor
    that lies, with its bytes, inside the string."""
    gram = gram_of(length)
    starts, spread = len(data) - length + 1, length - gram
    if starts <= 0:
        return (np.zeros(0, np.int32),) * 3 + (np.zeros(0, np.int64),)
    hashes = window_hashes(data, gram)
    chosen = []
    for at in range(0, starts, _CHUNK):
        part = hashes[at:at + _CHUNK + spread]
        # the hash's upper bits, then the position: the leftmost of equals is chosen
        keys = (part & ~np.uint64((1 << 24) - 1)) | np.arange(len(part), dtype=np.uint64)
        least = _sliding_min(keys, spread + 1)
        chosen.append((least & np.uint64((1 << 24) - 1)).astype(np.int64) + at)
    chosen = np.concatenate(chosen)[:starts]
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    last = np.append(first[1:], starts) - 1
    at = chosen[first]
    return (at.astype(np.int32), first.astype(np.int32), last.astype(np.int32),
            hashes[at].view(np.int64))


class SuffixFamily:
    """Levels of sorted suffix fingerprints: (fp, n), n being 2 for twice or more."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Adds a batch (fp) and returns the fingerprints it repeats, in itself or a level."""
        array = materialize(suffixes.groupBy("fp").agg(
            F.least(F.count(F.lit(1)), F.lit(2)).alias("n")).sortWithinPartitions("fp"),
            "suffix-batch")
        found = array.filter("n > 1").select("fp")
        for _, level in self.levels:
            found = found.union(array.join(level.select("fp"), "fp").select("fp"))
        found = materialize(found.distinct(), "suffix-matches")
        size, level = 1, array
        while self.levels and self.levels[-1][0] == size:
            _, other = self.levels.pop()
            level = materialize(other.union(level).groupBy("fp").agg(
                F.least(F.sum("n"), F.lit(2)).alias("n")).sortWithinPartitions("fp"),
                "suffix-level")
            size *= 2
        self.levels.append((size, level))
        return found


def _anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors((t or "").encode(), length) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["holder"], batch["hash"]] + [
                    pa.array([f[i] for f in found], pa.list_(kind)) for i, kind in
                    enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                names=["holder", "hash", "at", "first", "last", "fp"])

    return rows.mapInArrow(run, "holder long, hash binary, at array<int>, first array<int>, "
                                "last array<int>, fp array<long>")


def _blocks(held: DataFrame, length: int) -> DataFrame:
    """Per text, anchor and block of places: hash of the core, hash of the extent of the places
    that choose the anchor (with these places), and the string starts they stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, id_, marks in zip(batch["text"].to_pylist(), batch["id"].to_pylist(),
                                        batch["marks"].to_pylist(), strict=True):
                data = memoryview(text.encode())
                for mark in marks:
                    at, low, high = mark["at"], mark["at"] - mark["last"], mark["at"] - mark["first"]
                    for j in range(low // PLACES, high // PLACES + 1):
                        a, b = j * PLACES, min(j * PLACES + PLACES - 1, length - gram_of(length))
                        core = xxhash.xxh3_128_digest(data[at - a:at - b + length], j)
                        a, b = max(a, low), min(b, high)
                        whole = xxhash.xxh3_64_intdigest(data[at - b:at - a + length], a << 16 | b)
                        rows.append((id_, int.from_bytes(core[:8], "little", signed=True),
                                     int.from_bytes(core[8:], "little", signed=True), whole >> 1,
                                     at - b, at - a))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols],
                names=["id", "c1", "c2", "whole", "first", "last"])

    return held.select("id", "text", "marks").mapInArrow(
        run, "id long, c1 long, c2 long, whole long, first long, last long")


def _strings(held: DataFrame, length: int) -> DataFrame:
    """Hashes of the single strings of the wanted blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, id_, wanted in zip(batch["text"].to_pylist(), batch["id"].to_pylist(),
                                         batch["wanted"].to_pylist(), strict=True):
                data = text.encode()
                for w in wanted:
                    part = data[w["first"]:w["last"] + length]
                    rows.append((id_, w["c1"], w["first"], w["alone"],
                                 window_hashes(part, length).view(np.int64)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                names=["id", "c1", "first", "alone", "hashes"])

    return held.select("id", "text", "wanted").mapInArrow(
        run, "id long, c1 long, first long, alone boolean, hashes array<long>")


def _cut(held: DataFrame, length: int) -> DataFrame:
    """Per text with repeated strings: what is removed and what is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, id_, spans in zip(batch["text"].to_pylist(), batch["id"].to_pylist(),
                                        batch["spans"].to_pylist(), strict=True):
                data = text.encode()
                merged: list[list[int]] = []
                for a, b in sorted((s["first"], s["last"] + length) for s in spans):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                kept = b"".join(data[a:b] for a, b in zip(
                    [0] + [m[1] for m in merged], [m[0] for m in merged] + [len(data)],
                    strict=True))
                rows.append((id_, len(data) - len(kept), len(merged),
                             hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                names=["id", "n_removed", "n_spans", "kept_sha256", "kept"])

    return held.select("id", "text", "spans").mapInArrow(
        run, "id long, n_removed long, n_spans long, kept_sha256 string, kept string")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             batches: int = BATCHES, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(rows, texts): rows has doc_id, hash (of the text) and n_bytes; texts has, per different
    text from which bytes go: hash, n_removed, n_spans, kept_sha256, kept (as text, without characters
    cut in two). ``length``: bytes of a string that goes when it occurs twice, 128 to 400."""
    if not LEAST <= length <= LENGTH:
        raise ValueError(f"length must be from {LEAST} to {LENGTH}")
    rows = narrow(docs, id_col, text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "hash", F.unhex(F.sha2("text", 256))).withColumn(
        "holder", F.coalesce("doc_id", F.lit(_NONE)))
    listed = materialize(rows.select("doc_id", "holder", "hash",
                                     F.octet_length("text").cast("long").alias("n_bytes")),
                         "suffix-rows")
    long = F.col("n_bytes") >= length
    texts = materialize(listed.filter(long).groupBy("hash").agg(
        F.min("holder").alias("holder"), F.count(F.lit(1)).alias("copies"),
        F.first("n_bytes").alias("n_bytes")).withColumn(
        "id", F.monotonically_increasing_id()), "suffix-texts")
    with tables_noted() as spent:
        marked = materialize(_anchor_rows(rows.filter(F.octet_length("text") >= length), length),
                             "suffix-anchors")
        marked = marked.join(texts.select("holder", "hash", "id"), ["holder", "hash"])
        each = materialize(marked.select("id", F.explode(F.arrays_zip("at", "first", "last", "fp"))
                                         .alias("m")).select("id", "m.*"), "suffix-each")
        family, found = SuffixFamily(), None
        for i in range(batches):
            part = each.filter(F.pmod(F.xxhash64("id"), F.lit(batches)) == i)
            match = family.add(part.select("fp"))
            found = match if found is None else found.union(match)
        found = materialize(found.distinct(), "suffix-found")
        marks = each.join(found, "fp").groupBy("id").agg(
            F.collect_list(F.struct("at", "first", "last")).alias("marks"))
        marks = materialize(marks, "suffix-marks")
        names = marks.join(texts, "id").select("id", "marks", "holder", "hash")
        held = materialize(rows.select("holder", "hash", "text").join(names, ["holder", "hash"])
                           .select("id", "hash", "text", "marks"),
                           "suffix-held")
    drop_tables(docs.sparkSession, spent[:-1])

    with tables_noted() as worked:
        key = ["c1", "c2", "whole"]
        blocks = materialize(_blocks(held, length), "suffix-blocks")
        kinds = blocks.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(
            F.struct("id", "first", "last")).alias("one"))
        cores = kinds.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("all"))
        cores = materialize(cores.filter("`all` > 1"), "suffix-cores")
        kinds = materialize(kinds.join(cores, ["c1", "c2"]), "suffix-kinds")
        settled = blocks.join(kinds.filter("n > 1").select(*key), key).select("id", "first", "last")
        wanted = kinds.filter("kinds > 1").select(
            "one.*", "c1", (F.col("n") == 1).alias("alone")).groupBy("id").agg(
            F.collect_list(F.struct("c1", "first", "last", "alone")).alias("wanted"))
        strings = materialize(_strings(held.join(wanted, "id"), length), "suffix-strings")
        single = strings.select("id", "c1", "first", "alone", F.posexplode("hashes").alias("i", "h"))
        twice = materialize(single.groupBy("c1", "h").agg(F.count(F.lit(1)).alias("n"))
                            .filter("n > 1").select("c1", "h"), "suffix-twice")
        start = (F.col("first") + F.col("i")).alias("first")
        hits = single.filter("alone").join(twice, ["c1", "h"]).select(
            "id", start, start.alias("last"))
        spans = settled.union(hits).groupBy("id").agg(
            F.collect_list(F.struct("first", "last")).alias("spans"))
        cut = _cut(held.join(spans, "id"), length)
        # copies of a text without a partner for its anchors beyond those copies
        empty = F.lit(hashlib.sha256(b"").hexdigest())
        copies = texts.filter("copies > 1").select(
            "hash", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
            empty.alias("kept_sha256"), F.lit("").alias("kept"))
        single_texts = texts.filter("copies = 1").select("id", "hash")
        out = cut.join(single_texts, "id").select(*copies.columns).union(copies)
        out = materialize(out, "suffix-cut")
    drop_tables(docs.sparkSession, [spent[-1], *worked[:-1]])
    return listed.select("doc_id", "hash", "n_bytes"), out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, cut = repeated(docs, id_col, text_col)
    zero = F.lit(0).cast("long")
    return rows.join(cut.drop("kept"), "hash", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("hash"))).alias("kept_sha256"))


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes taken out of its texts; all columns and rows stay.

    Bytes of characters that were cut in two are left out as well.
    """
    _, cut = repeated(docs, id_col, text_col, length=length)
    text = F.col(f"`{text_col}`")
    cut = cut.select(F.col("hash").alias("__hash"), F.col("kept").alias("__kept"))
    return docs.withColumn("__hash", F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))).join(
        cut, "__hash", "left").withColumn(text_col, F.when(
            F.col("__kept").isNotNull(), F.col("__kept")).otherwise(text)) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])
