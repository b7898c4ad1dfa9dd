"""Near-duplicate texts by Order MinHash, candidates verified by banded alignment.

The k-mers of a text are its runs of five words, each labelled with how often it has occurred
before. A sketch takes the ``TAKEN`` k-mers with the smallest hashes under one of ``SKETCHES`` hash
functions and keeps them in text order, so equal sketches mean shared k-mers in the same order.
Texts with an equal sketch meet in a bucket. Two texts are near if the Jaccard similarity of their
sets of five-word shingles and the similarity of an edit alignment of their words are both 0.8 or
more. Classes are the connected components of near pairs; equal texts share a class anyway.

No bucket is expanded into all its pairs. A bucket of up to ``SMALL`` texts gives its pairs. In a
larger one each text is paired with a few leaders, the texts that meet most others over all
sketches. The texts of all larger buckets are then dealt anew by an exact key: of the shingles of a
text, rare ones first, each of the first n - ceil(0.8 n) + 1, one of which two near texts share. These
buckets are gone through in rounds: in each that still holds more than one class, texts outside its
largest class become leaders, four times as many each round, and meet all texts of other classes
there, until it holds one class or each of them has met all others. Pairs whose sizes, places of
the shared shingle or signatures (a bit for each shingle) rule out 0.8 are left out. So no near pair that meets in a bucket stays in two
classes, and the only near pairs missed are those that share no sketch at all. The price is up to
one pair for each two texts of a hot group that are in different classes, be they near or not.

Texts of fewer than five words are one shingle; texts without a word equal only themselves. Null
texts count as empty. Rows with equal ids are told apart by their text; class ids are the smallest
doc_id of a class, null ids last.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialize, mix, narrow, text_hash, words_of

SHINGLE, SIMILARITY = 5, 0.8
SKETCHES, TAKEN = 16, 3
#: Texts of a bucket that gives all its pairs, and leaders of a larger one.
SMALL, LEADERS = 6, 3
#: Slots in which shingles are counted to put rare ones first; any order gives the same classes.
SLOTS = 1 << 22
#: 64-bit words of a signature: the bits of a text's hashed shingles.
SIGNATURE = 16
_MARKS = [f"m{i}" for i in range(SIGNATURE)]
#: Texts whose words and shingles a task keeps while it checks pairs.
KEPT_SETS = 128

_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64))


def word_ids(text: str | None) -> np.ndarray:
    words = words_of(text)
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def shingles(ids: np.ndarray) -> np.ndarray:
    """Hash of each shingle, in text order."""
    if not len(ids):
        return np.zeros(0, np.uint64)
    size = min(SHINGLE, len(ids))
    n = len(ids) - size + 1
    out = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + ids[i:i + n])
    return out


def sketches(grams: np.ndarray) -> np.ndarray:
    """Order MinHash of one text: SKETCHES signed 64-bit numbers, none without a shingle."""
    n = len(grams)
    if not n:
        return np.zeros(0, np.int64)
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    starts = np.flatnonzero(fresh)
    label = np.empty(n, np.uint64)
    label[order] = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    taken = min(TAKEN, n)
    with np.errstate(over="ignore"):
        labelled = grams + label * np.uint64(0xD1B54A32D192ED03)
        out = np.empty(SKETCHES, np.uint64)
        for t in range(SKETCHES):
            hashes = mix(labelled ^ _SEEDS[t])
            at = np.argpartition(hashes, taken - 1)[:taken] if taken < n else np.arange(n)
            value = np.uint64(t)
            for x in labelled[np.sort(at)]:
                value = (value ^ x) * np.uint64(0x9E3779B97F4A7C15)
                value ^= value >> np.uint64(29)
            out[t] = value
    return out.view(np.int64)


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance of two sequences within the band of ``most`` diagonals on each side of the
    main one, or ``most`` + 1. Per diagonal the furthest row reached with e edits is kept."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    stops: dict[int, list[int]] = {}

    def slide(k: int, x: int) -> int:  # diagonal k: b[x + k] against a[x]
        if k not in stops:
            lo, hi = max(0, -k), min(n, m - k)
            stops[k] = [*(np.flatnonzero(a[lo:hi] != b[lo + k:hi + k]) + lo).tolist(), hi]
        return stops[k][bisect_left(stops[k], x)] if x < min(n, m - k) else x

    reach = {0: slide(0, 0)}
    for e in range(most + 1):
        if reach.get(m - n, -1) >= n:
            return e
        after = {}
        for k in range(-e - 1, e + 2):
            if -n <= k <= m:
                x = max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1)
                x = min(x, n, m - k)
                if x >= max(0, -k):
                    after[k] = slide(k, x)
        reach = after
    return most + 1


def _with_set(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids, np.unique(shingles(ids))


def _alike(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray],
           least: float) -> bool:
    """``near`` of two texts that come with their sets of shingles."""
    one, two = a[1], b[1]
    if min(len(one), len(two)) < least * max(len(one), len(two)):
        return False
    both = len(np.intersect1d(one, two, assume_unique=True))
    if both < least * (len(one) + len(two) - both):
        return False
    longest = max(len(a[0]), len(b[0]))
    most = int((1 - least) * longest + 1e-9)
    return edit_distance(a[0], b[0], most) <= most


def near(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Do two sequences of word ids lie within ``least`` on shingles and on the alignment?"""
    return _alike(_with_set(a), _with_set(b), least)


def _sketched(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketches(shingles(word_ids(t))) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["hash"], pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "hash", "sketches"])

    return texts.mapInArrow(run, "doc_id long, hash binary, sketches array<long>")


def _pairs(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Candidate pairs from buckets of (keys, id, popular) of ``n`` texts each."""
    small = entries.filter(F.col("n") <= SMALL).groupBy(*keys).agg(F.collect_list("id").alias("all"))
    pairs = small.select(F.explode(F.flatten(F.transform(
        "all", lambda a: F.transform(F.filter("all", lambda b: b > a),
                                     lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p"))
    large = entries.filter(F.col("n") > SMALL)
    best = large.groupBy(*keys, F.pmod(F.xxhash64("id"), F.lit(LEADERS)).alias("c")).agg(
        F.max(F.struct("popular", "id")).alias("best")).groupBy(*keys).agg(
        F.collect_list("best.id").alias("leaders"))
    best = materialize(best, "near-leaders")
    star = large.select(*keys, "id").join(best, keys).select(
        F.col("id"), F.explode("leaders").alias("lead"))
    star = star.filter(F.col("id") != F.col("lead")).select(
        F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b"))
    return pairs.select("p.a", "p.b").union(star)


def _candidates(sketched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs of text ids that meet in a bucket, and the ids of the texts in large
    buckets, whose other pairs are still to be found. ``sketched``: id, sketches.

    Entries travel without the other sketches of their text. Both sides of these joins grow with
    the corpus, so they are merged at every size.
    """
    entries = sketched.select("id", F.posexplode("sketches").alias("t", "k1"))
    keys = ["t", "k1"]
    sizes = entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = materialize(sizes, "near-sizes")
    met = entries.join(sizes.hint("merge"), keys)
    popular = materialize(met.groupBy("id").agg(F.sum("n").alias("popular")), "near-popular")
    met = materialize(met.join(popular.hint("merge"), "id"), "near-entries")
    pairs = materialize(_pairs(met.select(*keys, "id", "n", "popular"), keys).distinct(),
                        "near-pairs")
    return pairs, materialize(met.filter(F.col("n") > SMALL).select("id").distinct(), "near-large")


def _prefixes(words: DataFrame, least: float) -> DataFrame:
    """Buckets (bucket, id, place, size and the signature) by prefix filter. Two of ``words`` (id, words) that are
    near share one of their first ``size`` - ceil(``least`` * ``size``) + 1 shingles, if all texts
    have theirs in one order; here rare ones come first, by counts in hashed slots."""
    def sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        return (_with_set(np.frombuffer(w, "<u4").astype(np.uint64))[1]
                for w in batch["words"].to_pylist())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for grams in sets(batch):
                np.add.at(counts, grams % np.uint64(SLOTS), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["slot", "n"])

    table = words.mapInArrow(count, "slot long, n long").groupBy("slot").agg(
        F.sum("n").alias("n")).toArrow()  # at most SLOTS rows, whatever the corpus
    totals = np.zeros(SLOTS, np.int32)
    totals[table["slot"].to_numpy()] = np.minimum(table["n"].to_numpy(), np.iinfo(np.int32).max)
    shared = words.sparkSession.sparkContext.broadcast(totals)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id_, grams in zip(batch["id"].to_pylist(), sets(batch), strict=True):
                n, seen = len(grams), shared.value[grams % np.uint64(SLOTS)]
                order = np.lexsort((grams, seen))[:n - int(np.ceil(least * n - 1e-9)) + 1]
                place = np.flatnonzero(seen[order] > 1)  # a shingle counted once has no partner
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[order[place]].view(np.int64)),
                     pa.array(np.full(len(place), id_, np.int64)), pa.array(place),
                     pa.array(np.full(len(place), n, np.int64))]
                    + [pa.array(np.full(len(place), m, np.int64)) for m in signature(grams)],
                    names=["bucket", "id", "place", "size", *_MARKS])

    marks = ", ".join(f"{m} long" for m in _MARKS)
    found = materialize(words.mapInArrow(
        cut, f"bucket long, id long, place long, size long, {marks}"), "near-prefixes")
    several = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return materialize(found.join(several.select("bucket").hint("merge"), "bucket"), "near-shared")


def signature(grams: np.ndarray) -> np.ndarray:
    """One bit for each shingle, at a hashed place; as signed 64-bit numbers."""
    bits = np.zeros(SIGNATURE * 64, np.uint8)
    bits[mix(grams) % np.uint64(len(bits))] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _may(least: float):
    """May the texts of two entries of a prefix bucket be near, by sizes, by what is left of both
    behind the shared shingle, and by their signatures? A bit that one has and the other lacks is a
    shingle or more that the other lacks, so each such bit is one shared shingle less. True in the
    bucket of the first one that two near texts share."""
    one, two = F.col("size"), F.col("lead_size")
    lack = lambda a, b: sum((F.bit_count(F.col(f"{a}{m}").bitwiseAND(
        F.bitwise_not(F.col(f"{b}{m}")))) for m in _MARKS), F.lit(0))
    left = F.least(one - F.col("place"), two - F.col("lead_place"),
                   one - lack("", "lead_"), two - lack("lead_", ""))
    return (F.least(one, two) >= least * F.greatest(one, two) - 1e-6) & (
        left >= least / (1 + least) * (one + two) - 1e-6)


def _bridges(rest: DataFrame, roots: DataFrame, met: DataFrame | None, step: int,
             least: float | None = None):
    """Pairs that may join two classes of one large bucket, and the (bucket, id) of all leaders
    so far; None if no text is left to lead. ``met``: the leaders of the rounds before. With
    ``least``, ``rest`` has place, size and signature too, and pairs that these rule out are left
    out by the join itself, before any words move."""
    more = [] if least is None else ["place", "size", *_MARKS]
    placed = rest.join(roots.hint("merge"), "id", "left").select(
        "bucket", "id", *more, F.coalesce("root", "id").alias("root"))
    divided = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")) \
        .filter("lo != hi").select("bucket")
    members = materialize(placed.join(divided, "bucket"), "near-divided")
    main = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("bucket").agg(F.max(F.struct("n", "root"))["root"].alias("main"))
    outside = members.join(main, "bucket").filter("root != main").drop("main")
    if met is not None:
        outside = outside.join(met, ["bucket", "id"], "left_anti")
    lead = materialize(
        outside.groupBy("bucket", F.pmod(F.xxhash64("id", F.lit(step)),
                                         F.lit(LEADERS << 2 * step)).alias("c"))
        .agg(F.min(F.struct("id", "root", *more)).alias("l"))
        .select("bucket", F.col("l.id").alias("lead"), F.col("l.root").alias("lead_root"),
                *[F.col(f"l.{x}").alias(f"lead_{x}") for x in more]),
        "near-leaders")
    if lead.isEmpty():
        return None
    across = members.join(lead, "bucket").filter("root != lead_root")
    if least is not None:
        across = across.filter(_may(least))
    pairs = across.select(
        F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()
    leaders = lead.select("bucket", F.col("lead").alias("id"))
    return pairs, leaders if met is None else met.union(leaders)


def _words(texts: DataFrame) -> DataFrame:
    """The words of ``texts`` (id, text) as 32-bit ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [(word_ids(t) & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
                   for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(ids, pa.binary())],
                                             names=["id", "words"])

    return materialize(texts.mapInArrow(run, "id long, words binary"), "near-words")


def _verified(pairs: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """The pairs that are near. ``words``: id, words as 32-bit ids."""
    joined = pairs.join(words.select(F.col("id").alias("a"), F.col("words").alias("wa")), "a") \
        .join(words.select(F.col("id").alias("b"), F.col("words").alias("wb")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a leader's pairs come in a row, so its set is built once
        known = lru_cache(KEPT_SETS)(
            lambda words: _with_set(np.frombuffer(words, "<u4").astype(np.uint64)))
        for batch in batches:
            keep = [_alike(known(a), known(b), least) for a, b in zip(
                batch["wa"].to_pylist(), batch["wb"].to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.select("a", "b", "wa", "wb").mapInArrow(check, "a long, b long")


def _merged(roots: DataFrame, added: DataFrame) -> DataFrame:
    """``roots`` (id, root) with the links ``added`` (a, b) joined in, as ``components`` of all
    links would give them. Classes meet through the roots of the new links' ends, so the links
    found before are not gone through again."""
    ends = added.select(F.col("a").alias("id")).union(added.select(F.col("b").alias("id"))).distinct()
    placed = ends.join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    every = roots.select("id", "root").unionByName(placed).distinct()
    hops = added.join(placed.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a") \
        .join(placed.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b") \
        .where("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    if hops.isEmpty():
        return every
    up = components(hops, "near").select(F.col("id").alias("root"), F.col("root").alias("up"))
    return materialize(every.join(up, "root", "left").select(
        "id", F.coalesce("up", "root").alias("root")), "near-roots")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, n_links (near texts its text was found linked
    with), first (true for one row of each class, the one with the smallest id)."""
    return _classes(docs, id_col, text_col, least).drop("hash")


def _classes(docs: DataFrame, id_col: str, text_col: str, least: float) -> DataFrame:
    """``near_classes`` with the hash of each row's text."""
    rows = narrow(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    hashed = rows.withColumn("hash", text_hash())
    sketched = materialize(_sketched(hashed), "near-sketched")
    # one id per different text; copies are told by the hash alone
    groups = materialize(sketched.groupBy("hash").agg(
        F.min("doc_id").alias("low"), F.max("sketches").alias("sketches")), "near-groups")
    groups = materialize(groups.select(
        "hash", "low", "sketches", F.monotonically_increasing_id().alias("id")), "near-texts")
    ids = groups.select("hash", "low", "id")
    pairs, large = _candidates(groups.select("id", "sketches"))
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    holders = ids.join(wanted, "id").select(
        "id", "hash", F.coalesce("low", F.lit(-(1 << 62))).alias("holder"))
    # the texts that are in a pair, by the id and the hash of their first holder; the list grows
    # with the corpus, so it is merged at every size
    texts = hashed.withColumn("holder", F.coalesce("doc_id", F.lit(-(1 << 62)))) \
        .join(holders.hint("merge"), ["holder", "hash"]).select("id", "text")
    words = _words(texts)
    links = materialize(_verified(pairs, words, least).distinct(), "near-links")
    roots = components(links, "near")
    met, step = None, 0
    rest = None if large.isEmpty() else _prefixes(words.join(large, "id"), least)
    while rest is not None and (more := _bridges(rest, roots, met, step, least)):
        (bridges, met), step = more, step + 1
        fresh = materialize(bridges.join(pairs.hint("merge"), ["a", "b"], "left_anti"),
                            "near-bridges")
        pairs = pairs.union(fresh)
        added = materialize(_verified(fresh, words, least), "near-links")
        if not added.isEmpty():
            links = links.union(added)
            roots = _merged(roots, added)
    degree = links.select(F.col("a").alias("id")).union(links.select("b")) \
        .groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    named = ids.join(roots, "id", "left").select(
        "hash", "low", "id", F.coalesce("root", "id").alias("root"))
    heads = named.groupBy("root").agg(F.min(F.struct(
        F.col("low").isNull().alias("none"), "low", "hash")).alias("head"))
    labels = named.join(heads, "root").join(degree, "id", "left").select(
        "hash", F.col("head.low").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.col("head.hash") == F.col("hash")).alias("leads"), "low")
    labels = materialize(labels, "near-labels")
    return sketched.select("doc_id", "hash").join(labels, "hash").select(
        "doc_id", "hash", "class_id", "n_links",
        (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("low"))).alias("first"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of which no earlier near copy exists: one row of each class, all columns.

    Rows that agree in id and text are one document, of which one row stays.
    """
    classes = _classes(docs, id_col, text_col, SIMILARITY).filter("first")
    first = materialize(classes.groupBy(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"))
                        .agg(F.count(F.lit(1)).alias("n")), "near-first")
    keyed = docs.withColumns({"__key": F.col(f"`{id_col}`").cast("long"), "__text": text_hash(
        f"`{text_col}`")})
    kept = keyed.join(first, F.col("__key").eqNullSafe(F.col("__id"))
                      & (F.col("__text") == F.col("__hash")), "left_semi")
    if not first.filter("n > 1").isEmpty():
        kept = kept.dropDuplicates(["__key", "__text"])
    return kept.drop("__key", "__text")
