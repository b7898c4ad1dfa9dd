"""Phrases that occur together more often than apart, by best-first branch-and-bound growth.

A phrase of 2 to 4 words scores 2,000,000 * a / (l + r) at its worst cut into a first part and a rest
that occur l and r times, a being its own count. Whatever is put behind a phrase p with the first word
w, the longer phrase occurs at most f(p) times and its cut behind w has l = f(w) and r >= a; so its
score is at most 2,000,000 * f(p) / (f(w) + f(p)). The same holds from the other end. These bounds come
from counts of the level before, and no phrase below the bound is grown.

Words and pairs are counted whole; every pair is part of a longer phrase's cuts. Then per language the
score of the 4000th pair is the first bar: three-word phrases are counted where the prefix or the suffix
can still reach the bar, four-word ones where both can. A phrase at or above the bar is also extended by
one word at either side, whatever the bound, because a longer phrase with four fifths of its count drops
it (and if any longer one does, one that is a single word longer does). All phrases at or above the bar
are then known with their fate. If 2000 of a language survive, they and their ties are settled; if not,
its frontier is opened further (eight times as many pairs) until they are or the bar is 0.

Counting: each task turns slices of text into word numbers, counts the phrases of a slice and sends
(language, word hashes, count), which Spark adds up. Which phrases of the level before are frequent or
may grow is known to the tasks by bit sets of fixed size over hashes; a false positive costs a count that
is thrown away later, never a wrong result. Words are told apart by 64-bit hashes; two words with one
hash are an error that the word table reveals. Scores are taken in decimals, which do not overflow.

Null texts are empty, a null language is ``und``, repeated rows count each. Nothing is capped: a language
with fewer than 2000 survivors returns them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_engine.operators.joins import join_keyed, join_spread

from .common import materialize, mix

SCALE, LEAST, COVER, KEPT = 2_000_000, 30, 80, 2000
#: Pairs whose score sets the first bar, and how many more in each further round.
FIRST, FURTHER = 4000, 8
#: Bits of a set (a power of two; 8 MB), whatever the corpus; bytes of text counted at once.
BITS = 1 << 26
SLICE_BYTES = 8 << 20
_BUCKET = 1 << 15
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b
              for b in range(256))


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), seed=1))


def _slots(lang: np.ndarray | np.uint64, words: list[np.ndarray]) -> np.ndarray:
    """Places of phrases in a bit set."""
    key = lang
    for w in words:
        key = mix(key ^ w)
    return key & np.uint64(BITS - 1)


class _Slice:
    """Words of texts of one language as numbers; ``-1`` parts pieces and documents."""

    def __init__(self, texts: list[str]):
        data = b".".join(t.encode() for t in texts).translate(_FOLD).replace(b".", b" . ")
        cells = pa.array([data], pa.large_binary())
        coded = pc.list_flatten(pc.split_pattern(cells, b" ")).dictionary_encode()
        self.words: list[bytes] = coded.dictionary.to_pylist()
        ids = coded.indices.to_numpy()
        special = {w: i for i, w in enumerate(self.words) if w in (b"", b".")}
        ids = ids[ids != special[b""]] if b"" in special else ids
        self.hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words], np.uint64)
        self.ids = np.where(ids == special.get(b".", -1), -1, ids).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Slice]]:
    held: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if not text:
                continue
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text)
            total += len(text)
            if size[lang] >= SLICE_BYTES:
                total -= size.pop(lang)
                yield lang, _Slice(held.pop(lang))
            elif total >= 2 * SLICE_BYTES:
                total = 0
                size.clear()
                while held:
                    yield (at := next(iter(held))), _Slice(held.pop(at))
    while held:
        yield (at := next(iter(held))), _Slice(held.pop(at))


def _batch(lang: str, columns: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
    n = len(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int64)))]
        + [pa.array(c.view(np.int64)) for c in columns] + [pa.array(counts.astype(np.int64))],
        names=["lang", *[f"w{i + 1}" for i in range(len(columns))], "f"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, s in _slices(batches):
        counts = np.bincount(s.ids[s.ids >= 0], minlength=len(s.words))
        at = np.flatnonzero(counts)
        yield _batch(lang, [s.hashes[at]], counts[at]).append_column(
            "word", pa.array([s.words[i] for i in at.tolist()], pa.binary()))


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of ``codes`` (negative: none) and the place of each code among them."""
    if not len(codes):
        return codes, codes
    values, at = np.unique(codes, return_inverse=True)
    drop = int(np.searchsorted(values, 0))
    return values[drop:], at - drop


def _counter(size: int, sets: dict[str, object]):
    """Counts phrases of ``size`` words. ``sets``: broadcast bit sets of the shorter ones."""
    def has(name: str, slots: np.ndarray) -> np.ndarray:
        bits = sets[name].value
        return (bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, s in _slices(batches):
            seed, h = _lang_hash(lang), s.hashes
            known = np.append(has("words", _slots(seed, [h])), False)
            ids = np.where(known[s.ids], s.ids, -1)
            base = np.int64(len(s.words))
            codes = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * base + ids[1:], -1)
            if size > 2:  # from pairs to triples
                pairs, at = _runs(codes)
                left, right = pairs // base, pairs % base
                slots = _slots(seed, [h[left], h[right]])
                often = has("pairs", slots)
                grows = np.append(often & has("pairs_on", slots), False)
                ends = np.append(often & has("pairs_back", slots), False)
                often = np.append(often, False)
                ok = often[at[:-1]] & often[at[1:]]
                if size == 3:
                    ok &= grows[at[:-1]] | ends[at[1:]]
                codes = np.where(ok, at[:-1] * base + np.where(ids[2:] < 0, 0, ids[2:]), -1)
            if size == 3:
                triples, counts = np.unique(codes[codes >= 0], return_counts=True)
                pair, third = triples // base, triples % base
                yield _batch(lang, [h[left[pair]], h[right[pair]], h[third]], counts)
            elif size == 4:  # from triples to fours
                triples, at3 = _runs(codes)
                pair, third = triples // base, triples % base
                slots = _slots(seed, [h[left[pair]], h[right[pair]], h[third]])
                on, back, held = (np.append(has(f"triples_{x}", slots), False)
                                  for x in ("on", "back", "held"))
                first, second = at3[:-1], at3[1:]
                ok = (first >= 0) & (second >= 0) & (
                    (on[first] & back[second]) | held[first] | held[second])
                codes = np.where(ok, first * base + np.where(ids[3:] < 0, 0, ids[3:]), -1)
                fours, counts = np.unique(codes[codes >= 0], return_counts=True)
                t, fourth = fours // base, fours % base
                yield _batch(lang, [h[left[pair[t]]], h[right[pair[t]]], h[third[t]], h[fourth]],
                             counts)
            else:
                found, counts = np.unique(codes[codes >= 0], return_counts=True)
                yield _batch(lang, [h[found // base], h[found % base]], counts)

    return count


def _names(size: int) -> list[str]:
    return [f"w{i + 1}" for i in range(size)]


def _counted(texts: DataFrame, size: int, sets: dict[str, object], least: int) -> DataFrame:
    """Phrases of ``size`` words that occur ``least`` times or more, of those that are counted."""
    names = _names(size)
    schema = ", ".join(["lang string", *[f"{n} long" for n in names], "f long"])
    return texts.mapInArrow(_counter(size, sets), schema).groupBy("lang", *names).agg(
        F.sum("f").alias("f")).filter(F.col("f") >= least)


def _bit_set(phrases: DataFrame, size: int):
    """Broadcast bit set of the phrases: at most BITS / 8 bytes, put together in Spark."""
    names = _names(size)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch["lang"].dictionary_encode()
            seeds = np.array([_lang_hash(x) for x in langs.dictionary.to_pylist()], np.uint64)
            if batch.num_rows:
                slots = _slots(seeds[langs.indices.to_numpy()],
                               [batch[n].to_numpy().view(np.uint64) for n in names])
                yield pa.RecordBatch.from_arrays(
                    [pa.array((slots // _BUCKET).astype(np.int64)),
                     pa.array((slots % _BUCKET).astype(np.int64))], names=["bucket", "bit"])

    rows = phrases.select("lang", *names).mapInArrow(place, "bucket long, bit long") \
        .repartition("bucket").groupBy("bucket").agg(
            F.bitmap_construct_agg("bit").alias("bits")).toArrow()
    bits = np.zeros(BITS // 8, np.uint8)
    for bucket, part in zip(rows["bucket"].to_pylist(), rows["bits"].to_pylist(), strict=True):
        bits[bucket * _BUCKET // 8:][:_BUCKET // 8] = np.frombuffer(part, np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(bits)


def _score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(2,000,000 a / (l + r)) in decimals: the product may pass 64 bits."""
    return F.expr(f"cast({a} as decimal(20, 0)) * {SCALE} div "
                  f"(cast({l} as decimal(20, 0)) + cast({r} as decimal(20, 0)))")


def _scored(rows: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """Adds a, l, r and score of the lowest cut (the first of equal ones), and the two bounds."""
    worst = F.array_min(F.array(*[
        F.struct(_score("f", l, r).alias("score"), F.lit(k).alias("k"),  # noqa: E741
                 F.col(l).alias("l"), F.col(r).alias("r"))
        for k, (l, r) in enumerate(cuts, 1)]))  # noqa: E741
    return rows.withColumn("__cut", worst).select(
        "*", "__cut.score", "__cut.l", "__cut.r", _score("f", cuts[0][0], "f").alias("on"),
        _score("f", "f", cuts[-1][1]).alias("back")).drop("__cut")


def _renamed(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    return rows.select("lang", *[F.col(a).alias(b) for a, b in columns.items()])


def _pairs(texts: DataFrame, words: DataFrame, least: int) -> DataFrame:
    often = words.filter(F.col("f") >= least)
    found = materialize(_counted(texts, 2, {"words": _bit_set(often, 1)}, least), "phrase-pairs")
    found = materialize(join_spread(found, _renamed(often, {"w1": "w1", "f": "f1"}),
                                    ["lang", "w1"]), "phrase-pairs")
    found = join_spread(found, _renamed(often, {"w1": "w2", "f": "f2"}), ["lang", "w2"])
    return materialize(_scored(found, [("f1", "f2")]), "phrase-pairs")


def _triples(texts: DataFrame, pairs: DataFrame, sets: dict[str, object], least: int) -> DataFrame:
    found = materialize(_counted(texts, 3, sets, least), "phrase-triples")
    found = materialize(join_spread(found, _renamed(
        pairs, {"w1": "w1", "w2": "w2", "f": "f12", "f1": "f1"}), ["lang", "w1", "w2"]),
        "phrase-triples")
    found = join_spread(found, _renamed(
        pairs, {"w1": "w2", "w2": "w3", "f": "f23", "f2": "f3"}), ["lang", "w2", "w3"])
    return materialize(_scored(found, [("f1", "f23"), ("f12", "f3")]), "phrase-triples")


def _fours(texts: DataFrame, triples: DataFrame, sets: dict[str, object], least: int) -> DataFrame:
    """Fours of which a part was not counted cannot reach the bar; they have no score and are
    there for the phrases inside them."""
    found = materialize(_counted(texts, 4, sets, least), "phrase-fours")
    found = materialize(join_spread(found, _renamed(
        triples, {"w1": "w1", "w2": "w2", "w3": "w3", "f": "f123", "f1": "f1", "f12": "f12"}),
        ["lang", "w1", "w2", "w3"], "left"), "phrase-fours")
    found = join_spread(found, _renamed(
        triples, {"w1": "w2", "w2": "w3", "w3": "w4", "f": "f234", "f23": "f34", "f3": "f4"}),
        ["lang", "w2", "w3", "w4"], "left")
    known = F.col("f123").isNotNull() & F.col("f234").isNotNull()
    scored = _scored(found, [("f1", "f234"), ("f12", "f34"), ("f123", "f4")])
    return materialize(scored.withColumn("score", F.when(known, F.col("score"))), "phrase-fours")


def _inside(longer: DataFrame, size: int, into: int) -> DataFrame:
    """The largest count of a longer phrase around each phrase of ``into`` words inside it."""
    spans = F.array(*[F.struct(*[F.col(f"w{i + j + 1}").alias(f"w{j + 1}") for j in range(into)])
                      for i in range(size - into + 1)])
    return longer.select("lang", "f", F.explode(spans).alias("p")).groupBy(
        "lang", *[F.col(f"p.{n}").alias(n) for n in _names(into)]).agg(F.max("f").alias("around"))


def _survivors(levels: dict[int, DataFrame], bars: DataFrame) -> DataFrame:
    """lang, w1 to w4, a, l, r, score of the phrases at or above their language's bar that no
    longer phrase covers."""
    out = []
    for size, rows in levels.items():
        names = _names(size)
        rows = join_keyed(rows, bars, ["lang"]).filter(F.col("score") >= F.col("bar"))
        if size + 1 in levels:
            rows = rows.join(_inside(levels[size + 1], size + 1, size), ["lang", *names], "left") \
                .filter(F.coalesce(100 * F.col("around") < COVER * F.col("f"), F.lit(True)))
        out.append(rows.select("lang", *names, *[F.lit(None).cast("long").alias(n)
                                                 for n in _names(4)[size:]],
                               F.col("f").alias("a"), "l", "r", "score"))
    all_rows = out[0]
    for rows in out[1:]:
        all_rows = all_rows.unionByName(rows)
    return all_rows


def _bars(pairs: DataFrame, first: int) -> DataFrame:
    """The score of a language's pair number ``first``, or 0 where it has fewer."""
    ranked = pairs.select("lang", "score", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("score"))).alias("rk"))
    top = ranked.filter(F.col("rk") <= first).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
    return top.select("lang", F.when(F.col("n") < first, 0).otherwise(
        F.col("score")).cast("long").alias("bar"))


def _grown(texts: DataFrame, pairs: DataFrame, bars: DataFrame, least: int) -> DataFrame:
    """Survivors at or above the bars."""
    near = join_keyed(pairs, bars, ["lang"])
    sets = {"words": _bit_set(near.select("lang", "w1").union(near.select("lang", "w2")), 1),
            "pairs": _bit_set(near, 2),
            "pairs_on": _bit_set(near.filter(F.col("on") >= F.col("bar")), 2),
            "pairs_back": _bit_set(near.filter(F.col("back") >= F.col("bar")), 2)}
    triples = _triples(texts, pairs, sets, least)
    near = join_keyed(triples, bars, ["lang"])
    sets |= {"triples_on": _bit_set(near.filter(F.col("on") >= F.col("bar")), 3),
             "triples_back": _bit_set(near.filter(F.col("back") >= F.col("bar")), 3),
             "triples_held": _bit_set(near.filter(F.col("score") >= F.col("bar")), 3)}
    fours = _fours(texts, triples, sets, least)
    return materialize(_survivors({2: pairs, 3: triples, 4: fours}, bars), "phrase-survivors")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                 least: int = LEAST, kept: int = KEPT, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``kept`` best phrases of every language."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    words = materialize(texts.mapInArrow(
        _count_words, "lang string, w1 long, f long, word binary").groupBy("lang", "w1").agg(
            F.sum("f").alias("f"), F.min("word").alias("word"), F.max("word").alias("other")),
        "phrase-words")
    if not words.filter("word != other").isEmpty():
        raise ValueError("two words share a 64-bit hash")
    totals = materialize(words.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    pairs = _pairs(texts, words, least)
    settled, open_pairs, open_texts = None, pairs, texts
    while True:
        bars = materialize(_bars(open_pairs, first), "phrase-bars")
        found = _grown(open_texts, open_pairs, bars, least)
        n = found.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        state = materialize(bars.join(n, "lang", "left").select("lang", (
            (F.col("bar") == 0) | (F.coalesce("n", F.lit(0)) >= kept)).alias("done")), "phrase-state")
        rows = join_keyed(found, state.filter("done").select("lang"), ["lang"], "left_semi")
        settled = rows if settled is None else settled.unionByName(rows)
        rest = state.filter("not done").select("lang")
        if rest.isEmpty():
            break
        first *= FURTHER
        open_pairs = join_keyed(pairs, rest, ["lang"], "left_semi")
        open_texts = join_keyed(texts, rest, ["lang"], "left_semi")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    top = settled.withColumn("at", F.rank().over(best)).filter(F.col("at") <= kept).drop("at")
    for name in _names(4):
        top = top.join(words.select("lang", F.col("w1").alias(name),
                                    F.col("word").cast("string").alias(f"t{name}")),
                       ["lang", name], "left")
    top = top.select("lang", F.concat_ws(" ", *[f"t{n}" for n in _names(4)]).alias("phrase"),
                     "a", "l", "r", "score")
    top = top.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))) \
        .filter(F.col("rank") <= kept)
    return join_keyed(top, totals, ["lang"]).select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
