"""Spelling variants: words one edit apart, found by scanning sorted lists with a banded matrix.

Words are counted first: runs of letters, A-Z lower-cased, of which one occurrence in 97, chosen by the
checksum of document and run, loses a letter. The vocabulary holds the words of at least 5 code points
that occur 3 times or more.

A list of words in order is scanned for every word of it at once: walking from one word of the list to
the next, the rows of the edit matrices that belong to their common prefix are reused and only the rows
behind it are computed, each from the row before and three cells wide. A row holds only the words that
are still within one edit; where none is left, or for a word that is left out, all words of the list
with that prefix are skipped.

Lists: two words one edit apart agree before and behind the place of the edit. A word of m code points
is cut into segments of one or two; with every segment of the shorter word the pair's edit may fall
into, both words share all that stands before and behind. So words are dealt by (m, segment, what stands
before, what stands behind), once with their own length as m and once as the word that is one longer.
Their prefixes are then equal, so the scan starts behind it, on parts of at most two or three code
points: a list cannot be longer than 58 ** 2 + 58 ** 3 words, whatever the corpus. A pair is taken in
the one segment where its common prefix ends, so that every pair counts once.

A word's form is its near word of largest count, the first in code-point order of equal ones, if that
count is at least twice its own; its root is the end of the chain of forms, whose counts at least double
at each step, found by following forms of forms. Hot forms are spread in those joins.

Null and empty texts have no words; a null id counts as empty text; repeated rows count each. An empty
vocabulary gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_engine.operators.joins import join_spread

from .common import materialize, narrow

WORD = re.compile("[A-Za-zÀ-ÿ]+")
#: One occurrence in so many loses a letter; least length and count of a word; the form's lead.
DROP_ONE_IN, LEAST_LENGTH, LEAST_COUNT, LEAD = 97, 5, 3, 2
SEGMENT = 2
#: Different words that one task holds before it sends its counts on.
HELD_WORDS = 200_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LISTED = "m int, seg int, before string, behind string, part string, last boolean, n long"
_FOUND = "word string, n_near long, form_n long, form string"


def words_of(doc_id: int | None, text: str) -> Counter:
    """Words of a text and their counts."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out = Counter(WORD.findall(text.encode().translate(_LOWER).decode()))
    hit = [w for w in out if not zlib.crc32(w.encode(), start) % DROP_ONE_IN]
    for word, n in [(w, out.pop(w)) for w in hit]:
        at = zlib.crc32(word.encode(), start) % len(word)
        out[word[:at] + word[at + 1:]] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(),
                                    strict=True):
                for word, n in words_of(doc_id, text).items() if text else ():
                    if len(word) >= least_length:
                        seen[word] += n
                if len(seen) >= HELD_WORDS:
                    yield flush()
        yield flush()

    return narrow(docs, id_col, text_col).mapInArrow(count, "word string, n long").groupBy(
        "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every list a word belongs to."""
    for batch in batches:
        rows = []
        for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist(), strict=True):
            size = len(word)
            for m in (size, size - 1):
                for seg, at in enumerate(range(0, m, SEGMENT)):
                    tail = max(m - at - SEGMENT, 0)
                    rows.append((m, seg, word[:at], word[size - tail:], word[at:size - tail],
                                 tail == 0, n))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(),
                    pa.int64()), strict=True)],
                names=["m", "seg", "before", "behind", "part", "last", "n"])


def common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class _Row:
    """A row of all matrices. ``exact``: words that begin with the prefix. ``by``: words one edit off,
    by the code points that would keep them so. ``ends``: words one edit from the prefix itself.
    """

    __slots__ = ("by", "ends", "exact")

    def __init__(self, exact: list[tuple]):
        self.exact, self.by, self.ends = exact, {}, []


def _next_row(row: _Row, new: str, d: int) -> _Row:
    """Row ``d`` for a prefix that ends with ``new``. A state (i, word, size, a, b, c) holds the edits
    to the first d - 1, d and d + 1 code points; words stand between fillers that match nothing."""
    out = _Row([])
    by = out.by
    for i, word, size, a, b, c in (row.exact + row.by[new] if new in row.by else row.exact):
        before, here, behind = word[d - 1:d + 2]
        p = a if before == new else a + 1
        if b < p:
            p = b + 1 if b + 1 < p else p
        q = b if here == new else b + 1
        if c < q:
            q = c + 1 if c + 1 < q else q
        if p < q:
            q = p + 1 if p + 1 < q else q
        r = c if behind == new else c + 1
        if q < r:
            r = q + 1 if q + 1 < r else r
        state = (i, word, size, p, q, r)
        if q == 0:
            out.exact.append(state)
        left = size - d
        if p == 1:
            if left == -1:
                out.ends.append(i)
            if q:
                by.setdefault(here, []).append(state)
        if q == 1:
            if left == 0:
                out.ends.append(i)
            if p != 1 or behind != here:
                by.setdefault(behind, []).append(state)
        if r == 1:
            if left == 1:
                out.ends.append(i)
            far = word[d + 2]
            if q and (p != 1 or far != here) and (q != 1 or far != behind):
                by.setdefault(far, []).append(state)
    return out


def scan(parts: list[str], asked: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs (i, j): ``parts[j]`` is exactly one edit from ``parts[i]``, for the i that are asked.
    ``parts`` are different and in order."""
    rows = [_Row([(i, f"\0{parts[i]}\0\0\0", len(parts[i]), 2, 0, 1) for i in asked])]
    rows[0].ends = [i for i in asked if len(parts[i]) == 1]
    before = ""
    for j, part in enumerate(parts):
        del rows[common_prefix(before, part) + 1:]
        before = part
        # rows may end early: no word is within one edit of the prefix there, nor of a longer one
        while len(rows) <= len(part) and (rows[-1].exact or rows[-1].by):
            rows.append(_next_row(rows[-1], part[len(rows) - 1], len(rows)))
        if len(rows) > len(part):
            for i in rows[-1].ends:
                yield i, j


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word and list: how many near words, and the best of them. Rows come list by list."""
    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    out: list[tuple] = []
    for (m, _, before, behind), group in groupby(rows(), key=lambda r: r[:4]):
        entries = [r[4:] for r in group]
        if len(entries) < 2:
            continue
        parts = [e[0] for e in entries]
        short = m - len(before) - len(behind)
        last = entries[0][1]
        best: dict[int, tuple[int, int, int]] = {}

        def meet(i: int, j: int) -> None:
            n, top, at = best.get(i, (0, -1, 0))
            here = entries[j][2]
            first = here == top and parts[j] + behind < parts[at] + behind
            best[i] = (n + 1, here, j) if here > top or first else (n + 1, top, at)

        for i, j in scan(parts, [i for i, p in enumerate(parts) if len(p) == short]):
            if not last and common_prefix(parts[i], parts[j]) >= short:
                continue  # the edit falls into a later segment
            meet(i, j)
            if len(parts[j]) > short:
                meet(j, i)
        out += [(before + parts[i] + behind, n, top, before + parts[at] + behind)
                for i, (n, top, at) in best.items()]
        if len(out) >= 10_000:
            yield _found(out)
            out = []
    if out:
        yield _found(out)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=["word", "n_near", "form_n", "form"])


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, form_n, form: the number of near words and the best one, where there is one."""
    keys = ["m", "seg", "before", "behind"]
    listed = words.mapInArrow(_listed, _LISTED).select(*keys, "part", "last", "n")
    # a list of one word needs no scan, but to know that it must be gathered all the same
    found = listed.repartition(*keys).sortWithinPartitions(*keys, "part").mapInArrow(_near, _FOUND)
    best = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form"))).alias("best"))
    return best.select("word", "n_near", (-F.col("best.n")).alias("form_n"), "best.form")


def roots(forms: DataFrame, rounds: int = 64) -> DataFrame:
    """word, root for words (word, form) that have a form: forms are followed to the last one, each
    round doubling the steps taken."""
    steps = materialize(forms.select("word", F.col("form").alias("root")), "spelling-steps")
    for _ in range(rounds):
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = materialize(join_spread(steps, onward, ["root"], "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "spelling-steps")
        steps = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return steps
    raise RuntimeError(f"forms did not end in {rounds} rounds")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lead: int = LEAD) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = materialize(vocabulary(docs, id_col, text_col), "spelling-words")
    near = words.join(near_words(words), "word", "left")
    held = F.col("form_n") >= lead * F.col("n")
    near = materialize(near.select(
        "word", F.when(held, F.col("form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(held, F.col("form_n")).alias("form_n")), "spelling-near")
    last = roots(near.filter("form is not null"))
    return near.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
