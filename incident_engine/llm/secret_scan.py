"""Secrets in texts: fixed patterns, and windows of high entropy with an allow-list.

The base patterns find key assignments, access keys and long hexadecimal digests. Beside them each
character class of ``CLASSES`` is looked at by itself: every maximal run of its characters that is
as long as the class's window is a candidate string, and a window of that many characters slides
over it. The counts of the characters in the window change by one in and one out, and with them the
sum of c * log2(c), so that a step costs the same whatever the window. Windows whose Shannon entropy
reaches the class's bits are marked; marked windows that overlap or touch make one span. Candidate
strings that an allow-list pattern fits as a whole (identifiers, paths, dates, UUIDs, examples) give
no such span; spans of the base patterns always stay.

Sums are whole numbers in units of 2 ** -20 bits, so that every engine takes the same decision.
Offsets are code points, the end exclusive. Rows are independent: nothing is shuffled. Null and
empty texts have no spans; a repeated row is scanned as often as it is there; of other columns none
is read. A very long text costs time in proportion to its length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow

KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")


def _either_case(words: tuple[str, ...]) -> str:
    """Letters in either case, spelled out: a case flag would also fold letters beyond ASCII."""
    return "|".join(re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", w) for w in words)


#: Base kind, (pattern, the group that must be long enough, its least length), in order of output.
BASE: dict[str, tuple[str, int, int]] = {
    "assign": (f"({_either_case(KEYWORDS)})"
               r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    "hex": ("[0-9a-f]+", 0, 32),
}
#: The base kinds that are runs of a class: their characters and least length. A run that is too
#: short holds no longer one, so asking for the length in the pattern finds the same spans.
RUNS = {"access": ("A-Z0-9", 16), "hex": ("0-9a-f", 32)}
#: Class, (its characters (ASCII), window, least bits a character).
CLASSES: dict[str, tuple[str, int, float]] = {
    "high_hex": ("0-9A-Fa-f", 24, 3.0),
    "high_base36": ("0-9a-z", 20, 3.7),
    "high_base64": ("A-Za-z0-9+/=_-", 20, 3.9),
}
#: A candidate that one of these fits as a whole is no secret.
ALLOWED = (
    r"[A-Za-z+/=_-]+",  # words, identifiers and paths: no digit
    r"[0-9]+([-/_][0-9]+)*",  # numbers and dates
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    r"[A-Za-z0-9+/=_-]*([Ee]xample|EXAMPLE|[Ss]ample|[Pp]laceholder)[A-Za-z0-9+/=_-]*",
    r"[A-Za-z]*(abcdefghijklmnop|ABCDEFGHIJKLMNOP|0123456789)[A-Za-z0-9]*",
)
UNIT = 1 << 20
_SPANS = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"


def weights(window: int) -> list[int]:
    """c * log2(c) in units, for c characters of one kind in the window."""
    return [0] + [round(c * math.log2(c) * UNIT) for c in range(1, window + 1)]


def most(window: int, bits: float) -> int:
    """The largest sum of weights at which a window still has ``bits`` a character."""
    return math.floor((window * math.log2(window) - window * bits) * UNIT)


def rich_windows(run: str, window: int, bits: float) -> Iterator[tuple[int, int]]:
    """Joined spans of the windows of ``run`` that reach ``bits``."""
    weight, limit = weights(window), most(window, bits)
    up = [b - a for a, b in zip(weight, weight[1:], strict=False)] + [0]
    counts = dict.fromkeys(run, 0)
    total, start, end = 0, -1, -1
    for i, new in enumerate(run):
        if i >= window:
            old = run[i - window]
            counts[old] -= 1
            total -= up[counts[old]]
        total += up[counts[new]]
        counts[new] += 1
        at = i - window + 1
        if at >= 0 and total <= limit:
            if start < 0:
                start = at
            elif at > end:
                yield start, end
                start = at
            end = i + 1
    if start >= 0:
        yield start, end


def _holds(chars: str) -> np.ndarray:
    pattern = re.compile(f"[{chars}]")
    return np.array([b < 128 and bool(pattern.match(chr(b))) for b in range(256)])


class Scanner:
    """Finds the spans of one text after another.

    Only what can hold a span is searched by patterns: the text, where one of the keywords stands in
    it, and its runs of characters of any class that are as long as the shortest span.
    """

    def __init__(self, classes=CLASSES, allowed=ALLOWED):
        pattern, group, least = BASE["assign"]
        self.assign, self.group, self.assign_least = re.compile(pattern), group, least
        self.stems = [w.replace("_?", x).encode() for w in KEYWORDS for x in ("", "_")
                      if x == "" or "_?" in w]
        whole = {k: (chars, least) for k, (chars, least) in RUNS.items()}
        self.base = [(rank, kind, re.compile(f"{BASE[kind][0][:-1]}{{{BASE[kind][2] - skip},}}"))
                     for rank, (kind, skip) in enumerate((("access", 4), ("hex", 0)), 1)]
        self.classes = [(rank, kind, re.compile(f"[{chars}]{{{window},}}"), window, bits)
                        for rank, (kind, (chars, window, bits)) in enumerate(classes.items(), 3)]
        self.allowed = re.compile("|".join(f"(?:{p})" for p in allowed)) if allowed else None
        whole |= {k: (chars, window) for k, (chars, window, _) in classes.items()}
        self.run = np.logical_or.reduce([_holds(chars) for chars, _ in whole.values()])
        self.least = min(least for _, least in whole.values())

    def _runs(self, data: bytes) -> Iterator[tuple[int, str]]:
        """(code point offset, run) of the long runs; all their characters are ASCII."""
        inside = np.zeros(len(data) + 2, np.int8)
        raw = np.frombuffer(data, np.uint8)
        inside[1:-1] = self.run[raw]
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        at = passed = 0
        for i in np.flatnonzero(ends - starts >= self.least).tolist():
            start, end = int(starts[i]), int(ends[i])
            passed += int(np.count_nonzero((raw[at:start] & 0xC0) != 0x80))
            at = start
            yield passed, data[start:end].decode()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start, then by kind in the order of BASE and of the classes."""
        data, found = text.encode(), []
        low = data.lower()
        if any(stem in low for stem in self.stems):
            found += [(m.start(), 0, "assign", m.end()) for m in self.assign.finditer(text)
                      if m.end(self.group) - m.start(self.group) >= self.assign_least]
        for at, run in self._runs(data):
            for rank, kind, pattern in self.base:
                found += [(at + m.start(), rank, kind, at + m.end())
                          for m in pattern.finditer(run)]
            for rank, kind, pattern, window, bits in self.classes:
                for m in pattern.finditer(run):
                    if not (self.allowed and self.allowed.fullmatch(m.group())):
                        found += [(at + m.start() + a, rank, kind, at + m.start() + b)
                                  for a, b in rich_windows(m.group(), window, bits)]
        return [(kind, start, end) for start, _, kind, end in sorted(found)]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 classes: dict[str, tuple[str, int, float]] = CLASSES,
                 allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """doc_id and spans (kind, start, end) of every row."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allowed)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                   ("end", pa.int64())]))
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True))
                      for s in scanner.spans(t)] if t else [] for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(spans, kind)],
                                             names=["doc_id", "spans"])

    return narrow(docs, id_col, text_col).mapInArrow(scan, _SPANS)


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           classes: dict[str, tuple[str, int, float]] = CLASSES,
           allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """doc_id and text with every character inside a span replaced by an asterisk."""
    def hide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allowed)
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                parts, at = [], 0
                for _, start, end in scanner.spans(text) if text else []:
                    if end > at:
                        start = max(start, at)
                        parts += [text[at:start], "*" * (end - start)]
                        at = end
                out.append("".join([*parts, text[at:]]) if parts else text)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())],
                                             names=["doc_id", "text"])

    return narrow(docs, id_col, text_col).mapInArrow(hide, "doc_id long, text string")


def secret_report(found: DataFrame) -> DataFrame:
    """doc_id, base spans by kind counted, the digest of the base spans, and all spans as text."""
    def listed(of: str) -> str:
        return f"array_join(transform({of}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"

    kinds = ", ".join(f"'{k}'" for k in BASE)
    return found.select("doc_id", *[
        F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}")
        for k in BASE],
        F.sha2(F.expr(listed(f"filter(spans, s -> s.kind in ({kinds}))")), 256)
        .alias("base_sha256"), F.expr(listed("spans")).alias("spans"))
