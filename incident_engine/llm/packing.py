"""Pack tokenised documents into sequences of a fixed size (swap-based local search).

Documents are cut into pieces; pieces go to groups of bounded size by hash, and each group is
packed in a task of its own: best fit in order of falling length, then local search between
underfull bins. The search tries to empty the bin that holds least: a piece moves to the bin it
fits best, or changes places with one or two smaller pieces of another bin so that the other bin
is fuller afterwards. Every accepted step raises the sum of the squared fills, so it ends.

Bins still underfull after a level are opened again and their pieces packed in the next level
with far fewer groups, so that what the groups leave over meets in the end. No level gathers
more than one group per task, and each level is written to the shared folder.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, narrow
from .tokens import encoder

CAPACITY = 4096
#: Pieces of one group, on average.
GROUP_PIECES = 16_384
#: A bin filled to this share is closed; others are packed again in the next level.
CLOSED = 0.985
#: Bins which the search tries to empty, least filled first, per pass and the number of passes.
SOURCES, PASSES = 256, 3
LEVELS = 4

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document. Null texts count as empty: the end id alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(),
                                   words.encode(batch["text"].to_pylist()), strict=True):
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return narrow(docs).mapInArrow(run, _PIECES)


class Bins:
    """Bins of one group: contents as (length, item), sorted by length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[tuple[int, int]]] = []
        self.room: list[int] = []
        self.with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r is set if a bin may have r left

    def _note(self, b: int) -> None:
        r = self.room[b]
        if r:
            self.with_room[r].append(b)
            self.rooms |= 1 << r

    def best(self, length: int, but: int = -1) -> int:
        """The bin with the least room that still holds ``length``, or -1."""
        least = length
        while True:
            up = self.rooms >> least
            if not up:
                return -1
            r = least + (up & -up).bit_length() - 1
            stack = self.with_room[r]
            while stack and self.room[stack[-1]] != r:
                stack.pop()  # an old note
            if not stack:
                self.rooms &= ~(1 << r)
                continue
            b = next((x for x in reversed(stack) if x != but and self.room[x] == r), -1)
            if b >= 0:
                return b
            least = r + 1

    def put(self, b: int, length: int, item: int) -> None:
        insort(self.items[b], (length, item))
        self.room[b] -= length
        self._note(b)

    def take(self, b: int, at: int) -> tuple[int, int]:
        length, item = self.items[b].pop(at)
        self.room[b] += length
        self._note(b)
        return length, item

    def add(self, length: int, item: int) -> None:
        b = self.best(length)
        if b < 0:
            b = len(self.items)
            self.items.append([])
            self.room.append(self.capacity)
        self.put(b, length, item)

    def _swap(self, b: int, at: int) -> bool:
        """Change the piece for one or two smaller ones of a bin at least as full."""
        length, fill = self.items[b][at][0], self.capacity - self.room[b]
        for other in self.near(b):
            room, there = self.room[other], self.items[other]
            if self.capacity - room < fill:
                continue
            # one for one: the smallest partner that leaves the other bin no fuller than full
            k = bisect_right(there, (length - room - 1, 1 << 62))
            one = there[k][0] if k < len(there) and there[k][0] < length else None
            two, lo, hi = None, 0, len(there) - 1
            while lo < hi:  # two for one: the smallest sum not under what the room asks for
                total = there[lo][0] + there[hi][0]
                if total >= length - room:
                    if total < length and (two is None or total < two[0]):
                        two = (total, lo, hi)
                    hi -= 1
                else:
                    lo += 1
            if one is None and two is None:
                continue
            mine = self.take(b, at)
            if two is None or one is not None and one <= two[0]:
                back = [self.take(other, k)]
            else:
                back = [self.take(other, two[2]), self.take(other, two[1])]
            self.put(other, *mine)
            for piece in back:
                self.put(b, *piece)
            return True
        return False

    def near(self, b: int) -> list[int]:
        """Some underfull bins, fullest first."""
        found, rooms = [], self.rooms
        while rooms and len(found) < 24:
            r = (rooms & -rooms).bit_length() - 1
            rooms &= rooms - 1
            found += [x for x in self.with_room[r][-4:] if x != b and self.room[x] == r]
        return found

    def search(self) -> None:
        for _ in range(PASSES):
            order = sorted((b for b in range(len(self.items))
                            if self.items[b] and self.room[b]), key=lambda b: -self.room[b])
            emptied = False
            for b in order[:SOURCES]:
                steps = 4 * len(self.items[b]) + 16
                moved = True
                while self.items[b] and moved and steps:
                    moved, steps = False, steps - 1
                    for at in range(len(self.items[b]) - 1, -1, -1):
                        to = self.best(self.items[b][at][0], but=b)
                        if to >= 0 and self.room[to] <= self.room[b]:
                            self.put(to, *self.take(b, at))
                            moved = True
                            break
                        if self._swap(b, at):
                            moved = True
                            break
                emptied |= not self.items[b]
            if not emptied:
                break
        self._merge()

    def _merge(self) -> None:
        """Moves of whole bins: what is left of one goes into another that has room for all of it."""
        for b in sorted((b for b in range(len(self.items)) if self.items[b] and self.room[b]),
                        key=lambda b: -self.room[b]):
            to = self.best(self.capacity - self.room[b], but=b)
            while to >= 0 and self.items[b]:
                self.put(to, *self.take(b, -1))


def pack_lengths(lengths: list[int], capacity: int) -> list[list[tuple[int, int]]]:
    """Bins as lists of (length, index into ``lengths``)."""
    bins = Bins(capacity)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bins.add(lengths[i], i)
    bins.search()
    return [x for x in bins.items if x]


def _packer(capacity: int, level: int, last: bool):
    """Packs one group; bins that stay open get no number."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        frame = group.drop(columns="__group").reset_index(drop=True)
        base = (level << 56) + (int(group["__group"].iloc[0]) << 24)
        where = [(None, None)] * len(frame)
        for number, held in enumerate(pack_lengths(frame["length"].tolist(), capacity)):
            fill = 0
            close = last or sum(x[0] for x in held) >= CLOSED * capacity
            for length, i in held if close else ():
                where[i] = (base + number, fill)
                fill += length
        frame["sequence_id"] = pd.array([x[0] for x in where], "Int64")
        frame["offset"] = pd.array([x[1] for x in where], "Int64")
        return frame

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``capacity``.

    Equal rows are pieces of their own. An empty table gives an empty one.
    """
    columns = pieces.columns
    left = materialize(pieces, "pack-pieces")
    done = []
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    for level in range(LEVELS):
        count = left.count()
        groups = max(1, -(-count // group_pieces))
        last = groups == 1 or level == LEVELS - 1

        # the row's place in the written table parts equal rows
        salt = F.xxhash64(*[F.col(k) for k in columns], F.lit(level), F.monotonically_increasing_id())
        packed = materialize(
            left.withColumn("__group", F.pmod(salt, F.lit(groups))).groupBy("__group")
            .applyInPandas(_packer(capacity, level, last), f"{kinds}, sequence_id long, offset long"), "pack-level")
        done.append(packed.filter("sequence_id is not null"))
        if last:
            break
        left = packed.filter("sequence_id is null").select(*columns)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with the place it got; see the contract of the columns in ``cut``.

    Null and empty texts are one token long. Repeated rows are packed each.
    """
    return pack(cut(docs, tokenizer, capacity), capacity)
