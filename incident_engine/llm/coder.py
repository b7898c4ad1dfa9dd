"""Context-mixing range coder for token ids, many blocks at a time.

A block is coded on its own: model and coder start anew, and its checksum is kept. All blocks of
a call advance together, one id per step, as the lanes of numpy arrays, so a step costs some tens
of array operations whatever the number of blocks.

The model mixes three predictions into one distribution over ids:

* order 2: the id that followed the last two ids before (a hashed table per block),
* order 1: the id that followed the last id before,
* order 0: how often ids of the same range of 256 have come up so far.

Orders 2 and 1 name one id each and give it extra weight on top of the order-0 distribution. The
weight follows how often such a prediction has come true in this block at the same confidence
(times the slot was right in a row). The range coder is carry-less: 64-bit state, 16-bit words.
"""

from __future__ import annotations

import zlib

import numpy as np

IDS = 1 << 16
BLOCK = 2048
_BINS, _UNIT, _REFRESH = 256, 4096, 128
_BASE = _UNIT * 256
_SLOTS2, _SLOTS1, _CONF = 4096, 2048, 8
_TOP, _BOT = np.uint64(1 << 48), np.uint64(1 << 32)
_W16, _LOW = np.uint64(16), np.uint64((1 << 32) - 1)
_MOST = 1 << 24


class _Model:
    """Predictions for ``n`` lanes, of which the first ``k`` still advance.

    All tables are flat: lane times width plus slot. A slot of orders 2 and 1 holds the id that
    came last and, above it, how often in a row it was right, 0 for a slot never used.
    """

    def __init__(self, n: int):
        self.rows = np.arange(n)
        self.slots2, self.row2 = np.zeros(n * _SLOTS2, np.int32), self.rows * _SLOTS2
        self.slots1, self.row1 = np.zeros(n * _SLOTS1, np.int32), self.rows * _SLOTS1
        self.weight = np.full(n * 2 * _CONF, _BASE >> 3, np.int64)
        self.weight.reshape(n, 2 * _CONF)[:, [0, _CONF]] = 0
        self.row_w = self.rows * (2 * _CONF)
        self.seen, self.row_bin = np.zeros(n * _BINS, np.int32), self.rows * _BINS
        self.row_unit = self.rows * _UNIT
        self.last = np.zeros(n, np.int64)
        self.before = np.zeros(n, np.int64)
        self.step = 0
        self._refresh()

    def _refresh(self) -> None:
        n = len(self.rows)
        seen = self.seen.reshape(n, _BINS).astype(np.int64)
        total = seen.sum(axis=1, keepdims=True) + 64
        freq = 1 + (seen * (_UNIT - _BINS - 64)) // total
        freq[:, 0] += _UNIT - freq.sum(axis=1)
        self.freq = freq.ravel()
        self.below = ((np.cumsum(freq, axis=1) - freq) * 256).ravel()
        self.slot = np.repeat(np.tile(np.arange(_BINS, dtype=np.uint8), n), self.freq)

    def predict(self, k: int) -> tuple[np.ndarray, ...]:
        """The two named ids, the smaller first, and their weights. One id named by both orders
        counts once with both weights."""
        if self.step % _REFRESH == 0 and self.step:
            self._refresh()
        self.step += 1
        scrambled = self.last[:k] * 40503
        self.at2 = self.row2[:k] + ((scrambled + self.before[:k] * 30011 >> 3) & (_SLOTS2 - 1))
        self.at1 = self.row1[:k] + ((scrambled >> 4) & (_SLOTS1 - 1))
        entry2, entry1 = self.slots2.take(self.at2), self.slots1.take(self.at1)
        self.c2, self.c1 = entry2 >> 16, entry1 >> 16
        self.p2, self.p1 = entry2 & 65535, entry1 & 65535
        self.w_at2 = self.row_w[:k] + self.c2
        self.w_at1 = self.row_w[:k] + self.c1 + _CONF
        self.w2, self.w1 = self.weight.take(self.w_at2), self.weight.take(self.w_at1)
        a, b = np.minimum(self.p2, self.p1), np.maximum(self.p2, self.p1)
        both = self.w2 + self.w1
        wa = np.where(self.p2 < self.p1, self.w2, self.w1)
        wa = np.where(a == b, both, wa)
        return a, b, wa, both - wa

    def base(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.row_bin[:len(ids)] + (ids >> 8)
        freq = self.freq.take(at)
        return self.below.take(at) + freq * (ids & 255), freq

    def find(self, value: np.ndarray) -> np.ndarray:
        k = len(value)
        high = self.slot.take(self.row_unit[:k] + (value >> 8)).astype(np.int64)
        at = self.row_bin[:k] + high
        return high * 256 + (value - self.below.take(at)) // self.freq.take(at)

    def update(self, ids: np.ndarray) -> None:
        k = len(ids)
        for named, sure, weight, w_at, slots, at in (
                (self.p2, self.c2, self.w2, self.w_at2, self.slots2, self.at2),
                (self.p1, self.c1, self.w1, self.w_at1, self.slots1, self.at1)):
            hit = named == ids
            used = sure > 0
            moved = np.where(hit, weight + (_MOST - weight >> 7), weight - (weight >> 3))
            self.weight[w_at] = moved * used
            slots[at] = ids + (np.where(hit, np.minimum(sure + 1, _CONF - 1), 1) << 16)
        self.seen[self.row_bin[:k] + (ids >> 8)] += 1
        self.before[:k] = self.last[:k]
        self.last[:k] = ids


def _lanes(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes by falling length, and how many lanes have an id at each step."""
    order = np.argsort(-sizes, kind="stable")
    steps = np.arange(sizes.max(initial=0))
    return order, np.searchsorted(-sizes[order], -steps, side="left")


def encode(ids: np.ndarray, block: int = BLOCK) -> list[tuple[int, int, bytes]]:
    """Blocks of (number of ids, crc32 of the ids as unsigned 16-bit, coded bytes)."""
    ids = np.asarray(ids, np.uint16)
    n = -(-len(ids) // block)
    if not n:
        return []
    sizes = np.full(n, block)
    sizes[-1] = len(ids) - block * (n - 1)
    grid = np.zeros((n, block), np.int64)
    grid.ravel()[:len(ids)] = ids
    order, active = _lanes(sizes)
    grid = grid[order]
    out = np.zeros((n, 2 * block + 16), "<u2")
    ptr = np.zeros(n, np.int64)
    low = np.zeros(n, np.uint64)
    rng = np.full(n, (1 << 64) - 1, np.uint64)
    model = _Model(n)
    with np.errstate(over="ignore"):
        for step, k in enumerate(active.tolist()):
            x = grid[:k, step]
            a, b, wa, wb = model.predict(k)
            start, freq = model.base(x)
            start = start + wa * (x > a) + wb * (x > b)
            freq = freq + wa * (x == a) + wb * (x == b)
            share = rng[:k] // (_BASE + wa + wb).astype(np.uint64)
            low[:k] += share * start.astype(np.uint64)
            rng[:k] = share * freq.astype(np.uint64)
            _emit(low, rng, out, ptr, k)
            model.update(x)
    for _ in range(4):
        out[model.rows, ptr] = (low >> np.uint64(48)).astype(np.uint16)
        low <<= _W16
        ptr += 1
    coded = [b""] * n
    for lane, i in enumerate(order.tolist()):
        coded[i] = out[lane, :ptr[lane]].tobytes()
    little = ids.astype("<u2")
    return [(int(sizes[i]), zlib.crc32(little[i * block:i * block + sizes[i]].tobytes()), coded[i])
            for i in range(n)]


def _emit(low, rng, out, ptr, k) -> None:
    while True:
        l, r = low[:k], rng[:k]
        settled = (l ^ (l + r)) < _TOP
        small = r < _BOT
        ready = settled | small
        at = np.flatnonzero(ready)
        if not len(at):
            return
        force = at[~settled[at]]
        if len(force):
            rng[force] = (np.uint64(0) - low[force]) & _LOW
        out[at, ptr[at]] = (low[at] >> np.uint64(48)).astype(np.uint16)
        ptr[at] += 1
        low[at] <<= _W16
        rng[at] <<= _W16


def decode(blocks: list[tuple[int, int, bytes]]) -> np.ndarray:
    """The ids of all blocks in order; a block that does not match its checksum raises."""
    n = len(blocks)
    sizes = np.array([b[0] for b in blocks], np.int64)
    if not n:
        return np.zeros(0, np.uint16)
    order, active = _lanes(sizes)
    width = max(len(b[2]) for b in blocks) // 2 + 8
    data = np.zeros((n, width), np.uint64)
    for lane, i in enumerate(order.tolist()):
        words = np.frombuffer(blocks[i][2], "<u2")
        data[lane, :len(words)] = words
    grid = np.zeros((n, int(sizes.max())), np.uint16)
    low = np.zeros(n, np.uint64)
    rng = np.full(n, (1 << 64) - 1, np.uint64)
    code = np.zeros(n, np.uint64)
    for i in range(4):
        code = (code << _W16) | data[:, i]
    ptr = np.full(n, 4, np.int64)
    model = _Model(n)
    with np.errstate(over="ignore"):
        for step, k in enumerate(active.tolist()):
            a, b, wa, wb = model.predict(k)
            share = rng[:k] // (_BASE + wa + wb).astype(np.uint64)
            value = np.minimum(((code[:k] - low[:k]) // share).astype(np.int64),
                               _BASE + wa + wb - 1)
            start_a, freq_a = model.base(a)
            start_b, freq_b = model.base(b)
            stop_a = start_a + freq_a + wa
            stop_b = start_b + wa + freq_b + wb
            rest = value - wa * (value >= stop_a) - wb * (value >= stop_b)
            x = model.find(np.clip(rest, 0, _BASE - 1))
            x = np.where((value >= start_a) & (value < stop_a), a, x)
            x = np.where((a != b) & (value >= start_b + wa) & (value < stop_b), b, x)
            start, freq = model.base(x)
            start = start + wa * (x > a) + wb * (x > b)
            freq = freq + wa * (x == a) + wb * (x == b)
            low[:k] += share * start.astype(np.uint64)
            rng[:k] = share * freq.astype(np.uint64)
            _fill(low, rng, code, data, ptr, k)
            grid[:k, step] = x
            model.update(x)
    back = np.empty_like(order)
    back[order] = np.arange(n)
    parts = [grid[back[i], :sizes[i]] for i in range(n)]
    for i, (part, block) in enumerate(zip(parts, blocks, strict=True)):
        if zlib.crc32(part.astype("<u2").tobytes()) != block[1]:
            raise ValueError(f"block {i} does not match its checksum")
    return np.concatenate(parts)


def _fill(low, rng, code, data, ptr, k) -> None:
    while True:
        l, r = low[:k], rng[:k]
        settled = (l ^ (l + r)) < _TOP
        at = np.flatnonzero(settled | (r < _BOT))
        if not len(at):
            return
        force = at[~settled[at]]
        if len(force):
            rng[force] = (np.uint64(0) - low[force]) & _LOW
        code[at] = (code[at] << _W16) | data[at, np.minimum(ptr[at], data.shape[1] - 1)]
        ptr[at] += 1
        low[at] <<= _W16
        rng[at] <<= _W16
