"""Token ids of whole texts in Arrow batches, word by word.

The vocabulary used here drops white space and never joins across it, so a text's ids are the
ids of its words in order. Words come again and again: each is encoded once per worker and its
ids are kept as bytes (unsigned 32-bit, little-endian), so that a text costs one split and one
join. Words of Latin letters with ASCII marks behind them, which is nearly all, are encoded many
at a time: their ids are cut where a token ends a word. All others, and texts with separators on
which Python and the tokenizer differ, go to the tokenizer as they are.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

END_ID = 1
#: Words kept per worker. Beyond it the store starts anew.
KEPT_WORDS = 400_000
#: Characters whose new words are encoded together.
CHUNK_CHARS = 4_000_000

_PLAIN = re.compile(r"([A-Za-zß-öø-ÿÀ-ÖØ-Þ]+)"
                    r"([!-&(-/:-@\[-`{-~]*)")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_BY_PATH: dict[str, WordEncoder] = {}


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _direct(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> None:
        ids = np.array(self.tokenizer.encode_batch_fast(
            [" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(words) and (not len(ids) or stops[-1] == len(ids)):
            data, stops = ids.tobytes(), (stops * 4).tolist()
            self.parts.update(zip(words, map(data.__getitem__, map(slice, [0, *stops], stops)),
                                  strict=False))
        else:
            self.parts.update(zip(words, self._direct(words), strict=True))

    def _learn(self, words: set[str]) -> None:
        plain, other = [], []
        for word in words:
            if m := _PLAIN.fullmatch(word):
                plain.append((word, m[1].lower(), m[2]))
            else:
                other.append(word)
        fresh = list({x[1] for x in plain}.difference(self.parts))
        for at in range(0, len(fresh), 50_000):
            self._letters(fresh[at:at + 50_000])
        marks = list({x[2] for x in plain}.difference(self.parts))
        self.parts.update(zip(marks, self._direct(marks), strict=True))
        parts = self.parts
        self.known.update((word, parts[a] + parts[b]) for word, a, b in plain)
        self.known.update(zip(other, self._direct(other), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes, the end id included. Null is an empty text."""
        end = np.array([END_ID], "<u4").tobytes()
        out: list[bytes] = []
        held: list[list[str] | str] = []
        size = 0
        for at, text in enumerate(texts):
            text = text or ""
            whole = _ODD_SPACE.search(text) or any(s in text for s in self.special)
            held.append(text if whole else text.split())
            size += len(text)
            if size >= CHUNK_CHARS or at == len(texts) - 1:
                new = set(chain.from_iterable(x for x in held if isinstance(x, list)))
                if len(self.known) + len(new) > KEPT_WORDS:
                    self.known, self.parts = {}, {}
                self._learn(new.difference(self.known))
                ids = self.known.__getitem__
                out += [(self._direct([x])[0] if isinstance(x, str) else b"".join(map(ids, x)))
                        + end for x in held]
                held, size = [], 0
        return out


def encoder(path: str) -> WordEncoder:
    """One encoder per worker and file."""
    if path not in _BY_PATH:
        _BY_PATH[path] = WordEncoder(path)
    return _BY_PATH[path]
