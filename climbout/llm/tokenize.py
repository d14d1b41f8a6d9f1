"""Token ids of whole texts by a public tokenizer, with one encoding per distinct word of a task.

The word tokenizer drops white space and never joins pieces across it, so a text's ids are its words'
ids in a row.  A task therefore encodes each distinct blank-separated word once (in whole batches, by
the tokenizers library) and gathers the ids with numpy.  Words are also cut between an ASCII letter and
a following or preceding run of full stops and commas, where the tokenizer always cuts too.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd

from . import text as tx

#: Distinct words that a worker remembers before it starts anew.
CACHE_WORDS = 400_000
#: Cells of the table of remembered words.
TABLE = 1 << 20
#: Words that go to the library as one string; the offsets of its ids tell them apart.
RUN = 256

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2C, 0x2E]] = True
_encoders: dict[str, "Encoder"] = {}


def default_tokenizer() -> str:
    """Path of the public word tokenizer of this installation."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a tokenizer file; it lives as long as the worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        """Forget all words.  The table is direct-mapped: a word may push out another one, which is then encoded anew."""
        self.key, self.slot = np.zeros(TABLE, np.uint64), np.zeros(TABLE, np.int32)
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0
        self.start, self.length, self.rows = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64), 0

    def _learn(self, texts: list[str]) -> np.ndarray:
        """Encode the words and append their ids; returns the words' rows."""
        ids, length = [], []
        runs = [texts[i : i + RUN] for i in range(0, len(texts), RUN)]
        for run, e in zip(runs, self.tokenizer.encode_batch([" ".join(r) for r in runs], add_special_tokens=False), strict=True):
            ids.append(np.array(e.ids, np.uint32))
            begin = np.cumsum([0] + [len(w) + 1 for w in run])
            at = np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids))
            length.append(np.bincount(np.searchsorted(begin, at, "right") - 1, minlength=len(run)))
        ids, length = np.concatenate(ids), np.concatenate(length)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + len(texts) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        new = np.arange(self.rows, self.rows + len(texts))
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[new], self.length[new] = self.used + np.cumsum(length) - length, length
        self.used, self.rows = self.used + len(ids), self.rows + len(texts)
        return new

    def ids(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): all ids of a slice of texts, and where each text's ids begin."""
        start, end, first = pieces(data, off)
        codes, uniq = pd.factorize(tx.Prefix(data).spans(start, end))
        if self.rows > CACHE_WORDS:
            self.clear()
        cell = (uniq >> np.uint64(40)) & np.uint64(TABLE - 1)
        at = np.where(self.key[cell] == uniq, self.slot[cell], -1)
        if len(new := np.flatnonzero(at < 0)):
            where = np.empty(len(uniq), np.int64)
            where[codes[::-1]] = np.arange(len(codes))[::-1]
            raw, s, e = data.tobytes(), start[where[new]], end[where[new]]
            at[new] = self._learn([raw[a:b].decode("utf-8") for a, b in zip(s.tolist(), e.tolist(), strict=True)])
            self.key[cell[new]], self.slot[cell[new]] = uniq[new], at[new]
        each = self.length[at][codes]
        ids = self.flat[tx.ragged(self.start[at][codes], each)]
        return ids, np.concatenate([[0], np.cumsum(each)])[first]


def pieces(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the spans that are encoded by themselves."""
    start, end, first = tx.spans(data, off, tx.BLANKS)
    letter, stop = _LETTER[data], _STOP[data]
    cut = np.flatnonzero((letter[:-1] & stop[1:]) | (stop[:-1] & letter[1:])) + 1 if len(data) > 1 else np.zeros(0, np.int64)
    doc = np.isin(cut, off)
    cut = cut[~doc]
    start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    return start, end, np.searchsorted(start, off)
