"""Byte-level BPE: whole texts to ids by the ranks of a public vocabulary, and ids back to bytes.

A text is split by the vocabulary's pattern.  A piece that is itself a token is that token; any other piece is
merged byte by byte under a segment tree over its byte positions: a leaf holds the rank of the pair that begins
there, an inner node the leftmost minimum of its leaves.  The root names the next merge; a merge changes the pair
at its own position, the pair of the live neighbour before it, and closes the position that it swallows, each a
point update of logarithmic cost.  So a piece of n bytes takes n log n steps, however long it is.  The trees of all the short
pieces of a slice of rows merge in step, as the rows of numpy arrays; a long piece has a tree of its own.

The character classes of the pattern are those of the tiktoken library of the installation: its tables of letters, digits
and blanks are asked once by the driver, and characters on which the regex module differs are read as one of the right class.

Tasks read their rows as they come; nothing is shuffled.  A worker remembers the ids of short pieces.

Defined results: null or empty text has no ids and decodes to no bytes; repeated rows and null doc_ids are rows like
any other; texts of any length are read whole, piece by piece; an empty table gives no rows; only the named columns are read, so
others may have any name.  decode refuses ids that the vocabulary does not have (ValueError).
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import small_batches

#: Pieces that a worker remembers before it starts anew, and the characters of the longest of them.
CACHE_PIECES, CACHE_CHARS = 300_000, 48
#: Tokens that are decoded at once.
DECODE_TOKENS = 200_000
#: Bytes of a piece whose tree is a row among others, and trees that merge in step.
SHORT, TOGETHER = 64, 20_000
#: Trees over more positions than this are kept in packed arrays.
PACKED = 1 << 14

_vocabularies: dict[tuple[str, str], "Vocabulary"] = {}
_classes: list[dict[int, str]] = []


def default_ranks() -> str:
    """Path of the public multilingual ranks of this installation."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def vocabulary(path: str, pattern: str, other: dict[int, str]) -> "Vocabulary":
    """The worker's vocabulary for a file of ranks; it lives as long as the worker."""
    if (path, pattern) not in _vocabularies:
        _vocabularies[path, pattern] = Vocabulary(path, pattern, other)
    return _vocabularies[path, pattern]


def stand_ins() -> dict[int, str]:
    """For each character that the regex module puts into another class than tiktoken: one of the class it has there."""
    if not _classes:
        import regex
        import tiktoken

        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        single = {bytes([i]): i for i in range(256)}
        out: dict[int, str] = {}
        here, there = {}, {}
        for name, example in ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", "\t")):
            probe = tiktoken.Encoding("classes", pat_str=f"{name}+", mergeable_ranks=single, special_tokens={})
            there[example] = set(bytes(probe.encode_ordinary(every)).decode())
            here[example] = set(regex.sub(f"[^{name}]+", "", every))
        for example in here:
            for c in here[example] - there[example]:
                out.setdefault(ord(c), "\x01")
            for c in there[example] - here[example]:
                out[ord(c)] = example
        _classes.append(out)
    return _classes[0]


class PairTree:
    """Segment tree over the byte positions of a piece: which live pair merges next."""

    def __init__(self, piece: bytes, ranks: dict[bytes, int]):
        self.piece, self.ranks, n = piece, ranks, len(piece)
        self.none, self.width = len(ranks) << 40, 1 << max(n - 2, 0).bit_length()
        leaves = [self._key(i, i + 2) for i in range(n - 1)]
        tree = [self.none] * self.width + leaves + [self.none] * (self.width - n + 1)
        for i in range(self.width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        packed = n > PACKED
        self.tree, self.end, self.before = (array("q", x) if packed else x for x in (tree, ends, before))

    def _key(self, start: int, stop: int) -> int:
        """Rank first, position second: the minimum is the leftmost pair of the least rank."""
        rank = self.ranks.get(self.piece[start:stop])
        return self.none if rank is None else rank << 40 | start

    def _put(self, start: int, key: int) -> None:
        tree, i = self.tree, start + self.width
        tree[i] = key
        while i > 1:
            best = min(tree[i], tree[i ^ 1])
            i >>= 1
            if tree[i] == best:
                return
            tree[i] = best

    def ids(self) -> list[int]:
        """All merges, then the ids from left to right."""
        piece, tree, end, before, n = self.piece, self.tree, self.end, self.before, len(self.piece)
        while (top := tree[1]) < self.none:
            at = top & (1 << 40) - 1
            gone = end[at]
            end[at] = stop = end[gone]
            self._put(gone, self.none) if gone < n - 1 else None
            if stop < n:
                before[stop] = at
                self._put(at, self._key(at, end[stop]))
            else:
                self._put(at, self.none)
            if (left := before[at]) >= 0:
                self._put(left, self._key(left, stop))
        out, at = [], 0
        while at < n:
            out.append(self.ranks[piece[at : end[at]]])
            at = end[at]
        return out


class Pairs:
    """The rank of the token that two tokens make, for many pairs at once."""

    def __init__(self, ranks: dict[bytes, int]):
        made = [(ranks[w[:k]] << 32 | ranks[w[k:]], rank) for w, rank in ranks.items() for k in range(1, len(w)) if w[:k] in ranks and w[k:] in ranks]
        made.sort()
        self.keys = np.array([k for k, _ in made] + [1 << 62], np.int64)
        self.rank = np.array([r for _, r in made] + [0], np.int32)
        self.bytes = np.array([ranks.get(bytes([i]), 0) for i in range(256)], np.int32)

    def of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, whether there is such a token)."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return self.rank[at], self.keys[at] == key


def merge_together(pieces: list[bytes], pairs: Pairs) -> list[bytes]:
    """Ids (little-endian u32 bytes) of short pieces: one segment tree a row, all of them merging in step.

    A key is rank and position in one number, so that the minimum is the leftmost pair of the least rank.
    """
    none, m = np.int64(1) << 62, len(pieces)
    n = np.fromiter(map(len, pieces), np.int64, m)
    width = max(2, 1 << int(n.max() - 1).bit_length())
    token = np.zeros((m, width + 1), np.int32)
    alive = np.arange(width + 1) < n[:, None]
    token[alive] = pairs.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.tile(np.arange(1, width + 2), (m, 1))
    before = after - 2
    tree = np.full((m, 2 * width), none)

    flat_token, flat_after, flat_before, flat_alive, flat_tree = (x.reshape(-1) for x in (token, after, before, alive, tree))

    def keys(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        base = rows * (width + 1)
        right = flat_after[base + at]
        inside = right < n[rows]
        rank, known = pairs.of(flat_token[base + at], flat_token[base + np.where(inside, right, 0)])
        return np.where(inside & known, rank.astype(np.int64) << 8 | at, none)

    rows, at = np.nonzero(alive[:, :width])
    tree[rows, width + at] = keys(rows, at)
    for i in range(width - 1, 0, -1):
        tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])
    rows = np.arange(m)
    while True:
        top = flat_tree[rows * 2 * width + 1]
        rows, top = rows[top < none], top[top < none]
        if not len(rows):
            break
        base, root, at = rows * (width + 1), rows * (2 * width), top & 255
        gone = flat_after[base + at]
        right = flat_after[base + gone]
        flat_token[base + at], flat_alive[base + gone] = top >> 8, False
        flat_after[base + at] = right
        flat_before[base + np.minimum(right, width)] = at
        left = flat_before[base + at]
        left = np.where(left < 0, at, left)
        flat_tree[root + width + gone] = none
        for where in (at, left):
            flat_tree[root + width + where] = keys(rows, where)
        paths, level = [width + gone, width + at, width + left], width
        while level > 1:
            level >>= 1
            for k, path in enumerate(paths):
                paths[k] = path >> 1
                under = root + 2 * paths[k]
                flat_tree[root + paths[k]] = np.minimum(flat_tree[under], flat_tree[under + 1])
    ends = np.cumsum(alive.sum(1)) * 4
    flat = token[alive].astype("<u4").tobytes()
    return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class Vocabulary(dict):
    """Pieces of a text and their ids (little-endian u32 bytes), of which short ones are remembered; and the way back."""

    def __init__(self, path: str, pattern: str, other: dict[int, str]):
        import regex

        super().__init__()
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.split = regex.compile(pattern)
        self.pairs = Pairs(self.ranks)
        self.other = other
        self.odd = np.zeros(0x110000, bool)
        self.odd[list(other)] = True
        size = max(self.ranks.values()) + 1
        words = [b""] * size
        for word, rank in self.ranks.items():
            words[rank] = word
        self.known = np.array([bool(w) for w in words])
        self.words, self.decimals = Pool(words), Pool([b"%d," % i for i in range(size)])

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or not self.odd[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            return self.split.findall(text)
        return [text[m.start() : m.end()] for m in self.split.finditer(text.translate(self.other))]

    def learn(self, pieces: set[str]) -> None:
        """Remember the ids of these pieces; short ones are merged together by the size of their trees."""
        names = list(pieces)
        raws = [p.encode("utf-8") for p in names]
        ranks = list(map(self.ranks.get, raws))
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        open_ = np.fromiter((r is None for r in ranks), bool, len(raws))
        for i in np.flatnonzero(~open_).tolist():
            self[names[i]] = ranks[i].to_bytes(4, "little")
        for i in np.flatnonzero(open_ & (sizes > SHORT)).tolist():
            self[names[i]] = np.array(PairTree(raws[i], self.ranks).ids(), "<u4").tobytes()
        for k in range(1, SHORT.bit_length()):
            group = np.flatnonzero(open_ & (sizes > 1 << k - 1) & (sizes <= 1 << k))
            for j in range(0, len(group), TOGETHER):
                part = group[j : j + TOGETHER].tolist()
                self.update(zip([names[i] for i in part], merge_together([raws[i] for i in part], self.pairs), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        split = [self.pieces(t) for t in texts]
        new = {p for pieces in split for p in pieces if p not in self}
        if len(self) + len(new) > CACHE_PIECES:
            self.clear()
            new = {p for pieces in split for p in pieces}
        self.learn(new)
        out = [b"".join(map(self.__getitem__, pieces)) for pieces in split]
        for piece in new:
            if len(piece) > CACHE_CHARS:
                del self[piece]
        return out


class Pool:
    """Byte strings by number, gathered for many numbers at once."""

    def __init__(self, words: list[bytes]):
        self.length = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(words), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        parts = (ids[i : i + DECODE_TOKENS] for i in range(0, len(ids), DECODE_TOKENS))
        return b"".join(self.data[tx.ragged(self.start[x], self.length[x])].tobytes() for x in parts)


def encode(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row; ids are little-endian u32 bytes."""
    ranks, pattern, other = ranks or default_ranks(), pattern or default_pattern(), stand_ins()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks, pattern, other)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                ids = words.encode([t or "" for t in part.column("text").to_pylist()])
                sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, decimals, decoded) of rows (doc_id, ids): the ids as decimals joined by commas, and the bytes they stand for."""
    ranks, pattern, other = ranks or default_ranks(), pattern or default_pattern(), stand_ins()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks, pattern, other)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                ids = [np.frombuffer(x or b"", "<u4").astype(np.int64) for x in part.column("ids").to_pylist()]
                for x in ids:
                    if len(x) and (x.max() >= len(words.known) or not words.known[x].all()):
                        raise ValueError("an id is not in the vocabulary")
                columns = [
                    part.column("doc_id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([words.decimals.join(x)[:-1].decode() for x in ids], pa.string()),
                    pa.array([words.words.join(x) for x in ids], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "decimals", "decoded"])

    small_batches(encoded.sparkSession)
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("binary").alias("ids")).mapInArrow(run, "doc_id long, n_tokens long, decimals string, decoded binary")
