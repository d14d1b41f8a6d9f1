"""Benchmark decontamination with a generalised suffix automaton of the items' words.

Tasks build automata of blocks of items, at most BLOCK_WORDS words each; their arrays, linear in the words, are
broadcast, at most PASS_BLOCKS of them at once.  A larger benchmark takes several passes over the corpus, with the
hits so far written to the shared folder between them, so no more than one pass's automata are ever held.  Tasks stream the
words of every whole document: a word outside the items' vocabulary ends a match, so only runs of known
words that could hold a match walk the automaton, which tracks the longest matching length.  A match as
long as the window marks its words as hit.

Defined results: null text, in documents or items, has no words; items without words never occur; equal items and
rows that repeat an item_id all count; an item without item_id marks words, but is neither listed nor counted; repeated
documents are judged one by one; texts of any length are read whole; an empty benchmark leaves all documents
clean; an empty table gives an empty result; other columns are ignored (`remove_spans` hands them on).
"""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import materialize, small_batches

#: Words of one automaton at most (or one longer item), and automata of one pass.
BLOCK_WORDS, PASS_BLOCKS = 250_000, 8


class Automaton:
    """Generalised suffix automaton over sequences of word hashes, with the items' windows on its states."""

    def __init__(self, items: list[np.ndarray], window: int):
        self.window = window
        self.vocabulary = np.unique(np.concatenate(items)) if items else np.zeros(0, np.uint64)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [np.searchsorted(self.vocabulary, x).tolist() for x in items]
        for word in coded:
            last = 0
            for c in word:
                last = self._extend(last, c)
        # the items with a window that ends at a state, by walking each item along the finished automaton
        self.ends: list[dict[int, set[int]]] = [{} for _ in self.next]
        for k, word in enumerate(coded):
            size = min(window, len(word))
            state, held = 0, 0
            for c in word:
                state, held = self.walk(state, held, c)
                if held >= size:
                    self.ends[self.at_least(state, size)].setdefault(size, set()).add(k)
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        self.sizes: dict[int, tuple[tuple[int, frozenset[int]], ...]] = {}
        for v in order:  # a match that reaches a state also ends in all of its suffixes
            if own := (*self.sizes.get(self.link[v], ()), *((n, frozenset(k)) for n, k in sorted(self.ends[v].items()))):
                self.sizes[v] = own
        self.shortest = min((min(window, len(w)) for w in coded), default=1)
        self.freeze()

    def freeze(self) -> None:
        """Keep arrays: most states have one edge at most; the edges of the others stay in one table."""
        self.only, self.then, self.more = array("i"), array("i"), {}
        for v, edges in enumerate(self.next):
            c, to = next(iter(edges.items())) if len(edges) == 1 else (-2, -1)
            self.only.append(c)
            self.then.append(to)
            if len(edges) > 1:
                self.more[v] = edges
        self.link, self.length = array("i", self.link), array("i", self.length)
        del self.next, self.ends

    def edge(self, state: int, c: int) -> int:
        """The next state, or -1; of the finished automaton."""
        if self.only[state] == c:
            return self.then[state]
        edges = self.more.get(state)
        return -1 if edges is None else edges.get(c, -1)

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
        new = self._state(self.length[last] + 1, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return new

    def _state(self, length: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def walk(self, state: int, held: int, c: int) -> tuple[int, int]:
        """State and longest matching length after one more word, while the automaton is built."""
        while state and c not in self.next[state]:
            state = self.link[state]
            held = self.length[state]
        if c in self.next[state]:
            return self.next[state][c], held + 1
        return 0, 0

    def step(self, state: int, held: int, c: int) -> tuple[int, int]:
        """State and longest matching length after one more word."""
        to = self.edge(state, c)
        while to < 0 and state:
            state = self.link[state]
            held = self.length[state]
            to = self.edge(state, c)
        return (to, held + 1) if to >= 0 else (0, 0)

    def at_least(self, state: int, size: int) -> int:
        """The shortest suffix of a state's strings that still has `size` words lies in this state."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def runs(self, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, end) of the runs of known words, within one document, that are long enough for a match."""
        known = np.concatenate([[False], codes >= 0, [False]])
        begin = known[1:-1] & ~known[:-2]
        close = known[1:-1] & ~known[2:]
        cut = first[1:-1]
        cut = cut[(cut > 0) & (cut < len(codes))]
        begin[cut] = known[cut + 1]
        close[cut - 1] = known[cut]
        begin, end = np.flatnonzero(begin), np.flatnonzero(close) + 1
        long = end - begin >= self.shortest
        return begin[long], end[long]

    def scan(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
        """(hit per word, (word, item) of matched windows, longest match per document) of a slice of documents."""
        hit, found = np.zeros(len(hashes), bool), []
        longest = np.zeros(len(first) - 1, np.int64)
        if not len(self.vocabulary):
            return hit, found, longest
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        codes = np.where(self.vocabulary[at] == hashes, at, -1)
        for a, b in zip(*self.runs(codes, first), strict=True):
            state = held = most = 0
            for i, c in enumerate(codes[a:b].tolist(), a):
                state, held = self.step(state, held, c)
                most = max(most, held)
                for size, items in self.sizes.get(state, ()):
                    if size <= held:
                        hit[i - size + 1 : i + 1] = True
                        found += [(i, k) for k in items]
            doc = int(np.searchsorted(first, a, "right")) - 1
            longest[doc] = max(longest[doc], most)
        return hit, found, longest


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
STATE = "doc_id long, text string, bits binary, longest long, items array<string>"
FOUND = "doc_id long, n_words long, n_hit long, longest long, items array<string>, spans array<struct<start:long,end:long>>"


def blocks(benchmark: DataFrame, window: int) -> DataFrame:
    """(block): pickled (item ids, automaton) of at most BLOCK_WORDS words each, built where the items stand."""
    limit = BLOCK_WORDS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, items, size = [], [], 0

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps((names, Automaton(items, window)))], pa.binary())], names=["block"])

        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for row, data, off in tx.slices(batch.column("text")):
                word, first = tx.words(data, off, tx.ALNUM)
                for k in range(len(off) - 1):
                    if first[k] == first[k + 1]:
                        continue
                    if items and size + first[k + 1] - first[k] > limit:
                        yield emit()
                        names, items, size = [], [], 0
                    names.append(ids[row + k])
                    items.append(word[first[k] : first[k + 1]])
                    size += len(items[-1])
        if items:
            yield emit()

    small_batches(benchmark.sparkSession)
    rows = benchmark.select(F.col("item_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    return materialize(rows.mapInArrow(build, "block binary"), "benchmark-blocks")


def passes(benchmark: DataFrame, window: int) -> Iterator[tuple[list, bool]]:
    """(broadcast blocks, whether they are the last ones), PASS_BLOCKS at most at a time."""
    sc, held = benchmark.sparkSession.sparkContext, []
    for row in blocks(benchmark, window).toLocalIterator():
        if len(held) == PASS_BLOCKS:
            yield held, False
            held = []
        held.append(sc.broadcast(bytes(row.block)))
    yield held or [sc.broadcast(pickle.dumps(([], Automaton([], window))))], True


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document: words, hit words, longest match, ids of items with occurring windows, hit byte spans.

    Spans are [start, end) byte offsets into the UTF-8 text.  A benchmark of several passes needs no shuffle; every
    pass adds its hits to those of the passes before.
    """
    none = F.lit(None)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), none.cast("binary").alias("bits"), F.lit(0).cast("long").alias("longest"), F.expr("cast(array() as array<string>)").alias("items"))
    for shared, last in passes(benchmark, window):

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                before = {c: batch.column(c).to_pylist() for c in ("bits", "items")}
                most = batch.column("longest").to_numpy()
                for row, data, off in tx.slices(batch.column("text")):
                    n = len(off) - 1
                    found = scan_slice(shared, data, off, before["bits"][row : row + n], before["items"][row : row + n], most[row : row + n], last)
                    if last:
                        yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, n), *found], names=["doc_id", "n_words", "n_hit", "longest", "items", "spans"])
                    else:
                        yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, n), batch.column("text").slice(row, n), *found], names=["doc_id", "text", "bits", "longest", "items"])

        rows = rows.mapInArrow(scan, FOUND if last else STATE)
        if not last:
            rows = materialize(rows, "benchmark-hits")
            for block in shared:
                block.destroy()
    return rows


_loaded: dict[int, tuple[list, Automaton]] = {}


def loaded(block) -> tuple[list, Automaton]:
    """The block of a broadcast; a worker keeps the last PASS_BLOCKS of them."""
    key = hash(block.value)
    if key not in _loaded:
        while len(_loaded) >= PASS_BLOCKS:
            _loaded.pop(next(iter(_loaded)))
        _loaded[key] = pickle.loads(block.value)
    return _loaded[key]


def scan_slice(shared: list, data: np.ndarray, off: np.ndarray, bits: list, items: list[list[str]], most: np.ndarray, last: bool) -> list[pa.Array]:
    """The output columns of one pass over one slice, without doc_id and text."""
    start, end, first = tx.spans(data, off, tx.ALNUM)
    hashes = tx.Prefix(tx.LOWER[data]).spans(start, end)
    hit = np.zeros(len(hashes), bool)
    for d, old in enumerate(bits):
        if old is not None:
            a, b = first[d], first[d + 1]
            hit[a:b] |= np.unpackbits(np.frombuffer(old, np.uint8), count=int(b - a)).astype(bool)
    for block in shared:
        names, automaton = loaded(block)
        own, found, longest = automaton.scan(hashes, first)
        hit |= own
        most = np.maximum(longest, most)
        for d, k in {(int(np.searchsorted(first, i, "right")) - 1, k) for i, k in set(found)}:
            if names[k] is not None:
                items[d] = [*items[d], names[k]]
    items = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
    sums = np.concatenate([[0], np.cumsum(hit)])
    n_hit = sums[first[1:]] - sums[first[:-1]]
    if not last:
        packed = [np.packbits(hit[first[d] : first[d + 1]]).tobytes() if n else None for d, n in enumerate(n_hit.tolist())]
        return [pa.array(packed, pa.binary()), pa.array(most), items]
    runs: list[list[dict]] = [[] for _ in bits]
    for d in np.flatnonzero(n_hit).tolist():
        a, b = int(first[d]), int(first[d + 1])
        edge = np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]]))
        runs[d] = [{"start": int(start[a + x] - off[d]), "end": int(end[a + y - 1] - off[d])} for x, y in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
    return [pa.array(np.diff(first)), pa.array(n_hit), pa.array(most), items, pa.array(runs, pa.list_(SPAN))]


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """docs without the matched spans; documents with more than max_coverage of their words hit go whole.

    Keeps all columns and the order of the remaining text; a document without hits is left as it is.  Rows are
    cut where they stand, so nothing is joined or shuffled and rows that repeat a doc_id are judged one by one.
    """
    columns = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(columns))]).withColumn("bits", F.lit(None).cast("binary"))
    text = f"c{columns.index('text')}"
    for shared, last in passes(benchmark, window):

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bits = batch.column("bits").to_pylist()
                for row, data, off in tx.slices(batch.column(text)):
                    n = len(off) - 1
                    part = batch.slice(row, n)
                    found = scan_slice(shared, data, off, bits[row : row + n], [[] for _ in range(n)], np.zeros(n, np.int64), last)
                    if not last:
                        yield part.set_column(part.schema.get_field_index("bits"), "bits", found[0])
                        continue
                    words, hit, _, _, spans = found
                    part = part.drop_columns(["bits"])
                    if pa.compute.any(pa.compute.greater(hit, 0)).as_py():
                        at = part.schema.get_field_index(text)
                        part = part.set_column(at, part.schema.field(at), pa.array(without(part.column(text).to_pylist(), spans.to_pylist()), part.schema.field(at).type))
                    fine = hit.to_numpy() <= max_coverage * words.to_numpy()
                    yield part.filter(pa.array(fine))

        rows = rows.mapInArrow(scan, rows.drop("bits").schema if last else rows.schema)
        if not last:
            rows = materialize(rows, "benchmark-hits")
            for block in shared:
                block.destroy()
    return rows.toDF(*columns)


def without(texts: list[str | None], spans: list[list[dict]]) -> list[str | None]:
    """The texts without their spans of UTF-8 bytes."""
    out = []
    for text, cuts in zip(texts, spans, strict=True):
        if cuts:
            raw, at, kept = text.encode(), 0, []
            for cut in cuts:
                kept.append(raw[at : cut["start"]])
                at = cut["end"]
            text = b"".join([*kept, raw[at:]]).decode()
        out.append(text)
    return out
