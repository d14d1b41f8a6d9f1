"""Removal of repeated byte strings by distributed prefix doubling over sampled positions.

A byte goes if a string of LENGTH bytes that covers it also starts earlier, in a smaller doc_id or in the same
document.  Classic prefix doubling sorts every position's rank pair; a table of all positions is some
thirty times the input, so positions are sampled so that no repeat can hide: of the first-rank names (hashes
of GRAM bytes) inside any LENGTH-byte string, the smallest is chosen, wherever the string stands.  A chosen position
stands for the STEP[0] strings around it.  Then ranks grow as in prefix doubling: positions are grouped by the
name of a longer and longer common core (GRAM bytes, then LENGTH - STEP[1] + 1, then LENGTH).  A position
alone with its core is unique and leaves.  Positions with equal whole surroundings are one rank: all but the
first are covered.  The rest go to the next length, past the last of which every string is settled.

Names are 64-bit hashes (Karp-Miller-Rosenberg naming with hashes for ranks), so no global sort is needed.
Rows travel packed; copies that one task sees are settled there, and cores that one task sees in
many surroundings are dealt over all tasks by their surroundings.

Defined results: null text counts as empty; texts of fewer than LENGTH bytes stay whole; positions are
ordered by (doc_id, start), so rows that repeat a doc_id do not cover each other at equal starts; a null
doc_id sorts last; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import materialize, small_batches, union

LENGTH = 100
#: Strings that one row stands for in each round; the common core is LENGTH - STEP + 1 bytes.
STEP = (64, 8, 1)
#: Rows held by a task before they are sent; surroundings of one core in them that make it hot.
FLUSH, HOT = 400_000, 256
LAST = (1 << 63) - 1
#: What becomes of a row: its strings are covered, or go to the next round.
COVERED, OPEN = 0, 1
NODES = "part int, hot byte, run binary"
FOUND = "doc_id long, body long, first int, width int, state byte"


def slide(x: np.ndarray, width: int, f: np.ufunc) -> np.ndarray:
    """f over all windows of `width` neighbours, by doubling."""
    k = 1
    while 2 * k <= width:
        x = f(x[:-k], x[k:])
        k *= 2
    return f(x[: len(x) - (width - k)], x[width - k :]) if k < width else x


def chosen(prefix: tx.Prefix, off: np.ndarray, length: int, step: int) -> np.ndarray:
    """Positions whose gram is the smallest one of some string of `length` bytes inside a text."""
    n, gram = int(off[-1]), length - step + 1
    if n < length:
        return np.zeros(0, np.int64)
    at = np.arange(n - gram + 1)
    names = prefix.spans(at, at + gram)
    end = np.repeat(off[1:], np.diff(off))
    least = slide(names, step, np.minimum)
    least = np.where(np.arange(n - length + 1) + length <= end[: n - length + 1], least, np.uint64(0))
    edge = np.zeros(step - 1, np.uint64)
    most = slide(np.concatenate([edge, least, edge]), step, np.maximum)
    return np.flatnonzero(most == names)


def nodes_at(prefix: tx.Prefix, first: np.ndarray, low: np.ndarray, high: np.ndarray, step: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(core, surroundings) of the strings of a text [low, high) that start in [first, first + step).

    All those strings share the core, whether or not the text's ends leave out some of them; the surroundings
    are what they span, and tell where they are cut.
    """
    a = np.maximum(first, low)
    b = np.minimum(first + step - 1 + length, high)
    core = prefix.spans(first + step - 1, first + length)
    return core, tx.mix(prefix.spans(a, b) ^ tx.mix(((a - first) * 65536 + (b - first)).astype(np.uint64)))


class Packer:
    """Collects nodes and sends them, packed, to the tasks that own their cores."""

    def __init__(self, parts: int):
        self.parts, self.held, self.size = parts, [], 0

    def add(self, core: np.ndarray, around: np.ndarray, doc_id: np.ndarray, body: np.ndarray, first: np.ndarray) -> None:
        if len(core):
            self.held.append((core, around, doc_id, body, first.astype(np.int32)))
            self.size += len(core)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        rows = [np.concatenate(x) for x in zip(*self.held, strict=True)]
        self.held, self.size = [], 0
        rows, later, opened = ordered(rows)
        covered = [c[later] for c in rows]
        rows, opened = [c[~later] for c in rows], opened[~later]
        count = np.diff(np.append(np.flatnonzero(opened), len(opened)))
        hot = np.repeat(count > HOT, count)
        lead = hot & opened
        out = []
        for kind, pick in ((0, ~hot), (1, hot), (2, lead)):
            if pick.any():
                part = [c[pick] for c in rows]
                out += self.pack(kind, part, part[0] ^ part[1] if kind == 1 else part[0])
        if len(covered[0]):
            out += self.pack(3, covered, covered[2].view(np.uint64) ^ covered[3].view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int8(), pa.binary()), strict=True)], names=["part", "hot", "run"])

    def pack(self, kind: int, rows: list[np.ndarray], key: np.ndarray) -> list[tuple[int, int, bytes]]:
        to = (tx.mix(key) % np.uint64(self.parts)).astype(np.int64)
        order = np.lexsort((rows[4], rows[3], rows[2], to))
        rows, to = [c[order] for c in rows], to[order]
        edge = np.searchsorted(to, np.arange(self.parts + 1))
        return [(p, kind, encode([c[a:b] for c in rows])) for p, (a, b) in enumerate(zip(edge, edge[1:], strict=False)) if b > a]


def encode(rows: list[np.ndarray]) -> bytes:
    core, around, doc_id, body, first = rows
    new = np.flatnonzero(np.concatenate([[True], (doc_id[1:] != doc_id[:-1]) | (body[1:] != body[:-1])]))
    count = np.diff(np.append(new, len(core)))
    return b"".join([np.array([len(new), len(core)], "<u4").tobytes(), doc_id[new].astype("<i8").tobytes(), body[new].astype("<i8").tobytes(), count.astype("<u4").tobytes(), core.tobytes(), around.tobytes(), first.astype("<i4").tobytes()])


def decode(raw: bytes) -> list[np.ndarray]:
    k, n = np.frombuffer(raw, "<u4", 2).tolist()
    at, out = 8, []
    for kind, m in (("<i8", k), ("<i8", k), ("<u4", k), ("<u8", n), ("<u8", n), ("<i4", n)):
        out.append(np.frombuffer(raw, kind, m, at))
        at += out[-1].nbytes
    doc_id, body, count, core, around, first = out
    return [core, around, np.repeat(doc_id, count), np.repeat(body, count), first]


def ordered(rows: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows by core, surroundings and place; which ones repeat surroundings that start earlier; which ones open a core."""
    order = np.lexsort((rows[4], rows[2], rows[1], rows[0]))
    rows = [c[order] for c in rows]
    opened = np.ones(len(order), bool)
    opened[1:] = rows[0][1:] != rows[0][:-1]
    new = opened.copy()
    new[1:] |= rows[1][1:] != rows[1][:-1]
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    return rows, (rows[2] != rows[2][lead]) | (rows[4] != rows[4][lead]), opened


def settle(nodes: DataFrame, width: int, name: str) -> DataFrame:
    """(doc_id, body, first, width, state) of covered rows and of those that go to the next round."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows: list[np.ndarray], state: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows[2]), pa.array(rows[3]), pa.array(rows[4]), pa.array(np.full(len(state), width, np.int32)), pa.array(state.astype(np.int8))], names=["doc_id", "body", "first", "width", "state"])

        held: dict[bool, list] = {False: [], True: []}
        for batch in batches:
            for kind, raw in zip(batch.column("hot").to_pylist(), batch.column("run"), strict=True):
                rows = decode(raw.as_buffer())
                if kind == 3:
                    yield emit(rows, np.full(len(rows[0]), COVERED))
                else:
                    held[kind == 1].append([*rows, np.full(len(rows[0]), kind == 2)])
        for hot, runs in held.items():
            if not runs:
                continue
            rows, later, opened = ordered([np.concatenate(x) for x in zip(*runs, strict=True)])
            group = np.cumsum(opened) - 1
            several = np.bincount(group, ~later) > 1
            several |= np.bincount(group, rows[5]) > 0
            open_ = ~later & (several[group] | hot)
            if width == 1:
                open_[:] = False
            pick = np.flatnonzero(later | open_)
            for a in range(0, len(pick), 200_000):
                at = pick[a : a + 200_000]
                yield emit([c[at] for c in rows], np.where(later[at], COVERED, OPEN))

    return materialize(nodes.repartition(parts, "part").mapInArrow(run, FOUND), name, compression="zstd")


def body_hash(prefix: tx.Prefix, off: np.ndarray) -> np.ndarray:
    """Tells rows of one doc_id apart by their texts."""
    return prefix.spans(off[:-1], off[1:]).view(np.int64)


def source(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.col("doc_id").isNull().alias("nameless"), F.coalesce("text", F.lit("")).alias("text"))


def sample(docs: DataFrame, length: int, step: tuple[int, ...]) -> DataFrame:
    """The chosen positions of all texts as packed nodes of the first round."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(parts)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for row, data, off in tx.slices(batch.column("text")):
                prefix = tx.Prefix(data)
                at = chosen(prefix, off, length, step[0])
                doc = np.searchsorted(off, at, "right") - 1
                first = at - step[0] + 1
                packer.add(*nodes_at(prefix, first, off[doc], off[doc + 1], step[0], length), ids[row + doc], body_hash(prefix, off)[doc], first - off[doc])
                if packer.size > FLUSH:
                    yield from packer.flush()
        yield from packer.flush()

    return source(docs).select("doc_id", "text").mapInArrow(run, NODES)


def squeezed(docs: DataFrame) -> DataFrame:
    """(doc_id, nameless, body, squeezed): texts as zstandard bytes, so that a shuffle moves less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        zip_ = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for row, data, off in tx.slices(batch.column("text")):
                n, raw = len(off) - 1, data.tobytes()
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, n), batch.column("nameless").slice(row, n), pa.array(body_hash(tx.Prefix(data), off)), pa.array([zip_.compress(raw[a:b]) for a, b in zip(off.tolist(), off[1:].tolist(), strict=False)], pa.binary())], names=["doc_id", "nameless", "body", "squeezed"])

    return source(docs).mapInArrow(run, "doc_id long, nameless boolean, body long, squeezed binary")


def refine(docs: DataFrame, found: DataFrame, length: int, old: int, step: int) -> DataFrame:
    """Packed nodes of the next round: the strings of the open rows, `step` of them to a node."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    todo = found.where(F.col("state") == OPEN).groupBy("doc_id", "body").agg(F.collect_set("first").alias("first"))
    rows = squeezed(docs).drop("nameless").join(todo, ["doc_id", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unzip, packer = zstandard.ZstdDecompressor(), Packer(parts)
        for batch in batches:
            ids, bodies = batch.column("doc_id").to_pylist(), batch.column("body").to_pylist()
            for doc_id, body, raw, opened in zip(ids, bodies, batch.column("squeezed"), batch.column("first"), strict=True):
                data = np.frombuffer(unzip.decompress(raw.as_buffer()), np.uint8)
                prefix, n = tx.Prefix(data), len(data)
                first = np.unique((opened.values.to_numpy()[:, None] + np.arange(0, old, step)).ravel())
                first = first[(first + step > 0) & (first <= n - length)]
                core, around = nodes_at(prefix, first, np.zeros(len(first), np.int64), np.full(len(first), n), step, length)
                packer.add(core, around, np.full(len(first), doc_id), np.full(len(first), body), first)
                if packer.size > FLUSH:
                    yield from packer.flush()
        yield from packer.flush()

    return rows.select("doc_id", "body", "squeezed", "first").mapInArrow(run, NODES)


def repeated(docs: DataFrame, length: int = LENGTH, step: tuple[int, ...] = STEP) -> DataFrame:
    """(doc_id, body, first, width): strings that start in [first, first + width) also start earlier."""
    found = [settle(sample(docs, length, step), step[0], "suffix-0")]
    for k in range(1, len(step)):
        found.append(settle(refine(docs, found[-1], length, step[k - 1], step[k]), step[k], f"suffix-{k}"))
    return union(*found).where(F.col("state") == COVERED).drop("state")


def remove_repeats(docs: DataFrame, length: int = LENGTH, step: tuple[int, ...] = STEP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of every row of docs; spans are removed [start, end) bytes."""
    covered = repeated(docs, length, step).groupBy("doc_id", "body").agg(F.collect_list("first").alias("first"), F.collect_list("width").alias("width"))
    rows = squeezed(docs).join(covered, ["doc_id", "body"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unzip = zstandard.ZstdDecompressor()
        def emit(part: pa.RecordBatch, sizes: list, gone: list, runs: list, kept: list) -> pa.RecordBatch:
            spans = pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("nameless"), pa.array(sizes), pa.array(gone), spans, pa.array(kept, pa.binary())], names=["doc_id", "nameless", "n_bytes", "n_removed", "spans", "kept"])

        for batch in batches:
            begin, total, out = 0, 0, ([], [], [], [])
            for k, (raw, first, width) in enumerate(zip(*(batch.column(c) for c in ("squeezed", "first", "width")), strict=True)):
                data = np.frombuffer(unzip.decompress(raw.as_buffer()), np.uint8)
                depth = np.zeros(len(data) + 1, np.int64)
                if first.is_valid:
                    a = first.values.to_numpy().astype(np.int64)
                    np.add.at(depth, np.maximum(a, 0), 1)
                    np.add.at(depth, np.minimum(a + width.values.to_numpy() - 1 + length, len(data)), -1)
                removed = np.cumsum(depth)[:-1] > 0
                edge = np.diff(np.concatenate([[0], removed.astype(np.int8), [0]]))
                runs = [{"start": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]
                for column, value in zip(out, (len(data), int(removed.sum()), runs, data[~removed].tobytes()), strict=True):
                    column.append(value)
                total += len(data)
                if total > 4 * tx.SLICE_BYTES or k == batch.num_rows - 1:
                    yield emit(batch.slice(begin, k + 1 - begin), *out)
                    begin, total, out = k + 1, 0, ([], [], [], [])

    small_batches(docs.sparkSession)
    out = rows.select("doc_id", "nameless", "squeezed", "first", "width").mapInArrow(run, "doc_id long, nameless boolean, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    return out.select(F.when(~F.col("nameless"), F.col("doc_id")).alias("doc_id"), "n_bytes", "n_removed", "spans", "kept")
