"""Vector bin packing of examples into training sequences.

An example (a document's ids and its number of loss-bearing ids) has a size in three dimensions: tokens,
segments and loss-bearing tokens.  A sequence has a capacity in each.  Examples longer than a sequence are
cut; the whole pieces fill sequences by themselves, and the remainders are placed by the dot-product
heuristic: the open sequence takes, among the pieces that fit, the one whose size vector has the largest
dot product with what is left in it, each dimension weighed by the demand still waiting for it.  If cuts are
free and no waiting piece fits, the piece that scores best is cut at what is left.

Each task packs its own documents in bounded pools, so nothing is shuffled and no group of documents is
ever gathered; padding is at most one open sequence per pool.

Defined results: null or empty text gives a document of its end id alone; equal pieces are taken in input
order; repeated rows and rows without doc_id are documents of their own, packed like any other; a text of any length is
tokenized whole and cut into full sequences and a remainder; an empty table gives no pieces; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from . import tokenize as tk
from .shared import small_batches

#: Remainders that wait together for a place.
POOL = 512
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("loss_tokens", pa.int64())])


def place(sizes: np.ndarray, capacity: np.ndarray, cut: bool = True) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length); sizes: items x (tokens, segments, loss), each within capacity.

    Loss-bearing tokens are taken to lie evenly in an item when it is cut.
    """
    left = sizes.astype(float).copy()
    begin = np.zeros(len(sizes), np.int64)
    alive = np.flatnonzero(left[:, 0] > 0)
    order = alive[np.argsort(-left[alive, 0], kind="stable")]
    bins = []
    while len(order):
        room = capacity.astype(float).copy()
        demand = left[order].sum(0) / capacity
        weight = demand / max(demand.sum(), 1e-9) / capacity**2
        bin_, gone = [], np.zeros(len(order), bool)
        while room[0] > 0 and room[1] >= 1:
            size = left[order]
            fits = (size <= room + 1e-9).all(1) & ~gone
            score = size @ (room * weight)
            if fits.any():
                k = int(np.argmax(np.where(fits, score, -1)))
                item, take = order[k], int(left[order[k], 0])
                gone[k] = True
            elif cut and (~gone).any():
                k = int(np.argmax(np.where(gone, -1, score)))
                item = order[k]
                rate = left[item, 2] / left[item, 0]
                take = int(min(room[0], left[item, 0], np.inf if rate == 0 else room[2] // rate))
                if take < 1:
                    break
            else:
                break
            loss = left[item, 2] * take / left[item, 0]
            bin_.append((int(item), int(begin[item]), take))
            begin[item] += take
            left[item, 0] -= take
            left[item, 2] = max(0.0, left[item, 2] - loss)
            room -= (take, 1, loss)
        if not bin_:
            raise ValueError("an item exceeds the capacity")
        bins.append(bin_)
        order = order[~gone]
    return bins


def pack(docs: DataFrame, tokenizer: str | None = None, tokens: int = 4096, segments: int = 1024, loss: int | None = None, end_id: int = 2, cut: bool = True, loss_share: str | None = None) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset, loss_tokens) of all documents.

    ids are little-endian u32 bytes.  loss_share names a column with the share of a document's ids that
    bear loss (all of them without it); loss limits their number in a sequence (tokens without it).
    sequence_id holds the task's partition in its upper bits and counts in the lower ones.
    """
    tokenizer = tokenizer or tk.default_tokenizer()
    capacity = np.array([tokens, segments, tokens if loss is None else loss], np.int64)
    if capacity.min() < 1:
        raise ValueError("a sequence must hold at least one token, one segment and one loss-bearing token")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, sequence = tk.encoder(tokenizer), TaskContext.get().partitionId() << 33
        pool: list[tuple] = []

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECES.types, strict=True)], schema=PIECES)

        def settle(last: bool) -> pa.RecordBatch | None:
            """Empty the pool; unless it is the last one, what lies in the sequence still open waits on."""
            nonlocal sequence, pool
            sizes = np.array([(len(p[2]) // 4, 1, p[4]) for p in pool], float)
            bins, rows, wait = place(sizes, capacity, cut), [], []
            for bin_ in bins if last else bins[:-1]:
                at = 0
                for item, start, take in bin_:
                    name, base, raw, doc_tokens, bears = pool[item]
                    rows.append((name, base + start, take, raw[4 * start : 4 * (start + take)], doc_tokens, sequence, at, round(bears * take / (len(raw) // 4))))
                    at += take
                sequence += 1
            for item, start, take in [] if last else bins[-1]:
                name, base, raw, doc_tokens, bears = pool[item]
                wait.append((name, base + start, raw[4 * start : 4 * (start + take)], doc_tokens, bears * take / (len(raw) // 4)))
            pool = wait
            return emit(rows) if rows else None

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            share = batch.column("share").to_numpy(zero_copy_only=False)
            for row, data, off in tx.slices(batch.column("text")):
                ids, first = enc.ids(data, off)
                ids = np.insert(ids, first[1:], end_id)
                first = first + np.arange(len(first))
                whole = []
                for i in range(len(off) - 1):
                    n, bears = int(first[i + 1] - first[i]), min(max(float(share[row + i]), 0.0), 1.0)
                    raw = ids[first[i] : first[i + 1]].astype("<u4").tobytes()
                    most = int(capacity[0] if bears == 0 else min(capacity[0], capacity[2] // bears))
                    full = n // most * most
                    for at in range(0, full, most):
                        whole.append((names[row + i], at, most, raw[4 * at : 4 * (at + most)], n, sequence, 0, round(bears * most)))
                        sequence += 1
                    if full < n:
                        pool.append((names[row + i], full, raw[4 * full :], n, bears * (n - full)))
                    if len(pool) >= POOL and (out := settle(False)):
                        yield out
                if whole:
                    yield emit(whole)
        if pool:
            yield settle(True)

    share = F.lit(1.0) if loss_share is None else F.coalesce(F.col(loss_share).cast("double"), F.lit(1.0))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), share.alias("share"))
    small_batches(docs.sparkSession)
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, loss_tokens long")
