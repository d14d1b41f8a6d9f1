"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

Terms are pairs of neighbouring character classes and a few word-shape shares.  Their tf-idf weights on a
bounded sample of labelled rows give a truncated SVD (latent-semantic analysis, trained here in numpy).
The labelled vectors, bounded by MAX_LABELLED x RANK, are broadcast; every document takes exact cosine
products with all of them, in blocks, and its K nearest neighbours vote with weights by similarity.

Defined results: null text counts as empty and gets a score like any other; without labelled rows every
score is 0.5; equal similarities are taken in order of the labelled ids; of labelled rows that share an id the
smallest text counts; repeated rows repeat their score; an empty table gives an empty result; other columns are
ignored (`keep_good` hands them on).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import small_batches

#: Labelled rows that the classifier is fitted on at most: those with the smallest hashes of their ids.
MAX_LABELLED = 4096
#: Dimensions of the latent space; neighbours that vote; exponent of the similarity in a vote.
RANK, K, POWER = 48, 24, 8
FOLDS = 5
ROWS = 512

_CLASS = np.full(256, 64, np.uint8)
_CLASS[0x80:] = 63
_CLASS[0xC2:0xC4] = 62
_CLASS[65:91] = 26
_CLASS[48:58] = 27
_CLASS[97:123] = np.arange(26)
_CLASS[0x20], _CLASS[0x0A] = 28, 29
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS[_MARKS] = 30 + np.arange(len(_MARKS))
KINDS = 65
#: Shares in a document, each as one of BINS terms: words like the one before, words seen before, capitals, marks, long words, short words.
SHARES, BINS, SHARE_WEIGHT = 6, 12, 12.0
TERMS = KINDS * KINDS + SHARES * BINS


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text modulo FOLDS; fold 0 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def term_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """documents x TERMS counts of one slice of at most ROWS texts."""
    n = len(off) - 1
    doc = np.repeat(np.arange(n), np.diff(off))
    kind = _CLASS[data].astype(np.int64)
    pair = kind[:-1] * KINDS + kind[1:]
    same = doc[:-1] == doc[1:]
    out = np.bincount((doc[:-1] * TERMS + pair)[same], minlength=n * TERMS).reshape(n, TERMS).astype(np.float32)
    start, end, first = tx.spans(data, off, tx.BLANKS)
    words = np.diff(first)
    owner = np.repeat(np.arange(n), words)
    hashes = tx.Prefix(tx.LOWER[data]).spans(start, end)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    seen = np.zeros(len(hashes), bool)
    seen[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    size = np.maximum(np.diff(off), 1)
    long = (end - start) > 12
    shares = [np.bincount(owner, x, n) / np.maximum(words, 1) for x in (again, seen, long, (end - start) < 3)]
    shares += [np.bincount(doc, x, n) / size for x in (kind == 26, (kind >= 30) & (kind < 62))]
    for k, share in enumerate(shares):
        bin_ = np.minimum((np.sqrt(share) * BINS).astype(int), BINS - 1)
        out[np.arange(n), KINDS * KINDS + k * BINS + bin_] = SHARE_WEIGHT
    return out


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def text_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of at most ROWS texts."""
    for row, data, off in tx.slices(batch.column("text")):
        for a in range(0, len(off) - 1, ROWS):
            part = off[a : a + ROWS + 1]
            yield row + a, data[part[0] : part[-1]], part - part[0]


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, limit: int) -> DataFrame:
    """(doc_id, text, y): at most `limit` labelled rows outside the held-out fold, by the hash of their ids."""
    rows = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    rows = rows.select(F.col("doc_id").cast("long").alias("_id"), F.col(target).cast("int").alias("y")).dropDuplicates(["_id"])
    picked = rows.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    found = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))  # rows that share an id are one


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(idf, projection, labelled vectors, labels): all of bounded size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, off in text_rows(batch):
                found = term_counts(data, off)
                at = [np.flatnonzero(r) for r in found]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, len(at)), batch.column("y").slice(row, len(at)), pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())), pa.array([r[a] for r, a in zip(found, at, strict=True)], pa.list_(pa.float32()))], names=["doc_id", "y", "term", "n"])

    got = labelled_sample(docs, labels, "quality", limit).mapInArrow(count, "doc_id long, y int, term array<int>, n array<float>").toArrow().sort_by("doc_id")
    x = np.zeros((got.num_rows, TERMS), np.float32)
    for r, (term, n) in enumerate(zip(got["term"], got["n"], strict=True)):
        x[r, term.values.to_numpy()] = n.values.to_numpy()
    y = got["y"].to_numpy().astype(np.float32)
    if not len(y):
        return np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), y
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32)
    x = weigh(x, idf)
    basis = np.random.default_rng(7).normal(size=(TERMS, RANK + 16)).astype(np.float32)
    for _ in range(3):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
    projection = (basis @ right[:RANK].T).astype(np.float32)
    return idf, projection, unit(x @ projection), y


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def vote(vectors: np.ndarray, labelled: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of label 1 among the K nearest, weighed by similarity."""
    if not len(y):
        return np.full(len(vectors), 0.5)
    similar = vectors @ labelled.T
    k = min(K, len(y))
    near = np.argpartition(-similar, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(similar, near, 1).min(1)
    for row in np.flatnonzero((similar >= least[:, None]).sum(1) > k):  # ties at the edge: the first ids
        near[row] = np.argsort(-similar[row], kind="stable")[:k]
    near.sort(axis=1)
    weight = np.clip(np.take_along_axis(similar, near, 1), 1e-3, 1).astype(float) ** POWER
    return (weight * y[near]).sum(1) / weight.sum(1)


def quality_scores(docs: DataFrame, labels: DataFrame, labelled_docs: DataFrame | None = None, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, score) of every row of docs; labelled_docs holds the labelled texts if docs does not."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs if labelled_docs is None else labelled_docs, labels, limit))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, projection, labelled, y = shared.value
        for batch in batches:
            for row, data, off in text_rows(batch):
                found = vote(unit(weigh(term_counts(data, off), idf) @ projection), labelled, y)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, len(found)), pa.array(found)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    small_batches(docs.sparkSession)
    return rows.mapInArrow(score, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, labelled_docs: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs whose score reaches the threshold, with all their columns, scored and filtered in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(labelled_docs, labels))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, projection, labelled, y = shared.value
        for batch in batches:
            for row, data, off in text_rows(batch):
                found = vote(unit(weigh(term_counts(data, off), idf) @ projection), labelled, y)
                yield batch.slice(row, len(found)).filter(pa.array(found >= threshold))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(select, docs.schema)
