"""Periodic runs of words: every maximal stretch of words that repeats with a period, by comparing all lags.

For each lag p up to n / min_exponent the array of word ids is compared with itself shifted by p; a stretch of
L true positions is a run of L + p words with period p.  A run must be min_length words and min_exponent periods
long, so its stretch has a least length, and a first look at every few positions of a lag tells whether one can
be there: any such stretch holds four looked-at positions in a row.  Lags where four in a row agree are compared
as a whole and run-length coded; the look misses none.  A stretch at a multiple of the smallest period has the same
ends, so of runs with equal ends the one with the smallest lag stays.

Work is dealt out as ranges of lags of one text.  Comparing all lags of a text takes n * n / 2 steps at worst; a text
within RANGE_STEPS is one range and stays in its task, without any shuffle.  A longer one is dealt out as several
ranges to all tasks, and its runs are gathered again by (doc_id, text).

Defined results: null, empty and blank texts have no words and no runs; texts of any length are read whole; repeated
rows and null doc_ids are rows like any other, each with its result; an empty table gives no rows; other columns are ignored, whatever their
names.  Words are equal if their bytes are; blanks are [\\x20\\x09-\\x0D].
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import small_batches

#: Word comparisons of a range at most, were every lag compared as a whole: some seconds of a task.
RANGE_STEPS = 1 << 31
#: Positions of the first look that are taken at once.
LOOK = 1 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def scan(ids: np.ndarray, low: int, high: int, min_length: int = 12, min_exponent: float = 2.0) -> np.ndarray:
    """Rows (start, length, period) of all stretches at the lags low <= p < high, by lag and start."""
    n = len(ids)
    high = min(high, int(n / min_exponent) + 1)
    lag = np.arange(max(low, 1), high, dtype=np.int64)
    need = np.maximum(np.maximum(min_length - lag, np.ceil(lag * (min_exponent - 1) - 1e-9).astype(np.int64)), 1)
    lag, need = lag[need <= n - lag], need[need <= n - lag]
    if not len(lag):
        return np.zeros((0, 3), np.int64)
    step = np.maximum(need // 4, 1)
    looks = (n - lag + step - 1) // step
    found, first = [], 0
    ends = np.cumsum(looks)
    while first < len(lag):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + LOOK, "right")))
        p, s, c = lag[first:last], step[first:last], looks[first:last]
        row = np.repeat(np.arange(len(p)), c)
        at = (np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)) * s[row]
        same = ids[at] == ids[at + p[row]]
        four = same.copy()
        for k in (1, 2, 3):  # a stretch of fewer than four positions is looked at everywhere
            short = need[first:last][row[: len(row) - k]] <= k
            four[: len(row) - k] &= same[k:] | short
            four[len(row) - k :] &= need[first:last][row[len(row) - k :]] <= k
        found.append(first + np.unique(row[four]))
        first = last
    hits = np.concatenate(found)
    return np.concatenate([np.zeros((0, 3), np.int64), *(stretches(ids, int(lag[k]), int(need[k])) for k in hits)])


def stretches(ids: np.ndarray, lag: int, need: int) -> np.ndarray:
    """Runs of one lag: the whole array against its shift, run-length coded."""
    same = np.zeros(len(ids) - lag + 2, np.int8)
    same[1:-1] = ids[:-lag] == ids[lag:]
    turn = np.flatnonzero(np.diff(same))
    start, length = turn[::2], turn[1::2] - turn[::2]
    keep = length >= need
    start, length = start[keep], length[keep] + lag
    return np.column_stack([start, length, np.full(len(start), lag)])


def smallest(runs: np.ndarray) -> np.ndarray:
    """Of runs with equal ends the one with the smallest period, by start, then period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    keep = np.ones(len(runs), bool)
    keep[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[keep]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def words_of(raw: bytes | None) -> tuple[list[bytes], np.ndarray]:
    words = (raw or b"").split()  # bytes.split takes just the blanks above
    numbers: dict[bytes, int] = {}
    return words, np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, without those that a run repeats, joined by one blank."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k]) if len(runs) else b" ".join(words)


def lists(runs: list[np.ndarray]) -> pa.Array:
    """Arrays of runs as one list column."""
    flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(_RUN.value_type)))


def periodic_runs(docs: DataFrame, min_length: int = 12, min_exponent: float = 2.0, range_steps: int = RANGE_STEPS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row; runs are ordered by start, then period."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("text"))
    long_bytes = 2 * math.isqrt(2 * range_steps)  # a shorter text has too few words for a second range
    limits = (min_length, min_exponent)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, left = [], [], []
            for raw in batch.column("text").to_pylist():
                words, ids = words_of(raw)
                runs.append(smallest(scan(ids, 1, len(ids), *limits)))
                counts.append(len(words))
                left.append(collapse(words, runs[-1]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), lists(runs), pa.array(left, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = batch.column("low").to_pylist(), batch.column("high").to_pylist()
            runs = [scan(words_of(raw)[1], a, b, *limits) for raw, a, b in zip(batch.column("text").to_pylist(), low, high, strict=True)]
            text = [raw if a == 1 else None for raw, a in zip(batch.column("text").to_pylist(), low, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "digest", "copies")] + [pa.array(text, pa.binary()), lists(runs)], ["doc_id", "digest", "copies", "text", "runs"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, left = [], [], []
            for raw, parts in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                words = raw.split()
                found = np.array([(r["start"], r["length"], r["period"]) for p in parts for r in p], np.int64).reshape(-1, 3)
                runs.append(smallest(found))
                counts.append(len(words))
                left.append(collapse(words, runs[-1]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("copies"), pa.array(counts, pa.int64()), lists(runs), pa.array(left, pa.binary()).cast(pa.string())], ["doc_id", "copies", "n_words", "runs", "collapsed"])

    small_batches(docs.sparkSession)
    size = F.octet_length("text")
    whole = rows.where(size < long_bytes).mapInArrow(short, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
    words = F.floor((size + 1) / 2)
    per = F.greatest(F.lit(1), F.floor(F.lit(range_steps) / words))  # lags of a range
    each = rows.where(size >= long_bytes).withColumn("digest", F.sha2("text", 256)).groupBy("doc_id", "digest").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    lags = F.floor(words / F.lit(float(min_exponent))) + 1
    dealt = each.withColumn("low", F.explode(F.sequence(F.lit(1).cast("long"), F.greatest(lags, F.lit(1)).cast("long"), per.cast("long")))).withColumn("high", F.col("low") + per)
    ranges = dealt.repartition("doc_id", "digest", "low").mapInArrow(part, f"doc_id long, digest string, copies long, text binary, runs {RUNS}")
    back = ranges.groupBy("doc_id", "digest").agg(F.first("text", ignorenulls=True).alias("text"), F.first("copies").alias("copies"), F.collect_list("runs").alias("runs"))
    done = back.select("doc_id", "copies", "text", "runs").mapInArrow(finish, f"doc_id long, copies long, n_words long, runs {RUNS}, collapsed string")
    again = done.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc_id", "n_words", "runs", "collapsed")
    return whole.unionByName(again)
