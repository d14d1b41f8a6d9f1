"""Masked pseudo-likelihood scores from a bidirectional window network.

Words are told apart by their 64-bit hashes and counted over all documents.  Their classes come from BUCKETS of
hashes: each belongs to one of CLASSES classes (frequent buckets alone, the others dealt by frequency so that
classes are about equally likely).  The network sees the classes of two words on each side of a masked word,
sums one embedding per place, bends it by tanh and gives a softmax over classes; within its class a word has its
share of the counts.  A document's score is the sum over its words of log P(word | both sides).

Training: documents are dealt into shards of about SHARD_WORDS words by the hash of their id and text, so the
result does not depend on how the table is split.  Each shard trains one network (numpy, Adagrad) in order of
the hashes; networks are averaged, weighted by words, with exact sums: once after a quarter of all documents,
and again after the others, which start from that average.  What is gathered grows with the input, and every
document counts.  Only the classes of BUCKETS and the network are broadcast.

Counts: a task lists the words of a chunk of text once, with the documents that hold them, and sends each
list, packed, to the tasks that own its words.  An owner sees all lists of its words, sums their counts and
answers with sums for each document of a chunk, which meet the network's part of the score there.

Defined results: null text counts as empty; a text without words has 0 words, a sum of 0 and a null mean;
an empty table gives an empty result; repeated rows repeat their score and are trained on in one shard; texts of
any length are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import materialize, small_batches

BUCKETS, CLASSES, WIDTH, SIDE = 1 << 16, 128, 16, 2
#: Buckets with a class of their own; the last class stands for what lies beyond either end of a text.
ALONE, EDGE = 96, CLASSES - 1
BATCH, RATE = 8192, 0.15
#: Words that one network is trained on, about; one document in FIRST trains before the first average.
SHARD_WORDS, FIRST = 2_000_000, 4
#: Bytes of text in a chunk.
CHUNK = 4 * tx.SLICE_BYTES
#: Averages and logarithms are sums of multiples of 1 / FIXED, which no order of adding changes.
FIXED = float(1 << 30)
PLACES = (*range(-SIDE, 0), *range(1, SIDE + 1))
SHAPES = ((len(PLACES), CLASSES, WIDTH), (WIDTH, CLASSES), (CLASSES,))


def bucket_docs(docs: DataFrame) -> DataFrame:
    """(key, buckets) of all documents in the shared folder: words as little-endian u16 bucket numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, off in tx.slices(batch.column("text")):
                word, first = tx.words(data, off, tx.BLANKS)
                k = len(off) - 1
                raw = (word >> np.uint64(48)).astype("<u2").tobytes()
                column = pa.Array.from_buffers(pa.binary(), k, [None, pa.py_buffer((first * 2).astype(np.int32).tobytes()), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(row, k), column], names=["key", "buckets"])

    rows = docs.select(F.xxhash64("doc_id", "text").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    return materialize(rows.mapInArrow(run, "key long, buckets binary"), "lm-buckets", compression="zstd")


def binary_parts(column: pa.Array, limit: int = 200_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, u16 values, offsets) of consecutive rows with about `limit` values; no row is cut."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(column.buffers()[2] or b"", np.uint8)[off[0] : off[-1]].view("<u2") if len(column) else np.zeros(0, np.uint16)
    off = (off - off[0]) // 2
    row = 0
    while row < len(column):
        end = max(row + 1, min(len(column), int(np.searchsorted(off, off[row] + limit, "right")) - 1))
        yield row, values[off[row] : off[end]], off[row : end + 1] - off[row]
        row = end


def count_buckets(rows: DataFrame) -> np.ndarray:
    """Words of each bucket over all documents: summed per task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, values, _ in binary_parts(batch.column("buckets")):
                total += np.bincount(values, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    found = rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each bucket, log P(bucket | class), log P(class)), with add-one smoothing of the counts."""
    order = np.argsort(-counts, kind="stable")
    of = np.empty(BUCKETS, np.uint8)
    of[order[:ALONE]] = np.arange(ALONE)
    shared = EDGE - ALONE
    of[order[ALONE:]] = ALONE + np.arange(BUCKETS - ALONE) % shared
    n = counts + 1.0
    total = np.bincount(of, n, CLASSES)
    return of, (np.log(n) - np.log(total[of])).astype(np.float32), np.log((total + 1) / (total + 1).sum()).astype(np.float32)


class Network:
    """Weights of the window network; all arithmetic in float32."""

    def __init__(self, weights: list[np.ndarray]):
        self.embed, self.out, self.bias = weights

    @classmethod
    def fresh(cls, prior: np.ndarray) -> "Network":
        rng = np.random.default_rng(11)
        return cls([(0.3 * rng.normal(size=s)).astype(np.float32) for s in SHAPES[:2]] + [prior.copy()])

    def hidden(self, context: list[np.ndarray]) -> np.ndarray:
        h = self.embed[0][context[0]]
        for e, c in zip(self.embed[1:], context[1:], strict=True):
            h += e[c]
        return np.tanh(h, out=h)

    def log_probs(self, target: np.ndarray, context: list[np.ndarray]) -> np.ndarray:
        z = self.hidden(context) @ self.out + self.bias
        picked = z[np.arange(len(target)), target]
        top = z.max(1)
        return picked - top - np.log(np.exp(z - top[:, None]).sum(1))

    def train(self, target: np.ndarray, context: list[np.ndarray], memory: list[np.ndarray]) -> None:
        """One Adagrad step on one batch."""
        h = self.hidden(context)
        z = h @ self.out + self.bias
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(1, keepdims=True)
        z[np.arange(len(target)), target] -= 1
        z /= len(target)
        back = (z @ self.out.T) * (1 - h * h)
        embed = np.zeros_like(self.embed)
        for k, c in enumerate(context):
            order = np.argsort(c, kind="stable")
            ordered = c[order]
            starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            embed[k][ordered[starts]] = np.add.reduceat(back[order], starts, axis=0)
        for w, g, m in zip((self.embed, self.out, self.bias), (embed, h.T @ z, z.sum(0)), memory, strict=True):
            m += g * g
            w -= RATE * g / (np.sqrt(m) + 1e-6)


def windows(of: np.ndarray, values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(class of every word, classes at each place around it); EDGE beyond a text's ends."""
    n = np.diff(off)
    shift = np.repeat(np.arange(len(n)), n) * SIDE + SIDE
    padded = np.full(len(values) + SIDE * (len(n) + 1), EDGE, np.uint8)
    at = np.arange(len(values)) + shift
    padded[at] = of[values]
    return padded[at], [padded[at + p] for p in PLACES]


def train(rows: DataFrame, of: np.ndarray, prior: np.ndarray, shards: int, begin: list[np.ndarray]) -> list[np.ndarray]:
    """Average of the shards' networks, each trained on all of its documents from a common start."""
    shared = rows.sparkSession.sparkContext.broadcast((of, prior, begin))
    dealt = rows.withColumn("shard", F.pmod("key", F.lit(shards))).repartition(shards, "shard").sortWithinPartitions("shard", "key", "buckets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, prior, begin = shared.value
        shard, net, memory, seen = None, None, None, 0

        def emit() -> pa.RecordBatch:
            flat = np.concatenate([w.ravel() for w in (net.embed, net.out, net.bias)]).astype(np.float64)
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(np.rint(flat * FIXED).astype(np.int64)), pa.array(np.full(len(flat), seen))], names=["place", "value", "words"])

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            for start, end in runs_of(shards):
                if shards[start] != shard:
                    if seen:
                        yield emit()
                    shard, net, seen = shards[start], Network([w.copy() for w in begin]), 0
                    memory = [np.full(s, 1e-8, np.float32) for s in SHAPES]
                for _, values, off in binary_parts(batch.column("buckets").slice(start, end - start)):
                    target, context = windows(of, values, off)
                    for a in range(0, len(target), BATCH):
                        net.train(target[a : a + BATCH], [c[a : a + BATCH] for c in context], memory)
                    seen += len(target)
        if seen:
            yield emit()

    exact = lambda c: F.col(c).cast("decimal(19,0)")
    nets = dealt.select("shard", "buckets").mapInArrow(run, "place long, value long, words long")
    total = nets.groupBy("place").agg((F.sum(exact("value") * exact("words")).cast("double") / F.sum("words")).alias("value")).toArrow()
    if not total.num_rows:
        return begin
    flat = np.zeros(total.num_rows, np.float32)
    flat[total["place"].to_numpy()] = total["value"].to_numpy() / FIXED
    edges = np.cumsum([int(np.prod(s)) for s in SHAPES])[:-1]
    return [w.reshape(s) for w, s in zip(np.split(flat, edges), SHAPES, strict=True)]


def runs_of(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """[start, end) of the runs of equal values."""
    edge = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])) if len(values) else np.zeros(1, int)
    yield from zip(edge.tolist(), edge[1:].tolist(), strict=False)


def fit(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(class of each bucket, log of the words of each class, weights of the network)."""
    rows = bucket_docs(docs)
    counts = count_buckets(rows)
    of, _, prior = classes(counts)
    fresh = Network.fresh(prior)
    weights, early = [fresh.embed, fresh.out, fresh.bias], F.pmod(F.shiftright("key", 20), F.lit(FIRST)) == 0
    shards = -(-int(counts.sum()) // SHARD_WORDS) or 1
    for part in (early, ~early):
        weights = train(rows.where(part), of, prior, shards, weights)
    return of, np.log(np.maximum(np.bincount(of, counts, CLASSES), 1)), weights


ROW, LIST, SUMS = 0, 1, 2
SENT = pa.schema([("part", pa.int32()), ("kind", pa.int8()), ("chunk", pa.int64()), ("run", pa.binary())])


def pack_list(word: np.ndarray, doc: np.ndarray, count: np.ndarray, docs: int) -> bytes:
    """Rows sorted by word: words | rows per word | documents | how often each holds the word."""
    start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    wide, often = (4 if docs > 1 << 16 else 2), (1 if count.max() < 256 else 4)
    head = np.array([len(start), len(word), wide, often], "<u4").tobytes()
    return b"".join([head, word[start].astype("<u8").tobytes(), np.diff(np.append(start, len(word))).astype("<u4").tobytes(), doc.astype(f"<u{wide}").tobytes(), count.astype(f"<u{often}").tobytes()])


def unpack_list(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    k, n, wide, often = np.frombuffer(raw, "<u4", 4).tolist()
    at, out = 16, []
    for kind, m in (("<u8", k), ("<u4", k), (f"<u{wide}", n), (f"<u{often}", n)):
        out.append(np.frombuffer(raw, kind, m, at))
        at += out[-1].nbytes
    word, rows, doc, count = out
    return word, rows.astype(np.int64), doc, count


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, log_prob, mean_log_prob) of every row of docs, under the network trained on docs."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(fit(docs))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, size, weights = shared.value
        net, chunk, held, bytes_ = Network(weights), TaskContext.get().partitionId() << 36, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal chunk
            ids, n, inner = pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            word = np.concatenate([h[3] for h in held])
            measured = pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(inner)], names=["doc_id", "n_words", "inner"])
            rows = [(chunk % parts, ROW, chunk, tx.ipc(measured))]
            if len(word):
                doc = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((doc, word))
                word, doc = word[order], doc[order]
                new = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])]))
                count = np.diff(np.append(new, len(word)))
                word, doc = word[new], doc[new]
                to = (word % np.uint64(parts)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                edge = np.searchsorted(to[order], np.arange(parts + 1))
                for p, (a, b) in enumerate(zip(edge.tolist(), edge[1:].tolist(), strict=False)):
                    if b > a:
                        rows.append((p, LIST, chunk, pack_list(word[order[a:b]], doc[order[a:b]], count[order[a:b]], len(n))))
            chunk += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SENT.types, strict=True)], schema=SENT)

        for batch in batches:
            for row, data, off in tx.slices(batch.column("text")):
                word, first = tx.words(data, off, tx.BLANKS)
                target, context = windows(of, (word >> np.uint64(48)).astype(np.int64), first)
                each = -size[target]
                for a in range(0, len(target), BATCH):
                    each[a : a + BATCH] += net.log_probs(target[a : a + BATCH], [c[a : a + BATCH] for c in context])
                doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
                inner = np.bincount(doc, np.rint(each * FIXED) / FIXED, len(off) - 1)
                held.append((batch.column("doc_id").slice(row, len(off) - 1), np.diff(first), inner, word))
                bytes_ += len(data)
                if bytes_ >= CHUNK:
                    yield flush()
                    bytes_ = 0
        if held:
            yield flush()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            listed = np.asarray(batch.column("kind")) == LIST
            yield batch.filter(pa.array(~listed))
            held += [(c, run.as_py()) for c, run in zip(batch.column("chunk").filter(pa.array(listed)).to_pylist(), batch.column("run").filter(pa.array(listed)), strict=True)]
        if not held:
            return
        word, total = [], []
        for _, raw in held:
            words, rows, _, count = unpack_list(raw)
            word.append(words)
            total.append(np.add.reduceat(count.astype(np.int64), np.cumsum(rows) - rows))
        names, at = np.unique(np.concatenate(word), return_inverse=True)
        total = np.bincount(at, np.concatenate(total), len(names))
        each = np.rint(np.log(total) * FIXED) / FIXED
        begin, part = 0, TaskContext.get().partitionId()
        for chunk, raw in held:
            words, rows, doc, count = unpack_list(raw)
            log = np.repeat(each[at[begin : begin + len(words)]], rows)
            begin += len(words)
            sums = np.bincount(doc, log * count)
            pick = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([SUMS], pa.int8()), pa.array([chunk]), pa.array([pick.astype("<u4").tobytes() + sums[pick].tobytes()], pa.binary())], schema=SENT)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known, inner = None, None, None

        def emit() -> pa.RecordBatch:
            n = known.column("n_words").to_numpy()
            mean = pa.array(np.divide(inner, n, out=np.zeros(len(n)), where=n > 0), mask=n == 0)
            return pa.RecordBatch.from_arrays([known.column("doc_id"), known.column("n_words"), pa.array(inner), mean], names=["doc_id", "n_words", "log_prob", "mean_log_prob"])

        for batch in batches:
            for kind, chunk, run in zip(batch.column("kind").to_pylist(), batch.column("chunk").to_pylist(), batch.column("run"), strict=True):
                if chunk != current:
                    if current is not None:
                        yield emit()
                    current = chunk
                if kind == ROW:  # the first of its chunk
                    known = pa.ipc.open_stream(run.as_buffer()).read_next_batch()
                    inner = known.column("inner").to_numpy().copy()
                else:
                    raw = run.as_py()
                    k = len(raw) // 12
                    inner[np.frombuffer(raw, "<u4", k)] += np.frombuffer(raw, "<f8", k, 4 * k)
        if current is not None:
            yield emit()

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "part int, kind byte, chunk long, run binary"
    answers = rows.mapInArrow(send, schema).repartition(parts, "part").mapInArrow(answer, schema)
    both = answers.select("kind", "chunk", "run").repartition(parts, "chunk").sortWithinPartitions("chunk", "kind")
    small_batches(docs.sparkSession)
    return both.mapInArrow(add, "doc_id long, n_words long, log_prob double, mean_log_prob double")

