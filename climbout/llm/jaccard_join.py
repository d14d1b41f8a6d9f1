"""N-gram Jaccard join with parity sketches: exact links and components of documents with similar shingle sets.

Two documents link when their sets of word shingles have a Jaccard similarity of at least 0.8.  Then their
sets differ in at most a quarter of the smaller one, and in at most 2/9 of the upper bound of the larger
one's size band.  Per size band, the hash space is cut into a few more segments than that; a document's
sketch holds the parity word (XOR of the shingles' 64-bit hashes) of each segment, and the number of unequal
words bounds the symmetric difference from below.  By the pigeonhole principle a linked pair agrees in a
segment that is not empty, provided the document has more filled segments than differences allowed:

1. segments over the shingles that are not very common (the common ones come from a sample; any choice is
   exact, because leaving shingles out on both sides never adds differences);
2. documents too poor in those also take segments over all their shingles;
3. documents still too poor also take the smallest hashes of their set, a plain prefix filter.

Documents with equal sets are one node from the start.  Words are sent packed and grouped in tasks; groups
with the same members are kept once.  Pairs are then found in two ways:

* Nearest ones, a slice of the words at a time: members of a word are dealt into small blocks by a hash, and each
  is paired with the nearest one of its block.  What is verified joins components, and words whose members are
  in one component are closed, so a large group of near copies falls together after a few of its words.
* All pairs, for the words still open: a pair inside one component needs no look, so the members outside of a word's
  largest component (its hubs) meet all members.  Both sides are dealt in blocks, so no task holds a whole word.

Both compare parity bit sketches of the whole sets (one bit per shingle, XOR), whose Hamming distance bounds the
symmetric difference from below; only pairs within the bound are written and verified on the sets.

Defined results: null or wordless texts have an empty set and are alone; a text of fewer words than a
shingle has its whole sequence as its one shingle; null doc_ids take part, and a component of only such
rows has a null component_id; repeated rows are equal sets; texts of any length are read whole; of equally
small names any may lead; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import BROADCAST_ROWS, attach, components, materialize, positional, union

#: Similarity in percent, words in a shingle.
PERCENT, WORDS = 80, 5
#: One text in SAMPLE is asked for common shingles; those of at least COMMON of them, COMMON_MOST at most, are left out of step 1.
SAMPLE, COMMON, COMMON_MOST = 16, 4, 200_000
#: Words held by a task before they are sent; members of one word in them that make it hot.
FLUSH, HOT = 350_000, 64
#: Shares in which a task groups its words.
CUTS = 4
#: What a run holds: rows of the owner, the smallest node of hot words, all nodes of hot words, measured documents.
OWNED, LEAD, MEMBER, ROW = 0, 1, 2, 3
#: Words are cut into SLICES by their hashes; nearest ones are sought in these slices, [from, to), in rounds.
SLICES, ROUNDS = 32, ((0, 4), (4, 16))
#: Members among which the nearest one is sought, and members of each side of a block of all pairs.
NEAR, BLOCK = 192, 1024
#: Pairs of one hub verified in one task; 64-bit words of a bit sketch at most (longer ones are folded).
HUB_RUN, SKETCH = 64, 512
FAR = 1 << 40
_BOUNDS = [0, 1]
while _BOUNDS[-1] < 1 << 40:
    _BOUNDS.append(max(_BOUNDS[-1] + 1, _BOUNDS[-1] * 3 // 2))
BOUNDS = np.array(_BOUNDS)


def node_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set; equal sets, and practically only those, share it."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tx.mix(hashes))])
    return tx.mix((sums[first[1:]] - sums[first[:-1]]) ^ (np.diff(first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)


def segment_words(hashes: np.ndarray, owner: np.ndarray, segments: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, parity word) of all filled segments; hashes are sorted within an owner, so segments are runs."""
    if not len(hashes):
        return owner, hashes
    seg = ((hashes >> np.uint64(32)) * segments[owner].astype(np.uint64)) >> np.uint64(32)
    new = np.ones(len(hashes), bool)
    new[1:] = (seg[1:] != seg[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    parity = np.bitwise_xor.reduceat(tx.mix(hashes), at)
    return owner[at], tx.mix(parity ^ tx.mix(salt[owner[at]] + seg[at]))


def sketch(hashes: np.ndarray, first: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, word): what the documents of a slice are grouped by, for every size band they may link in."""
    n = np.diff(first)
    docs, bands = [], []
    own = np.searchsorted(BOUNDS, n)
    last = np.searchsorted(BOUNDS, n * 100 // PERCENT)
    for up in range(int((last - own).max(initial=0)) + 1):
        here = np.flatnonzero((n > 0) & (own + up <= last))
        docs.append(here)
        bands.append(own[here] + up)
    doc, band = np.concatenate(docs), np.concatenate(bands)
    high = BOUNDS[band]
    differ = np.minimum(2 * (100 - PERCENT) * high // (100 + PERCENT), n[doc] * (100 - PERCENT) // PERCENT)
    segments = np.where(2 * (100 - PERCENT) * high // (100 + PERCENT) == 0, 1, np.ceil(1.08 * (2 * (100 - PERCENT) * high // (100 + PERCENT) + 1)).astype(np.int64) + 2)
    rare = ~np.isin(hashes, common) if len(common) else np.ones(len(hashes), bool)
    out = []
    todo = np.arange(len(doc))
    for step, keep in ((1, rare), (2, np.ones(len(hashes), bool))):
        at = tx.ragged(first[doc[todo]], n[doc[todo]])
        owner = np.repeat(todo, n[doc[todo]])[keep[at]]
        salt = (band * 4 + step).astype(np.uint64) << np.uint64(40)
        owner, word = segment_words(hashes[at][keep[at]], owner, segments, salt)
        out.append((doc[owner], word))
        filled = np.bincount(owner, minlength=len(doc))
        todo = todo[filled[todo] <= differ[todo]]
    poor = np.unique(doc[todo])
    prefix = n[poor] - -(-n[poor] * PERCENT // 100) + 1
    at = tx.ragged(first[poor], prefix)
    out.append((np.repeat(poor, prefix), tx.mix(hashes[at] + np.uint64(3))))
    return np.concatenate([d for d, _ in out]), np.concatenate([w for _, w in out])


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of shingles that many sets of the sampled texts have; bounded by COMMON_MOST."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, off in tx.slices(batch.column("text")):
                hashes, first = tx.shingles(data, off, WORDS)
                node = node_of(hashes, first)
                once = np.unique(node, return_index=True)[1]
                yield pa.RecordBatch.from_arrays([pa.array(node[once]), pa.array([hashes[first[k] : first[k + 1]].view(np.int64) for k in once], pa.list_(pa.int64()))], names=["node", "set"])

    sample = texts(docs).where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(run, "node long, set array<long>")
    each = sample.dropDuplicates(["node"]).select(F.explode("set").alias("h"))
    found = each.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON).orderBy(F.desc("n"), "h").limit(COMMON_MOST).select("h").toArrow()
    return np.sort(found["h"].to_numpy().view(np.uint64))


def encode_run(node: np.ndarray, word: np.ndarray) -> bytes:
    """Rows sorted by node as: nodes | words per node | words."""
    start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    count = np.diff(np.append(start, len(node))).astype("<u4")
    return np.uint32(len(start)).tobytes() + node[start].astype("<i8").tobytes() + count.tobytes() + word.astype("<u8").tobytes()


def decode_run(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = int(np.frombuffer(raw, "<u4", 1)[0])
    node, count = np.frombuffer(raw, "<i8", k, 4), np.frombuffer(raw, "<u4", k, 4 + 8 * k)
    return np.repeat(node, count), np.frombuffer(raw, "<u8", -1, 4 + 12 * k)


GROUPED = pa.schema([("kind", pa.int8()), ("word", pa.int64()), ("node", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64())])


def grouped(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """One pass over all texts; in the shared folder, by kind: every document's (doc_id, n, node), and the (word, node) of all words that more than one node has.

    Words travel packed to the task that owns them.  A word that one task sees for many nodes is hot: its
    members are dealt over all tasks and passed on as they are, only the smallest goes to the owner, marked
    as a lead: the owner does not see such a word's members, so it keeps its group whatever the others hold.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(common)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, turn = [], 0, TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            node, word = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((node, word))
            node, word = node[order], word[order]
            new = np.concatenate([[True], (word[1:] != word[:-1]) | (node[1:] != node[:-1])])
            node, word = node[new], word[new]
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            count = np.diff(np.append(start, len(word)))
            hot = np.repeat(count > HOT, count)
            lead = np.zeros(len(word), bool)
            lead[start] = hot[start]
            rows = []
            for kind, pick in ((OWNED, ~hot), (LEAD, lead), (MEMBER, hot)):
                n, w = node[pick], word[pick]
                to = ((w ^ n.view(np.uint64) if kind == MEMBER else w) % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((n, to))
                n, w, to = n[order], w[order], to[order]
                edge = np.searchsorted(to, np.arange(parts + 1))
                rows += [(p, kind, encode_run(n[a:b], w[a:b])) for p, (a, b) in enumerate(zip(edge, edge[1:], strict=False)) if b > a]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int8(), pa.binary()), strict=True)], names=["part", "kind", "run"])

        for batch in batches:
            for row, data, off in tx.slices(batch.column("text")):
                hashes, first = tx.shingles(data, off, WORDS)
                node, n = node_of(hashes, first), np.diff(first)
                measured = pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, len(n)), pa.array(n), pa.array(node, mask=n == 0)], names=["doc_id", "n", "node"])
                yield pa.RecordBatch.from_arrays([pa.array([turn % parts], pa.int32()), pa.array([ROW], pa.int8()), pa.array([tx.ipc(measured)], pa.binary())], names=["part", "kind", "run"])
                turn += 1
                keep = np.isin(np.arange(len(node)), np.unique(node, return_index=True)[1])
                doc, word = sketch(hashes, first, shared.value)
                held.append((node[doc][keep[doc]], word[keep[doc]]))
                size += len(held[-1][0])
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def emit(node: np.ndarray, word: np.ndarray) -> pa.RecordBatch:
        k = len(node)
        return pa.RecordBatch.from_arrays([pa.array(np.full(k, OWNED, np.int8)), pa.array(word.view(np.int64)), pa.array(node), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], schema=GROUPED)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = [], np.zeros(0, np.uint64)
        for batch in batches:
            for kind, run in zip(batch.column("kind").to_pylist(), batch.column("run"), strict=True):
                if kind == ROW:
                    for part in pa.ipc.open_stream(run.as_buffer()):
                        k = part.num_rows
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(k, ROW, np.int8)), pa.nulls(k, pa.int64()), part.column("node"), part.column("doc_id"), part.column("n")], schema=GROUPED)
                elif kind == MEMBER:
                    yield emit(*decode_run(run.as_buffer()))
                else:
                    held.append((kind, run.as_py()))
        for cut in range(CUTS if held else 0):  # a share of the words at a time
            node, word, lead = [], [], []
            for kind, raw in held:
                n, w = decode_run(raw)
                here = (w >> np.uint64(32)) % np.uint64(CUTS) == cut
                node.append(n[here])
                word.append(w[here])
                if kind == LEAD:
                    lead.append(word[-1])
            node, word = np.concatenate(node), np.concatenate(word)
            if not len(node):
                continue
            order = np.lexsort((node, word))
            node, word = node[order], word[order]
            new = np.concatenate([[True], (word[1:] != word[:-1]) | (node[1:] != node[:-1])])
            node, word = node[new], word[new]
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            count = np.diff(np.append(start, len(word)))
            members = np.add.reduceat(tx.mix(node.view(np.uint64)), start)
            if lead:  # a group whose members are elsewhere is like no other
                elsewhere = np.isin(word[start], np.concatenate(lead))
                members[elsewhere] = tx.mix(members[elsewhere] ^ tx.mix(word[start][elsewhere]))
            several = np.flatnonzero(count > 1)
            once = several[np.unique(members[several], return_index=True)[1]]  # groups of the same members, once
            once = once[~np.isin(members[once], seen)]
            seen = np.concatenate([seen, members[once]])
            at = tx.ragged(start[once], count[once])
            for a in range(0, len(at), 200_000):
                yield emit(node[at[a : a + 200_000]], word[at[a : a + 200_000]])

    rows = texts(docs).mapInArrow(send, "part int, kind byte, run binary")
    return materialize(rows.repartition(parts, "part").mapInArrow(group, "kind byte, word long, node long, doc_id long, n long"), "jaccard-groups", compression="zstd")


def parity_bits(hashes: np.ndarray) -> bytes:
    """Bit sketch of a set: each shingle flips one bit; three to six bits per shingle, a power of two."""
    size = min(64 * SKETCH, 1 << max(6, (3 * len(hashes)).bit_length()))
    bits = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(bool), bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The sketch of the same set in `size` 64-bit words: halves are XORed onto each other."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def apart(hubs: list, members: list) -> Iterator[tuple[int, np.ndarray]]:
    """(first hub, Hamming distances hub x member) by blocks of hubs; pairs that cannot be similar, or need not be known, have a huge one."""
    size = min(len(x[3]) for x in (*hubs, *members))
    a, b = (np.stack([folded(x[3], size) for x in side]) for side in (hubs, members))
    na, nb = (np.array([x[2] for x in side]) for side in (hubs, members))
    ca, cb = (np.array([x[1] for x in side]) for side in (hubs, members))
    block = max(1, 2_000_000 // (size * len(members)))
    for k in range(0, len(hubs), block):
        at = slice(k, k + block)
        distance = np.bitwise_count(a[at, None, :] ^ b[None, :, :]).sum(2, dtype=np.int64)
        both = na[at, None] + nb[None, :]
        fine = ((100 + PERCENT) * distance <= (100 - PERCENT) * both) & (ca[at, None] != cb[None, :])
        fine &= 100 * np.minimum(na[at, None], nb[None, :]) >= PERCENT * np.maximum(na[at, None], nb[None, :])
        yield k, np.where(fine, distance, FAR)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list]]:
    """(key, rows) of a sorted stream; a row is (node, component, n, bits as 64-bit words)."""
    current, held = None, []
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in keys]
        node, component, n = (batch.column(c).to_numpy() for c in ("node", "component", "n"))
        bits = batch.column("bits")
        change = np.zeros(max(len(node) - 1, 0), bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        edge = [0, *(np.flatnonzero(change) + 1).tolist(), len(node)]
        for a, b in zip(edge, edge[1:], strict=False):
            if a == b:
                continue
            if (key := tuple(c[a] for c in columns)) != current:
                if held:
                    yield current, held
                current, held = key, []
            held += [(node[i], component[i], n[i], np.frombuffer(bits[i].as_buffer(), np.uint64)) for i in range(a, b)]
    if held:
        yield current, held


def pair_batches(pairs: Iterator[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Pairs (smaller node, larger node), without those that a batch already has."""
    found: set[tuple[int, int]] = set()

    def emit() -> pa.RecordBatch:
        x, y = zip(*found, strict=True)
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    for x, y in pairs:
        found.add((min(x, y), max(x, y)))
        if len(found) >= 100_000:
            yield emit()
    if found:
        yield emit()


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, bits, value) of the wanted (node, doc_id), once each, in the shared folder: bit sketches and sorted u64 hashes.

    A set comes from a row that stands for it; only such rows' texts are read again.
    """
    few = wanted.count() <= BROADCAST_ROWS
    ids = wanted.select(F.col("doc_id").alias("_id")).distinct()
    narrow = texts(docs)
    narrow = narrow.join(F.broadcast(ids) if few else ids, narrow.doc_id.eqNullSafe(ids._id), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, off in tx.slices(batch.column("text")):
                hashes, first = tx.shingles(data, off, WORDS)
                n = np.diff(first)
                keep = np.flatnonzero(n > 0)
                each = [hashes[first[k] : first[k + 1]] for k in keep]
                columns = [pa.array(node_of(hashes, first)[keep]), batch.column("doc_id").slice(row, len(n)).take(pa.array(keep)), pa.array(n[keep]), pa.array([parity_bits(x) for x in each], pa.binary()), pa.array([x.tobytes() for x in each], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "doc_id", "n", "bits", "value"])

    found = narrow.mapInArrow(run, "node long, doc_id long, n long, bits binary, value binary")
    named = wanted.select(F.col("node").alias("_node"), F.col("doc_id").alias("_doc"))
    match = (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    sets = materialize(found.join(F.broadcast(named) if few else named, match, "left_semi").drop("doc_id"), "jaccard-sets")
    if sets.groupBy("node").count().where("count > 1").isEmpty():
        return sets
    return materialize(sets.dropDuplicates(["node"]), "jaccard-sets")  # of rows that are repeated as a whole


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough.

    A hub's set is sent once for every HUB_RUN of its pairs, so hubs of any degree are dealt over tasks.
    """
    runs = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_RUN).cast("int").alias("runs"))
    hubs = sets.join(runs, sets.node == runs.a).select("a", F.col("value").alias("hashes"), F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"), "runs")
    hub = hubs.select("a", "run", F.col("hashes").alias("left"))
    sizes = attach(pairs, runs.withColumn("n", F.col("runs").cast("long")), ["a"], "inner").withColumn("run", F.pmod(F.xxhash64("b"), F.col("runs")).cast("int"))
    both = sizes.join(sets.select(F.col("node").alias("b"), F.col("value").alias("right")), "b").join(hub, ["a", "run"])
    near = F.least(F.length("left"), F.length("right")) * 100 >= F.greatest(F.length("left"), F.length("right")) * PERCENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.where(near).select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def distinct_groups(words: DataFrame) -> DataFrame:
    """The rows of words of which no other has the same members, one word for each set of members, in the shared folder.

    Tasks have dropped such words among their own; over all tasks they are told by two 64-bit hashes of the members.
    """
    once = materialize(words.distinct(), "jaccard-words", compression="zstd")
    marks = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"m{k}") for k in range(2)]
    each = once.groupBy("word").agg(F.count("*").alias("n"), *marks)
    kept = materialize(each.groupBy("n", "m0", "m1").agg(F.min("word").alias("word")).select("word", "n"), "jaccard-kept")
    return materialize(attach(once, kept, ["word"], "inner").select("word", "node"), "jaccard-words", compression="zstd")


def opened(words: DataFrame, label: DataFrame | None) -> DataFrame:
    """(word, node, component, n) of the words whose n members are in several components."""
    if label is None:
        named = words.withColumn("component", F.col("node"))
    else:
        named = words.join(label, "node", "left").select("word", "node", F.coalesce("component", "node").alias("component"))
    each = named.groupBy("word").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).where("x <> y")
    return attach(named, materialize(each.select("word", "n"), "jaccard-open"), ["word"], "inner")


def nearest_pairs(rows: DataFrame, sets: DataFrame, turn: int) -> DataFrame:
    """(a, b): members of a word with the nearest one of their block of about NEAR members, if it is within the bound."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(turn)), F.ceil(F.col("n") / NEAR))).drop("n")
    rows = rows.join(sets.select("node", "n", "bits"), "node").select("word", "block", "node", "component", "n", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[int, int]]:
            for _, held in groups(batches, ["word", "block"]):
                for begin, distance in apart(held, held) if len(held) > 1 else ():
                    best = distance.argmin(1)
                    for i in np.flatnonzero(distance[np.arange(len(best)), best] < FAR).tolist():
                        yield held[begin + i][0], held[best[i]][0]

        return pair_batches(pairs())

    return rows.repartition("word", "block").sortWithinPartitions("word", "block").mapInArrow(run, "a long, b long").distinct()


def near_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of different components that share a word and whose sizes and bit sketches allow the similarity.

    All members of a word meet its hubs, those outside of its largest component; BLOCK at most of either side at a time.
    """
    each = rows.groupBy("word", "component").agg(F.count("*").alias("n"))
    each = each.groupBy("word").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("n"))
    each = materialize(each.select("word", "n", F.col("most.component").alias("main"), F.ceil(F.col("n") / BLOCK).alias("blocks"), F.ceil((F.col("n") - F.col("most.n")) / BLOCK).alias("sides")), "jaccard-mains")
    rows = attach(rows.drop("n"), each, ["word"], "inner").drop("n").join(sets.select("node", "n", "bits"), "node")
    side, block = F.pmod(F.xxhash64("node"), F.col("sides")), F.pmod(F.xxhash64("node"), F.col("blocks"))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    columns = ["word", "side", "block", "hub", "node", "component", "n", "bits"]
    hubs = rows.where("component <> main").select("*", F.lit(True).alias("hub"), side.alias("side"), every("blocks").alias("block"))
    members = rows.select("*", F.lit(False).alias("hub"), block.alias("block"), every("sides").alias("side"))
    both = hubs.select(columns).union(members.select(columns)).repartition("word", "side", "block").sortWithinPartitions("word", "side", "block", F.desc("hub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[int, int]]:
            current, hubs = None, []
            for (*key, hub), held in groups(batches, ["word", "side", "block", "hub"]):
                if hub:
                    current, hubs = key, held
                elif key == current:
                    for begin, distance in apart(hubs, held):
                        for i, j in np.argwhere(distance < FAR).tolist():
                            yield hubs[begin + i][0], held[j][0]

        return pair_batches(pairs())

    return both.mapInArrow(run, "a long, b long").distinct()


def links(docs: DataFrame, words: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(links (a, b) between nodes that connect all similar nodes, components (node, component) of the linked ones)."""
    words = distinct_groups(words)
    wanted = materialize(words.select("node").distinct().join(nodes.select("node", F.col("least").alias("doc_id")), "node"), "jaccard-wanted")
    sets = sets_of(docs, wanted)
    found, label = [], None
    turn = F.pmod(F.xxhash64("word"), F.lit(SLICES))
    for k, part in enumerate((*ROUNDS, None)):
        if part:
            pairs = nearest_pairs(opened(words.where(turn.between(part[0], part[1] - 1)), label), sets, k)
        else:
            pairs = near_pairs(opened(words, label), sets)
        pairs = materialize(pairs, "jaccard-pairs")
        found.append(materialize(verified(pairs, sets), "jaccard-links"))
        if not found[-1].isEmpty():
            label = components(union(*found), "jaccard-components")
    return union(*found), label


def labelled(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, component_id, head) of every row of docs; head is the node that stands for the component."""
    found = grouped(docs, common_shingles(docs))
    measured = found.where(F.col("kind") == ROW).select("doc_id", "n", "node")
    nodes = materialize(measured.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "jaccard-nodes")
    _, label = links(docs, found.where(F.col("kind") == OWNED).select("word", "node"), nodes)
    named = nodes.withColumn("component", F.col("node")) if label is None else nodes.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = F.min(F.struct(F.col("least").isNull().alias("unnamed"), "least", "node"))
    named = materialize(named.select("node", "least", "n", "component"), "jaccard-named")
    heads = named.groupBy("component").agg(first.alias("first"), F.count("*").alias("n")).select("component", F.col("first.least").alias("component_id"), F.col("first.node").alias("head"), "n")
    named = attach(named.select("node", "component", F.col("n").alias("rows")), heads, ["component"], "inner").select("node", "component_id", "head", F.col("rows").alias("n"))
    named = materialize(named, "jaccard-named")
    rows = measured.select("doc_id", F.col("n").alias("n_shingles"), "node")
    full = attach(rows.where("node is not null"), named, ["node"], "inner").select("doc_id", "n_shingles", "node", "component_id", "head")
    return union(full, rows.where("node is null").select("doc_id", "n_shingles", "node", F.col("doc_id").alias("component_id"), F.col("node").alias("head")))


def similar_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs."""
    return labelled(docs).select("doc_id", "n_shingles", "component_id")


def with_nodes(docs: DataFrame) -> DataFrame:
    """The rows of docs with the name of their set, null if it is empty, as _node."""
    schema = docs.withColumn("_node", F.lit(None).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, off in tx.slices(batch.column("text")):
                hashes, first = tx.shingles(data, off, WORDS)
                node = pa.array(node_of(hashes, first), mask=np.diff(first) == 0)
                yield pa.RecordBatch.from_arrays([*batch.slice(row, len(off) - 1).columns, node], names=[*batch.schema.names, "_node"])

    return docs.mapInArrow(run, schema)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of docs for each component (of the smallest doc_id, then the smallest set name), with all its columns.

    Rows are told apart by doc_id and set, so a doc_id that several texts share stays with those not linked;
    of repeated rows one stays, and one of a component without doc_ids.  Rows without words all stay.
    """
    columns, docs = docs.columns, positional(docs)
    rows = materialize(labelled(docs).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("node") == F.col("head"))), "jaccard-rows")
    # a doc_id of one row decides alone; others, and rows without one, are told apart by their sets
    shared = materialize(rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("_doc")), "jaccard-shared")
    odd = F.col("doc_id").eqNullSafe(F.col("_doc"))
    few_shared = shared.count() <= BROADCAST_ROWS
    side = lambda frame, few: F.broadcast(frame) if few else frame
    dropped = rows.where("not kept").join(side(shared, few_shared), odd, "left_anti").select(F.col("doc_id").alias("_doc"))
    dropped = materialize(dropped, "jaccard-dropped")
    here = docs.doc_id.cast("long").eqNullSafe(F.col("_doc"))
    alone = docs.join(side(dropped, dropped.count() <= BROADCAST_ROWS), here, "left_anti")
    if shared.isEmpty():
        return alone.toDF(*columns)
    alone = alone.join(side(shared, few_shared), here, "left_anti")
    pairs = rows.join(side(shared, few_shared), odd, "left_semi").where("node is not null").groupBy("doc_id", "node", "kept").agg(F.count("*").alias("rows"))
    decided = materialize(pairs.where("not kept or rows > 1").select(F.col("doc_id").alias("_doc"), F.col("node").alias("_set"), "kept"), "jaccard-decided")
    few = decided.count() <= BROADCAST_ROWS
    keyed = with_nodes(docs.join(side(shared, few_shared), here, "left_semi"))
    match = keyed.doc_id.cast("long").eqNullSafe(F.col("_doc")) & (F.col("_node") == F.col("_set"))
    others = keyed.join(side(decided, few), match, "left_anti")
    repeated = keyed.join(side(decided.where("kept"), few), match, "left_semi").dropDuplicates(["doc_id", "_node"])
    return union(alone, others.drop("_node"), repeated.drop("_node")).toDF(*columns)
