"""Token ids in binary shards: independent zstandard frames, a trailing seek table, a checksum per frame.

A shard follows the public zstandard seekable format: ordinary frames, then one skippable frame with the
compressed size, the plain size and the low 32 bits of xxh64 of each frame, so any zstandard tool can
decompress it and a reader can fetch one frame alone.  A frame holds whole documents:

    n u32 | width u32 | rows without doc_id u32 | 0 u32 | doc_id i64 * n | tokens u64 * n | ids (u16 or u32, little-endian)

Rows are sorted by doc_id over all shards; those without doc_id come first.  A shard is written under a name of its own attempt, and only
the attempts whose manifest rows Spark commits are ever read, so retries leave no half shard behind.

Defined results: null text counts as empty; a null doc_id sorts first and reads back as null; equal doc_ids are
ordered by the hash of their text, then by text, and may be dealt over several shards, while rows repeated as a whole
lie in one; a text of any length is one document of one frame; an empty table gives no shards; other columns
are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as tx
from . import tokenize as tk
from .shared import materialize, shared_folder, small_batches

#: Plain bytes after which a frame is closed; a longer document has a frame of its own.
FRAME_BYTES = 1 << 20
#: Packed bytes that a task reads back, about, and neighbouring frames that stay together.
READ_BYTES, READ_FRAMES = 8 << 20, 8
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
MANIFEST = "shard int, path string, frame int, first_doc long, last_doc long, docs long, tokens long, frame_bytes long"


def filesystem(uri: str):
    """(file system, path) by pyarrow, which knows local paths and the usual remote stores."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def pack_frame(doc_ids: np.ndarray, nameless: int, counts: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    head = struct.pack("<IIII", len(doc_ids), width, nameless, 0)
    return head + doc_ids.astype("<i8").tobytes() + counts.astype("<u8").tobytes() + ids.astype(f"<u{width}").tobytes()


def unpack_frame(raw: bytes) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """(doc_ids, how many of the first ones are null, ids per document, ids)."""
    n, width, nameless, _ = struct.unpack_from("<IIII", raw)
    doc_ids = np.frombuffer(raw, "<i8", n, 16)
    counts = np.frombuffer(raw, "<u8", n, 16 + 8 * n).astype(np.int64)
    return doc_ids, nameless, counts, np.frombuffer(raw, f"<u{width}", -1, 16 + 16 * n)


class ShardWriter:
    """Appends frames to one shard; close() adds the seek table and gives the file its name."""

    def __init__(self, uri: str, level: int = 3):
        import zstandard

        self.fs, self.path = filesystem(uri)
        self.out = self.fs.open_output_stream(self.path + ".part")
        self.zip, self.table = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True), []

    def frame(self, raw: bytes) -> int:
        import xxhash

        packed = self.zip.compress(raw)
        self.out.write(packed)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        return len(packed)

    def close(self) -> None:
        body = b"".join(struct.pack("<III", *x) for x in self.table) + struct.pack("<IBI", len(self.table), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()
        self.fs.move(self.path + ".part", self.path)


class ShardReader:
    """Random access to the frames of one shard."""

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        self.file = self.fs.open_input_file(self.path)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError(f"{uri}: no seek table")
        rows = np.frombuffer(self.file.read_at(12 * count, size - 9 - 12 * count), "<u4").reshape(count, 3).astype(np.int64)
        self.packed, self.plain, self.sums = rows.T
        self.start = np.cumsum(self.packed) - self.packed

    def frame(self, k: int) -> bytes:
        import xxhash
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(int(self.packed[k]), int(self.start[k])), int(self.plain[k]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"{self.path}: frame {k} is damaged")
        return raw


def write_tokens(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, end_id: int | None = 1, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; returns the manifest, one row per frame."""
    tokenizer = tokenizer or tk.default_tokenizer()
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    tail = [] if end_id is None else [end_id]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        enc = tk.encoder(tokenizer)
        width = 2 if max(enc.tokenizer.get_vocab_size(), *tail, 0) <= 1 << 16 else 4
        path, writer, rows, held, size = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.zst", None, [], [], 0

        def close_frame() -> None:
            nonlocal held, size, writer
            if not held:
                return
            writer = writer or ShardWriter(path)
            names, null, counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            packed = writer.frame(pack_frame(names, int(null.sum()), counts, ids, width))
            rows.append((shard, path, len(rows), int(names[0]), int(names[-1]), len(names), int(counts.sum()), packed))
            held, size = [], 0

        filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)
        for batch in batches:
            null = np.asarray(batch.column("doc_id").is_null())
            names = batch.column("doc_id").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            for row, data, off in tx.slices(batch.column("text")):
                ids, first = enc.ids(data, off)
                counts = np.diff(first)
                if tail:
                    ids = np.insert(ids, first[1:], end_id)
                    counts = counts + 1
                ends = np.cumsum(counts)
                at = 0
                while at < len(counts):
                    base = ends[at - 1] if at else 0
                    stop = max(at + 1, int(np.searchsorted(ends, base + (frame_bytes - size) // width, "right")))
                    stop = min(stop, len(counts))
                    held.append((names[row + at : row + stop], null[row + at : row + stop], counts[at:stop], ids[base : ends[stop - 1]]))
                    size += int(ends[stop - 1] - base) * width
                    at = stop
                    if size >= frame_bytes or at < len(counts):
                        close_frame()
        close_frame()
        if writer:
            writer.close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=MANIFEST_NAMES).cast(MANIFEST_ARROW)

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("name", F.xxhash64("text"))
    # the hash of the text lets ranges split rows that share a doc_id or have none
    rows = rows.repartitionByRange("doc_id", "name").sortWithinPartitions("doc_id", "name", "text").drop("name")
    return materialize(rows.mapInArrow(write, MANIFEST), "token-manifest")


MANIFEST_ARROW = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("frame", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64()), ("frame_bytes", pa.int64())])
MANIFEST_NAMES = MANIFEST_ARROW.names


def read_tokens(manifest: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids): documents from their shards; ids are little-endian u32 bytes.

    With doc_ids, only the frames whose range may hold one of them are fetched and decompressed.
    start counts the ids of all documents before, over all shards.
    """
    spark = manifest.sparkSession
    totals = manifest.groupBy("shard").agg(F.sum("tokens").alias("tokens"), F.sum("frame_bytes").alias("size")).orderBy("shard").collect()  # one row per shard
    base, seen, size = [], 0, 0
    for shard, tokens, packed in totals:
        base.append((shard, seen))
        seen, size = seen + tokens, size + packed
    from pyspark.sql import Window

    before = F.sum("tokens").over(Window.partitionBy("shard").orderBy("frame")) - F.col("tokens")
    frames = manifest.withColumn("start", before)
    if base:
        frames = frames.join(F.broadcast(spark.createDataFrame(base, "shard int, base long")), "shard").withColumn("start", F.col("start") + F.col("base"))
    if doc_ids is not None:
        wanted = sorted(doc_ids)
        frames = frames.where(F.exists(F.lit(wanted), lambda x: x.between(F.col("first_doc"), F.col("last_doc"))))
    pick = None if doc_ids is None else np.array(sorted(doc_ids), np.int64)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = (None, None)
        for batch in batches:
            for path, frame, start in zip(*(batch.column(c).to_pylist() for c in ("path", "frame", "start")), strict=True):
                if reader[0] != path:
                    reader = (path, ShardReader(path))
                names, nameless, counts, ids = unpack_frame(reader[1].frame(frame))
                starts = start + np.cumsum(counts) - counts
                raw = ids.astype("<u4").tobytes()
                edge = np.concatenate([[0], np.cumsum(counts)]) * 4
                column = pa.Array.from_buffers(pa.large_binary(), len(names), [None, pa.py_buffer(edge.astype(np.int64).tobytes()), pa.py_buffer(raw)])
                got = pa.RecordBatch.from_arrays([pa.array(names, mask=np.arange(len(names)) < nameless), pa.array(starts), pa.array(counts), column.cast(pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
                yield got if pick is None else got.filter(pa.array(np.isin(names, pick) & (np.arange(len(names)) >= nameless)))

    parts = max(1, -(-size // READ_BYTES), spark.sparkContext.defaultParallelism)
    dealt = frames.select("path", "frame", "start").repartition(parts, "path", F.floor(F.col("frame") / READ_FRAMES)).sortWithinPartitions("path", "frame")
    small_batches(spark)
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
