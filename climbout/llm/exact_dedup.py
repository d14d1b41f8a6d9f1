"""Exact deduplication by a log-structured merge index of text digests.

Each input partition is a memtable: it flushes one run, sorted by digest, as a Parquet file with a Bloom
filter on the digest, into the shared folder.  Compaction merges the runs: for every digest it counts the
rows and keeps the winner and the smallest identifier, combining before the shuffle, and writes the
next level, sorted within each file.  (The merge itself is Spark's aggregation; it does not rely on the order of the runs.)  `lookup` asks an
index for a few digests: file ranges and filters skip all row groups that cannot hold them.  Digests that occur
more than once are hits; every row of a hit is verified byte by byte against its winner's text, and rows
that differ form groups of their own, so results are exact for any digest.

Defined results: null text counts as empty; null doc_id sorts last; rows that repeat a doc_id are rows of
their own, and all rows equal to the winner in doc_id and length are marked as kept (`survivors` returns
one of them); of equal lengths the smallest doc_id wins; texts of any length are read whole; an empty table gives
an empty result; other columns are ignored, whatever their names (`survivors` hands them on).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, attach, materialize, positional, union

#: Members of a group that are verified against one copy of the winner's text in one task.
VERIFY_RUN = 64


def normalised(text: Column) -> Column:
    """The text without any blank characters."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def flush(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Level 0: one run of (digest, doc_id, points, row) for each input partition, sorted, with its filter."""
    text = normalised(F.col("text"))
    rows = docs.select(digest(text).alias("digest"), F.col("doc_id").cast("long"), F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("points"))
    return materialize(rows.sortWithinPartitions("digest"), "lsm-level0", **{"parquet.bloom.filter.enabled#digest": "true"})


def compact(runs: DataFrame) -> DataFrame:
    """Level 1: (digest, n, smallest, keep_id, keep_points), one row per digest, sorted, with its filter."""
    first = F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("nameless"), "doc_id")
    merged = runs.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("smallest"), F.min(first).alias("w"))
    level = merged.select("digest", "n", "smallest", F.col("w.doc_id").alias("keep_id"), (-F.col("w.less")).alias("keep_points"))
    return materialize(level.sortWithinPartitions("digest"), "lsm-level1", **{"parquet.bloom.filter.enabled#digest": "true"})


def lookup(index: DataFrame, digests: list[bytes]) -> DataFrame:
    """The rows of a level for some digests; the predicate reaches the scan, whose Bloom filters prune row groups."""
    return index.where(F.col("digest").isin([bytearray(d) for d in digests]))


def verify(docs: DataFrame, hits: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(doc_id, digest, points, same, text): every row of a hit against its winner; text only where it differs.

    The winner's text is sent once for each VERIFY_RUN members, so the hottest group is dealt over many tasks.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("points"), normalised(F.col("text")).alias("body"))
    members = attach(texts.withColumn("digest", digest(F.col("body"))), hits, ["digest"], "inner")
    members = members.withColumn("runs", F.ceil(F.col("n") / VERIFY_RUN).cast("int"))
    winner = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    members = members.withColumn("run", F.when(F.col("n") > VERIFY_RUN, F.pmod(F.xxhash64("doc_id", "points"), F.col("runs"))).otherwise(0).cast("int"))
    members = materialize(members.select("doc_id", "digest", "points", "body", "run", "runs", winner.alias("wins")), "lsm-hits")
    best = members.where("wins").groupBy("digest").agg(F.min("body").alias("best"), F.first("runs").alias("runs"))
    best = best.select("digest", "best", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"))
    same = F.col("body") == F.col("best")
    return members.join(best, ["digest", "run"]).select("doc_id", "digest", "points", same.alias("same"), F.when(~same, F.col("body")).alias("body"))


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(doc_id, points, digest, keep_id, keep_points, group_size, smallest, kept) for every row of docs."""
    runs = flush(docs, digest)
    index = compact(runs)
    hits = index.where("n > 1").select("digest", "n", "keep_id", "keep_points")
    checked = materialize(verify(docs, hits, digest), "lsm-verified")
    order = F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("nameless"), "doc_id")
    agreed = checked.groupBy("digest", "body").agg(F.count("*").alias("n"), F.min("doc_id").alias("smallest"), F.min(order).alias("w"))
    agreed = agreed.select("digest", "body", "n", "smallest", F.col("w.doc_id").alias("keep_id"), (-F.col("w.less")).alias("keep_points"))
    matched = attach(checked.where("same").select("doc_id", "digest", "points"), agreed.where("body is null").drop("body"), ["digest"], "inner")
    others = checked.where("not same").join(agreed.where("body is not null"), ["digest", "body"]).drop("same", "body")
    single = index.where("n = 1").select(F.col("keep_id").alias("doc_id"), "digest", F.col("keep_points").alias("points"), "n", "smallest", "keep_id", "keep_points")
    out = union(single, matched.select(single.columns), others.select(single.columns))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    return out.select("doc_id", "points", "digest", "keep_id", "keep_points", F.col("n").alias("group_size"), "smallest", kept.alias("kept"))


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns: one for each distinct normalised text."""
    columns, docs = docs.columns, positional(docs)
    dropped = exact_duplicates(docs).where("group_size > 1").select("doc_id", "digest", "points", "kept")
    dropped = materialize(dropped.distinct(), "lsm-decisions")
    few = dropped.count() <= BROADCAST_ROWS
    body = normalised(F.col("text"))
    keyed = docs.withColumn("_digest", sha256(body)).withColumn("_points", F.char_length(F.coalesce("text", F.lit(""))).cast("long"))

    def joined(side: DataFrame, how: str) -> DataFrame:
        side = F.broadcast(side) if few else side
        return keyed.join(side, keyed.doc_id.eqNullSafe(side.doc_id) & (keyed._digest == side.digest) & (keyed._points == side.points), how)

    alone = joined(dropped, "left_anti")
    chosen = joined(dropped.where("kept").select("doc_id", "digest", "points"), "left_semi").dropDuplicates(["_digest", "_points", "doc_id"])
    return union(alone, chosen).drop("_digest", "_points").toDF(*columns)
