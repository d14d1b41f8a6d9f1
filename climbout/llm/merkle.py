"""Merkle manifest of a dataset: a tree over the rows of each source, a tree over the sources, and a proof for every row.

Leaves are numbered within their source, which Spark does by ranges: rows are range-partitioned by (source, order),
numbered in their tasks, and shifted by the sums of the counts before them.  A superblock is fanout ** levels
consecutive nodes; its bucket index is the node's index divided by that.  applyInPandas collapses `levels` levels of a
bucket into its root, and the bucket roots are reduced the same way until one node of each source is left; then the sources'
roots are the leaves of the upper tree.  On the way down a bucket's nodes meet the proof of their bucket's root, again in
applyInPandas, and each gets its lower proof followed by the upper one.  No task holds more than a superblock,
no row more than one proof, and texts are hashed where they are read.

Every `fanout` consecutive nodes become the hash of their concatenated hex digests, a last run of fewer (even of
one) too, while a level has more than one node; a single leaf is its own root.

Defined results: rows of one source ascend by the order column, nulls first, then by leaf; rows that agree in all of it are
interchangeable.  A null source is a source of its own and comes first; null fields are `-`.  An empty table gives no
rows.  Texts of any length are hashed whole.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import attach, materialize

FANOUT, LEVELS = 16, 2
#: A node's place on the way to the root: its positions in its runs, and its siblings' digests run by run.
PROOF = "places array<int>, siblings array<string>"


def field(column: Column) -> Column:
    """`-` for null, else the value's UTF-8 byte count, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def parent(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def depth(n: int, fanout: int) -> int:
    """Levels above n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def climb(nodes: list[str], steps: int, fanout: int) -> list[list[str]]:
    """The levels from these nodes up, the first one included."""
    out = [nodes]
    for _ in range(steps):
        out.append([parent(out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def numbered(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """rows with `idx` (from 0, within the key, by the order) and `n` (rows of the key).

    The row's place in its table breaks ties, so that no set of equal rows must go to one task.
    """
    types = [(f.name, f.dataType.simpleString()) for f in rows.schema] + [("part", "int"), ("local", "bigint"), ("_row", "bigint")]
    columns = [c for c, _ in types]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            new[0] = keys[0] != last
            at = np.arange(len(keys))
            local = at - np.maximum.accumulate(np.where(new, at, 0))
            local[np.cumsum(new) == 0] += done
            last, done = keys[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), part, np.int32)) if c == "part" else pa.array(local) if c == "local" else batch.column(c) for c in columns], columns)

    marked = rows.withColumn("_row", F.monotonically_increasing_id())
    ranged = marked.repartitionByRange(key, *order, "_row").sortWithinPartitions(key, *order, "_row")
    counted = materialize(ranged.mapInArrow(count, ", ".join(f"`{c}` {t}" for c, t in types)), name).drop("_row")
    each = counted.groupBy("part", key).agg(F.count("*").alias("here"))
    w = Window.partitionBy(key)
    sums = each.select("part", key, F.col("here").alias("_here"), F.sum("here").over(w.orderBy("part")).alias("_until"), F.sum("here").over(w).alias("_all"))
    met = attach(counted, materialize(sums.withColumn("n", F.col("_here")), name), ["part", key], "inner")
    return met.withColumn("idx", F.col("local") + F.col("_until") - F.col("_here")).drop("part", "local", "n", "_here", "_until").withColumnRenamed("_all", "n")


def reduce(nodes: DataFrame, fanout: int, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(tables, tops): the nodes of every superblock level (grp, n, idx, bucket, node, ...), and (grp, node) of each tree's root."""
    width = fanout**levels

    def collapse(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iloc[0])
        steps = min(levels, depth(n, fanout))
        top = climb(rows.sort_values("idx")["node"].tolist(), steps, fanout)[-1]
        for _ in range(steps):
            n = -(-n // fanout)
        return pd.DataFrame({"grp": [key[0]], "n": [n], "idx": [int(key[1])], "node": top})

    tables = []
    level = nodes
    while True:
        level = materialize(level.withColumn("bucket", F.floor(F.col("idx") / width)), name)
        tables.append(level)
        if not (level.agg(F.max("n")).first()[0] or 0) > 1:
            return tables, level.select("grp", "node")
        level = level.select("grp", "n", "idx", "node", "bucket").groupBy("grp", "bucket").applyInPandas(collapse, "grp string, n long, idx long, node string")


def descend(tables: list[DataFrame], tops: DataFrame, kept: list[str], fanout: int, levels: int, name: str) -> DataFrame:
    """Proofs of the nodes of the lowest table; tops (grp, subroot, root, places, siblings) is the proof of each tree's root."""
    carried = f"subroot string, root string, {PROOF}"
    types = {f.name: f.dataType.simpleString() for f in tables[0].schema}

    def spread(key: tuple, rows: pd.DataFrame, upper: pd.DataFrame, extra: list[str]) -> pd.DataFrame:
        rows = rows.sort_values("idx", ignore_index=True)
        steps = min(levels, depth(int(rows["n"].iloc[0]), fanout))
        tiers = climb(rows["node"].tolist(), steps, fanout)
        above = upper.iloc[0]
        far_places, far_siblings = [int(p) for p in above["places"]], list(above["siblings"])
        places, siblings = [], []
        for i in range(len(rows)):
            own_places, own_siblings, at = [], [], i
            for tier in tiers[:-1]:
                run = tier[at - at % fanout : at - at % fanout + fanout]
                own_places.append(at % fanout)
                own_siblings.append("".join(run[: at % fanout] + run[at % fanout + 1 :]))
                at //= fanout
            places.append(own_places + far_places)
            siblings.append(own_siblings + far_siblings)
        out = rows[["grp", "idx", "node", *extra]].copy()
        out["subroot"], out["root"], out["places"], out["siblings"] = above["subroot"], above["root"], places, siblings
        return out

    upper = tops.withColumn("bucket", F.lit(0).cast("long"))
    for k, table in reversed(list(enumerate(tables))):
        extra = kept if k == 0 else []
        part = table.select("grp", "bucket", "n", "idx", "node", *extra)
        schema = ", ".join(["grp string, idx long, node string", *(f"`{c}` {types[c]}" for c in extra), carried])
        function = (lambda extra: lambda key, rows, upper: spread(key, rows, upper, extra))(extra)
        found = part.groupBy("grp", "bucket").cogroup(upper.select("grp", "bucket", "subroot", "root", "places", "siblings").groupBy("grp", "bucket")).applyInPandas(function, schema)
        if k == 0:
            return found
        upper = materialize(found.withColumn("bucket", F.col("idx")), name)


def prove(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS, name: str = "merkle") -> DataFrame:
    """(doc_id, source, leaf, other, subroot, root, places, siblings) of every row of leaves (doc_id, source, leaf, other).

    leaf and other are hex digests; other is carried along.  siblings has one string for each run on the way from the leaf to the root:
    the digests of the run's other nodes, left to right; places the node's own position in each.
    """
    group = F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0"))  # null first, then bytewise
    given = materialize(leaves.select(group.alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), F.col("leaf").alias("node"), "other"), name)
    tables, roots = reduce(numbered(given, "grp", ["doc_id", "node"], name), fanout, levels, name)
    sources = roots.select(F.lit("all").alias("grp"), F.col("grp").alias("source"), "node")
    upper_tables, tops = reduce(numbered(sources, "grp", ["source"], name), fanout, levels, name)
    nothing = [F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("siblings")]
    whole = tops.select("grp", F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"), *nothing)
    proofs = descend(upper_tables, whole, ["source"], fanout, levels, name)
    proofs = materialize(proofs.select(F.col("source").alias("grp"), F.col("node").alias("subroot"), "root", "places", "siblings"), name)
    found = descend(tables, proofs, ["doc_id", "other"], fanout, levels, name)
    source = F.when(F.col("grp") != "0", F.substring("grp", 2, 2**31 - 1))
    return found.select("doc_id", source.alias("source"), F.col("node").alias("leaf"), "other", "subroot", "root", "places", "siblings")


def fold(leaf: Column, places: str = "places", siblings: str = "siblings") -> Column:
    """The root that follows from a leaf and its proof."""
    step = F.arrays_zip(F.col(places).alias("place"), F.col(siblings).alias("others"))
    mix = lambda node, s: digest(F.substring(s["others"], F.lit(1), 64 * s["place"]), node, F.substring(s["others"], 64 * s["place"] + 1, F.lit(2**31 - 1)))
    return F.aggregate(step, leaf, mix)


def proof_digest(siblings: str = "siblings") -> Column:
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)
