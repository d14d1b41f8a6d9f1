"""Plumbing shared by the operators: the shared folder, tables that cut lineage, skew-safe joins, components."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of at most this many narrow rows may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: A key is hot if it has more than this share of all rows; so there are fewer than 1 / HOT_SHARE hot keys.
HOT_SHARE = 1e-3
#: Bytes of an Arrow batch, about (Spark's own bound is 64 MB, several times over for each task).
BATCH_BYTES = 8 << 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors see.

    Where the session names none, a temporary folder takes its place on a local master (tests); a cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="climbout-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """Send BATCH_BYTES at a time to Python, unless the session says otherwise: rows of texts are large."""
    key, usual = "spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20)
    if spark.conf.get(key, usual).rstrip("bB") == usual:
        spark.conf.set(key, str(BATCH_BYTES))


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows of df as a table in the shared folder: later stages do not depend on lost executors.

    The shuffle files that made the table go as soon as it is written.
    """
    small_batches(df.sparkSession)
    path, conf, key = shared_folder(df.sparkSession, name), df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positional(docs: DataFrame) -> DataFrame:
    """docs with neutral names for all columns but doc_id and text, so that none clashes with those of an operator."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)])


def union(*frames: DataFrame) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def attach(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join left with the unique-keyed right, whose column `n` counts left's rows of the key (how: left or inner).

    Rows of hot keys meet a broadcast table of less than 1 / HOT_SHARE rows and so stay where they are;
    all others are joined by a shuffle, in which no key has more than HOT_SHARE of the rows.
    A right side that is small as a whole is broadcast as a whole.
    """
    size = right.agg(F.count("*").alias("rows"), F.sum("n").alias("all")).first()
    if size["rows"] <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), keys, how)
    hot = right.where(F.col("n") > F.lit(HOT_SHARE * size["all"]))
    marked = left.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    done = marked.where("_hot").drop("_hot")
    cold = marked.where("_hot is null").select(left.columns).join(right.where(F.col("n") <= F.lit(HOT_SHARE * size["all"])), keys, how)
    return union(done, cold.select(done.columns))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node that links reach.

    Minimum labels spread along edges and labels of labels are followed (pointer jumping) until nothing
    changes.  Labels are broadcast while they are few; beyond, the edges of a hub and the members of a large
    component meet their label by `attach`, which keeps hot keys where they are, and messages are combined before the
    shuffle.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), name)
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component"), F.count("*").alias("n")), name)
    few = labels.count() <= BROADCAST_ROWS
    meet = lambda left, right, key: left.join(F.broadcast(right.drop("n")), key) if few else attach(left, right, [key], "inner").drop("n")
    while True:
        heard = meet(both.select("a", F.col("b").alias("node")), labels, "node").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        nearer = labels.join(heard, "node").select("node", "n", F.col("component").alias("old"), F.least("component", "heard").alias("near"))
        up = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
        if not few:
            nearer = materialize(nearer, name)
            up = up.join(nearer.groupBy("near").agg(F.count("*").alias("n")), "near")
        moved = meet(nearer.withColumnRenamed("n", "degree"), up, "near").select("node", F.least("near", "far").alias("component"), F.col("degree").alias("n"), "old")
        new = materialize(moved, name)
        labels = new.drop("old")
        if new.where("component <> old").isEmpty():
            return labels.select("node", "component")
