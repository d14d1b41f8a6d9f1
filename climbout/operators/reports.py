"""Findings, reports, issue actions, snapshots and colours."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import signatures
from ..sources.sinks import written

#: Colours of the palette.
COLOURS = 6
# Counts that the points of one window add to, and tasks for each core where points are dealt.
WINDOW, TASKS_A_CORE = 1_000_000, 4


def by_kind(findings: DataFrame) -> DataFrame:
    return findings.groupBy("kind").agg(F.count("*").alias("findings"))


def grouped(findings: DataFrame) -> DataFrame:
    """findings(seq, kind, signature, airport) by key: members by airport, groups in the order first seen."""
    keyed = findings.withColumn("key", signatures.signature_key(F.col("kind"), F.col("signature"), F.col("airport")))
    members = F.array_sort(F.collect_list(F.struct("airport", "seq")))
    return keyed.groupBy("key", "kind").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"), F.min_by("signature", "seq").alias("signature"), F.transform(members, lambda m: m["airport"]).alias("airports"))


def summary(totals: DataFrame) -> DataFrame:
    """totals(drawn, textual, findings, signatures, partial, graphic_only) as one line of text."""
    thousands = lambda c: F.format_number(c, 0)
    share = F.when(F.col("textual") > 0, F.bround(100 * F.col("drawn") / F.col("textual"))).otherwise(0).cast("int")
    part = F.when(F.col("partial") > 0, F.concat(F.lit(", "), thousands(F.col("partial")), F.lit(" in part"))).otherwise("")
    charted = F.when(F.col("graphic_only") > 0, F.concat(F.lit("; "), thousands(F.col("graphic_only")), F.lit(" airports use only charted DPs"))).otherwise("")
    line = F.concat(F.lit("Drew "), thousands(F.col("drawn")), F.lit(" of "), thousands(F.col("textual")), F.lit(" ODPs ("), share.cast("string"), F.lit("%"), part, F.lit("); "), thousands(F.col("findings")), F.lit(" findings in "), thousands(F.col("signatures")), F.lit(" signatures"), charted)
    return totals.withColumn("line", line)


def top(rows: DataFrame, key: str, order: str, n: int = 20) -> DataFrame:
    """The n most frequent keys; of equally frequent ones those first seen."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("first_seen")).orderBy(F.desc("n"), "first_seen").limit(n)


def issue_actions(groups: DataFrame, issues: DataFrame) -> DataFrame:
    """groups(key, body) against open issues(key, number, body): create, update, unchanged or close."""
    g, i = groups.select("key", F.col("body").alias("new_body")), issues.select("key", "number", F.col("body").alias("old_body"))
    action = F.when(F.col("number").isNull(), "create").when(F.col("new_body").isNull(), "close").when(F.trim("new_body") == F.trim("old_body"), "unchanged").otherwise("update")
    return g.join(i, "key", "full").select("key", "number", action.alias("action"))


def snapshot_diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, change) between two snapshots(key, drawn, digest, findings): gained, lost, redrawn or findings_changed."""
    b = before.select(key, F.col("drawn").alias("b_drawn"), F.col("digest").alias("b_digest"), F.col("findings").alias("b_findings"))
    a = after.select(key, F.col("drawn").alias("a_drawn"), F.col("digest").alias("a_digest"), F.col("findings").alias("a_findings"))
    was, is_ = F.coalesce("b_drawn", F.lit(False)), F.coalesce("a_drawn", F.lit(False))
    change = (
        F.when(is_ & ~was, "gained")
        .when(was & ~is_, "lost")
        .when(was & is_ & ~F.col("b_digest").eqNullSafe(F.col("a_digest")), "redrawn")
        .when(F.col("b_drawn").isNotNull() & F.col("a_drawn").isNotNull() & ~F.col("b_findings").eqNullSafe(F.col("a_findings")), "findings_changed")
    )
    return b.join(a, key, "full").select(key, change.alias("change")).where("change is not null")


def outcome(drawn: Column, partial: Column, charted: Column) -> Column:
    return F.when(drawn & ~partial, "whole").when(drawn, "part").when(charted, "charted").otherwise("not drawn")


def colour(points: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, colour): each point in id order takes the colour its coloured neighbours use least, the lowest on ties.

    pairs(a, b) are neighbours, a < b.
    """
    both = pairs.select(F.col("a").alias("place"), F.col("b").alias("other")).union(pairs.select("b", "a")).where("place <> other")
    return colour_members(points.select("id", F.col("id").alias("place")), both)


def colour_members(members: DataFrame, links: DataFrame, width: int = WINDOW) -> DataFrame:
    """(id, colour) as `colour`, of members(id, place): points are neighbours if links(place, other), which go both ways, hold their places.

    A colour depends on those of all smaller neighbours, so the points of a cluster of linked places are coloured in windows of
    ids, one after another, those of all clusters side by side.  A window holds points that add to about `width` counts at most,
    whatever the size of the cluster, and takes from earlier ones only the counts of colours near each place: neither
    pairs of points nor chains of neighbours make rows or rounds.
    """
    spark = members.sparkSession
    tasks = TASKS_A_CORE * spark.sparkContext.defaultParallelism
    members, links = written(members.distinct(), "colour-members"), written(links.distinct(), "colour-links")
    weights = links.groupBy("place").agg((F.count("*") + 1).alias("weight"))
    rows = members.join(linked_clusters(links), "place").join(weights, "place")
    # the running weight in a cluster: within slices of ids, from the sums of the slices before
    dealt = written(rows.repartitionByRange(tasks, "id").withColumn("slice", F.spark_partition_id()), "colour-slices")
    sums = dealt.groupBy("cluster", "slice").agg(F.sum("weight").alias("before"))
    earlier = Window.partitionBy("cluster").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("before", F.coalesce(F.sum("before").over(earlier), F.lit(0)))
    running = F.sum("weight").over(Window.partitionBy("cluster", "slice").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    window = F.expr(f"(before + running - 1) div {width}").cast("int").alias("round")
    queued = dealt.withColumn("running", running).join(offsets, ["cluster", "slice"]).select("cluster", "id", "place", window)
    queued = written(queued.repartition(tasks, "cluster", "round"), "colour-queued", "round")
    spots = queued.select("round", "cluster", "place").distinct()
    inside = spots.select("round", F.col("place").alias("other"), F.lit(True).alias("inside"))
    ties = written(spots.join(links, "place").join(inside, ["round", "other"], "left").repartition(tasks, "cluster", "round"), "colour-ties", "round")
    last = queued.groupBy("place").agg(F.max("round").alias("last"))
    used = [f"n{k}" for k in range(COLOURS)]
    told = spots.limit(0).select("place", *[F.lit(0).cast("long").alias(c) for c in used])
    found = [members.join(links, "place", "left_anti").select("id", F.lit(0).alias("colour"))]
    schema = f"id {members.schema['id'].dataType.simpleString()}, place {members.schema['place'].dataType.simpleString()}, colour int"
    for i in range((queued.agg(F.max("round")).first()[0] or 0) + 1):
        now, tied = queued.where(F.col("round") == i), ties.where(F.col("round") == i)
        begun = now.join(told, "place", "left").select("cluster", "id", "place", *[F.coalesce(c, F.lit(0)).alias(c) for c in used])
        near = tied.where("inside").select("cluster", "place", "other")
        fresh = written(begun.groupBy("cluster").cogroup(near.groupBy("cluster")).applyInPandas(paint, schema), "colour-round")
        found.append(fresh.select("id", "colour"))
        counts = fresh.groupBy("place").agg(*[F.count_if(F.col("colour") == k).alias(c) for k, c in enumerate(used)])
        heard = tied.join(counts, "place").select(F.col("other").alias("place"), *used).union(told.select("place", *used))
        told = written(heard.join(last.where(F.col("last") > i), "place", "left_semi").groupBy("place").agg(*[F.sum(c).alias(c) for c in used]), "colour-told")
    return functools.reduce(DataFrame.union, found)


def paint(rows: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
    """One window of a cluster: rows(id, place, counts of colours near the place so far) in id order, near(place, other) among its places."""
    rows = rows.sort_values("id")
    at, places = pd.factorize(rows["place"])
    _, first = np.unique(at, return_index=True)
    counts = rows[[f"n{k}" for k in range(COLOURS)]].to_numpy()[first]
    names = pd.Index(places)
    one, two = names.get_indexer(near["place"]), names.get_indexer(near["other"])
    order = np.argsort(one, kind="stable")
    others = np.split(two[order], np.searchsorted(one[order], np.arange(1, len(names))))
    taken = np.empty(len(at), np.int32)
    for i, p in enumerate(at):
        taken[i] = k = counts[p].argmin()
        counts[others[p], k] += 1
    return pd.DataFrame({"id": rows["id"], "place": rows["place"], "colour": taken})


def linked_clusters(links: DataFrame) -> DataFrame:
    """(place, cluster) of links(place, other) that go both ways: the smallest place that links reach.

    The smallest names spread along links and to the places named so far, and names of names are followed, until nothing changes.
    """
    names = written(links.groupBy("place").agg(F.least("place", F.min("other")).alias("cluster")), "cluster-names")
    while True:
        heard = links.join(names.select(F.col("place").alias("other"), "cluster"), "other").groupBy("place").agg(F.min("cluster").alias("heard"))
        nearer = names.join(heard, "place").select("place", "cluster", F.least("cluster", "heard").alias("via"))
        nearer = nearer.select("place", "via").union(nearer.select("cluster", "via")).groupBy("place").agg(F.min("via").alias("via")).join(names.withColumnRenamed("cluster", "was"), "place")
        found = written(nearer.join(names.select(F.col("place").alias("via"), "cluster"), "via").select("place", "was", "cluster"), "cluster-names")
        names = found.select("place", "cluster")
        if found.where("was <> cluster").isEmpty():
            return names


def paths(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(path, n): how many keys have the same sequence of values, repeats in a row taken once."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(order))
    turns = rows.withColumn("_before", before).where(~F.col("_before").eqNullSafe(F.col(value)))
    path = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), " | ")
    return turns.groupBy(key).agg(path.alias("path")).groupBy("path").agg(F.count("*").alias("n"))


def repeated(rows: DataFrame, key: str, member: str) -> DataFrame:
    """(key, n, first): keys of several rows, with the smallest member."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(member).alias("first")).where("n > 1")


def shapes_once(rows: DataFrame, shape: list[str], seq: Column, group: str) -> DataFrame:
    """Equal shapes once, at their first place; one drawn by several groups belongs to none."""
    own = F.when(F.min(group) == F.max(group), F.min(group))
    return rows.groupBy(*shape).agg(F.min(seq).alias("first_seq"), own.alias("grp"), F.count("*").alias("n"))


def digests(rows: DataFrame, key: str, order: str, shape: Column) -> DataFrame:
    """(key, digest): the first twelve hex digits of the SHA-1 of a key's shapes in order."""
    shapes = F.transform(F.array_sort(F.collect_list(F.struct(order, shape.alias("s")))), lambda x: x["s"])
    return rows.groupBy(key).agg(F.substring(F.sha1(F.array_join(shapes, ",").cast("binary")), 1, 12).alias("digest"))


#: Members of a group that an issue lists; the rest are only counted.
LISTED = 50


def issue_texts(findings: DataFrame, cycle: str, listed: int = LISTED) -> DataFrame:
    """(key, title, body, n) of findings(seq, kind, signature, airport, amendment, detail, verbatim_text): an issue a group.

    The body names at most `listed` members, those first by airport; they are numbered by a window and only they are gathered, so that a
    frequent signature is no larger a row than a rare one.
    """
    keyed = findings.withColumn("key", signatures.signature_key(F.col("kind"), F.col("signature"), F.col("airport")))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min_by(F.struct("kind", "signature"), "seq").alias("first"))
    named = heads(keyed, ["key"], [F.col("airport"), F.col("seq")], listed)
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    row = F.concat(F.lit("| "), empty("airport"), F.lit(" | "), empty("amendment"), F.lit(" | "), empty("detail"), F.lit(" |"))
    block = F.concat(F.lit("### "), empty("airport"), F.lit("\n```\n"), empty("verbatim_text"), F.lit("\n```\n"))
    lines = F.array_sort(F.collect_list(F.struct("_n", row.alias("row"), block.alias("block"))))
    told = named.groupBy("key").agg(lines.alias("lines")).join(sizes, "key")
    more = F.when(F.col("n") > listed, F.concat(F.lit("… and "), (F.col("n") - listed).cast("string"), F.lit(" more, see report.json in the release\n"))).otherwise("")
    head = F.concat(F.lit("<!-- odp-signature: "), "key", F.lit(f" -->\n\nCycle {cycle}, "), F.col("n").cast("string"), F.lit(" airports.\n\n| Airport | Amendment | Detail |\n| --- | --- | --- |\n"))
    body = F.concat(head, F.array_join(F.transform("lines", lambda x: x["row"]), "\n"), F.lit("\n"), more, F.lit("\n"), F.array_join(F.transform("lines", lambda x: x["block"]), "\n"))
    title = F.concat(F.lit("[odp] "), "first.kind", F.lit(": "), signatures.finding_signature(F.col("first.signature")))
    return told.select("key", title.alias("title"), body.alias("body"), "n")


def heads(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key, numbered from 1 as `_n`.

    Rows are numbered within a share of their key first and again among the n of each share, so no task holds a frequent key.
    """
    share = F.pmod(F.xxhash64(*order), F.lit(64))
    part = Window.partitionBy(*keys, "_share").orderBy(*order)
    few = rows.withColumn("_share", share).withColumn("_n", F.row_number().over(part)).where(F.col("_n") <= n)
    return few.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_share")


def clusters(rows: DataFrame, key: str) -> DataFrame:
    """(key, n), most frequent keys first, then by key."""
    counted = rows.groupBy(key).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), key)
