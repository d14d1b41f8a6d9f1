"""Plans that hold at any size of the tables: what grows with them is shuffled, not passed through the driver."""

import re

from pyspark.sql import functions as F

from climbout.operators import bindings, facilities, routes, whole_sections
from climbout.plans.catalog import QUERIES


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def broadcast_keys(frame) -> list[str]:
    """The first key of each broadcast join of a frame's plan."""
    return re.findall(r"BroadcastHashJoin \[(\w+)", plan(frame))


def broadcast_plans(frame) -> list[str]:
    """What is broadcast: the part of a frame's plan below each exchange for that."""
    lines, depth = plan(frame).split("\n"), lambda line: len(re.match(r"[ :+*()\d-]*", line)[0])
    out = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth(lines[j]) <= depth(line)), len(lines))
            out.append("\n".join(lines[i:end]))
    return out


def test_rows_of_sections_are_not_broadcast(spark):
    """Only the pieces of text, which recur, may go to all tasks: sections, their sentences, groups and places are joined where they are."""
    k = F.col("id")
    said = F.concat(F.lit("Rwy 9, climb heading 090° to 1800. Rwy 27, climbing left turn direct ABC VORTAC.\nAvoid mast "), k.cast("string"), F.lit(".\nRwy 22, climb heading 220° to 1500."))
    sections = spark.range(40).select(k.alias("block"), said.alias("text"))
    lines = whole_sections.sentences(sections)
    assert set(broadcast_keys(whole_sections.routes(lines, True))) <= {"piece"}
    groups, climbs, unparsed = whole_sections.parse(sections)
    places = spark.range(40).select(k.alias("block"), F.lit("ABC").alias("ident"), F.lit("ABLE").alias("name"), F.lit(-9.0).alias("x"), F.lit(5.0).alias("y"))
    bound = routes.bind(groups, places, F.lit(0.0))
    for frame in (groups, climbs, unparsed, bound):
        assert set(broadcast_keys(frame)) <= {"piece"}
    assert bound.count() == 80 and unparsed.where("not withheld").count() == 40
    assert bound.where("runways = array('9')").select(F.size("legs").alias("n"), F.col("legs")[0]["feet"].alias("feet")).distinct().collect() == [(1, 1800.0)]


def test_arrays_of_holds_are_not_broadcast(spark):
    """Few rows that are copied for each share are many: neither copies nor arrays of the holds pass through the driver."""
    legs = spark.range(300).select(F.col("id").alias("block"), (F.col("id") % 5).alias("fix"))
    holds = spark.range(200).select(F.col("id").alias("hold"), (F.col("id") % 5).alias("fix"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("navaid"))
    rows = bindings.matching_holds(legs, holds, legs.select("block", (F.col("block") % 7).alias("ident")))
    assert "collect_list" in plan(rows)
    assert not any("collect_list" in p or "sequence(" in p for p in broadcast_plans(rows))


def test_holds_as_a_plain_loop_finds_them(spark):
    """Legs given twice, of no fix or of no block, navaids given twice or more than one, holds of the fix itself, more columns."""
    legs = [(b if b % 11 else None, f, f"l{b}{f}") for b in range(30) for f in (b % 4, None, b % 3)]
    holds = [(h % 4 if h % 13 else None, (None, h % 4, h % 6)[h % 3], h, h % 2 == 0) for h in range(40)]
    navaids = [(b, n) for b in range(30) for n in (b % 6, b % 5, b % 5)] + [(None, 1)]
    known = {(b, n) for b, n in navaids if b is not None}
    want = sorted(str((b, f, note, n, h, right)) for b, f, note in legs for g, n, h, right in holds if f is not None and f == g and (n is None or n == f or (b, n) in known))
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = bindings.matching_holds(frame(legs, "block long, fix long, note string"), frame(holds, "fix long, navaid long, hold long, right boolean"), frame(navaids, "block long, ident long"))
    assert got.columns == ["block", "fix", "note", "navaid", "hold", "right"]
    assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_arrays_are_short_where_tasks_would_be_idle(spark):
    rows = spark.range(4000).select(F.lit(1).alias("key"), F.col("id").alias("value"))
    arrays = {tasks: [r.n for r in facilities.chunked(rows, ["key"], ["value"], tasks).select(F.size("_members").alias("n")).collect()] for tasks in (1, 20, 1000)}
    assert [len(n) for n in arrays.values()] == [8, 20, 80] and all(sum(n) == 4000 for n in arrays.values())


def test_distances_are_rounded_once_for_two_places(spark, tmp_path):
    """Rows of pairs are many: what is the same for all pairs of two places is not computed for each."""
    spark.range(1, 2201).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    rows = QUERIES["neighbour_pairs"](spark, str(tmp_path))
    assert plan(rows).index("Generate explode") < plan(rows).index("round(")
    points = rows.select(F.col("a").alias("id")).union(rows.select(F.col("b").alias("id"))).distinct()
    places = points.select("id", (30 + F.col("id") * 37 % 1000 / 100.0).alias("lat"), (-120 + F.col("id") * 91 % 2000 / 100.0).alias("lon"))
    whole = facilities.neighbours(places, 40.0).select("a", "b", F.round("nm", 6).alias("nm"))
    assert rows.count() == whole.count() > 10_000 and rows.exceptAll(whole).isEmpty()
