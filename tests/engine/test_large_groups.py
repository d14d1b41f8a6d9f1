"""Joins whose keys or places are few: each is compared once, the rows behind it are dealt in shares."""

from pyspark.sql import functions as F

from climbout.operators import bindings, facilities, reports
from tests.engine.test_operators import nm


def test_neighbours_of_copied_places(spark):
    """1,500 points at three places, two of them near each other beside a pole, more than an array of members holds."""
    spots = ((89.9, 10.0), (89.9, -170.0), (40.0, 10.0))
    points = spark.range(1500).select("id", *[F.element_at(F.array(*[F.lit(s[i]) for s in spots]), (F.col("id") % 3 + 1).cast("int")).alias(c) for i, c in enumerate(("lat", "lon"))])
    pairs = facilities.neighbours(points, 40.0)
    n = 500
    assert pairs.count() == pairs.distinct().count() == 3 * n * (n - 1) // 2 + n * n
    assert pairs.where("a >= b").isEmpty() and {round(r.nm, 6) for r in pairs.where("nm > 0").select("nm").distinct().collect()} == {round(nm(spots[0], spots[1]), 6)}
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_places_of_references_are_compared_once(spark):
    """Rows that go into the distance join are places, however many references and candidates lie there."""
    refs = spark.range(2000).select(F.col("id").alias("ref_id"), (F.col("id") % 2).alias("key"), F.lit(40.0).alias("lat"), (F.col("id") % 4).cast("double").alias("lon"))
    cand = spark.range(900).select(F.col("id").alias("c_id"), (F.col("id") % 2).alias("key"), F.lit(41.0).alias("c_lat"), F.when(F.col("id") == 1, 3.0).otherwise(90.0).alias("c_lon"))
    met = facilities.in_range(refs.select("key", "lat", "lon").distinct(), cand.select("key", "c_lat", "c_lon").distinct(), ["key"], 150.0)
    assert met.count() == 2
    got = facilities.resolve_one(refs, cand, ["key"], "navaid").groupBy("matches", "c_id", "failure", F.col("ref_id") % 2).count().collect()
    assert {tuple(r) for r in got} == {(1, 1, None, 1, 1000), (0, None, "navaid not found", 0, 1000)}


def test_navaids_of_copied_references(spark):
    sites = spark.createDataFrame([("ABC", "VOR", 40.0, 0.0, 2.0)] * 2 + [("ABC", "NDB", 40.0, 0.0, None)], "ident string, type string, lat double, lon double, mag_var_east double")
    refs = spark.range(300).select(F.col("id").alias("ref_id"), F.lit("ABC").alias("ident"), F.when(F.col("id") % 3 == 0, "VOR").when(F.col("id") % 3 == 1, "NDB").alias("type"), F.lit(40.5).alias("lat"), F.lit(0.0).alias("lon"), (F.col("id") % 5).cast("double").alias("variation"))
    got = {r.ref_id: (r.matches, r.type, r.variation, r.failure) for r in facilities.resolve_navaids(refs, sites).collect()}
    assert got == {k: ((2, None, None, "navaid ambiguous"), (1, "NDB", float(k % 5), None), (3, None, None, "navaid ambiguous"))[k % 3] for k in range(300)}


def test_holds_of_a_frequent_fix_are_dealt(spark):
    """One fix of many legs and holds: no task gets all of its rows."""
    legs = spark.range(1200).select(F.col("id").alias("block"), F.lit(7).alias("fix"))
    holds = spark.range(1100).select(F.lit(7).alias("fix"), F.when(F.col("id") % 3 == 1, 7).when(F.col("id") % 3 == 2, 1).cast("int").alias("navaid"), F.col("id").alias("hold"))
    navaids = legs.select("block", (F.col("block") % 2).cast("int").alias("ident"))
    rows = bindings.matching_holds(legs, holds, navaids)
    free, tied = 367 + 367, 366
    assert rows.count() == rows.select("block", "hold").distinct().count() == 1200 * free + 600 * tied
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 16 and max(sizes) < rows.count() / 8


def test_colours_of_copied_places(spark, monkeypatch):
    """Copies of a place are neighbours of each other, yet neither tables written nor rows of a task grow with them; windows give what a plain loop gives."""
    spots = [(40.0, -100.0), (40.3, -100.0), (40.6, -100.2), (10.0, 20.0), (10.2, 20.0), (-60.0, 0.0), (None, None)]
    places = {i: spots[i * i % 11 % 7] for i in range(300)}
    frame = spark.createDataFrame([(i, *p) for i, p in places.items()] + [(7, *places[7])], "id long, lat double, lon double")
    plain = {}
    for i, p in places.items():
        used = [plain[j] for j in plain if None not in p and None not in places[j] and nm(p, places[j]) <= 40]
        plain[i] = min(range(6), key=lambda k: (used.count(k), k))
    tables, written = [], reports.written
    monkeypatch.setattr(reports, "written", lambda df, name, by=None: tables.append((name, written(df, name, by))) or tables[-1][1])
    members, links = facilities.linked_places(frame, 40.0)
    assert links.count() < 20

    def coloured(**width):
        tables.clear()
        rows = reports.colour_members(members, links, **width).collect()
        assert len(rows) == 300 and {r.id: r.colour for r in rows} == plain

    coloured()
    assert len(tables) < 15
    coloured(width=100)
    rounds = [t for name, t in tables if name == "colour-round"]
    assert len(rounds) > 3 and max(t.count() for t in rounds) < 120
