"""Binding joins, labels and compass points on small tables."""

import pytest
from pyspark.sql import functions as F

from climbout.functions import geodesy, labels
from climbout.operators import bindings


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def strings(*values):
    return F.array(*[F.lit(v) for v in values]) if values else F.expr("cast(array() as array<string>)")


def test_airports_keep_the_order_of_the_file(spark):
    airports = spark.createDataFrame([("AAA",), ("BBB",)], "lid string")
    runways = spark.createDataFrame([("AAA", 2, "09/27", 5000), ("AAA", 1, "18/36", 4000), ("AAA", 3, "H1", None)], "lid string, seq long, runway_id string, length_ft int")
    ends = spark.createDataFrame([("AAA", "09/27", 2, "27"), ("AAA", "09/27", 1, "09"), ("AAA", "18/36", 1, "36")], "lid string, runway_id string, seq long, end_id string")
    rows = {r.lid: [(w.runway_id, w.length_ft, w.ends) for w in r.runways] for r in bindings.airports_with_runways(airports, runways, ends).collect()}
    assert rows == {"AAA": [("18/36", 4000, ["36"]), ("09/27", 5000, ["09", "27"]), ("H1", None, [])], "BBB": []}


def test_runway_without_positions_or_at_no_airport_fails(spark):
    airports = spark.createDataFrame([("AAA", 700)], "lid string, elevation_ft int")
    runways = spark.createDataFrame([("AAA", "09/27", 6076)], "lid string, runway_id string, length_ft int")
    schema = "lid string, runway_id string, end_id string, lat double, lon double, elevation_ft int, tora_ft int"
    ends = spark.createDataFrame([("AAA", "09/27", "09", 0.0, 10.0, 650, 3038), ("AAA", "09/27", "27", 0.0, 10.1, None, None)], schema)
    wanted = spark.createDataFrame([("AAA", "09"), ("AAA", "27"), ("AAA", "18"), ("ZZZ", "09")], "lid string, runway string")
    rows = {(r.lid, r.runway): r for r in bindings.runway_starts(wanted, airports, runways, ends).collect()}
    east, west = rows["AAA", "09"], rows["AAA", "27"]
    assert (east.der_elevation_ft, west.der_elevation_ft) == (700, 650)
    assert (east.course_true, west.course_true, west.der_lon) == (pytest.approx(90), pytest.approx(270), 10.0)
    assert (10.1 - east.der_lon) * 60.04 == pytest.approx(0.5, abs=1e-3)  # half a mile of the runway is not available
    for key in (("AAA", "18"), ("ZZZ", "09")):
        assert rows[key].failure == "runway end position missing" and rows[key].der_lat is None


def test_names_of_several_navaids_bind_nothing(spark):
    refs = spark.createDataFrame([(1, "OAK", "VOR", "OAK"), (1, "OAK", "VOR", "OAK"), (1, "ELM", "VOR", "ELM"), (1, "ELM", "NDB", "EL"), (2, None, "VOR", "X")], "block int, name string, type string, ident string")
    wanted = spark.createDataFrame([(1, "OAK", "VOR"), (1, "OAK", "NDB"), (1, "ELM", "VOR"), (2, "OAK", "VOR")], "block int, name string, type string")
    got = {(r.block, r.name, r.type): (r.ident, r.failure) for r in bindings.named_navaids(wanted, refs).collect()}
    lost = (None, "navaid without ident")
    assert got == {(1, "OAK", "VOR"): ("OAK", None), (1, "OAK", "NDB"): lost, (1, "ELM", "VOR"): lost, (2, "OAK", "VOR"): lost}


def test_metafile_aliases_and_later_airports(spark):
    expected = spark.createDataFrame([("V1", "W94", None, 1), ("V1", "ABC", "PABC", 2), ("V1", "LST", "PABC", 3), ("V1", "QQQ", "", 4)], "volume string, lid string, icao string, seq int")
    blocks = spark.createDataFrame([("V1", "KW94"), ("V1", "PABC"), ("V1", "NEW"), ("V2", "W94")], "volume string, lid string")
    got = {r.warning for r in bindings.metafile_check(blocks, expected).collect()}
    assert got == {"V1: metafile airport ABC has no block", "V1: metafile airport QQQ has no block", "V1: block NEW has no metafile airport", "V2: block W94 has no metafile airport"}


def test_destinations_mentioned_only_are_none(spark):
    pairs = lambda *names: spark.createDataFrame([("V", n) for n in names], "volume string, name string")
    blocks = spark.createDataFrame([("V", "AAA"), ("V", "AAA"), ("V", "BBB"), ("V", "K1AB")], "volume string, lid string")
    got = sorted(r.warning for r in bindings.destination_check(blocks, pairs("AAA", "LIN", "CCC", "DPs", "DDD"), pairs("LIN", "CCC"), pairs("CCC")).collect())
    assert got == ["V: block BBB has no named destination", "V: destination (CCC) has no block", "V: destination (DDD) has no block", "V: duplicate LID AAA"]


def test_same_ident_at_two_places(spark):
    points = spark.createDataFrame([(1, "A", True, 1.0, 2.0), (1, "A", False, 1.0, 2.0), (1, "B", True, 1.0, 2.0), (1, "B", False, 1.0, 3.0)], "block int, ident string, is_fix boolean, lat double, lon double")
    got = {r.ident: (r.is_fix, r.lon, r.ambiguous) for r in bindings.same_places(points).collect()}
    assert got == {"A": (False, 2.0, False), "B": (False, 3.0, True)}


def test_labels(spark):
    assert one(spark, labels.runway_tag(strings())) == "ALL RWYS"
    assert one(spark, labels.runway_tag(strings("8R", "26", "8", "8L"))) == "8L/R/,26"
    assert one(spark, labels.runway_tag(strings(*[f"{n}{s}" for n in (16, 17, 18) for s in "LCR"]))) is None
    assert one(spark, labels.wrapped(strings())) == []
    assert one(spark, labels.wrapped(strings("x" * 30, "a", "b" * 20, "c"))) == ["x" * 30, "a " + "b" * 20, "c"]
    assert one(spark, labels.dme(F.lit("BAM"), F.lit(10.0))) == "BAM 10 DME"
    assert one(spark, labels.dme(F.lit("BAM"), F.lit(7.25))) == "BAM 7.25 DME"


def test_compass_and_sectors(spark):
    assert [one(spark, labels.compass_bearing(F.lit(p))) for p in ("N", "SW", "X")] == [0, 225, None]
    assert [one(spark, labels.sixteenth_point(F.lit(a), F.lit(b))) for a, b in (("S", "SW"), ("N", "SW"), ("SW", "S"))] == [True, False, False]
    assert [one(spark, labels.side_agrees(F.lit("N"), F.lit(d))) for d in (180, 210, 211, 0)] == [True, True, False, False]
    swept = labels.swept(F.lit(350), F.lit(5), F.lit(True))
    assert one(spark, swept) == [*range(350, 360), *range(6)]
    assert one(spark, labels.swept(F.lit(350), F.lit(5), F.lit(False))) == [*range(5, 351)]
    assert one(spark, labels.other_headings(swept)) == [*range(6, 350)]
    unit = geodesy.unit(F.lit(300.0))
    assert one(spark, geodesy.course_of(unit["x"], unit["y"])) == pytest.approx(300)
