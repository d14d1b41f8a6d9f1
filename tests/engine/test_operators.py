"""The operators against plain versions and published texts."""

import math
import random

import pytest

from climbout.operators import blocks, facilities, procedures, reports

QVX = """Rwy 12, climbing right turn direct QUAVERLY (QVX) VORTAC thence...
Rwy 30, climbing left turn direct QUAVERLY (QVX) VORTAC thence...
...continue climb in QVX holding pattern (SW, LT, 041° inbound) to cross QVX VORTAC at or above 7700 before proceeding on course."""
MRB = """Rwy 5, climb on heading 052° to 3100 before turning south.
Rwy 23, climb on heading 229° to 1900 before proceeding on course."""
DWN = """Rwy 17, climbing left turn heading 075° and DWN VORTAC R-118 outbound to 8800 before proceeding on course.
Rwy 35, climb direct DWN VORTAC and proceed on DWN R-118 outbound to 8900 before proceeding on course."""


def parsed(spark, **texts):
    read, failed = procedures.parse(spark.createDataFrame(list(texts.items()), "block string, text string"))
    groups = {(r.block, r.line): r for r in read.collect()}
    return groups, {(r.block, r.line): r.signature for r in failed.collect()}


def test_procedures_of_all_common_legs(spark):
    groups, failed = parsed(spark, qvx=QVX, mrb=MRB, dwn=DWN, chart="Rwy 8, use GALLOP DEPARTURE.\nRwy 26, NA - Obstacles.")
    assert not failed
    nodes = {k: [x.leg.node for x in g.legs] for k, g in groups.items()}
    assert nodes["qvx", 0] == ["Direct", "Thence"] and groups["qvx", 0].legs[0].side == "R" and groups["qvx", 0].legs[0].leg.target == "QVX"
    hold = groups["qvx", 2].legs[0].leg
    assert groups["qvx", 2].tail and (hold.node, hold.target, hold.hold_side, hold.hold_turns, hold.inbound, hold.kind, hold.feet) == ("ClimbInHold", "QVX", "SW", "LT", 41, "at or above", 7700)
    assert nodes["mrb", 0] == ["ClimbHeading", "ProceedOnCourse"] and groups["mrb", 0].legs[1].leg.toward == "south"
    both = groups["dwn", 0].legs[0].leg
    assert (both.node, both.heading, both.ident, both.radial, both.sense, both.feet) == ("HeadingAndRadial", 75, "DWN", 118, "outbound", 8800)
    assert nodes["dwn", 1] == ["Direct", "Radial", "ProceedOnCourse"]
    assert nodes["chart", 0] == ["GraphicDeparture"] and nodes["chart", 1] == ["NotAvailable"]


def test_unread_text_takes_down_what_it_may_bind(spark):
    groups, failed = parsed(spark, part="Rwy 6, climb banana.\nRwy 15, climb heading 150° to 5000 before proceeding on course.", all="Rwy 6, climb heading 150° to 5000.\nAircraft must whistle.", tail="Rwy 1, climb heading 010° to 900.\n...continue oddly.")
    assert set(groups) == {("part", 1)}
    assert failed["part", 0] == 'unmatched phrase "climb banana"' and failed["all", 1] == 'unmatched phrase "aircraft must whistle"' and ("tail", 1) in failed


PAGES = [
    ("XX7", 1, "T TAKEOFF MINS T\nMIDDLE FORK, ID\nQUAVERLY (QVX) (KQVX)\nTAKEOFF MINIMUMS AND (OBSTACLE)\nDEPARTURE PROCEDURES\nAMDT 5 02JAN25 (25002) (FAA)\nTAKEOFF MINIMUMS: Rwys 4, 22, NA - Terrain. Rwy 12,\n400-2 with a min. climb of 290 ft per NM.\nDEPARTURE PROCEDURE:\nRwy 12, climb...\n...in the hold.\nL31"),
    ("XX7", 2, "MIDDLE FORK, ID (CON'T)\nQUAVERLY (QVX) (KQVX)\nVCOA All Runways: Ask the tower first.\nTAKEOFF OBSTACLE NOTES: Rwy 4, mast.\nRwy 12, pole\n31' from DER.\nDUSTY FIELD (DF2)\nORIG 02JAN25 (25002) (FAA)\nDEPARTING PROCEDURE; Climb direct."),
]


def test_blocks_of_pages(spark):
    got = {r.lid: r for r in blocks.blocks(spark.createDataFrame(PAGES, "volume string, page int, text string")).collect()}
    qvx, dusty = got["QVX"], got["DF2"]
    assert (qvx.city, qvx.name, qvx.pages, qvx.amendment) == ("MIDDLE FORK, ID", "QUAVERLY", [1, 2], "AMDT 5 02JAN25 (25002) (FAA)")
    assert qvx.takeoff_minimums == "Rwys 4, 22, NA - Terrain. Rwy 12, 400-2 with a min. climb of 290 ft per NM."
    assert qvx.departure_procedure == "Rwy 12, climb...\n...in the hold." and qvx.vcoa == "All Runways: Ask the tower first."
    assert qvx.obstacle_notes == "Rwy 4, mast.\nRwy 12, pole 31' from DER." and qvx.dva is None
    assert (dusty.city, dusty.amendment, dusty.departure_procedure) == ("MIDDLE FORK, ID", "ORIG 02JAN25 (25002) (FAA)", "Climb direct.")


def nm(a, b):
    h = math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 3440.065 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def test_neighbours_and_colours(spark):
    rng = random.Random(1)
    points = [(i, rng.uniform(-89.5, 89.5), rng.choice([-179.9, 179.8, rng.uniform(-180, 180)])) for i in range(150)] + [(200 + i, 40 + i / 10, -100.0) for i in range(12)]
    frame = spark.createDataFrame(points, "id long, lat double, lon double")
    want = {(a[0], b[0]) for a in points for b in points if a[0] < b[0] and nm(a[1:], b[1:]) <= 300}
    assert {(r.a, r.b) for r in facilities.neighbours(frame, 300.0).collect()} == want
    near = facilities.neighbours(frame, 40.0)
    pairs = {(r.a, r.b) for r in near.collect()}
    got = {r.id: r.colour for r in reports.colour(frame, near).collect()}
    plain = {}
    for i, *_ in sorted(points):
        used = [plain[j] for j in plain if (j, i) in pairs]
        plain[i] = min(range(6), key=lambda k: (used.count(k), k))
    assert got == plain


def test_runway_pairs_need_exactly_their_two_ends(spark):
    rows = spark.createDataFrame([("QVX", "11/29"), ("QVX", "15/33"), ("QVX", "H1")], "lid string, runway_id string")
    ends = spark.createDataFrame([("QVX", "11/29", "29", 1.0), ("QVX", "11/29", "11", 2.0), ("QVX", "15/33", "15", 3.0), ("QVX", "H1", "H1", 4.0)], "lid string, runway_id string, end_id string, lat double")
    got = facilities.runway_pairs(rows, ends, ["lid"]).collect()
    assert [(r.runway_id, [e.end_id for e in r.ends]) for r in got] == [("11/29", ["11", "29"])]


def test_summary_line(spark):
    t = spark.createDataFrame([(1872, 2004, 96, 17, 31, 150), (0, 0, 0, 0, 0, 0)], "drawn long, textual long, findings long, signatures long, partial long, graphic_only long")
    assert [r.line for r in reports.summary(t).orderBy("drawn").collect()] == ["Drew 0 of 0 ODPs (0%); 0 findings in 0 signatures", "Drew 1,872 of 2,004 ODPs (93%, 31 in part); 96 findings in 17 signatures; 150 airports use only charted DPs"]


@pytest.mark.parametrize("text,kind", [("Rwy 8, climb on runway heading to 3000 before turning.", "RunwayHeading"), ("Rwy 8, climb straight ahead to 3000.", "StraightAhead"), ("Rwy 8, climb heading between 100° CW to 200° from DER.", "HeadingRange")])
def test_leg_kinds(spark, text, kind):
    groups, failed = parsed(spark, x=text)
    assert not failed and groups["x", 0].legs[0].leg.node == kind


def test_shapes(spark):
    from pyspark.sql import functions as F

    from climbout.operators import shapes

    one = spark.range(1)
    lit = lambda *x: [F.lit(float(v)) for v in x]
    leg = one.select(shapes.direct(*lit(0, 2, 360), *lit(8, 0), F.lit("R"), F.lit(0.8)).alias("l")).first().l
    assert (leg.x, leg.y, leg.failure) == (8, 0, None) and 90 < leg.course < 180
    assert one.select(shapes.direct(*lit(0, 2, 360), *lit(0.5, 2.0), F.lit("R"), F.lit(0.8)).alias("l")).first().l.failure == "fix inside turn circle"
    at = one.select(shapes.intercept(*lit(0, 0, 90, 10, 10, 180)).alias("p")).first().p
    assert (round(at.x, 6), round(at.y, 6), at.failure) == (10, 0, None)
    assert one.select(shapes.intercept(*lit(0, 0, 90, -10, 10, 180)).alias("p")).first().p.failure == "radial intercept behind"
    track = one.select(shapes.racetrack(*lit(0, 6, 360), F.lit("R"), F.lit(2.5), F.lit(0.8)).alias("t")).first().t
    assert max(p.x for p in track) == pytest.approx(1.6) and min(p.y for p in track) == pytest.approx(6 - 2.5 - 0.8) and track[0] == track[-1]
