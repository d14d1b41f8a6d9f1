"""Ends of routes, shared tails, parts, shades, styles and round trips on small tables."""

import colorsys
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from climbout.functions import labels, shades
from climbout.operators import parts, pens, procedures, visual_climbs
from climbout.sources import kml, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def strings(*values):
    return F.array(*[F.lit(v) for v in values]) if values else F.expr("cast(array() as array<string>)")


def lch(colour):
    """Lightness, chroma and hue of a KML colour, with numpy."""
    v = np.array([int(colour[i : i + 2], 16) for i in (6, 4, 2)]) / 255
    v = np.where(v <= 0.04045, v / 12.92, ((v + 0.055) / 1.055) ** 2.4)
    lightness, a, b = np.array(shades.TO_LAB) @ np.cbrt(np.array(shades.TO_CONES) @ v)
    return lightness, math.hypot(a, b), math.degrees(math.atan2(b, a))


def displayable(lightness, chroma, hue):
    while True:
        lab = np.array([lightness, chroma * math.cos(math.radians(hue)), chroma * math.sin(math.radians(hue))])
        v = np.array(shades.TO_RGB) @ (np.array(shades.FROM_LAB) @ lab) ** 3
        if chroma <= 0 or (v.min() >= -1e-4 and v.max() <= 1.0001):
            v = np.clip(v, 0, 1)
            return [int(c) for c in np.round(255 * np.where(v <= 0.0031308, 12.92 * v, 1.055 * v ** (1 / 2.4) - 0.055))]
        chroma -= 0.002


def plain_shades(colour, n, palette):
    if n < 2:
        return [colour] * n
    lightness, chroma, hue = lch(colour)
    room = {1: 15.0, -1: 15.0}
    for _, other_chroma, other_hue in map(lch, palette):
        gap = (other_hue - hue + 180) % 360 - 180
        if gap and min(chroma, other_chroma) / max(chroma, other_chroma) >= 0.6:
            room[int(math.copysign(1, gap))] = min(room[int(math.copysign(1, gap))], abs(gap) / 3)
    rows = 1 + (n > 3)
    columns = -(-n // rows)
    stride = min((s for s in range(n // 2 + 1, n) if math.gcd(s, n) == 1), default=1)
    out = []
    for i in range(n):
        row, column = divmod(i * stride % n, columns)
        move = 0 if columns == 1 else (room[1] + room[-1]) * column / (columns - 1) - room[-1]
        red, green, blue = displayable(lightness, chroma * (1 - 0.4 * row), hue + move)
        out.append(f"{colour[:2]}{blue:02x}{green:02x}{red:02x}")
    return out


def test_shades_of_every_palette(spark):
    wanted = spark.createDataFrame([(c, n) for c in kml.PALETTES for n in range(9)], "colour string, n int")
    for r in wanted.select("colour", "n", shades.shades(F.col("colour"), F.col("n"), kml.PALETTES).alias("got")).collect():
        assert r.got == plain_shades(r.colour, r.n, kml.PALETTES), (r.colour, r.n)
        assert len(set(r.got)) == r.n


def test_grey_keeps_its_hue(spark):
    lightness, chroma, _ = one(spark, shades.oklch(F.lit("ff808080")))
    assert chroma == pytest.approx(0, abs=1e-4) and 0.5 < lightness < 0.7
    assert colorsys.rgb_to_hls(0.5, 0.5, 0.5)[2] == 0
    assert one(spark, shades.kml(shades.shown(F.lit(lightness), F.lit(chroma), F.lit(0.0)), F.lit("7f"))) == "7f808080"


def test_groups_of_one_airport_get_shades(spark):
    rows = [("A", 0, "route", ["22"]), ("A", 0, "radial", ["4"]), ("A", 0, "route", []), ("A", 0, "route", ["16L", "16R"]), ("B", 1, "hold", ["H1"]), ("B", 1, "hold", None)]
    got = kml.group_styles(spark.createDataFrame(rows, "lid string, palette int, style string, grp array<string>")).collect()
    own = plain_shades(kml.PALETTES[0], 3, kml.PALETTES)
    assert {(r.lid, tuple(r.grp or ["none"]), r.style_id, r.colour) for r in got} == {
        ("A", ("4",), "radial-0-3-0", own[0]), ("A", ("16L", "16R"), "route-0-3-1", own[1]), ("A", ("22",), "route-0-3-2", own[2]),
        ("A", ("none",), "route-0", None), ("B", ("H1",), "hold-1", None), ("B", ("none",), "hold-1", None),
    }
    styles = kml.shared_styles(spark).collect()
    assert len({s.style_id for s in styles}) == len(styles) == 30
    assert '<Style id="vcoa-5"><LineStyle><color>ff14466e</color><width>5</width></LineStyle></Style>' in {s.kml for s in styles}


def test_no_turn_has_no_dashes(spark):
    zero = F.lit(0.0)
    assert one(spark, pens.dashed_turn(zero, zero, F.lit(90.0), F.lit(90.0), F.lit(None).cast("string"), F.lit(0.8))) == []
    last = one(spark, pens.dashed_turn(zero, zero, F.lit(0.0), F.lit(90.0), F.lit("R"), F.lit(0.8)))[-1]
    assert last.to_deg <= 90
    straight = one(spark, pens.on_course(zero, zero, F.lit(0.0), F.lit(None).cast("string")))
    assert straight[-1].b.y == pytest.approx(1.0) and all(d.a.x == pytest.approx(0) for d in straight)


@pytest.mark.parametrize(
    ("starts", "ends", "course", "side", "outbound"),
    [(2.0, 5.0, 0.0, None, True), (5.0, 2.0, 0.0, None, False), (5.0, 5.4, 0.0, None, None), (2.0, None, 40.0, None, True), (2.0, None, 250.0, None, False), (2.0, None, 160.0, None, None), (2.0, None, 330.0, "R", True), (2.0, None, 80.0, "R", None), (2.0, None, None, None, None)],
)
def test_sense_of_a_radial_of_090(spark, starts, ends, course, side, outbound):
    lit = lambda v, t: F.lit(v).cast(t)
    got = pens.flown_outbound(lit(None, "boolean"), lit(starts, "double"), lit(ends, "double"), lit(course, "double"), F.lit(90.0), lit(side, "string"))
    assert one(spark, got) is outbound


def test_pens_meet_or_do_not(spark):
    rows = [(1, 2, "b", 0.3, 0.0), (1, 1, "a", 0.0, 0.0), (2, 1, "a", 0.0, 0.0), (2, 2, "b", 0.0, 0.6), (3, 1, "a", 7.0, 7.0)]
    got = {r.block: (r.name, round(r.gap_nm, 3), r.failure) for r in pens.tail_starts(spark.createDataFrame(rows, "block int, seq int, name string, x double, y double")).collect()}
    assert got == {1: ("a", 0.3, None), 2: ("a", 0.6, "shared tail start mismatch"), 3: ("a", 0.0, None)}


def test_parts_and_withheld_routes(spark):
    texts = [(1, "Rwy 9, climb heading 090° to 2000 thence...\nRwy 27, use WOLF DEPARTURE.\nRwy 18, climb heading 180° to 3000.\n...climb direct ELK VORTAC."), (2, "Rwy 9, climb heading 090° to 2000.")]
    read, failures = procedures.parse(spark.createDataFrame(texts, "block int, text string"))
    assert failures.isEmpty()
    got = {(r.block, r.part): [x.leg.node for x in r.tail_legs or []] for r in parts.parts(read).collect()}
    assert got == {(1, "RWY 9"): ["Direct"], (1, "RWY 18"): [], (2, "RWY 9"): []}
    limits = spark.createDataFrame([(1, "Rwy 18, std., 180 KIAS or less."), (2, None)], "block int, text string")
    kept, withheld = parts.without_speed_limited(read, limits)
    assert [(r.block, r.part, r.detail) for r in withheld.collect()] == [(1, "RWY 18", "Rwy 18, std., 180 KIAS or less.")]
    assert kept.count() == read.count() - 1
    assert parts.parts(read.limit(0)).isEmpty()


def test_hold_without_a_fix_takes_that_of_the_leg_before(spark):
    text = "Rwy 9, climb heading 090° to 2000, direct ELK VORTAC, continue climb in holding pattern to 5000, climb in hold to 6000."
    rows = parts.with_hold_fix(procedures.legs(procedures.groups(spark.createDataFrame([(1, text)], "block int, text string"))))
    assert [(r.leg.node, r.held) for r in rows.orderBy("seq").collect()] == [("ClimbHeading", None), ("Direct", None), ("ClimbInHold", "ELK"), ("ClimbInHold", None)]


def test_older_reports_lack_counts(spark):
    lines = spark.createDataFrame([(-1, '{"cycle":"2601","drawn":3}'), (0, '{"kind":"PARSE","airport":"ABC"}')], "seq long, line string")
    totals, findings = sinks.report_from_json(lines)
    assert totals.first()[:] == ("2601", None, 3, None, 0, 0)
    assert findings.first()[:3] == (0, "PARSE", "ABC")


def test_snapshots_of_cycles_and_states(spark, tmp_path):
    row = "lid string, state string, outcome string, digest string, findings array<string>"
    path = str(tmp_path / "snapshots")
    sinks.save_snapshot(spark.createDataFrame([("ABC", "CA", "whole", "12", ["x"]), ("DEF", "NV", "part", None, [])], row), path, "2601")
    sinks.save_snapshot(spark.createDataFrame([("ABC", "CA", "part", "34", [])], row), path, "2602")
    sinks.save_snapshot(spark.createDataFrame([("ABC", "CA", "whole", "56", [])], row), path, "2602")
    assert sorted(r.lid for r in sinks.load_snapshot(spark, path, "2601").collect()) == ["ABC", "DEF"]
    assert [r.lid for r in sinks.load_snapshot(spark, path, "2601", "NV").collect()] == ["DEF"]
    assert [r.digest for r in sinks.load_snapshot(spark, path, "2602").collect()] == ["56"]


def test_note_breaks_only_after_a_slash(spark):
    assert one(spark, labels.not_shown(strings())) == ["ODP NOT SHOWN"]
    assert one(spark, labels.not_shown(strings("RWY 4", "RWY 22", "RWY 4", "VCOA", "other runways"))) == ["ODP NOT SHOWN", "RWY 4, RWY 22, VCOA,", "other runways"]
    assert one(spark, labels.speed(F.lit(200), F.lit(None).cast("string"))) == "≤200 KIAS"


def test_visual_climbs_of_a_section(spark):
    ask = "obtain ATC approval for VCOA when requesting IFR clearance. "
    climb = "Climb in visual conditions to cross "
    texts = [
        (1, f"Rwys 4, 13, {ask}{climb}Elk Mountain airport at or above 9200 before proceeding on course."),
        (2, f"{ask.capitalize()}{climb}OAKEY westbound or above 4300 MSL. When executing VCOA, notify ATC prior to departure."),
        (3, f"All runways: obtain ATC approval for climb in visual conditions when requesting IFR clearance. {climb}ELK VORTAC at or above 5000."),
        (4, f"Rwy 9, {ask}{climb}Augusta Rgnl at Bush Fld at or above 5000, climb heading 090° to 6000 thence..."),
        (5, None), (6, ""), (7, f"Rwy 9, {ask}{climb}Elk airport at or above 5000 direct nowhere at all."),
    ]
    climbs, failures = visual_climbs.read(spark.createDataFrame(texts, "block int, vcoa string"))
    got = {r.block: (r.runways, r.cross, r.bound, r.feet, [x.leg.node for x in r.legs or []]) for r in climbs.collect()}
    assert got == {1: (["4", "13"], None, None, 9200, ["ProceedOnCourse"]), 2: ([], "OAKEY", "west", 4300, [])}
    lost = {r.block: r.signature for r in failures.collect()}
    assert set(lost) == {3, 4, 7} and lost[3] == "unsupported VCOA crossing a navaid"
    assert lost[4] == "visual climb into the shared tail" and lost[7].startswith("unmatched phrase")


def test_routes_that_are_none(spark):
    texts = [(1, "Rwy 9, NA - Obstacles."), (2, "Rwy 9, left turns on departure NA."), (3, "Rwy 9, diverse departures authorized."), (4, "Rwy 9, climb heading 090° to 2000.")]
    read, failures = procedures.parse(spark.createDataFrame(texts, "block int, text string"))
    assert failures.isEmpty() and {r.block for r in read.where(parts.flies(F.col("legs"))).collect()} == {4}
    assert {r.block for r in parts.parts(read).collect()} == {4}


def test_holds_on_the_wrong_side_fail_unless_told_otherwise(spark):
    hold = lambda side: f"Rwy 9, climb in ELK holding pattern (hold {side}, RT, 246° inbound) to 5000."
    texts = spark.createDataFrame([(1, hold("northeast")), (2, hold("south")), (3, hold("E"))], "block int, text string")
    assert {r.block: r.signature for r in procedures.parse(texts)[1].collect()} == {2: procedures.CONTRARY_HOLD}
    assert procedures.parse(texts, check_holds=False)[1].isEmpty()
