"""Values of the column functions."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from climbout.functions import cycles, geodesy, runways, signatures, spelling

#: (as printed, as spelled): at least one for each rule, and texts that a rule leaves alone.
SPELLINGS = [
    ("‘A’ and “B” turn 090º", "'A' and \"B\" turn 090°"),
    ("cross it… then. . . .on\t.\t.\t.", "cross it... then...on ..."),
    ("QQV r-007, ZZT R- 114 and R·359, R-12", "QQV R-007, ZZT R-114 and R-359, R-12"),
    ("QQV VOR/\n DME, an NDB/  DME, a TACAN/ DME", "QQV VOR/DME, an NDB/DME, a TACAN/ DME"),
    ("HDG017 or heading9, subheading4", "HDG 017 or heading 9, subheading4"),
    ("hdg 008.000 then heading 360.0 but 41.00", "hdg 008 then heading 360 but 41.00"),
    ("CLIMB-IN hold, climb in -hold, climb in hold", "CLIMB-in-hold, climb-in-hold, climb in hold"),
    ("At/Above 50, flat/above", "At or Above 50, flat/above"),
    ("1,000 or 22,750; 333,000; 1,2,300", "1000 or 22750; 333,000; 1,2,300"),
    ("exceed 190K, Exceed 90 knots, exceed 5 kt, exceed 70 Kings", "exceed 190 KIAS, Exceed 90 KIAS, exceed 5 KIAS, exceed 70 Kings"),
    ("stop.. now ... go", "stop. now ... go"),
    ("w/min. slope and with a min slope, w/ minimum", "with a min. slope and with a min. slope, w/ minimum"),
    ("a VOCA, no AVOCADO", "a VCOA, no AVOCADO"),
    ("Runway heading  9900, runway heading 090", "Runway heading to 9900, runway heading 090"),
    ("7⅞ and ⅛, 3¾", "7 7/8 and 1/8, 3 3/4"),
    ("410' per NM, 260'/NM, 88' tree, it's", "410 ft per NM, 260 ft/NM, 88 tree, it's"),
    ("a \u00a0\t b\u3000c\x0bd", "a b c d"),
    ("one \n  two\u00a0\n\n\n \n three", "one\ntwo\n\nthree"),
    ("go preceding on course, preceding it", "go proceeding on course, preceding it"),
    ("Continue climbing on course; continue climb on course", "Climb on course; climb on course"),
    ("north of of QQV, of office", "north of QQV, of office"),
    ("a Holding Pattern. (hold S), pattern. (Hold", "a Holding Pattern (hold S), pattern. (Hold"),
    ("\u2003 \n ends \n", "ends"),
    ("", ""),
]


def column(spark, values, c, schema="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    return [r.out for r in spark.createDataFrame(rows, f"i int, x {schema}").select("i", c(F.col("x")).alias("out")).orderBy("i").collect()]


def test_spelling(spark):
    assert column(spark, [a for a, _ in SPELLINGS] + [None], spelling.normalize) == [b for _, b in SPELLINGS] + [None]


def test_cycles(spark):
    days = [dt.date(2026, 9, 23), dt.date(2026, 10, 1), dt.date(2026, 9, 30), dt.date(2020, 12, 2)]
    assert column(spark, days, cycles.containing, "date") == [dt.date(2026, 9, 3), dt.date(2026, 10, 1), dt.date(2026, 9, 3), dt.date(2020, 11, 5)]
    dates = ["2026-01-22", "2026-09-03", "2026-12-24", "2027-01-21", "2025-12-25"]
    assert column(spark, dates, lambda c: cycles.code(c.cast("date"))) == ["2601", "2609", "2613", "2701", "2513"]
    assert column(spark, ["2026-09-03"], lambda c: cycles.tag(c.cast("date"))) == ["03_Sep_2026"]
    with pytest.raises(Exception):
        column(spark, ["2026-09-04"], lambda c: cycles.checked(c.cast("date")))


def test_runways(spark):
    assert column(spark, ["4", "04", "15", "4l", "H1"], runways.canonical) == ["04", "04", "15", "04L", "H1"]
    assert column(spark, ["2L/R, 35", "4"], runways.expand) == [["2L", "2R", "35"], ["4"]]
    assert column(spark, ["", " ", "5430.3", None], runways.number) == [None, None, 5430.3, None]
    text = "Rwy 7, NA - obstacles. Rwys 2, 20, std. with a min. climb of 275 ft per NM to 2600. Rwy 31, std. with a min. climb of 410 ft per NM."
    (got,) = column(spark, [text], runways.gradients)
    assert {g.runway: (g.ft_per_nm, g.to_ft) for g in got} == {"2": (275, 2600), "20": (275, 2600), "31": (410, None)}


def test_signatures(spark):
    assert column(spark, ["Climb to 9300 via QVX VORTAC R-210"], signatures.phrase_signature) == ["climb to <n> via <id> vortac r-<n>"]
    assert column(spark, ["VOR", "QVX", "X", "Ab"], lambda c: signatures.is_ident_word(c)) == [False, True, False, False]
    assert column(spark, ["at  kqvx: QVX VOR R-210, 3U3 to 9300"], lambda c: signatures.finding_signature(c, F.lit("KQVX"))) == ["at id: id vor r-nnn, id to nnnn"]
    (key,) = column(spark, ["QVX 12"], lambda c: signatures.signature_key(F.lit("parse"), c, F.lit(None)))
    assert key == hashlib.sha1(b"parse:id nn").hexdigest()
    assert column(spark, ["climb...to 9.5ft R-210é ¾"], signatures.tokens) == [["climb", "...", "to", "9.5ft", "R-210", "é", "¾"]]


def test_geodesy(spark):
    one = spark.range(1)
    f = lambda c: one.select(c.alias("x")).first().x
    lit = lambda *x: [F.lit(float(v)) for v in x]
    assert f(geodesy.distance(*lit(37.6188056, -122.3754167, 33.9424964, -118.4080486))) == pytest.approx(293, abs=1)
    assert f(geodesy.bearing(*lit(37.6188056, -122.3754167, 33.9424964, -118.4080486))) == pytest.approx(137, abs=1)
    assert f(geodesy.destination(*lit(37, -122, 0, 60))["lat"]) == pytest.approx(38, abs=0.01)
    assert f(geodesy.plane_x(*lit(0, -179, 180))) == pytest.approx(-60, abs=1e-9)
    assert f(geodesy.plane_y(*lit(41, 43.5))) == 150 and f(geodesy.plane_lat(*lit(41, 150))) == 43.5
    assert f(geodesy.plane_lon(*lit(60, 179, 60))) == pytest.approx(-179, abs=1e-9)
    assert (f(geodesy.to_true(*lit(123, 15))), f(geodesy.to_true(*lit(350, 15))), f(geodesy.wrap360(F.lit(-10.0)))) == (138, 5, 350)
    assert f(geodesy.turn_radius(*lit(150, 25))) == pytest.approx(150 / 188.5)
    assert f(geodesy.clipped_length(*lit(-2, 0, 2, 0, -1, -1, 1, 1))) == 2
