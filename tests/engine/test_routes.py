"""The pen against a plain pen that walks leg by leg, on random routes of all kinds of legs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from climbout.operators import routes, whole_sections

R = routes.RADIUS
NAMES = ("node", "side", "turns", "heading", "feet", "fx", "fy", "nx", "ny", "radial", "sense", "dme", "at_navaid", "onto", "inbound")
SCHEMA = f"id int, x double, y double, course double, base_ft double, ft_per_nm double, to_ft double, legs array<struct<{', '.join(f.replace(' ', ': ', 1) for f in routes.LEG.split(', '))}>>"


def leg(node, **more):
    return tuple({"turns": False, "at_navaid": False, "onto": False, "node": node, **more}.get(n) for n in NAMES)


class Stop(Exception):
    pass


class Plain:
    """Vectors as complex numbers, north along the imaginary axis."""

    def __init__(self, x, y, course, base, steep, top):
        self.at, self.course, self.runway, self.base, self.steep, self.top = complex(x, y), course, course, base, steep, top
        self.along, self.open, self.straight, self.ranged = 1.0, False, True, False

    @staticmethod
    def way(course):
        return complex(math.sin(math.radians(course)), math.cos(math.radians(course)))

    def climb(self, feet):
        top = self.top if self.top is not None else 1e9
        return max(min(feet, top) - self.base, 0) / (self.steep or 200.0) + max(feet - max(self.base, top), 0) / 200.0

    def need(self, feet):
        if feet <= self.base:
            raise Stop("altitude not above current")
        nm = max(1.0, self.climb(feet))
        if nm > 30:
            raise Stop("altitude leg capped")
        return nm

    def turn(self, to, side):
        right = (to - self.course) % 360
        by = right if side == "R" else (right - 360 if right else 0.0) if side == "L" else right - 360 if right > 180 else right
        hand = -1 if by < 0 else 1
        if by:
            centre = self.at + R * self.way(self.course + 90 * hand)
            self.at = centre + R * self.way(to - 90 * hand)
        self.along += R * math.radians(abs(by))
        self.course = to % 360

    def go(self, nm):
        self.at += nm * self.way(self.course)
        self.along += nm

    def beside(self, navaid, course):
        off = (self.at - navaid) / self.way(course)  # along the course, and left of it
        return off.real, -off.imag

    def fly(self, v):
        node, side = v["node"], v["side"]
        if self.ranged and node not in ("ProceedOnCourse", "SpeedRestriction"):
            raise Stop("leg after a heading range")
        if node in routes.HEADINGS:
            if node == "StraightAhead" and (v["turns"] or not self.straight):
                raise Stop("unsupported leg")
            self.turn(v["heading"] if node == "ClimbHeading" else self.runway, side)
            if v["feet"] is not None:
                self.go(max(0.0, self.need(v["feet"]) - self.along))
        elif node == "Direct":
            fix = complex(v["fx"], v["fy"])
            bearing = math.degrees(math.atan2((fix - self.at).real, (fix - self.at).imag))
            hand = {"R": 1, "L": -1}.get(side) or (-1 if (bearing - self.course) % 360 > 180 else 1)
            centre = self.at + R * self.way(self.course + 90 * hand)
            reach = abs(fix - centre)
            if reach < R:
                raise Stop("fix inside turn circle")
            if math.sqrt(reach**2 - R**2) < 0.5:
                raise Stop("leg too short")
            out = math.degrees(math.atan2((fix - centre).real, (fix - centre).imag)) - hand * math.degrees(math.acos(R / reach))
            self.turn(out + 90 * hand, "R" if hand > 0 else "L")
            self.go(abs(fix - self.at))
        elif node in routes.RADIALS:
            self.radial(v)
        elif node == "HeadingRange":
            if v["feet"] is not None and v["feet"] <= self.base:
                raise Stop("altitude not above current")
            self.ranged = True
        elif node == "ClimbInHold":
            if v["inbound"] is None:
                raise Stop("hold unspecified")
            fix = complex(v["fx"], v["fy"])
            if abs(fix - self.at) > 0.01:
                if abs((math.degrees(math.atan2((fix - self.at).real, (fix - self.at).imag)) - self.course + 180) % 360 - 180) > 90:
                    raise Stop("hold fix behind")
                self.fly({**v, "node": "Direct", "side": None})
            self.at, self.course = fix, v["inbound"]
            if v["feet"] is not None:
                self.base, self.along = v["feet"], 0.0
        elif node == "CrossAt":
            off = (complex(v["fx"], v["fy"]) - self.at) / self.way(self.course)
            if abs(off.real) > 0.01 or abs(off.imag) > 0.5:
                raise Stop("crossing off the route")
        self.open = self.open if node == "Thence" else node in ("ClimbHeading", "RunwayHeading") and v["feet"] is None
        self.straight = self.straight and node not in ("ClimbHeading", "Direct", "ClimbInHold", "HeadingRange", *routes.RADIALS)

    def radial(self, v):
        if v["sense"] is None:
            raise Stop("radial sense unstated")
        navaid, out = complex(v["nx"], v["ny"]), v["radial"]
        track = out if v["sense"] == "outbound" else (out + 180) % 360
        rolls = False
        if v["node"] == "HeadingAndRadial":
            heading = v["heading"]
        elif self.open and not v["turns"]:
            heading = self.course
        elif v["onto"]:
            if v["side"] is None:
                raise Stop("intercept without a turn")
            hand = 1 if v["side"] == "R" else -1
            centre = Plain.beside_point(self.at + R * self.way(self.course + 90 * hand), navaid, track)
            rolls = abs(centre - hand * R) <= 0.5
            off = centre - hand * R if rolls else centre - hand * R * math.cos(math.radians(45))
            heading = (track - math.copysign(20 if rolls else 45, off)) % 360
            by = lambda to: (to - self.course) % 360 if hand > 0 else -((self.course - to) % 360)
            if abs(by(heading) - by(track)) > 45 + 1e-6 or abs(by(heading)) > 270:
                raise Stop("intercept heading behind the turn")
        else:
            heading = None
        if heading is None:
            self.turn(track, v["side"])
            along, across = self.beside(navaid, out)
            if along < 0 or abs(across) > 0.5:
                raise Stop("off radial")
        elif rolls:
            self.turn(track, v["side"])
            along, across = self.beside(navaid, out)
            by = abs(across) / math.tan(math.radians(20))
            to = along + (by if v["sense"] == "outbound" else -by)
            if along < 0 or to < 0:
                raise Stop("off radial")
            end = navaid + to * self.way(out)
            self.along += abs(end - self.at)
            self.at = end
        else:
            self.turn(heading, v["side"])
            lines = ((heading - out + 180) % 360 - 180, (heading - out) % 360 - 180)
            u, w = self.way(heading), self.way(out)
            cross = lambda a, b: a.real * b.imag - a.imag * b.real
            refused = None
            if min(map(abs, lines)) < 15:
                refused = "radial colinear"
            else:
                ahead, back = cross(navaid - self.at, w) / cross(u, w), cross(navaid - self.at, u) / cross(u, w)
                by = (track - heading + 180) % 360 - 180
                lead = R * math.tan(math.radians(abs(by)) / 2)
                if ahead <= 0 or back <= 0 or ahead < lead:
                    refused = "radial intercept behind"
            along, across = self.beside(navaid, out)
            if refused:
                if not (v["node"] == "HeadingAndRadial" and along >= 0 and abs(across) <= 0.5 and math.degrees(math.atan2(abs(across), along)) <= 3):
                    raise Stop(refused)
            else:
                self.go(ahead - lead)
            self.turn(track, None)
        self.track(v, navaid, out, track)

    @staticmethod
    def beside_point(point, navaid, course):
        return -((point - navaid) / Plain.way(course)).imag

    def track(self, v, navaid, out, track):
        fix = None if v["fx"] is None or v["at_navaid"] else complex(v["fx"], v["fy"])
        climbs = fix is None and not v["at_navaid"] and v["dme"] is None and v["feet"] is not None
        ahead = lambda p: ((p - self.at) / self.way(track)).real
        if v["at_navaid"] or (fix is None and v["dme"] is None and v["feet"] is None and v["sense"] == "inbound"):
            nm, end = ahead(navaid), navaid
        elif fix is not None:
            if abs(((fix - self.at) / self.way(track)).imag) > 0.5:
                raise Stop("off radial")
            nm, end = ahead(fix), None
        elif v["dme"] is not None:
            end = navaid + v["dme"] * self.way(out)
            nm = ahead(end)
        elif climbs:
            # the climb's own limits come last, behind the question whether the end lies short of the navaid
            top = max(1.0, self.climb(v["feet"]))
            nm, end = max(0.0, top - self.along), None
            if v["sense"] == "inbound" and nm > ahead(navaid):
                raise Stop("unsupported leg")
        else:
            raise Stop("unsupported leg")
        if not climbs and nm < 0.5:
            raise Stop("leg too short")
        if v["feet"] is not None:
            self.need(v["feet"])
        self.at = self.at + nm * self.way(track) if end is None else end
        self.course = track
        self.along += nm
        if v["feet"] is not None and not climbs:
            self.along, self.base = min(0.0, self.along - self.climb(v["feet"])), v["feet"]


def random_route(rng):
    legs, side = [], lambda: rng.choice([None, "L", "R"])
    for _ in range(rng.randint(1, 4)):
        kind = rng.choice(["heading", "heading", "runway", "ahead", "direct", "both", "both", "radial", "onto", "cross", "thence", "course", "hold", "range"])
        feet = rng.choice([None, rng.choice([900.0, 2500.0, 4000.0, 9000.0])])
        radial = dict(nx=rng.uniform(-12, 12), ny=rng.uniform(-12, 12), radial=rng.uniform(0, 360), sense=rng.choice(["inbound", "outbound", "outbound", None]))
        end = rng.choice([dict(feet=rng.choice([2500.0, 4000.0, 9000.0])), dict(dme=rng.uniform(1, 25)), dict(at_navaid=True, fx=radial["nx"], fy=radial["ny"]), {}, dict(dme=rng.uniform(5, 25), feet=4000.0)])
        s = side()
        if kind == "heading":
            legs.append(leg("ClimbHeading", heading=rng.uniform(0, 360), feet=feet, side=s, turns=s is not None))
        elif kind == "runway":
            legs.append(leg("RunwayHeading", feet=feet))
        elif kind == "ahead":
            legs.append(leg("StraightAhead", feet=feet))
        elif kind == "direct":
            legs.append(leg("Direct", fx=rng.uniform(-9, 9), fy=rng.uniform(-9, 9), side=s, turns=s is not None))
        elif kind == "both":
            legs.append(leg("HeadingAndRadial", heading=rng.uniform(0, 360), side=s, **radial, **end))
        elif kind == "radial":
            legs.append(leg("Radial", **radial, **end))
        elif kind == "onto":
            legs.append(leg("Radial", onto=True, turns=True, side=s, **radial, **end))
        elif kind == "hold":
            legs.append(leg("ClimbInHold", fx=rng.uniform(-9, 9), fy=rng.uniform(-9, 9), inbound=rng.choice([None, 40.0, 215.0]), feet=feet))
        elif kind == "range":
            legs.append(leg("HeadingRange", feet=feet))
        elif kind == "cross":
            legs.append(leg("CrossAt", fx=rng.uniform(-1, 1), fy=rng.uniform(-1, 1), feet=5000.0))
        else:
            legs.append(leg("Thence" if kind == "thence" else "ProceedOnCourse"))
    return legs


def aimed_routes(rng, n):
    """Routes whose radials can be flown: the navaid lies where the leg before leads."""
    out = []
    for _ in range(n):
        course, radial = rng.uniform(0, 360), rng.uniform(0, 360)
        way = Plain.way
        meet = rng.uniform(6, 12) * way(course)
        sense = rng.choice(["inbound", "outbound"])
        off = rng.uniform(8, 15) if sense == "inbound" else rng.uniform(1, 6)
        navaid = meet - off * way(radial)
        spot = dict(nx=navaid.real, ny=navaid.imag, radial=radial, sense=sense)
        end = rng.choice([dict(at_navaid=True, fx=navaid.real, fy=navaid.imag) if sense == "inbound" else dict(dme=off + 8), dict(feet=rng.choice([3000.0, 5000.0]))])
        first = rng.choice([[leg("ClimbHeading", heading=course)], []])
        kind = rng.choice(["HeadingAndRadial", "Radial"]) if first else "HeadingAndRadial"
        legs = [*first, leg(kind, heading=course, **spot, **end), leg("ProceedOnCourse")]
        if rng.random() < 0.4:
            legs = [leg("Direct", fx=navaid.real, fy=navaid.imag), leg("Radial", **{**spot, "sense": "outbound"}, dme=20.0, feet=6000.0), leg("ClimbHeading", heading=radial, feet=8000.0)]
            legs += [leg("ClimbInHold", fx=20 * way(radial).real, fy=20 * way(radial).imag, inbound=radial, feet=9000.0)] if rng.random() < 0.5 else []
            legs[1] = leg("Radial", onto=rng.random() < 0.3, side=rng.choice(["L", "R"]), turns=True, **{**spot, "sense": "outbound"}, dme=20.0, feet=6000.0)
        out.append((course, legs))
    return out


def test_random_routes(spark):
    rng = random.Random(21)
    rows = [(i, 0.0, 1.0, float(rng.choice([0, 90, 215])), 700.0, rng.choice([None, 320.0]), rng.choice([None, 3000.0]), random_route(rng)) for i in range(500)]
    rows += [(1000 + i, 0.0, 0.0, course, 700.0, None, None, legs) for i, (course, legs) in enumerate(aimed_routes(rng, 300))]
    got = {r.id: r.pen for r in routes.fly(spark.createDataFrame(rows, SCHEMA)).select("id", "pen").collect()}
    flown = kinds = 0
    for i, x, y, course, base, steep, top, legs in rows:
        plain, failure = Plain(x, y, course, base, steep, top), None
        try:
            for one in legs:
                plain.fly(dict(zip(NAMES, one, strict=True)))
        except Stop as stop:
            failure = str(stop)
        pen = got[i]
        assert pen.failure == failure, (i, legs)
        if failure is None:
            flown += 1
            kinds += any(v[0] in routes.RADIALS for v in legs)
            assert (pen.x, pen.y, pen.along, pen.base_ft) == pytest.approx((plain.at.real, plain.at.imag, plain.along, plain.base), abs=1e-6)
            assert math.cos(math.radians(pen.course - plain.course)) == pytest.approx(1, abs=1e-9) and pen.open == plain.open
    assert flown > 250 and kinds > 100


def test_the_drawn_line_runs_through_all_moves(spark):
    rng = random.Random(2)
    rows = [(i, 0.0, 0.0, course, 700.0, None, None, legs) for i, (course, legs) in enumerate(aimed_routes(rng, 40))]
    for r in routes.fly(spark.createDataFrame(rows, SCHEMA)).where("pen.failure is null").select("pen", routes.points(F.col("pen.moves")).alias("line")).collect():
        assert (r.line[-1].x, r.line[-1].y) == pytest.approx((r.pen.x, r.pen.y))
        for m in r.pen.moves:
            for x, y in ((m.x0, m.y0), (m.sx, m.sy)):
                assert min(math.hypot(p.x - x, p.y - y) for p in r.line) < 1e-6


def test_tail_begins_where_routes_converge(spark):
    base = "struct<x: double, y: double, course: double, along: double, base_ft: double, failure: string>"
    pens = [("near", 0, "4", (0.0, 0.0, 10.0, 3.0, 900.0, None)), ("near", 1, "22", (0.3, 0.3, 50.0, 5.0, 800.0, None)), ("apart", 0, "4", (0.0, 0.0, 10.0, 3.0, 900.0, None)), ("apart", 1, "9", (0.0, 0.6, 0.0, 1.0, 1.0, None)), ("lost", 0, "4", (0.0, 0.0, 0.0, 0.0, 0.0, "off radial"))]
    flown = spark.createDataFrame(pens, f"block string, grp int, runway string, pen {base}")
    got = {r.block: r for r in routes.tail_starts(flown, spark.createDataFrame([(b,) for b in ("near", "apart", "lost")], "block string")).collect()}
    assert (got["near"].x, got["near"].course, got["near"].tail_failure) == (0.0, 10.0, None)
    assert got["apart"].tail_failure == "shared tail start mismatch" and got["lost"].tail_failure == "off radial"


def test_from_text_to_routes(spark):
    text = "Rwy 9, climb heading 090° to 2000. Rwy 27, climb direct QUAVERLY VORTAC.\nRwy 18, climb heading 180° to intercept QVX VORTAC R-090 inbound to QVX VORTAC.\nRwy 36, climb direct NOWHR INT."
    groups, _, unparsed = whole_sections.parse(spark.createDataFrame([("q", text)], "block string, text string"))
    assert unparsed.isEmpty()
    places = spark.createDataFrame([("q", "QVX", "QUAVERLY", -8.0, -6.0)], "block string, ident string, name string, x double, y double")
    bound = routes.bind(groups, places, F.lit(0.0)).withColumn("course", F.col("runways")[0].cast("double") * 10).withColumn("x", F.lit(0.0)).withColumn("y", F.lit(0.0)).withColumn("base_ft", F.lit(500.0)).withColumn("ft_per_nm", F.lit(None).cast("double")).withColumn("to_ft", F.lit(None).cast("double")).withColumn("along", F.lit(1.0))
    got = {r.runways[0]: r.pen for r in routes.fly(bound).collect()}
    assert (got["9"].x, got["9"].y) == pytest.approx((6.5, 0.0)) and got["36"].failure == "unknown place"
    assert (got["27"].x, got["27"].y) == (-8.0, -6.0) and (got["18"].x, got["18"].y, got["18"].course) == (-8.0, -6.0, 270.0)


def test_tails_are_flown_and_ranges_end_routes(spark):
    text = "Rwy 9, climb direct QVX VORTAC thence...\nRwy 27, climb direct QVX VORTAC thence...\n...climb in QVX holding pattern (W, RT, 090° inbound) to 9000 before proceeding on course.\nRwy 18, climb heading between 100° CW to 200° from DER to 3000."
    both = spark.createDataFrame([("q", text.rsplit("\n", 1)[0]), ("r", text.rsplit("\n", 1)[1])], "block string, text string")
    groups, _, unparsed = whole_sections.parse(both)
    assert unparsed.isEmpty()
    places = spark.createDataFrame([("q", "QVX", "QUAVERLY", -3.0, 6.0)], "block string, ident string, name string, x double, y double")
    bound = routes.bind(groups, places, F.lit(0.0)).cache()
    ready = bound.where("not tail").withColumn("runway", F.col("runways")[0]).withColumn("course", F.col("runway").cast("double") * 10)
    for name, value in (("x", 0.0), ("y", 0.0), ("along", 1.0), ("base_ft", 500.0)):
        ready = ready.withColumn(name, F.lit(value))
    flown = routes.fly(ready.withColumn("ft_per_nm", F.lit(None).cast("double")).withColumn("to_ft", F.lit(None).cast("double"))).select("block", "grp", "runway", "pen")
    tail = routes.fly_tails(flown.where("block = 'q'"), bound.where("tail").select("block", "legs")).first()
    assert tail.failure is None and (tail.pen.x, tail.pen.y, tail.pen.course, tail.pen.base_ft) == (-3.0, 6.0, 90.0, 9000.0)
    assert [(w.block, w.runway, w.course) for w in routes.wedges(flown).collect()] == [("r", "18", 180.0)]
