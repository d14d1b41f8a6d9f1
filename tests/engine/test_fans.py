"""Merged sectors, shared wedges, fans and label layout against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from climbout.functions import labels
from climbout.operators import fans, layout
from climbout.operators.routes import RADIUS


def test_sectors_merge_on_the_circle(spark):
    rng = random.Random(4)
    rows = [(i, float(rng.randrange(360)), float(rng.choice([1, 10, 50, 90, 200, 360, -30, -200]))) for i in range(300) for _ in range(rng.randint(1, 5))]
    rows += [(900, 0.0, 0.0), (901, 350.0, 20.0), (901, 10.0, 5.0), (902, 0.0, 180.0), (902, 180.0, 180.0), (903, 340.0, 20.0), (903, 0.0, 20.0)]
    got = {}
    for r in fans.merged_sectors(spark.createDataFrame(rows, "id int, start double, sweep double"), ["id"]).collect():
        got.setdefault(r.id, []).append((r.start, r.sweep))
    for i in {r[0] for r in rows}:
        covered = set()
        for _, start, sweep in (r for r in rows if r[0] == i):
            a, n = (start + sweep, -sweep) if sweep < 0 else (start, sweep)
            covered |= {int(a + d) % 360 for d in range(int(min(n, 360)))}
        mine = {int(s + d) % 360 for s, n in got.get(i, []) for d in range(int(n))}
        assert mine == covered and sum(n for _, n in got.get(i, [])) == len(covered)
        starts = {d for d in covered if (d - 1) % 360 not in covered}
        assert len(got.get(i, [])) == (len(starts) or bool(covered))
    assert got[901] == [(350.0, 25.0)] and got[902] == [(0.0, 360.0)] and got[903] == [(340.0, 40.0)]


def wedge_rows():
    rng = random.Random(6)
    rows = []
    for lid in range(40):
        for seq in range(rng.randint(1, 7)):
            sectors = [(100.0, 50.0)] if rng.random() < 0.7 else [(200.0, -40.0), (20.0, 30.0)]
            rows.append((lid, seq, rng.uniform(0, 2.2), 0.0, sectors, rng.choice(["a", "a", "b"]), [rng.choice(["4L", "4R", "22", "36C", "9", "18"])], rng.choice([90.0, 100.0]), rng.choice([None, "L", "R"])))
    return rows


WEDGES = "lid int, seq int, x double, y double, sectors array<struct<start: double, sweep: double>>, printed string, runways array<string>, course double, side string"


def test_wedges_that_read_alike_are_shared(spark):
    rows = wedge_rows()
    got = {(r.lid, r.seq): r.fan for r in fans.shared_wedges(spark.createDataFrame(rows, WEDGES)).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for lid, wedges in by.items():
        groups = []
        for w in wedges:
            for g in groups:
                if all((o[4], o[5]) == (w[4], w[5]) and abs(o[2] - w[2]) <= 1.5 for o in g):
                    g.append(w)
                    break
            else:
                groups.append([w])
        assert {(lid, w[1]): g[0][1] for g in groups for w in g} == {k: v for k, v in got.items() if k[0] == lid}


def test_fans_reach_their_radius(spark):
    shared = fans.shared_wedges(spark.createDataFrame(wedge_rows(), WEDGES))
    rows = fans.fans(shared).collect()
    for r in rows:
        assert r.radius >= 1.0
        for e in r.edges:
            assert math.hypot(e.tip_x - r.x, e.tip_y - r.y) == pytest.approx(r.radius)
            assert math.hypot(e.x - r.x, e.y - r.y) + 0.3 <= r.radius + 1e-9
            hand = -1 if e.turn < 0 else 1
            way = lambda a: complex(math.sin(math.radians(a)), math.cos(math.radians(a)))
            end = complex(r.x, r.y) + (RADIUS * way(r.course + 90 * hand) + RADIUS * way(e.heading - 90 * hand) if e.turn else 0)
            assert (e.x, e.y) == pytest.approx((end.real, end.imag))
            if r.side:
                assert e.turn * (1 if r.side == "R" else -1) >= 0
    dashes = fans.dashed_arcs(fans.fans(shared)).collect()
    for key in {(d.lid, d.fan, d.sector) for d in dashes}:
        own = sorted((d for d in dashes if (d.lid, d.fan, d.sector) == key), key=lambda d: d.dash)
        fan = next(r for r in rows if (r.lid, r.fan) == key[:2])
        tips = [math.degrees(math.atan2(e.tip_x - fan.x, e.tip_y - fan.y)) % 360 for e in fan.edges]
        ends = (own[0].start, own[-1].start + own[-1].sweep)
        assert all(min(abs((t - e + 180) % 360 - 180) for t in tips) < 1e-6 for e in ends)


def test_a_turn_stays_inside_the_sectors(spark):
    def plain(course, heading, sectors):
        def ok(h):
            for s, n in sectors:
                t = (h - s) % 360 if n > 0 else (s - h) % 360
                if t <= abs(n) + 1e-9 or t > 360 - 1e-9:
                    return True
            return False

        def inside(right):
            by = (heading - course) % 360 if right else -((course - heading) % 360)
            n = max(1, math.ceil(abs(by)))
            return all(ok(course + by * i / n) for i in range(n + 1))

        left, right = inside(False), inside(True)
        return "L" if left and not right else "R" if right and not left else None

    rng = random.Random(3)
    rows = [(i, float(rng.randrange(360)), float(rng.randrange(360)), [(float(rng.randrange(360)), float(rng.choice([90, 200, 300, -250])))]) for i in range(200)]
    frame = spark.createDataFrame(rows, "id int, c double, h double, s array<struct<start: double, sweep: double>>")
    got = {r.id: r.t for r in frame.select("id", fans.turn_within(F.col("c"), F.col("h"), F.col("s")).alias("t")).collect()}
    assert got == {i: plain(c, h, s) for i, c, h, s in rows} and {"L", "R"} <= set(got.values())


def test_labels_are_placed_one_after_another(spark):
    rng = random.Random(7)
    spots = lambda: [(rng.uniform(-2, 2), rng.uniform(-2, 2), rng.uniform(0, 1)) for _ in range(6)]
    rows = [(lid, seq, 0.5, 0.3, spots()) for lid in range(25) for seq in range(4)]
    boxes = [(lid, rng.uniform(-2, 2), rng.uniform(-2, 2), 0.4, 0.2) for lid in range(25) for _ in range(lid % 4)]
    frame = spark.createDataFrame(rows, "lid int, seq int, w double, h double, spots array<struct<x: double, y: double, cost: double>>")
    drawn = spark.createDataFrame(boxes, "lid int, x double, y double, w double, h double")
    lines = spark.createDataFrame([], "lid int, x0 double, y0 double, x1 double, y1 double, weight double")
    got = {(r.lid, r.seq): (r.x, r.y) for r in layout.place(frame, drawn, lines).collect()}
    free = {(r.lid, r.seq): r.x for r in layout.place(frame, drawn, lines, first_free=True).collect()}

    def share(a, b, z):
        return max(0, min(a[0] + z * a[2], b[0] + z * b[2]) - max(a[0] - z * a[2], b[0] - z * b[2])) * max(0, min(a[1] + z * a[3], b[1] + z * b[3]) - max(a[1] - z * a[3], b[1] - z * b[3]))

    for lid in range(25):
        there, open_ = [[b[1:] for b in boxes if b[0] == lid] for _ in "ab"]
        for seq in range(4):
            w, h, own = next(r[2:] for r in rows if r[:2] == (lid, seq))
            cost = lambda p, taken: sum(100 * share((p[0], p[1], w, h), b, 1) + 20 * share((p[0], p[1], w, h), b, 1.6) for b in taken)
            best = min(own, key=lambda p: round(p[2] + cost(p, there), 9))
            assert got[lid, seq] == pytest.approx(best[:2])
            there.append((*best[:2], w, h))
            first = next((p for p in own if cost(p, open_) == 0), None)
            assert free[lid, seq] == (first[0] if first else None)
            if first:
                open_.append((*first[:2], w, h))
    assert None in free.values()


def test_lines_cross_labels(spark):
    frame = spark.createDataFrame([(1, 0, 0.5, 0.3, [(0.0, 0.0, 0.0), (3.0, 0.0, 0.1)])], "lid int, seq int, w double, h double, spots array<struct<x: double, y: double, cost: double>>")
    boxes = spark.createDataFrame([], "lid int, x double, y double, w double, h double")
    line = spark.createDataFrame([(1, -2.0, 0.0, 2.0, 0.0, 4.0)], "lid int, x0 double, y0 double, x1 double, y1 double, weight double")
    assert layout.place(frame, boxes, line).first().x == 3.0 and layout.place(frame, boxes, line.limit(0)).first().x == 0.0


def test_fewest_lines(spark):
    rows = [
        (["35L", "35R"], ["hdg 333° CW 162°"], ["35L/R hdg 333° CW 162°"]),
        (["16L", "16R"], ["hdg 213° CCW 353°", "5000'"], ["16L/R hdg 213° CCW 353°", "5000'"]),
        (["11"], ["hdg 320° CW 220°", "3000'"], ["11 320° CW 220° 3000'"]),
        (["11", "17L", "22"], ["LT hdg 320° CW 220°", "or 010° CW 020°"], ["RWY 11,17L,22", "LT hdg 320° CW 220°", "or 010° CW 020°"]),
        ([], ["hdg 320° CW 220°"], ["ALL RWYS", "hdg 320° CW 220°"]),
        (["1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11"], ["hdg 320° CW 220°", "900'"], ["hdg 320° CW 220° 900'"]),
    ]
    frame = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(rows)], "i int, r array<string>, p array<string>")
    got = {r.i: r.l for r in frame.select("i", labels.fewest_lines(F.col("r"), F.col("p")).alias("l")).collect()}
    for i, r in enumerate(rows):
        lines = got[i]
        assert all(len(x) <= 22 for x in lines) and "".join(r[1]).replace("hdg ", "").replace(" ", "") in "".join(lines).replace("hdg ", "").replace(" ", "")
        assert len(lines) <= len(r[2]), (i, lines)
    assert got[2] == rows[2][2] and got[4] == ["ALL RWYS 320° CW 220°"] and got[5] == rows[5][2] and got[3] == rows[3][2]


def test_blocks_of_lines(spark):
    frame = spark.createDataFrame([(["RWY 4", "hdg 010° CW 020°"],)], "t array<string>")
    r = frame.select(layout.half_size(F.col("t")).alias("half"), layout.lines_at(F.lit(1.0), F.lit(2.0), F.col("t")).alias("at"), layout.beyond(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(90.0), F.lit(0.5), F.lit(0.3)).alias("b"), layout.note_candidates(F.lit(0.0), F.lit(0.0)).alias("n")).first()
    assert (r.half.w, r.half.h) == pytest.approx((16 * 0.16 / 2, 3 * 0.32 / 2)) and [round(x.y, 6) for x in r.at] == [2.16, 1.84]
    assert (r.b.x, r.b.y) == pytest.approx((1.6, 0.0)) and len(r.n) == 7 * 24 and (r.n[0].x, r.n[0].y) == pytest.approx((0.0, -0.5))


def test_labels_of_all_airports_are_placed_side_by_side(spark):
    """The fold runs over Arrow batches, not an expression a label, and drawn boxes do not pass the driver; odd labels keep their rows."""
    spots = "array<struct<x: double, y: double, cost: double>>"
    near, far = (0.0, 0.0, 0.0), (3.0, 0.0, 0.1)
    rows = [(1, 2, 0.5, 0.3, [near, far]), (1, 1, 0.5, 0.3, [near, far]), (2, 1, 0.5, 0.3, []), (2, 2, 0.5, 0.3, None), (2, 3, 0.5, 0.3, [(None, 1.0, 0.0), near]), (2, 4, 0.5, 0.3, [near]), (3, 1, 0.5, 0.3, [far, (9.0, 9.0, None)]), (4, 1, 0.5, 0.3, [far, near])]
    frame = spark.createDataFrame([*rows, *[(i, 1, 0.5, 0.3, [near, far]) for i in range(10, 2010)]], f"lid int, seq int, w double, h double, spots {spots}")
    boxes = spark.createDataFrame([(i, 0.1, 0.0, 0.4, 0.2) for i in range(10, 2010, 2)] + [(5, 0.0, 0.0, 1.0, 1.0)], "lid int, x double, y double, w double, h double")
    lines = spark.createDataFrame([(4, -2.0, 0.0, 2.0, 0.0, 4.0), (4, None, 0.0, 2.0, 0.0, 4.0), (11, -2.0, 0.0, 2.0, 0.0, 4.0)], "lid int, x0 double, y0 double, x1 double, y1 double, weight double")
    placed = layout.place(frame, boxes, lines)
    got = {(r.lid, r.seq): (r.x, r.y, r.cost) for r in placed.collect()}
    want = {(1, 1): near, (1, 2): far, (2, 1): (None, None, None), (2, 2): (None, None, None), (2, 3): (None, 1.0, 0.0), (2, 4): near, (3, 1): (9.0, 9.0, None), (4, 1): (3.0, 0.0, None)}
    want |= {(i, 1): far if i % 2 == 0 or i == 11 else near for i in range(10, 2010)}
    assert got == want
    free = {(r.lid, r.seq): (r.x, r.cost) for r in layout.place(frame, boxes, lines, first_free=True).where("lid < 12").collect()}
    assert free == {(1, 1): (0.0, 0.0), (1, 2): (3.0, 0.1), (2, 1): (None, None), (2, 2): (None, None), (2, 3): (None, 0.0), (2, 4): (0.0, 0.0), (3, 1): (3.0, 0.1), (4, 1): (3.0, 0.1), (10, 1): (3.0, 0.1), (11, 1): (0.0, 0.0)}
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Broadcast" not in plan
