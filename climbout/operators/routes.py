"""One pen over all legs of a route: from read groups and bound places to positions, moves and failures.

`bind` gives each leg the places it names as points of the departure's plane (a merge join by block and ident), `fly` folds the legs of a
route: the pen carries position, course, distance flown since the climb's base, that base, whether it holds an open heading, and the first
failure, and each leg adds a move: a turn, a straight line, and for a joined radial a second turn and line.
The fold is one aggregate expression over the array of legs, so a route stays in its row and nothing is shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geodesy
from .traces import BANK, GRADIENT, LEG_MAX, LEG_MIN, TAS

# Least length of a leg, least angle of an intercept, that of one without a heading and its turn at most, convergence
# beside a radial, tolerances on a radial, of one already joined, of an arrival and of a shared tail.
SHORTEST_NM, LEAST_ANGLE, INTERCEPT_ANGLE, MOST_TURN, CONVERGE_ANGLE = 0.5, 15.0, 45.0, 270.0, 20.0
ON_RADIAL_NM, JOINED_DEG, ARRIVED_NM, CONVERGED_NM = 0.5, 3.0, 0.01, 0.5
RADIUS = max(TAS * TAS / (geodesy.BANK_CONSTANT * 0.4663076581549986), TAS / geodesy.STANDARD_RATE)

#: What a leg must bring: x, y of its fix and of its navaid, courses true, `onto` where a radial is to be intercepted.
LEG = "node string, side string, turns boolean, heading double, feet double, fx double, fy double, nx double, ny double, radial double, sense string, dme double, at_navaid boolean, onto boolean, inbound double"
MOVE = "node string, x0 double, y0 double, course0 double, turn1 double, sx double, sy double, course1 double, turn2 double, x double, y double, course double, feet double"
HEADINGS = ("ClimbHeading", "RunwayHeading", "StraightAhead")
RADIALS = ("Radial", "HeadingAndRadial")
STILL = ("Thence", "ProceedOnCourse", "SpeedRestriction", "CrossAt", "HeadingRange")


def bind(groups: DataFrame, places: DataFrame, variation: Column, holds: DataFrame | None = None) -> DataFrame:
    """groups(block, grp, alt, runways, tail, legs) with legs as LEG wants them; places(block, ident, x, y, name) on the block's plane.

    A place is named by its ident, or by its name where the text gives no ident; one that is not in places leaves its coordinates
    null, which `fly` reports.  variation is that of the magnetic courses, in degrees east.  A hold without a place is at the fix that the
    leg before it ends at; one without a course takes that of holds(fix, inbound), the only published one of its fix.
    """
    key = ["block", "grp", "alt"]
    each = groups.select(*key, F.posexplode("legs").alias("seq", "l"))
    flat = each.select(*key, "seq", F.col("l.turns").alias("turns"), F.col("l.side").alias("side"), "l.leg.*")
    order = Window.partitionBy(*key).orderBy("seq")
    nameless = (F.col("node") == "ClimbInHold") & F.col("target").isNull() & F.col("target_name").isNull()
    for c in ("target", "target_name"):
        flat = flat.withColumn(f"_{c}", F.when(nameless, F.lag(c).over(order)).otherwise(F.col(c)))
    flat = flat.drop("target", "target_name").withColumnRenamed("_target", "target").withColumnRenamed("_target_name", "target_name")
    if holds is not None:
        sole = holds.groupBy(F.col("fix").alias("target")).agg(F.when(F.count("*") == 1, F.first("inbound")).alias("_published"))
        flat = flat.join(sole, "target", "left").withColumn("inbound", F.when(F.col("node") == "ClimbInHold", F.coalesce("inbound", "_published")).otherwise(F.col("inbound"))).drop("_published")
    refs = flat.select(*key, "seq", F.explode(F.array(F.struct(F.lit("f").alias("what"), F.col("target").alias("ident"), F.col("target_name").alias("name")), F.struct(F.lit("n").alias("what"), F.col("ident").alias("ident"), F.col("name").alias("name")))).alias("r"))
    refs = refs.select(*key, "seq", "r.*").where("ident is not null or name is not null")
    known = places.select(F.col("block").alias("_block"), F.col("ident").alias("_ident"), F.col("name").alias("_name"), "x", "y")
    by_ident = refs.where("ident is not null").join(known.hint("merge"), (F.col("block") == F.col("_block")) & (F.col("ident") == F.col("_ident")))
    by_name = refs.where("ident is null").join(known.hint("merge"), (F.col("block") == F.col("_block")) & (F.col("name") == F.col("_name")))
    at = by_ident.unionByName(by_name).groupBy(*key, "seq").agg(*[F.max(F.when(F.col("what") == w, F.col(c))).alias(w + c) for w in "fn" for c in "xy"])
    rows = flat.join(at.hint("merge"), [*key, "seq"], "left")
    true = lambda c: geodesy.to_true(F.col(c).cast("double"), variation)
    same = F.coalesce("target", "target_name").eqNullSafe(F.coalesce("ident", "name")) & F.coalesce("target", "target_name").isNotNull()
    onto = (F.col("node") == "Radial") & F.col("turns") & F.col("heading").isNull()
    leg = F.struct(
        F.coalesce("node", F.lit("Turn")).alias("node"), "side", "turns", true("heading").alias("heading"), F.col("feet").cast("double").alias("feet"), "fx", "fy", "nx", "ny",
        true("radial").alias("radial"), "sense", F.col("dme").cast("double").alias("dme"), same.alias("at_navaid"), F.coalesce(onto, F.lit(False)).alias("onto"), true("inbound").alias("inbound"),
    )
    gathered = rows.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", leg.alias("leg")))), lambda s: s["leg"]).alias("legs"))
    return groups.drop("legs").join(gathered.hint("merge"), key)


def fly(routes: DataFrame, radius: float = RADIUS, gradient: float = GRADIENT) -> DataFrame:
    """routes(..., x, y, course, base_ft, ft_per_nm, to_ft, legs) with pen: struct<x, y, course, along, base_ft, open, straight, failure, moves>.

    x, y, course: where the first turn may begin and the runway's course; along is counted from the departure end.
    ft_per_nm up to to_ft is a published climb (null: the default gradient).
    """
    d = lambda c: F.col(c).cast("double")
    start = F.struct(
        d("x").alias("x"), d("y").alias("y"), d("course").alias("course"), (d("along") if "along" in routes.columns else F.lit(1.0)).alias("along"), d("base_ft").alias("base_ft"), F.lit(False).alias("open"),
        F.lit(True).alias("straight"), F.lit(None).cast("string").alias("failure"), F.expr(f"cast(array() as array<struct<{MOVE.replace(' double', ': double').replace(' string', ': string')}>>)").alias("moves"),
    )
    climb = lambda base, feet: geodesy.climb_nm(base, feet, d("ft_per_nm"), d("to_ft"), F.lit(gradient))
    return routes.withColumn("pen", F.aggregate("legs", start, lambda pen, leg: step(pen, leg, d("course"), F.lit(float(radius)), climb)))


def step(pen: Column, leg: Column, runway: Column, r: Column, climb) -> Column:
    """The pen after one leg; a pen with a failure stays as it is."""
    node = leg["node"]
    held = (node == "Radial") & pen["open"] & ~leg["turns"]
    outward = leg["sense"] == "outbound"
    track = F.when(outward, leg["radial"]).otherwise(geodesy.wrap360(leg["radial"] + 180))

    def decide(v: Column) -> Column:
        """Which course to turn onto first, and on which side."""
        p, g = v["p"], v["g"]
        short = geodesy.signed_turn(p["course"], geodesy.course_of(g["fx"] - p["x"], g["fy"] - p["y"]))
        far = F.sqrt(F.pow(g["fx"] - p["x"], 2) + F.pow(g["fy"] - p["y"], 2)) > ARRIVED_NM
        direct = (g["node"] == "Direct") | ((g["node"] == "ClimbInHold") & F.coalesce(far, F.lit(False)))
        hand = F.when(g["side"] == "R", 1.0).when(g["side"] == "L", -1.0).otherwise(F.when(direct & (short < 0), -1.0).otherwise(1.0))
        cx, cy = p["x"] + r * F.sin(F.radians(p["course"] + 90 * hand)), p["y"] + r * F.cos(F.radians(p["course"] + 90 * hand))
        return geodesy.let(choose, p=p, g=g, hand=hand, cx=cx, cy=cy, dx=g["fx"] - cx, dy=g["fy"] - cy, track=track, held=held, direct=direct, astern=F.abs(short) > 90)

    def choose(v: Column) -> Column:
        p, g = v["p"], v["g"]
        reach = F.sqrt(v["dx"] * v["dx"] + v["dy"] * v["dy"])
        tangent = F.degrees(F.atan2(v["dx"], v["dy"])) - v["hand"] * F.degrees(F.acos(F.least(r / reach, F.lit(1.0)))) + 90 * v["hand"]
        centre_abeam = geodesy.across(v["cx"] - g["nx"], v["cy"] - g["ny"], v["track"])
        beside = centre_abeam - v["hand"] * r
        abeam = centre_abeam - v["hand"] * r * F.cos(F.radians(F.lit(INTERCEPT_ANGLE)))
        rolls = g["onto"] & (F.abs(beside) <= ON_RADIAL_NM)
        off = geodesy.wrap360(v["track"] - F.signum(abeam) * INTERCEPT_ANGLE)
        converging = geodesy.wrap360(v["track"] - F.signum(beside) * CONVERGE_ANGLE)
        schematic = F.when(rolls, converging).otherwise(off)
        onto = (
            F.when(g["node"].isin("RunwayHeading", "StraightAhead"), runway).when(v["direct"], geodesy.wrap360(tangent)).when(v["held"] | (g["node"] == "ClimbInHold"), p["course"])
            .when(g["onto"], F.when(rolls, v["track"]).otherwise(off)).when(g["node"] == "Radial", v["track"]).otherwise(g["heading"])
        )
        side = F.when(v["direct"], F.when(v["hand"] > 0, "R").otherwise("L")).otherwise(g["side"])
        to_heading, to_track = geodesy.signed_turn(p["course"], schematic, g["side"]), geodesy.signed_turn(p["course"], v["track"], g["side"])
        behind = g["onto"] & ((F.abs(to_heading - to_track) > INTERCEPT_ANGLE + 1e-6) | (F.abs(to_heading) > MOST_TURN))
        rest = F.sqrt(F.greatest(reach * reach - r * r, F.lit(0.0)))
        failure = (
            F.when(g["node"] == "Direct", F.when(g["fx"].isNull(), "unknown place").when(reach < r, "fix inside turn circle").when(rest < SHORTEST_NM, "leg too short"))
            .when(g["node"].isin(*RADIALS), F.when(g["nx"].isNull(), "unknown place").when(g["sense"].isNull(), "radial sense unstated").when(g["onto"] & g["side"].isNull(), "intercept without a turn").when(behind, "intercept heading behind the turn"))
            .when(g["node"] == "ClimbInHold", F.when(g["fx"].isNull(), "unknown place").when(g["inbound"].isNull(), "hold unspecified").when(v["direct"] & v["astern"], "hold fix behind").when(v["direct"] & (reach < r), "fix inside turn circle").when(v["direct"] & (rest < SHORTEST_NM), "leg too short"))
            .when((g["node"] == "StraightAhead") & (g["turns"] | ~p["straight"]), "unsupported leg")
        )
        turn = geodesy.signed_turn(p["course"], onto, side)
        return geodesy.let(turned, p=p, g=g, track=v["track"], onto=onto, turn=turn, rest=rest, rolls=rolls, held=v["held"], direct=v["direct"], failure=failure)

    def turned(v: Column) -> Column:
        """Behind the first turn: what is flown straight, and where a radial is met."""
        p, g = v["p"], v["g"]
        hand = F.when(v["turn"] < 0, -1.0).otherwise(1.0)
        side = p["course"] + 90 * hand
        tx = p["x"] + r * F.sin(F.radians(side)) + r * F.sin(F.radians(v["onto"] - 90 * hand))
        ty = p["y"] + r * F.cos(F.radians(side)) + r * F.cos(F.radians(v["onto"] - 90 * hand))
        moved = v["turn"] != 0
        return geodesy.let(
            straight, p=p, g=g, track=v["track"], onto=v["onto"], turn=v["turn"], rest=v["rest"], rolls=v["rolls"], held=v["held"], direct=v["direct"], failure=v["failure"],
            x=F.when(moved, tx).otherwise(p["x"]), y=F.when(moved, ty).otherwise(p["y"]), along=p["along"] + r * F.radians(F.abs(v["turn"])),
        )

    def straight(v: Column) -> Column:
        p, g = v["p"], v["g"]
        need = F.greatest(F.lit(LEG_MIN), climb(p["base_ft"], g["feet"]))
        low = F.when(g["feet"] <= p["base_ft"], "altitude not above current").when(need > LEG_MAX, "altitude leg capped")
        # the radial: distance along it and beside it, and the crossing of the heading with it
        out, beside = geodesy.along(v["x"] - g["nx"], v["y"] - g["ny"], g["radial"]), geodesy.across(v["x"] - g["nx"], v["y"] - g["ny"], g["radial"])
        joins = (g["node"] == "HeadingAndRadial") | v["held"] | (g["onto"] & ~v["rolls"])
        angle = F.least(F.abs(geodesy.wrap180(v["onto"] - g["radial"])), F.abs(geodesy.wrap180(v["onto"] - g["radial"] - 180)))
        sine = F.sin(F.radians(g["radial"] - v["onto"]))
        ahead = F.sin(F.radians(g["radial"])) * (g["ny"] - v["y"]) - F.cos(F.radians(g["radial"])) * (g["nx"] - v["x"])
        ahead = ahead / F.nullif(sine, F.lit(0.0))
        back = F.sin(F.radians(v["onto"])) * (g["ny"] - v["y"]) - F.cos(F.radians(v["onto"])) * (g["nx"] - v["x"])
        back = back / F.nullif(sine, F.lit(0.0))
        turn2 = geodesy.signed_turn(v["onto"], v["track"])
        lead = r * F.tan(F.radians(F.abs(turn2)) / 2)
        refused = F.when(angle < LEAST_ANGLE, "radial colinear").when((ahead <= 0) | (back <= 0) | (ahead < lead), "radial intercept behind")
        joined = (g["node"] == "HeadingAndRadial") & refused.isNotNull() & (out >= 0) & (F.abs(beside) <= ON_RADIAL_NM) & (F.degrees(F.atan2(F.abs(beside), out)) <= JOINED_DEG)
        converge = F.abs(beside) / F.tan(F.radians(F.lit(CONVERGE_ANGLE)))
        meets = out + F.when(g["sense"] == "outbound", converge).otherwise(-converge)
        nm = F.when(g["node"].isin(*HEADINGS), F.when(g["feet"].isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), need - v["along"]))).when(v["direct"], v["rest"]).when(joins & ~joined, ahead - lead).otherwise(F.lit(0.0))
        failure = F.coalesce(
            v["failure"], F.when(g["node"].isin(*HEADINGS) & g["feet"].isNotNull(), low), F.when(joins & ~joined, refused), F.when(v["rolls"] & ((out < 0) | (meets < 0)), "off radial"),
            F.when((g["node"] == "Radial") & ~joins & ~v["rolls"] & ((out < 0) | (F.abs(beside) > ON_RADIAL_NM)), "off radial"),
        )
        on_x, on_y = g["nx"] + meets * F.sin(F.radians(g["radial"])), g["ny"] + meets * F.cos(F.radians(g["radial"]))
        sx = F.when(v["rolls"], on_x).when(v["direct"], g["fx"]).otherwise(v["x"] + nm * F.sin(F.radians(v["onto"])))
        sy = F.when(v["rolls"], on_y).when(v["direct"], g["fy"]).otherwise(v["y"] + nm * F.cos(F.radians(v["onto"])))
        flown = F.when(v["rolls"], F.sqrt(F.pow(on_x - v["x"], 2) + F.pow(on_y - v["y"], 2))).otherwise(nm)
        return geodesy.let(tracked, p=p, g=g, track=v["track"], onto=v["onto"], turn=v["turn"], turn2=F.when(g["node"].isin(*RADIALS) & joins, turn2).otherwise(F.lit(0.0)), sx=sx, sy=sy, along=v["along"] + flown, failure=failure, low=low, need=need)

    def tracked(v: Column) -> Column:
        """The second turn and the tracking of the radial to its end."""
        p, g = v["p"], v["g"]
        radial = g["node"].isin(*RADIALS)
        hand = F.when(v["turn2"] < 0, -1.0).otherwise(1.0)
        side = v["onto"] + 90 * hand
        tx = F.when(v["turn2"] != 0, v["sx"] + r * F.sin(F.radians(side)) + r * F.sin(F.radians(v["track"] - 90 * hand))).otherwise(v["sx"])
        ty = F.when(v["turn2"] != 0, v["sy"] + r * F.cos(F.radians(side)) + r * F.cos(F.radians(v["track"] - 90 * hand))).otherwise(v["sy"])
        along = v["along"] + r * F.radians(F.abs(v["turn2"]))
        return geodesy.let(ended, p=p, g=g, track=v["track"], onto=v["onto"], turn=v["turn"], turn2=v["turn2"], sx=v["sx"], sy=v["sy"], tx=tx, ty=ty, along=along, failure=v["failure"], low=v["low"], need=v["need"], radial=radial)

    def ended(v: Column) -> Column:
        p, g = v["p"], v["g"]
        to_fix, to_navaid = geodesy.along(g["fx"] - v["tx"], g["fy"] - v["ty"], v["track"]), geodesy.along(g["nx"] - v["tx"], g["ny"] - v["ty"], v["track"])
        off_fix = F.abs(geodesy.across(g["fx"] - v["tx"], g["fy"] - v["ty"], v["track"]))
        dme_x, dme_y = g["nx"] + g["dme"] * F.sin(F.radians(g["radial"])), g["ny"] + g["dme"] * F.cos(F.radians(g["radial"]))
        to_dme = geodesy.along(dme_x - v["tx"], dme_y - v["ty"], v["track"])
        by_fix, inward = g["fx"].isNotNull() & ~g["at_navaid"], g["sense"] == "inbound"
        at_navaid = g["at_navaid"] | (~by_fix & g["dme"].isNull() & g["feet"].isNull() & inward)
        climbs = ~by_fix & ~g["at_navaid"] & g["dme"].isNull() & g["feet"].isNotNull()
        remaining = F.greatest(F.lit(0.0), v["need"] - v["along"])
        nm = F.when(at_navaid, to_navaid).when(by_fix, to_fix).when(g["dme"].isNotNull(), to_dme).when(climbs, remaining)
        ex = F.when(at_navaid, g["nx"]).when(g["dme"].isNotNull() & ~by_fix, dme_x).otherwise(v["tx"] + nm * F.sin(F.radians(v["track"])))
        ey = F.when(at_navaid, g["ny"]).when(g["dme"].isNotNull() & ~by_fix, dme_y).otherwise(v["ty"] + nm * F.cos(F.radians(v["track"])))
        bad = F.when(nm.isNull(), "unsupported leg").when(by_fix & (off_fix > ON_RADIAL_NM), "off radial").when(~climbs & (nm < SHORTEST_NM), "leg too short").when(climbs & inward & (remaining > to_navaid), "unsupported leg").when(g["feet"].isNotNull(), v["low"])
        crossing = (g["node"] == "CrossAt") & ((F.abs(geodesy.along(g["fx"] - p["x"], g["fy"] - p["y"], p["course"])) > ARRIVED_NM) | (F.abs(geodesy.across(g["fx"] - p["x"], g["fy"] - p["y"], p["course"])) > ON_RADIAL_NM))
        ranged = F.coalesce(F.try_element_at(p["moves"], F.lit(-1))["node"] == "HeadingRange", F.lit(False))
        failure = F.coalesce(p["failure"], F.when(ranged & ~g["node"].isin("ProceedOnCourse", "SpeedRestriction"), "leg after a heading range"), F.when(~g["node"].isin(*STILL), v["failure"]), F.when(v["radial"], bad), F.when(crossing, "crossing off the route"), F.when((g["node"] == "HeadingRange") & (g["feet"] <= p["base_ft"]), "altitude not above current"), F.when(~g["node"].isin(*HEADINGS, *RADIALS, *STILL, "Direct", "ClimbInHold", "Turn"), "unsupported leg"))
        still = g["node"].isin(*STILL, "Turn")
        x, y = F.when(still, p["x"]).when(v["radial"], ex).otherwise(v["sx"]), F.when(still, p["y"]).when(v["radial"], ey).otherwise(v["sy"])
        holds = g["node"] == "ClimbInHold"
        x, y = F.when(holds, g["fx"]).otherwise(x), F.when(holds, g["fy"]).otherwise(y)
        course = F.when(still, p["course"]).when(holds, g["inbound"]).when(v["radial"], v["track"]).otherwise(v["onto"])
        along = F.when(still, p["along"]).when(holds & g["feet"].isNotNull(), 0.0).when(v["radial"], v["along"] + nm).otherwise(v["along"])
        levels = v["radial"] & g["feet"].isNotNull() & ~climbs
        return geodesy.let(settle, p=p, g=g, x=x, y=y, course=geodesy.wrap360(course), along=along, levels=levels, failure=failure, onto=v["onto"], turn=v["turn"], turn2=v["turn2"], sx=v["sx"], sy=v["sy"], still=still)

    def settle(v: Column) -> Column:
        p, g, lost = v["p"], v["g"], v["failure"].isNotNull()
        rises = (g["node"] == "ClimbInHold") & g["feet"].isNotNull()
        level_along = F.least(F.lit(0.0), v["along"] - climb(p["base_ft"], g["feet"]))
        move = F.struct(
            g["node"].alias("node"), p["x"].alias("x0"), p["y"].alias("y0"), p["course"].alias("course0"), v["turn"].alias("turn1"), v["sx"].alias("sx"), v["sy"].alias("sy"), v["onto"].alias("course1"),
            v["turn2"].alias("turn2"), v["x"].alias("x"), v["y"].alias("y"), v["course"].alias("course"), g["feet"].alias("feet"),
        )
        keep = lambda new, old: F.when(lost, old).otherwise(new)
        return F.struct(
            keep(v["x"], p["x"]).alias("x"), keep(v["y"], p["y"]).alias("y"), keep(v["course"], p["course"]).alias("course"),
            keep(F.when(v["levels"], level_along).otherwise(v["along"]), p["along"]).alias("along"), keep(F.when(v["levels"] | rises, g["feet"]).otherwise(p["base_ft"]), p["base_ft"]).alias("base_ft"),
            F.when(g["node"] == "Thence", p["open"]).otherwise(g["node"].isin("ClimbHeading", "RunwayHeading") & g["feet"].isNull()).alias("open"),
            (p["straight"] & (g["node"].isin("RunwayHeading", "StraightAhead") | g["node"].isin(*STILL))).alias("straight"), v["failure"].alias("failure"),
            F.when(lost | (v["still"] & (g["node"] != "HeadingRange")), p["moves"]).otherwise(F.concat(p["moves"], F.array(move))).alias("moves"),
        )

    return geodesy.let(decide, p=pen, g=leg)


def points(moves: Column, radius: float = RADIUS) -> Column:
    """array<struct<x, y>> of the line that the moves draw: both turns as arcs, and the ends of the straight parts."""
    r = F.lit(float(radius))
    arc = lambda m, x, y, c, t: F.when(t != 0, geodesy.turn_arc(x, y, c, t, r)).otherwise(F.array(F.struct(x.alias("x"), y.alias("y"))))
    return F.flatten(F.transform(moves, lambda m: F.concat(arc(m, m["x0"], m["y0"], m["course0"], m["turn1"]), arc(m, m["sx"], m["sy"], m["course1"], m["turn2"]), F.array(F.struct(m["x"].alias("x"), m["y"].alias("y"))))))


def tail_starts(flown: DataFrame, legs: DataFrame) -> DataFrame:
    """Where the shared tail of each block begins: (block, x, y, course, along, base_ft, failure, legs) from routes(block, grp, runway, pen) that enter it.

    The routes must end within CONVERGED_NM of the first one; the tail is flown from there.
    """
    order = Window.partitionBy("block").orderBy("grp", "runway")
    first = flown.withColumn("_n", F.row_number().over(order)).withColumn("_first", F.first("pen").over(order))
    gap = F.sqrt(F.pow(F.col("pen.x") - F.col("_first.x"), 2) + F.pow(F.col("pen.y") - F.col("_first.y"), 2))
    one = first.groupBy("block").agg(F.min_by("pen", "_n").alias("pen"), F.max(gap).alias("_gap"), F.min_by(F.col("pen.failure"), F.when(F.col("pen.failure").isNotNull(), F.col("_n"))).alias("_failure"))
    failure = F.coalesce("_failure", F.when(F.col("_gap") > CONVERGED_NM, "shared tail start mismatch"))
    return one.select("block", *[F.col(f"pen.{c}").alias(c) for c in ("x", "y", "course", "along", "base_ft")], failure.alias("tail_failure")).join(legs.hint("merge"), "block")


def wedges(flown: DataFrame) -> DataFrame:
    """(block, runway, x, y, course) where routes(block, runway, pen) end in a range of headings, for `fans`."""
    last = F.try_element_at("pen.moves", F.lit(-1))
    return flown.where(last["node"] == "HeadingRange").select("block", "runway", F.col("pen.x").alias("x"), F.col("pen.y").alias("y"), F.col("pen.course").alias("course"))


def fly_tails(flown: DataFrame, tails: DataFrame, **limits: float) -> DataFrame:
    """Tails flown from where their routes meet: routes(block, grp, runway, pen) that enter the tail(block, legs) of their block.

    pen carries the failure of the first route that failed, or that the routes end apart.
    """
    starts = tail_starts(flown, tails).withColumn("ft_per_nm", F.lit(None).cast("double")).withColumn("to_ft", F.lit(None).cast("double"))
    rows = fly(starts, **limits)
    return rows.withColumn("failure", F.coalesce("tail_failure", "pen.failure"))
