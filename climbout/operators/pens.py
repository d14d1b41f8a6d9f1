"""Ends, dashes, arrowheads and shared tails of routes on the plane: x east, y north, NM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geodesy

# On-course stub, arrowhead, shared tail, radials and their senses.
STUB_DASHES, STUB_NM, DASH_NM, BEND_DEG = 4, 1.0, 0.15, 45.0
DASH_SPACING_NM = (STUB_NM - DASH_NM) / (STUB_DASHES - 1)
ARM_NM, SETBACK_NM, SPLAY_DEG = 0.25, 0.5, 30.0
MEETING_NM, ON_RADIAL_NM, ON_TRACK_DEG = 0.5, 0.5, 1.0
LEAST_LEG_NM, SENSE_DEG = 0.5, 60.0
TAIL_MISMATCH = "shared tail start mismatch"
UNSTATED_SENSE = 'radial without "inbound" or "outbound"'


def hand(side: Column) -> Column:
    """1 to the right, -1 to the left, 0 for no side."""
    return F.when(side == "R", 1.0).when(side == "L", -1.0).otherwise(0.0)


def on_course(x: Column, y: Column, course: Column, side: Column) -> Column:
    """array<struct<a, b>>: the dashes that end a route on course, bent to the side that the text names."""

    def dashes(v: Column) -> Column:
        def one(i: Column) -> Column:
            at = lambda nm: geodesy.offset(v["x"], v["y"], v["course"], nm)
            return F.struct(at(i * DASH_SPACING_NM).alias("a"), at(i * DASH_SPACING_NM + DASH_NM).alias("b"))

        return F.transform(F.sequence(F.lit(0), F.lit(STUB_DASHES - 1)), one)

    return geodesy.let(dashes, x=x, y=y, course=course + BEND_DEG * hand(side))


def dashed_turn(x: Column, y: Column, course: Column, target: Column, side: Column, radius: Column) -> Column:
    """array<struct<from_deg, to_deg, a, b>>: dashes along the turn onto a course, the last one cut at its end; none if there is no turn."""

    def dashes(v: Column) -> Column:
        way = F.when(v["sweep"] < 0, -1.0).otherwise(1.0)
        cx, cy = v["x"] + v["r"] * F.sin(F.radians(v["course"] + 90 * way)), v["y"] + v["r"] * F.cos(F.radians(v["course"] + 90 * way))
        whole, spacing = F.abs(v["sweep"]), F.degrees(DASH_SPACING_NM / v["r"])

        def one(i: Column) -> Column:
            end = F.least(i * spacing + F.degrees(DASH_NM / v["r"]), whole)
            on = lambda deg: geodesy.offset(cx, cy, v["course"] + way * (deg - 90), v["r"])
            return F.struct((i * spacing).alias("from_deg"), end.alias("to_deg"), on(i * spacing).alias("a"), on(end).alias("b"))

        n = F.ceil(whole / spacing).cast("int")
        return F.transform(F.slice(F.sequence(F.lit(0), n), F.lit(1), n), one)

    return geodesy.let(dashes, x=x, y=y, course=course, r=radius, sweep=geodesy.signed_turn(course, target, side))


def arrowhead(x: Column, y: Column, course: Column, last: Column) -> Column:
    """struct<left, tip, right> of an arrowhead; that of a route's last segment points at its end, others stop short of it."""

    def arms(v: Column) -> Column:
        arm = lambda deg: geodesy.offset(v["tip"]["x"], v["tip"]["y"], v["course"] + 180 + deg, F.lit(ARM_NM))
        return F.struct(arm(-SPLAY_DEG).alias("left"), v["tip"].alias("tip"), arm(SPLAY_DEG).alias("right"))

    tip = geodesy.offset(x, y, course + 180, F.when(last, 0.0).otherwise(SETBACK_NM))
    return geodesy.let(arms, tip=tip, course=course)


def flown_outbound(printed: Column, starts_nm: Column, ends_nm: Column, course: Column, radial: Column, side: Column) -> Column:
    """Whether a radial is flown outbound: as printed, else toward its end, else as the aircraft turns onto it; null if none of these tells.

    starts_nm and ends_nm are distances along the radial where it is joined and left; ends_nm is null for a radial
    flown to an altitude.  An end close to the join tells nothing.  A turn without a side goes to the track less
    than 60 degrees off; a turn with a side must pass 60 degrees and stop short of 120.
    """
    apart = F.when(F.abs(ends_nm - starts_nm) >= LEAST_LEG_NM, ends_nm > starts_nm)

    def reached(track: Column) -> Column:
        turn = F.abs(geodesy.signed_turn(course, track, side))
        return F.when(side.isNull(), turn <= SENSE_DEG).otherwise(turn.between(SENSE_DEG, 180 - SENSE_DEG))

    turned = F.when(reached(radial), True).when(reached(radial + 180), False)
    return F.coalesce(printed, F.when(ends_nm.isNotNull(), apart).otherwise(turned))


def tail_starts(pens: DataFrame) -> DataFrame:
    """(block, name, x, y, gap_nm, failure) where the shared tail of pens(block, seq, name, x, y) starts: the first pen's end.

    It fails if another pen ends too far from there; gap_nm is the widest gap.  Of pens with one seq the first by name, x and y.
    """
    first = pens.groupBy("block").agg(F.min(F.struct("seq", "name", "x", "y")).alias("first"))
    gap = F.sqrt(F.pow(F.col("x") - F.col("first.x"), 2) + F.pow(F.col("y") - F.col("first.y"), 2))
    widest = pens.join(first, "block").groupBy("block").agg(F.first("first").alias("first"), F.max(gap).alias("gap_nm"))
    return widest.select("block", "first.name", "first.x", "first.y", "gap_nm", F.when(F.col("gap_nm") > MEETING_NM, TAIL_MISMATCH).alias("failure"))


def radial_starts(pens: DataFrame, radials: DataFrame) -> DataFrame:
    """(block, seq, along_nm) of the pen that joined the tail's radial farthest back, for blocks whose pens all track it.

    pens(block, seq, x, y, course), radials(block, nx, ny, radial, outbound) in true degrees.  Of equal pens the first.
    """
    dx, dy = F.col("x") - F.col("nx"), F.col("y") - F.col("ny")
    track = F.when(F.col("outbound"), F.col("radial")).otherwise(F.col("radial") + 180)
    off = F.abs(geodesy.wrap180(F.col("course") - track))
    placed = pens.join(radials, "block").withColumn("along_nm", geodesy.along(dx, dy, F.col("radial")))
    on = (F.col("along_nm") >= 0) & (F.abs(geodesy.across(dx, dy, F.col("radial"))) <= ON_RADIAL_NM) & (off <= ON_TRACK_DEG)
    back = F.when(F.col("outbound"), F.col("along_nm")).otherwise(-F.col("along_nm"))
    best = placed.groupBy("block").agg(F.bool_and(F.coalesce(on, F.lit(False))).alias("all_on"), F.min_by(F.struct("seq", "along_nm"), F.struct(back.alias("back"), F.col("seq"))).alias("best"))
    return best.where("all_on").select("block", "best.*")
