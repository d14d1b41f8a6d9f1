"""Shapes of single legs on the plane as Column expressions: x east, y north, NM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import geodesy

# Visual-climb circle, dashes, hold timing.
VCOA_NM, VCOA_DASHES = 2.0, 36
HOLD_FT, MINUTE, HIGH_MINUTES = 14000, 1.0, 1.5


def direct(x: Column, y: Column, course: Column, tx: Column, ty: Column, side: Column, radius: Column) -> Column:
    """struct<x, y, course, nm, failure> of a turn and a straight line to a fix.

    The line leaves the turn's circle at the tangent to the fix; the side is the printed one or the shorter way.
    """

    def circle(v: Column) -> Column:
        hand = F.when(v["side"] == "R", 1.0).when(v["side"] == "L", -1.0).otherwise(F.when(v["short"] < 0, -1.0).otherwise(1.0))
        return geodesy.let(centre, x=v["x"], y=v["y"], course=v["course"], tx=v["tx"], ty=v["ty"], r=v["r"], hand=hand)

    def centre(v: Column) -> Column:
        out = F.radians(v["course"] + 90 * v["hand"])
        return geodesy.let(tangent, course=v["course"], hand=v["hand"], r=v["r"], tx=v["tx"], ty=v["ty"], dx=v["tx"] - v["x"] - v["r"] * F.sin(out), dy=v["ty"] - v["y"] - v["r"] * F.cos(out))

    def tangent(v: Column) -> Column:
        d = F.sqrt(v["dx"] * v["dx"] + v["dy"] * v["dy"])
        at = F.degrees(F.atan2(v["dx"], v["dy"])) - v["hand"] * F.degrees(F.acos(F.least(v["r"] / d, F.lit(1.0))))
        rest = F.sqrt(F.greatest(d * d - v["r"] * v["r"], F.lit(0.0)))
        return geodesy.let(leg, v=v, d=d, at=at, rest=rest)

    def leg(w: Column) -> Column:
        v = w["v"]
        turn = F.pmod(v["hand"] * (w["at"] - (v["course"] - 90 * v["hand"])), F.lit(360.0))
        failure = F.when(w["d"] < v["r"], "fix inside turn circle").when(w["rest"] < 0.5, "fix too close")
        return F.struct(v["tx"].alias("x"), v["ty"].alias("y"), geodesy.wrap360(w["at"] + 90 * v["hand"]).alias("course"), (v["r"] * F.radians(turn) + w["rest"]).alias("nm"), failure.alias("failure"))

    short = geodesy.signed_turn(course, F.degrees(F.atan2(tx - x, ty - y)))
    return geodesy.let(circle, x=x, y=y, course=course, tx=tx, ty=ty, r=radius, side=side, short=short)


def intercept(x: Column, y: Column, heading: Column, nx: Column, ny: Column, radial: Column, least_angle: float = 15.0) -> Column:
    """struct<x, y, failure> where a heading from (x, y) crosses the radial that leaves (nx, ny)."""
    ux, uy = F.sin(F.radians(heading)), F.cos(F.radians(heading))
    vx, vy = F.sin(F.radians(radial)), F.cos(F.radians(radial))
    cross = ux * vy - uy * vx
    t = ((nx - x) * vy - (ny - y) * vx) / F.nullif(cross, F.lit(0.0))
    s = ((nx - x) * uy - (ny - y) * ux) / F.nullif(cross, F.lit(0.0))
    failure = F.when(F.abs(cross) < F.sin(F.radians(F.lit(least_angle))), "radial colinear").when((t <= 0) | (s <= 0), "radial intercept behind")
    return F.struct((x + t * ux).alias("x"), (y + t * uy).alias("y"), failure.alias("failure"))


def hold_leg_nm(feet: Column, speed_kt: Column, dme_nm: Column) -> Column:
    """Length of a hold's straight legs: printed, or a minute's flight, longer above the high level."""
    return F.coalesce(dme_nm, speed_kt / 60 * F.when(feet > HOLD_FT, HIGH_MINUTES).otherwise(MINUTE))


def racetrack(x: Column, y: Column, inbound: Column, side: Column, length: Column, radius: Column) -> Column:
    """array<struct<x, y>> of a closed racetrack: turn at the fix, outbound leg, turn, inbound leg."""
    hand = F.when(side == "L", -1.0).otherwise(1.0)
    near = geodesy.turn_arc(x, y, inbound, 180 * hand, radius)
    ex = x + 2 * radius * F.sin(F.radians(inbound + 90 * hand)) - length * F.sin(F.radians(inbound))
    ey = y + 2 * radius * F.cos(F.radians(inbound + 90 * hand)) - length * F.cos(F.radians(inbound))
    return F.concat(near, geodesy.turn_arc(ex, ey, inbound + 180, 180 * hand, radius), F.array(F.struct(x.alias("x"), y.alias("y"))))


def vcoa_dashes(x: Column, y: Column, radius: float = VCOA_NM) -> Column:
    """array<struct<a, b>>: the circle of a visual climb as dashes, each half its share of the circle."""
    step = 360.0 / VCOA_DASHES
    return F.transform(F.sequence(F.lit(0), F.lit(VCOA_DASHES - 1)), lambda i: F.struct(geodesy.offset(x, y, i * step, F.lit(radius)).alias("a"), geodesy.offset(x, y, i * step + step / 2, F.lit(radius)).alias("b")))


def altitude_label(feet: Column, kind: Column, style: str = "plain") -> Column:
    """7000', ≥7000', ≤7000', at 7000'; in the fms style 7000A, 7000B, 7000."""
    if style == "fms":
        return F.concat(feet.cast("string"), F.when(kind == "at or above", "A").when(kind == "at or below", "B").otherwise(""))
    return F.concat(F.when(kind == "at or above", "≥").when(kind == "at or below", "≤").when(kind == "at", "at ").otherwise(""), feet.cast("string"), F.lit("'"))
