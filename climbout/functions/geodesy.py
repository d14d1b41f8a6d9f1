"""Spherical and plane geometry as Column expressions; distances in NM, angles in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_NM, FEET_PER_NM, DEGREE_NM = 3440.065, 6076.11549, 60.0
BANK_CONSTANT, STANDARD_RATE = 68626.0, 188.5


def let(f, **values: Column) -> Column:
    """f(struct of the values), each computed once however often f names it."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), f)[0]


def wrap360(deg: Column) -> Column:
    return F.pmod(deg, F.lit(360.0))


def wrap180(deg: Column) -> Column:
    """Into (-180, 180]."""
    turned = F.pmod(deg, F.lit(360.0))
    return F.when(turned > 180, turned - 360).otherwise(turned)


def distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by haversines."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_NM) * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """True bearing at the start."""
    p1, p2, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    return wrap360(F.degrees(F.atan2(F.sin(d) * F.cos(p2), F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(d))))


def destination(lat: Column, lon: Column, course: Column, nm: Column) -> Column:
    """struct<lat, lon> reached on a great circle."""
    p, t, d = F.radians(lat), F.radians(course), nm / EARTH_NM
    to = F.asin(F.sin(p) * F.cos(d) + F.cos(p) * F.sin(d) * F.cos(t))
    east = F.atan2(F.sin(t) * F.sin(d) * F.cos(p), F.cos(d) - F.sin(p) * F.sin(to))
    return F.struct(F.degrees(to).alias("lat"), wrap180(lon + F.degrees(east)).alias("lon"))


def to_true(magnetic: Column, variation_east: Column) -> Column:
    return wrap360(magnetic + variation_east)


def to_magnetic(true: Column, variation_east: Column) -> Column:
    return wrap360(true - variation_east)


def unit(course: Column) -> Column:
    """struct<x, y> of length one on a course."""
    return F.struct(F.sin(F.radians(course)).alias("x"), F.cos(F.radians(course)).alias("y"))


def course_of(x: Column, y: Column) -> Column:
    return wrap360(F.degrees(F.atan2(x, y)))


def plane_x(lat0: Column, lon0: Column, lon: Column) -> Column:
    """East of the origin on the local tangent plane."""
    return wrap180(lon - lon0) * DEGREE_NM * F.cos(F.radians(lat0))


def plane_y(lat0: Column, lat: Column) -> Column:
    return (lat - lat0) * DEGREE_NM


def plane_lat(lat0: Column, y: Column) -> Column:
    return lat0 + y / DEGREE_NM


def plane_lon(lat0: Column, lon0: Column, x: Column) -> Column:
    return wrap180(lon0 + x / (F.cos(F.radians(lat0)) * DEGREE_NM))


def offset(x: Column, y: Column, course: Column, nm: Column) -> Column:
    """struct<x, y> nm away on a course."""
    return F.struct((x + nm * F.sin(F.radians(course))).alias("x"), (y + nm * F.cos(F.radians(course))).alias("y"))


def along(x: Column, y: Column, course: Column) -> Column:
    return x * F.sin(F.radians(course)) + y * F.cos(F.radians(course))


def across(x: Column, y: Column, course: Column) -> Column:
    """Right of the course is positive."""
    return x * F.cos(F.radians(course)) - y * F.sin(F.radians(course))


def turn_radius(tas_kt: Column, bank_deg: Column) -> Column:
    """The larger of the bank's and the standard rate's radius."""
    return F.greatest(tas_kt * tas_kt / (F.lit(BANK_CONSTANT) * F.tan(F.radians(bank_deg))), tas_kt / STANDARD_RATE)


def signed_turn(course: Column, target: Column, side: Column | None = None) -> Column:
    """Degrees to turn, right positive; side 'L' or 'R' forces the way round."""
    right = wrap360(target - course)
    shorter = F.when(right > 180, right - 360).otherwise(right)
    return shorter if side is None else F.when(side == "R", right).when(side == "L", F.when(right > 0, right - 360).otherwise(F.lit(0.0))).otherwise(shorter)


def turn_arc(x: Column, y: Column, course: Column, turn: Column, radius: Column, step: float = 5.0) -> Column:
    """array<struct<x, y>> of points on a turn, at most `step` degrees apart, both ends included."""
    side = F.when(turn < 0, -1.0).otherwise(1.0)
    cx = x + radius * F.sin(F.radians(course + 90 * side))
    cy = y + radius * F.cos(F.radians(course + 90 * side))
    n = F.greatest(F.ceil(F.abs(turn) / step), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), n), lambda i: offset(cx, cy, course - 90 * side + turn * i / n, radius))


def climb_nm(from_ft: Column, to_ft: Column, ft_per_nm: Column, ceiling_ft: Column, default_ft_per_nm: Column) -> Column:
    """Distance of a climb at the published gradient up to its ceiling and at the default one above."""
    g = F.coalesce(ft_per_nm, default_ft_per_nm)
    top = F.coalesce(ceiling_ft, F.lit(1e9))
    low = F.greatest(F.least(to_ft, top) - from_ft, F.lit(0.0))
    high = F.greatest(to_ft - F.greatest(from_ft, top), F.lit(0.0))
    return low / g + high / default_ft_per_nm


def box_overlap(ax0, ay0, ax1, ay1, bx0, by0, bx1, by1) -> Column:
    """Area that two boxes share."""
    return F.greatest(F.least(ax1, bx1) - F.greatest(ax0, bx0), F.lit(0.0)) * F.greatest(F.least(ay1, by1) - F.greatest(ay0, by0), F.lit(0.0))


def clipped_length(x0, y0, x1, y1, bx0, by0, bx1, by1) -> Column:
    """Length of a segment inside a box: the overlap of the parameter intervals of both axes."""
    dx, dy = x1 - x0, y1 - y0

    def interval(p, d, lo, hi):
        enter = F.when(d == 0, F.when((p >= lo) & (p <= hi), 0.0).otherwise(2.0)).otherwise(F.least((lo - p) / d, (hi - p) / d))
        leave = F.when(d == 0, F.when((p >= lo) & (p <= hi), 1.0).otherwise(-1.0)).otherwise(F.greatest((lo - p) / d, (hi - p) / d))
        return enter, leave

    (ex, lx), (ey, ly) = interval(x0, dx, bx0, bx1), interval(y0, dy, by0, by1)
    share = F.least(lx, ly, F.lit(1.0)) - F.greatest(ex, ey, F.lit(0.0))
    return F.greatest(share, F.lit(0.0)) * F.sqrt(dx * dx + dy * dy)
