"""Routes on the plane: a fold over a group's legs that carries the pen (position, course, track length)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geodesy

# Default climb, speed and bank, limits of an altitude leg.
GRADIENT, TAS, BANK, STUB_NM = 200.0, 150.0, 25.0, 1.0
LEG_MIN, LEG_MAX = 1.0, 30.0


def trace_headings(routes: DataFrame, variation: float = 0.0) -> DataFrame:
    """End of each route(id, course, base_ft, legs array<struct<heading int, feet int, side string>>) on its plane.

    The pen starts at the runway's end, flies the stub, and for each leg turns onto the (magnetic) heading on the
    printed or the shorter side and then flies straight until the climb from base_ft has reached the altitude.
    failure names the first leg whose altitude is not above the base or that is too long.
    """
    radius = F.lit(max(TAS * TAS / (geodesy.BANK_CONSTANT * 0.4663076581549986), TAS / geodesy.STANDARD_RATE))

    def step(base: Column):
        def run(pen: Column, leg: Column) -> Column:
            target = geodesy.to_true(leg["heading"].cast("double"), F.lit(variation))
            turn = geodesy.signed_turn(pen["course"], target, leg["side"])
            hand = F.when(turn < 0, -1.0).otherwise(1.0)
            cx = pen["x"] + radius * F.sin(F.radians(pen["course"] + 90 * hand))
            cy = pen["y"] + radius * F.cos(F.radians(pen["course"] + 90 * hand))
            tx = cx + radius * F.sin(F.radians(target - 90 * hand))
            ty = cy + radius * F.cos(F.radians(target - 90 * hand))
            flown = pen["along"] + radius * F.radians(F.abs(turn))
            nm = F.greatest(F.lit(LEG_MIN), (leg["feet"] - base) / GRADIENT)
            straight = F.greatest(F.lit(0.0), nm - flown)
            failure = F.coalesce(pen["failure"], F.when(leg["feet"] <= base, "altitude not above current").when(nm > LEG_MAX, "altitude leg capped"))
            return F.struct(
                (tx + straight * F.sin(F.radians(target))).alias("x"), (ty + straight * F.cos(F.radians(target))).alias("y"),
                target.alias("course"), (flown + straight).alias("along"), failure.alias("failure"),
            )

        return run

    start = F.struct(
        (STUB_NM * F.sin(F.radians("course"))).alias("x"), (STUB_NM * F.cos(F.radians("course"))).alias("y"), F.col("course").cast("double").alias("course"),
        F.lit(STUB_NM).alias("along"), F.lit(None).cast("string").alias("failure"),
    )
    pen = F.aggregate("legs", start, step(F.col("base_ft").cast("double")))
    return routes.select("id", pen.alias("pen")).select("id", "pen.*")


# Feet above the departure end where a climb is taken to begin, feet climbed before a turn, NM flown before it at least.
DER_CROSSING_FT, TURN_START_FT, TURN_START_NM = 35.0, 400.0, 1.0


def turn_starts(starts: DataFrame, default_ft_per_nm: float = 200.0) -> DataFrame:
    """starts(der_lat, der_lon, der_elevation_ft, course_true, ft_per_nm, to_ft, ...) with where and how high the first turn may begin.

    ft_per_nm up to to_ft is the published climb, null if there is none.
    """
    base = F.col("der_elevation_ft") + DER_CROSSING_FT
    nm = F.greatest(F.lit(TURN_START_NM), geodesy.climb_nm(base, base + TURN_START_FT, F.col("ft_per_nm").cast("double"), F.col("to_ft").cast("double"), F.lit(default_ft_per_nm)))
    at = geodesy.offset(F.lit(0.0), F.lit(0.0), F.col("course_true"), F.col("turn_nm"))
    rows = starts.withColumn("base_ft", base).withColumn("turn_nm", nm).withColumn("_at", at)
    lat = geodesy.plane_lat(F.col("der_lat"), F.col("_at.y"))
    return rows.withColumn("turn_lat", lat).withColumn("turn_lon", geodesy.plane_lon(F.col("der_lat"), F.col("der_lon"), F.col("_at.x"))).drop("_at")
