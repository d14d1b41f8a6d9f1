"""Queries over leg shapes derived from keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geodesy
from ..operators import shapes
from .queries import query, r6, table

SQL_RADIUS = "greatest(150.0 * 150 / (68626 * tan(radians(25))), 150 / 188.5)"


@query(
    f"""with p as (select p_partkey as id, p_partkey * 11 % 360 as c, (p_partkey * 37 % 200 - 100) / 10.0 as tx, (p_partkey * 53 % 180 - 90) / 10.0 as ty, case when p_partkey % 3 = 0 then 'L' when p_partkey % 3 = 1 then 'R' end as side, {SQL_RADIUS} as r from part),
    b as (select *, degrees(atan2(tx, ty)) - c as raw from p), w as (select *, raw - 360 * floor(raw / 360) as turn0 from b),
    h as (select *, case when side = 'R' then 1.0 when side = 'L' then -1.0 when turn0 > 180 then -1.0 else 1.0 end as hand from w),
    o as (select *, r * sin(radians(c + 90 * hand)) as cx, r * cos(radians(c + 90 * hand)) as cy from h),
    d as (select *, sqrt((tx - cx) * (tx - cx) + (ty - cy) * (ty - cy)) as d from o),
    a as (select *, degrees(atan2(tx - cx, ty - cy)) - hand * degrees(acos(least(r / d, 1.0))) as brg, sqrt(greatest(d * d - r * r, 0.0)) as rest from d),
    t as (select *, hand * (brg - (c - 90 * hand)) as t0, brg + 90 * hand as c0 from a)
    select id, case when d < r then 'fix inside turn circle' when rest < 0.5 then 'fix too close' end as failure,
           case when d >= r then round(r * radians(t0 - 360 * floor(t0 / 360)) + rest, 5) end as nm, case when d >= r then round(sin(radians(c0)), 5) + 0.0 end as east from t"""
)
def direct_legs(spark, sf_dir):
    k = F.col("p_partkey")
    side = F.when(k % 3 == 0, "L").when(k % 3 == 1, "R")
    zero = F.lit(0.0)
    leg = shapes.direct(zero, zero, (k * 11 % 360).cast("double"), (k * 37 % 200 - 100) / 10.0, (k * 53 % 180 - 90) / 10.0, side, geodesy.turn_radius(F.lit(150.0), F.lit(25.0)))
    out = table(spark, sf_dir, "part").select(k.alias("id"), leg.alias("leg"))
    reached = ~F.coalesce(F.col("leg.failure") == "fix inside turn circle", F.lit(False))
    return out.select("id", "leg.failure", F.when(reached, F.round("leg.nm", 5)).alias("nm"), F.when(reached, F.round(F.sin(F.radians("leg.course")), 5) + 0.0).alias("east"))


@query(
    """with p as (select p_partkey as id, p_partkey * 7 % 360 as h, p_partkey * 31 % 360 as q, (p_partkey * 37 % 200 - 100) / 10.0 as nx, (p_partkey * 53 % 180 - 90) / 10.0 as ny from part),
    c as (select *, sin(radians(h)) * cos(radians(q)) - cos(radians(h)) * sin(radians(q)) as x from p),
    t as (select *, (nx * cos(radians(q)) - ny * sin(radians(q))) / x as t, (nx * cos(radians(h)) - ny * sin(radians(h))) / x as s from c)
    select id, case when abs(x) < sin(radians(15)) then 'radial colinear' when t <= 0 or s <= 0 then 'radial intercept behind' end as failure,
           case when abs(x) >= sin(radians(15)) and t > 0 and s > 0 then round(t * sin(radians(h)), 6) + 0.0 end as x, case when abs(x) >= sin(radians(15)) and t > 0 and s > 0 then round(t * cos(radians(h)), 6) + 0.0 end as y from t"""
)
def radial_intercepts(spark, sf_dir):
    k = F.col("p_partkey")
    zero = F.lit(0.0)
    at = shapes.intercept(zero, zero, (k * 7 % 360).cast("double"), (k * 37 % 200 - 100) / 10.0, (k * 53 % 180 - 90) / 10.0, (k * 31 % 360).cast("double"))
    out = table(spark, sf_dir, "part").select(k.alias("id"), at.alias("p"))
    ok = F.col("p.failure").isNull()
    return out.select("id", "p.failure", F.when(ok, r6(F.col("p.x"))).alias("x"), F.when(ok, r6(F.col("p.y"))).alias("y"))


@query(
    """select s_suppkey as id, cast(i as int) as i, round(s_suppkey % 9 + 2 * sin(radians(i * 10)), 6) + 0.0 as ax, round(s_suppkey % 7 + 2 * cos(radians(i * 10)), 6) + 0.0 as ay,
       round(s_suppkey % 9 + 2 * sin(radians(i * 10 + 5)), 6) + 0.0 as bx, round(s_suppkey % 7 + 2 * cos(radians(i * 10 + 5)), 6) + 0.0 as by_ from (select *, unnest(generate_series(0, 35)) as i from supplier)"""
)
def vcoa_circle(spark, sf_dir):
    k = F.col("s_suppkey")
    dashes = shapes.vcoa_dashes((k % 9).cast("double"), (k % 7).cast("double"))
    out = table(spark, sf_dir, "supplier").select(k.alias("id"), F.posexplode(dashes).alias("i", "d"))
    return out.select("id", "i", r6(F.col("d.a.x")).alias("ax"), r6(F.col("d.a.y")).alias("ay"), r6(F.col("d.b.x")).alias("bx"), r6(F.col("d.b.y")).alias("by_"))


@query(
    """select p_partkey, (case p_partkey % 4 when 0 then '≥' when 1 then '≤' when 2 then 'at ' else '' end) || (1000 + p_partkey % 90 * 100) || '''' as plain,
       (1000 + p_partkey % 90 * 100) || (case p_partkey % 4 when 0 then 'A' when 1 then 'B' else '' end) as fms from part"""
)
def altitude_labels(spark, sf_dir):
    k = F.col("p_partkey")
    kind = F.element_at(F.array(F.lit("at or above"), F.lit("at or below"), F.lit("at"), F.lit("to")), (k % 4 + 1).cast("int"))
    feet = 1000 + k % 90 * 100
    return table(spark, sf_dir, "part").select("p_partkey", shapes.altitude_label(feet, kind).alias("plain"), shapes.altitude_label(feet, kind, "fms").alias("fms"))
