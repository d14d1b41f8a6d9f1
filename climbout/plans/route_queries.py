"""From section texts to flown routes: read, bound to places and flown by one pen; the SQL has the closed forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import routes, whole_sections
from .queries import query, r6, spread, table, text

_RADIUS = "(select greatest(150.0 * 150 / (68626 * tan(radians(25))), 150 / 188.5))"


def texts(spark, sf_dir) -> DataFrame:
    """A section for every part: two runways, a heading to an altitude, a turn to a navaid or a heading to a radial."""
    k = F.col("p_partkey")
    deg = lambda c: F.lpad((c % 360).cast("string"), 3, "0")
    side = F.when(k % 2 == 0, "left").otherwise("right")
    one = text("Rwy 9, climb heading ", deg(k * 29), "° to ", 1800 + k % 40 * 100, " before proceeding on course.")
    two = text("Rwy 27, climbing ", side, " turn direct ABC VORTAC.")
    three = text("Rwy 27, climb heading ", deg(k * 7), "° to intercept QUAVERLY (QVX) VOR/DME R-", deg(k * 13), " outbound to ", 3000 + k % 30 * 100, ".")
    return spread(table(spark, sf_dir, "part").select("p_partkey")).select(k.alias("block"), text(one, F.lit("\n"), F.when(k % 3 == 0, two).otherwise(three)).alias("text"))


def flown(spark, sf_dir) -> DataFrame:
    groups, _, _ = whole_sections.parse(texts(spark, sf_dir))
    k = F.col("p_partkey")
    spots = table(spark, sf_dir, "part").select(
        k.alias("block"),
        F.explode(F.array(
            F.struct(F.lit("ABC").alias("ident"), F.lit("ABLE").alias("name"), (k % 17 - 8.5).cast("double").alias("x"), (k % 13 - 6.5).cast("double").alias("y")),
            F.struct(F.lit("QVX").alias("ident"), F.lit("QUAVERLY").alias("name"), (k % 11 - 5.0).cast("double").alias("x"), (k % 7 - 3.0).cast("double").alias("y")),
        )).alias("p"),
    ).select("block", "p.*")
    bound = routes.bind(groups, spots, F.lit(0.0))
    course = F.col("runways")[0].cast("int") * 10
    starts = bound.withColumn("course", course).withColumn("x", F.sin(F.radians(course))).withColumn("y", F.cos(F.radians(course))).withColumn("along", F.lit(1.0)).withColumn("base_ft", F.lit(535.0))
    return routes.fly(starts.withColumn("ft_per_nm", F.when(F.col("block") % 5 == 0, 320.0)).withColumn("to_ft", F.when(F.col("block") % 5 == 0, 2500.0)))


@query(
    f"""with p as (select p_partkey as k, {_RADIUS} as r from part),
    legs as (select k, r, '9' as rwy, 90.0 as c, 'H' as kind, cast(k * 29 % 360 as double) as h, 1800 + k % 40 * 100.0 as feet, null::double as rad, null as side from p
      union all select k, r, '27', 270.0, 'D', null, null, null, case when k % 2 = 0 then -1.0 else 1.0 end from p where k % 3 = 0
      union all select k, r, '27', 270.0, 'R', k * 7 % 360, 3000 + k % 30 * 100.0, k * 13 % 360, null from p where k % 3 <> 0),
    s as (select *, sin(radians(c)) as x0, cos(radians(c)) as y0, k % 17 - 8.5 as ax, k % 13 - 6.5 as ay, k % 11 - 5.0 as qx, k % 7 - 3.0 as qy,
      greatest(1.0, case when k % 5 = 0 then greatest(least(feet, 2500) - 535, 0) / 320 + greatest(feet - 2500, 0) / 200 else (feet - 535) / 200 end) as need from legs),
    d as (select *, ax - x0 - r * sin(radians(c + 90 * side)) as dx, ay - y0 - r * cos(radians(c + 90 * side)) as dy from s),
    t as (select *, sqrt(dx * dx + dy * dy) as reach, case when kind = 'D' then degrees(atan2(dx, dy)) - side * degrees(acos(least(1.0, r / sqrt(dx * dx + dy * dy)))) + 90 * side else h end as goal from d),
    g as (select *, ((goal % 360) + 360) % 360 as onto from t),
    q as (select *, (onto - c + 720) % 360 as rt from g),
    u as (select *, case when kind = 'D' then (case when side > 0 then rt when rt > 0 then rt - 360 else 0 end) when rt > 180 then rt - 360 else rt end as turn from q),
    v as (select *, case when turn < 0 then -1.0 else 1.0 end as hand, 1 + r * radians(abs(turn)) as flown1 from u),
    w as (select *, case when turn = 0 then x0 else x0 + r * sin(radians(c + 90 * hand)) + r * sin(radians(onto - 90 * hand)) end as x1,
      case when turn = 0 then y0 else y0 + r * cos(radians(c + 90 * hand)) + r * cos(radians(onto - 90 * hand)) end as y1 from v),
    i as (select *, least(abs((onto - rad + 540) % 360 - 180), abs((onto - rad + 360) % 360 - 180)) as angle, nullif(sin(radians(onto - rad)), 0) as sine,
      (x1 - qx) * sin(radians(rad)) + (y1 - qy) * cos(radians(rad)) as out, (x1 - qx) * cos(radians(rad)) - (y1 - qy) * sin(radians(rad)) as beside,
      case when (rad - onto + 720) % 360 > 180 then (rad - onto + 720) % 360 - 360 else (rad - onto + 720) % 360 end as turn2 from w),
    j as (select *, ((qx - x1) * cos(radians(rad)) - (qy - y1) * sin(radians(rad))) / sine as ahead, ((qx - x1) * cos(radians(onto)) - (qy - y1) * sin(radians(onto))) / sine as back, r * tan(radians(abs(turn2)) / 2) as lead from i),
    l as (select *, case when angle < 15 then 'radial colinear' when ahead <= 0 or back <= 0 or ahead < lead then 'radial intercept behind' end as refused from j),
    m as (select *, refused is not null and out >= 0 and abs(beside) <= 0.5 and degrees(atan2(abs(beside), out)) <= 3 as joined from l),
    n as (select *, case when joined then 0.0 else ahead - lead end as go, case when turn2 < 0 then -1.0 else 1.0 end as hand2 from m),
    o as (select *, flown1 + go + r * radians(abs(turn2)) as flown2, x1 + go * sin(radians(onto)) + r * sin(radians(onto + 90 * hand2)) + r * sin(radians(rad - 90 * hand2)) as x2,
      y1 + go * cos(radians(onto)) + r * cos(radians(onto + 90 * hand2)) + r * cos(radians(rad - 90 * hand2)) as y2 from n),
    e as (select k, rwy, kind,
      case kind when 'H' then x1 + greatest(0, need - flown1) * sin(radians(onto)) when 'D' then ax else x2 + greatest(0, need - flown2) * sin(radians(rad)) end as x,
      case kind when 'H' then y1 + greatest(0, need - flown1) * cos(radians(onto)) when 'D' then ay else y2 + greatest(0, need - flown2) * cos(radians(rad)) end as y,
      case kind when 'H' then greatest(need, flown1) when 'D' then flown1 + sqrt(greatest(0, reach * reach - r * r)) else greatest(need, flown2) end as along,
      case kind when 'H' then case when need > 30 then 'altitude leg capped' end
        when 'D' then case when reach < r then 'fix inside turn circle' when sqrt(greatest(0, reach * reach - r * r)) < 0.5 then 'leg too short' end
        else case when refused is not null and not joined then refused when need > 30 then 'altitude leg capped' end end as failure from o)
    select k as block, rwy as runway, failure, case when failure is null then round(x, 6) + 0.0 end as x, case when failure is null then round(y, 6) + 0.0 end as y, case when failure is null then round(along, 6) + 0.0 end as along from e"""
)
def section_routes(spark, sf_dir):
    """Texts to route ends: straight and turning headings, tangents to navaids, headings onto radials, climbs at published gradients."""
    rows = flown(spark, sf_dir)
    ok = lambda c: F.when(F.col("pen.failure").isNull(), r6(F.col(c)))
    return rows.select("block", F.col("runways")[0].alias("runway"), F.col("pen.failure").alias("failure"), ok("pen.x").alias("x"), ok("pen.y").alias("y"), ok("pen.along").alias("along"))


@query(
    f"""with s as (select s_suppkey as k, {_RADIUS} as r, s_suppkey % 17 - 8.5 as ax, s_suppkey % 13 - 6.5 as ay, 7000 + s_suppkey % 20 * 100.0 as feet from supplier),
    l as (select *, '9' as rwy, 90.0 as c, null::double as side from s union all select *, '27', 270.0, -1.0 from s),
    d as (select *, sin(radians(c)) as x0, cos(radians(c)) as y0, ((degrees(atan2(ax - sin(radians(c)), ay - cos(radians(c)))) - c) % 360 + 360) % 360 as off from l),
    h as (select *, coalesce(side, case when off > 180 then -1.0 else 1.0 end) as hand from d),
    t as (select *, sqrt(pow(ax - x0 - r * sin(radians(c + 90 * hand)), 2) + pow(ay - y0 - r * cos(radians(c + 90 * hand)), 2)) as reach from h),
    f as (select k, rwy, ax, ay, feet, case when reach < r then 'fix inside turn circle' when sqrt(reach * reach - r * r) < 0.5 then 'leg too short' end as failure from t),
    b as (select k, any_value(ax) as ax, any_value(ay) as ay, any_value(feet) as feet, coalesce(min(case when rwy = '9' then failure end), min(case when rwy = '27' then failure end)) as failure from f group by k)
    select k as block, failure, case when failure is null then ax + 0.0 end as x, case when failure is null then ay + 0.0 end as y, case when failure is null then 236.0::double end as course, case when failure is null then feet::double end as base_ft from b"""
)
def section_tails(spark, sf_dir):
    """Shared tails of whole sections: both runways fly to a navaid and go on in its hold from there."""
    k = F.col("s_suppkey")
    said = text(
        "Rwy 9, climb direct ABC VORTAC thence...\nRwy 27, climbing left turn direct ABC VORTAC thence...\n...climb in ABC holding pattern (NE, RT, 236° inbound) to ", 7000 + k % 20 * 100,
        " before proceeding on course.",
    )
    groups, _, _ = whole_sections.parse(table(spark, sf_dir, "supplier").select(k.alias("block"), said.alias("text")))
    spots = table(spark, sf_dir, "supplier").select(k.alias("block"), F.lit("ABC").alias("ident"), F.lit("ABLE").alias("name"), (k % 17 - 8.5).cast("double").alias("x"), (k % 13 - 6.5).cast("double").alias("y"))
    bound = routes.bind(groups, spots, F.lit(0.0))
    runway = F.col("runways")[0]
    starts = bound.where("not tail").withColumn("runway", runway).withColumn("course", runway.cast("int") * 10).withColumn("x", F.sin(F.radians("course"))).withColumn("y", F.cos(F.radians("course")))
    starts = starts.withColumn("along", F.lit(1.0)).withColumn("base_ft", F.lit(535.0)).withColumn("ft_per_nm", F.lit(None).cast("double")).withColumn("to_ft", F.lit(None).cast("double"))
    tails = routes.fly_tails(routes.fly(starts).select("block", "grp", "runway", "pen"), bound.where("tail").select("block", "legs"))
    ok = lambda c: F.when(F.col("failure").isNull(), r6(F.col(c)))
    return tails.select("block", "failure", *[ok(f"pen.{c}").alias(c) for c in ("x", "y", "course", "base_ft")])
