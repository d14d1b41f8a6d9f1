"""Queries over procedure texts generated from keys; the SQL states what they must be read as."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import procedures, traces
from ..sources.sinks import written
from .queries import query, r6, spread, table, text


def departures(spark, sf_dir) -> DataFrame:
    """One block per order: two or three runways, a shared tail for some, a misread word for others."""
    k = F.col("o_orderkey")
    deg = lambda c: F.lpad((c % 360).cast("string"), 3, "0")
    side = F.when(k % 2 == 0, "left").otherwise("right")
    one = text("Rwy 4, climb on heading ", deg(k), "° to ", 2000 + k % 60 * 100, F.when(k % 11 == 0, " upward").otherwise(""), " before turning ", side, ".")
    two = text("Rwys 22, 35L/R, climbing ", side, " turn heading ", deg(k * 7), "° and ABC VORTAC R-", deg(k * 3), " outbound to ", 5000 + k % 40 * 100, F.when(k % 3 == 0, " thence...").otherwise(" before proceeding on course."))
    tail = F.when(k % 3 == 0, text("\n...continue climb in XYZ holding pattern (NE, RT, ", deg(k * 5), "° inbound) to cross XYZ VORTAC at or above ", 9000 + k % 9 * 100, " before proceeding on course.")).otherwise("")
    loose = F.when(k % 13 == 0, "\nAll aircraft whistle.").otherwise("")
    return spread(table(spark, sf_dir, "orders").select("o_orderkey")).select(k.alias("block"), F.concat(one, F.lit("\n"), two, tail, loose).alias("text"))


@query(
    """with o as (select o_orderkey as k from orders where o_orderkey % 13 <> 0)
    select k as block, 0 as line, '4' as runways, 'ClimbHeading,ProceedOnCourse' as nodes, cast(k % 360 as int) as heading, null::int as radial, cast(2000 + k % 60 * 100 as int) as feet, null as side from o where k % 11 <> 0
    union all select k, 1, '22,35L,35R', 'HeadingAndRadial,' || case when k % 3 = 0 then 'Thence' else 'ProceedOnCourse' end, cast(k * 7 % 360 as int), cast(k * 3 % 360 as int), cast(5000 + k % 40 * 100 as int), case when k % 2 = 0 then 'L' else 'R' end from o
    union all select k, 2, '', 'ClimbInHold,ProceedOnCourse', null, null, cast(9000 + k % 9 * 100 as int), null from o where k % 3 = 0"""
)
def parse_procedures(spark, sf_dir):
    read, _ = procedures.parse(departures(spark, sf_dir), check_holds=False)
    first = F.col("legs")[0]
    nodes = F.array_join(F.transform("legs", lambda x: x["leg"]["node"]), ",")
    return read.select("block", "line", F.array_join("runways", ",").alias("runways"), nodes.alias("nodes"), first["leg"]["heading"].alias("heading"), first["leg"]["radial"].alias("radial"), first["leg"]["feet"].alias("feet"), first["side"].alias("side"))


@query(
    """select o_orderkey as block, 0 as line, 'unmatched phrase "climb on heading <n>° to <n> upward"' as signature from orders where o_orderkey % 11 = 0
    union all select o_orderkey, case when o_orderkey % 3 = 0 then 3 else 2 end, 'unmatched phrase "all aircraft whistle"' from orders where o_orderkey % 13 = 0"""
)
def parse_failures(spark, sf_dir):
    _, failures = procedures.parse(departures(spark, sf_dir), check_holds=False)
    return failures.select("block", "line", "signature")


@query(
    """select o_orderkey as block, 'ABC' as ident, 'VORTAC' as type from orders union all select o_orderkey, 'XYZ', null from orders where o_orderkey % 3 = 0"""
)
def procedure_references(spark, sf_dir):
    rows = procedures.legs(written(procedures.groups(departures(spark, sf_dir)), "groups"))
    return procedures.references(rows).groupBy("block", "ident").agg(F.max("type").alias("type"))


@query(
    """with p as (select p_partkey as id, p_partkey * 11 % 360 as c, p_partkey * 29 % 360 as h, 1000 + p_size * 10 as base, 1200 + p_partkey % 70 * 100 as ft, case when p_partkey % 3 = 0 then 'L' when p_partkey % 3 = 1 then 'R' end as side from part),
    t as (select *, (h - c + 360) % 360 as r, greatest(150.0 * 150 / (68626 * tan(radians(25))), 150 / 188.5) as rad from p),
    u as (select *, case when side = 'R' then r when side = 'L' then (case when r > 0 then r - 360 else 0 end) when r > 180 then r - 360 else r end as turn from t),
    s as (select *, case when turn < 0 then -1 else 1 end as sg, 1 + rad * radians(abs(turn)) as flown, greatest(1.0, (ft - base) / 200.0) as nm from u),
    e as (select *, greatest(0.0, nm - flown) as st from s)
    select id, round(sin(radians(c)) + rad * sin(radians(c + 90 * sg)) + rad * sin(radians(h - 90 * sg)) + st * sin(radians(h)), 6) + 0.0 as x,
           round(cos(radians(c)) + rad * cos(radians(c + 90 * sg)) + rad * cos(radians(h - 90 * sg)) + st * cos(radians(h)), 6) + 0.0 as y, round(flown + st, 6) as along,
           case when ft <= base then 'altitude not above current' when nm > 30 then 'altitude leg capped' end as failure from e"""
)
def trace_routes(spark, sf_dir):
    k = F.col("p_partkey")
    leg = F.struct((k * 29 % 360).cast("int").alias("heading"), (1200 + k % 70 * 100).cast("int").alias("feet"), F.when(k % 3 == 0, "L").when(k % 3 == 1, "R").alias("side"))
    routes = table(spark, sf_dir, "part").select(k.alias("id"), (k * 11 % 360).alias("course"), (1000 + F.col("p_size") * 10).alias("base_ft"), F.array(leg).alias("legs"))
    out = traces.trace_headings(routes)
    return out.select("id", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"), r6(F.col("along")).alias("along"), "failure")
