"""Queries over the binding joins, labels and compass points, on tables derived from keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geodesy, labels
from ..operators import bindings, facilities, traces
from .queries import query, r6, table, text

FEET_NM = 6076.11549


@query(
    f"""with c as (select c_custkey as k, 30 + c_custkey % 500 / 25.0 as la, -120 + c_custkey % 700 / 35.0 as lo, 0.01 + c_custkey % 7 / 1000.0 as dla, c_custkey % 9 / 1000.0 as dlo, 6000 + c_custkey % 50 * 100 as len from customer),
    e as (select *, '22' as runway, la + dla as lat, lo + dlo as lon, la as olat, lo as olon, case when k % 5 > 0 then 100 end as oft, case when k % 4 > 0 then 5000 + k % 60 * 100 end as tora from c
          union all select *, '04', la, lo, la + dla, lo + dlo, case when k % 5 > 0 then 200 end, null from c),
    b as (select *, radians(lat) as p, radians(olat) as q, radians(olon - lon) as d, greatest(coalesce(len - tora, 0), 0) / {FEET_NM} as cut, k % 11 = 0 as gone from e),
    t as (select *, degrees(atan2(sin(d) * cos(q), cos(p) * sin(q) - sin(p) * cos(q) * cos(d))) as fwd, atan2(sin(-d) * cos(p), cos(q) * sin(p) - sin(q) * cos(p) * cos(-d)) as back, cut / 3440.065 as a from b),
    m as (select *, asin(sin(q) * cos(a) + cos(q) * sin(a) * cos(back)) as to_lat from t)
    select k as lid, runway, case when not gone then round(degrees(to_lat), 6) end as der_lat,
           case when not gone then round(olon + degrees(atan2(sin(back) * sin(a) * cos(q), cos(a) - sin(q) * sin(to_lat))), 6) end as der_lon,
           case when not gone then coalesce(oft, 50) end as der_elevation_ft, case when not gone then round(fwd - 360 * floor(fwd / 360), 6) end as course_true, case when gone then 'runway end position missing' end as failure from m"""
)
def runway_starts(spark, sf_dir):
    """Both ends of one runway per customer; some without run available, elevation or position."""
    k = F.col("c_custkey")
    lat, lon = 30 + k % 500 / 25.0, -120 + k % 700 / 35.0
    c = table(spark, sf_dir, "customer")
    one = F.struct(F.lit("04").alias("end_id"), F.when(k % 11 > 0, lat).alias("lat"), lon.alias("lon"), F.when(k % 5 > 0, 100).alias("elevation_ft"), F.lit(None).cast("int").alias("tora_ft"))
    two = F.struct(F.lit("22").alias("end_id"), (lat + 0.01 + k % 7 / 1000.0).alias("lat"), (lon + k % 9 / 1000.0).alias("lon"), F.when(k % 5 > 0, 200).alias("elevation_ft"), F.when(k % 4 > 0, 5000 + k % 60 * 100).cast("int").alias("tora_ft"))
    ends = c.select(k.alias("lid"), F.lit("04/22").alias("runway_id"), F.explode(F.array(one, two)).alias("e")).select("lid", "runway_id", "e.*")
    runways = c.select(k.alias("lid"), F.lit("04/22").alias("runway_id"), (6000 + k % 50 * 100).alias("length_ft"))
    out = bindings.runway_starts(ends.select("lid", F.col("end_id").alias("runway")), c.select(k.alias("lid"), F.lit(50).alias("elevation_ft")), runways, ends)
    return out.withColumns({x: r6(F.col(x)) for x in ("der_lat", "der_lon", "course_true")})


@query(
    """with l as (select c_custkey as block, c_custkey % 50 as fix from customer),
    h as (select s_suppkey as hold, s_suppkey % 50 as fix, case s_suppkey % 3 when 1 then s_suppkey % 50 when 2 then s_suppkey % 7 end as navaid from supplier)
    select block, l.fix, hold from l join h on l.fix = h.fix where navaid is null or navaid = h.fix or navaid = block % 7"""
)
def hold_candidates(spark, sf_dir):
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    blocks = table(spark, sf_dir, "customer").select(c.alias("block"), (c % 50).alias("fix"), (c % 7).alias("ident"))
    holds = table(spark, sf_dir, "supplier").select(s.alias("hold"), (s % 50).alias("fix"), F.when(s % 3 == 1, s % 50).when(s % 3 == 2, s % 7).alias("navaid"))
    return bindings.matching_holds(blocks.select("block", "fix"), holds, blocks.select("block", "ident")).select("block", "fix", "hold")


@query(
    """select c_custkey as lid, cast(case when c_custkey % 3 > 0 then c_custkey % 40 - 20.0 when c_custkey % 2 = 0 then c_custkey % 30 - 15.5 end as double) as variation_east,
       case when c_custkey % 3 > 0 then 'published' when c_custkey % 2 = 0 then 'model' end as source from customer"""
)
def variation_fallback(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer")
    return bindings.variation(c.select(k.alias("lid"), F.when(k % 3 > 0, k % 40 - 20.0).alias("published")), c.where(k % 2 == 0).select(k.alias("lid"), (k % 30 - 15.5).alias("declination")))


@query(
    """select l_orderkey as block, l_suppkey % 4 as ident, min(l_linenumber % 2) as is_fix, arg_min(l_partkey % 3, (l_linenumber % 2) * 10 + l_partkey % 3) as lat,
       count(distinct l_partkey % 3) > 1 as ambiguous from lineitem group by 1, 2"""
)
def same_ident_places(spark, sf_dir):
    points = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("block"), (F.col("l_suppkey") % 4).alias("ident"), (F.col("l_linenumber") % 2).alias("is_fix"), (F.col("l_partkey") % 3).alias("lat"), F.lit(0).alias("lon"))
    return bindings.same_places(points).select("block", "ident", "is_fix", "lat", "ambiguous")


@query(
    """with r as (select l_orderkey as block, l_partkey % 3 as name, l_suppkey % 2 as ident, ['VOR', 'NDB'][l_suppkey % 2 + 1] as type from lineitem where l_partkey % 5 > 0),
    s as (select block, name, min(ident) as ident, min(type) as type from r group by 1, 2 having count(distinct ident) = 1 and count(distinct type) = 1)
    select o_orderkey as block, 'N' || (o_orderkey % 3) as name, 'VOR' as type, case when s.type = 'VOR' then 'I' || s.ident end as ident, case when s.type is distinct from 'VOR' then 'navaid without ident' end as failure
    from orders left join s on o_orderkey = block and o_orderkey % 3 = name"""
)
def navaids_by_name(spark, sf_dir):
    odd = F.col("l_suppkey") % 2
    refs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("block"), F.when(F.col("l_partkey") % 5 > 0, text("N", F.col("l_partkey") % 3)).alias("name"), F.when(odd == 0, "VOR").otherwise("NDB").alias("type"), text("I", odd).alias("ident"))
    wanted = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("block"), text("N", F.col("o_orderkey") % 3).alias("name"), F.lit("VOR").alias("type"))
    return bindings.named_navaids(wanted, refs)


@query(
    """with e as (select 'V' || (s_suppkey % 4) as volume, 'A' || s_suppkey as lid, case when s_suppkey % 3 = 0 then 'K' || s_suppkey end as icao from supplier),
    b as (select distinct 'V' || (k % 4) as volume, case k % 5 when 0 then 'A' || k when 1 then 'K' || k when 2 then 'KA' || k when 3 then 'A' || k else 'Z' || k end as lid from (select c_custkey // 2 as k from customer)),
    m as (select b.volume, b.lid as block, e.lid from b join e on b.volume = e.volume and (b.lid = e.lid or b.lid = e.icao or (length(b.lid) = 4 and b.lid = 'K' || e.lid)))
    select volume, lid, volume || ': metafile airport ' || lid || ' has no block' as warning from e where (volume, lid) not in (select volume, lid from m)
    union all select volume, lid, volume || ': block ' || lid || ' has no metafile airport' from b where (volume, lid) not in (select volume, block from m)"""
)
def metafile_reconciliation(spark, sf_dir):
    s, k = F.col("s_suppkey"), F.expr("c_custkey div 2")
    expected = table(spark, sf_dir, "supplier").select(text("V", s % 4).alias("volume"), text("A", s).alias("lid"), F.when(s % 3 == 0, text("K", s)).alias("icao"), s.alias("seq"))
    head = F.element_at(F.array(*[F.lit(x) for x in ("A", "K", "KA", "A", "Z")]), (k % 5 + 1).cast("int"))
    blocks = table(spark, sf_dir, "customer").select(text("V", k % 4).alias("volume"), text(head, k).alias("lid")).distinct()
    return bindings.metafile_check(blocks, expected)


@query(
    """with b as (select 'V' || (c_custkey % 3) as volume, 'D' || (c_custkey % 90) as lid from customer where c_custkey % 7 > 0),
    d as (select distinct 'V' || (s_suppkey % 3) as volume, 'D' || s_suppkey as lid from supplier where s_suppkey % 5 > 0),
    r as (select * from d where not (substr(lid, 2)::int % 4 = 1 and substr(lid, 2)::int % 8 <> 1))
    select volume, lid, volume || ': destination (' || lid || ') has no block' as warning from r where (volume, lid) not in (select volume, lid from b)
    union all select volume, lid, volume || ': block ' || lid || ' has no named destination' from b where length(lid) = 3 and (volume, lid) not in (select volume, lid from r)
    union all select volume, lid, volume || ': duplicate LID ' || lid from b group by 1, 2 having count(*) > 1"""
)
def destination_reconciliation(spark, sf_dir):
    """Suppliers as destinations, beside the front matter's; some are only mentioned in running text."""
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    blocks = table(spark, sf_dir, "customer").where(c % 7 > 0).select(text("V", c % 3).alias("volume"), text("D", c % 90).alias("lid"))
    named = table(spark, sf_dir, "supplier").select(s, text("V", s % 3).alias("volume"), text("D", s).alias("name"))
    front = table(spark, sf_dir, "region").select(F.lit("V0").alias("volume"), F.explode(F.array(*[F.lit(x) for x in bindings.FRONT_MATTER])).alias("name"))
    return bindings.destination_check(blocks, named.where(s % 5 > 0).select("volume", "name").unionByName(front), named.where(s % 4 == 1).select("volume", "name"), named.where(s % 8 == 1).select("volume", "name"))


@query(
    """with t as (select p_partkey as k, p_partkey % 18 + 1 as a, p_partkey % 17 + 19 as b from part)
    select k, case k % 3 when 0 then 'ALL RWYS' when 1 then a || 'L/C/R,' || b end as tag,
       'hdg ' || lpad(cast(k % 360 as varchar), 3, '0') || '°' as heading, 'ABC R-' || lpad(cast(k * 7 % 360 as varchar), 3, '0') as radial,
       'ABC ' || (k % 30) || case when k % 2 = 1 then '.5' else '' end || ' DME' as dme from t"""
)
def label_texts(spark, sf_dir):
    k = F.col("p_partkey")
    a, b = k % 18 + 1, k % 17 + 19
    three = F.array(text(a, "R"), text(b), text(a, "L"), text(a, "C"))
    many = F.array(*[text(b + n, side) for n in (0, 20, 40) for side in ("L", "C", "R")])  # too long for a label
    runways = F.when(k % 3 == 0, F.expr("cast(array() as array<string>)")).when(k % 3 == 1, three).otherwise(many)
    nm = k % 30 + F.when(k % 2 == 1, 0.5).otherwise(0.0)
    return table(spark, sf_dir, "part").select(k.alias("k"), labels.runway_tag(runways).alias("tag"), labels.heading(k % 360).alias("heading"), labels.radial(k * 7 % 360, F.lit("ABC")).alias("radial"), labels.dme(F.lit("ABC"), nm).alias("dme"))


@query(
    """select p_partkey as k, case when p_partkey % 2 = 0 then h || ' ' || h || '|' || h else 'all other headings CW to ' || h || '|' || h || ' ' || h end as lines
    from (select *, 'hdg ' || lpad(cast(p_partkey % 360 as varchar), 3, '0') || '°' as h from part)"""
)
def label_lines(spark, sf_dir):
    k = F.col("p_partkey")
    h = labels.heading(k % 360)
    first = F.when(k % 2 == 0, h).otherwise(text("all other headings CW to ", h))
    return table(spark, sf_dir, "part").select(k.alias("k"), F.array_join(labels.wrapped(F.array(first, h, h)), "|").alias("lines"))


@query(
    """with t as (select p_partkey as k, p_partkey % 8 as i, p_partkey * 7 % 360 as inbound, p_partkey % 360 as s, p_partkey * 13 % 360 as e, p_partkey % 2 = 0 as cw from part)
    select k, cast(i * 45 as bigint) as bearing, abs((i * 45 - inbound + 360) % 360 - 180) <= 30 as agrees, cast(359 - (case when cw then e - s + 360 else s - e + 360 end) % 360 as int) as others,
           case when (case when cw then e - s + 360 else s - e + 360 end) % 360 < 359 then cast(list_min(list_filter(generate_series(0, 359), lambda x: (case when cw then x - s + 360 else x - e + 360 end) % 360 > (case when cw then e - s + 360 else s - e + 360 end) % 360)) as int) end as lowest from t"""
)
def compass_and_sectors(spark, sf_dir):
    k = F.col("p_partkey")
    point = F.element_at(F.array(*[F.lit(p) for p in labels.POINTS]), (k % 8 + 1).cast("int"))
    others = labels.other_headings(labels.swept(k % 360, k * 13 % 360, k % 2 == 0))
    return table(spark, sf_dir, "part").select(k.alias("k"), labels.compass_bearing(point).alias("bearing"), labels.side_agrees(point, k * 7 % 360).alias("agrees"), F.size(others).alias("others"), F.array_min(others).alias("lowest"))


@query(
    """with s as (select l_orderkey as k, sum(sin(radians(l_partkey % 120 + l_orderkey % 200))) as x, sum(cos(radians(l_partkey % 120 + l_orderkey % 200))) as y from lineitem group by 1)
    select k, round(degrees(atan2(x, y)) - 360 * floor(degrees(atan2(x, y)) / 360), 5) as course from s"""
)
def mean_course(spark, sf_dir):
    """Circular mean of the courses of an order's lines, all within 120 degrees of each other."""
    unit = geodesy.unit((F.col("l_partkey") % 120 + F.col("l_orderkey") % 200).cast("double"))
    s = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum(unit["x"]).alias("x"), F.sum(unit["y"]).alias("y"))
    return s.select("k", F.round(geodesy.course_of(F.col("x"), F.col("y")), 5).alias("course"))


@query(
    """with p as (select p_partkey as k, 30 + p_partkey % 400 / 20.0 as lat, -120 + p_partkey % 300 / 15.0 as lon, p_size * 20 + 35.0 as base, p_partkey * 7 % 360 as c, case when p_partkey % 3 > 0 then 210.0 + p_partkey % 300 end as g, case when p_partkey % 3 = 1 then p_size * 20 + 100 + p_partkey % 500 end as top from part),
    n as (select *, greatest(1.0, greatest(least(base + 400, coalesce(top, 1e9)) - base, 0) / coalesce(g, 200.0) + greatest(base + 400 - greatest(base, coalesce(top, 1e9)), 0) / 200.0) as nm from p)
    select k, cast(base as double) as base_ft, round(nm, 6) as turn_nm, round(lat + nm * cos(radians(c)) / 60, 6) as turn_lat, round(lon + nm * sin(radians(c)) / (60 * cos(radians(lat))), 6) as turn_lon from n"""
)
def turn_starts(spark, sf_dir):
    """The first straight climb, at the published gradient as far as it reaches, else at the usual one."""
    k = F.col("p_partkey")
    starts = table(spark, sf_dir, "part").select(
        k.alias("k"), (30 + k % 400 / 20.0).alias("der_lat"), (-120 + k % 300 / 15.0).alias("der_lon"), (F.col("p_size") * 20).alias("der_elevation_ft"), (k * 7 % 360).alias("course_true"),
        F.when(k % 3 > 0, 210.0 + k % 300).alias("ft_per_nm"), F.when(k % 3 == 1, F.col("p_size") * 20 + 100 + k % 500).alias("to_ft"),
    )
    out = traces.turn_starts(starts)
    return out.select("k", F.col("base_ft").cast("double").alias("base_ft"), *[r6(F.col(c)).alias(c) for c in ("turn_nm", "turn_lat", "turn_lon")])


@query(
    """with b as (select c_custkey, case when c_custkey % 3 = 0 then 'K' || (100 + c_custkey % 900) else cast(100 + c_custkey % 900 as varchar) end as lid from customer),
    w as (select cast(100 + s_suppkey * 7 % 900 as varchar) as ident from supplier union all select 'K' || (100 + s_suppkey * 11 % 900) from supplier)
    select c_custkey, lid, 'RWY ' || (c_custkey % 18 + 1) || '/' || (c_custkey % 18 + 19) as part from b where lid in (select ident from w) or (length(lid) = 4 and lid like 'K%' and substr(lid, 2) in (select ident from w))"""
)
def selected_airports(spark, sf_dir):
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    blocks = table(spark, sf_dir, "customer").select("c_custkey", text(F.when(c % 3 == 0, "K").otherwise(""), 100 + c % 900).alias("lid"), labels.part_name(F.array(text(c % 18 + 1), text(c % 18 + 19))).alias("part"))
    w = table(spark, sf_dir, "supplier")
    return facilities.selected(blocks, w.select(text(100 + s * 7 % 900).alias("ident")).union(w.select(text("K", 100 + s * 11 % 900)))).select("c_custkey", "lid", "part")


@query(
    """with l as (select c_custkey as k from customer), r as (select s_suppkey * 20 as k from supplier)
    select 'left' as side, k from l where k not in (select k from r) union all select 'right', k from r where k not in (select k from l)"""
)
def reconcile_overlap(spark, sf_dir):
    """Two key sets of which each has some that the other lacks."""
    right = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 20).alias("k"))
    return facilities.reconcile(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), right, "k")
