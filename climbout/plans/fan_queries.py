"""Ranges of headings and label layout over the driver's tables; the SQL walks degrees and recurses over the order of drawing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels
from ..operators import fans, layout
from .queries import query, r6, spread, table, text


@query(
    """with s as (select distinct l_orderkey as k, l_partkey % 360 as a, case l_suppkey % 6 when 0 then 10 when 1 then 45 when 2 then 90 when 3 then -30 when 4 then 200 else -5 end as n from lineitem),
    d as (select distinct k, ((case when n < 0 then a + n else a end) + i + 720) % 360 as d from s, range(0, 200) r(i) where i < abs(n)),
    c as (select k, count(*) as n from d group by k),
    u as (select k, d.range as d from c, range(0, 360) d where n < 360 and not exists (select 1 from d x where x.k = c.k and x.d = d.range)),
    b as (select d.k, d.d from d where not exists (select 1 from d x where x.k = d.k and x.d = (d.d + 359) % 360))
    select b.k, b.d + 0.0::double as start, min((u.d - b.d + 360) % 360) + 0.0::double as sweep from b join u using (k) group by b.k, b.d
    union all select k, 0.0, 360.0 from c where n = 360"""
)
def sector_union(spark, sf_dir):
    """Sectors of an order merged on the circle."""
    s = F.col("l_suppkey") % 6
    n = F.when(s == 0, 10).when(s == 1, 45).when(s == 2, 90).when(s == 3, -30).when(s == 4, 200).otherwise(-5)
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_partkey") % 360).cast("double").alias("start"), n.cast("double").alias("sweep"))
    return fans.merged_sectors(rows, ["k"])


@query(
    """with recursive w as (select l_orderkey as lid, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) as seq, l_partkey % 40 / 10.0::double as x from lineitem),
    f(lid, seq, fans, fan) as (
      select lid, 1::bigint, [{'first': 1::bigint, 'lo': x, 'hi': x}], 1::bigint from w where seq = 1
      union all select w.lid, w.seq, case when pos is null then list_append(f.fans, {'first': w.seq, 'lo': w.x, 'hi': w.x})
          else list_transform(f.fans, lambda g: case when g.first = f.fans[pos].first then {'first': g.first, 'lo': least(g.lo, w.x), 'hi': greatest(g.hi, w.x)} else g end) end,
        case when pos is null then w.seq else f.fans[pos].first end
      from f join (select w.*, null as z from w) w on w.lid = f.lid and w.seq = f.seq + 1,
      lateral (select nullif(list_position(list_transform(f.fans, lambda g: greatest(g.hi, w.x) - least(g.lo, w.x) <= 1.5), true), 0) as pos) p)
    select lid, seq, fan from f"""
)
def wedge_sharing(spark, sf_dir):
    """Wedges of an order that are drawn as one, in the order of its lines."""
    from pyspark.sql import Window

    seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey"))
    sectors = F.array(F.struct(F.lit(10.0).alias("start"), F.lit(50.0).alias("sweep")))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("lid"), seq.cast("long").alias("seq"), (F.col("l_partkey") % 40 / 10.0).alias("x"), F.lit(0.0).alias("y"), sectors.alias("sectors"), F.lit("hdg 010° CW 060°").alias("printed"), F.array(F.lit("4"), F.lit("22")).alias("runways"))
    return fans.shared_wedges(rows).select("lid", "seq", "fan")


@query(
    """with recursive w as (select l_orderkey as lid, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as seq, l_partkey % 30 / 10.0::double as a, l_suppkey % 20 / 10.0::double as b from lineitem),
    c as (select lid, seq, [{'x': a, 'y': b, 'c': 0.0::double}, {'x': a + 1, 'y': b, 'c': 0.25::double}, {'x': a, 'y': b + 1, 'c': 0.5::double}, {'x': a - 1, 'y': b - 1, 'c': 0.75::double}] as spots from w),
    start as (select o_orderkey as lid, [{'x': o_custkey % 25 / 10.0::double, 'y': o_custkey % 15 / 10.0::double, 'w': 0.4::double, 'h': 0.2::double}] as boxes from orders),
    f(lid, seq, boxes, x, y, cost) as (
      select lid, 0::bigint, boxes, null::double, null::double, null::double from start
      union all select c.lid, c.seq, list_append(f.boxes, {'x': best.x, 'y': best.y, 'w': 0.5::double, 'h': 0.3::double}), best.x, best.y, best.cost
      from f join c on c.lid = f.lid and c.seq = f.seq + 1,
      lateral (select list_sort(list_transform(range(1, 5), lambda i: {'cost': round(c.spots[i].c + list_sum(list_transform(f.boxes, lambda o:
        100 * greatest(least(c.spots[i].x + 0.5, o.x + o.w) - greatest(c.spots[i].x - 0.5, o.x - o.w), 0) * greatest(least(c.spots[i].y + 0.3, o.y + o.h) - greatest(c.spots[i].y - 0.3, o.y - o.h), 0)
        + 20 * greatest(least(c.spots[i].x + 0.8, o.x + 1.6 * o.w) - greatest(c.spots[i].x - 0.8, o.x - 1.6 * o.w), 0) * greatest(least(c.spots[i].y + 0.48, o.y + 1.6 * o.h) - greatest(c.spots[i].y - 0.48, o.y - 1.6 * o.h), 0))), 6), 'i': i, 'x': c.spots[i].x, 'y': c.spots[i].y}))[1] as best) p)
    select lid, seq, round(x, 6) + 0.0 as x, round(y, 6) + 0.0 as y from f where seq > 0"""
)
def label_layout(spark, sf_dir):
    """Labels of an order placed one after another: what is placed is clutter for the next."""
    from pyspark.sql import Window

    seq = F.row_number().over(Window.partitionBy("lid").orderBy("l_linenumber", "l_partkey", "l_suppkey")).cast("long")
    a, b = F.col("l_partkey") % 30 / 10.0, F.col("l_suppkey") % 20 / 10.0
    spot = lambda x, y, c: F.struct(x.alias("x"), y.alias("y"), F.lit(c).alias("cost"))
    # dealt by order before the spots are made, so that these are not shuffled
    rows = spread(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("lid"), "l_linenumber", "l_partkey", "l_suppkey"), "lid").withColumn("seq", seq)
    rows = rows.select("lid", "seq", F.lit(0.5).alias("w"), F.lit(0.3).alias("h"), F.array(spot(a, b, 0.0), spot(a + 1, b, 0.25), spot(a, b + 1, 0.5), spot(a - 1, b - 1, 0.75)).alias("spots"))
    boxes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("lid"), (F.col("o_custkey") % 25 / 10.0).alias("x"), (F.col("o_custkey") % 15 / 10.0).alias("y"), F.lit(0.4).alias("w"), F.lit(0.2).alias("h"))
    lines = boxes.limit(0).select("lid", *[F.lit(0.0).alias(c) for c in ("x0", "y0", "x1", "y1", "weight")])
    return layout.place(rows, boxes, lines).select("lid", "seq", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"))


@query(
    """with p as (select p_partkey as k, case p_partkey % 4 when 0 then '4' when 1 then '17L/R' when 2 then '4,17L/R,22' else 'ALL RWYS' end as tag,
      case when p_partkey % 3 = 0 then 'LT ' else '' end as turn, printf('%03d° CW %03d°', p_partkey % 360, p_partkey * 7 % 360) as s, case when p_partkey % 5 < 3 then (1000 + p_size * 100) || '''' end as alt from part),
    w as (select *, 'hdg ' as h from p),
    v as (select k, tag, alt, turn || 'hdg ' || s as first, tag || ' ' || turn || 'hdg ' || s as one, tag || ' ' || turn || s as two, case when tag = 'ALL RWYS' then tag else 'RWY ' || tag end as alone from w),
    l as (select k, case when length(one) <= 22 then case when alt is null then [one] when length(one || ' ' || alt) <= 22 then [one || ' ' || alt] else [one, alt] end end as a,
      case when length(two) <= 22 then case when alt is null then [two] when length(two || ' ' || alt) <= 22 then [two || ' ' || alt] else [two, alt] end end as b,
      list_prepend(alone, case when alt is null then [first] when length(first || ' ' || alt) <= 22 then [first || ' ' || alt] else [first, alt] end) as c from v)
    select k, array_to_string(case when a is not null and (b is null or len(a) <= len(b)) and len(a) <= len(c) then a when b is not null and len(b) <= len(c) then b else c end, '|') as lines from l"""
)
def range_label_lines(spark, sf_dir):
    """Lines of a range's label: the way with the fewest lines, the first of them on ties."""
    k = F.col("p_partkey")
    runways = F.when(k % 4 == 0, F.array(F.lit("4"))).when(k % 4 == 1, F.array(F.lit("17R"), F.lit("17L"))).when(k % 4 == 2, F.array(F.lit("4"), F.lit("17L"), F.lit("17R"), F.lit("22"))).otherwise(F.expr("cast(array() as array<string>)"))
    sector = F.array(F.struct((k % 360).alias("start"), F.lit(True).alias("clockwise"), (k * 7 % 360).alias("end")))
    phrases = labels.heading_range(sector, F.when(k % 3 == 0, "L"), F.when(k % 5 < 3, text(1000 + F.col("p_size") * 100, "'")))
    return spread(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select(k.alias("k"), F.array_join(labels.fewest_lines(runways, phrases), "|").alias("lines"))
