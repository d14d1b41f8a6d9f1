"""Queries over ends of routes, shared tails, parts, styles and round trips, on tables derived from keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geodesy, labels
from ..operators import parts, pens, procedures, visual_climbs
from ..sources import kml, sinks
from .procedure_queries import departures
from .queries import query, r6, spread, table, text
from .shape_queries import SQL_RADIUS


def sided(k):
    return F.when(k % 3 == 0, "L").when(k % 3 == 1, "R")


SQL_SIDE = "case when {k} % 3 = 0 then 'L' when {k} % 3 = 1 then 'R' end"
SPACING = "(0.85 / 3)"


@query(
    f"""with p as (select p_partkey as k, p_partkey % 9 as x, p_partkey % 7 as y, p_partkey * 11 % 360 + case when p_partkey % 3 = 0 then -45 when p_partkey % 3 = 1 then 45 else 0 end as c, unnest(generate_series(0, 3)) as i from part)
    select k, cast(i as int) as i, round(x + i * {SPACING} * sin(radians(c)), 6) + 0.0 as ax, round(y + i * {SPACING} * cos(radians(c)), 6) + 0.0 as ay,
       round(x + (i * {SPACING} + 0.15) * sin(radians(c)), 6) + 0.0 as bx, round(y + (i * {SPACING} + 0.15) * cos(radians(c)), 6) + 0.0 as by_ from p"""
)
def on_course_stubs(spark, sf_dir):
    k = F.col("p_partkey")
    dashes = pens.on_course((k % 9).cast("double"), (k % 7).cast("double"), (k * 11 % 360).cast("double"), sided(k))
    out = table(spark, sf_dir, "part").select(k.alias("k"), F.posexplode(dashes).alias("i", "d"))
    return out.select("k", "i", r6(F.col("d.a.x")).alias("ax"), r6(F.col("d.a.y")).alias("ay"), r6(F.col("d.b.x")).alias("bx"), r6(F.col("d.b.y")).alias("by_"))


@query(
    f"""with p as (select p_partkey as k, p_partkey * 11 % 360 as c, p_partkey * 29 % 360 as h, {SQL_SIDE.format(k="p_partkey")} as side, {SQL_RADIUS} as r from part),
    t as (select *, (h - c + 360) % 360 as raw from p),
    u as (select *, case when side = 'R' then raw when side = 'L' then (case when raw > 0 then raw - 360 else 0 end) when raw > 180 then raw - 360 else raw end as turn from t),
    w as (select *, case when turn < 0 then -1 else 1 end as way, degrees({SPACING} / r) as sp, degrees(0.15 / r) as dash from u),
    d as (select *, unnest(generate_series(0, cast(ceil(abs(turn) / sp) as int) - 1)) as i from w),
    e as (select *, least(i * sp + dash, abs(turn)) as till from d)
    select k, cast(i as int) as i, round(i * sp, 6) as from_deg, round(till, 6) as to_deg, round(r * sin(radians(c + 90 * way)) + r * sin(radians(c + way * (till - 90))), 6) + 0.0 as bx,
       round(r * cos(radians(c + 90 * way)) + r * cos(radians(c + way * (till - 90))), 6) + 0.0 as by_ from e"""
)
def dashed_turns(spark, sf_dir):
    k = F.col("p_partkey")
    dashes = pens.dashed_turn(F.lit(0.0), F.lit(0.0), (k * 11 % 360).cast("double"), (k * 29 % 360).cast("double"), sided(k), geodesy.turn_radius(F.lit(150.0), F.lit(25.0)))
    out = table(spark, sf_dir, "part").select(k.alias("k"), F.posexplode(dashes).alias("i", "d"))
    return out.select("k", "i", F.round("d.from_deg", 6).alias("from_deg"), F.round("d.to_deg", 6).alias("to_deg"), r6(F.col("d.b.x")).alias("bx"), r6(F.col("d.b.y")).alias("by_"))


@query(
    """with p as (select p_partkey as k, p_partkey % 9 as x, p_partkey % 7 as y, p_partkey * 13 % 360 as c, case when p_partkey % 2 = 0 then 0 else 0.5 end as b from part),
    t as (select *, x - b * sin(radians(c)) as tx, y - b * cos(radians(c)) as ty from p)
    select k, round(tx, 6) + 0.0 as tip_x, round(ty, 6) + 0.0 as tip_y, round(tx + 0.25 * sin(radians(c + 150)), 6) + 0.0 as left_x, round(ty + 0.25 * cos(radians(c + 210)), 6) + 0.0 as right_y from t"""
)
def arrowheads(spark, sf_dir):
    k = F.col("p_partkey")
    arrow = pens.arrowhead((k % 9).cast("double"), (k % 7).cast("double"), (k * 13 % 360).cast("double"), k % 2 == 0)
    out = table(spark, sf_dir, "part").select(k.alias("k"), arrow.alias("a"))
    return out.select("k", r6(F.col("a.tip.x")).alias("tip_x"), r6(F.col("a.tip.y")).alias("tip_y"), r6(F.col("a.left.x")).alias("left_x"), r6(F.col("a.right.y")).alias("right_y"))


@query(
    f"""with p as (select p_partkey as k, {SQL_SIDE.format(k="p_partkey")} as side, p_partkey * 11 % 360 as c, p_partkey * 29 % 360 as q, case when p_partkey % 5 = 0 then p_partkey % 2 = 0 end as printed, case when p_partkey % 5 = 1 then p_partkey % 9 end as ends, p_partkey % 4 as starts from part),
    t as (select *, (q - c + 360) % 360 as o, (q + 180 - c + 360) % 360 as i from p),
    w as (select *, case when side = 'R' then o when side = 'L' then (360 - o) % 360 else least(o, 360 - o) end as ot, case when side = 'R' then i when side = 'L' then (360 - i) % 360 else least(i, 360 - i) end as it from t)
    select k, case when printed is not null then printed when ends is not null then (case when ends <> starts then ends > starts end)
       when (side is null and ot <= 60) or (side is not null and ot between 60 and 120) then true when (side is null and it <= 60) or (side is not null and it between 60 and 120) then false end as outbound from w"""
)
def radial_senses(spark, sf_dir):
    k = F.col("p_partkey")
    sense = pens.flown_outbound(F.when(k % 5 == 0, k % 2 == 0), (k % 4).cast("double"), F.when(k % 5 == 1, (k % 9).cast("double")), (k * 11 % 360).cast("double"), (k * 29 % 360).cast("double"), sided(k))
    return table(spark, sf_dir, "part").select(k.alias("k"), sense.alias("outbound"))


@query(
    """with p as (select l_orderkey as block, l_linenumber as seq, l_partkey % 10 / 16.0 as x, l_suppkey % 10 / 16.0 as y from lineitem),
    f as (select block, x as fx, y as fy, seq as s from p qualify row_number() over (partition by block order by seq, x, y) = 1)
    select p.block, 'pen ' || min(s) as name, round(max(sqrt((x - fx) * (x - fx) + (y - fy) * (y - fy))), 6) as gap_nm, case when max(sqrt((x - fx) * (x - fx) + (y - fy) * (y - fy))) > 0.5 then 'shared tail start mismatch' end as failure from p join f on p.block = f.block group by 1"""
)
def shared_tails(spark, sf_dir):
    ends = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("block"), F.col("l_linenumber").alias("seq"), text("pen ", F.col("l_linenumber")).alias("name"), (F.col("l_partkey") % 10 / 16.0).alias("x"), (F.col("l_suppkey") % 10 / 16.0).alias("y"))
    return pens.tail_starts(ends).select("block", "name", F.round("gap_nm", 6).alias("gap_nm"), "failure")


@query(
    """with p as (select l_orderkey as block, l_linenumber as seq, l_orderkey % 2 = 0 as outbound, (8 - l_linenumber) * 3 - case when l_orderkey % 5 = 0 then 4 else 0 end as a,
       l_suppkey % 40 > 0 and l_partkey % 40 > 0 as straight from lineitem),
    b as (select block, bool_and(straight and a >= 0) as all_on, arg_min(seq, case when outbound then a else -a end) as seq, case when bool_and(outbound) then min(a) else max(a) end as a from p group by 1)
    select block, seq, round(cast(a as double), 6) as along_nm from b where all_on"""
)
def tail_radials(spark, sf_dir):
    """Pens strung out along each order's radial, some beside it or not flying along it."""
    k = F.col("l_orderkey")
    radial, outbound = (k * 7 % 360).cast("double"), k % 2 == 0
    along = ((8 - F.col("l_linenumber")) * 3 - F.when(k % 5 == 0, 4).otherwise(0)).cast("double")
    beside = F.when(F.col("l_suppkey") % 40 == 0, 0.6).otherwise(0.2)
    place = lambda f, g: along * f(F.radians(radial)) + beside * g(F.radians(radial + 90))
    course = radial + F.when(outbound, 0.0).otherwise(180.0) + F.when(F.col("l_partkey") % 40 == 0, 2.0).otherwise(0.5)
    flown = table(spark, sf_dir, "lineitem").select(k.alias("block"), F.col("l_linenumber").alias("seq"), place(F.sin, F.sin).alias("x"), place(F.cos, F.cos).alias("y"), course.alias("course"))
    o = F.col("o_orderkey")
    radials = table(spark, sf_dir, "orders").select(o.alias("block"), F.lit(0.0).alias("nx"), F.lit(0.0).alias("ny"), (o * 7 % 360).cast("double").alias("radial"), (o % 2 == 0).alias("outbound"))
    return pens.radial_starts(flown, radials).select("block", "seq", F.round("along_nm", 6).alias("along_nm"))


def minimums(spark, sf_dir):
    """Takeoff minimums of the departures: a limit for the first group, for the second, none, or for all."""
    k = F.col("o_orderkey")
    lines = F.array(F.lit("Rwy 4, 200-1, max 180 KIAS."), F.lit("Rwys 22, 35L/R, std., 200 knots or less."), F.lit("Rwy 4, std."), F.lit("All runways 210 KIAS until established."))
    return table(spark, sf_dir, "orders").select(k.alias("block"), F.element_at(lines, (k % 4 + 1).cast("int")).alias("text"))


@query(
    """with o as (select o_orderkey as k from orders where o_orderkey % 13 <> 0)
    select k as block, 0 as line, 'RWY 4' as part, 'unread speed limit in takeoff minimums' as signature, case k % 4 when 0 then 'Rwy 4, 200-1, max 180 KIAS.' else 'All runways 210 KIAS until established.' end as detail from o where k % 11 <> 0 and k % 4 in (0, 3)
    union all select k, 1, 'RWY 22/35L/35R', 'unread speed limit in takeoff minimums', case k % 4 when 1 then 'Rwys 22, 35L/R, std., 200 knots or less.' else 'All runways 210 KIAS until established.' end from o where k % 4 in (1, 3)"""
)
def withheld_routes(spark, sf_dir):
    read, _ = procedures.parse(departures(spark, sf_dir), check_holds=False)
    return parts.without_speed_limited(read, minimums(spark, sf_dir))[1]


@query(
    """with o as (select o_orderkey as k from orders where o_orderkey % 13 <> 0)
    select k as block, 0 as line, 'RWY 4' as part, 2 as legs, 0 as tail_legs from o where k % 11 <> 0 and k % 4 in (1, 2)
    union all select k, 1, 'RWY 22/35L/35R', 2, case when k % 3 = 0 then 2 else 0 end from o where k % 4 in (0, 2)"""
)
def procedure_parts(spark, sf_dir):
    """The routes that stay under the takeoff minimums, each with the tail that it goes on into."""
    read, _ = procedures.parse(departures(spark, sf_dir), check_holds=False)
    kept, _ = parts.without_speed_limited(read, minimums(spark, sf_dir))
    return parts.parts(kept).select("block", "line", "part", F.size("legs").alias("legs"), F.coalesce(F.size("tail_legs"), F.lit(0)).alias("tail_legs"))


@query(
    """select l_orderkey as block, min('F' || l_suppkey % 2) as target from lineitem group by 1 having count(distinct l_suppkey % 2) = 1 and bool_and(l_partkey % 9 > 0)"""
)
def common_ends(spark, sf_dir):
    target = F.when(F.col("l_partkey") % 9 > 0, text("F", F.col("l_suppkey") % 2))
    legs = F.array(F.struct(F.struct(F.lit("Direct").alias("node"), target.alias("target")).alias("leg")))
    return parts.common_end(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("block"), F.lit(False).alias("tail"), legs.alias("legs")))


@query(
    """with l as (select l_orderkey as block, (l_linenumber::bigint * 1000000000 + l_partkey) * 1000000 + l_suppkey as seq, l_partkey % 3 = 0 as hold, case when l_suppkey % 2 = 0 then 'F' || l_suppkey end as target from lineitem)
    select block, seq, case when hold then coalesce(target, lag(target) over (partition by block order by seq)) end as held from l"""
)
def hold_fixes(spark, sf_dir):
    leg = F.struct(F.when(F.col("l_partkey") % 3 == 0, "ClimbInHold").otherwise("Direct").alias("node"), F.when(F.col("l_suppkey") % 2 == 0, text("F", F.col("l_suppkey"))).alias("target"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("block"), F.lit(0).alias("line"), F.expr("(l_linenumber * 1000000000L + l_partkey) * 1000000 + l_suppkey").alias("seq"), leg.alias("leg"))
    return parts.with_hold_fix(rows).select("block", "seq", "held")


@query(
    """with l as (select distinct l_suppkey as lid, l_linenumber % 4 as g from lineitem), n as (select lid, g, row_number() over (partition by lid order by g) - 1 as i, count(*) over (partition by lid) as n from l where g > 0)
    select l_orderkey, l_linenumber, 'route-' || (l_suppkey % 6) || case when n > 1 then '-' || n || '-' || i else '' end as style_id, coalesce(n > 1, false) as shaded from lineitem left join n on lid = l_suppkey and g = l_linenumber % 4"""
)
def group_styles(spark, sf_dir):
    """Each line drawn for one of three groups of runways or for none; the names are in numeric order, not in that of their letters."""
    grp = F.element_at(F.array(F.expr("cast(array() as array<string>)"), F.array(F.lit("4")), F.array(F.lit("16L"), F.lit("16R")), F.array(F.lit("22"))), (F.col("l_linenumber") % 4 + 1).cast("int"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("lid"), (F.col("l_suppkey") % 6).cast("int").alias("palette"), F.lit("route").alias("style"), grp.alias("grp"))
    return kml.group_styles(lines).select("l_orderkey", "l_linenumber", "style_id", F.col("colour").isNotNull().alias("shaded"))


@query(
    """with o as (select o_orderkey as k from orders where o_orderkey % 13 <> 0)
    select k as block, 0 as line, 'ClimbHeading,ProceedOnCourse' as nodes, cast(2000 + k % 60 * 100 as int) as feet, true as same from o where k % 11 <> 0
    union all select k, 1, 'HeadingAndRadial,' || case when k % 3 = 0 then 'Thence' else 'ProceedOnCourse' end, cast(5000 + k % 40 * 100 as int), true from o
    union all select k, 2, 'ClimbInHold,ProceedOnCourse', cast(9000 + k % 9 * 100 as int), true from o where k % 3 = 0"""
)
def legs_round_trip(spark, sf_dir):
    read, _ = procedures.parse(departures(spark, sf_dir), check_holds=False)
    back = read.withColumn("text", procedures.legs_to_json(F.col("legs"))).withColumn("back", procedures.legs_from_json(F.col("text")))
    nodes = F.array_join(F.transform("back", lambda x: x["leg"]["node"]), ",")
    return back.select("block", "line", nodes.alias("nodes"), F.col("back")[0]["leg"]["feet"].alias("feet"), (procedures.legs_to_json(F.col("back")) == F.col("text")).alias("same"))


@query(
    """select cast(-1 as bigint) as seq, null as kind, null as airport, count(*)::int as drawn, 0 as partial from orders
    union all select o_orderkey, case o_orderkey % 3 when 0 then null else 'kind ' || o_orderkey % 3 end, 'A"' || o_custkey, null, null from orders"""
)
def report_round_trip(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    none = F.lit(None).cast("string")
    totals = o.agg(F.count("*").cast("int").alias("drawn")).select("drawn", F.lit("2601").alias("cycle"), *[F.lit(None).cast("int").alias(c) for c in ("airports_with_text", "label_count", "graphic_only", "partial")])
    found = o.select(F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 3 > 0, text("kind ", F.col("o_orderkey") % 3)).alias("kind"), text('A"', F.col("o_custkey")).alias("airport"), *[none.alias(c) for c in ("signature", "verbatim_text", "amendment")])
    head, findings = sinks.report_from_json(sinks.report_json(totals, found))
    return head.select(F.lit(-1).cast("long").alias("seq"), none.alias("kind"), none.alias("airport"), "drawn", "partial").unionByName(findings.select("seq", "kind", "airport", F.lit(None).cast("int").alias("drawn"), F.lit(None).cast("int").alias("partial")))


@query(
    """select 'S' || s_suppkey as lid, '{"lid":"S' || s_suppkey || '","amendment":null,"departure_procedure":' || case when s_suppkey % 3 > 0 then '"climb to ' || s_suppkey || '"' else 'null' end || ',"vcoa":' || case when s_suppkey % 2 > 0 then '"cross \\"' || s_suppkey || '\\""' else 'null' end || '}' as line
    from supplier where s_suppkey % 3 > 0 or s_suppkey % 2 > 0"""
)
def sections_dump(spark, sf_dir):
    """Blocks with a departure procedure or a visual climb, as JSON lines."""
    s = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(text("S", s).alias("lid"), F.lit(None).cast("string").alias("amendment"), F.when(s % 3 > 0, text("climb to ", s)).alias("departure_procedure"), F.when(s % 2 > 0, text('cross "', s, '"')).alias("vcoa"))
    return sinks.sections_json(parts.with_text(rows))


@query(
    """with p as (select p_partkey as k, p_partkey % 360 as d, 1000 + p_partkey % 120 * 100 as ft, case when p_partkey % 3 = 0 then 'L' when p_partkey % 3 = 1 then 'R' end as side, lpad(cast(p_partkey % 360 as varchar), 3, '0') as h, lpad(cast(p_partkey * 7 % 360 as varchar), 3, '0') as e from part)
    select k, 'Hold ' || h || '° ' || coalesce(side, 'R') || 'T' || case when k % 2 = 0 then ' ≥' || ft || '''' else '' end as hold,
       '≤' || (150 + k % 100) || ' KIAS' || case when k % 2 = 0 then ' until ' || ft || '''' else '' end as speed,
       'VCOA (≥' || ft || '''' || case when k % 2 = 0 and length('VCOA (≥' || ft || ''' ' || case when k % 4 = 0 then 'SE' else 'N' end || ' bound)') <= 22 then ' ' || case when k % 4 = 0 then 'SE' else 'N' end || ' bound' else '' end || ')' as vcoa,
       coalesce(side || 'T ', '') || 'hdg ' || h || '° CW ' || e || '°|or ' || e || '° CCW ' || h || '°' || case when k % 2 = 0 then '|' || ft || '''' else '' end as sectors,
       case side when 'L' then 'climbing left turn ' when 'R' then 'climbing right turn ' else '' end || 'heading ' || h || case when k % 2 = 0 then ' to ' || ft else '' end as heading,
       'ABC R-' || e || case when k % 2 = 0 then ' outbound' else ' inbound' end as radial from p"""
)
def label_phrases(spark, sf_dir):
    k = F.col("p_partkey")
    even, feet = k % 2 == 0, 1000 + k % 120 * 100
    ends = F.when(even, text("≥", feet, "'"))
    sector = lambda a, cw, b: F.struct((a % 360).alias("start"), F.lit(cw).alias("clockwise"), (b % 360).alias("end"))
    phrases = labels.heading_range(F.array(sector(k, True, k * 7), sector(k * 7, False, k)), sided(k), F.when(even, text(feet, "'")))
    bound = F.when(k % 4 == 0, "SE").when(even, "N")
    return table(spark, sf_dir, "part").select(
        k.alias("k"), labels.hold(k % 360, F.coalesce(sided(k), F.lit("R")), ends).alias("hold"),
        labels.speed(150 + k % 100, F.when(even, text("reaching ", feet, " MSL")).otherwise("established on course")).alias("speed"),
        labels.visual_climb(text("≥", feet, "'"), bound).alias("vcoa"), F.array_join(phrases, "|").alias("sectors"),
        labels.leg_name(sided(k), labels.heading_phrase(k % 360, F.when(even, feet))).alias("heading"), labels.radial_phrase(F.lit("ABC"), k * 7 % 360, even).alias("radial"),
    )


@query(
    """select p_partkey as k, 'ODP NOT SHOWN|' || case when p_partkey % 2 = 0 then 'RWY ' || a || ', VCOA' else 'RWY ' || a || 'L/' || a || 'R/' || b || 'L/' || b || 'R/|' || a || 'C, VCOA' end as lines from (select *, 10 + p_partkey % 20 as a, 30 + p_partkey % 6 as b from part)"""
)
def not_shown_labels(spark, sf_dir):
    k = F.col("p_partkey")
    a, b = 10 + k % 20, 30 + k % 6
    long = labels.part_name(F.array(text(a, "L"), text(a, "R"), text(b, "L"), text(b, "R"), text(a, "C")))
    short = labels.part_name(F.array(text(a)))
    named = F.when(k % 2 == 0, F.array(short, F.lit("VCOA"), short)).otherwise(F.array(long, F.lit("VCOA")))
    return table(spark, sf_dir, "part").select(k.alias("k"), F.array_join(labels.not_shown(named), "|").alias("lines"))


def visual_sections(spark, sf_dir):
    """A section per order, of one or two lines: runways or all of them, an airport or a fix, a direction, a limit of speed, or a word too many."""
    k = F.col("o_orderkey")
    approval = ", obtain ATC approval for VCOA when requesting IFR clearance. "
    crossing = F.when(k % 3 == 0, text("ABCDE ")).when(k % 3 == 1, "Elk River Muni airport southeast bound ").otherwise("Elk River/Bend Fld airport ")
    route = F.when(k % 2 == 0, text(" direct ELK VORTAC, continue climb in ELK holding pattern (NE, RT, ", F.lpad(k % 360, 3, "0"), "° inbound) to ", 9000 + k % 9 * 100)).otherwise(" before proceeding on course")
    one = text(F.when(k % 5 == 0, "All runways").otherwise("Rwys 4, 13L/R"), approval, F.when(k % 7 == 0, "Slowly climb").otherwise("Climb"), " in visual conditions to cross ", crossing, "at or above ", 5000 + k % 50 * 100, route, ".", F.when(k % 4 == 1, " Do not exceed 180 KIAS until reaching 9000 MSL.").otherwise(""))
    two = F.when(k % 4 == 3, text("\nRwy 22", approval, "Climb in visual conditions to cross Elk River airport at or above 8000 before proceeding east.", F.when(k % 8 == 3, " Do not exceed 200 KIAS.").otherwise(""))).otherwise("")
    return spread(table(spark, sf_dir, "orders").select("o_orderkey")).select(k.alias("block"), F.concat(one, two).alias("vcoa"))


SQL_AGREES = "abs((45 - k % 360 + 360) % 360 - 180) <= 30"


@query(
    f"""with o as (select o_orderkey as k from orders)
    select k as block, 0 as line, case when k % 5 = 0 then '' else '4,13L,13R' end as runways, case when k % 3 = 0 then 'ABCDE' end as cross_fix, case when k % 3 = 1 then 'southeast' end as bound, cast(5000 + k % 50 * 100 as int) as feet, case when k % 4 = 1 then 180 end as kias,
       case when k % 4 = 1 then 'reaching 9000 MSL' end as until_phrase, case when k % 2 = 0 then 'Direct,ClimbInHold' else 'ProceedOnCourse' end as nodes from o where k % 7 > 0 and (k % 2 = 1 or {SQL_AGREES})
    union all select k, 1, '22', null, null, 8000, null, null, 'ProceedOnCourse' from o where k % 8 = 7"""
)
def visual_climb_sections(spark, sf_dir):
    climbs, _ = visual_climbs.read(visual_sections(spark, sf_dir))
    nodes = F.array_join(F.transform("legs", lambda x: x["leg"]["node"]), ",")
    return climbs.select("block", "line", F.array_join("runways", ",").alias("runways"), F.col("cross").alias("cross_fix"), "bound", "feet", "kias", "until_phrase", nodes.alias("nodes"))


@query(
    f"""with o as (select o_orderkey as k from orders)
    select k as block, 0 as line, 'hold side contradicts its inbound course' as failure from o where k % 2 = 0 and k % 7 > 0 and not ({SQL_AGREES})
    union all select k, 0, 'unmatched' from o where k % 7 = 0 union all select k, 1, 'speed limit after several visual climbs' from o where k % 8 = 3"""
)
def visual_climb_failures(spark, sf_dir):
    _, failures = visual_climbs.read(visual_sections(spark, sf_dir))
    return failures.select("block", "line", F.regexp_replace("signature", "^(unmatched) phrase.*", "$1").alias("failure"))


@query(
    f"""with o as (select o_orderkey as k from orders)
    select k as block, 0 as line, case k % 4 when 0 then 'Unrouted' when 1 then 'Unrouted' when 2 then 'ClimbHeading,ProceedOnCourse' else '' end as nodes, case k % 4 when 2 then 'east/south' end as toward, k % 4 = 2 as flies,
       case when k % 4 = 3 then 'unsupported routing "then westbound on"' end as failure from o"""
)
def unrouted_groups(spark, sf_dir):
    """Groups without a route, of two directions, and along an airway."""
    k = F.col("o_orderkey")
    bodies = F.array(F.lit("left turn on departure NA."), F.lit("diverse departures NA, use RADAR vectors or published departure procedures for obstacle avoidance."), F.lit("climb heading 090° to 4000 before proceeding east or south bound."), F.lit("climb heading 090° to 4000, then westbound on V326 to GINNA."))
    rows = procedures.groups(table(spark, sf_dir, "orders").select(k.alias("block"), text("Rwy 4, ", F.element_at(bodies, (k % 4 + 1).cast("int"))).alias("text")))
    each = procedures.legs(rows, check_holds=True)
    one = F.transform(F.array_sort(F.collect_list(F.struct("seq", F.struct("leg").alias("step")))), lambda x: x["step"])
    read = each.groupBy("block", "line").agg(one.alias("legs"), F.max("signature").alias("failure"), F.max(F.concat_ws("/", "leg.toward", "leg.toward_or")).alias("toward"))
    ok = F.col("failure").isNull()
    nodes = F.when(ok, F.array_join(F.transform("legs", lambda x: x["leg"]["node"]), ",")).otherwise("")
    return read.select("block", "line", nodes.alias("nodes"), F.when(ok, F.nullif(F.col("toward"), F.lit(""))).alias("toward"), (ok & parts.flies(F.col("legs"))).alias("flies"), "failure")
