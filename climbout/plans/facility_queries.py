"""Facility files as typed tables, their malformed rows, navaids by type and issues of groups, over tables derived from keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import facilities, reports
from ..sources import facilities as files
from .queries import query, spread, table, text


def navaid_strings(spark, sf_dir) -> DataFrame:
    """A navaid file of strings, a row for every supplier: some without an elevation, some that cannot be typed."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        text("N", k % 40).alias("NAV_ID"), F.when(k % 7 == 0, "VOT").when(k % 2 == 0, "VORTAC").otherwise("NDB").alias("NAV_TYPE"), text(" NAME ", k, " ").alias("NAME"),
        F.when(k % 11 == 0, "").when(k % 13 == 0, "north").otherwise(text(30 + k % 20, ".5")).alias("LAT_DECIMAL"), text("-", 90 + k % 30).alias("LONG_DECIMAL"),
        F.when(k % 5 == 0, " ").otherwise((k % 900).cast("string")).alias("ELEV"), F.when(k % 17 == 0, "a lot").when(k % 3 == 0, "").otherwise((k % 25).cast("string")).alias("MAG_VARN"),
        F.when(k % 4 == 0, "E").otherwise("W").alias("MAG_VARN_HEMIS"),
    )


@query(
    """select 'N' || s_suppkey % 40 as ident, case when s_suppkey % 7 = 0 then 'VOT' when s_suppkey % 2 = 0 then 'VORTAC' else 'NDB' end as type, 'NAME ' || s_suppkey as name,
      30 + s_suppkey % 20 + 0.5::double as lat, -(90 + s_suppkey % 30)::double as lon, case when s_suppkey % 5 > 0 then (s_suppkey % 900)::double end as elevation_ft,
      case when s_suppkey % 3 > 0 then (case when s_suppkey % 4 = 0 then 1 else -1 end * (s_suppkey % 25))::double + 0.0 end as mag_var_east
    from supplier where s_suppkey % 11 > 0 and s_suppkey % 13 > 0 and s_suppkey % 17 > 0"""
)
def typed_navaids(spark, sf_dir):
    good, _ = files.typed(navaid_strings(spark, sf_dir), files.NAVAIDS)
    return good.withColumn("mag_var_east", F.col("mag_var_east") + F.lit(0.0))


@query(
    """select "column", count(*) as n, min(name) as first from (select case when s_suppkey % 11 = 0 or s_suppkey % 13 = 0 then 'lat' when s_suppkey % 17 = 0 then 'mag_var_east' end as "column", ' NAME ' || s_suppkey || ' ' as name from supplier)
    where "column" is not null group by 1"""
)
def malformed_navaids(spark, sf_dir):
    _, bad = files.typed(navaid_strings(spark, sf_dir), files.NAVAIDS)
    return bad.groupBy("column").agg(F.count("*").alias("n"), F.min(F.get_json_object("row", "$.NAME")).alias("first"))


@query(
    """select 'N' || s_suppkey % 40 as ident, count(*) as places, string_agg('NAME ' || s_suppkey, ',' order by 'NAME ' || s_suppkey) as names
    from supplier where s_suppkey % 11 > 0 and s_suppkey % 13 > 0 and s_suppkey % 17 > 0 group by 1"""
)
def places_by_ident(spark, sf_dir):
    """All places that share an ident."""
    good, _ = files.typed(navaid_strings(spark, sf_dir), files.NAVAIDS)
    found = files.by_ident(good.select("ident", "name", "lat", "lon"))
    return found.select("ident", F.size("places").cast("long").alias("places"), F.array_join(F.transform("places", lambda p: p["name"]), ",").alias("names"))


@query(
    """with n as (select s_suppkey % 40 as ident, case when s_suppkey % 7 = 0 then 'VOT' when s_suppkey % 2 = 0 then 'VORTAC' else 'NDB' end as type, 30 + s_suppkey % 20 + 0.5 as lat, -(90 + s_suppkey % 30) as lon,
      case when s_suppkey % 3 > 0 then (case when s_suppkey % 4 = 0 then 1 else -1 end * (s_suppkey % 25))::double end as var from supplier where s_suppkey % 11 > 0 and s_suppkey % 13 > 0 and s_suppkey % 17 > 0),
    r as (select c_custkey as ref_id, c_custkey % 40 as ident, case c_custkey % 3 when 0 then 'VORTAC' when 1 then 'NDB' end as type, 30 + c_custkey % 20 + 0.5 as lat, -(90 + c_custkey % 30) as lon, c_custkey % 9 - 4.0 as own from customer),
    h as (select r.ref_id, r.own, n.type, n.var from r join n on r.ident = n.ident and n.type <> 'VOT' and (r.type is null or r.type = n.type)
      where 2 * 3440.065 * asin(sqrt(pow(sin(radians(n.lat - r.lat) / 2), 2) + cos(radians(r.lat)) * cos(radians(n.lat)) * pow(sin(radians(n.lon - r.lon) / 2), 2))) <= 150)
    select r.ref_id, coalesce(m.n, 0) as matches, case when n = 1 then m.type end as type, case when n = 1 then coalesce(m.var, r.own) + 0.0 end as variation,
      case when n is null then 'navaid not found' when n > 1 then 'navaid ambiguous' end as failure from r left join (select ref_id, count(*) as n, min(type) as type, min(var) as var from h group by 1) m using (ref_id)"""
)
def navaids_by_type(spark, sf_dir):
    """References to navaids: test navaids are none, a stated type must fit, the variation is the navaid's or the airport's."""
    good, _ = files.typed(navaid_strings(spark, sf_dir), files.NAVAIDS)
    k = F.col("c_custkey")
    refs = table(spark, sf_dir, "customer").select(k.alias("ref_id"), text("N", k % 40).alias("ident"), F.when(k % 3 == 0, "VORTAC").when(k % 3 == 1, "NDB").alias("type"), (30 + k % 20 + 0.5).alias("lat"), (-(90 + k % 30)).cast("double").alias("lon"), (k % 9 - 4.0).alias("variation"))
    return facilities.resolve_navaids(refs, good).select("ref_id", "matches", "type", (F.col("variation") + F.lit(0.0)).alias("variation"), "failure")


@query(
    """with f as (select l_orderkey * 8 + l_linenumber as seq, 'kind' || l_linenumber % 3 as kind, 'climb to ' || l_suppkey % 4 || ' feet' as sig, 'A' || l_partkey as airport, l_linestatus as amd, l_returnflag as detail from lineitem),
    k as (select *, sha1(kind || ':' || 'climb to n feet') as key from f),
    n as (select *, row_number() over (partition by key order by airport, seq) as i, count(*) over (partition by key) as n from k)
    select '[odp] ' || any_value(kind) || ': climb to n feet' as title, max(n) as n,
      sha256('<!-- odp-signature: ' || key || ' -->' || chr(10) || chr(10) || 'Cycle 2609, ' || max(n) || ' airports.' || chr(10) || chr(10) || '| Airport | Amendment | Detail |' || chr(10) || '| --- | --- | --- |' || chr(10)
        || string_agg('| ' || airport || ' | ' || amd || ' | ' || detail || ' |', chr(10) order by i) || chr(10) || case when max(n) > 50 then '… and ' || (max(n) - 50) || ' more, see report.json in the release' || chr(10) else '' end || chr(10)
        || string_agg('### ' || airport || chr(10) || '```' || chr(10) || sig || chr(10) || '```' || chr(10), chr(10) order by i)) as body_sha256
    from n where i <= 50 group by key"""
)
def issue_bodies(spark, sf_dir):
    """Titles and bodies of the issues of all groups, each with its first fifty members and the number of the rest."""
    sig = text("climb to ", F.col("l_suppkey") % 4, " feet")
    lines = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_linestatus", "l_returnflag"))
    rows = lines.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), text("kind", F.col("l_linenumber") % 3).alias("kind"), sig.alias("signature"), text("A", F.col("l_partkey")).alias("airport"), F.col("l_linestatus").alias("amendment"), F.col("l_returnflag").alias("detail"), sig.alias("verbatim_text"))
    return reports.issue_texts(rows, "2609").select("title", "n", F.sha2(F.col("body").cast("binary"), 256).alias("body_sha256"))
