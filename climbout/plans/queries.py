"""Queries of the engine over the driver's tables, each with the SQL that must give the same rows.

Texts, coordinates and courses are derived from keys, so the SQL can state the expected values plainly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import cycles, geodesy, runways, signatures, spelling
from ..operators import blocks, facilities, procedures, reports

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixed value: tasks for each core where rows of much work are dealt.
TASKS_A_CORE = 4


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows dealt over all cores (by keys, if any), several tasks each: a file of one row group is read by one task, into however many splits it is cut."""
    return rows.repartition(TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism, *keys)


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def r6(c: Column) -> Column:
    """Six decimals, without a negative zero."""
    return F.round(c, 6) + F.lit(0.0)


SQL_DIST = "2 * 3440.065 * atan2(sqrt(h), sqrt(1 - h))"


def sql_h(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"


# --- findings and reports ------------------------------------------------------------------------


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as findings: kind, airport and a text that names the airport, a facility and numbers."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    airport = F.concat(F.lit("K"), F.substring(F.upper("event_type"), 1, 2), F.pmod(k, F.lit(7)).cast("string"))
    words = F.element_at(F.array(*[F.lit(x) for x in ("navaid ABC not found near", "radial R-210 of VOR XYZ behind", "unmatched phrase at")]), (F.pmod(k, F.lit(3)) + 1).cast("int"))
    return e.select(k.alias("seq"), F.col("event_type").alias("kind"), airport.alias("airport"), text(words, " ", airport, "  to ", F.pmod(k, F.lit(5)) * 1111).alias("signature"))


SQL_FINDINGS = """findings as (
    select event_id as seq, event_type as kind, 'K' || upper(event_type[1:2]) || (event_id % 7) as airport,
           ['navaid ABC not found near', 'radial R-210 of VOR XYZ behind', 'unmatched phrase at'][event_id % 3 + 1] as words, event_id
    from events),
keyed as (
    select *, ['navaid id not found near', 'radial r-nnn of vor id behind', 'unmatched phrase at'][event_id % 3 + 1] || ' id to '
              || (case when event_id % 5 = 0 then 'n' else 'nnnn' end) as sig,
           words || ' ' || airport || '  to ' || (event_id % 5) * 1111 as signature
    from findings)"""


@query("select event_type as kind, count(*) as findings from events group by 1")
def findings_by_kind(spark, sf_dir):
    return reports.by_kind(findings(spark, sf_dir))


@query(
    f"""with {SQL_FINDINGS}
    select sha1(kind || ':' || sig) as key, kind, count(*) as n, min(seq) as first_seq, arg_min(signature, seq) as signature,
           array_to_string(list_distinct(list(airport)).list_sort(), ',') as airports
    from keyed group by 1, 2"""
)
def findings_report(spark, sf_dir):
    out = reports.grouped(findings(spark, sf_dir))
    return out.withColumn("airports", F.array_join(F.array_sort(F.array_distinct("airports")), ","))


@query(
    f"""with {SQL_FINDINGS}, g as (select sig, count(*) as n, min(seq) as first_seen from keyed group by 1)
    select sig, n, first_seen from g order by n desc, first_seen limit 20"""
)
def top20_signatures(spark, sf_dir):
    f = findings(spark, sf_dir).withColumn("sig", signatures.finding_signature(F.col("signature"), F.col("airport")))
    return reports.top(f, "sig", "seq")


@query(
    """with t as (
        select o_orderpriority as name, count(*) filter (o_orderstatus = 'F') as drawn, count(*) as textual,
               count(*) filter (o_orderkey % 9 = 0) as findings, count(distinct o_custkey % 50) as signatures,
               count(*) filter (o_orderkey % 20 = 0) as partial, count(*) filter (o_orderkey % 31 = 0) as graphic_only
        from orders group by 1)
    select *, 'Drew ' || format('{:,}', drawn) || ' of ' || format('{:,}', textual) || ' ODPs (' || cast(round_even(100.0 * drawn / textual, 0) as int) || '%'
           || case when partial > 0 then ', ' || format('{:,}', partial) || ' in part' else '' end || '); ' || format('{:,}', findings) || ' findings in '
           || format('{:,}', signatures) || ' signatures'
           || case when graphic_only > 0 then '; ' || format('{:,}', graphic_only) || ' airports use only charted DPs' else '' end as line
    from t"""
)
def report_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    n = lambda c: F.count_if(c)
    k = F.col("o_orderkey")
    totals = o.groupBy(F.col("o_orderpriority").alias("name")).agg(
        n(F.col("o_orderstatus") == "F").alias("drawn"), F.count("*").alias("textual"), n(k % 9 == 0).alias("findings"),
        F.count_distinct(F.col("o_custkey") % 50).alias("signatures"), n(k % 20 == 0).alias("partial"), n(k % 31 == 0).alias("graphic_only"),
    )
    return reports.summary(totals)


@query(
    """with g as (select user_id as key, 'body ' || count(*) as body from events where event_id % 2 = 0 group by 1),
    i as (select user_id as key, min(event_id) as number, 'body ' || (count(*) + user_id % 2) as body from events where event_id % 2 = 1 group by 1)
    select coalesce(g.key, i.key) as key, number,
           case when number is null then 'create' when g.body is null then 'close' when g.body = i.body then 'unchanged' else 'update' end as action
    from g full join i on g.key = i.key"""
)
def issue_merge_actions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    g = e.where("event_id % 2 = 0").groupBy(F.col("user_id").alias("key")).agg(text("body ", F.count("*")).alias("body"))
    i = e.where("event_id % 2 = 1").groupBy(F.col("user_id").alias("key")).agg(F.min("event_id").alias("number"), text("body ", F.count("*") + F.col("user_id") % 2).alias("body"))
    return reports.issue_actions(g, i)


@query(
    """with s as (
        select user_id, event_id % 2 as half, bool_or(event_type = 'purchase') as drawn, md5(cast(max(event_id) // 200 as varchar)) as digest, count(*) filter (event_type = 'error') as findings
        from events group by 1, 2),
    j as (select coalesce(b.user_id, a.user_id) as user_id, b.drawn bd, a.drawn ad, b.digest bg, a.digest ag, b.findings bf, a.findings af
          from (select * from s where half = 0) b full join (select * from s where half = 1) a on b.user_id = a.user_id),
    c as (select user_id, case when coalesce(ad, false) and not coalesce(bd, false) then 'gained' when coalesce(bd, false) and not coalesce(ad, false) then 'lost'
                 when bd and ad and bg is distinct from ag then 'redrawn' when bd is not null and ad is not null and bf is distinct from af then 'findings_changed' end as change from j)
    select * from c where change is not null"""
)
def snapshot_diff(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    half = lambda n: e.where(F.col("event_id") % 2 == n).groupBy("user_id").agg(
        F.bool_or(F.col("event_type") == "purchase").alias("drawn"), F.md5(F.floor(F.max("event_id") / 200).cast("string").cast("binary")).alias("digest"), F.count_if(F.col("event_type") == "error").alias("findings"),
    )
    return reports.snapshot_diff(half(0), half(1), "user_id")


@query(
    """select case when d and not p then 'whole' when d then 'part' when c then 'charted' else 'not drawn' end as outcome, count(*) as n
    from (select o_orderstatus = 'F' as d, o_orderkey % 4 = 0 as p, o_orderkey % 3 = 0 as c from orders) group by 1"""
)
def outcome_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.groupBy(reports.outcome(F.col("o_orderstatus") == "F", k % 4 == 0, k % 3 == 0).alias("outcome")).agg(F.count("*").alias("n"))


# --- text ----------------------------------------------------------------------------------------


@query(
    r"""select o_orderkey, 'climb heading ' || lpad(cast(o_orderkey % 360 as varchar), 3, '0') || '° to ' || (10000 + o_orderkey % 9 * 1000)
        || ' and ABC VORTAC R-' || lpad(cast(o_orderkey % 360 as varchar), 3, '0') || ' outbound... do not exceed ' || (150 + o_orderkey % 90) || ' KIAS, with a min. climb of '
        || (200 + o_orderkey % 300) || ' ft per NM to cross XYZ VOR/DME at or above ' || (5000 + o_orderkey % 7 * 100) || ', climb on course. Visibility 2 3/4 for VCOA of VOR' || chr(10) || chr(10) || 'before proceeding on course.' as spelled
    from orders"""
)
def normalize_text(spark, sf_dir):
    k = F.col("o_orderkey")
    deg = F.lpad((k % 360).cast("string"), 3, "0")
    raw = text(
        "  climb heading", deg, ".00º to  ", F.format_number(10000 + k % 9 * 1000, 0), "' and ABC VORTAC r- ", deg, " outbound. . . . do not exceed ", 150 + k % 90, " knots, w/ min climb of ",
        200 + k % 300, "’ per NM to cross XYZ VOR/ DME at/above ", 5000 + k % 7 * 100, "', continue climbing on course.. Visibility 2¾ for VOCA of of VOR \n\n \n\n before preceding on course.\t",
    )
    return spread(table(spark, sf_dir, "orders").select("o_orderkey")).select("o_orderkey", spelling.normalize(raw).alias("spelled"))


@query(
    r"""select token, count(*) as n from (
        select unnest(regexp_extract_all(o_orderpriority || ' R-' || o_custkey || ' to ' || o_totalprice || 'ft ... (NA)', '(\.\.\.|R-[0-9]+|[0-9]+(?:\.[0-9]+)?[A-Za-z]*|[A-Za-z][A-Za-z0-9]*|\S)', 1)) as token from orders)
    group by 1"""
)
def token_counts(spark, sf_dir):
    """Tokens of a line of every order."""
    line = text(F.col("o_orderpriority"), " R-", F.col("o_custkey"), " to ", F.col("o_totalprice"), "ft ... (NA)")
    return table(spark, sf_dir, "orders").select(F.explode(signatures.tokens(line)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))



@query(
    """select p_partkey, 'rwy <n>, climb <id> vortac r-<n> to <n>' || case when p_partkey % 2 = 0 then ' ndb' else ' <id>' end as signature,
       p_partkey % 2 <> 0 as names from part"""
)
def phrase_signatures(spark, sf_dir):
    k = F.col("p_partkey")
    word = F.when(k % 2 == 0, "NDB").otherwise("QRS")
    phrase = text("Rwy ", k % 36 + 1, ", climb  QVX VORTAC R-", k % 360, " to ", k * 10, " ", word)
    return table(spark, sf_dir, "part").select("p_partkey", signatures.phrase_signature(phrase).alias("signature"), signatures.is_ident_word(word).alias("names"))


@query(
    """with p as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n from documents),
    f as (select *, lag(line) over w as before from p window w as (partition by doc_id order by n)),
    g as (select *, sum(case when before is null or regexp_matches(before, '[.:]$') and regexp_matches(line, '^(A|The|And|Of)( |$)') then 1 else 0 end) over (partition by doc_id order by n) as line_id from f)
    select doc_id, line_id, string_agg(line, ' ' order by n) as text from g group by 1, 2"""
)
def logical_lines(spark, sf_dir):
    """Gaps and islands: a line goes on unless a sentence ended and it opens with an item word."""
    p = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    w = Window.partitionBy("doc_id").orderBy("n")
    before = F.lag("line").over(w)
    fresh = F.when(before.isNull(), 1).when(before.rlike(r"[.:]\z") & F.col("line").rlike(r"^(A|The|And|Of)( |\z)"), 1).otherwise(0)
    g = p.withColumn("fresh", fresh).withColumn("line_id", F.sum("fresh").over(w))
    return g.groupBy("doc_id", "line_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), " ").alias("text"))


BLOCK_LINES = ("RENO, NV", "AIRPORT {k} ({lid})", "TAKEOFF MINIMUMS AND (OBSTACLE) DEPARTURE PROCEDURES", "AMDT {a} 17AUG17 (17229) (FAA)", "TAKE-OFF MINIMUMS: Rwy 4, std. with a min.", "climb of {g} ft per NM to {t}.", "DEPARTURE PROCEDURE:", "Rwy 4, climb heading 0{h}° to {t}", "before turning.", "L5", "TAKEOFF OBSTACLE NOTES: Rwy 4, trees {k} from DER.")


@query(
    """select 'K' || lpad(cast(c_custkey % 1000 as varchar), 3, '0') as lid, c_custkey // 1000 as volume, 'AMDT ' || (c_custkey % 9) || ' 17AUG17 (17229) (FAA)' as amendment,
       'Rwy 4, std. with a min. climb of ' || (200 + c_custkey % 300) || ' ft per NM to ' || (3000 + c_custkey % 50 * 100) || '.' as takeoff_minimums,
       'Rwy 4, climb heading 0' || (10 + c_custkey % 80) || '° to ' || (3000 + c_custkey % 50 * 100) || ' before turning.' as departure_procedure,
       'Rwy 4, trees ' || c_custkey || ' from DER.' as obstacle_notes, cast(c_custkey % 1000 // 2 as int) as page
    from customer"""
)
def airport_blocks(spark, sf_dir):
    """Pages of two airports each, through all line and section operators, and back to one row per airport."""
    return blocks_of(spread(table(spark, sf_dir, "customer").select("c_custkey")))



def blocks_of(customers: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    values = {"{k}": k, "{lid}": text("K", F.lpad((k % 1000).cast("string"), 3, "0")), "{a}": k % 9, "{g}": 200 + k % 300, "{t}": 3000 + k % 50 * 100, "{h}": 10 + k % 80}
    lines = []
    for line in BLOCK_LINES:
        c = F.lit(line)
        for name, value in values.items():
            c = F.replace(c, F.lit(name), value.cast("string"))
        lines.append(c)
    one = customers.select(F.expr("c_custkey div 1000").alias("volume"), F.expr("cast((c_custkey % 1000) div 2 as int)").alias("page"), k.alias("k"), F.array_join(F.array(*lines), "\n").alias("text"))
    pages = one.groupBy("volume", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "\n").alias("text"))
    out = blocks.blocks(pages)
    return out.select("lid", "volume", "amendment", "takeoff_minimums", "departure_procedure", "obstacle_notes", F.col("pages")[0].alias("page"))


@query(
    """with t as (select *, sum(case when role = 'user' then 1 else 0 end) over (partition by conv_id order by turn rows unbounded preceding) as entry from conversations)
    select conv_id, entry, min(turn) as first_turn, count(*) as turns, arg_min(text, turn) as heading from t where entry > 0 group by 1, 2"""
)
def entries_carried_forward(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    t = table(spark, sf_dir, "conversations").withColumn("entry", F.sum(F.when(F.col("role") == "user", 1).otherwise(0)).over(w))
    return t.where("entry > 0").groupBy("conv_id", "entry").agg(F.min("turn").alias("first_turn"), F.count("*").alias("turns"), F.min_by("text", "turn").alias("heading"))


@query("select user_id, max(event_id) as event_id, arg_max(event_type, event_id) as event_type from events group by 1")
def dedupe_last_wins(spark, sf_dir):
    return facilities.last_wins(table(spark, sf_dir, "events"), ["user_id"], [F.col("event_id")]).select("user_id", "event_id", "event_type")


@query(
    """with t as (select event_id, user_id, event_type, case when event_id % 3 = 0 then value > 50 end as sense from events),
    f as (select *, case when lag(event_type) over w is distinct from event_type then 1 else 0 end as fresh from t window w as (partition by user_id order by event_id)),
    i as (select *, sum(fresh) over (partition by user_id order by event_id) as island from f)
    select event_id, first_value(sense ignore nulls) over (partition by user_id, island order by event_id rows between current row and unbounded following) as sense from i"""
)
def radial_sense_backfill(spark, sf_dir):
    """Events as legs: an unstated sense is that of the next leg on the same radial."""
    sense = F.when(F.col("event_id") % 3 == 0, F.col("value") > 50)
    leg = F.struct(F.col("event_type").alias("ident"), F.lit(0).alias("radial"), sense.alias("sense"))
    legs = table(spark, sf_dir, "events").select(F.col("user_id").alias("block"), F.lit(0).alias("line"), F.col("event_id").alias("seq"), leg.alias("leg"))
    return procedures.carry_senses(legs).select(F.col("seq").alias("event_id"), "sense")


@query(
    """with t as (select user_id, event_id, event_type, lag(event_type) over (partition by user_id order by event_id) as before from events)
    select path, count(*) as n from (select user_id, string_agg(event_type, ' | ' order by event_id) as path from t where before is distinct from event_type group by 1) group by 1"""
)
def cluster_by_sequence(spark, sf_dir):
    return reports.paths(table(spark, sf_dir, "events"), "user_id", "event_id", "event_type")


# --- runways, gradients, cycles ------------------------------------------------------------------


@query(
    """select l_orderkey, l_linenumber, case when l_partkey % 3 = 2 then 'H' || (l_partkey % 10) else lpad(cast(l_partkey % 36 + 1 as varchar), 2, '0') || (case l_partkey % 3 when 0 then 'L' else '' end) end as runway from lineitem"""
)
def runway_id_canonical(spark, sf_dir):
    k = F.col("l_partkey")
    raw = F.when(k % 3 == 2, text("h", k % 10)).otherwise(text(k % 36 + 1, F.when(k % 3 == 0, "l").otherwise("")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", runways.canonical(raw).alias("runway"))


@query(
    """select p_partkey, (p_partkey % 36 + 1) || 'L,' || (p_partkey % 36 + 1) || 'R,' || (p_size % 36 + 1) as runways from part"""
)
def runway_list_expand(spark, sf_dir):
    raw = text(F.col("p_partkey") % 36 + 1, "L/R, ", F.col("p_size") % 36 + 1)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(runways.expand(raw), ",").alias("runways"))


@query(
    """select p_partkey, cast(p_partkey % 17 + 1 as varchar) as runway, cast(200 + p_partkey % 300 as double) as ft_per_nm, case when p_partkey % 2 = 0 then cast(3000 + p_size * 100 as int) end as to_ft from part
    union all select p_partkey, cast(p_partkey % 17 + 19 as varchar), cast(200 + p_partkey % 300 as double), case when p_partkey % 2 = 0 then cast(3000 + p_size * 100 as int) end from part"""
)
def min_climb_gradients(spark, sf_dir):
    k = F.col("p_partkey")
    line = text("Rwys 36, NA - ATC. Rwys ", k % 17 + 1, ", ", k % 17 + 19, ", std. with a min. climb of ", 200 + k % 300, " ft per NM", F.when(k % 2 == 0, text(" to ", 3000 + F.col("p_size") * 100)).otherwise(""), ".")
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(runways.gradients(line)).alias("g")).select("p_partkey", "g.*")


@query(
    """select p_partkey, case when p_partkey % 3 = 0 or p_partkey % 5 = 1 then 'Rwy 4, do not exceed 210 KIAS until established.' when p_partkey % 3 = 1 then 'All aircraft 180K.' end as line from part"""
)
def speed_limit_binding(spark, sf_dir):
    k = F.col("p_partkey")
    lines = text("Rwy 4, do not exceed 210 KIAS until established.", F.when(k % 3 == 1, "\nAll aircraft 180K.").otherwise("\nRwy 9, 180 NM."))
    flown = F.when(k % 5 == 1, F.expr("cast(array() as array<string>)")).when(k % 3 == 0, F.array(F.lit("4"), F.lit("22"))).otherwise(F.array(F.lit("22")))
    return table(spark, sf_dir, "part").select("p_partkey", runways.speed_limit(lines, flown).alias("line"))


@query(
    """with t as (select distinct cast(o_orderdate as date) as day from orders),
    c as (select day, date '2020-12-03' + cast(28 * floor(date_diff('day', date '2020-12-03', day) / 28.0) as int) as effective from t),
    j as (select *, date '2020-12-03' + cast(28 * ceil(date_diff('day', date '2020-12-03', cast(date_trunc('year', effective) as date)) / 28.0) as int) as first from c)
    select day, effective, effective + 28 as following, strftime(effective, '%y') || lpad(cast(date_diff('day', first, effective) // 28 + 1 as varchar), 2, '0') as code, strftime(effective, '%d_%b_%Y') as tag from j"""
)
def cycle_calendar(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    t = table(spark, sf_dir, "orders").select(day.alias("day")).distinct().withColumn("effective", cycles.checked(cycles.containing(F.col("day"))))
    e = F.col("effective")
    return t.select("day", "effective", cycles.following(e).alias("following"), cycles.code(e).alias("code"), cycles.tag(e).alias("tag"))


# --- joins ---------------------------------------------------------------------------------------


def places(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """(id, lat, lon): pseudo positions from keys."""
    k = F.col(key)
    return table(spark, sf_dir, name).select(k.alias("id"), (30 + (k * 37 % 1000) / 100.0).alias("lat"), (-120 + (k * 91 % 2000) / 100.0).alias("lon"))


SQL_PLACE = "30 + ({k} * 37 % 1000) / 100.0 as lat, -120 + ({k} * 91 % 2000) / 100.0 as lon"


@query(
    f"""with a as (select c_custkey as id, {SQL_PLACE.format(k='c_custkey')} from customer), b as (select s_suppkey as id, {SQL_PLACE.format(k='s_suppkey')} from supplier),
    d as (select a.id as ref_id, b.id as c_id, {sql_h('a.lat', 'a.lon', 'b.lat', 'b.lon')} as h from a join b on a.id % 10 = b.id % 10),
    n as (select ref_id, count(*) as matches, min(c_id) as c_id from d where {SQL_DIST} <= 150 group by 1)
    select a.id as ref_id, coalesce(matches, 0) as matches, case when matches = 1 then c_id end as c_id,
           case when matches is null then 'navaid not found' when matches > 1 then 'navaid ambiguous' end as failure
    from a left join n on a.id = n.ref_id"""
)
def resolve_exactly_one(spark, sf_dir):
    key = (F.col("id") % 10).alias("key")
    refs = places(spark, sf_dir, "customer", "c_custkey").select(F.col("id").alias("ref_id"), "lat", "lon", key)
    cand = places(spark, sf_dir, "supplier", "s_suppkey").select(F.col("id").alias("c_id"), F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"), key)
    return facilities.resolve_one(refs, cand, ["key"], "navaid")


@query(
    f"""with a as (select c_custkey as id, {SQL_PLACE.format(k='c_custkey')} from customer),
    d as (select a.id as a, b.id as b, {sql_h('a.lat', 'a.lon', 'b.lat', 'b.lon')} as h from a join a b on a.id < b.id)
    select a, b, round({SQL_DIST}, 6) as nm from d where {SQL_DIST} <= 40"""
)
def neighbour_pairs(spark, sf_dir):
    points = places(spark, sf_dir, "customer", "c_custkey")
    return facilities.neighbours(points, 40.0, digits=6)



@query(None)
def greedy_palette(spark, sf_dir):
    points = places(spark, sf_dir, "supplier", "s_suppkey")
    return reports.colour_members(*facilities.linked_places(points, 40.0))


@query(
    """with a as (select 'A' || s_suppkey as lid, case when s_suppkey % 3 = 0 then 'K' || s_suppkey end as icao from supplier),
    r as (select c_custkey, case c_custkey % 4 when 0 then 'A' || k when 1 then 'K' || k when 2 then 'KA' || k else 'ZZ' || k end as ident from (select c_custkey, c_custkey // 10 as k from customer))
    select c_custkey, ident, coalesce(x.lid, y.lid, z.lid) as lid, case when x.lid is not null then 'lid' when y.lid is not null then 'icao' when z.lid is not null then 'without_k' end as found_by
    from r left join a x on ident = x.lid left join a y on length(ident) = 4 and ident = y.icao left join a z on length(ident) = 4 and ident = 'K' || z.lid"""
)
def airport_lookup_fallback(spark, sf_dir):
    """An airport of every supplier, ids from whole keys; only idents of four letters are ICAO ids."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    airports = table(spark, sf_dir, "supplier").select(text("A", s).alias("lid"), F.when(s % 3 == 0, text("K", s)).alias("icao"), s.alias("seq"))
    head = F.element_at(F.array(*[F.lit(x) for x in ("A", "K", "KA", "ZZ")]), (c % 4 + 1).cast("int"))
    refs = table(spark, sf_dir, "customer").select("c_custkey", text(head, F.expr("c_custkey div 10")).alias("ident"))
    return facilities.find_airport(refs, airports).select("c_custkey", "ident", "lid", "found_by")



@query(
    """select a.l_orderkey as lid, a.l_linenumber as end_id, min(b.l_linenumber) as reciprocal_id from lineitem a join lineitem b
    on a.l_orderkey = b.l_orderkey and (a.l_linenumber + 1) // 2 = (b.l_linenumber + 1) // 2 and a.l_linenumber <> b.l_linenumber group by 1, 2"""
)
def reciprocal_runway_end(spark, sf_dir):
    ends = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("lid"), F.expr("(l_linenumber + 1) div 2").alias("runway_id"), F.col("l_linenumber").alias("end_id"))
    return facilities.reciprocals(ends, ["lid"]).select("lid", "end_id", "reciprocal_id")


@query(
    """with t as (select c_custkey as hold_id, c_custkey % 40 as fix, case when c_custkey % 3 > 0 then ['L', 'R'][c_custkey % 2 + 1] end as turn, case when c_custkey % 3 > 0 then c_custkey % 4 * 90 end as inbound from customer),
    p as (select distinct s_suppkey % 40 as fix, ['L', 'R'][s_suppkey % 2 + 1] as turn, s_suppkey % 4 * 90 as inbound from supplier),
    j as (select t.*, p.turn as pt, p.inbound as pi from t left join p on t.fix = p.fix),
    g as (select hold_id, fix, turn, inbound, count(pt) as published, coalesce(bool_or(turn = pt and inbound = pi), false) as agrees, min(pt) as pt, min(pi) as pi from j group by 1, 2, 3, 4)
    select hold_id, published, case when turn is null and published = 1 then pt else turn end as turn, case when turn is null and published = 1 then pi else inbound end as inbound,
           case when turn is null and published <> 1 then 'hold ambiguous' when turn is not null and published > 0 and not agrees then 'hold contradicts NASR' end as failure from g"""
)
def hold_agreement(spark, sf_dir):
    side = lambda k: F.when(k % 2 == 0, "L").otherwise("R")
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    texts = table(spark, sf_dir, "customer").select(c.alias("hold_id"), (c % 40).alias("fix"), F.when(c % 3 > 0, side(c)).alias("turn"), F.when(c % 3 > 0, c % 4 * 90).alias("inbound"))
    published = table(spark, sf_dir, "supplier").select((s % 40).alias("fix"), side(s).alias("turn"), (s % 4 * 90).alias("inbound")).distinct()
    return facilities.hold_agreement(texts, published)


@query("select text_hash, count(*) as n, min(doc_id) as first_doc from (select doc_id, md5(text) as text_hash from documents) group by 1 having count(*) > 1")
def duplicate_ids(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("text_hash"))
    return reports.repeated(d, "text_hash", "doc_id").withColumnRenamed("first", "first_doc")


# --- geometry ------------------------------------------------------------------------------------


@query(
    f"""with a as (select c_custkey as id, {SQL_PLACE.format(k='c_custkey')} from customer),
    b as (select id, lat, lon, 35 + (id * 13 % 500) / 100.0 as lat2, -110 + (id * 17 % 900) / 100.0 as lon2 from a),
    h as (select *, {sql_h('lat', 'lon', 'lat2', 'lon2')} as h, degrees(atan2(sin(radians(lon2 - lon)) * cos(radians(lat2)), cos(radians(lat)) * sin(radians(lat2)) - sin(radians(lat)) * cos(radians(lat2)) * cos(radians(lon2 - lon)))) as brg from b),
    m as (select *, (brg + 360) - 360 * floor((brg + 360) / 360) as bearing from h)
    select id, round({SQL_DIST}, 6) as nm, round(bearing, 6) as bearing, round(bearing + 13 - 360 * floor((bearing + 13) / 360), 6) as true_13,
           round((lon2 - lon) * 60 * cos(radians(lat)), 6) as x, round((lat2 - lat) * 60, 6) as y,
           round(degrees(asin(sin(radians(lat)) * cos(60 / 3440.065) + cos(radians(lat)) * sin(60 / 3440.065) * cos(radians(bearing)))), 6) as lat60 from m"""
)
def geodesy_basics(spark, sf_dir):
    k = F.col("id")
    p = places(spark, sf_dir, "customer", "c_custkey").withColumns({"lat2": 35 + (k * 13 % 500) / 100.0, "lon2": -110 + (k * 17 % 900) / 100.0})
    at = [F.col(c) for c in ("lat", "lon", "lat2", "lon2")]
    b = geodesy.bearing(*at)
    return p.select(
        "id", r6(geodesy.distance(*at)).alias("nm"), r6(b).alias("bearing"), r6(geodesy.to_true(b, F.lit(13.0))).alias("true_13"),
        r6(geodesy.plane_x(at[0], at[1], at[3])).alias("x"), r6(geodesy.plane_y(at[0], at[2])).alias("y"), r6(geodesy.destination(at[0], at[1], b, F.lit(60.0))["lat"]).alias("lat60"),
    )


@query(
    """with t as (select p_partkey as id, p_partkey * 7 % 360 as c, p_partkey * 13 % 360 as t, case when p_partkey % 2 = 0 then 'R' else 'L' end as side from part),
    s as (select *, (t - c + 360) % 360 as r from t), d as (select *, case when side = 'R' then r when r > 0 then r - 360 else 0 end as turn from s),
    n as (select *, greatest(cast(ceil(abs(turn) / 5.0) as int), 1) as n, case when turn < 0 then -1 else 1 end as sg, greatest(150.0 * 150 / (68626 * tan(radians(25))), 150 / 188.5) as radius from d),
    p as (select *, unnest(generate_series(0, n)) as i from n)
    select id, cast(i as int) as i, round(radius * sin(radians(c + 90 * sg)) + radius * sin(radians(c - 90 * sg + turn * i / cast(n as double))), 6) + 0.0 as x,
           round(radius * cos(radians(c + 90 * sg)) + radius * cos(radians(c - 90 * sg + turn * i / cast(n as double))), 6) + 0.0 as y from p"""
)
def turn_arc_points(spark, sf_dir):
    k = F.col("p_partkey")
    p = spread(table(spark, sf_dir, "part").select("p_partkey")).select(k.alias("id"), (k * 7 % 360).cast("double").alias("c"), (k * 13 % 360).cast("double").alias("t"), F.when(k % 2 == 0, "R").otherwise("L").alias("side"))
    turn = geodesy.signed_turn(F.col("c"), F.col("t"), F.col("side"))
    zero = F.lit(0.0)
    arc = geodesy.turn_arc(zero, zero, F.col("c"), turn, geodesy.turn_radius(F.lit(150.0), F.lit(25.0)))
    return p.select("id", F.posexplode(arc).alias("i", "p")).select("id", "i", r6(F.col("p.x")).alias("x"), r6(F.col("p.y")).alias("y"))


@query(
    """select p_partkey, round((greatest(least(cast(to_ft as double), top) - 500, 0)) / g + greatest(to_ft - greatest(500.0, top), 0) / 200.0, 6) as nm
    from (select p_partkey, 1000 + p_partkey % 90 * 100 as to_ft, case when p_partkey % 3 = 0 then 200.0 else 200.0 + p_partkey % 300 end as g, case when p_partkey % 2 = 0 then 1e9 else 2000.0 + p_size * 50 end as top from part)"""
)
def climb_distance(spark, sf_dir):
    k = F.col("p_partkey")
    nm = geodesy.climb_nm(F.lit(500.0), (1000 + k % 90 * 100).cast("double"), F.when(k % 3 != 0, 200.0 + k % 300), F.when(k % 2 != 0, 2000.0 + F.col("p_size") * 50), F.lit(200.0))
    return table(spark, sf_dir, "part").select("p_partkey", r6(nm).alias("nm"))


@query(
    """with t as (select l_orderkey as k, l_linenumber as n, (l_partkey % 40 - 20) / 10.0 as x0, (l_suppkey % 30 - 15) / 10.0 as y0, (l_partkey % 23 - 11) / 5.0 as dx, (l_partkey % 17 - 8) / 5.0 as dy from lineitem),
    p as (select *, case when dx = 0 then (case when abs(x0) <= 1 then 0.0 else 2.0 end) else least((-1 - x0) / dx, (1 - x0) / dx) end as ex, case when dx = 0 then (case when abs(x0) <= 1 then 1.0 else -1.0 end) else greatest((-1 - x0) / dx, (1 - x0) / dx) end as lx,
                 case when dy = 0 then (case when abs(y0) <= 1 then 0.0 else 2.0 end) else least((-1 - y0) / dy, (1 - y0) / dy) end as ey, case when dy = 0 then (case when abs(y0) <= 1 then 1.0 else -1.0 end) else greatest((-1 - y0) / dy, (1 - y0) / dy) end as ly from t)
    select k, n, round(greatest(least(lx, ly, 1.0) - greatest(ex, ey, 0.0), 0.0) * sqrt(dx * dx + dy * dy), 6) + 0.0 as inside from p"""
)
def segment_box_clip(spark, sf_dir):
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    t = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), ((p % 40 - 20) / 10.0).alias("x0"), ((s % 30 - 15) / 10.0).alias("y0"), ((p % 23 - 11) / 5.0).alias("dx"), ((p % 17 - 8) / 5.0).alias("dy"))
    x0, y0, dx, dy = (F.col(c) for c in ("x0", "y0", "dx", "dy"))
    one = F.lit(1.0)
    return t.select("k", "n", r6(geodesy.clipped_length(x0, y0, x0 + dx, y0 + dy, -one, -one, one, one)).alias("inside"))


@query(
    """with c as (select o_orderkey, unnest(generate_series(0, 7)) as i from orders), p as (select *, round(2 * sin(radians(i * 45)), 6) as x, round(2 * cos(radians(i * 45)), 6) as y from c),
    b as (select l_orderkey, (l_partkey % 50 - 25) / 10.0 as bx, (l_suppkey % 50 - 25) / 10.0 as yy from lineitem),
    k as (select o_orderkey, i, 100 * coalesce(sum(greatest(least(x + 0.5, bx + 0.5) - greatest(x - 0.5, bx - 0.5), 0) * greatest(least(y + 0.3, yy + 0.3) - greatest(y - 0.3, yy - 0.3), 0)), 0) as cost from p left join b on o_orderkey = l_orderkey group by 1, 2)
    select o_orderkey, arg_min(i, {'c': round(cost, 6), 'i': i}) as spot, min(round(cost, 6)) as cost from k group by 1"""
)
def label_argmin(spark, sf_dir):
    """Label candidates against the boxes already there: the least clutter, the first candidate on ties."""
    boxes = table(spark, sf_dir, "lineitem").select("l_orderkey", ((F.col("l_partkey") % 50 - 25) / 10.0).alias("bx"), ((F.col("l_suppkey") % 50 - 25) / 10.0).alias("by"))
    boxes = boxes.groupBy("l_orderkey").agg(F.collect_list(F.struct("bx", "by")).alias("boxes"))
    # an order without boxes costs all candidates one whole overlap, as in the SQL
    none = F.array(F.struct(F.lit(None).cast("double").alias("bx"), F.lit(None).cast("double").alias("by")))

    def candidate(i: int) -> Column:
        x, y = F.round(2 * F.sin(F.radians(F.lit(45.0 * i))), 6), F.round(2 * F.cos(F.radians(F.lit(45.0 * i))), 6)
        area = lambda b: geodesy.box_overlap(x - 0.5, y - 0.3, x + 0.5, y + 0.3, b["bx"] - 0.5, b["by"] - 0.3, b["bx"] + 0.5, b["by"] + 0.3)
        total = F.aggregate(F.coalesce("boxes", none), F.lit(0.0), lambda sum_, b: sum_ + area(b))
        return F.struct(F.round(100 * total, 6).alias("cost"), F.lit(i).cast("long").alias("i"))

    # the boxes of an order are gathered once; its candidates are columns, not rows
    best = F.array_min(F.array(*[candidate(i) for i in range(8)]))
    found = table(spark, sf_dir, "orders").join(boxes, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", best.alias("best"))
    return found.select("o_orderkey", F.col("best.i").alias("spot"), F.col("best.cost").alias("cost"))


@query(
    """select l_partkey, l_suppkey, min(l_orderkey * 10 + l_linenumber) as first_seq, case when count(distinct l_returnflag) = 1 then min(l_returnflag) end as grp, count(*) as n from lineitem group by 1, 2"""
)
def shape_dedupe(spark, sf_dir):
    return reports.shapes_once(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], F.col("l_orderkey") * 10 + F.col("l_linenumber"), "l_returnflag")


@query("select l_orderkey, sha1(string_agg(l_partkey || ':' || l_suppkey, ',' order by l_linenumber, l_partkey || ':' || l_suppkey))[1:12] as digest from lineitem group by 1")
def shape_digest(spark, sf_dir):
    return reports.digests(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", text(F.col("l_partkey"), ":", F.col("l_suppkey")))


@query(
    """select s_suppkey, '<Placemark><name>' || replace(replace(replace(name, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</name><styleUrl>#route-' || (s_suppkey % 6) || '</styleUrl><LineString><coordinates>'
        || printf('%.5f,%.5f', lon, lat) || ' ' || printf('%.5f,%.5f', lon + 0.25, lat + 0.5) || '</coordinates></LineString></Placemark>' as kml
    from (select s_suppkey, s_name || ' <R&D>' as name, -120 + s_suppkey % 97 / 8.0 as lon, 30 + s_suppkey % 89 / 8.0 as lat from supplier)"""
)
def kml_placemarks(spark, sf_dir):
    from ..sources import kml

    k = F.col("s_suppkey")
    lon, lat = -120 + k % 97 / 8.0, 30 + k % 89 / 8.0
    points = F.array(F.struct(lon.alias("lon"), lat.alias("lat")), F.struct((lon + 0.25).alias("lon"), (lat + 0.5).alias("lat")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", kml.line_placemark(F.concat("s_name", F.lit(" <R&D>")), text("route-", k % 6), points).alias("kml"))
