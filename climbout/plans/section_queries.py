"""Queries over whole departure sections generated from keys: several sentences a line, alternatives, tails, unread text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import whole_sections
from .queries import query, spread, table, text

FORMS = 12


def sections(spark, sf_dir) -> DataFrame:
    """A section for every customer, in one of FORMS forms, with headings, altitudes and names from the key."""
    k = F.col("c_custkey")
    deg = lambda c: F.lpad((c % 360).cast("string"), 3, "0")
    one = text("Rwy 4, climb heading ", deg(k), "° to ", 2000 + k % 60 * 100)
    two = text("Rwy 22, climb heading ", deg(k * 7), "° to ", 1500 + k % 50 * 100)
    hold = text(" in ABC holding pattern (NE, RT, 236° inbound) to ", 7000 + k % 20 * 100)
    both = text(one, " before turning left. ", two, " before proceeding on course.")
    forms = [
        both,
        text("Rwy 4, climb direct ABC VORTAC. Continue climb", hold, ".\n", two, " before proceeding on course."),
        text("Rwy 4, climb direct ABC VORTAC.\nRwy 22, climb direct XYZ VORTAC. Continue climb", hold, "."),
        text("Rwy 4, climb direct ABC VORTAC. Continue climb", hold, ".\n", two, ". Continue climb", hold, "."),
        text("Rwy 4, climb sideways to ", 2000 + k, ". ", two, " before proceeding on course."),
        text(one, ".\nAvoid mast ", k, ".\n", two, " before proceeding on course."),
        text("Avoid mast ", k, ". ", one, "."),
        text("Rwy 4, climbing right turn thence...\nRwy 22, Climbing left turn heading ", deg(k), "° thence...\n...climb", hold, " before proceeding on course."),
        text(one, ".\nRwy 22, NA - Terrain.\nAll aircraft, proceed direct ABC VORTAC."),
        text(one, " before turning right. Climb heading ", deg(k), "° to ", 9000 + k % 10 * 100, " before turning left."),
        text("Rwy 4, climb heading between 100° CW to 200° from DER to 3000, or climb heading ", deg(k), "° to ", 5000 + k % 9 * 100, ".\n", two, "."),
        text("Rwys 4, 22, left turns on departure NA.\n", two, "."),
    ]
    form = F.lit("")
    for i, f in enumerate(forms):
        form = F.when(k % FORMS == i, f).otherwise(form)
    return spread(table(spark, sf_dir, "customer").select("c_custkey")).select(k.alias("block"), form.alias("text"))


@query(
    """with c as (select c_custkey as k, c_custkey % 12 as f from customer),
    h as (select k, f, cast(k % 360 as int) as deg, cast(k * 7 % 360 as int) as deg7, cast(2000 + k % 60 * 100 as int) as one, cast(1500 + k % 50 * 100 as int) as two, cast(7000 + k % 20 * 100 as int) as hold from c)
    select k as block, '4' as runways, 'ClimbHeading,ProceedOnCourse' as nodes, deg as heading, one as feet from h where f = 0
    union all select k, '22', 'ClimbHeading,ProceedOnCourse', deg7, two from h where f in (0, 1, 4, 5)
    union all select k, '4', 'Direct,ClimbInHold', null, null from h where f in (1, 3)
    union all select k, '22', 'ClimbHeading,ClimbInHold', deg7, two from h where f = 3
    union all select k, '4', '-,Thence', null, null from h where f = 7
    union all select k, '22', 'ClimbHeading,Thence', deg, null from h where f = 7
    union all select k, '', 'ClimbInHold,ProceedOnCourse', null, hold from h where f = 7
    union all select k, '4', 'ClimbHeading,Thence', deg, one from h where f = 8
    union all select k, '22', 'NotAvailable', null, null from h where f = 8
    union all select k, '', 'Direct', null, null from h where f = 8
    union all select k, '4', 'ClimbHeading,ProceedOnCourse', deg, one from h where f = 9
    union all select k, '4', 'ClimbHeading,ProceedOnCourse', deg, cast(9000 + k % 10 * 100 as int) from h where f = 9
    union all select k, '4', 'HeadingRange', null, 3000 from h where f = 10
    union all select k, '4', 'ClimbHeading', deg, cast(5000 + k % 9 * 100 as int) from h where f = 10
    union all select k, '22', 'ClimbHeading', deg7, two from h where f = 10"""
)
def section_groups(spark, sf_dir):
    """Groups of whole sections: sentences that go on with a route, alternatives, tails, and what unread text withholds."""
    groups, _, _ = whole_sections.parse(sections(spark, sf_dir))
    nodes = F.array_join(F.transform("legs", lambda x: F.coalesce(x["leg"]["node"], F.lit("-"))), ",")
    first = F.col("legs")[0]["leg"]
    return groups.select("block", F.array_join("runways", ",").alias("runways"), nodes.alias("nodes"), first["heading"].alias("heading"), first["feet"].alias("feet"))


@query(
    """with c as (select c_custkey as k, c_custkey % 12 as f from customer)
    select k as block, '22' as runways, true as everywhere, 'unmatched phrase "continue climb in <id> holding pattern (<id>, rt, <n>° inbound) to <n>"' as signature from c where f = 2
    union all select k, '4', false, 'unmatched phrase "climb sideways to <n>"' from c where f = 4
    union all select k, '4', false, 'unmatched phrase "avoid mast <n>"' from c where f = 5
    union all select k, '', true, 'unmatched phrase "avoid mast <n>"' from c where f = 6
    union all select k, '4,22', false, 'runway both routed and given no route' from c where f = 11
    union all select k, '22', false, 'runway both routed and given no route' from c where f = 11"""
)
def section_unread(spark, sf_dir):
    """What is left unread of whole sections, with the runways it names and whether it may restrict every departure."""
    _, _, unparsed = whole_sections.parse(sections(spark, sf_dir))
    return unparsed.where("not withheld").select("block", F.array_join("runways", ",").alias("runways"), "everywhere", "signature")


@query(
    """with c as (select c_custkey as k, c_custkey % 12 as f from customer)
    select k as block, '4' as runways, 'unmatched phrase "continue climb in <id> holding pattern (<id>, rt, <n>° inbound) to <n>"' as signature from c where f = 2
    union all select k, '4', 'unmatched phrase "avoid mast <n>"' from c where f = 6"""
)
def section_withheld(spark, sf_dir):
    """Groups that were read but are withheld for unread text elsewhere in the section that may bind them."""
    _, _, unparsed = whole_sections.parse(sections(spark, sf_dir))
    return unparsed.where("withheld").select("block", F.array_join("runways", ",").alias("runways"), "signature")


@query(
    """with t as (select doc_id, text, length(text) as n from documents where length(text) > 0),
    s as (select doc_id, text, n, unnest(range(0, (n + 99) // 100)) as i from t),
    g as (select *, (doc_id * 31 + i * 53) % 97 as gap from s),
    h as (select doc_id, text, i * 100 + 90 - gap % 40 as start, least(i * 100 + 100, n) as stop from g where gap % 5 = 0)
    select doc_id as id, cast(start as int) as "start", cast(stop as int) as "end" from h where start < stop and regexp_matches(substr(text, start + 1, stop - start), '[^ \t\n\r\f\v]')"""
)
def span_coverage(spark, sf_dir):
    """What spans over all texts leave out of them: each hundred characters are covered but for a part of every few."""
    docs = table(spark, sf_dir, "documents").where(F.length("text") > 0).select(F.col("doc_id").alias("id"), "text")
    n = F.length("text")
    rows = docs.select("id", n.alias("n"), F.explode(F.sequence(F.lit(0), F.floor((n - 1) / 100).cast("int"))).alias("i"))
    gap, begin = (F.col("id") * 31 + F.col("i") * 53) % 97, F.col("i") * 100
    stop = F.least(F.when(gap % 5 == 0, begin + 90 - gap % 40).otherwise(begin + 100), F.col("n"))
    return whole_sections.uncovered(docs, rows.select("id", begin.alias("start"), stop.alias("end"))).select("id", "start", "end")
