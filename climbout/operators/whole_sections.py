"""Whole departure sections: sentences, the groups they belong to, and what is left unread with its scope.

A section is cut into sentences where one may begin: after a period that no lower-case word follows, before a runway header,
a shared tail or a sentence for all.  Each sentence has a kind and its span in the text.  Headers start groups (gaps and
islands); a sentence that goes on with a route joins the group before it where its meaning is certain, else it is
unread.  Reading resumes at the next header: what cannot be read is a row with the runways it may bind, or with `everywhere` where it
may restrict every departure.  Every step is a window over a section or a join by section, so sections are independent.
Sentences, their legs and the groups are written as tables once, since several results are made from them.  Joins by section are
merge joins: the written tables are small as files only, and a broadcast would pass the rows of all sections through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import runways, signatures
from ..sources.sinks import written
from . import parts, procedures, visual_climbs

# What opens sentences of each kind, and the failures of sections.
ON = r"(?:climb|climbing|continue|proceed|direct|cross)\b"
ALL = r"(?i:all (?:aircraft|rwys|runways))\b"
STATEMENT = r"(?i)^(?:DME required|diverse departures? NA(?:[.,] use (?:RADAR vectors or )?published departure(?: procedures?)?(?: \(DP\))?(?: for obstacle avoidance)?)?)\.$"
VISUAL = r"(?i:for climb in visual conditions)"
OTHER_RANGE = r"[,;.]? ?(?:(?i:all other (?:courses|headings))[:,]?|or(?= (?:climb|climbing|min\.)\b)) "
NO_TAIL, TAIL_AGAIN = '"thence" without a shared tail', '"thence" inside the shared tail'
TWO_READINGS, BESIDE_TAIL = "runway both routed and given no route", "runway with no route beside a shared tail"
BARE_TURN, BESIDE_CHART = "turn without a route", "route beside a charted DP for every runway"
CLOSED = "visual climb from a runway with no route"

#: Where a sentence may begin; nothing is consumed, so that sentences keep their spans.
BOUNDARY = (
    r"(?<=(?<!\.)\.[ \n])(?=[^a-z \n.])"
    rf"|(?<=\n)(?=\.\.\.|(?i:Rwys?) \d|{ALL})"
    rf"|(?<=(?:\.\.\.|:|;)[ \n]?)(?=(?i:Rwys?) \d|{ALL})"
    rf"|(?<=(?i:thence) ?\.\.\. ?)(?={ON})"
)


def sentences(sections: DataFrame) -> DataFrame:
    """(block, line, start, end, opens_line, text, kind, runways) of sections(block, text), the text canonically spelled.

    start and end are character positions.  A header names its runways; one that cannot be read (`lost`) those up to the first
    word that is no runway.
    """
    rows = sections.select("block", F.posexplode(F.split(F.regexp_replace("text", BOUNDARY, "\u0001"), "\u0001")).alias("line", "raw"))
    order = Window.partitionBy("block").orderBy("line")
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("raw")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int"))
    rows = rows.withColumn("opens_line", F.coalesce(F.lag("raw").over(order).rlike(r"\n\z"), F.lit(True)))
    rows = rows.withColumn("end", (F.col("start") + F.length(F.regexp_replace("raw", r"\s+\z", ""))).cast("int"))
    rows = rows.withColumn("text", F.trim(F.regexp_replace("raw", r"\s+", " "))).where("text <> ''")
    named, lead = F.regexp_extract("text", procedures.HEADER, 1), F.col("text")
    after_thence = F.lag("text").over(order).rlike(r"(?i)thence ?\.\.\.\z")
    more = F.max(lead.rlike(r"^(?i:Rwys?) \d")).over(order.rowsBetween(1, Window.unboundedFollowing))
    rows = rows.withColumn("later_header", F.coalesce(more, F.lit(False)))
    kind = (
        F.when(named != "", "header").when(lead.rlike(r"^(?i:Rwys?) \d"), "lost").when(lead.rlike(r"^(?i:all (?:rwys|runways)),"), "all")
        .when(lead.startswith("...") | lead.rlike(r"^(?i:all aircraft)\b"), "tail").when(after_thence & lead.rlike(rf"^{ON}") & ~F.col("later_header"), "tail")
        .when(lead.rlike(STATEMENT), "statement").when(lead.rlike(r"^(?i:thence) ?\.\.\.\z"), "thence").when(lead.rlike(rf"^(?:(?i:or) )?{VISUAL}"), "visual")
        .when(lead.rlike(r"^(?i:do not exceed)\b"), "speed").when(lead.rlike(rf"^(?i:{ON})"), "on").when(lead.rlike(r"^(?:[Uu]se|[Ss]ee) .*DEPARTURE") & (F.col("line") == 0), "chart").otherwise("other")
    )
    readable = F.regexp_extract("text", r"^(?i:Rwys?) ((?:\d{1,2}[LRC]?(?:/[LRC])*(?:, ?| |\b))+)", 1)
    names = F.when(named != "", runways.expand(named)).when(lead.rlike(r"^(?i:Rwys?) \d"), runways.expand(readable)).otherwise(F.expr("cast(array() as array<string>)"))
    whole = F.count("*").over(Window.partitionBy("block")) == 1
    nothing = whole & lead.rlike(r"(?i)^(?:(?:departures? )?NA(?: ?- ?(?:Obstacles|ATC|Terrain|Environmental))?|diverse departures? authorized all runways)\.\z")
    rows = rows.withColumn("kind", F.when(nothing, "none").otherwise(kind)).withColumn("runways", names)
    return rows.select("block", "line", "start", "end", "opens_line", "later_header", "text", "kind", "runways")


def unread(text: Column) -> Column:
    return F.concat(F.lit('unmatched phrase "'), signatures.phrase_signature(F.regexp_replace(text, r"\.\z", "")), F.lit('"'))


def routes(rows: DataFrame, check_holds: bool) -> DataFrame:
    """(block, line, alt, body, legs, signature): the legs of each sentence, a row for each alternative that it offers.

    "..., or climb ..." and "All other courses: ..." after a range of headings are alternatives for the same runways.
    """
    body = F.when(F.col("kind").isin("header", "all"), F.regexp_replace(F.regexp_replace("text", procedures.HEADER, ""), r"^(?i:all (?:rwys|runways)), ", ""))
    tail = F.regexp_replace(F.regexp_replace("text", r"^\.\.\. ?(?:thence )?", ""), r"^(?i:all aircraft)[,:]? ", "")
    body = F.when(F.col("kind") == "tail", tail).when(F.col("kind") == "none", "NA").otherwise(F.coalesce(body, F.col("text")))
    body = F.regexp_replace(body, rf"[,;]? ?(?:or )?{VISUAL}.*", "")
    rows = rows.withColumn("body", F.trim(F.regexp_replace(body, r"(?<!\.)\.\s*\z", "")))
    first = F.concat(F.lower(F.substring("body", 1, 1)), F.substring(F.col("body"), F.lit(2), F.length("body")))
    rows = rows.withColumn("body", F.when(F.col("body").rlike(r"^(?:Climb|Continue|Proceed|Direct|Cross|Do|Use|See|Turn|Left|Right)\b"), first).otherwise(F.col("body")))
    each = F.when(F.col("body").contains(" between "), F.split("body", OTHER_RANGE)).otherwise(F.array("body"))
    rows = rows.select("block", F.col("line").alias("_line"), F.posexplode(each).alias("alt", "body")).where("body <> ''")
    keyed = rows.withColumn("line", F.col("_line") * 64 + F.col("alt"))
    read = procedures.legs(keyed.select("block", "line", F.expr("cast(array() as array<string>)").alias("runways"), "body"), check_holds)
    step = F.struct("seq", F.struct("turns", "side", "leg").alias("step"))
    legs = F.transform(F.array_sort(F.collect_list(step)), lambda x: x["step"]).alias("legs")
    bad = F.min_by("signature", F.when(F.col("signature").isNotNull(), F.col("seq"))).alias("signature")
    return read.groupBy("block", "line").agg(legs, bad).join(keyed.select("block", "line", "_line", "alt").hint("merge"), ["block", "line"]).select("block", F.col("_line").alias("line"), "alt", "legs", "signature")


def last(legs: Column, at: int = -1) -> Column:
    return F.try_element_at(legs, F.lit(at))


def end_fix(legs: Column) -> Column:
    """The fix that a route ends at, null if at none."""
    leg = last(legs)["leg"]
    return F.coalesce(leg["target"], leg["target_name"])


def bound(rows: DataFrame) -> DataFrame:
    """rows with `grp` (the header's line), `joins` (goes on with that group) and `alternative` (another route for its runways).

    A sentence goes on with the route before it if another header follows, if that is the only route, if all
    routes end at one fix, or if it repeats word for word a sentence that went on with an earlier route.  An alternative
    climbs as the header's sentence does, to another altitude, before turning another way.
    """
    order = Window.partitionBy("block").orderBy("line", "alt")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    heads = F.col("kind").isin("header", "all", "lost", "tail", "chart", "none")
    rows = rows.withColumn("grp", F.last(F.when(heads, F.col("line")), ignorenulls=True).over(so_far))
    rows = rows.withColumn("head_kind", F.last(F.when(heads, F.col("kind")), ignorenulls=True).over(so_far))
    head = lambda c: F.last(F.when(heads, c), ignorenulls=True).over(so_far)
    flown = F.coalesce(parts.flies(F.col("legs")), F.lit(False))
    rows = rows.withColumn("_flown", F.coalesce(head(flown), F.lit(False))).withColumn("_head", head(F.struct("legs", "alt")))
    lead, own = F.col("_head.legs"), F.col("legs")
    climbs = lambda x: F.struct(last(x, 1)["leg"]["node"], last(x, 1)["leg"]["heading"], last(x, 1)["side"])
    turn = lambda x: F.coalesce(last(x)["leg"]["direction"], last(x)["leg"]["toward"])
    straight = lambda x: last(x, 1)["leg"]["node"].isin("ClimbHeading", "RunwayHeading") & last(x, 1)["leg"]["feet"].isNotNull() & (last(x)["leg"]["node"] == "ProceedOnCourse")
    other = (F.col("kind") == "on") & ~F.col("opens_line") & (F.size(lead) == 2) & (F.size(own) == 2) & straight(lead) & straight(own) & climbs(lead).eqNullSafe(climbs(own)) & (turn(lead) != turn(own))
    rows = rows.withColumn("alternative", F.coalesce(other & (F.col("head_kind") == "header"), F.lit(False)))
    rows = rows.withColumn("_mixed", F.max("alternative").over(Window.partitionBy("block", "grp").orderBy("line", "alt").rowsBetween(Window.unboundedPreceding, 0)))
    route = (F.col("kind") == "header") & flown
    ends = F.collect_set(F.when(route, end_fix(own))).over(so_far)
    open_ends = F.sum(F.when(route & end_fix(own).isNull(), 1).otherwise(0)).over(so_far)
    count = F.sum(F.when(route | F.col("alternative"), 1).otherwise(0)).over(so_far)
    into_tail = F.coalesce(last(lead)["leg"]["node"] == "Thence", F.lit(False))
    visual = F.coalesce(F.lag(F.col("text").rlike(VISUAL)).over(order), F.lit(False))
    may = F.col("kind").isin("on", "speed") & F.col("_flown") & F.col("head_kind").isin("header", "tail") & ~into_tail & ~F.col("_mixed") & ~visual
    certain = may & (F.col("later_header") | (F.col("head_kind") == "tail") | (count == 1) | ((F.size(ends) == 1) & (open_ends == 0)))
    rows = rows.withColumn("_certain", F.coalesce(certain, F.lit(False))).withColumn("_may", F.coalesce(may, F.lit(False)))
    said = Window.partitionBy("block", "text").orderBy("line", "alt").rowsBetween(Window.unboundedPreceding, -1)
    again = F.coalesce(F.max(F.col("_certain") & F.col("signature").isNull()).over(said), F.lit(False))
    thence = (F.col("kind") == "thence") & F.col("_flown") & (F.col("head_kind") == "header") & ~into_tail
    rows = rows.withColumn("joins", F.col("_certain") | (F.col("_may") & again) | thence)
    return rows.drop("_flown", "_head", "_mixed", "_certain", "_may")


def parse(sections: DataFrame, check_holds: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups, climbs, unparsed) of sections(block, text), in part: what can be read, and the rest with its scope.

    groups: block, grp, alt, runways (none: all), tail, legs.  climbs: block, grp, runways, cross, bound, feet, legs of the
    visual climbs written into the section.  unparsed: block, line, start, end, runways, everywhere, vcoa, signature, withheld (a
    group that was read, but that unread text elsewhere in the section may bind).
    A group is left out if it could not be read, if unread text names one of its runways or may restrict every departure,
    or if it has no certain reading beside the other groups and the tail.
    """
    lines = written(sentences(sections), "sentences")
    legs = written(routes(lines.where("kind in ('header', 'all', 'on', 'speed', 'tail', 'chart', 'none')"), check_holds), "sentence_legs")
    rows = bound(lines.join(legs.hint("merge"), ["block", "line"], "left").withColumn("alt", F.coalesce("alt", F.lit(0))))
    # one failure a sentence: its legs, or that it stands where nothing certain can be made of it
    silent = F.col("kind").isin("header", "all") & F.col("text").rlike(VISUAL) & F.col("legs").isNull()
    heads = F.col("kind").isin("header", "tail", "chart", "none") | ((F.col("kind") == "all") & (silent | F.coalesce(last(F.col("legs"), 1)["leg"]["node"] == "GraphicDeparture", F.lit(False))))
    loose = ~heads & ~F.col("joins") & ~F.col("alternative") & (F.col("kind") != "statement")
    empty = heads & F.col("legs").isNull() & ~silent
    rows = rows.withColumn("signature", F.when(loose | empty, unread(F.col("text"))).when(heads | F.col("joins") | F.col("alternative"), F.col("signature")))
    rows = rows.withColumn("_first_bad", F.min(F.when(F.col("signature").isNotNull(), F.col("line"))).over(Window.partitionBy("block", "grp")))
    rows = written(rows.withColumn("_skipped", F.coalesce(F.col("line") > F.col("_first_bad"), F.lit(False))), "sentence_groups")
    own_text = heads | F.col("joins") | F.col("alternative")
    is_tail = F.col("head_kind").eqNullSafe("tail")
    condition = F.col("text").rlike(r":\z")
    no_header = F.col("grp").isNull() | F.col("head_kind").isin("all", "chart")
    everywhere = F.when(own_text & ~F.col("_skipped"), F.lit(False)).otherwise(no_header | ~F.col("later_header") | (condition & ~F.col("_skipped"))) & ~is_tail
    bad = rows.where((F.col("signature").isNotNull() & ~F.col("_skipped")) | (F.col("_skipped") & (F.col("kind") != "statement")))
    bad = bad.withColumn("everywhere", everywhere)
    owner = rows.where(F.col("kind").isin("header", "lost")).groupBy("block", F.col("line").alias("grp")).agg(F.first("runways").alias("owned"))
    before = rows.where("kind = 'lost'").select("block", F.col("line").alias("_lost")).join(owner.withColumnRenamed("grp", "_h").hint("merge"), "block").where("_h < _lost").groupBy("block", F.col("_lost").alias("grp")).agg(F.max_by("owned", "_h").alias("earlier"))
    none = F.expr("cast(array() as array<string>)")
    bad = bad.join(owner.hint("merge"), ["block", "grp"], "left").join(before.hint("merge"), ["block", "grp"], "left")
    names = F.array_union(F.coalesce("owned", none), F.when(F.col("kind") == "lost", F.coalesce("earlier", none)).otherwise(none))
    text_failures = bad.select("block", "line", "start", "end", names.alias("runways"), F.coalesce("everywhere", F.lit(False)).alias("everywhere"), F.coalesce("signature", unread(F.col("text"))).alias("signature"), is_tail.alias("_tail")).distinct()

    # groups: the header's legs and those of the sentences that go on with it
    kept = rows.where(own_text & F.col("_first_bad").isNull() & F.col("grp").isNotNull())
    kept = kept.withColumn("grp_alt", F.when(F.col("kind") == "on", F.when(F.col("alternative"), F.col("line") * 64).otherwise(F.lit(0))).otherwise(F.col("alt")))
    thence_leg = F.when(F.col("kind") == "thence", F.array(F.struct(F.lit(False).alias("turns"), F.lit(None).cast("string").alias("side"), thence_struct(rows).alias("leg"))))
    kept = kept.withColumn("legs", F.coalesce("legs", thence_leg)).where("legs is not null")
    ordered = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("line", "alt", "legs"))), lambda x: x["legs"]))
    groups = kept.groupBy("block", "grp", F.col("grp_alt").alias("alt")).agg(ordered.alias("legs"), F.first("head_kind").alias("head_kind"), F.max(F.col("text").rlike(r"^(?:\.\.\. ?)?(?:thence )?(?i:all aircraft)")).alias("for_all"))
    groups = groups.join(owner.hint("merge"), ["block", "grp"], "left").withColumn("runways", F.coalesce("owned", none)).drop("owned").withColumn("tail", F.col("head_kind") == "tail")
    tails = groups.where("tail").groupBy("block").agg(F.max("for_all").alias("_for_all"), F.first("legs").alias("_tail_legs"))
    lost_tails = text_failures.where("_tail").groupBy("block").agg(F.min_by("signature", "line").alias("_tail_error"), F.min("line").alias("_tail_line"))
    all_lines = lines.where(r"kind = 'tail' and text rlike '^(\\.\\.\\. ?)?(thence )?[Aa]ll aircraft'").select("block").distinct().withColumn("_all_text", F.lit(True))
    groups = groups.join(tails.hint("merge"), "block", "left").join(lost_tails.hint("merge"), "block", "left").join(all_lines.hint("merge"), "block", "left")
    flies = parts.flies(F.col("legs")) & ~F.col("tail")
    thence_array = F.array(F.struct(F.lit(False).alias("turns"), F.lit(None).cast("string").alias("side"), thence_struct(rows).alias("leg")))
    enters = F.coalesce("_for_all", F.lit(False)) | F.coalesce("_all_text", F.lit(False))
    groups = groups.withColumn("legs", F.when(flies & enters & ~parts.ends_in_tail(F.col("legs")), F.concat("legs", thence_array)).otherwise(F.col("legs")))
    w = Window.partitionBy("block")
    to_tail, has_tail = parts.ends_in_tail(F.col("legs")) & ~F.col("tail"), F.col("_tail_legs").isNotNull()
    bad_tail = F.coalesce(parts.ends_in_tail(F.col("_tail_legs")), F.lit(False))
    no_route = ~flies & ~F.col("tail") & ~F.array_contains(F.array_compact(parts.nodes(F.col("legs"))), "GraphicDeparture")
    chart = F.max(F.array_contains(F.array_compact(parts.nodes(F.col("legs"))), "GraphicDeparture") & (F.size("runways") == 0)).over(w)
    closed = F.flatten(F.collect_list(F.when(no_route, F.col("runways"))).over(w))
    routed = F.flatten(F.collect_list(F.when(~no_route & ~F.col("tail"), F.col("runways"))).over(w))
    bare = F.exists("legs", lambda x: x["turns"] & x["leg"].isNull()) & ~F.col("tail")
    last_bare = F.when(to_tail, F.try_element_at("legs", F.lit(-2))).otherwise(F.lit(None))
    only_last = to_tail & last_bare["turns"] & last_bare["leg"].isNull() & (F.size(F.filter("legs", lambda x: x["turns"] & x["leg"].isNull())) == 1) & has_tail
    unrouted = no_route & F.exists(parts.nodes(F.col("legs")), lambda n: n == "Unrouted")
    reason = (
        F.when(to_tail & bad_tail, TAIL_AGAIN).when(to_tail & ~has_tail, F.coalesce("_tail_error", F.lit(NO_TAIL)))
        .when(bare & ~F.coalesce(only_last, F.lit(False)), BARE_TURN).when(flies & chart, BESIDE_CHART)
        .when((no_route & F.arrays_overlap("runways", routed)) | (~no_route & ~F.col("tail") & F.arrays_overlap("runways", closed)), TWO_READINGS)
        .when(unrouted & (has_tail | F.col("_tail_error").isNotNull()), BESIDE_TAIL).when(F.col("tail") & bad_tail, TAIL_AGAIN)
    )
    entered = F.coalesce(F.max(to_tail).over(w), F.lit(False))
    groups = written(groups.withColumn("_reason", reason).withColumn("_entered", entered), "section_groups")
    refused = groups.where("_reason is not null and not tail").select("block", F.col("grp").alias("line"), "runways", F.col("_reason").alias("signature"))
    spans = lines.select("block", "line", "start", "end")
    refused = refused.join(spans.hint("merge"), ["block", "line"]).withColumn("everywhere", F.lit(False))
    # a tail that fails binds the groups that enter it; if none does, every departure
    tail_known = groups.groupBy("block").agg(F.max("_entered").alias("_entered"))
    text_failures = text_failures.join(tail_known.hint("merge"), "block", "left").withColumn("everywhere", F.col("everywhere") | (F.col("_tail") & ~F.coalesce("_entered", F.lit(False)))).drop("_entered", "_tail")
    columns = ["block", "line", "start", "end", "runways", "everywhere", "signature"]
    unparsed = text_failures.select(columns).unionByName(refused.select(columns)).withColumn("vcoa", F.lit(False))
    climbs, climb_failures = inline_climbs(rows.where(F.col("_first_bad").isNull()), groups)
    unparsed = unparsed.unionByName(climb_failures.select("block", "line", "start", "end", "runways", F.lit(False).alias("everywhere"), "signature", F.lit(True).alias("vcoa")))
    readable = groups.where("_reason is null").select("block", "grp", "alt", "runways", "tail", "legs")
    lost = [withheld(readable.where("not tail"), text_failures, F.lit(False)), withheld(climbs, text_failures, F.lit(True))]
    for rows_ in lost:
        unparsed = unparsed.withColumn("withheld", F.lit(False)) if "withheld" not in unparsed.columns else unparsed
        unparsed = unparsed.unionByName(rows_.join(spans.withColumnRenamed("line", "grp").hint("merge"), ["block", "grp"]).withColumnRenamed("grp", "line").withColumn("withheld", F.lit(True)))
    return withhold(readable, text_failures), withhold(climbs, text_failures), unparsed


def thence_struct(rows: DataFrame) -> Column:
    """A leg that goes on with the shared tail."""
    leg = rows.schema["legs"].dataType.elementType["leg"].dataType
    return F.struct(*[(F.lit("Thence") if f.name == "node" else F.lit(None).cast(f.dataType)).alias(f.name) for f in leg])


def withhold(groups: DataFrame, unparsed: DataFrame) -> DataFrame:
    """groups without those from a runway that unread text names; text that may restrict every departure withholds all.

    A group for all runways is bound by any such text; a tail by none, it only goes with the routes that enter it.
    """
    flown = groups.withColumn("_tail", F.col("tail") if "tail" in groups.columns else F.lit(False))
    scope = unparsed.groupBy("block").agg(F.max("everywhere").alias("_everywhere"), F.array_distinct(F.flatten(F.collect_list("runways"))).alias("_named"))
    met = flown.join(scope.hint("merge"), "block", "left")
    named = F.coalesce(F.arrays_overlap("runways", "_named"), F.lit(False))
    any_ = (F.size("runways") == 0) & F.coalesce(F.size("_named") > 0, F.lit(False)) & F.lit("cross" in groups.columns)
    keep = met.where(~(F.coalesce("_everywhere", F.lit(False)) | named | any_) | (F.col("_tail") & ~F.coalesce("_everywhere", F.lit(False))))
    if "tail" in groups.columns:  # a tail that nothing enters any more goes too
        entered = keep.withColumn("_in", F.max(parts.ends_in_tail(F.col("legs")) & ~F.col("tail")).over(Window.partitionBy("block")))
        keep = entered.where("not tail or _in").drop("_in")
    return keep.select(groups.columns)


def withheld(groups: DataFrame, unparsed: DataFrame, vcoa: Column) -> DataFrame:
    """(block, grp, runways, everywhere, signature, vcoa) of the groups that `withhold` takes out, each with the first text that binds it.

    The first in the text that may restrict every departure, else that of the group's first runway that any names.
    """
    texts = F.array_sort(F.collect_list(F.struct("line", "runways", "everywhere", "signature")))
    met = groups.join(unparsed.groupBy("block").agg(texts.alias("_texts")).hint("merge"), "block")
    first = lambda keep: F.try_element_at(F.filter("_texts", keep), F.lit(1))["signature"]
    by_runway = F.transform("runways", lambda r: first(lambda t: F.array_contains(t["runways"], r)))
    for_all = F.when((F.size("runways") == 0) & F.lit("cross" in groups.columns), first(lambda t: F.size(t["runways"]) > 0))
    signature = F.coalesce(first(lambda t: t["everywhere"]), F.try_element_at(F.array_compact(by_runway), F.lit(1)), for_all)
    rows = met.withColumn("signature", signature).where("signature is not null")
    return rows.select("block", "grp", "runways", F.lit(False).alias("everywhere"), "signature", vcoa.alias("vcoa"))


def inline_climbs(rows: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(climbs, failures): visual climbs written into runway sentences or behind the tail, read as their section would have them."""
    said = rows.where(F.col("alt") == 0).where(F.col("text").rlike(VISUAL))
    crossing = F.regexp_extract("text", rf"{VISUAL}[:,]? (?:to )?(?i:cross) (.*)\z", 1)
    order = Window.partitionBy("block").orderBy("line")
    entering = groups.where(~F.col("tail") & parts.ends_in_tail(F.col("legs"))).groupBy("block").agg(F.array_distinct(F.flatten(F.collect_list("runways"))).alias("_entering"))
    own = said.join(entering.hint("merge"), "block", "left").withColumn("runways", F.when(F.col("kind") == "visual", F.col("_entering")).otherwise(F.col("runways"))).withColumn("crossing", crossing)
    who = F.when(F.size("runways") > 0, F.concat(F.lit("Rwys "), F.array_join("runways", ", "), F.lit(", "))).otherwise("")
    line = F.concat(who, F.lit("Obtain ATC approval for VCOA when requesting IFR clearance. Climb in visual conditions to cross "), F.col("crossing"))
    keyed = own.where("crossing <> ''").withColumn("_n", F.row_number().over(order) - 1)
    texts = keyed.groupBy("block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", line.alias("t")))), lambda x: x["t"]), "\n").alias("vcoa"))
    climbs, failed = visual_climbs.read(texts)
    back = keyed.select("block", F.col("_n").alias("_line"), "line", "start", "end", F.col("runways").alias("_runways"))
    read = climbs.withColumnRenamed("line", "_line").join(back.hint("merge"), ["block", "_line"]).select("block", F.col("line").alias("grp"), "runways", "cross", "bound", "feet", "legs", "start", "end")
    open_, shut = open_runways(read, groups)
    lost = failed.withColumnRenamed("line", "_line").join(back.hint("merge"), ["block", "_line"]).select("block", "line", "start", "end", F.col("_runways").alias("runways"), "signature")
    refused = shut.select("block", F.col("grp").alias("line"), "start", "end", "runways", F.lit(CLOSED).alias("signature"))
    return open_.drop("start", "end"), lost.unionByName(refused)


def open_runways(climbs: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """climbs split into those from runways that the section gives a route, and those it closes.

    A closed runway refuses the climbs from it and those for all runways; a section that gives no runway a route refuses all.
    """
    shut = groups.where(parts.no_route(F.col("legs")) & ~F.col("tail")).groupBy("block").agg(F.flatten(F.collect_list("runways")).alias("_shut"), F.max(F.size("runways") == 0).alias("_all_shut"))
    met = climbs.join(shut.hint("merge"), "block", "left")
    refused = F.coalesce(F.col("_all_shut") | (F.size("runways") == 0) | F.arrays_overlap("runways", "_shut"), F.lit(False)) & F.col("_shut").isNotNull()
    marked = met.withColumn("_refused", refused)
    return marked.where("not _refused").select(climbs.columns), marked.where("_refused").select(climbs.columns)


def section_climbs(inline: DataFrame, section: DataFrame) -> DataFrame:
    """The climbs of the section on visual climbs that do not repeat one written into the departure section."""
    same = ["block", "runways", "cross", "bound", "feet", "_legs"]
    key = lambda c: c.withColumn("_legs", F.to_json("legs"))
    seen = key(inline).select(*[F.col(c).alias(f"_{c}") for c in same]).distinct()
    rows = key(section)
    on = (F.col("block") == F.col("_block")) & F.col("runways").eqNullSafe(F.col("_runways")) & F.col("cross").eqNullSafe(F.col("_cross")) & F.col("bound").eqNullSafe(F.col("_bound")) & (F.col("feet") == F.col("_feet")) & F.col("_legs").eqNullSafe(F.col("__legs"))
    return rows.join(seen.hint("merge"), on, "left_anti").select(section.columns)


def uncovered(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(id, start, end, text) of what no span covers in texts(id, text), blanks apart; spans(id, start, end) may overlap.

    Spans are merged by running maxima; what lies between the merged ones, before the first or behind the last is a row.
    """
    ends = texts.select("id", F.length("text").alias("start"), F.length("text").alias("end"))
    order = Window.partitionBy("id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    rows = spans.select("id", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end")).unionByName(ends).withColumn("_till", F.coalesce(F.max("end").over(order), F.lit(0)))
    gaps = rows.where("start > _till").select("id", F.col("_till").alias("start"), F.col("start").alias("end"))
    cut = gaps.join(texts.select("id", F.col("text").alias("_whole")), "id").withColumn("text", F.substring(F.col("_whole"), F.col("start") + 1, F.col("end") - F.col("start")))
    return cut.where(F.col("text").rlike(r"\S")).select("id", "start", "end", "text")
