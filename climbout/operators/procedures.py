"""Departure text to typed legs, as rows: groups, pieces, legs, failures, and what failures take down.

A procedure's lines become runway groups and a shared tail; a group's text is cut where a new leg opens, each
piece goes through a table of full-match patterns, and the first that fits gives the leg.  A piece that no
pattern reads in full is a failure with its phrase signature: no word is ever skipped.  Unread text takes
down the routes it may bind (an anti-join): its own group, or, if it stands outside of any, all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels, runways, signatures
from ..sources.sinks import written

# The failure of a hold on the wrong side, atoms of the published phrases.
CONTRARY_HOLD = "hold side contradicts its inbound course"
TYPE = r"(?:VOR/DME|VORTAC|VOR|NDB|DME)"
POINT = r"north(?:east|west)?|south(?:east|west)?|east|west|NE|NW|SE|SW|N|S|E|W"
TARGET = rf"(?:([A-Z]+(?: [A-Z]+)*) (?=\())?\(?\b([A-Z]{{2,5}})\b\)?(?: ({TYPE})| INT)?"
#: A navaid by its name alone; its ident stands elsewhere in the procedure (bindings.named_navaids).
NAMED = rf"([A-Z]+(?: [A-Z]+)+|[A-Z]{{6,}}) ({TYPE})"
RADIAL = rf"(?:the )?{TARGET},? R-(\d{{3}})(?: (inbound|outbound))?"
ALTITUDE = r"(?: (?:to|until) (?:(at or above|at or below|at) )?(\d{3,5})(?: MSL)?)?"
SIDE = r"([Ll]eft|[Rr]ight|LT|RT)(?: turns?)?"
HEADER = r"^(?i:Rwys?) (\d{1,2}[LRC]?(?:/[LRC])*(?:, ?\d{1,2}[LRC]?(?:/[LRC])*)*)(?:: ?|,(?! ?\d{1,2}[LRC]?\b) ?| (?=climb))"
#: All of them open with a blank or a sign before it, which is looked for first: other places are passed in one step.
OPENERS = r"(?=[ ,;])(?:(?:[,;]? then |[,;] | and )(?=(?:climb|climbing|proceed|direct|turn|left turn|right turn|intercept|continue)\b)|[,;]? (?=(?:before|prior to) )|[,;]? (?=thence\.\.\.)|[,;]? (?=do not exceed)|[,;]? (?=to cross [A-Z]+ R-))"
FIELDS = ("direction", "heading", "name", "ident", "type", "radial", "sense", "target_name", "target", "target_type", "kind", "feet", "hold_side", "hold_turns", "inbound", "toward", "kias", "until_phrase", "start", "end", "rotation", "dme", "toward_or")
NUMBERS = {"dme", "heading", "radial", "feet", "inbound", "kias", "start", "end"}

#: (node, pattern, field of each capture); the first full match wins.
LEGS: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("Thence", r"(?:thence)?\.\.\.", ()),
    ("NotAvailable", r"(?:departures? )?NA(?: ?- ?(?:Obstacles|ATC|Terrain|Environmental))?", ()),
    ("Unrouted", r"(?i)(?:left|right) turns? on departure NA", ()),
    ("Unrouted", r"(?i)diverse departures? (?:auth(?:orized)?|NA(?:[.,] use (?:RADAR vectors or )?published departure(?: procedures?)?(?: \(DP\))?(?: for obstacle avoidance)?)?)", ()),
    ("GraphicDeparture", r"(?:[Uu]se|[Ss]ee) ([A-Z]+(?: [A-Z]+)*) DEPARTURE(?: \([A-Z]+\))*", ("name",)),
    ("SpeedRestriction", r"do not exceed (\d+) KIAS until (.+)", ("kias", "until_phrase")),
    ("ProceedOnCourse", r"(?:(?:before|prior to) proceeding|proceed|climb) on course", ()),
    ("ProceedOnCourse", rf"(?:before|prior to) (?:turning|proceeding) (?:{SIDE} )?(?:on course )?({POINT})(?: ?bound)?(?: or ({POINT})(?: ?bound)?)?", ("direction", "toward", "toward_or")),
    ("ProceedOnCourse", r"(?:before|prior to) (?:turning (left|right)|(?:a )?(left|right) turn)(?: on course)?", ("direction", "toward")),
    ("ProceedOnCourse", r"(?:before|prior to) (?:turning|turn)(?: on course)?", ()),
    ("Direct", rf"(?:before|prior to) proceeding direct {TARGET}", ("target_name", "target", "target_type")),
    ("ClimbInHold", rf"(?:continue )?climb(?: in|-in-hold(?:ing)?)? (?:the )?{TARGET} (?:holding pattern|hold)(?:,? \((?:[Hh]old )?({POINT}), {SIDE}, (\d{{3}})°? inbound\))?(?:(?: to cross {TARGET})? (?:(at or above|at or below|at|to) )(\d{{3,5}}))?", ("target_name", "target", "target_type", "hold_side", "hold_turns", "inbound", "", "", "", "kind", "feet")),
    ("ClimbInHold", rf"(?:continue )?climb(?: in|-in-hold(?:ing)?) (?:the )?(?:holding pattern|hold)(?: (?:(at or above|at or below|at|to) )(\d{{3,5}}))?", ("kind", "feet")),
    ("HeadingRange", rf"climb(?:ing)?(?: on)? (?:a )?heading between (\d{{3}})°? (CW|CCW) (?:to )?(\d{{3}})°?(?: from DER)?{ALTITUDE}", ("start", "rotation", "end", "kind", "feet")),
    ("MinimumClimb", r"min\. climb of (\d+) ft per NM to (\d+)", ("kias", "feet")),
    ("RunwayHeading", rf"climb(?: on)? (?:runway|rwy) (?:heading|hdg){ALTITUDE}", ("kind", "feet")),
    ("StraightAhead", rf"[Cc]limb straight ahead{ALTITUDE}", ("kind", "feet")),
    ("HeadingAndRadial", rf"(?:climb(?: on| via)? )?(?:heading|hdg) (\d{{3}})°? (?:and|to intercept|to join) (?:on )?{RADIAL}{ALTITUDE} to {TARGET}", ("heading", "name", "ident", "type", "radial", "sense", "kind", "feet", "target_name", "target", "target_type")),
    ("Radial", rf"(?:climb|proceed|climb via|intercept|to intercept)(?: on| via)? {RADIAL}{ALTITUDE} to {TARGET}", ("name", "ident", "type", "radial", "sense", "kind", "feet", "target_name", "target", "target_type")),
    ("Radial", rf"(?:climb|proceed|climb via|intercept|to intercept)(?: on| via)? {RADIAL} (?:to|until) (?:[A-Z]{{2,5}} )?(\d{{1,3}}) DME", ("name", "ident", "type", "radial", "sense", "dme")),
    ("HeadingAndRadial", rf"(?:climb(?: on| via)? )?(?:heading|hdg) (\d{{3}})°? (?:and|to intercept|to join) (?:on )?{RADIAL}{ALTITUDE}", ("heading", "name", "ident", "type", "radial", "sense", "kind", "feet")),
    ("ClimbHeading", rf"(?:climb(?: on| via)? )?(?:heading|hdg) (\d{{3}})°?{ALTITUDE}", ("heading", "kind", "feet")),
    ("Radial", rf"(?:climb|proceed|climb via|intercept|to intercept)(?: on| via)? {RADIAL}{ALTITUDE}", ("name", "ident", "type", "radial", "sense", "kind", "feet")),
    ("Direct", rf"(?:climb |proceed )?direct(?: to)? {TARGET}", ("target_name", "target", "target_type")),
    ("Direct", rf"(?:(?:climb|proceed) )?direct(?: to)? {NAMED}", ("target_name", "target_type")),
    ("CrossAt", rf"(?:to )?cross {TARGET} (at or above|at or below|at) (\d{{3,5}})", ("target_name", "target", "target_type", "kind", "feet")),
    ("CrossRadial", rf"to cross {TARGET},? R-(\d{{3}})", ("name", "ident", "type", "radial")),
)
#: A turn is one leg with what it turns to.
UNROUTED_TURN = r"(?i)turns? on departure NA\z"
AIRWAY = r"\bthen (\w+bound) on\b"
TURN = rf"^(?:[Cc]limbing )?(?:{SIDE}|[Tt]urn)(?: turn)?(?: to)?(?: (.+))?\z"


def with_leg(rows: DataFrame, piece: str, table: tuple = LEGS) -> DataFrame:
    """rows with `leg`: struct<node, fields...> of the first pattern that fits the whole piece; null if none does.

    The pattern is found first and then applied once more for all its captures together; a field is a place among them.
    """
    which, captures = F.lit(None).cast("int"), F.lit(None).cast("array<string>")
    for k, (_, pattern, names) in reversed(list(enumerate(table))):
        which = F.when(F.col(piece).rlike(rf"^(?:{pattern})\z"), k).otherwise(which)
        if names:
            all_ = "\u0001".join(f"${i + 1}" for i in range(len(names)))
            captures = F.when(F.col("_which") == k, F.split(F.regexp_replace(piece, rf"^(?:{pattern})\z", all_), "\u0001")).otherwise(captures)
    rows = rows.withColumn("_which", which).withColumn("_captures", captures)
    fields = []
    for f in FIELDS:
        at: dict[int, list[int]] = {}
        for k, (_, _, names) in enumerate(table):
            if f in names:
                at.setdefault(names.index(f), []).append(k)
        place = F.lit(None).cast("int")
        for i, ks in at.items():
            place = F.when(F.col("_which").isin(ks), i).otherwise(place)
        got = F.nullif(F.get("_captures", place), F.lit("")) if at else F.lit(None).cast("string")
        fields.append((got.cast("int") if f in NUMBERS else got).alias(f))
    node = F.element_at(F.array(*[F.lit(t[0]) for t in table]), F.col("_which") + 1)
    return rows.withColumn("leg", F.when(F.col("_which").isNotNull(), F.struct(node.alias("node"), *fields))).drop("_which", "_captures")


def groups(procedures: DataFrame) -> DataFrame:
    """(block, line, runways, body, tail) of procedures(block, text): a group or tail per line.

    A line without a header continues nothing here: it is unread text of all runways.
    """
    lines = procedures.select("block", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    lines = lines.where("raw <> ''").withColumn("header", F.regexp_extract("raw", HEADER, 1))
    tail = F.col("raw").startswith("...")
    body = F.when(tail, F.expr("substring(raw, 4)")).when(F.col("header") != "", F.regexp_replace("raw", HEADER, "")).otherwise(F.col("raw"))
    body = F.regexp_replace(body, r"(?<!\.)\.\s*\z", "")
    out = lines.select("block", "line", F.when(F.col("header") != "", runways.expand(F.col("header"))).alias("runways"), F.trim(body).alias("body"), tail.alias("tail"))
    return out.withColumn("runways", F.when(F.col("tail"), F.expr("cast(array() as array<string>)")).otherwise(F.col("runways")))


def legs(group_rows: DataFrame, check_holds: bool = True) -> DataFrame:
    """(block, line, seq, piece, turns, side, leg, signature): each piece with its leg, or with a failure's signature.

    check_holds fails a hold whose printed side is not where its inbound course puts it (on unless the caller says otherwise).
    Pieces recur in many procedures, and a piece alone tells its leg: each is read once, into a table.
    """
    rows = group_rows.where("runways is not null").select("block", "line", F.posexplode(F.split(F.regexp_replace("body", OPENERS, "\u0001"), "\u0001")).alias("seq", "piece"))
    read = written(read_pieces(rows.select("piece").distinct(), check_holds), "pieces")
    return rows.join(read, "piece").select("block", "line", "seq", "piece", "turns", "side", "leg", "signature")


def read_pieces(rows: DataFrame, check_holds: bool) -> DataFrame:
    """rows(piece) with turns, side, leg and signature."""
    turning = F.col("piece").rlike(r"^(?:[Cc]limbing|[Tt]urn|[Ll]eft|[Rr]ight|LT|RT)\b") & ~F.col("piece").rlike(UNROUTED_TURN)
    side = F.upper(F.substring(F.regexp_extract("piece", TURN, 1), 1, 1))
    onto = F.regexp_extract("piece", TURN, 2)
    rows = rows.withColumn("turns", turning & F.col("piece").rlike(TURN)).withColumn("onto", F.when(F.col("turns"), onto).otherwise(F.col("piece")))
    rows = with_leg(rows.withColumn("side", F.when(F.col("turns"), F.nullif(side, F.lit("")))), "onto")
    bare = F.col("turns") & (F.col("onto") == "")
    failed = F.col("leg").isNull() & ~bare
    airway = F.regexp_extract("piece", AIRWAY, 1)
    contrary = F.lit(check_holds) & (F.col("leg.node") == "ClimbInHold") & ~labels.side_agrees(labels.compass_point(F.col("leg.hold_side")), F.col("leg.inbound"))
    unread = F.concat(F.lit('unmatched phrase "'), signatures.phrase_signature(F.col("piece")), F.lit('"'))
    signature = F.when(failed & (airway != ""), F.concat(F.lit('unsupported routing "then '), F.lower(airway), F.lit(' on"'))).when(failed, unread).when(contrary, CONTRARY_HOLD)
    return rows.select("piece", "turns", "side", "leg", signature.alias("signature"))


def parse(procedures: DataFrame, check_holds: bool = True) -> tuple[DataFrame, DataFrame]:
    """(readable groups, failures) of procedures(block, text).

    groups: block, line, runways, tail, legs in order.  failures: block, line, runways, signature (the first
    of its line).  A failure takes down the groups whose runways it names, in the same block; unread
    text that names none takes down the whole block, as does a failed tail.
    """
    rows = written(groups(procedures), "groups")  # both are read several times, for groups and failures
    each = written(legs(rows, check_holds), "legs")
    first = each.where("signature is not null").groupBy("block", "line").agg(F.min_by("signature", "seq").alias("signature"))
    loose = rows.where("runways is null").select("block", "line", F.concat(F.lit('unmatched phrase "'), signatures.phrase_signature(F.col("body")), F.lit('"')).alias("signature"))
    failures = rows.select("block", "line", "runways", "tail").join(first.unionByName(loose), ["block", "line"])
    whole = failures.where("runways is null or tail").select(F.col("block").alias("_b")).distinct()
    named = failures.where("runways is not null and not tail").select(F.col("block").alias("_b"), F.explode("runways").alias("_r")).distinct()
    flown = rows.where("runways is not null")
    hit = flown.select("block", "line", F.explode("runways").alias("_rwy")).join(named, (F.col("block") == F.col("_b")) & (F.col("_rwy") == F.col("_r")), "left_semi").select("block", "line").distinct()
    kept = flown.join(whole, F.col("block") == F.col("_b"), "left_anti").join(hit, ["block", "line"], "left_anti")
    read = each.groupBy("block", "line").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "turns", "side", "leg"))), lambda x: F.struct(x["turns"].alias("turns"), x["side"].alias("side"), x["leg"].alias("leg"))).alias("legs"))
    return kept.drop("body").join(read, ["block", "line"]), failures


def carry_senses(leg_rows: DataFrame) -> DataFrame:
    """A radial without a sense takes that of the next leg on the same navaid and radial in its group."""
    order = Window.partitionBy("block", "line").orderBy("seq")
    key = F.struct(F.col("leg.ident"), F.col("leg.radial"))
    rows = leg_rows.withColumn("_fresh", F.when(F.lag(key).over(order).eqNullSafe(key), 0).otherwise(1)).withColumn("_island", F.sum("_fresh").over(order))
    ahead = Window.partitionBy("block", "line", "_island").orderBy("seq").rowsBetween(0, Window.unboundedFollowing)
    return rows.withColumn("sense", F.first("leg.sense", ignorenulls=True).over(ahead)).drop("_fresh", "_island")


def references(leg_rows: DataFrame) -> DataFrame:
    """(block, ident, type) of all navaids and fixes that the legs name, each once."""
    refs = F.array(F.struct(F.col("leg.ident").alias("ident"), F.col("leg.type").alias("type")), F.struct(F.col("leg.target").alias("ident"), F.col("leg.target_type").alias("type")))
    return leg_rows.where("leg is not null").select("block", F.explode(refs).alias("r")).where("r.ident is not null").select("block", "r.ident", "r.type").distinct()


def legs_to_json(legs_: Column) -> Column:
    """An array of legs as JSON, each with its node and all fields, absent ones null."""
    return F.to_json(legs_, {"ignoreNullFields": "false"})


def legs_from_json(text: Column) -> Column:
    """The array of legs that `legs_to_json` wrote; a field that is missing is null."""
    leg = ", ".join(["node: string", *(f"{f}: {'int' if f in NUMBERS else 'string'}" for f in FIELDS)])
    return F.from_json(text, f"array<struct<turns: boolean, side: string, leg: struct<{leg}>>>")
