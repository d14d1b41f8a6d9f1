"""Chart labels and compass points as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longest label, name for no runways, heading of a note, compass points clockwise, order of parallels, degrees a hold's side may be off.
LABEL_LIMIT, ALL_RUNWAYS, NOT_SHOWN = 22, "ALL RWYS", "ODP NOT SHOWN"
POINTS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
PARALLELS = ("L", "C", "R")
SIDE_TOLERANCE = 30


def heading(magnetic: Column) -> Column:
    return F.format_string("hdg %03d°", magnetic.cast("int"))


def radial(degrees: Column, ident: Column | None = None) -> Column:
    """R-035, or SAU R-035 with the navaid's ident."""
    short = F.format_string("R-%03d", degrees.cast("int"))
    return short if ident is None else F.concat(ident, F.lit(" "), short)


def dme(ident: Column, nm: Column) -> Column:
    """BAM 10 DME, BAM 9.5 DME: no trailing zeros."""
    return F.concat(ident, F.lit(" "), F.regexp_replace(F.round(nm, 4).cast("string"), r"\.0+\z", ""), F.lit(" DME"))


def designators(runways: Column) -> Column:
    """[16R, 16L, 17L] as 16L/R,17L: numbers in the order given, their sides L, C, R, then others."""
    parts = F.transform(runways, lambda r: F.struct(F.regexp_extract(r, r"^(\d*)", 1).alias("number"), F.regexp_extract(r, r"^\d*(.*)\z", 1).alias("side")))
    known = F.array(*[F.lit(x) for x in PARALLELS])

    def one(number: Column) -> Column:
        own = F.transform(F.filter(parts, lambda p: p["number"] == number), lambda p: p["side"])
        rank = lambda s: F.when(F.array_contains(known, s), F.array_position(known, s)).otherwise(len(PARALLELS) + 1)
        ranked = F.array_sort(F.transform(own, lambda s, i: F.struct(rank(s).alias("rank"), i.alias("i"), s.alias("side"))))
        return F.concat(number, F.array_join(F.transform(ranked, lambda x: x["side"]), "/"))

    return F.array_join(F.transform(F.array_distinct(F.transform(parts, lambda p: p["number"])), one), ",")


def runway_tag(runways: Column) -> Column:
    """The designators as a label, null if they do not fit; an empty array names all runways."""
    tag = F.when(F.size(runways) == 0, F.lit(ALL_RUNWAYS)).otherwise(designators(runways))
    return F.when(F.char_length(tag) <= LABEL_LIMIT, tag)


def part_name(runways: Column, unnamed: str = ALL_RUNWAYS) -> Column:
    """RWY 4/22 for a part of a procedure; `unnamed` where it names no runway."""
    return F.when(F.size(runways) == 0, F.lit(unnamed)).otherwise(F.concat(F.lit("RWY "), F.array_join(runways, "/")))


def filled(pieces: Column, joined: Callable[[Column, Column], Column]) -> Column:
    """The pieces in order as lines: each goes on the last line if the two joined still fit a label, else on a new one."""

    def step(lines: Column, piece: Column) -> Column:
        line = joined(F.try_element_at(lines, F.lit(-1)), piece)
        kept = F.slice(lines, F.lit(1), F.greatest(F.size(lines) - 1, F.lit(0)))
        return F.when(F.char_length(line) <= LABEL_LIMIT, F.concat(kept, F.array(line))).otherwise(F.concat(lines, F.array(piece)))

    return F.aggregate(pieces, F.expr("cast(array() as array<string>)"), step)


def wrapped(phrases: Column) -> Column:
    """The phrases in order as lines, as many to a line as fit; a phrase that is too long stands alone."""
    return filled(phrases, lambda line, phrase: F.concat(line, F.lit(" "), phrase))


def not_shown(parts: Column) -> Column:
    """Lines that name the parts of a procedure that are not drawn, each part once; only a part too long for a line breaks, after a slash."""

    def pieces(named: Column) -> Column:
        with_comma = F.transform(named, lambda p, i: F.when(i < F.size(named) - 1, F.concat(p, F.lit(","))).otherwise(p))
        return F.flatten(F.transform(with_comma, lambda p: F.when(F.char_length(p) <= LABEL_LIMIT, F.array(p)).otherwise(F.regexp_extract_all(p, F.lit("[^/]+/?"), 0))))

    space = lambda line: F.when(F.endswith(line, F.lit("/")), "").otherwise(" ")
    return F.concat(F.array(F.lit(NOT_SHOWN)), filled(pieces(F.array_distinct(parts)), lambda line, piece: F.concat(line, space(line), piece)))


def hold(inbound: Column, side: Column, altitude: Column) -> Column:
    """Hold 246° RT ≥9300', with the altitude's own label or none."""
    return F.concat_ws(" ", F.format_string("Hold %03d° %sT", inbound.cast("int"), side), altitude)


def speed(kias: Column, until: Column) -> Column:
    """≤200 KIAS until 9000' for a limit that ends on reaching an altitude, else only ≤200 KIAS."""
    feet = F.regexp_extract(F.coalesce(until, F.lit("")), r"^(?i)reaching (\d+)(?: MSL)?\z", 1)
    return F.concat(F.lit("≤"), kias.cast("string"), F.lit(" KIAS"), F.when(feet != "", F.concat(F.lit(" until "), feet, F.lit("'"))).otherwise(""))


def visual_climb(altitude: Column, bound: Column) -> Column:
    """VCOA (≥8200' SE bound); the direction only where the label still fits."""
    label = lambda inner: F.concat(F.lit("VCOA ("), inner, F.lit(")"))
    directed = label(F.concat(altitude, F.lit(" "), bound, F.lit(" bound")))
    return F.when(F.char_length(directed) <= LABEL_LIMIT, directed).otherwise(label(altitude))


def heading_range(sectors: Column, side: Column, altitude: Column) -> Column:
    """[LT hdg 256° CW 054°, or 179° CW 254°, 7700'] for sectors array<struct<start, clockwise, end>>: where a label may break."""

    def phrase(s: Column, i: Column) -> Column:
        sector = F.format_string("%03d° %s %03d°", s["start"].cast("int"), F.when(s["clockwise"], "CW").otherwise("CCW"), s["end"].cast("int"))
        opening = F.concat(F.when(side.isNotNull(), F.concat(side, F.lit("T "))).otherwise(""), F.lit("hdg "))
        return F.concat(F.when(i == 0, opening).otherwise("or "), sector)

    return F.array_compact(F.concat(F.transform(sectors, phrase), F.array(altitude)))


def leg_name(side: Column, phrase: Column) -> Column:
    """climbing right turn heading 077 to 7000: the name of the line of a leg."""
    turn = F.when(side == "R", "climbing right turn ").when(side == "L", "climbing left turn ").otherwise("")
    return F.concat(turn, phrase)


def heading_phrase(magnetic: Column, feet: Column) -> Column:
    """heading 077 to 7000, or heading 077 where it does not end at an altitude."""
    return F.concat_ws(" to ", F.format_string("heading %03d", magnetic.cast("int")), feet.cast("string"))


def radial_phrase(ident: Column, degrees: Column, outbound: Column) -> Column:
    """QVX R-210 inbound."""
    return F.concat(radial(degrees, ident), F.when(outbound, " outbound").otherwise(" inbound"))


def compass_point(word: Column) -> Column:
    """N of north or n, SE of southeast; null for anything else."""
    names = ("NORTH", "NORTHEAST", "EAST", "SOUTHEAST", "SOUTH", "SOUTHWEST", "WEST", "NORTHWEST")
    both = [F.lit(x) for pair in [*zip(names, POINTS), *zip(POINTS, POINTS)] for x in pair]
    return F.try_element_at(F.create_map(*both), F.upper(word))


def compass_bearing(point: Column) -> Column:
    """N is 0, NE 45, ... NW 315; null for anything else."""
    place = F.array_position(F.array(*[F.lit(p) for p in POINTS]), point)
    return F.when(place > 0, (place - 1) * 45)


def sixteenth_point(cardinal: Column, intercardinal: Column) -> Column:
    """Whether the two name one of the sixteen points together, as south-southwest does."""
    return (F.char_length(cardinal) == 1) & (F.char_length(intercardinal) == 2) & F.contains(intercardinal, cardinal)


def side_agrees(side: Column, inbound: Column) -> Column:
    """Whether a hold lies on that side of its fix, given the course inbound to it."""
    return F.abs(F.pmod(compass_bearing(side) - inbound, F.lit(360)) - 180) <= SIDE_TOLERANCE


def swept(start: Column, end: Column, clockwise: Column) -> Column:
    """Whole-degree headings of a sector, both ends included; 360 is 0."""
    first = F.when(clockwise, start).otherwise(end).cast("int")
    last = F.when(clockwise, end).otherwise(start).cast("int")
    return F.transform(F.sequence(F.lit(0), F.pmod(last - first, F.lit(360))), lambda step: F.pmod(first + step, F.lit(360)))


def other_headings(named: Column) -> Column:
    """The whole-degree headings that are not named, ascending."""
    return F.array_except(F.sequence(F.lit(0), F.lit(359)), named)


def fewest_lines(runways: Column, phrases: Column) -> Column:
    """The lines of a range of headings: the runways lead its first phrase, or lead it without its `hdg`, or stand alone.

    Of the ways that fit a label the one with the fewest lines wins, the first of them on ties; runways that fit no label are left out.
    """
    tag, first = runway_tag(runways), phrases[0]
    rest = F.slice(phrases, F.lit(2), F.greatest(F.size(phrases) - 1, F.lit(0)))
    leads = [F.concat(tag, F.lit(" "), first), F.concat(tag, F.lit(" "), F.regexp_replace(first, r"^(.*?)hdg ", "$1"))]
    standing = F.concat(F.lit("RWY "), tag)
    alone = F.when((tag != ALL_RUNWAYS) & (F.char_length(standing) <= LABEL_LIMIT), standing).otherwise(tag)
    ways = [F.when(F.char_length(lead) <= LABEL_LIMIT, wrapped(F.concat(F.array(lead), rest))) for lead in leads] + [F.concat(F.array(alone), wrapped(phrases))]
    ranked = F.transform(F.filter(F.array(*[F.struct(F.size(w).alias("n"), F.lit(i).alias("i"), w.alias("lines")) for i, w in enumerate(ways)]), lambda w: w["lines"].isNotNull()), lambda w: w)
    return F.when(tag.isNull(), wrapped(phrases)).otherwise(F.array_min(ranked)["lines"])
