"""Runway identifiers, published climb gradients, speed limits, and value parsers of facility files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the minimums text.
RUNWAY_LIST = r"\d{1,2}[LRC]?(?:/[LRC])?(?:\s*,\s*\d{1,2}[LRC]?(?:/[LRC])?)*"
ENTRY = rf"(?m)\bRwys? ({RUNWAY_LIST})\s*,(.*?)(?=\bRwys? \d|$)"
GRADIENT = r"\bstd\. with a min\. climb of (\d+) ft per NM(?: (?:to|until passing) (\d+)\b)?"
SPEED = r"(?i)\b\d{2,3} ?(?:K|KIAS|KTS?|knots)\b"


def blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def number(c: Column) -> Column:
    """Blank is null, never zero."""
    return F.when(~blank(c), F.trim(c).cast("double"))


def integer(c: Column) -> Column:
    return number(c).cast("int")


def position(lat: Column, lon: Column) -> Column:
    """struct<lat, lon>, null if either is blank."""
    return F.when(~blank(lat) & ~blank(lon), F.struct(number(lat).alias("lat"), number(lon).alias("lon")))


def variation(value: Column, hemisphere: Column) -> Column:
    """East positive, anything else negative."""
    return F.when(F.upper(F.trim(hemisphere)) == "E", number(value)).otherwise(-number(value))


def canonical(runway: Column) -> Column:
    """4 becomes 04, 4l becomes 04L; other names are only upper-cased."""
    padded = F.concat(F.lpad(F.regexp_extract(runway, r"^(\d{1,2})", 1), 2, "0"), F.upper(F.regexp_extract(runway, r"^\d{1,2}([A-Za-z]?)\z", 1)))
    return F.when(runway.rlike(r"^\d{1,2}[A-Za-z]?\z"), padded).otherwise(F.upper(runway))


def expand(runway_list: Column) -> Column:
    """'2L/R, 35' becomes [2L, 2R, 35]."""
    each = F.regexp_extract_all(runway_list, F.lit(r"(\d{1,2}[LRC]?(?:/[LRC])*)"), 1)

    def sides(item: Column) -> Column:
        digits = F.regexp_extract(item, r"^(\d+)", 1)
        parts = F.split(item, "/")
        return F.concat(F.slice(parts, 1, 1), F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda s: F.concat(digits, s)))

    return F.flatten(F.transform(each, sides))


def entries(text: Column) -> Column:
    """array<struct<runways, body>> of the runway entries of a minimums text."""
    whole = F.regexp_extract_all(text, F.lit(ENTRY), 0)
    return F.transform(whole, lambda e: F.struct(expand(F.regexp_extract(e, rf"^Rwys? ({RUNWAY_LIST})", 1)).alias("runways"), F.regexp_replace(e, rf"^Rwys? {RUNWAY_LIST}\s*,", "").alias("body")))


def gradients(text: Column) -> Column:
    """array<struct<runway, ft_per_nm, to_ft>>; of entries for one runway the last holds."""
    steep = F.filter(entries(text), lambda e: e["body"].rlike(GRADIENT))
    rows = F.flatten(
        F.transform(
            steep,
            lambda e: F.transform(
                e["runways"],
                lambda r: F.struct(
                    r.alias("runway"),
                    F.regexp_extract(e["body"], GRADIENT, 1).cast("double").alias("ft_per_nm"),
                    F.nullif(F.regexp_extract(e["body"], GRADIENT, 2), F.lit("")).cast("int").alias("to_ft"),
                ),
            ),
        )
    )
    return F.filter(rows, lambda g, i: ~F.exists(F.slice(rows, i + 2, F.greatest(F.size(rows), F.lit(1))), lambda later: later["runway"] == g["runway"]))


def speed_limit(text: Column, runways: Column) -> Column:
    """The first line with a speed limit that may bind any of the runways (an empty array: all)."""
    lines = F.split(text, "\n")

    def binds(line: Column) -> Column:
        named = F.flatten(F.transform(entries(line), lambda e: e["runways"]))
        return line.rlike(SPEED) & ((F.size(named) == 0) | (F.size(runways) == 0) | F.arrays_overlap(named, runways))

    return F.try_element_at(F.filter(lines, binds), F.lit(1))
