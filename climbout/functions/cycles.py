"""The 28-day publication calendar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A publication day and the length of a cycle.
DATUM, DAYS = "2020-12-03", 28


def containing(day: Column) -> Column:
    """Effective date of the cycle that holds the day."""
    datum = F.lit(DATUM).cast("date")
    return F.date_add(datum, (F.floor(F.datediff(day, datum) / DAYS) * DAYS).cast("int"))


def is_boundary(day: Column) -> Column:
    return F.pmod(F.datediff(day, F.lit(DATUM).cast("date")), F.lit(DAYS)) == 0


def checked(day: Column) -> Column:
    """The day itself if a cycle starts on it; else an error."""
    return F.when(is_boundary(day), day).otherwise(F.raise_error(F.concat(F.lit("not a cycle date: "), day.cast("string"))).cast("date"))


def following(day: Column) -> Column:
    return F.date_add(day, DAYS)


def code(day: Column) -> Column:
    """YYCC: year and number of the cycle within the year of its effective date."""
    new_year = F.trunc(day, "year")
    first = containing(new_year)
    first = F.when(first == new_year, first).otherwise(following(first))
    number = (F.datediff(day, first) / DAYS).cast("int") + 1
    return F.concat(F.date_format(day, "yy"), F.lpad(number.cast("string"), 2, "0"))


def tag(day: Column) -> Column:
    return F.date_format(day, "dd_MMM_yyyy")
