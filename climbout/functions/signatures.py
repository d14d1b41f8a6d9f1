"""Tokens, phrase signatures and finding keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that never name a facility, the abbreviations kept in signatures, the token pattern.
RESERVED = (
    "ATC", "CCW", "CW", "DER", "DME", "IFR", "KIAS", "LT", "MCA", "MEA", "MOCA", "MSL", "NA", "NDB", "RNAV", "RT", "VCOA", "VOR", "VORTAC",
)
KEPT = (
    "AGL", "AMDT", "ATC", "CCW", "CW", "DER", "DME", "DP", "DVA", "E", "FAA", "FT", "ICA", "IFR", "ILS", "KIAS", "KT", "LOC", "LT", "MCA", "MEA",
    "MOCA", "MSL", "N", "NA", "NDB", "NE", "NM", "NW", "ODP", "ORIG", "RNAV", "RT", "S", "SE", "SID", "SM", "STAR", "SW", "TACAN", "TODA", "TORA",
    "VCA", "VCOA", "VFR", "VOR", "VORTAC", "W",
)
TOKEN = r"\.\.\.|R-\d+|\d+(?:\.\d+)?[A-Za-z]*|[A-Za-z][A-Za-z0-9]*|\S"


def tokens(text: Column) -> Column:
    """All tokens of a text; only white space is dropped."""
    return F.regexp_extract_all(text, F.lit(f"(?U)({TOKEN})".replace(r"\d", "[0-9]")), 1)


def is_ident_word(word: Column) -> Column:
    return word.rlike(r"^[A-Z]{2,}\z") & ~word.isin(*RESERVED)


def phrase_signature(phrase: Column) -> Column:
    """The phrase with radials, numbers and names abstracted."""
    out = F.regexp_replace(phrase, r"R-\d+", "R-<n>")
    out = F.regexp_replace(out, r"(?U)(?<![<\w])\d+(?:\.\d+)?", "<n>")
    out = F.regexp_replace(out, rf"(?U)\b(?!(?:{'|'.join(RESERVED)})\b)[A-Z]{{2,}}\b", "<id>")
    return F.lower(F.regexp_replace(out, r"(?U)\s+", " "))


def finding_signature(text: Column, airport: Column | None = None) -> Column:
    """The text as it reads for any airport: names blurred, lower case, digits as runs of n.

    airport is a column of plain letters and digits (or null); it is blurred in any case of letters.
    """
    if airport is not None:
        own = F.concat(F.lit(r"(?iU)\b"), F.regexp_replace(airport, r"([^A-Za-z0-9])", r"\\$1"), F.lit(r"\b"))
        # a pattern of its own for each row is dear: only for texts that hold the airport in some case of letters
        plain = lambda c: F.lower(F.upper(F.translate(c, "İ", "I")))
        named = (F.coalesce(airport, F.lit("")) != "") & F.contains(plain(text), plain(airport))
        text = F.when(named, F.regexp_replace(text, own, F.lit("ID"))).otherwise(text)
    out = F.regexp_replace(text, rf"(?U)\b(?!(?:{'|'.join(KEPT)})\b)(?![0-9]+\b)[A-Z0-9]{{2,5}}\b", "ID")
    out = F.regexp_replace(F.regexp_replace(F.lower(out), r"(?U)\s+", " "), r"^ | \z", "")
    return F.regexp_replace(out, r"(?U)\d", "n")


def signature_key(kind: Column, signature: Column, airport: Column | None = None) -> Column:
    return F.sha1(F.encode(F.concat(kind, F.lit(":"), finding_signature(signature, airport)), "UTF-8"))
