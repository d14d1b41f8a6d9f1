"""Canonical spelling of departure-procedure text.

A rule is a joint: what stands between a left and a right context is replaced.  Joints that put the same text share one
alternation and so one pass over the text; a context is captured and written back, which needs no lookbehind.  The passes
are plain nested expressions inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Glyph pairs of the published text.
QUOTES = ("‘’“”º", "''\"\"°")
FRACTIONS = {"¼": "1/4", "½": "1/2", "¾": "3/4", "⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8"}

#: Blanks within a line, and any white space, as character classes.
BLANK = r"[\h\f\r\x0B\x1C-\x1F\x85\u2028\u2029&&[^\u180e]]"
SPACE = rf"(?:{BLANK}|\n)"
HEADING = r"\b(?i:heading|hdg)"

Joint = tuple[str, str, str]

#: (text to put, what its joints open with, joints (left, between, right)): what a line says before its blanks are settled.
#: The opening characters are looked for first, so that all other places of a text are passed in one step.
WORDING: tuple[tuple[str, str, tuple[Joint, ...]], ...] = (
    ("...", r"[.]", (("", r"\.(?:[ \t]?\.){2,}", ""),)),
    ("R-", r"[Rr]", (("", rf"\b[Rr][-·]{SPACE}*", r"\d{3}\b"),)),
    (" ", r"[Hh\d]", ((HEADING, "", r"\d"), (r"\d", "", f"[{''.join(FRACTIONS)}]"))),
    ("", r"[VNHh\d]", ((r"\b(?:VOR|NDB)/", f"{SPACE}+", r"DME\b"), (rf"{HEADING} \d{{1,3}}", r"\.0+\b", ""), (r"(?<![\d,])\d{1,2}", ",", r"\d{3}(?![\d,])"))),
    ("-in-", r"[Cc]", ((r"\b(?i:climb)", rf"(?i:-in{SPACE}*-?|{SPACE}+in{SPACE}*-){SPACE}*", r"(?i:hold)"),)),
    (" or ", r"[Aa]", ((r"\b(?i:at)", "/", r"(?i:above)\b"),)),
    (" KIAS", r"[Ee]", ((r"\b(?i:exceed) \d+", r" ?(?i:k|kts?|knots)\b", ""),)),
    (".", r"[.]", (("", r"(?<!\.)\.\.(?!\.)", ""),)),
    ("with a min.", r"[w]", (("", r"\bw(?:/ ?|ith a )min\b\.?", ""),)),
    ("VCOA", r"[V]", (("", r"\bVOCA\b", ""),)),
    (" to ", r"[Rr]", ((r"\b(?i:runway heading)", f"{SPACE}+", r"[1-9]\d{3,4}\b"),)),
    (" ft", r"[\d]", ((r"\d", "'", r"\s*(?:per NM|/NM)"),)),
    ("", r"[\d]", ((r"\d", "'", ""),)),
    (" ", r"[^!-~]", (("", f"{BLANK}+", ""),)),
)
#: The same for lines whose blanks are settled.
PHRASES: tuple[tuple[str, str, tuple[Joint, ...]], ...] = (
    ("proceeding", r"[p]", (("", r"\bpreceding", r" on course\b"),)),
    ("limb", r"[Cc]", ((r"\b[Cc]", "ontinue climb(?:ing)?", r" on course\b"),)),
    ("", r"[\noHh]", (("\n\n", "\n+", ""), (r"\bof", " of", r"\b"), (r"\b(?i:holding pattern)", r"\.", r" \((?i:hold)\b"))),
)


def put(text: Column, what: str, opens: str, joints: tuple[Joint, ...]) -> Column:
    """text with `what` at all the joints, each of which opens with a character of the class `opens`."""
    places = "|".join(f"({left}){between}" + (f"(?={right})" if right else "") for left, between, right in joints)
    back = "".join(f"${k + 1}" for k in range(len(joints)))
    return F.regexp_replace(text, f"(?={opens})(?:{places})", back + what)


def normalize(text: Column) -> Column:
    """The canonical spelling; null stays null."""
    text = F.replace(F.translate(text, *QUOTES), F.lit("…"), F.lit("..."))
    for what, opens, joints in WORDING:
        text = put(text, what, opens, joints)
    for glyph, plain in FRACTIONS.items():
        text = F.replace(text, F.lit(glyph), F.lit(plain))
    text = F.replace(F.replace(text, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    for what, opens, joints in PHRASES:
        text = put(text, what, opens, joints)
    return F.btrim(text, F.lit(" \n"))
