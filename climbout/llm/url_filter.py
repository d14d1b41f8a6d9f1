"""URL filter: domain and path rules first, then a weighted vocabulary of URL terms.

An Aho-Corasick automaton of all terms runs over the lower-cased URL once.  Strict terms must stand
between boundaries (no letter or digit next to them); soft terms may stand anywhere.  One strict hit, or
soft hits of several distinct terms whose weights reach the threshold, reject the URL.

Boundaries are anything but a-z and 0-9, as in the SQL.

Defined results: a null or empty URL, or one without "://", has an empty host and path, fits no rule and
holds no term unless its text does; rows are judged one by one, so repeated rows repeat their verdict; of rules of
one length the alphabetically first holds; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The vocabulary; a strict term rejects alone, soft terms by their weights.
STRICT = ("porn", "xxx", "casino", "viagra", "cheap-pills", "spam-farm", "malware", "phishing", "warez", "escort")
SOFT = {"cheap": 1.0, "pills": 1.0, "spam": 1.0, "farm": 0.5, "free": 0.5, "bonus": 1.0, "win": 0.5, "bet": 1.0, "poker": 1.0, "adult": 1.0, "sex": 1.0, "hack": 1.0, "crack": 1.0, "torrent": 1.0, "loan": 1.0, "click": 0.5, "deal": 0.5, "xx": 1.0}
# The rules as (action, host, path prefix).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Sum of the weights of distinct soft terms that rejects; no single term reaches it.
SOFT_LIMIT = 1.5


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty without "://"."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """The longest rule, as host + path, that fits; the alphabetically first of equally long ones; else null."""
    out = F.lit(None).cast("string")
    for _, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        out = F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), h + p).otherwise(out)
    return out


def matcher(strict: tuple[str, ...], soft: dict[str, float]):
    """A function from a lower-cased URL to (strict terms hit, soft terms hit)."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for term in {*strict, *soft}:
        machine.add_word(term, term)
    machine.make_automaton()
    strong, inner = set(strict), frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

    def hits(url: str) -> tuple[list[str], list[str]]:
        hard, mild = set(), set()
        for end, term in machine.iter(url):
            if term in strong:
                begin = end - len(term)
                if not (begin >= 0 and url[begin] in inner) and not (end + 1 < len(url) and url[end + 1] in inner):
                    hard.add(term)
            if term in soft:
                mild.add(term)
        return sorted(hard), sorted(mild)

    return hits


def judge_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_limit: float = SOFT_LIMIT) -> DataFrame:
    """(page_id, host, path, rule, verdict, strict_hits, soft_hits) of every row of pages."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hits = matcher(tuple(strict), dict(soft))
        for batch in batches:
            found = [hits(u) for u in batch.pop("lowered")]
            batch["strict_hits"], batch["soft_hits"] = [f[0] for f in found], [f[1] for f in found]
            batch["reject"] = [bool(f[0]) or len(f[1]) > 1 and sum(soft[t] for t in f[1]) >= soft_limit for f in found]
            yield batch

    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), rule_for(host, path, rules).alias("rule"), ascii_lower(F.coalesce("url", F.lit(""))).alias("lowered"))
    kind = dict(rows.dtypes)["page_id"]
    scanned = rows.mapInPandas(scan, f"page_id {kind}, host string, path string, rule string, strict_hits array<string>, soft_hits array<string>, reject boolean")
    action = F.lit(None).cast("string")
    for a, h, p in rules:
        action = F.when(F.col("rule") == h + p, a).otherwise(action)
    verdict = F.coalesce(action, F.when(F.col("reject"), "block").otherwise("allow"))
    return scanned.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "strict_hits", "soft_hits")
