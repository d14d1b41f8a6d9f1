"""The section on climbs in visual conditions, a row for each of its lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import runways, signatures
from ..sources.sinks import written
from . import procedures

# The published sentences of the section and the words of its names.
LEADING = r"(?:(?i:Rwys?) (\d{1,2}[LRC]?(?:/[LRC])*(?:, ?\d{1,2}[LRC]?(?:/[LRC])*)*)[,:] |(?i:All) (?:Rwys|runways)[,:] )?"
APPROVAL = r"(?i:obtain ATC approval for (?:VCOA|climb in visual conditions) when requesting IFR clearance)\. "
NAME = r"((?:(?:[A-Z][A-Za-z0-9.']*(?:[/-][A-Za-z0-9.']+)*|[/()-]|\([A-Z][A-Za-z. ]*\)|airport|at|du) )+?)"
BOUND = rf"(?:({procedures.POINT}) ?bound )?"
NOTICE = r"(?: When executing (?:the )?VCOA,? notify ATC prior to departure\.)?"
LIMIT = r"(?: Do not exceed (\d+) KIAS(?: until ([^.]+))?\.)?"
LINE = rf"^{LEADING}{APPROVAL}(?i:climb in visual conditions to cross) {NAME}{BOUND}(?:at )?or above (\d{{3,5}})(?: MSL)?,?((?: [^.]+)?(?:\.\.\.)?)(?:(?<=\.\.\.)|\.){NOTICE}{LIMIT}{NOTICE}\z"
INTO_TAIL = "visual climb into the shared tail"
SEVERAL = "speed limit after several visual climbs"


def read(sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(climbs, failures) of sections(block, vcoa), the section's lines each naming runways or, with none named, all.

    climbs: block, line, runways, cross (a fix, null for the departure airport), bound, feet, kias, until_phrase, legs.
    failures: block, line, signature.  A speed limit behind the last of several climbs could mean any of them: it
    fails.  Blocks without a section have neither; a section's lines may be read although others of it fail.
    """
    lines = sections.select("block", F.posexplode(F.split("vcoa", "\n")).alias("line", "raw")).where("raw <> ''")
    group = lambda i: F.nullif(F.trim(F.regexp_extract("raw", LINE, i)), F.lit(""))
    last = lines.groupBy("block").agg(F.max("line").alias("_last"), F.min("line").alias("_first"))
    name = F.col("name")
    fix = name.rlike(r"^[A-Z]{5}\z")
    navaid = name.rlike(rf"\b{procedures.TYPE}\b")
    shaped = lines.join(last.hint("merge"), "block").select("block", "line", "raw", "_last", "_first", F.col("raw").rlike(LINE).alias("fits"), F.coalesce(runways.expand(group(1)), F.expr("cast(array() as array<string>)")).alias("runways"), group(2).alias("name"), group(3).alias("bound"), group(4).cast("int").alias("feet"), group(5).alias("body"), group(6).cast("int").alias("kias"), group(7).alias("until_phrase"))
    unclear = F.col("kias").isNotNull() & (F.col("line") == F.col("_last")) & (F.col("line") > F.col("_first"))
    named = (fix | name.rlike(r"[A-Za-z][a-z]")) & ~navaid
    unread = F.concat(F.lit('unmatched phrase "'), signatures.phrase_signature(F.col("raw")), F.lit('"'))
    rows = shaped.withColumn("_failure", F.when(~F.col("fits"), unread).when(~named, F.when(navaid, "unsupported VCOA crossing a navaid").otherwise(unread)).when(unclear, SEVERAL))
    rows = written(rows.withColumn("cross", F.when(fix, name)), "visual_climbs")  # read for their legs and again beside them
    flown = procedures.legs(rows.where("_failure is null and body is not null").select("block", "line", "runways", "body"), check_holds=True)
    tail = F.when(F.col("leg.node") == "Thence", INTO_TAIL)
    one = F.struct("seq", F.struct("turns", "side", "leg").alias("step"))
    read_ = flown.groupBy("block", "line").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["step"]).alias("legs"), F.min_by(F.coalesce("signature", tail), F.when(F.coalesce("signature", tail).isNotNull(), F.col("seq"))).alias("_leg_failure"))
    all_ = rows.join(read_.hint("merge"), ["block", "line"], "left").withColumn("signature", F.coalesce("_failure", "_leg_failure"))
    climbs = all_.where("signature is null").select("block", "line", "runways", "cross", "bound", "feet", "kias", "until_phrase", "legs")
    return climbs, all_.where("signature is not null").select("block", "line", "signature")
