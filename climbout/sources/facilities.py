"""Typed facility tables from the published CSV archives, with the rows that cannot be typed as rows of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import runways
from .files import zipped_csv

# The published files and columns.  A column is (kind, source columns): text, text? (blank is null), number, number?, integer, integer?, east?.
Spec = dict[str, tuple[str, tuple[str, ...]]]
POSITION: Spec = {"lat": ("number", ("LAT_DECIMAL",)), "lon": ("number", ("LONG_DECIMAL",))}
AIRPORTS: Spec = {
    "lid": ("text", ("ARPT_ID",)), "icao": ("text?", ("ICAO_ID",)), "name": ("text", ("ARPT_NAME",)), "city": ("text", ("CITY",)), "state": ("text", ("STATE_CODE",)),
    **POSITION, "elevation_ft": ("number", ("ELEV",)), "mag_var_east": ("east?", ("MAG_VARN", "MAG_HEMIS")),
}
RUNWAYS: Spec = {"lid": ("text", ("ARPT_ID",)), "runway_id": ("text", ("RWY_ID",)), "length_ft": ("integer?", ("RWY_LEN",))}
ENDS: Spec = {
    "lid": ("text", ("ARPT_ID",)), "runway_id": ("text", ("RWY_ID",)), "end_id": ("text", ("RWY_END_ID",)), "lat": ("number?", ("LAT_DECIMAL",)), "lon": ("number?", ("LONG_DECIMAL",)),
    "elevation_ft": ("number?", ("RWY_END_ELEV",)), "true_alignment": ("integer?", ("TRUE_ALIGNMENT",)), "displaced_lat": ("number?", ("LAT_DISPLACED_THR_DECIMAL",)),
    "displaced_lon": ("number?", ("LONG_DISPLACED_THR_DECIMAL",)), "tora_ft": ("integer?", ("TKOF_RUN_AVBL",)),
}
NAVAIDS: Spec = {"ident": ("text", ("NAV_ID",)), "type": ("text", ("NAV_TYPE",)), "name": ("text", ("NAME",)), **POSITION, "elevation_ft": ("number?", ("ELEV",)), "mag_var_east": ("east?", ("MAG_VARN", "MAG_VARN_HEMIS"))}
FIXES: Spec = {"ident": ("text", ("FIX_ID",)), "state": ("text", ("STATE_CODE",)), **POSITION}
HOLDS: Spec = {
    "name": ("text", ("HP_NAME",)), "fix": ("text?", ("FIX_ID",)), "navaid": ("text?", ("NAV_ID",)), "inbound": ("integer", ("COURSE_INBOUND_DEG",)), "turn": ("text", ("TURN_DIRECTION",)),
    "leg_length_nm": ("number?", ("LEG_LENGTH_DIST",)), "direction": ("text?", ("HOLD_DIRECTION",)),
}
FILES = {
    "airports": ("APT_BASE.csv", AIRPORTS), "runways": ("APT_RWY.csv", RUNWAYS), "ends": ("APT_RWY_END.csv", ENDS),
    "navaids": ("NAV_BASE.csv", NAVAIDS), "fixes": ("FIX_BASE.csv", FIXES), "holds": ("HPF_BASE.csv", HOLDS),
}
TEST_NAVAID = "VOT"


def value(kind: str, sources: tuple[str, ...]) -> tuple[Column, Column]:
    """(typed value, whether the strings cannot be typed): a blank is null where that is allowed, and never zero."""
    raw = F.trim(F.coalesce(F.col(sources[0]), F.lit("")))
    if kind.startswith("text"):
        return (F.nullif(raw, F.lit("")), F.lit(False)) if kind == "text?" else (raw, F.lit(False))
    number = F.nullif(raw, F.lit("")).try_cast("double")
    wrong = number.isNull() & ((raw != "") | F.lit(not kind.endswith("?")))
    if kind.startswith("integer"):
        return number.cast("int"), wrong | F.coalesce(number != F.floor(number), F.lit(False))
    if kind == "east?":
        return F.when(F.upper(F.trim(sources[1])) == "E", number).otherwise(-number), wrong
    return number, wrong


def typed(rows: DataFrame, spec: Spec) -> tuple[DataFrame, DataFrame]:
    """(rows typed by the spec, rows that cannot be: (column, row as JSON), the first column that fails)."""
    values = {name: value(kind, sources) for name, (kind, sources) in spec.items()}
    wrong = F.coalesce(*[F.when(bad, F.lit(name)) for name, (_, bad) in values.items()])
    marked = rows.withColumn("_wrong", wrong)
    good = marked.where("_wrong is null").select(*[v.alias(name) for name, (v, _) in values.items()])
    return good, marked.where("_wrong is not null").select(F.col("_wrong").alias("column"), F.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("row"))


def keyed_holds(holds: DataFrame) -> DataFrame:
    """holds with the ident they are filed under as `fix`: the fix, or the navaid that they are flown at; those with neither are dropped."""
    return holds.withColumn("fix", F.coalesce("fix", "navaid")).where("fix is not null")


def load(spark: SparkSession, archives: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables by name, malformed rows (table, column, row)) of the archives at a path; closed airports are left out."""
    tables, bad = {}, None
    for name, (member, spec) in FILES.items():
        columns = list(dict.fromkeys(c for _, sources in spec.values() for c in sources))
        rows = zipped_csv(spark, archives, member, columns + (["SITE_TYPE_CODE", "ARPT_STATUS"] if name == "airports" else []))
        if name == "airports":
            rows = rows.where("SITE_TYPE_CODE = 'A' AND ARPT_STATUS = 'O'").drop("SITE_TYPE_CODE", "ARPT_STATUS")
        tables[name], wrong = typed(rows, spec)
        wrong = wrong.select(F.lit(name).alias("table"), "column", "row")
        bad = wrong if bad is None else bad.unionByName(wrong)
    tables["holds"] = keyed_holds(tables["holds"])
    return tables, bad


def by_ident(rows: DataFrame, key: str = "ident") -> DataFrame:
    """(key, places): all rows of an ident as an array of structs, in the order of their values; only few share one."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in rows.columns if c != key]))).alias("places"))


def gradients_by_runway(entries: Column) -> Column:
    """array<struct<runway, ft_per_nm, to_ft>> as a map from the canonical runway to its climb, for lookups by runway."""
    return F.map_from_entries(F.transform(entries, lambda g: F.struct(runways.canonical(g["runway"]).alias("key"), F.struct(g["ft_per_nm"].alias("ft_per_nm"), g["to_ft"].alias("to_ft")).alias("value"))))
