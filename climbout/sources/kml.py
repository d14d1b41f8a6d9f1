"""KML elements as Column expressions, and the one file they go to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import shades

# Line widths, KML colours (aabbggrr) of the six palettes, scale of a label's icon.
WIDTHS = {"route": 10, "radial": 5, "hold": 8, "vcoa": 5}
PALETTES = ("ff8b3a1e", "ff1e1ec8", "ff287814", "ffa01e78", "ff0078e6", "ff14466e")
ICON_SCALE = "0.1"


def escaped(c: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def coordinate(lon: Column, lat: Column) -> Column:
    return F.format_string("%.5f,%.5f", lon, lat)


def line_placemark(name: Column, style: Column, points: Column) -> Column:
    path = F.array_join(F.transform(points, lambda p: coordinate(p["lon"], p["lat"])), " ")
    return F.concat(F.lit("<Placemark><name>"), escaped(name), F.lit("</name><styleUrl>#"), style, F.lit("</styleUrl><LineString><coordinates>"), path, F.lit("</coordinates></LineString></Placemark>"))


def label_placemark(name: Column, style: Column, lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("<Placemark><name>"), escaped(name), F.lit("</name><styleUrl>#"), style, F.lit("</styleUrl><Point><coordinates>"), coordinate(lon, lat), F.lit("</coordinates></Point></Placemark>"))


def line_style(style_id: Column, colour: Column, width: Column) -> Column:
    return F.concat(F.lit('<Style id="'), style_id, F.lit('"><LineStyle><color>'), colour, F.lit("</color><width>"), width.cast("string"), F.lit("</width></LineStyle></Style>"))


def shared_styles(spark: SparkSession) -> DataFrame:
    """(palette, style, style_id, kml) of every palette: a line style for each kind of line, and the label style."""
    kinds = [*WIDTHS.items(), ("label", None)]
    rows = spark.createDataFrame([(p, c, kind, width) for p, c in enumerate(PALETTES) for kind, width in kinds], "palette int, colour string, style string, width int")
    name = F.concat_ws("-", "style", "palette")
    label = F.concat(F.lit('<Style id="'), name, F.lit('"><IconStyle><color>'), "colour", F.lit(f"</color><scale>{ICON_SCALE}</scale></IconStyle></Style>"))
    return rows.select("palette", "style", name.alias("style_id"), F.when(F.col("style") == "label", label).otherwise(line_style(name, F.col("colour"), F.col("width"))).alias("kml"))


def runway_order(group: Column) -> Column:
    """What groups of runways are sorted by: 4, 16L and 16R, 22, 34, and names without a number before them."""
    return F.transform(group, lambda r: F.struct(F.coalesce(F.nullif(F.regexp_extract(r, r"^\d*", 0), F.lit("")).cast("int"), F.lit(0)).alias("number"), r.alias("runway")))


def group_styles(lines: DataFrame) -> DataFrame:
    """lines(lid, palette, style, grp array<string>, ...) with style_id, and colour where the line has a shade of its own.

    An airport whose lines belong to several groups of runways gives each group a shade; an empty group is none.
    """
    named = lines.where(F.size("grp") > 0).select("lid", "grp").distinct()
    rank = F.row_number().over(Window.partitionBy("lid").orderBy(runway_order(F.col("grp")))) - 1
    ranked = named.select("lid", "grp", rank.alias("_i"), F.count("*").over(Window.partitionBy("lid")).cast("int").alias("_n"))
    shared = F.concat_ws("-", "style", "palette")
    own = F.col("_n") > 1
    base = F.element_at(F.array(*[F.lit(c) for c in PALETTES]), F.col("palette") + 1)
    rows = lines.join(ranked, ["lid", "grp"], "left").withColumn("style_id", F.when(own, F.concat_ws("-", shared, "_n", "_i")).otherwise(shared))
    # Shades depend on the palette and the number of groups alone, so they are worked out once for each pair of those.
    pairs = rows.where(own).select("palette", "_n").distinct()
    each = pairs.select("palette", "_n", F.posexplode(shades.shades(base, F.col("_n"), PALETTES)).alias("_i", "colour"))
    return rows.join(each, ["palette", "_n", "_i"], "left").drop("_i", "_n")


def folders(placemarks: DataFrame) -> DataFrame:
    """placemarks(lid, seq, kml) as one folder per airport."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("seq", "kml"))), lambda x: x["kml"])
    return placemarks.groupBy("lid").agg(F.concat(F.lit("<Folder><name>"), escaped(F.col("lid")), F.lit("</name>"), F.array_join(parts, ""), F.lit("</Folder>")).alias("kml"))


def write_document(folders_: DataFrame, path: str, name: str) -> None:
    """One KML file on the driver, folder after folder, as they arrive in order of lid."""
    with open(path, "w", encoding="utf-8") as out:
        out.write(f'<?xml version="1.0" encoding="UTF-8"?>\n<kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>{name}</name>')
        for row in folders_.orderBy("lid").toLocalIterator():
            out.write(row["kml"])
        out.write("</Document></kml>\n")
