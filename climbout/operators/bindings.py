"""Joins that bind a procedure to its airport, runways, holds and navaids, and the reconciliation of blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geodesy
from .facilities import TASKS_A_CORE, chunked, reciprocals

# Destinations of the front matter, length of an id that has a destination.
FRONT_MATTER = ("DPs", "DVA", "ICA")
DESTINATION_ID = 3


def airports_with_runways(airports: DataFrame, runways: DataFrame, ends: DataFrame) -> DataFrame:
    """airports(lid, ...) with their runways(lid, seq, runway_id, length_ft) in file order, each with its ends(lid, runway_id, seq, end_id).

    An airport without runways, and a runway without ends, has an empty array.
    """
    held = ends.groupBy("lid", "runway_id").agg(F.array_sort(F.collect_list(F.struct("seq", "end_id"))).alias("ends"))
    each = runways.join(held, ["lid", "runway_id"], "left").withColumn("ends", F.transform(F.coalesce("ends", F.expr("cast(array() as array<struct<seq:bigint,end_id:string>>)")), lambda e: e["end_id"]))
    nested = each.groupBy("lid").agg(F.array_sort(F.collect_list(F.struct("seq", "runway_id", "length_ft", "ends"))).alias("runways"))
    out = airports.join(nested, "lid", "left")
    return out.withColumn("runways", F.coalesce("runways", F.slice(F.array(F.struct(F.lit(0).cast("long").alias("seq"), F.lit("").alias("runway_id"), F.lit(0).cast("int").alias("length_ft"), F.expr("cast(array() as array<string>)").alias("ends"))), 1, 0)))


def runway_starts(departures: DataFrame, airports: DataFrame, runways: DataFrame, ends: DataFrame) -> DataFrame:
    """departures(lid, runway) with where and how high the runway's departure end is, its true course, or a failure.

    airports(lid, elevation_ft), runways(lid, runway_id, length_ft), ends(lid, runway_id, end_id, lat, lon, elevation_ft, tora_ft).
    The departure end is the other end, pulled back where the run available is shorter than the runway.
    """
    both = reciprocals(ends, ["lid"]).withColumnRenamed("end_id", "runway").join(runways, ["lid", "runway_id"])
    out = departures.join(both, ["lid", "runway"], "left").join(airports.select("lid", F.col("elevation_ft").alias("field_ft")), "lid", "left")
    here, there = (F.col("lat"), F.col("lon")), (F.col("other_lat"), F.col("other_lon"))
    missing = F.greatest(*[c.isNull() for c in (*here, *there)])
    short = F.coalesce(F.greatest(F.col("length_ft") - F.col("tora_ft"), F.lit(0)), F.lit(0)) / geodesy.FEET_PER_NM
    moved = geodesy.destination(*there, geodesy.bearing(*there, *here), short)
    der = F.when(~missing, F.when(short > 0, moved).otherwise(F.struct(there[0].alias("lat"), there[1].alias("lon"))))
    out = out.withColumn("der", der)
    return out.select(
        "lid", "runway", F.col("der.lat").alias("der_lat"), F.col("der.lon").alias("der_lon"), F.when(~missing, F.coalesce("other_elevation_ft", "field_ft")).alias("der_elevation_ft"),
        F.when(~missing, geodesy.bearing(*here, *there)).alias("course_true"), F.when(missing, F.lit("runway end position missing")).alias("failure"),
    )


def matching_holds(legs: DataFrame, holds: DataFrame, navaids: DataFrame) -> DataFrame:
    """legs(block, fix) with the published holds(fix, navaid, ...) that may be meant; none gives no row.

    A hold counts if it has no navaid, if that is its fix, or if it is one of the block's navaids(block, ident).  That is
    decided once for all holds of a fix and navaid.  The legs and the holds of both are arrays of bounded length, met by a merge join and
    dealt over all cores before they are paired, so that no task holds a frequent fix and no copies of the holds pass through the driver.
    """
    shares = TASKS_A_CORE * legs.sparkSession.sparkContext.defaultParallelism
    kinds = holds.select("fix", "navaid").distinct()
    known = navaids.select("block", F.col("ident").alias("navaid")).distinct()
    free = legs.join(kinds.where("navaid is null or navaid = fix"), "fix")
    tied = legs.join(known.hint("merge"), "block").where("navaid <> fix").join(kinds, ["fix", "navaid"], "left_semi")
    own, rest = ([c for c in frame.columns if c not in ("fix", "navaid")] for frame in (legs, holds))
    flown = chunked(free.unionByName(tied), ["fix", "navaid"], own, shares).select(F.col("fix").alias("_fix"), F.col("navaid").alias("_navaid"), F.col("_members").alias("_legs"))
    same = (F.col("fix") == F.col("_fix")) & F.col("navaid").eqNullSafe(F.col("_navaid"))
    both = flown.join(chunked(holds, ["fix", "navaid"], rest).hint("merge"), same).repartition(shares)
    return both.select("fix", "navaid", "_members", F.inline("_legs")).select(*legs.columns, "navaid", F.inline("_members"))


def variation(airports: DataFrame, model: DataFrame) -> DataFrame:
    """airports(lid, published) with variation_east: the published one, else that of model(lid, declination)."""
    found = F.coalesce("published", "declination")
    source = F.when(F.col("published").isNotNull(), "published").when(F.col("declination").isNotNull(), "model")
    return airports.join(model, "lid", "left").select("lid", found.alias("variation_east"), source.alias("source"))


def same_places(points: DataFrame) -> DataFrame:
    """points(block, ident, is_fix, lat, lon), one row per block and ident: a navaid before a fix, and whether all lie at one place."""
    spot = F.struct("is_fix", "lat", "lon")
    one = points.groupBy("block", "ident").agg(F.min(spot).alias("kept"), (F.count_distinct(F.struct("lat", "lon")) > 1).alias("ambiguous"))
    return one.select("block", "ident", "kept.*", "ambiguous")


def named_navaids(wanted: DataFrame, refs: DataFrame) -> DataFrame:
    """wanted(block, name, type) with the ident that the block's refs(block, name, type, ident) give the name, or a failure.

    A name counts if all its references agree on ident and type, and that type is the wanted one.
    """
    each = refs.where("name is not null").groupBy("block", "name").agg(F.min(F.struct("ident", "type")).alias("low"), F.max(F.struct("ident", "type")).alias("high"))
    sure = each.where("low = high").select("block", "name", "low.ident", F.col("low.type").alias("_type"))
    out = wanted.join(sure, ["block", "name"], "left")
    ident = F.when(F.col("type") == F.col("_type"), F.col("ident"))
    return out.select("block", "name", "type", ident.alias("ident"), F.when(ident.isNull(), F.lit("navaid without ident")).alias("failure"))


def metafile_check(blocks: DataFrame, expected: DataFrame) -> DataFrame:
    """(volume, lid, warning) of expected(volume, lid, icao, seq) airports without a block and blocks(volume, lid) without an airport.

    A printed id may be the airport's LID, its ICAO id, or its LID after a K; of airports with one alias the later holds.
    """
    alias = expected.select("volume", "lid", "seq", F.explode(F.array_distinct(F.array("lid", "icao"))).alias("alias")).where("alias <> ''")
    alias = alias.groupBy("volume", "alias").agg(F.max_by("lid", "seq").alias("means"))
    bare = F.when((F.length("lid") == 4) & F.col("lid").startswith("K"), F.substring("lid", 2, 3))
    printed = blocks.select("volume", F.col("lid").alias("block"), F.explode(F.array("lid", bare)).alias("alias")).where("alias is not null")
    met = printed.join(alias, ["volume", "alias"])
    lone = expected.select("volume", "lid").distinct().join(met.select("volume", F.col("means").alias("lid")).distinct(), ["volume", "lid"], "left_anti")
    odd = blocks.select("volume", "lid").join(met.select("volume", F.col("block").alias("lid")).distinct(), ["volume", "lid"], "left_anti")
    say = lambda frame, before, after: frame.select("volume", "lid", F.concat("volume", F.lit(f": {before} "), "lid", F.lit(f" {after}")).alias("warning"))
    return say(lone, "metafile airport", "has no block").unionByName(say(odd, "block", "has no metafile airport"))


def destination_check(blocks: DataFrame, destinations: DataFrame, mentioned: DataFrame, headings: DataFrame) -> DataFrame:
    """(volume, lid, warning): destinations(volume, name) without blocks(volume, lid), blocks without destinations, repeated ids.

    Ids that are only mentioned(volume, name), never in headings(volume, name), and the front matter's are no destinations.
    """
    only = mentioned.join(headings, ["volume", "name"], "left_anti")
    real = destinations.where(~F.col("name").isin(*FRONT_MATTER)).join(only, ["volume", "name"], "left_anti").select("volume", F.col("name").alias("lid")).distinct()
    counted = blocks.withColumn("_n", F.count("*").over(Window.partitionBy("volume", "lid")))
    lone = real.join(blocks, ["volume", "lid"], "left_anti").withColumn("warning", F.concat("volume", F.lit(": destination ("), "lid", F.lit(") has no block")))
    bare = blocks.where(F.length("lid") == DESTINATION_ID).join(real, ["volume", "lid"], "left_anti").select("volume", "lid", F.concat("volume", F.lit(": block "), "lid", F.lit(" has no named destination")).alias("warning"))
    twice = counted.where("_n > 1").select("volume", "lid", F.concat("volume", F.lit(": duplicate LID "), "lid").alias("warning")).distinct()
    return lone.unionByName(bare).unionByName(twice)
