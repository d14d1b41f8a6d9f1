"""Ranges of headings: sectors merged on the circle, wedges that read alike drawn as one, and what a fan draws.

Sectors are (start, sweep): degrees from a start, clockwise if positive.  Merging is gaps and islands by running maxima
on the circle cut at north, with the islands on both sides of the cut joined again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geodesy, labels
from .routes import RADIUS

# Apart at most to be drawn as one, reach of a fan, straight part behind a turn, dash and gap of its arc.
SHARED_NM, REACH_NM, STRAIGHT_NM, DASH_NM, GAP_NM, EPSILON = 1.5, 1.0, 0.3, 0.12, 0.1, 1e-6
EMPTY = "empty heading sector"


def sweep(start: Column, end: Column, clockwise: Column) -> Column:
    """Signed degrees from start to end; null for a sector whose ends coincide, which is no full circle."""
    right, left = geodesy.wrap360(end - start), geodesy.wrap360(start - end)
    return F.when(right != 0, F.when(clockwise, right).otherwise(-left))


def merged_sectors(sectors: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, sweep) of the union of the sectors(keys, start, sweep) of each key, clockwise; (0, 360) is the whole circle.

    Sectors that touch are one.  Rows of null or empty sweeps add nothing.
    """
    first = geodesy.wrap360(F.when(F.col("sweep") < 0, F.col("start") + F.col("sweep")).otherwise(F.col("start")).cast("double"))
    size = F.least(F.abs(F.col("sweep")).cast("double"), F.lit(360.0))
    # cut at north: a sector across it is two
    parts = F.when(first + size > 360, F.array(F.struct(first.alias("a"), F.lit(360.0).alias("b")), F.struct(F.lit(0.0).alias("a"), (first + size - 360).alias("b")))).otherwise(F.array(F.struct(first.alias("a"), (first + size).alias("b"))))
    rows = sectors.where("sweep <> 0").select(*keys, F.explode(parts).alias("p")).select(*keys, "p.*")
    order = Window.partitionBy(*keys).orderBy("a", "b")
    till = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_island", F.sum(F.when(F.col("a") <= till, 0).otherwise(1)).over(order))
    islands = rows.groupBy(*keys, "_island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    each = Window.partitionBy(*keys)
    low, high = F.min("a").over(each), F.max("b").over(each)
    joined = (low == 0) & (high == 360)
    islands = islands.withColumn("_joined", joined).withColumn("_low_end", F.max(F.when(F.col("a") == 0, F.col("b"))).over(each)).withColumn("_n", F.count("*").over(each))
    # the island that ends at north goes on with the one that begins there
    goes_on = F.col("_joined") & (F.col("b") == 360) & (F.col("_n") > 1)
    kept = islands.where(~(F.col("_joined") & (F.col("a") == 0) & (F.col("_n") > 1)))
    return kept.select(*keys, F.col("a").alias("start"), (F.col("b") - F.col("a") + F.when(goes_on, F.col("_low_end")).otherwise(0.0)).alias("sweep"))


def mean_course(courses: Column) -> Column:
    """Circular mean of an array of courses."""
    total = lambda f: F.aggregate(courses, F.lit(0.0), lambda s, c: s + f(F.radians(c)))
    return geodesy.course_of(total(F.sin), total(F.cos))


def shared_wedges(wedges: DataFrame, reach: float = SHARED_NM) -> DataFrame:
    """wedges(lid, seq, x, y, sectors, printed, runways, ...) with `fan`: the seq of the first wedge that they are drawn with.

    In drawing order a wedge joins the first fan of the same sectors and wording whose every wedge begins within reach of it, if all
    their runways still fit one label.  The wedges of one wording of an airport are folded in one row.
    """
    one = F.struct("seq", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "runways")
    alike = wedges.groupBy("lid", F.to_json("sectors").alias("_sectors"), "printed").agg(F.array_sort(F.collect_list(one)).alias("_w"))
    kind = wedges.select(one.alias("w")).schema["w"].dataType.simpleString()

    def step(fans: Column, w: Column) -> Column:
        def takes(fan: Column) -> Column:
            near = F.forall(fan, lambda o: F.sqrt(F.pow(o["x"] - w["x"], 2) + F.pow(o["y"] - w["y"], 2)) <= reach)
            held = F.flatten(F.transform(fan, lambda o: o["runways"]))
            names = F.array_distinct(F.concat(held, w["runways"]))
            # the label of a fan of several wedges fits already, and runways that it has do not change it
            same = (F.size(fan) > 1) & (F.size(F.array_except(w["runways"], held)) == 0)
            return near & (same | labels.runway_tag(names).isNotNull())

        at = F.array_position(F.transform(fans, takes), True)
        return F.when(at == 0, F.concat(fans, F.array(F.array(w)))).otherwise(F.transform(fans, lambda fan, i: F.when(i == at - 1, F.concat(fan, F.array(w))).otherwise(fan)))

    fans = F.aggregate("_w", F.expr(f"cast(array() as array<array<{kind}>>)"), step)
    named = alike.select("lid", F.explode(fans).alias("_fan")).select("lid", F.col("_fan")[0]["seq"].alias("fan"), F.explode(F.transform("_fan", lambda w: w["seq"])).alias("seq"))
    return wedges.join(named, ["lid", "seq"])


def permits(heading: Column, sectors: Column) -> Column:
    """Whether a heading lies in one of array<struct<start, sweep>>, limits included."""

    def within(s: Column) -> Column:
        turned = F.when(s["sweep"] > 0, geodesy.wrap360(heading - s["start"])).otherwise(geodesy.wrap360(s["start"] - heading))
        limit = lambda a: F.abs(geodesy.wrap180(heading - a)) < EPSILON
        return (turned <= F.abs(s["sweep"])) | limit(s["start"]) | limit(s["start"] + s["sweep"])

    return F.exists(sectors, within)


def turn_within(course: Column, heading: Column, sectors: Column) -> Column:
    """L or R if just one way onto the heading passes, checked by the degree, through headings of the sectors alone; else null."""

    def inside(side: str) -> Column:
        by = geodesy.signed_turn(course, heading, F.lit(side))
        n = F.greatest(F.ceil(F.abs(by)).cast("int"), F.lit(1))
        return F.forall(F.sequence(F.lit(0), n), lambda i: permits(course + by * i / n, sectors))

    left, right = inside("L"), inside("R")
    return F.when(left & ~right, "L").when(right & ~left, "R")


def fans(wedges: DataFrame, radius: float = REACH_NM, turn_radius: float = RADIUS) -> DataFrame:
    """One row for each fan of `shared_wedges`: lid, fan, x, y, course, side, sectors, runways, radius and edges.

    The apex is the centroid of the wedges' own, the course flown into it their circular mean.  edges: array<struct<heading, turn, x, y,
    tip_x, tip_y>> of the limiting headings, each once in the order printed: the turn onto it (the published way, else the only one inside
    the sectors, else the shorter), where that ends, and the tip where the edge meets the fan's radius, which grows where a turn needs it.
    """
    first = lambda c: F.min_by(c, "seq")
    runways = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("seq", "runways"))), lambda w: w["runways"])))
    one = wedges.groupBy("lid", "fan").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), mean_course(F.collect_list("course")).alias("course"), first("side").alias("side"), first("sectors").alias("sectors"), first("printed").alias("printed"), runways.alias("runways"))
    headings = F.array_distinct(F.flatten(F.transform("sectors", lambda s: F.array(F.round(geodesy.wrap360(s["start"]), 6), F.round(geodesy.wrap360(s["start"] + s["sweep"]), 6)))))
    r = F.lit(float(turn_radius))

    def turned(h: Column) -> Column:
        by = geodesy.signed_turn(F.col("course"), h, F.coalesce("side", turn_within(F.col("course"), h, F.col("sectors"))))
        return geodesy.let(ends, h=h, by=by, c=F.col("course"))

    def ends(v: Column) -> Column:
        hand = F.when(v["by"] < 0, -1.0).otherwise(1.0)
        dx = F.when(v["by"] == 0, 0.0).otherwise(r * F.sin(F.radians(v["c"] + 90 * hand)) + r * F.sin(F.radians(v["h"] - 90 * hand)))
        dy = F.when(v["by"] == 0, 0.0).otherwise(r * F.cos(F.radians(v["c"] + 90 * hand)) + r * F.cos(F.radians(v["h"] - 90 * hand)))
        return F.struct(v["h"].alias("heading"), v["by"].alias("turn"), dx.alias("dx"), dy.alias("dy"))

    rows = one.withColumn("_turned", F.transform(headings, turned))
    widest = F.array_max(F.transform("_turned", lambda t: F.sqrt(t["dx"] * t["dx"] + t["dy"] * t["dy"])))
    rows = rows.withColumn("radius", F.greatest(F.lit(float(radius)), widest + STRAIGHT_NM))

    def edge(t: Column) -> Column:
        along = geodesy.along(t["dx"], t["dy"], t["heading"])
        on = F.sqrt(F.greatest(F.lit(0.0), along * along - t["dx"] * t["dx"] - t["dy"] * t["dy"] + F.col("radius") * F.col("radius"))) - along
        x, y = F.col("x") + t["dx"], F.col("y") + t["dy"]
        return F.struct(t["heading"], t["turn"], x.alias("x"), y.alias("y"), (x + on * F.sin(F.radians(t["heading"]))).alias("tip_x"), (y + on * F.cos(F.radians(t["heading"]))).alias("tip_y"))

    return rows.withColumn("edges", F.transform("_turned", edge)).drop("_turned")


def dashed_arcs(fan: DataFrame) -> DataFrame:
    """(lid, fan, sector, dash, start, sweep, radius): the dashes of the arc between the tips of each sector, bearings from the apex.

    Dashes are about DASH_NM long and GAP_NM apart; the arc begins and ends with one.
    """
    tip = lambda h: F.filter("edges", lambda e: F.abs(geodesy.wrap180(e["heading"] - h)) < 1e-5)[0]
    bearing = lambda e: geodesy.course_of(e["tip_x"] - F.col("x"), e["tip_y"] - F.col("y"))
    rows = fan.select("lid", "fan", "x", "y", "radius", "edges", F.posexplode("sectors").alias("sector", "s"))
    rows = rows.withColumn("_first", bearing(tip(F.col("s.start")))).withColumn("_last", bearing(tip(F.col("s.start") + F.col("s.sweep"))))
    swept = F.col("s.sweep") + geodesy.wrap180(F.col("_last") - (F.col("s.start") + F.col("s.sweep"))) - geodesy.wrap180(F.col("_first") - F.col("s.start"))
    rows = rows.withColumn("_sweep", swept).withColumn("_n", F.greatest(F.lit(2), F.rint((F.col("radius") * F.radians(F.abs("_sweep")) + GAP_NM) / (DASH_NM + GAP_NM)).cast("int")))
    period = F.col("_sweep") / (F.col("_n") - GAP_NM / (DASH_NM + GAP_NM))
    rows = rows.withColumn("_period", period).withColumn("dash", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return rows.select("lid", "fan", "sector", "dash", (F.col("_first") + F.col("dash") * F.col("_period")).alias("start"), (F.col("_period") * DASH_NM / (DASH_NM + GAP_NM)).alias("sweep"), "radius")


def bearings(sectors: Column, step: float = 5.0) -> Column:
    """array<struct<bearing, off>> across each sector at most `step` apart, with the signed angle from its middle."""

    def across(s: Column) -> Column:
        n = F.greatest(F.ceil(F.abs(s["sweep"]) / step).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), n), lambda i: F.struct((s["start"] + s["sweep"] * i / n).alias("bearing"), (s["sweep"] * (i / n - 0.5)).alias("off")))

    return F.flatten(F.transform(sectors, across))
