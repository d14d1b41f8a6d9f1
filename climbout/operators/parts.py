"""Parts of a procedure, routes withheld for a speed limit, and what a procedure flies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels, runways

# Names of parts, the failure of a withheld route.
UNNAMED_PART, VISUAL_PART = "other runways", "VCOA"
# Legs that give no route.
NO_ROUTE = ("NotAvailable", "Unrouted")
UNREAD_SPEED = "unread speed limit in takeoff minimums"


def nodes(legs: Column) -> Column:
    """The node of each leg, of an array of legs as `procedures.parse` gives them; a bare turn has none."""
    return F.transform(legs, lambda x: x["leg"]["node"])


def flies(legs: Column) -> Column:
    """Whether a group flies a route: it has legs, is available, and does not send the pilot to a chart."""
    return F.exists(legs, lambda x: ~F.coalesce(x["leg"]["node"].isin(*NO_ROUTE), F.lit(False))) & ~F.array_contains(F.array_compact(nodes(legs)), "GraphicDeparture")


def no_route(legs: Column) -> Column:
    """Whether a group gives its runways no route: not available, or a restriction alone."""
    return F.forall(nodes(legs), lambda n: F.coalesce(n.isin(*NO_ROUTE), F.lit(False)))


def climbs_only(legs: Column) -> Column:
    """Whether a group is nothing but a climb gradient."""
    return (F.size(legs) > 0) & F.forall(nodes(legs), lambda n: n.eqNullSafe("MinimumClimb"))


def ends_in_tail(legs: Column) -> Column:
    return F.coalesce(F.try_element_at(nodes(legs), F.lit(-1)) == "Thence", F.lit(False))


def has_range(legs: Column) -> Column:
    """Whether a group may leave on any heading of a range."""
    return F.array_contains(F.array_compact(nodes(legs)), "HeadingRange")


def with_text(sections: DataFrame) -> DataFrame:
    """Blocks that publish a departure procedure or a visual climb; the others are not counted at all."""
    return sections.where("departure_procedure is not null or vcoa is not null")


def parts(groups: DataFrame) -> DataFrame:
    """(block, line, part, runways, legs, tail_legs): each group that flies a route as a procedure of its own.

    groups(block, line, runways, tail, legs) as `procedures.parse` reads them; tail_legs are those of the block's shared
    tail if the group goes on into it, else null.
    """
    tails = groups.where("tail").groupBy("block").agg(F.min_by("legs", "line").alias("tail_legs"))
    own = groups.where(~F.col("tail") & flies(F.col("legs")) & ~climbs_only(F.col("legs")))
    name = labels.part_name(F.col("runways"), UNNAMED_PART)
    return own.join(tails, "block", "left").select("block", "line", name.alias("part"), "runways", "legs", F.when(ends_in_tail(F.col("legs")), F.col("tail_legs")).alias("tail_legs"))


def without_speed_limited(groups: DataFrame, minimums: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups that stay, (block, line, part, signature, detail) of those withheld) under minimums(block, text), one row a block.

    A route that a speed limit of the takeoff minimums may bind is withheld, since those limits are not flown.
    """
    bound = groups.join(minimums.select("block", F.col("text").alias("_minimums")), "block", "left")
    bound = bound.withColumn("_limit", F.when(~F.col("tail") & flies(F.col("legs")), runways.speed_limit(F.coalesce("_minimums", F.lit("")), F.col("runways"))))
    kept = bound.where("_limit is null").drop("_minimums", "_limit")
    return kept, bound.where("_limit is not null").select("block", "line", labels.part_name(F.col("runways"), UNNAMED_PART).alias("part"), F.lit(UNREAD_SPEED).alias("signature"), F.col("_limit").alias("detail"))


def common_end(groups: DataFrame) -> DataFrame:
    """(block, target): the fix at which every group of groups(block, runways, tail, legs) ends, for blocks that have one."""
    last = F.try_element_at(F.col("legs"), F.lit(-1))["leg"]["target"]
    ends = groups.where("not tail").groupBy("block").agg(F.count_distinct(last).alias("n"), F.bool_and(last.isNotNull()).alias("all"), F.min(last).alias("target"))
    return ends.where(F.col("all") & (F.col("n") == 1)).select("block", "target")


def with_hold_fix(leg_rows: DataFrame) -> DataFrame:
    """`held`: the fix of a climb in a hold, its own or, where it names none, that at which the leg before it ends."""
    before = F.lag("leg.target").over(Window.partitionBy("block", "line").orderBy("seq"))
    return leg_rows.withColumn("held", F.when(F.col("leg.node") == "ClimbInHold", F.coalesce("leg.target", before)))
