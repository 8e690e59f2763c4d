"""Outlines from their member ways: closed rings of many boundaries at once, put together by joins.

A way is two arcs, one for each direction. An arc's successor is the arc that leaves its end by another way; where just two
ways meet at each end, arcs form cycles, each ring once in either direction. Successors are doubled: after k rounds each arc
knows the 2**k arcs ahead of it, so the least of a cycle and the steps to it take rounds by the logarithm of the ring's
ways. The area is an aggregate over the ring's ways; no walk, and no more than one ring's points in a row.

Ways without two points, ways that end in the open and ends where more than two ways meet belong to no ring. A way that
closes on itself is a ring. Of rings equal in area the one with the least way counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import cut

c = F.col


def _cross(points: Column) -> Column:
    """Twice the signed area between a line and the origin."""
    n = F.size(points)
    nexts = F.arrays_zip(F.slice(points, F.lit(1), n - 1).alias("a"), F.slice(points, F.lit(2), n - 1).alias("b"))
    return F.aggregate(nexts, F.lit(0.0), lambda sum_, s: sum_ + s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"])


def rings(ways: DataFrame) -> DataFrame:
    """ways (boundary, way, points array<struct<x, y>>) -> (boundary, ring, n_ways, area, points): every closed ring, run through
    in the direction of positive area; ``ring`` is its least way."""
    shaped = ways.where(F.size("points") >= 2).withColumns({"first": c("points")[0], "last": F.element_at("points", -1)})
    forward = shaped.select("boundary", "way", F.lit(True).alias("ahead"), c("first").alias("from"), c("last").alias("to"), "points")
    back = shaped.select("boundary", "way", F.lit(False).alias("ahead"), c("last").alias("from"), c("first").alias("to"), F.reverse("points").alias("points"))
    all_arcs = forward.union(back).withColumn("cross", _cross(c("points")))
    degree = all_arcs.groupBy("boundary", "from").agg(F.count("*").alias("degree")).where(c("degree") == 2).select("boundary", c("from").alias("node"))
    arcs = cut(all_arcs.join(degree.withColumnRenamed("node", "from"), ["boundary", "from"]).join(degree.withColumnRenamed("node", "to"), ["boundary", "to"]))
    arc = F.struct("way", "ahead")
    leaving = arcs.select("boundary", c("from").alias("node"), arc.alias("next"), c("way").alias("other"))
    own = arcs.select("boundary", c("to").alias("node"), arc.alias("arc"), "way", (c("from") == c("to")).alias("loop"))
    # Of the two arcs that leave an end, the other way's; a way that closes on itself follows itself.
    steps = own.join(leaving, ["boundary", "node"]).where((~c("loop") & (c("way") != c("other"))) | (c("loop") & (c("next") == c("arc"))))
    state = cut(steps.select("boundary", "arc", "next", c("arc").alias("least"), F.lit(0).cast("long").alias("steps"), F.lit(1).cast("long").alias("span")))
    # Chains that end in the open lose their last arcs round by round. As long as spans are shorter than a cycle, some arc of
    # it sees a lesser one in each round.
    while state.limit(1).count():
        ahead = state.select("boundary", c("arc").alias("next"), c("next").alias("after"), c("least").alias("least2"), c("steps").alias("steps2"), c("span").alias("span2"))
        lower = c("least2") < c("least")
        doubled = state.join(ahead, ["boundary", "next"]).select("boundary", "arc", c("after").alias("next"), F.when(lower, c("least2")).otherwise(c("least")).alias("least"), F.when(lower, c("span") + c("steps2")).otherwise(c("steps")).alias("steps"), (c("span") + c("span2")).alias("span"))
        doubled = cut(doubled)
        moved = doubled.join(state.select("boundary", "arc", c("least").alias("was")), ["boundary", "arc"]).where(c("was") != c("least")).limit(1).count()
        state, done = doubled, not moved
        if done:
            break
    # ``steps`` leads from an arc to the least arc of its cycle: the greatest comes first behind it.
    sizes = state.groupBy("boundary", "least").agg(F.count("*").alias("n_ways"))
    placed = state.join(sizes, ["boundary", "least"]).withColumn("place", F.pmod(c("n_ways") - c("steps"), c("n_ways")))
    parts = placed.select("boundary", "least", "n_ways", "place", c("arc.way").alias("way"), c("arc.ahead").alias("ahead")).join(arcs.select("boundary", "way", "ahead", "points", "cross"), ["boundary", "way", "ahead"])
    in_turn = F.array_sort(F.collect_list(F.struct("place", "points")))
    found = parts.groupBy("boundary", "least").agg(F.count("*").alias("n_ways"), F.min("way").alias("ring"), (F.sum("cross") / 2).alias("area"), in_turn.alias("parts"))
    # What is left of a chain that ends in the open doesn't come back to where it began.
    closed = c("parts")[0]["points"][0] == F.element_at(F.element_at("parts", -1)["points"], -1)
    line = F.flatten(F.transform("parts", lambda p: F.slice(p["points"], F.lit(1), F.size(p["points"]) - 1)))
    found = found.where((c("area") > 0) & closed).withColumn("points", line).where(F.size("points") >= 3)
    return found.select("boundary", "ring", "n_ways", "area", F.concat("points", F.slice("points", 1, 1)).alias("points"))


def outlines(ways: DataFrame) -> DataFrame:
    """(boundary, area, points): the largest ring of each boundary that has one."""
    best = rings(ways).groupBy("boundary").agg(F.min(F.struct((-c("area")).alias("less"), "ring", "points")).alias("b"))
    return best.select("boundary", (-c("b.less")).alias("area"), c("b.points").alias("points"))
