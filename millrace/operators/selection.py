"""Exact medians and modes of groups of any size: no task holds a group's values.

Equal values are counted first. Then the different values of each group that may hold a middle rank are narrowed round by
round: pivots from a mergeable sketch cut them in ranges, ranges are counted exactly, and only the ranges with the middle
ranks go on. A round leaves about one part in PIVOTS of a group's different values, so a hundred billion take six. Groups of
FEW different values end at once, by a window over those.

Nulls take no part; a group of nulls only has a null median. NaN is the greatest number. Groups may be null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import cut
from .spread import spread

PIVOTS, FEW = 64, 1000


def counted(df: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """(key, value, w): how often each value stands in each group; ``key`` is a struct of the groups and the value's column name."""
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("value")) for v in values]))
    rows = df.select(*[F.col(b).alias(f"g{k}") for k, b in enumerate(by)], pairs.alias("p")).where(F.col("p.value").isNotNull())
    key = F.struct(*[F.col(f"g{k}") for k in range(len(by))], F.col("p.name").alias("name"))
    return rows.select(key.alias("key"), F.col("p.value").alias("value")).groupBy("key", "value").agg(F.count("*").alias("w"))


def _end(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """(key, median) of groups of few different values."""
    upto = F.sum("w").over(Window.partitionBy("key").orderBy("value"))
    placed = rows.join(ranks, "key").withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("w"))
    at = lambda k: F.max(F.when((F.col(k) >= F.col("from")) & (F.col(k) < F.col("upto")), F.col("value")))
    return placed.groupBy("key").agg(((at("low") + at("high")) / 2).alias("median"))


def _keyed_medians(rows: DataFrame, pivots: int, few: int) -> DataFrame:
    rows = cut(rows)
    # The middle ranks from 0; both are the same where a group has an odd number of values.
    ranks = rows.groupBy("key").agg(F.sum("w").alias("n"), F.count("*").alias("different"))
    ranks = cut(ranks.select("key", "different", F.floor((F.col("n") - 1) / 2).alias("low"), F.floor(F.col("n") / 2).alias("high")))
    done = None
    while True:
        ready = ranks.where(F.col("different") <= few)
        ended = _end(rows.join(ready.select("key"), "key", "left_semi"), ready.select("key", "low", "high"))
        done = ended if done is None else done.union(ended)
        ranks = cut(ranks.where(F.col("different") > few))
        if not ranks.limit(1).count():
            return done
        shares = F.array(*[F.lit(k / pivots) for k in range(1, pivots)])
        cuts = rows.groupBy("key").agg(F.percentile_approx("value", shares, F.lit(pivots * 20)).alias("cuts"))
        classes = cut(ranks.join(cuts, "key").withColumnRenamed("different", "n"))
        split = spread(rows, classes, ["key"], ["value"]).withColumn("part", F.size(F.filter("cuts", lambda p: p <= F.col("value"))))
        split = cut(split.select("key", "value", "w", "part"))
        parts = split.groupBy("key", "part").agg(F.sum("w").alias("w"), F.count("*").alias("n"))
        upto = parts.withColumn("upto", F.sum("w").over(Window.partitionBy("key").orderBy("part"))).withColumn("from", F.col("upto") - F.col("w"))
        # Each group has at most ``pivots`` parts, whatever its size. The part of the lower middle and that of the upper stay.
        meets = ((F.col("low") >= F.col("from")) & (F.col("low") < F.col("upto"))) | ((F.col("high") >= F.col("from")) & (F.col("high") < F.col("upto")))
        kept = cut(upto.join(ranks.drop("different"), "key").where(meets))
        rows = cut(spread(split, kept.select("key", "part", "n"), ["key", "part"], ["value"]).select("key", "value", "w"))
        left = kept.groupBy("key").agg(F.min("from").alias("from"), F.sum("n").alias("different"), F.first("low").alias("low"), F.first("high").alias("high"))
        ranks = cut(left.select("key", "different", (F.col("low") - F.col("from")).alias("low"), (F.col("high") - F.col("from")).alias("high")))


def _wide(found: DataFrame, by: list[str], values: list[str], column: str) -> DataFrame:
    flat = found.select(*[F.col(f"key.g{k}").alias(b) for k, b in enumerate(by)], F.col("key.name").alias("name"), column)
    return flat.groupBy(*by).agg(*[F.max(F.when(F.col("name") == v, F.col(column))).alias(v) for v in values])


def medians(df: DataFrame, by: list[str], values: list[str], pivots: int = PIVOTS, few: int = FEW) -> DataFrame:
    """(by, values): the median of each column in each group that has any value."""
    return _wide(_keyed_medians(counted(df, by, values), pivots, few), by, values, "median")


def modes(df: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """(by, values): the most frequent value of each column, of equals the smallest."""
    top = counted(df, by, values).groupBy("key").agg(F.max(F.struct("w", (-F.col("value")).alias("value"))).alias("top"))
    return _wide(top.select("key", (-F.col("top.value")).alias("mode")), by, values, "mode")


def beside(df: DataFrame, other: DataFrame, by: list[str]) -> DataFrame:
    """Two tables of groups side by side; null is a group like any other."""
    if not by:
        return df.join(other, F.lit(True), "left")
    named = other.select(*[F.col(b).alias(f"__{b}") for b in by], *[c for c in other.columns if c not in by])
    same = [df[b].eqNullSafe(named[f"__{b}"]) for b in by]
    return df.join(named, same, "left").drop(*[f"__{b}" for b in by])
