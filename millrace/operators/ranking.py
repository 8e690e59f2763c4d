"""Ranks that no single task has to hold: a range sort, then counts of what lies before each partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from .components import cut

# Categories in order, and bands of relative value with the share at which each ends.
CATEGORIES = ("PRIMARY", "STRETCH", "NEAR_MISS", "EXCLUDED")
BANDS = ((0.25, "EXCELLENT_VALUE"), (0.5, "GOOD_VALUE"), (0.75, "FAIR_VALUE"), (2.0, "EXPENSIVE_RELATIVE_TO_SAMPLE"))
# Columns that ``rank_order`` reads.
ORDERED_BY = ("row_id", "category", "noise_risk", "noise_confidence", "fit_score", "budget_class", "estimated_total_monthly_usd", "rent_usd")


def numbered(df: DataFrame, group: list[Column], order: list[Column], name: str) -> DataFrame:
    """``df`` with the 1-based place of each row in its group. ``order`` must have no ties.

    The rows are sorted by range once and kept; the driver sees one number for each partition and group in it.
    """
    keys = {f"__g{k}": g for k, g in enumerate(group)}
    ready = df.withColumns(keys) if keys else df
    ordered = cut(ready.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], *order).sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys], *order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("__at", 33)
    counts = ordered.groupBy(part.alias("__part"), *keys).agg(F.count("*").alias("n"), F.min("__at").alias("__first"))
    # A partition holds few groups or a group few partitions, so this table is about as long as both together.
    before = counts.withColumn("__before", F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) if keys else counts.withColumn("__before", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    same = [ordered[k].eqNullSafe(before[k]) for k in keys]
    joined = ordered.join(before, [F.shiftrightunsigned(ordered["__at"], 33) == before["__part"], *same])
    return joined.select(*[ordered[c] for c in df.columns], (ordered["__at"] - before["__first"] + before["__before"] + 1).cast("long").alias(name))


def rank_order(cfg: Config) -> list[Column]:
    """Loud places last, then fit with a margin for all-in prices, all-in first, the lower cost, the earlier row."""
    c = F.col
    loud = F.coalesce((c("noise_risk") == "HIGH") & c("noise_confidence").isin("HIGH", "MEDIUM"), F.lit(False)).cast("int")
    strict = F.coalesce(c("budget_class") == "STRICT_ALL_IN", F.lit(False)).cast("int")
    cost = F.coalesce("estimated_total_monthly_usd", "rent_usd")
    return [loud.asc(), (c("fit_score") + strict * cfg.strict_margin).desc(), strict.desc(), cost.asc_nulls_last(), c("row_id").asc()]


def rank(scored: DataFrame, cfg: Config, kept: list[str] | None = None) -> DataFrame:
    """Canonical records with rank_in_category; with what the order reads and the columns ``kept``, if given, else with all."""
    # Scoring is dear and the range sort reads its input twice, so the scores are written once. Columns that nobody reads aren't made.
    rows = scored.where("is_canonical")
    narrow = rows if kept is None else rows.select(*dict.fromkeys([*ORDERED_BY, *kept]))
    return numbered(cut(narrow), [F.col("category")], rank_order(cfg), "rank_in_category")


def value_bands(df: DataFrame, group: str, value: str, in_scope: Column, min_group: int) -> DataFrame:
    """value_percentile and value_band of each row: its average rank among the in-scope rows of its group.

    Equal values are counted first, so the window runs over distinct values and never over rows.
    """
    scope = in_scope & F.col(value).isNotNull() & F.col(group).isNotNull()
    counts = df.where(scope).groupBy(group, value).agg(F.count("*").alias("__n"))
    up = Window.partitionBy(group).orderBy(value)
    share = (F.sum("__n").over(up) - F.col("__n") + (F.col("__n") + 1) / 2) / F.sum("__n").over(Window.partitionBy(group))
    bands = counts.select(F.col(group).alias("__g"), F.col(value).alias("__v"), share.alias("__share"), F.sum("__n").over(Window.partitionBy(group)).alias("__all"))
    joined = df.join(bands, scope & (F.col(group) == F.col("__g")) & (F.col(value) == F.col("__v")), "left")
    enough = F.col("__all") >= min_group
    band = F.coalesce(*[F.when(F.col("__share") <= top, name) for top, name in BANDS])
    return joined.withColumns({
        "value_percentile": F.when(enough, F.bround(F.col("__share") * 100, 0)),
        "value_band": F.when(F.col("__all").isNull(), "INSUFFICIENT_DATA").when(~enough, "INSUFFICIENT_SAMPLE").otherwise(band),
    }).drop("__g", "__v", "__share", "__all")


def display_tier(place: str, top: int) -> Column:
    return F.when(F.col(place) <= top, f"TOP {top}").otherwise("ALTERNATIVE")
