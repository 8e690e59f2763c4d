"""Summaries of listing tables: coverage, validation, reasons, market snapshot, lease observations, run sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import selection

c = F.col

# Metrics of coverage and the fields that count for each.
COVERAGE = {
    "url": ("source_url",), "rent": ("rent_original",), "currency": ("rent_currency",), "bedrooms": ("bedrooms",), "area": ("total_area_m2", "built_area_m2"), "maintenance": ("maintenance_fee", "maintenance_included_in_rent"),
    "coordinates": ("latitude",), "address": ("address",), "publication_date": ("publication_date",), "contact": ("phone", "whatsapp"), "description": ("description",), "images": ("image_count",),
}


def share(condition: Column) -> Column:
    """Share of rows that meet the condition; 0 for no rows."""
    return F.coalesce(F.avg(F.when(condition, 1.0).otherwise(0.0)), F.lit(0.0))


def filled(field: str) -> Column:
    value = c(field)
    return F.coalesce(value.isNotNull() & ~value.cast("string").isin("", "NaN", "false"), F.lit(False))


def coverage(df: DataFrame, by: str | None = None, metrics: dict[str, tuple[str, ...]] = COVERAGE) -> DataFrame:
    aggs = [share(reduce(lambda x, y: x | y, map(filled, fields))).alias(name) for name, fields in metrics.items()]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def validation(df: DataFrame, by: str = "source") -> DataFrame:
    area = lambda k: F.coalesce(c(k).between(12, 400), F.lit(False))
    some = lambda x: F.coalesce(x, F.lit(False))
    return df.groupBy(by).agg(
        F.count("*").alias("records"), share(some(c("rent_original").between(150, 60000) & c("rent_currency").isin("USD", "PEN"))).alias("valid_rent"), share(some(c("bedrooms").between(0, 10))).alias("valid_bedrooms"),
        share(area("built_area_m2") | area("total_area_m2")).alias("valid_area"), share(c("maintenance_fee").isNotNull() | T.true(c("maintenance_included_in_rent"))).alias("maintenance"),
        share(c("latitude").isNotNull()).alias("coordinates"), share(some(T.known(c("phone"))) | some(T.known(c("whatsapp")))).alias("contact"), share(some(T.known(c("publication_date")))).alias("dated"),
    )


def source_status(n: Column, errors: Column, status: Column, core: Column, area: Column) -> Column:
    blocked = errors.contains("unreachable") | errors.contains("NetworkBlocked")
    empty = F.when(F.coalesce(blocked, F.lit(False)), "PENDING (environment egress blocked)").when(status == "SKIPPED", "SKIPPED").otherwise("REJECTED")
    return F.when(n == 0, empty).when((n >= 5) & (core >= 0.9) & (area >= 0.6), "APPROVED").otherwise("PARTIAL")


def usable_sample(df: DataFrame, by: str = "source") -> DataFrame:
    """Is each source's sample good enough for a full run?"""
    rent = F.coalesce((c("rent_original") != 0) & T.known(c("rent_currency")), F.lit(False))
    checks = (share(F.coalesce(T.known(c("source_url")), F.lit(False))) >= 0.9) & (share(rent) >= 0.8) & (share(c("bedrooms").isNotNull()) >= 0.7)
    return df.groupBy(by).agg(((F.count("*") >= 5) & checks).alias("usable"))


def group_counts(df: DataFrame, group: str = "duplicate_group_id") -> DataFrame:
    """Groups, groups of several records, records folded away, groups with conflicts."""
    sizes = df.groupBy(group).agg(F.count("*").alias("n"), F.max(F.coalesce(c("dup_inconsistencies") != "", F.lit(False))).alias("clash"))
    return sizes.agg(F.count("*").alias("groups"), F.count_if(c("n") > 1).alias("merged_groups"), F.coalesce(F.sum(c("n") - 1), F.lit(0)).alias("folded"), F.count_if("clash").alias("conflicting"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.where(c(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def top_reasons(df: DataFrame, column: str = "exclusion_reason", separator: str = "; ", k: int = 6) -> DataFrame:
    parts = df.select(F.explode(F.split(column, separator)).alias("reason")).where(c("reason") != "")
    return parts.groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(k)


def market_snapshot(df: DataFrame, by: str = "bedrooms", rent: str = "rent_usd", area: str = "area_m2", per_area: str = "rent_usd_per_m2") -> DataFrame:
    shares = df.groupBy(by).agg(F.count("*").alias("n"), share(T.true(c("furnished"))).alias("furnished_share"), share(c("maintenance_usd").isNotNull()).alias("maintenance_share"))
    middles = selection.medians(df, [by], [rent, area, per_area]).select(by, c(rent).alias("median_rent"), c(area).alias("median_area"), c(per_area).alias("median_per_m2"))
    return selection.beside(shares, middles, [by]).select(by, "n", "median_rent", "median_area", "median_per_m2", "furnished_share", "maintenance_share")


def usual_and_middle(df: DataFrame, by: str, value: str) -> DataFrame:
    """(by, usual, middle): the most frequent value of each group and the median."""
    usual = selection.modes(df, [by], [value]).select(by, c(value).alias("usual"))
    return selection.beside(usual, selection.medians(df, [by], [value]).select(by, c(value).alias("middle")), [by])


def lease_observations(df: DataFrame) -> DataFrame:
    term, deposit = c("minimum_contract_months"), c("deposit_months")
    counts = df.agg(
        F.count("*").alias("n"), F.count(term).alias("terms_stated"), F.count(deposit).alias("deposits_stated"), F.count_if(deposit >= 3).alias("high_deposits"),
        (F.count("maintenance_usd") + F.count_if(T.true(c("maintenance_included_in_rent")))).alias("maintenance_known"), F.count_if(c("rent_usd_basis") == "CALCULATED").alias("converted"),
    )
    usual = selection.modes(df, [], ["minimum_contract_months"]).select(c("minimum_contract_months").cast(df.schema["minimum_contract_months"].dataType).alias("usual_term"))
    middle = selection.medians(df, [], ["deposit_months"]).select(c("deposit_months").alias("median_deposit"))
    out = selection.beside(selection.beside(counts, usual, []), middle, [])
    return out.select("n", "terms_stated", "usual_term", "deposits_stated", "median_deposit", "high_deposits", "maintenance_known", "converted")


def budget_counts(df: DataFrame) -> DataFrame:
    kinds = ("STRICT_ALL_IN", "BASE_RENT_COMPLIANT", "STRETCH", "OVER_BUDGET", "UNKNOWN")
    return df.groupBy("category").agg(*[F.count_if(c("budget_class") == k).alias(k.lower()) for k in kinds])


def extents(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[f(k).alias(f"{n}_{k}") for k in columns for f, n in ((F.min, "min"), (F.max, "max"))])


def run_sizes(samples: DataFrame, remaining: float, share_of_budget: float, validation_items: int) -> DataFrame:
    """samples (source, cap, records, cost, estimate) -> items of a full run: each source's part of the pool over its cost per item."""
    per_item = F.coalesce(F.when((c("records") > 0) & (c("cost") > 0), c("cost") / c("records")), F.when(c("estimate") > 0, c("estimate") / max(1, validation_items)))
    total = samples.agg(F.sum("cap").alias("__total"))
    pool = F.lit(remaining * share_of_budget) * c("cap") / F.coalesce(F.nullif(c("__total"), F.lit(0)), F.lit(1))
    paid = F.greatest(F.lit(0), F.least(c("cap"), (pool / per_item).cast("int")))
    return samples.crossJoin(F.broadcast(total)).select("source", F.when(per_item > 0, paid).otherwise(c("cap")).cast("int").alias("items"), per_item.alias("cost_per_item"))


def field_counts(records: DataFrame, json: str, k: int = 60) -> DataFrame:
    """How many JSON objects have each key with something in it; the ``k`` most frequent."""
    entries = records.select(F.explode(F.from_json(json, "map<string,string>")).alias("key", "value"))
    return entries.where(c("value").isNotNull() & ~c("value").isin("", "[]", "{}")).groupBy("key").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "key").limit(k)
