"""Checks after ranking: plausibility, page re-checks, manual verdicts, fresh copies, and the fix-point loop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import text as T
from .components import cut
from .ranking import rank

c = F.col

# Fields that a fresh copy updates, what is compared under which name, and wordings of closed pages.
REFRESHED = (
    "rent_original rent_currency rent_usd rent_pen rent_usd_basis rent_pen_basis maintenance_fee maintenance_currency maintenance_usd maintenance_pen maintenance_usd_basis maintenance_pen_basis maintenance_included_in_rent"
    " estimated_total_monthly_usd estimated_total_monthly_pen bedrooms built_area_m2 total_area_m2 furnished semi_furnished minimum_contract_months deposit_months phone whatsapp"
).split()
COMPARED = {
    "rent": ("rent_original", "rent_currency"), "bedrooms": ("bedrooms",), "area": ("built_area_m2", "total_area_m2"), "maintenance": ("maintenance_fee", "maintenance_currency"), "furnished": ("furnished",),
    "contract": ("minimum_contract_months",), "deposit": ("deposit_months",), "contact": ("phone", "whatsapp"),
}
CLOSED = ("aviso finalizado", "publicacion finalizada", "publicacion pausada", "ya no esta disponible", "este aviso ya no", "el inmueble ya fue alquilado", "aviso no disponible", "no longer available")
CHALLENGES = ("cf-chl", "challenge-platform", "just a moment...", "attention required", "captcha", "are you a robot", "px-captcha", "datadome", "access denied", "verifica que eres humano", "account-verification")


def plausibility(cfg: Config) -> Column:
    """What doesn't look right about a listing, as an array."""
    south, west, north, east = cfg.bbox
    per_m2, paid = c("rent_usd_per_m2"), c("maintenance_usd")
    known = lambda k: F.coalesce(T.known(c(k)), F.lit(False))
    return T.listed(
        F.when(~known("source_url"), F.lit("no listing URL")), F.when(c("rent_usd").isNull() | ~c("rent_usd").between(150, 5000), F.lit("implausible rent")),
        F.when(c("rent_currency").isNull() | ~c("rent_currency").isin("USD", "PEN"), F.lit("rent currency unknown")), F.when(c("bedrooms").isNull() | ~c("bedrooms").isin(1, 2), F.lit("bedrooms not 1–2")),
        F.when(~per_m2.between(4, 45), F.lit("USD/m² outside plausible 4–45 range — check area/price")), F.when(paid > 0.6 * c("rent_usd"), F.lit("maintenance > 60% of rent — possible rent/maintenance mix-up")),
        F.when(~(c("latitude").between(south, north) & c("longitude").between(west, east)), F.lit("coordinates outside the district's box")), F.when(~known("phone") & ~known("whatsapp") & ~known("agency_name"), F.lit("no contact channel")),
    )


def worklist(ranked: DataFrame, cfg: Config) -> DataFrame:
    """The first PRIMARY rows, then all of the other in-scope categories; ``deep`` marks the first few."""
    rows = ranked.where((c("category") == "PRIMARY") & (c("rank_in_category") <= cfg.qa_programmatic) | c("category").isin("STRETCH", "NEAR_MISS"))
    first = rows.where("category = 'PRIMARY'").count()
    offset = rows.where("category = 'NEAR_MISS'").count()
    place = F.when(c("category") == "PRIMARY", c("rank_in_category")).when(c("category") == "NEAR_MISS", c("rank_in_category") + first).otherwise(c("rank_in_category") + first + offset)
    return rows.withColumn("qa_place", place).withColumn("deep", c("qa_place") <= cfg.qa_deep)


def page_verdict(status: Column, body: Column, rent: Column, area: Column) -> tuple[Column, Column]:
    """(status, note) of a listing page fetched again."""
    page = T.fold(F.left(body, F.lit(400000)))
    closed = F.exists(F.array(*map(F.lit, CLOSED)), lambda m: page.contains(m))
    grouped = F.format_number(F.rint(rent), 0)
    seen = body.contains(grouped) | body.contains(F.replace(grouped, F.lit(","), F.lit("."))) | body.contains(T.plain(rent))
    stated = F.regexp_like(page, F.concat(F.lit("\\b"), area.cast("int").cast("string"), F.lit("\\s*m")))
    notes = T.listed(F.when((rent != 0) & ~seen, F.concat(F.lit("published rent "), grouped, F.lit(" not found on page — price may have changed"))), F.when((area != 0) & ~stated, F.concat(F.lit("area "), T.plain(area), F.lit(" m² not found verbatim"))))
    kind = F.when(status.isin(404, 410), "INACTIVE").when(status != 200, "UNVERIFIED_ERROR").when(closed, "INACTIVE").when(F.size(notes) > 0, "ACTIVE_WITH_DIFFERENCES").otherwise("VERIFIED_ACTIVE")
    note = F.when(status != 200, F.concat(F.lit("HTTP "), status.cast("string"))).when(closed, "page marks the listing as finished / rented").otherwise(F.array_join(notes, "; "))
    return kind, note


def is_challenge(status: Column, content_type: Column, body: Column) -> Column:
    """Does a response look like a bot challenge rather than a page?"""
    head = F.lower(F.left(body, F.lit(6000)))
    marked = F.exists(F.array(*map(F.lit, CHALLENGES)), lambda m: head.contains(m))
    return status.isin(403, 429, 503) | (content_type.contains("html") & marked & (F.length(body) < 60000))


def same_value(a: Column, b: Column, tolerance: float = 0.01) -> Column:
    """Numbers within a share of the larger, else equal text without case and outer blanks."""
    x, y = T.number(a), T.number(b)
    near = F.abs(x - y) <= tolerance * F.greatest(F.abs(x), F.abs(y), F.lit(1.0))
    word = lambda v: F.lower(F.trim(F.coalesce(v.cast("string"), F.lit("None"))))
    return F.when(x.isNotNull() & y.isNotNull(), near).otherwise(word(a) == word(b))


def compare(old: str, new: str) -> tuple[Column, Column]:
    """(confirmed, differences), arrays, between two structs of listing fields; what isn't published again says nothing."""
    def state(fields: tuple[str, ...]) -> tuple[Column, Column]:
        told = [c(f"{new}.{f}").isNotNull() for f in fields]
        agree = [~t | same_value(c(f"{old}.{f}"), c(f"{new}.{f}")) for t, f in zip(told, fields, strict=True)]
        return F.greatest(*told) if len(told) > 1 else told[0], F.least(*agree) if len(agree) > 1 else agree[0]

    yes, no = [], []
    for label, fields in COMPARED.items():
        told, agree = state(fields)
        show = lambda side, fields=fields: F.nullif(F.concat_ws(" ", *[c(f"{side}.{f}").cast("string") for f in fields]), F.lit(""))
        yes.append(F.when(told & agree, F.lit(label)))
        no.append(F.when(told & ~agree, F.concat(F.lit(f"{label} changed: "), F.coalesce(show(old), F.lit("UNKNOWN")), F.lit(" → "), show(new))))
    return T.listed(*yes), T.listed(*no)


def recheck(ranked: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows with their fresh copy's verdict: found by source id, else by URL."""
    key = T.norm_url(c("source_url"))
    pick = [k for k in REFRESHED if k in fresh.columns]
    copy = fresh.select("source_listing_id", key.alias("url"), F.struct("active_status", *pick).alias("f"))
    one = lambda k, name: copy.where(c(k).isNotNull()).groupBy(k).agg(F.max("f").alias(name)).withColumnRenamed(k, f"__{k}")
    both = ranked.withColumn("__k", key).join(one("source_listing_id", "by_id"), c("source_listing_id") == c("__source_listing_id"), "left").join(one("url", "by_url"), c("__k") == c("__url"), "left")
    both = both.withColumns({"new": F.coalesce("by_id", "by_url"), "old": F.struct(*[c(k) for k in pick])})
    confirmed, differences = compare("old", "new")
    gone = c("new.active_status") == "INACTIVE"
    status = F.when(c("new").isNull(), "UNVERIFIED_NOT_RETURNED").when(gone, "INACTIVE").when(F.size(differences) > 0, "ACTIVE_WITH_DIFFERENCES").otherwise("VERIFIED_ACTIVE")
    told = both.withColumns({"qa_status": status, "qa_confirmed": F.array_join(confirmed, ", "), "qa_differences": F.array_join(differences, "; ")})
    alive = ~gone & c("new").isNotNull()
    updates = {k: F.when(alive, F.coalesce(c(f"new.{k}"), c(k))).otherwise(c(k)) for k in pick}
    updates["active_status"] = F.when(alive, F.lit("ACTIVE_CONFIRMED")).when(gone, F.lit("INACTIVE")).otherwise(c("active_status"))
    return told.withColumns(updates).drop("__k", "__source_listing_id", "__url", "by_id", "by_url", "new", "old")


def apply_overrides(ranked: DataFrame, overrides: DataFrame) -> DataFrame:
    """Manual verdicts by URL; of several the last (by ``seq``) holds, and an empty status keeps the old one."""
    last = Window.partitionBy("source_url").orderBy(F.desc("seq"))
    verdict = c("qa_status").isin("VERIFIED_ACTIVE", "INACTIVE")
    ranks = overrides.withColumn("__n", F.row_number().over(last))
    decided = F.max_by(F.when(verdict, c("qa_status")), F.when(verdict, c("seq")))
    stated = F.max_by("qa_status", F.when(F.coalesce(T.known(c("qa_status")), F.lit(False)), c("seq")))
    folded = ranks.groupBy(c("source_url").alias("__url")).agg(stated.alias("__status"), F.max(F.when(c("__n") == 1, F.coalesce("qa_notes", F.lit("")))).alias("__notes"), F.max(F.when(c("__n") == 1, c("checked_at"))).alias("__at"), decided.alias("__verdict"))
    hit = c("__url").isNotNull()
    new = {
        "qa_status": F.coalesce("__status", "qa_status"), "qa_notes": F.when(hit, F.concat(F.lit("MANUAL: "), c("__notes"))).otherwise(c("qa_notes")), "qa_checked_at": F.coalesce("__at", "qa_checked_at"),
        "active_status": F.when(c("__verdict") == "VERIFIED_ACTIVE", "ACTIVE_CONFIRMED").when(c("__verdict") == "INACTIVE", "INACTIVE").otherwise(c("active_status")),
    }
    return ranked.join(folded, c("source_url") == c("__url"), "left").withColumns(new).drop("__url", "__status", "__notes", "__at", "__verdict")


def write_back(df: DataFrame, changed: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` taken from the rows of ``changed`` that have the same row_id."""
    new = changed.select(c("row_id").alias("__id"), *[c(k).alias(f"__{k}") for k in columns])
    hit = c("__id").isNotNull()
    return df.join(new, c("row_id") == c("__id"), "left").withColumns({k: F.when(hit, c(f"__{k}")).otherwise(c(k)) for k in columns}).drop("__id", *[f"__{k}" for k in columns])


def settle(df: DataFrame, scorer: Callable[[DataFrame], DataFrame], check: Callable[[DataFrame], DataFrame], cfg: Config, columns: list[str], rounds: int = 4) -> DataFrame:
    """Score, rank, check and write back until the first rows stay the same, ``rounds`` times at most."""
    before: list | None = None
    for _ in range(rounds):
        ranked = cut(rank(scorer(df), cfg))
        top = [r[0] for r in ranked.where((c("category") == "PRIMARY") & (c("rank_in_category") <= cfg.top_n)).orderBy("rank_in_category").select("row_id").collect()]
        if top == before:
            return ranked
        before = top
        df = cut(write_back(df, check(ranked), columns))
    return rank(scorer(df), cfg)


def final_checks(ranked: DataFrame, cfg: Config) -> DataFrame:
    """(rule, bad) over the first rows: how many break each rule."""
    top = ranked.where((c("category") == "PRIMARY") & (c("rank_in_category") <= cfg.top_n))
    no = lambda x: ~F.coalesce(x, F.lit(False))
    rules = {
        "district": no(T.fold(c("district")) == T.fold(F.lit(cfg.district))) & no(c("inside_district_polygon")), "bedrooms": no(c("bedrooms").between(cfg.min_bedrooms, cfg.max_bedrooms)),
        "budget_class": (c("budget_class") == "STRICT_ALL_IN") & no(F.coalesce("estimated_total_monthly_usd", "rent_usd") <= cfg.target_max_total), "confidence": c("noise_confidence").isNull(), "demo": c("title").rlike(r"(?i)\bdemo\b|synthetic"),
    }
    aggs = [F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    flat = top.agg(*aggs, (F.count("*") - F.count_distinct("duplicate_group_id")).alias("repeated_groups"))
    return flat.unpivot([], [*rules, "repeated_groups"], "rule", "bad")
