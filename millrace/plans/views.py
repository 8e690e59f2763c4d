"""The fixed result views over ranked listings, each one select; and the display texts in their columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import text as T
from ..operators.ranking import display_tier

c = F.col
UNKNOWN = "UNKNOWN"

# Columns of the views, and names of sources.
LABELS = {"urbania": "Urbania", "adondevivir": "Adondevivir", "mercadolibre": "Mercado Libre", "manual": "Manual import"}
PICKS = "display_rank property total_text fit_score quietness area budget_class furnished parking contract contact value_band main_advantage main_drawback".split()
SHORTLIST = (
    "display_rank tier property category fit_score budget_class rent total_text maintenance quietness noise area space_band furnished parking floor contract deposit location contact sources value_band foreign_tenant red_flags main_advantage main_drawback source_url"
).split()


def quiet_space(ranked: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` of the primary category by quietness and space together."""
    value = F.round(F.lit(0.6) * c("quietness_score_0_100") + F.lit(2.0) * c("pts_space"), 4)
    return ranked.where("category = 'PRIMARY'").withColumn("quiet_space", value).orderBy(F.desc("quiet_space"), "row_id").limit(k)


def best_value(ranked: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` of the primary category in the two better value bands, without high noise, by rent for each square metre."""
    good = (c("category") == "PRIMARY") & c("value_band").isin("EXCELLENT_VALUE", "GOOD_VALUE") & (F.coalesce(c("noise_risk"), F.lit("")) != "HIGH")
    return ranked.where(good).orderBy("rent_usd_per_m2", "row_id").limit(k)


def yes_no(k: str) -> Column:
    return F.when(c(k), "Yes").when(~c(k), "No").otherwise(UNKNOWN)


def furnished_text() -> Column:
    return F.when(T.true(c("furnished")), "Yes").when(T.true(c("semi_furnished")), "Semi").when(c("furnished").eqNullSafe(F.lit(False)), "No").otherwise(UNKNOWN)


def parking_text() -> Column:
    return F.when(c("parking_spaces") > 0, F.concat(F.lit("Yes ("), c("parking_spaces").cast("string"), F.lit(")"))).when(c("parking_spaces") <= 0, "No").otherwise(yes_no("parking_included"))


def floor_text() -> Column:
    return F.coalesce(c("floor").cast("string"), F.lit(UNKNOWN))


def contract_text() -> Column:
    return F.coalesce(F.concat(c("minimum_contract_months").cast("string"), F.lit(" months min.")), F.lit(UNKNOWN))


def deposit_text() -> Column:
    short = lambda x: F.regexp_replace(x.cast("string"), r"\.0$", "")
    one = F.when(c("deposit_months") == 1, "").otherwise("s")
    said = T.joined("; ", F.concat(short(c("deposit_months")), F.lit(" month"), one, F.lit(" deposit")), F.concat(short(c("advance_months")), F.lit(" in advance")))
    return F.coalesce(F.nullif(said, F.lit("")), F.lit(UNKNOWN))


def maintenance_text() -> Column:
    soles = (c("maintenance_currency") == "PEN") & c("maintenance_pen").isNotNull()
    return F.when(T.true(c("maintenance_included_in_rent")), "Included in rent").when(soles, F.concat(F.lit("S/ "), T.whole(c("maintenance_pen")), F.lit(" (≈ USD "), T.whole(c("maintenance_usd")), F.lit(")"))).when(c("maintenance_usd").isNotNull(), F.concat(F.lit("USD "), T.whole(c("maintenance_usd")))).otherwise(UNKNOWN)


def sources_text() -> Column:
    names = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    each = F.filter(F.transform(F.split(F.coalesce(F.nullif(c("duplicate_sources"), F.lit("")), c("source")), ";"), lambda s: F.trim(s)), lambda s: s != "")
    return F.array_join(F.transform(each, lambda s: F.coalesce(F.try_element_at(names, s), s)), " + ")


def property_label() -> Column:
    place = F.coalesce(*[F.nullif(c(k), F.lit("")) for k in ("address", "subarea", "district")], F.lit(""))
    place = F.regexp_replace(F.regexp_replace(place, r"(?i)\s*,?\s*(Miraflores|Lima)(,\s*Lima)*\s*$", ""), r"^[ ,]+|[ ,]+$", "")
    head = F.concat(F.coalesce(c("bedrooms").cast("string"), F.lit("?")), F.lit("BR"), F.when(c("area_m2") > 0, F.concat(F.lit(" · "), T.plain(c("area_m2")), F.lit(" m²"))).otherwise(""))
    return F.concat(head, F.lit(" — "), F.when(place != "", place).otherwise(F.coalesce(F.substring("title", 1, 60), F.lit(""))))


def location_text() -> Column:
    where = F.coalesce(F.nullif(c("address"), F.lit("")), F.nullif(c("subarea"), F.lit("")), F.lit("address not published"))
    return T.joined(" · ", where, c("location_notes"))


def contact_text() -> Column:
    who = F.coalesce(F.nullif(c("agency_name"), F.lit("")), F.nullif(c("agent_name"), F.lit("")))
    direct = F.coalesce(F.concat(F.lit("WhatsApp "), F.nullif(c("whatsapp"), F.lit(""))), F.concat(F.lit("Tel. "), F.nullif(c("phone"), F.lit(""))), F.concat(F.lit("contact form on "), sources_text()))
    return T.joined(" · ", who, direct)


def noise_text() -> Column:
    return F.concat(c("noise_risk"), F.lit(" · conf. "), F.lower("noise_confidence"))


def why_matches() -> Column:
    return F.concat(c("main_advantage"), F.lit("; but: "), c("main_drawback"))


def questions() -> Column:
    """What to ask, from what is flagged."""
    flag = lambda k: F.array_contains(F.split("red_flags", "; "), k)
    return F.array_join(T.listed(F.when(flag("UNKNOWN_MAINTENANCE"), F.lit("How much is the maintenance fee?")), F.when(flag("AREA_UNKNOWN"), F.lit("What is the floor area?")), F.when(flag("APPROXIMATE_LOCATION"), F.lit("What is the exact address?")), F.when(flag("DIRECT_MAJOR_AVENUE"), F.lit("Does the bedroom face the avenue?")), F.when(c("minimum_contract_months").isNull(), F.lit("What is the minimum contract?"))), " ")


def display(ranked: DataFrame, cfg: Config) -> DataFrame:
    return ranked.select("*", *[v.alias(f"v_{k}") for k, v in {
        "display_rank": c("rank_in_category"), "tier": display_tier("rank_in_category", cfg.top_n), "property": property_label(), "total_text": c("estimated_total_text"), "fit_score": c("fit_score"), "quietness": c("quietness_score_0_100"), "noise": noise_text(),
        "area": F.coalesce(F.concat(T.plain(c("area_m2")), F.lit(" m²")), F.lit(UNKNOWN)), "space_band": c("space_band"), "budget_class": c("budget_class"), "rent": c("rent_usd"), "maintenance": maintenance_text(), "furnished": furnished_text(), "parking": parking_text(), "floor": floor_text(),
        "contract": contract_text(), "deposit": deposit_text(), "location": location_text(), "contact": contact_text(), "sources": sources_text(), "value_band": c("value_band"), "foreign_tenant": c("foreign_tenant_friendliness"), "red_flags": c("red_flags"), "main_advantage": c("main_advantage"),
        "main_drawback": c("main_drawback"), "category": c("category"), "source_url": c("source_url"), "questions": questions(), "why": why_matches(), "map": T.map_link(c("latitude"), c("longitude"), c("address"), ", Miraflores, Lima, Peru"),
    }.items()])


def _of(shown: DataFrame, names: list[str]) -> DataFrame:
    return shown.select(*[c(f"v_{n}").alias(n) for n in names])


def views(ranked: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    """Every deliverable view; each is lazy and small where it is a top list."""
    shown = display(ranked, cfg)
    primary, stretch = shown.where("category = 'PRIMARY'"), shown.where("category = 'STRETCH'")
    first = lambda df, n: df.where(c("rank_in_category") <= n)
    every = SHORTLIST + ["questions", "why", "map"]
    return {
        "client_top_picks": _of(first(primary, cfg.top_n), PICKS), "executive_shortlist": _of(first(primary, cfg.top_n + cfg.alternatives), SHORTLIST), "all_matches": _of(primary, every), "stretch": _of(stretch, every), "near_misses": _of(shown.where("category = 'NEAR_MISS'"), every),
        "quiet_space": _of(primary.orderBy((0.6 * c("quietness_score_0_100") + 2 * c("pts_space")).desc(), "row_id").limit(5), PICKS),
        "best_value": _of(primary.where(c("value_band").isin("EXCELLENT_VALUE", "GOOD_VALUE") & (c("noise_risk") != "HIGH")).orderBy("rent_usd_per_m2", "row_id").limit(5), PICKS),
        "stretch_top": _of(first(stretch, 5), PICKS), "contact_guide": _of(first(primary, cfg.top_n), ["display_rank", "property", "contact", "questions", "source_url"]),
        "scatter": shown.where("category IN ('PRIMARY', 'STRETCH')").select("row_id", "rent_usd", "area_m2", "quietness_score_0_100", "category"), "map_points": shown.where(c("latitude").isNotNull()).select("row_id", "latitude", "longitude", "category", "rank_in_category"),
    }


def register(ranked: DataFrame, cfg: Config) -> None:
    for name, df in views(ranked, cfg).items():
        df.createOrReplaceTempView(name)
