"""Hard gates, the 100-point fit, noise, red flags and the sentences that go with them; columns only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config, wordings
from ..functions import text as T
from ..functions.money import budget_class, total_text
from ..functions.signals import foreign_tenant_in, foreign_text
from .ranking import value_bands

# Words of property types, markers of demo data.
APARTMENT = tuple(wordings()["apartment_types"])
NOT_APARTMENT = ("casa", "house", "oficina", "office", "local", "terreno", "habitacion", "cuarto", "room", "cochera", "deposito")
RENTING = ("alquiler", "rent", "arriendo")
DEMO_FIELD, DEMO_TEXT = r"(?i)\bdemo\b|\(demo|ejemplo|synthetic|sint[eé]tic|\bfake\b|lorem ipsum", r"(?i)\(demo|synthetic|lorem ipsum|fake listing"
DEMO_HOSTS = ("example.com", "example.org", "example.net", "localhost")
ROUGH = ("APPROXIMATE", "STREET_LEVEL")

c = F.col


def add(*terms: Column) -> Column:
    return reduce(lambda x, y: x + y, terms)


def points(condition: Column, value: float) -> Column:
    return F.when(condition, F.lit(float(value))).otherwise(F.lit(0.0))


def has(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda x, y: x | y, [text.contains(w) for w in words])


def says(text: str, *values: Column) -> Column:
    return F.format_string(text, *values)


def area() -> tuple[Column, Column]:
    """Built area if plausible, else total area, and which."""
    built, total = c("built_area_m2").between(12, 400), c("total_area_m2").between(12, 400)
    return F.when(built, c("built_area_m2")).when(total, c("total_area_m2")), F.when(built, "built").when(total, "total")


def space_band(cfg: Config, beds: Column, size: Column) -> Column:
    value = F.lit("UNKNOWN")
    for n, (fair, good, great) in cfg.space_bands.items():
        graded = F.when(size >= great, "VERY_SPACIOUS").when(size >= good, "GOOD").when(size >= fair, "ACCEPTABLE").otherwise("SMALL")
        value = F.when((beds == n) & size.isNotNull(), graded).otherwise(value)
    return value


def very_small(cfg: Config, beds: Column, size: Column) -> Column:
    return F.coalesce(reduce(lambda x, y: x | y, [(beds == n) & (size < cfg.very_small_factor * b[0]) for n, b in cfg.space_bands.items()]), F.lit(False))


def integrity_issues() -> Column:
    url = F.coalesce(c("source_url"), F.lit(""))
    marked = F.coalesce(*[F.when(c(k).rlike(DEMO_FIELD), F.lit(f"demo marker in {k}")) for k in ("title", "address", "agency_name", "agent_name", "source_listing_id", "source_url")])
    return T.listed(
        F.when(~url.startswith("http"), F.lit("no listing URL")).when(has(F.lower(url), DEMO_HOSTS), F.lit("demo/example URL")),
        marked, F.when(c("description").rlike(DEMO_TEXT), F.lit("demo marker in description")), F.when(c("rent_usd").isNull(), F.lit("rent missing")),
    )


def gates(cfg: Config) -> dict[str, Column]:
    """category, exclusion reasons (array) and gate flags (array)."""
    beds, rent, stated = c("bedrooms").cast("double"), c("rent_usd"), T.known(c("district"))
    kind, op = T.fold(F.coalesce(c("property_type"), F.lit(""))), T.fold(F.coalesce(c("operation"), F.lit("")))
    hard = T.listed(
        F.when((op != "") & ~has(op, RENTING), F.concat(F.lit("operation is '"), c("operation"), F.lit("', not rent"))),
        F.when(has(kind, NOT_APARTMENT) & ~has(kind, APARTMENT), F.concat(F.lit("property type '"), c("property_type"), F.lit("' is not an apartment"))),
        F.when(T.true(c("shared_room_text")), F.lit("room in a shared flat, not a whole unit")),
        F.when(c("active_status") == "INACTIVE", F.lit("listing inactive")),
        F.when(beds.isNull(), F.lit("bedroom count unknown")).when(beds == 0, F.lit("studio (0 bedrooms)")).when(~beds.between(cfg.min_bedrooms, cfg.max_bedrooms), F.concat(T.plain(beds), F.lit(" bedrooms"))),
        F.when(rent.isNull(), F.lit("rent unknown")),
    )
    if cfg.production:
        hard = F.concat(F.transform(integrity_issues(), lambda x: F.concat(F.lit("INTEGRITY: "), x)), hard)
    by_text = F.coalesce(T.fold(c("district")) == T.fold(F.lit(cfg.district)), F.lit(False))
    by_map, far = c("inside_district_polygon"), c("dist_outside_district_m").cast("double")
    rough = F.coalesce(c("coord_precision").isin(*ROUGH), F.lit(False))
    inside = F.when(by_map.isNull(), by_text).when(rough, by_text | (by_map & ~F.coalesce(stated, F.lit(False)))).otherwise(by_map)
    stated = F.coalesce(stated, F.lit(False))
    unmapped = F.when(stated, F.concat(F.lit("district text '"), c("district"), F.lit("'"))).otherwise("district not stated")
    why_out = F.when(by_map.isNull(), unmapped).otherwise(F.concat(F.lit(f"outside {cfg.district} ("), T.plain(F.coalesce(far, F.lit(0.0))), F.lit(" m beyond the boundary)")))
    near = F.coalesce((far <= cfg.near_miss_m) & (rent <= cfg.target_max_rent), F.lit(False))
    category = (
        F.when(F.size(hard) > 0, "EXCLUDED").when(~inside & near, "NEAR_MISS_CANDIDATE").when(~inside, "EXCLUDED")
        .when(rent <= cfg.target_max_rent, "PRIMARY").when(rent <= cfg.stretch_max_rent, "STRETCH").otherwise("EXCLUDED")
    )
    too_dear = F.concat(F.lit("rent USD "), T.plain(rent), F.lit(" above stretch ceiling"))
    reasons = F.when(F.size(hard) > 0, hard).when(~inside, F.array(why_out)).when(rent > cfg.stretch_max_rent, F.array(too_dear)).otherwise(F.array().cast("array<string>"))
    flags = T.listed(F.when(T.true(c("studio_text")) & (beds == 1), F.lit("STUDIO_WORDING")), F.when(by_map.isNotNull() & (by_map != by_text) & stated, F.lit("DISTRICT_MISMATCH")))
    return {"category": category, "__reasons": reasons, "__gate_flags": flags}


def stepped(distance: Column, steps: tuple) -> Column:
    """The penalty of the nearest step that the distance is within, as a negative number."""
    value = F.lit(0.0)
    for metres, penalty in reversed(steps):
        value = F.when(distance <= metres, F.lit(-float(penalty))).otherwise(value)
    return value


def noise(cfg: Config) -> dict[str, Column]:
    """Quietness 0-100 with risk, confidence, reasons and flags, from distances and from what the text says."""
    major, arterial, club = (c(f"dist_{k}_m").cast("double") for k in ("major_road", "arterial_road", "nightclub"))
    bars, food = (F.coalesce(c(k).cast("int"), F.lit(0)) for k in ("bars_within_m", "restaurants_within_m"))
    road, avenue = F.coalesce(F.nullif(c("major_road_name"), F.lit("")), F.lit("major road")), F.coalesce(F.nullif(c("arterial_road_name"), F.lit("")), F.lit("arterial"))
    located, t = major.isNotNull(), cfg.noise_text
    few = F.when(bars >= cfg.bars_many[0], -float(cfg.bars_many[1])).when(bars > 0, -float(cfg.bars_few_penalty)).otherwise(0.0)
    geo = add(stepped(major, cfg.major_road), F.coalesce(stepped(arterial, cfg.arterial_road), F.lit(0.0)), F.coalesce(stepped(club, cfg.nightclub), F.lit(0.0)), few, points(food >= cfg.restaurants_many[0], -cfg.restaurants_many[1]))
    faces, street = T.true(c("avenue_view")), T.true(c("exterior_view")) & ~T.true(c("avenue_view"))
    # A distance of 0 counts as unknown here.
    beside = street & located & (F.coalesce(F.nullif(major, F.lit(0.0)), F.lit(999.0)) <= 150)
    high = F.coalesce(c("floor") >= cfg.high_floor_from, F.lit(False))
    said = add(points(T.true(c("interior_view")), t["interior_view"]), points(T.true(c("acoustic_windows")), t["acoustic_windows"]), points(faces, t["avenue_view"]), points(beside, -4), points(T.true(c("quiet_claim")), t["quiet_claim"]), points(high, t["high_floor"]))
    raw = F.when(located, cfg.noise_baseline + geo + said).otherwise(50 + 0.6 * said)
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw))
    risk = F.when(score >= cfg.low_noise_from, "LOW").when(score >= cfg.medium_noise_from, "MEDIUM").otherwise("HIGH")
    rough = F.coalesce(c("coord_precision").isin(*ROUGH), F.lit(False))
    oriented = T.true(c("interior_view")) | T.true(c("exterior_view")) | T.true(c("avenue_view"))
    confidence = F.when(~located | rough, "LOW").when(c("coord_precision").isin("EXACT", "STREET_NUMBER") & oriented, "HIGH").otherwise("MEDIUM")
    m = lambda x: F.concat(T.plain(x), F.lit(" m"))
    (m1, _), (m2, _), (m3, _) = cfg.major_road
    (a1, _), (a2, _) = cfg.arterial_road
    (n1, _), (n2, _), (n3, _) = cfg.nightclub
    by_map = [
        F.when(major <= m2, F.concat(m(major), F.lit(" from "), road, F.lit(" (major road)"))).when(major <= m3, F.concat(m(major), F.lit(" from "), road)).otherwise(F.concat(F.lit("nearest major road ("), road, F.lit(") "), m(major), F.lit(" away"))),
        F.when(arterial <= a1, F.concat(F.lit("fronts/adjacent to "), avenue, F.lit(" ("), m(arterial), F.lit(")"))).when(arterial <= a2, F.concat(m(arterial), F.lit(" from "), avenue)),
        F.when(club <= n2, F.concat(F.lit("nightclub '"), F.coalesce(c("nightclub_name"), F.lit("None")), F.lit("' "), m(club), F.lit(" away"))).when(club <= n3, F.concat(F.lit("nightclub "), m(club), F.lit(" away"))).otherwise(f"no nightclub mapped within {n3} m"),
        F.when(bars >= cfg.bars_many[0], F.concat(bars.cast("string"), F.lit(f" bars/pubs within {cfg.cluster_radius_m:.0f} m"))).when(bars > 0, F.concat(bars.cast("string"), F.lit(f" bar(s) within {cfg.cluster_radius_m:.0f} m"))),
        F.when(food >= cfg.restaurants_many[0], F.concat(food.cast("string"), F.lit(f" restaurants within {cfg.cluster_radius_m:.0f} m (busy frontage)"))),
    ]
    reasons = T.listed(
        F.when(~located, F.lit("no usable coordinates — text evidence only")), *[F.when(located, x) for x in by_map],
        F.when(T.true(c("interior_view")), F.lit("listing says interior-facing / contrafrente")), F.when(T.true(c("acoustic_windows")), F.lit("acoustic / double-glazed windows mentioned")),
        F.when(faces, F.lit("listing says it faces an avenue")).when(beside, F.lit("street-facing unit near a major road")), F.when(T.true(c("quiet_claim")), F.lit("seller describes the street as quiet (unverified claim)")),
        F.when(high, F.concat(F.lit("high floor ("), c("floor").cast("int").cast("string"), F.lit(")"))), F.when(rough, F.lit("portal location is approximate")),
    )
    text = F.array_join(F.slice(reasons, 1, 6), "; ")
    sentence = F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 100000), F.lit(". Quietness estimate: "), F.lower(confidence), F.lit(" confidence."))
    flags = T.listed(F.when((located & (major <= m1)) | faces, F.lit("DIRECT_MAJOR_AVENUE")), F.when(located & ((club <= n2) | (bars >= cfg.bars_many[0])), F.lit("NIGHTLIFE_PROXIMITY")), F.when(risk == "HIGH", F.lit("HIGH_NOISE_RISK")))
    return {"quietness_score_0_100": F.bround(score, 0).cast("int"), "noise_risk": risk, "noise_confidence": confidence, "quietness_reason": sentence, "__noise_flags": flags}


def components(cfg: Config, as_of: str) -> dict[str, Column]:
    """The seven parts of the fit, each rounded to cents. ``as_of``: the day from which ages are counted."""
    w, rent, total = cfg.weights, c("rent_usd"), c("estimated_total_monthly_usd")
    slack = lambda cost: 0.3 * F.least(F.lit(1.0), (F.lit(float(cfg.target_max_rent)) - cost) / 300)
    paid = (
        F.when(rent.isNull(), 0.0).when(rent > cfg.target_max_rent, F.when(rent <= cfg.stretch_max_rent, 0.2).otherwise(0.0)).when(total.isNull(), 0.6 + slack(rent))
        .when(total <= cfg.target_max_total, 0.7 + slack(total)).when(total <= cfg.stretch_max_rent, 0.5).otherwise(0.3)
    )
    beds, (size, _) = c("bedrooms").cast("int"), area()
    band = space_band(cfg, beds, size)
    base = F.when(band == "VERY_SPACIOUS", 0.95).when(band == "GOOD", 0.8).when(band == "ACCEPTABLE", 0.55).when(very_small(cfg, beds, size), 0.15).when(band == "SMALL", 0.3).otherwise(0.35)
    extras = add(points(F.coalesce(c("bathrooms") >= 2, F.lit(False)), 0.05), points(T.true(c("balcony")) | T.true(c("terrace")), 0.05), points(T.true(c("study")), 0.05), points(T.true(c("laundry")), 0.025), points(T.true(c("walk_in_closet")), 0.025))
    d = {k: c(f"dist_{k}_m").cast("double") for k in cfg.livability}
    served = add(F.lit(0.0), *[F.when(d[k] <= m, x).when(d[k] <= m * 1.6, x / 2).otherwise(0.0) for k, (m, x) in cfg.livability.items()])
    place = F.when(d["supermarket"].isNull() & d["park"].isNull(), 0.5).otherwise(served)
    fitted = F.when(T.true(c("furnished")), 1.0).when(T.true(c("semi_furnished")), 0.6).when(c("furnished").eqNullSafe(F.lit(False)), 0.2).otherwise(0.35)
    parking = T.true(c("parking_included")) | F.coalesce(c("parking_spaces") > 0, F.lit(False))
    shared = reduce(lambda x, y: x | y, [T.true(c(k)) for k in ("gym", "pool", "coworking", "common_areas")])
    house = add(points(T.true(c("security_24h")), 0.35), points(T.true(c("elevator")), 0.2), points(T.true(c("laundry")), 0.15), points(parking, 0.15), points(shared, 0.15))
    date = F.when(c("publication_date").rlike(r"^\d{4}-\d{2}-\d{2}"), F.left(c("publication_date"), F.lit(10))).try_cast("date")
    age = F.datediff(F.lit(as_of).cast("date"), date)
    status = F.when(c("active_status") == "ACTIVE_CONFIRMED", 0.3).when(c("active_status") == "LIKELY_ACTIVE", 0.25).when(c("active_status") == "UNKNOWN", 0.1).otherwise(0.0)
    reach = F.coalesce(T.known(c("phone")) | T.known(c("whatsapp")) | T.known(c("agency_name")), F.lit(False))
    good = add(
        status, F.when(age <= 30, 0.2).when(age <= 90, 0.1).otherwise(0.0), F.when(c("image_count") >= 8, 0.1).when(c("image_count") >= 3, 0.05).otherwise(0.0), points(c("latitude").isNotNull(), 0.1),
        points(reach, 0.1), points(F.coalesce(F.length("description") >= 300, F.lit(False)), 0.1), points(F.coalesce(c("number_of_sources") >= 2, F.lit(False)), 0.1),
    )
    part = lambda k, x: F.round(float(w[k]) * x, 2)
    one = lambda x: F.least(F.lit(1.0), x)
    return {
        "pts_quietness": F.round(float(w["quietness"]) * c("quietness_score_0_100") / 100, 2), "pts_budget": part("budget", paid), "pts_space": part("space", one(base + extras)), "pts_location": part("location", place),
        "pts_furnishing": part("furnishing", fitted), "pts_building": part("building", one(house)), "pts_listing_quality": part("listing_quality", one(good)),
    }


def location_notes(cfg: Config) -> Column:
    labels = {"cafe": "café", "transit": "bus/Metropolitano stop", "malecon": "Malecón"}
    near = T.listed(*[F.when(c(f"dist_{k}_m") <= m, F.concat(F.lit(f"{labels.get(k, k)} "), T.plain(c(f"dist_{k}_m")), F.lit(" m"))) for k, (m, _) in cfg.livability.items()])
    return F.when(c("dist_supermarket_m").isNull() & c("dist_park_m").isNull(), "location data unavailable (neutral score)").otherwise(F.array_join(near, ", "))


def red_flags(cfg: Config) -> Column:
    beds, (size, _) = c("bedrooms").cast("int"), area()
    titled = T.found(T.fold(c("title")), r"(\d)\s*(?:dormitorio|dorm|habitaci|bedroom)").cast("int")
    no = lambda x: ~F.coalesce(x, F.lit(False))
    rules = {
        "PRICE_OVER_BUDGET": c("rent_usd") > cfg.target_max_rent, "TOTAL_COST_OVER_BUDGET": c("estimated_total_monthly_usd") > cfg.target_max_total,
        "UNKNOWN_MAINTENANCE": c("maintenance_usd").isNull() & ~T.true(c("maintenance_included_in_rent")), "VERY_SMALL_AREA": very_small(cfg, beds, size), "AREA_UNKNOWN": size.isNull(),
        "NO_PUBLICATION_DATE": no(T.known(c("publication_date"))), "UNKNOWN_ACTIVE_STATUS": c("active_status").isNull() | (c("active_status") == "UNKNOWN"),
        "VERY_HIGH_DEPOSIT": c("deposit_months") >= cfg.high_deposit_months, "LONG_MINIMUM_CONTRACT": c("minimum_contract_months") >= cfg.long_contract_months,
        "NO_FURNITURE": c("furnished").eqNullSafe(F.lit(False)) & ~T.true(c("semi_furnished")), "POSSIBLE_DUPLICATE": T.known(c("possible_duplicate_of")), "DUPLICATE_DATA_CONFLICT": T.known(c("dup_inconsistencies")),
        "INCOMPLETE_CONTACT": no(T.known(c("phone"))) & no(T.known(c("whatsapp"))), "INCOMPLETE_ADDRESS": no(c("address").rlike(r"\d")), "APPROXIMATE_LOCATION": c("coord_precision").isin(*ROUGH),
        "NO_COORDINATES": c("latitude").isNull(), "AREA_INCONSISTENT": (c("built_area_m2") != 0) & (c("total_area_m2") != 0) & (c("built_area_m2") > c("total_area_m2") * 1.05), "BEDROOM_TITLE_MISMATCH": titled != beds,
        "SHORT_TERM_WORDING": T.true(c("short_term_text")), "PRICE_CONVERTED_FROM_PEN": c("rent_usd_basis") == "CALCULATED",
    }
    return F.sort_array(F.array_distinct(F.concat(c("__gate_flags"), c("__noise_flags"), T.listed(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))))


def advantages() -> Column:
    usd = lambda x: F.concat(F.lit("USD "), T.whole(x))
    beds = F.coalesce(c("bedrooms").cast("int"), F.lit(0)).cast("string")
    words = lambda x: F.lower(F.replace(x, F.lit("_"), F.lit(" ")))
    all_ = T.listed(
        F.when(c("space_band").isin("VERY_SPACIOUS", "GOOD"), F.concat(T.plain(c("area_m2")), F.lit(" m² "), F.when(c("area_basis") == "built", "built ").otherwise(""), F.lit("area — "), words(c("space_band")), F.lit(" for a "), beds, F.lit("-bedroom"))),
        F.when((c("noise_risk") == "LOW") & (c("noise_confidence") != "LOW"), F.concat(F.lit("low estimated noise ("), c("quietness_score_0_100").cast("string"), F.lit("/100)"))),
        F.when(T.true(c("interior_view")), F.lit("interior-facing")), F.when(T.true(c("acoustic_windows")), F.lit("acoustic/double-glazed windows")),
        F.when(c("value_band").isin("EXCELLENT_VALUE", "GOOD_VALUE") & c("rent_usd_per_m2").isNotNull(), F.concat(F.lit("USD "), says("%.1f", c("rent_usd_per_m2")), F.lit("/m² ("), words(c("value_band")), F.lit(" vs other "), beds, F.lit("BR in sample)"))),
        F.when(c("estimated_total_monthly_usd") <= 850, F.concat(F.lit("all-in ≈ "), usd(c("estimated_total_monthly_usd")), F.lit("/month"))),
        F.when(T.true(c("furnished")), F.lit("furnished")), F.when(T.true(c("security_24h")), F.lit("building security/controlled access")), F.when(T.true(c("balcony")) | T.true(c("terrace")), F.lit("balcony/terrace")),
    )
    return F.coalesce(F.nullif(F.array_join(F.slice(all_, 1, 3), "; "), F.lit("")), F.lit("meets all hard requirements"))


def main_drawback() -> Column:
    n = lambda x: T.plain(F.coalesce(c(x).cast("double"), F.lit(0.0)))
    beside = F.coalesce(F.nullif(c("dist_major_road_m").cast("double"), F.lit(0.0)), F.lit(999.0)) <= 50
    texts = {
        "HIGH_NOISE_RISK": F.concat(F.lit("high estimated noise: "), F.coalesce(F.split("quietness_reason", ";")[0], F.lit(""))),
        "DIRECT_MAJOR_AVENUE": F.when(beside, F.concat(F.lit("only "), n("dist_major_road_m"), F.lit(" m from "), F.coalesce(F.nullif(c("major_road_name"), F.lit("")), F.lit("a major avenue")))).otherwise("listing says the unit faces an avenue"),
        "NIGHTLIFE_PROXIMITY": F.lit("bars/nightlife nearby — check at night"), "TOTAL_COST_OVER_BUDGET": F.concat(F.lit("rent + maintenance "), total_text(), F.lit(" exceeds USD 1,000")),
        "VERY_SMALL_AREA": F.concat(F.lit("only "), n("area_m2"), F.lit(" m²")), "LONG_MINIMUM_CONTRACT": F.concat(F.lit("minimum contract "), n("minimum_contract_months"), F.lit(" months")), "VERY_HIGH_DEPOSIT": F.concat(n("deposit_months"), F.lit(" months' deposit")),
        "UNKNOWN_MAINTENANCE": F.lit("maintenance fee not published — confirm before visiting"), "AREA_UNKNOWN": F.lit("floor area not published"), "NO_FURNITURE": F.lit("unfurnished"), "APPROXIMATE_LOCATION": F.lit("portal shows an approximate location only"),
        "NO_COORDINATES": F.lit("no map location — noise estimate is text-only"), "DUPLICATE_DATA_CONFLICT": F.concat(F.lit("portals disagree: "), F.coalesce(c("dup_inconsistencies"), F.lit("None"))),
        "INCOMPLETE_CONTACT": F.lit("no direct phone/WhatsApp — contact via portal"), "NO_PUBLICATION_DATE": F.lit("publication date unknown"),
    }
    flags = F.split("red_flags", "; ")
    return F.coalesce(*[F.when(F.array_contains(flags, k), v) for k, v in texts.items()], F.when(c("noise_risk") == "MEDIUM", F.lit("moderate estimated noise — visit at rush hour and at night")), F.lit("no major drawback identified from listing data"))


def score(df: DataFrame, cfg: Config, as_of: str) -> DataFrame:
    """Deduplicated, enriched listings -> scored listings. Every row is kept, copies and excluded ones too."""
    # Whose values are compared follows from the gates alone, so the counts that value bands need don't score the rows a second time.
    out = df.withColumns(gates(cfg) | noise(cfg)).withColumn("__compared", c("category").isin("PRIMARY", "STRETCH"))
    size, basis = area()
    out = out.withColumns(components(cfg, as_of) | {"area_m2": size, "area_basis": basis, "space_band": space_band(cfg, c("bedrooms").cast("int"), size), "location_notes": location_notes(cfg), "__foreign": foreign_text(c("title"), c("description"))})
    parts = ("pts_quietness", "pts_budget", "pts_space", "pts_location", "pts_furnishing", "pts_building", "pts_listing_quality")
    kind, note = budget_class(cfg)
    friendly, said = foreign_tenant_in(c("__foreign"), c("furnished"), c("minimum_contract_months"))
    out = out.withColumns({
        "fit_score": F.round(add(*map(c, parts)), 1), "budget_class": kind, "budget_note": note, "foreign_tenant_friendliness": friendly, "foreign_tenant_evidence": said,
        "red_flags": F.array_join(red_flags(cfg), "; "), "rent_usd_per_m2": F.when((c("rent_usd").isNotNull()) & (c("area_m2") > 0), F.round(c("rent_usd") / c("area_m2"), 2)),
    })
    weak = (c("category") == "NEAR_MISS_CANDIDATE") & (c("fit_score") < cfg.near_miss_min_fit)
    reasons = F.array_join("__reasons", "; ")
    out = out.withColumn("exclusion_reason", F.when(weak, F.concat(reasons, F.lit("; fit below near-miss bar"))).otherwise(reasons))
    out = out.withColumn("category", F.when(weak, "EXCLUDED").when(c("category") == "NEAR_MISS_CANDIDATE", "NEAR_MISS").otherwise(c("category")))
    out = value_bands(out, "bedrooms", "rent_usd_per_m2", c("__compared"), cfg.min_value_group)
    out = out.withColumns({"main_advantage": advantages(), "main_drawback": main_drawback(), "estimated_total_text": total_text()})
    return out.drop("__reasons", "__gate_flags", "__noise_flags", "__foreign", "__compared")
