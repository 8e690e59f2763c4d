"""Raw JSON records of several shapes -> listing columns. Paths look keys up exactly first, then without case."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.money import currency_code

c = F.col
_MAP, _LIST = "map<string,string>", "array<string>"

# Where each field may be in a record, first that is filled wins.
PATHS = {
    "url": ("url", "link", "detailUrl", "postingUrl", "permalink", "listingUrl", "href"),
    "id": ("id", "postingId", "listingId", "propertyId", "postingCode", "code"),
    "title": ("title", "generatedTitle", "name", "headline"),
    "description": ("description", "descriptionNormalized", "fullDescription", "text", "body"),
    "published": (
        "publicationDate", "publishedAt", "publishDate", "published", "createdAt", "created", "datePublished",
        "publishedText", "publicationDateText", "antiquity",
    ),
    "updated": ("modifiedDate", "updatedAt", "lastUpdate", "modified", "lastModified", "updated"),
    "status": ("status", "postingStatus", "isActive", "active", "available"),
    "price": ("price", "priceAmount", "price.amount", "price.value", "rent", "monthlyPrice"),
    "currency": ("currency", "priceCurrency", "price.currency", "currencyCode"),
    "price_usd": ("priceUSD", "priceUsd", "price_usd", "usdPrice", "priceInUsd"),
    "price_pen": ("pricePEN", "pricePen", "price_pen", "penPrice", "priceInPen"),
    "expenses": (
        "expenses", "maintenance", "maintenanceFee", "expensas", "commonExpenses", "maintenanceCost", "hoa",
        "gastosComunes",
    ),
    "expenses_currency": ("expensesCurrency", "maintenanceCurrency", "expenses.currency"),
    "bedrooms": ("bedrooms", "dormitorios", "bedroomsCount", "bedroom", "numBedrooms"),
    "bathrooms": ("bathrooms", "baths", "banos", "bathroomsCount"),
    "total_area": (
        "totalArea", "total_area", "areaTotal", "totalSurface", "surfaceTotal", "area", "surface", "m2Total",
    ),
    "built_area": (
        "coveredArea", "builtArea", "covered_area", "roofedArea", "areaTechada", "coveredSurface", "surfaceCovered",
    ),
    "floor": ("floor", "piso", "unitFloor"),
    "total_floors": ("totalFloors", "floors", "buildingFloors"),
    "parking": ("parking", "parkingSpaces", "garages", "parkingLots", "estacionamientos"),
    "latitude": (
        "latitude", "lat", "geolocation.latitude", "geoLocation.latitude", "location.latitude", "location.lat",
        "coordinates.latitude", "coordinates.lat", "postingLocation.postingGeolocation.geolocation.latitude",
        "geo.lat", "geo.latitude", "mapLocation.lat",
    ),
    "longitude": (
        "longitude", "lng", "lon", "geolocation.longitude", "geoLocation.longitude", "location.longitude",
        "location.lng", "location.lon", "coordinates.longitude", "coordinates.lng",
        "postingLocation.postingGeolocation.geolocation.longitude", "geo.lng", "geo.lon", "geo.longitude",
        "mapLocation.lng",
    ),
    "exact": ("showExactLocation", "exactLocation", "postingLocation.postingGeolocation.showExactLocation"),
    "approximate": ("isApproximate", "approximateLocation", "locationIsApproximate"),
    "address": (
        "address.name", "address.street", "address.value", "address", "postingLocation.address.name",
        "location.address", "street", "fullAddress", "addressLine",
    ),
    "district": (
        "district.name", "district", "neighborhood", "neighbourhood", "postingLocation.location.name",
        "location.name", "locationName", "location.district", "comuna", "barrio",
    ),
    "subarea": (
        "city.name", "city", "postingLocation.location.parent.name", "location.city", "province", "zone",
        "locationText", "fullLocation",
    ),
    "property_type": ("propertyType", "realEstateType.name", "property_type", "type", "category"),
    "operation": ("operationType", "operation", "priceOperationTypes.0.operationType.name", "transaction"),
    "agent": ("contactName", "agent.name", "agentName", "contact.name"),
    "agency": (
        "publisher.name", "publisherName", "agencyName", "agency.name", "advertiser.name", "advertiserName",
        "realEstate.name", "inmobiliaria",
    ),
    "phone": (
        "phone", "phones.0", "publisher.phone", "contact.phone", "phoneNumber", "telephone", "mobile", "cellPhone",
    ),
    "whatsapp": (
        "whatsapp", "whatsApp", "whatsappNumber", "publisher.whatsapp", "contact.whatsapp", "publisher.whatsApp",
    ),
    "furnished": ("furnished", "isFurnished", "amoblado"),
    "images": ("images", "pictures", "photos", "visiblePictures.pictures", "gallery", "imageUrls", "imagesUrls"),
    "main_image": ("mainImage.url", "mainImage.src", "mainImage", "mainImageUrl", "thumbnail", "coverImage", "image"),
    "image_count": ("picturesCount", "imageCount", "imagesCount", "photoCount"),
}
# Keys of pictures, of labelled features and of amenities; label rules; words of closed listings; plausible coordinates.
IMAGE = ("url", "url730x532", "resizeUrl1200x1200", "src", "href", "original", "large")
FEATURES = ("mainFeatures", "features", "characteristics", "attributes", "specs", "details")
AMENITIES = (
    "amenities", "generalFeatures", "services", "extras", "facilities", "amenitiesList", "features",
    "characteristics",
)
#: field -> pattern of its label, in order of precedence.
RULES = {
    "bedrooms": r"dormitorio|dorm\b|dorm\.|habitaci|recamara|bedroom", "half_bath": r"medio bano|medios banos|toilette|half bath", "bathrooms": r"bano|bath",
    "total_area_m2": r"(area|superficie|sup\.?)\s*total|m2 tot|m² tot|tot\.|total area", "built_area_m2": r"techad|construid|cubiert|covered|built|m2 cub|m² cub|cub\.",
    "parking_spaces": r"estacionamiento|cochera|parking|garage|estac\.", "total_floors": r"(cantidad|numero|n°) de pisos|pisos del edificio|total floors",
    "floor": r"^piso\b|numero de piso|piso de la unidad|ubicacion en piso|\bfloor\b",
}
CLOSED = ("finaliz", "offline", "paused", "pausad", "inactive", "alquilad", "rented", "sold")
LAT, LON = (-12.30, -11.80), (-77.25, -76.80)


def child(text: Column, key: str) -> Column:
    """One step of a path: an element of a list, or a value of an object by its exact key, else by its key without case."""
    if key.isdigit():
        return F.get(F.from_json(text, _LIST), int(key))
    return looked_up(F.map_entries(F.from_json(text, _MAP)), key)


def looked_up(entries: Column, key: str) -> Column:
    """The value of a key among an object's entries; the exact one sorts first."""
    loose = F.filter(entries, lambda e: F.lower(e["key"]) == key.lower())
    exact = F.get(F.filter(loose, lambda e: e["key"] == key), 0)["value"]
    return F.coalesce(exact, F.get(loose, 0)["value"])


def get_path(text: Column, path: str) -> Column:
    return reduce(child, path.split("."), text)


def filled(value: Column) -> Column:
    return F.when(~value.isin("", "[]", "{}"), value)


def pick(text: Column, *paths: str) -> Column:
    return F.coalesce(*[filled(get_path(text, p)) for p in paths])


def scalar(value: Column) -> Column:
    return F.when(~value.rlike(r"^\s*[\[{]"), value)


# ---------------------------------------------------------------- shapes, resolved as variants
#: Fields that are read as numbers.
NUMBERS = (
    "price", "price_usd", "price_pen", "expenses", "bedrooms", "bathrooms", "total_area", "built_area", "floor", "total_floors",
    "parking", "latitude", "longitude", "image_count", "rooms",
)
#: Labelled values inside labelled values are opened this many levels deep.
DEPTH = 4
_ITEM = "struct<label:string,value:string,rest:string>"


def lower_keys(text: Column) -> Column:
    """JSON text with its keys in lower case: what stands between two quotes with a colon behind the second, unless it ends in a backslash.

    The text is parted at the first quote of each key. What is before the first one is an opening bracket, or no object is read from it.
    """
    key = lambda p: F.substring_index(p, '"', 1)
    return F.array_join(F.transform(F.split(text, r'"(?=[^"]*+(?<!\\)"\s*:)'), lambda p: F.concat(F.lower(key(p)), F.substr(p, F.length(key(p)) + 1))), '"')


def under(record: Column, path: str) -> Column:
    """The variant at a dotted path of a struct of variants."""
    first, _, rest = path.partition(".")
    return at(record[first], rest) if rest else record[first]


def at(value: Column, path: str, kind: str = "variant") -> Column:
    """What is at a dotted path of a variant; a step of digits is a place in a list."""
    steps = "".join(f"[{k}]" if k.isdigit() else f".{k}" for k in path.split("."))
    return F.try_variant_get(value, f"${steps}", kind)


def is_a(value: Column, *kinds: str) -> Column:
    return named_as(F.schema_of_variant(value), *kinds)


def named_as(kind: Column, *kinds: str) -> Column:
    return reduce(lambda x, y: x | y, [kind.startswith(k) for k in kinds])


def number_text(value: Column) -> Column:
    """The text of a variant. Three digits behind a point would read as thousands in text; a number's point is always decimal."""
    def read(kind: Column) -> Column:
        digits = F.when(named_as(kind, "DOUBLE"), value.cast("string").try_cast("decimal(38,12)").cast("string")).otherwise(value.cast("string"))
        return F.when(named_as(kind, "DECIMAL", "DOUBLE"), T.let(digits, lambda d: F.when(d.rlike(r"\.\d{3}$"), F.concat(d, F.lit("0"))).otherwise(d))).otherwise(value.cast("string"))

    return T.let(F.schema_of_variant(value), read)


def first_filled(value: Column, paths: tuple[str, ...]) -> Column:
    """The variant at the first path that holds anything but null, "", [] or {}."""
    return _first([at(value, p) for p in paths])


def _first(found: list[Column]) -> Column:
    # No lambda: those run outside generated code, a hundred paths of them for each record.
    return F.coalesce(*[F.when(~x.cast("string").isin("", "[]", "{}"), x) for x in found])


def _first_text(found: list[Column]) -> Column:
    return F.coalesce(*[filled(x.cast("string")) for x in found])


def first_text(value: Column, paths: tuple[str, ...]) -> Column:
    return _first_text([at(value, p) for p in paths])


def container(keys: Column, values: Column, key: str) -> Column:
    """The text of a top-level value as it stands in the record. ``keys`` (in lower case) and ``values`` run backwards, so of keys that
    differ in case only the last counts."""
    return filled(F.get(values, F.array_position(keys, key.lower()).cast("int") - 1))


def _item(label: Column, value: Column, rest: Column) -> Column:
    return F.struct(label.cast("string").alias("label"), value.cast("string").alias("value"), rest.cast("string").alias("rest")).cast(_ITEM)


def _labelled(inner: Column, label: Column, *keys: str) -> Column:
    return _item(label, F.coalesce(*[number_text(at(inner, k)) for k in keys]), F.lit(None))


def opened(text: Column) -> Column:
    """One level of a labelled structure in its own order: pairs, and the texts of what has to be opened in turn."""
    none, text_or = F.lit(None), lambda *keys: lambda x: F.coalesce(*[F.nullif(at(x, k, "string"), F.lit("")) for k in keys])

    def field(e: Column) -> Column:
        key, value = e["key"], e["value"]
        named = at(value, "label").isNotNull() | at(value, "name").isNotNull()
        label = F.coalesce(text_or("label", "name")(value), F.lit("None"))
        as_it_stands = F.from_json(text, _MAP)[key]
        return T.let(F.schema_of_variant(value), lambda kind: F.when(named_as(kind, "OBJECT"), F.when(named, _labelled(value, label, "value", "measure")).otherwise(_item(none, none, as_it_stands))).when(named_as(kind, "ARRAY"), _item(none, none, as_it_stands)).when(value.cast("string").isNotNull(), _item(key, number_text(value), none)))

    def member(value: Column, place: Column) -> Column:
        own = lambda label: _labelled(value, label, "value", "value_name", "measure")
        as_it_stands = F.get(F.from_json(text, _LIST), place)
        thing = T.let(text_or("label", "name", "key", "title")(value), lambda label: F.when(label.isNull(), _item(none, none, as_it_stands)).otherwise(own(label)))
        return T.let(F.schema_of_variant(value), lambda kind: F.when(kind == "STRING", _item(value.cast("string"), value.cast("string"), none)).when(named_as(kind, "OBJECT"), thing))

    fields, members = F.map_entries(F.from_json(text, "map<string,variant>")), F.from_json(text, "array<variant>")
    return F.array_compact(F.when(text.startswith("{"), F.transform(fields, field)).when(text.startswith("["), F.transform(members, member)))


def labelled(df: DataFrame, name: str, texts: list[Column]) -> DataFrame:
    """``df`` with ``name``: for each text the (label, value) pairs of labelled objects, of plain objects, and of lists of either or of texts."""
    start = F.transform(F.array(*texts), lambda t: F.when(t.isNotNull(), F.array(_item(F.lit(None), F.lit(None), t))).otherwise(F.array().cast(f"array<{_ITEM}>")))
    df = df.withColumn(name, start)
    to_open = lambda items: F.exists(items, lambda i: i["rest"].isNotNull())
    for _ in range(DEPTH):
        more = lambda items: F.flatten(F.transform(items, lambda i: F.when(i["rest"].isNull(), F.array(i)).otherwise(F.coalesce(opened(i["rest"]), F.array().cast(f"array<{_ITEM}>")))))
        df = df.withColumn(name, F.transform(name, lambda items: F.when(to_open(items), more(items)).otherwise(items)))
    return df.withColumn(name, F.transform(name, lambda items: F.filter(items, lambda i: i["rest"].isNull())))


def resolved(df: DataFrame, column: str) -> DataFrame:
    """``df`` and a column __<field> for each field: the text at its first filled path, all prices, pairs of features and of amenities.

    The record is parsed once as a variant with keys in lower case; where an object has keys that differ in case only, it is
    parsed as it is and lower-case paths are looked up. Labelled structures are read in the order of the text. Text that is no
    JSON object has no fields.
    """
    whole = F.coalesce(F.try_parse_json(lower_keys(c(column))), F.try_parse_json(column))
    # All first steps come out of one pass over the record's keys.
    heads = sorted({p.lower().partition(".")[0] for paths in PATHS.values() for p in paths} | {"rooms", "prices", "priceoperationtypes"})
    raw = df.withColumn("__low", whole).withColumn("__low", F.try_variant_get("__low", "$", f"struct<{','.join(f'`{k}`:variant' for k in heads)}>"))
    v = c("__low")
    each = lambda k: [under(v, p.lower()) for p in PATHS.get(k, (k,))]
    texts = {f"__{k}": _first_text(each(k)) for k in PATHS if k not in NUMBERS and k != "images"}
    raw = raw.withColumns(texts | {f"__v_{k}": _first(each(k)) for k in (*NUMBERS, "images")})
    held, kind = (lambda k: c(f"__v_{k}")), (lambda k: c(f"__k_{k}"))
    top = F.from_json(column, _MAP)
    backwards = {"__keys": F.reverse(F.transform(F.map_keys("__top"), F.lower)), "__values": F.reverse(F.map_values("__top"))}
    raw = raw.withColumns({f"__k_{k}": F.schema_of_variant(held(k)) for k in NUMBERS} | {"__top": top}).withColumns(backwards)

    def number(value: Column, kind: Column) -> Column:
        return F.when(kind == "STRING", T.to_float(value.cast("string"))).when(kind != "BOOLEAN", F.try_variant_get(value, "$", "double"))

    def held_number(k: str) -> Column:
        part = first_filled(held(k), ("value", "amount", "number"))
        return F.when(kind(k).startswith("OBJECT"), number(part, F.schema_of_variant(part))).otherwise(number(held(k), kind(k)))

    inner = lambda k: F.when(kind(k).startswith("OBJECT"), at(held(k), "currency", "string"))
    codes = {"__currency": F.coalesce(c("__currency"), inner("price")), "__expenses_currency": F.coalesce(c("__expenses_currency"), inner("expenses"))}
    codes |= {f"__said_{k}": F.when(kind(k) == "STRING", held(k).cast("string")) for k in ("price", "expenses")} | {f"__has_{k}": held(k).isNotNull() for k in ("floor", "parking")}
    money = lambda p: F.struct(at(p, "currency", "string").alias("currency"), number_text(F.coalesce(first_filled(p, ("amount",)), first_filled(p, ("value",)))).alias("amount"))
    listed = lambda x: F.try_variant_get(x, "$", "array<variant>")
    none = F.array().cast("array<struct<currency:string,amount:string>>")
    priced = lambda x: F.coalesce(F.transform(F.filter(x, lambda p: is_a(p, "OBJECT")), money), none)
    nested = F.flatten(F.array_compact(F.transform(listed(v["priceoperationtypes"]), lambda o: listed(at(o, "prices")))))
    prices = F.concat(priced(nested), priced(listed(v["prices"])))
    image = lambda p: T.let(F.schema_of_variant(p), lambda kind: F.when(kind == "STRING", p.cast("string")).when(named_as(kind, "OBJECT"), first_text(p, tuple(k.lower() for k in IMAGE))))
    pictures = F.coalesce(F.array_compact(F.transform(listed(held("images")), image)), F.array().cast("array<string>"))
    raw = raw.withColumns({f"__n_{k}": held_number(k) for k in NUMBERS} | codes | {"__prices": prices, "__pictures": pictures})
    holders = list(dict.fromkeys(FEATURES + AMENITIES))
    raw = labelled(raw, "__labels", [container(c("__keys"), c("__values"), k) for k in holders])
    pairs_of = lambda keys: F.flatten(F.array(*[F.get("__labels", holders.index(k)) for k in keys]))
    raw = raw.withColumns({"__pairs": pairs_of(FEATURES), "__extras": pairs_of(AMENITIES)})
    return raw.drop("__low", "__top", "__keys", "__values", "__labels", *[f"__v_{k}" for k in (*NUMBERS, "images")], *[f"__k_{k}" for k in NUMBERS])


def tagged(pairs: Column) -> Column:
    """Each pair once: the rule that its label answers to, the first of them, and its number; pairs without are left out."""
    folded = F.transform(pairs, lambda x: F.struct(T.fold(x["label"]).alias("said"), F.equal_null(x["label"], x["value"]).alias("own"), x["value"].alias("value")))
    ruled = F.transform(folded, lambda x: F.struct(F.coalesce(*[F.when(x["said"].rlike(p), F.lit(k)) for k, p in RULES.items()]).alias("rule"), x["said"].alias("said"), x["own"].alias("own"), x["value"].alias("value")))
    known = F.filter(ruled, lambda x: x["rule"].isNotNull())
    number = F.transform(known, lambda x: F.struct(x["rule"].alias("rule"), F.when(~(x["rule"].endswith("area_m2") & x["own"] & ~x["said"].contains("m")), T.to_float(F.when(x["own"], x["said"]).otherwise(x["value"]))).alias("number")))
    return F.filter(number, lambda x: x["number"].isNotNull())


def feature_values(found: Column) -> dict[str, Column]:
    """The first number that a label of each rule gives, out of ``tagged`` pairs."""
    return {name: F.get(F.filter(found, lambda x: x["rule"] == name), 0)["number"] for name in RULES}


def amenities(pairs: Column) -> Column:
    yes = F.filter(pairs, lambda x: x["value"].isNull() | (x["value"] == x["label"]) | x["value"].isin("true", "Sí", "Si", "si", "sí", "1"))
    return F.array_distinct(F.filter(F.transform(yes, lambda x: F.trim(x["label"])), lambda x: (x != "") & ~x.rlike(r"^\d")))


def map_record(df: DataFrame, column: str, source: Column, scraped_at: Column, base_url: str = "") -> DataFrame:
    """(… , json) -> listing columns beside those of ``df``. Unknown stays null."""
    raw = resolved(df, column).withColumn("scraped_at", scraped_at)
    price = lambda p: F.struct(currency_code(p["currency"]).alias("currency"), T.to_float(p["amount"]).alias("amount"))
    raw = raw.withColumn("__prices", F.filter(F.transform("__prices", price), lambda p: p["currency"].isNotNull() & (p["amount"] != 0)))
    g = lambda k: c(f"__{k}")
    raw = raw.withColumn("__tagged", tagged(g("pairs")))
    raw = raw.withColumns({f"__f_{k}": v for k, v in feature_values(g("tagged")).items()})
    f = lambda k: c(f"__f_{k}")
    url = F.when(g("url").startswith("/"), F.concat(F.lit(base_url.rstrip("/")), g("url"))).otherwise(g("url"))
    listing_id = F.coalesce(g("id"), T.found(url, r"-(\d{6,})\.html"), T.found(url, r"(\d{8,})"))
    # Price: the first published; else the flat one; else the converted figure that looks typed by hand.
    first = F.get(g("prices"), 0)
    raw = raw.withColumns({"__code": F.coalesce(currency_code(g("currency")), T.money_currency(g("said_price"))), "__dues_code": F.coalesce(currency_code(g("expenses_currency")), T.money_currency(g("said_expenses")))})
    n = lambda k: c(f"__n_{k}")
    whole = lambda k: F.bround(n(k), 0).try_cast("int")
    flat, flat_currency = n("price"), c("__code")
    usd, pen = F.nullif(n("price_usd"), F.lit(0.0)), F.nullif(n("price_pen"), F.lit(0.0))
    use_usd = usd.isNotNull() & ((usd % 10 == 0) | pen.isNull() | (pen % 10 != 0))
    converted = usd.isNotNull() | pen.isNotNull()
    stated = (flat != 0) & flat_currency.isNotNull()
    amount = F.when(first.isNotNull(), first["amount"]).when(stated, flat).when(converted, F.when(use_usd, usd).otherwise(pen)).otherwise(flat)
    currency = F.when(first.isNotNull(), first["currency"]).when(stated, flat_currency).when(converted, F.when(use_usd, F.lit("USD")).otherwise("PEN")).otherwise(flat_currency)
    in_ = lambda code: F.coalesce(F.get(F.filter(g("prices"), lambda p: p["currency"] == code), 0)["amount"], F.when(first.isNull() & (currency == code), amount))
    fee, fee_currency = n("expenses"), c("__dues_code")
    charged = fee > 0
    lat, lon = n("latitude"), n("longitude")
    placed = F.coalesce(lat.between(*LAT) & lon.between(*LON), F.lit(False))
    exact, rough = T.to_bool(g("exact")), T.to_bool(g("approximate"))
    status = T.fold(F.coalesce(g("status"), F.lit("")))
    closed = (status == "false") | F.exists(F.array(*map(F.lit, CLOSED)), lambda w: status.contains(w))
    pictures = g("pictures")
    keys = F.filter(F.transform(pictures, lambda u: F.regexp_extract(u, r"(?i)/([0-9a-f]{12,}|\d{7,})[^/]*\.(?:jpe?g|png|webp)", 1)), lambda k: k != "")
    columns = {
        "source": source, "source_listing_id": listing_id, "source_url": url, "publication_date": T.date_text(g("published"), scraped_at), "last_updated_date": T.date_text(g("updated"), scraped_at),
        "active_status": F.when(closed, "INACTIVE").otherwise("LIKELY_ACTIVE"), "active_evidence": F.when(closed, F.concat(F.lit("source status = "), g("status"))).otherwise(F.concat(F.lit("returned by a live "), source, F.lit(" search at "), scraped_at)),
        "title": F.nullif(T.strip_html(g("title")), F.lit("")), "description": F.nullif(T.strip_html(g("description")), F.lit("")), "district": scalar(g("district")), "subarea": scalar(g("subarea")), "address": scalar(g("address")),
        "latitude": F.when(placed, lat), "longitude": F.when(placed, lon), "coord_source": F.when(placed, "LISTING"),
        "coord_precision": F.when(placed, F.when(T.true(exact) | rough.eqNullSafe(F.lit(False)), "EXACT").when(exact.eqNullSafe(F.lit(False)) | T.true(rough), "APPROXIMATE").otherwise("UNSPECIFIED")),
        "rent_original": amount, "rent_currency": currency, "rent_usd": in_("USD"), "rent_usd_basis": F.when(in_("USD").isNotNull(), "PUBLISHED"), "rent_pen": in_("PEN"), "rent_pen_basis": F.when(in_("PEN").isNotNull(), "PUBLISHED"),
        "maintenance_fee": F.when(charged, fee), "maintenance_currency": F.when(charged, F.coalesce(fee_currency, F.lit("PEN"))), "property_type": scalar(g("property_type")), "operation": scalar(g("operation")),
        "bedrooms": F.coalesce(whole("bedrooms"), F.bround(f("bedrooms"), 0).cast("int"), whole("rooms")), "bathrooms": F.coalesce(n("bathrooms"), f("bathrooms") + 0.5 * F.coalesce(f("half_bath"), F.lit(0.0))),
        "total_area_m2": F.coalesce(F.nullif(n("total_area"), F.lit(0.0)), f("total_area_m2")), "built_area_m2": F.coalesce(F.nullif(n("built_area"), F.lit(0.0)), f("built_area_m2")),
        "floor": F.when(g("has_floor"), whole("floor")).otherwise(F.bround(f("floor"), 0).cast("int")), "total_floors": F.coalesce(F.nullif(whole("total_floors"), F.lit(0)), F.bround(f("total_floors"), 0).cast("int")),
        "parking_spaces": F.when(g("has_parking"), whole("parking")).otherwise(F.bround(f("parking_spaces"), 0).cast("int")), "agent_name": scalar(g("agent")), "agency_name": scalar(g("agency")), "phone": scalar(g("phone")), "whatsapp": scalar(g("whatsapp")),
        "main_image_url": F.coalesce(scalar(g("main_image")), F.get(pictures, 0)), "image_count": F.coalesce(F.nullif(whole("image_count"), F.lit(0)), F.nullif(F.size(pictures), F.lit(0))), "image_keys": keys, "amenities": amenities(g("extras")),
        "furnished": T.to_bool(g("furnished")), "text_signals": T.listed(F.when(charged & fee_currency.isNull(), F.lit("maintenance currency not provided by source — assumed PEN"))),
    }
    return raw.select(*[c(k) for k in df.columns], "scraped_at", *[v.alias(k) for k, v in columns.items()])


def page_url(search: Column, page: Column, size: int = 48) -> Column:
    """Address of a numbered result page."""
    return F.when(page == 1, search).otherwise(F.concat(F.regexp_replace(search, "/+$", ""), F.lit("/_Desde_"), ((page - 1) * size + 1).cast("string"), F.lit("_NoIndex_True")))


def numbered_page_url(search: Column, page: Column) -> Column:
    """Address of a numbered result page of portals that put the number before the suffix, or in the query."""
    n = page.cast("string")
    suffixed = F.concat(F.regexp_replace(search, r"\.html$", ""), F.lit("-pagina-"), n, F.lit(".html"))
    return F.when(page == 1, search).when(search.endswith(".html"), suffixed).otherwise(F.concat(search, F.when(search.contains("?"), "&").otherwise("?"), F.lit("page="), n))


def id_from_url(url: Column) -> Column:
    return F.concat(F.lit("MPE"), T.found(url, r"MPE-?(\d{6,})"))
