"""Entity resolution: which records describe the same flat. Nothing is deleted; each group gets a canonical record.

Pairs come from blocks, not from all rows. Apart from a URL, a source id or a sister source's id, no single piece of evidence
is worth the 0.45 that a possible duplicate needs, so every such pair shares two pieces at least. Blocks are therefore keyed by
two pieces (or three where two are common ones): a photo and a price, a street number and a cell of the map, an area and a
word of the description. A common title, photo, phone or house number alone is no block.

Numbers that are close, and places that are near, share a band or a cell, as each record enters all that its half tolerance
touches. Texts that are similar share words: a record probes with its rarest words, up to half of its letters, what others
index with all of theirs. So a pair whose texts agree in half of the letters of either text's words is met; similarity that
comes from parts of words alone is met only where other evidence does. Everything else is equal to comparing all pairs.

Records that agree in all but their texts are one class. Blocks without words are met by classes, and what their evidence decides
whatever the texts say is decided for all pairs of two classes at once; only the rest is compared record by record.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import geo
from ..functions import text as T
from ..functions.fuzzy import token_set_ratio
from . import extent
from .components import components, cut
from .ranking import numbered
from .spread import spread

# Fields that make a record complete, and fields that copies may fill.
COMPLETE = (
    "latitude", "total_area_m2", "maintenance_fee", "description", "publication_date", "phone", "floor", "furnished",
    "bathrooms", "address", "image_count",
)
BACKFILLED = (
    "latitude", "longitude", "coord_source", "coord_precision", "total_area_m2", "built_area_m2", "maintenance_fee",
    "maintenance_currency", "maintenance_pen", "maintenance_usd", "maintenance_pen_basis", "maintenance_usd_basis",
    "floor", "phone", "whatsapp", "publication_date", "furnished", "deposit_months", "minimum_contract_months",
)
_USED = "row_id source source_listing_id source_url bedrooms latitude longitude built_area_m2 total_area_m2 rent_usd phone title description address image_keys floor".split()


#: Every set of evidence worth 0.45 holds one of these. ``near`` lies within coord_match_m, ``cell`` within 100 m.
BLOCKS = (
    ("area", "photo"), ("price", "photo"), ("cell", "photo"), ("phone", "photo"), ("number", "photo"), ("floor", "photo"), ("title", "photo"), ("text", "photo"),
    ("area", "phone"), ("price", "phone"), ("cell", "phone"), ("number", "phone"), ("text", "phone"), ("area", "number"), ("price", "number"), ("cell", "number"), ("text", "number"),
    ("area", "cell"), ("price", "cell"), ("text", "cell"), ("floor", "near", "title"), ("area", "price", "title"), ("area", "text"), ("price", "text"), ("floor", "text", "title"),
)
#: Blocks that hold words of a record, and those that are the same for all records of a class.
WORDED = tuple(kinds for kinds in BLOCKS if {"title", "text"} & set(kinds))
PLAIN = tuple(kinds for kinds in BLOCKS if kinds not in WORDED)
#: What records of a class agree in: all that pairs are compared on but titles and descriptions.
LIKE = "source source_listing_id url no_url bedrooms latitude longitude built_area_m2 total_area_m2 rent_usd phone image_keys floor street numbers x y titled long".split()
#: Share of a text's letters, in whole words, that similar texts have in common at least.
SHARED = 0.5


def close(a: Column, b: Column, tolerance: float) -> Column:
    """Is the relative difference within the tolerance? Null if either is unknown or both are 0."""
    top = F.greatest(a, b)
    return F.when(a.isNotNull() & b.isNotNull() & (top != 0), F.abs(a - b) / top <= tolerance)


def areas(a: str, b: str) -> tuple[Column, Column]:
    """Like with like: built areas, else total areas, else whatever each side has."""
    get = lambda side, k: F.nullif(F.col(f"{side}.{k}"), F.lit(0.0))
    built, total = (get(a, "built_area_m2"), get(b, "built_area_m2")), (get(a, "total_area_m2"), get(b, "total_area_m2"))
    use_built, use_total = built[0].isNotNull() & built[1].isNotNull(), total[0].isNotNull() & total[1].isNotNull()
    return tuple(F.when(use_built, built[k]).when(use_total, total[k]).otherwise(F.coalesce(built[k], total[k])) for k in (0, 1))


def prepared(df: DataFrame) -> DataFrame:
    """What pairs are compared on, made once for each record."""
    c = F.col
    x, y = geo.project(c("latitude"), c("longitude"))
    ready = df.select(*_USED).withColumns({"url": T.norm_url(c("source_url")), "folded_title": T.fold(c("title")), "folded_text": T.fold(F.substring("description", 1, 800)), "text_size": F.least(F.length("description"), F.lit(800)), "street": T.norm_address(c("address")), "x": x, "y": y})
    ready = ready.withColumns({"numbers": T.street_numbers(c("street")), "no_url": c("url").isNull(), "titled": F.coalesce(T.known(c("folded_title")), F.lit(False)), "long": F.coalesce(T.known(c("folded_text")) & (c("text_size") > 80), F.lit(False))})
    return ready.drop("title", "description", "address", "source_url")


def without_lone(ready: DataFrame, cfg: Config) -> DataFrame:
    """``ready`` without URLs, ids, phones and photos that one record alone holds: they agree with nobody's, and tell nothing else."""
    c = F.col
    item = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))
    one = lambda kind, value, condition=F.lit(True): F.when(T.known(value) & condition, item(kind, value))
    numbered = T.known(c("source_listing_id"))
    single = F.array(one("url", c("url")), F.when(c("url") == "", item("url", c("url"))), one("id", F.concat_ws("\x1f", "source", "source_listing_id"), numbered), one("sister", c("source_listing_id"), c("source").isin(*cfg.sister_sources)), one("phone", c("phone")))
    photos = F.transform(F.array_distinct(F.coalesce("image_keys", F.array().cast("array<string>"))), lambda v: item("photo", v))
    held = ready.select("row_id", F.explode(F.concat(single, photos)).alias("e")).where(c("e").isNotNull()).select("row_id", "e.kind", "e.value").where(c("value").isNotNull())
    counts = cut(held.groupBy("kind", "value").agg(F.count("*").alias("n")).where(c("n") > 1))
    has = lambda kind: F.max(c("kind") == kind)
    known = spread(held, counts, ["kind", "value"], ["row_id"]).groupBy("row_id").agg(has("url").alias("__url"), (has("id") | has("sister")).alias("__id"), has("phone").alias("__phone"), F.array_sort(F.collect_set(F.when(c("kind") == "photo", c("value")))).alias("__photos"))
    kept = {"url": "__url", "source": "__id", "source_listing_id": "__id", "phone": "__phone"}
    out = ready.join(known, "row_id", "left").withColumns({k: F.when(c(flag), c(k)) for k, flag in kept.items()} | {"image_keys": F.coalesce("__photos", F.array().cast("array<string>"))})
    return out.drop("__url", "__id", "__phone", "__photos")


def classed(ready: DataFrame) -> DataFrame:
    """``ready`` with ``cls``, the least id of the records that it agrees with in all but texts, and their number ``n``."""
    told = ready.withColumn("__like", F.sha2(F.to_json(F.struct(*LIKE)), 256))
    sizes = cut(told.groupBy("__like").agg(F.min("row_id").alias("cls"), F.count("*").alias("n")))
    return spread(told, sizes, ["__like"], ["row_id"]).drop("__like")


def bands(value: Column, tolerance: float) -> Column:
    """Numbers of the logarithmic bands that a positive number's half tolerance touches: two that are close share one."""
    width = -math.log(1 - tolerance) + 1e-9
    place = F.ln(F.when(value > 0, value)) / width
    return F.array_distinct(F.array_compact(F.transform(F.array(place - 0.5, place + 0.5), lambda p: F.floor(p).cast("long"))))


def cells(x: Column, y: Column, reach: float) -> Column:
    """Cells twice as wide as ``reach`` that a circle of half of it touches: two places within reach share one."""
    size, half = 2 * (reach + 1), (reach + 1) / 2
    ends = lambda v: F.array_distinct(F.transform(F.array(v - half, v + half), lambda e: F.floor(e / size).cast("long")))
    found = F.flatten(F.transform(ends(x), lambda i: F.transform(ends(y), lambda j: F.xxhash64(i, j))))
    return F.coalesce(F.when(x.isNotNull() & y.isNotNull(), found), F.array().cast("array<long>"))


def words(ready: DataFrame, shared: float = SHARED) -> DataFrame:
    """(row_id, kind, words): array<struct<word, probe>> of each record's title and text; rarest words probe."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.array_distinct(F.filter(F.split(column, r"\s+"), lambda w: w != "")).alias("words")) for k, column in (("title", F.col("folded_title")), ("text", F.when(F.col("text_size") > 80, F.col("folded_text"))))])
    flat = cut(ready.select("row_id", F.explode(kinds).alias("e")).select("row_id", "e.kind", F.explode("e.words").alias("word")))
    counts = cut(flat.groupBy("kind", "word").agg(F.count("*").alias("n")))
    known = spread(flat, counts, ["kind", "word"], ["row_id"])
    ranked = known.groupBy("row_id", "kind").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("w"))
    before = lambda x, i: F.aggregate(F.slice("w", F.lit(1), i), F.lit(0), lambda sum_, y: sum_ + F.length(y["word"]))
    total = F.aggregate("w", F.lit(0), lambda sum_, y: sum_ + F.length(y["word"]))
    # Not shared is at most (1 - shared) of the letters, so words that hold more than that hold a shared one.
    # A word that is nobody else's counts as letters, but meets nobody.
    marked = F.transform("w", lambda x, i: F.struct(x["word"].alias("word"), (before(x, i) <= (1 - shared) * F.col("letters")).alias("probe"), x["n"].alias("n")))
    met = F.transform(F.filter(marked, lambda x: x["n"] > 1), lambda x: F.struct(x["word"].alias("word"), x["probe"].alias("probe")))
    return ranked.withColumn("letters", total).select("row_id", "kind", met.alias("words"))


def keys(ready: DataFrame, cfg: Config, blocks: tuple = BLOCKS) -> DataFrame:
    """(row_id, key, probe) of every block a record is in; ``key`` is a hash of what the block shares. URLs and ids alone are
    blocks too, but for those of ``WORDED``."""
    c = F.col
    none = F.array().cast("array<string>")
    full = ready
    if any(kinds in WORDED for kinds in blocks):
        texts = words(ready).groupBy("row_id").agg(*[F.first(F.when(c("kind") == k, c("words")), ignorenulls=True).alias(k) for k in ("title", "text")])
        no_words = F.array().cast("array<struct<word:string,probe:boolean>>")
        full = ready.join(texts, "row_id", "left").withColumns({k: F.coalesce(k, no_words) for k in ("title", "text")}).where((F.size("title") > 0) | (F.size("text") > 0) | F.lit(blocks != WORDED))
    sister = c("source").isin(*cfg.sister_sources)
    some = lambda condition, value: F.when(F.coalesce(condition, F.lit(False)), F.array(value.cast("string"))).otherwise(none)
    plain = lambda values: F.transform(values, lambda v: v.cast("string"))
    # Pieces of evidence. Areas of either kind are compared with each other where one is missing, so they share bands.
    full = full.withColumns({
        "e_area": plain(F.array_union(bands(c("built_area_m2"), cfg.area_tolerance), bands(c("total_area_m2"), cfg.area_tolerance))), "e_price": plain(bands(c("rent_usd"), cfg.price_tolerance)),
        "e_cell": plain(cells(c("x"), c("y"), 100.0)), "e_near": plain(cells(c("x"), c("y"), cfg.coord_match_m)), "e_phone": some(T.known(c("phone")), c("phone")), "e_floor": some(c("floor").isNotNull(), c("floor")),
        "e_photo": F.coalesce("image_keys", none), "e_number": F.coalesce("numbers", none),
    })
    sure = lambda x: F.struct(x.alias("at"), F.lit(True).alias("probe"))
    of = lambda k: F.transform(f"e_{k}", sure) if k not in ("title", "text") else F.transform(k, lambda w: F.struct(w["word"].alias("at"), w["probe"].alias("probe")))

    def block(*kinds: str) -> Column:
        """Every combination of one piece of each kind; it probes if its words do."""
        label = "+".join(kinds)
        made = F.transform(of(kinds[0]), lambda a: F.struct(F.xxhash64(F.lit(label), a["at"]).alias("key"), a["probe"].alias("probe")))
        joined = lambda others: lambda a: F.transform(others, lambda b: F.struct(F.xxhash64(a["key"], b["at"]).alias("key"), (a["probe"] & b["probe"]).alias("probe")))
        for k in kinds[1:]:
            made = F.flatten(F.transform(made, joined(of(k))))
        return made

    alone = lambda label, values: F.transform(values, lambda v: F.struct(F.xxhash64(F.lit(label), v).alias("key"), F.lit(True).alias("probe")))
    own = [alone("url", some(T.known(c("url")), c("url"))), alone("id", some(T.known(c("source_listing_id")), F.concat_ws("\x1f", "source", "source_listing_id"))), alone("sister", some(sister & T.known(c("source_listing_id")), c("source_listing_id")))]
    # One explode after another, so that no row holds the keys of all kinds at once.
    which = [*(own if blocks != WORDED else []), *[block(*kinds) for kinds in blocks]]
    return full.select("row_id", F.explode(F.array(*which)).alias("made")).select("row_id", F.explode("made").alias("m")).select("row_id", "m.key", "m.probe")


def candidates(ready: DataFrame, cfg: Config, blocks: tuple = BLOCKS, bounded: bool = False) -> DataFrame:
    """(a, b), a < b: pairs that share a block, where one of the two probes with it. If ``bounded``, without those that can't be
    possible duplicates: they are ruled out where they meet, so that only pairs that count are shuffled."""
    return _meeting(_keyed(ready, cfg, blocks), ready, cfg, bounded)


def _keyed(ready: DataFrame, cfg: Config, blocks: tuple) -> DataFrame:
    return cut(keys(ready, cfg, blocks).groupBy("row_id", "key").agg(F.max("probe").alias("probe")))


def _meeting(k: DataFrame, ready: DataFrame, cfg: Config, bounded: bool) -> DataFrame:
    # Blocks of one row meet nobody; most keys go here.
    shared = k.groupBy("key").agg(F.count("*").alias("n"), F.max("probe").alias("any")).where((F.col("n") > 1) & F.col("any")).select("key")
    k = k.join(shared, "key", "left_semi")
    k = cut(k.join(ready.select("row_id", _brief().alias("brief")), "row_id") if bounded else k)
    l, r = k.alias("l"), k.alias("r")
    meet = (F.col("l.key") == F.col("r.key")) & F.col("l.probe") & (F.col("l.row_id") != F.col("r.row_id")) & (~F.col("r.probe") | (F.col("l.row_id") < F.col("r.row_id")))
    return l.join(r, meet & _may(cfg) if bounded else meet).select(F.least("l.row_id", "r.row_id").alias("a"), F.greatest("l.row_id", "r.row_id").alias("b")).distinct()


def class_pairs(ready: DataFrame, cfg: Config) -> DataFrame:
    """(a, b, verdict), a <= b: classes of ``classed`` records that share a block, and classes of several records that are in one.

    ``verdict`` is 2 if all of their pairs are merged and 1 if all are possible duplicates, whatever their texts say, and null if
    texts have to tell. Pairs that can be neither are left out.
    """
    c = F.col
    classes = cut(ready.where(c("row_id") == c("cls")).select("row_id", "n", *LIKE))
    k = _keyed(classes, cfg, PLAIN)
    apart = _meeting(k, classes, cfg, True)
    own = classes.where(c("n") > 1).join(k.select("row_id").distinct(), "row_id", "left_semi").select(c("row_id").alias("a"), c("row_id").alias("b"))
    return _decided(cut(apart.union(own)), classes, cfg)


#: Metres on the ground to the square of the chord of a unit sphere, a little more or less for rounding.
_CHORD = lambda metres, slack: (2 * math.sin(metres / geo.EARTH_M / 2)) ** 2 * slack


def _brief() -> Column:
    """Few numbers of a class by which most of the pairs that meet are ruled out; ``_may`` is short, as long ones aren't compiled."""
    c = F.col
    lat, lon = F.radians("latitude"), F.radians("longitude")
    sizes = [F.nullif(c(k), F.lit(0.0)) for k in ("built_area_m2", "total_area_m2")]
    kept = {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat), "a0": F.least(*sizes), "a1": F.greatest(*sizes), "rent": F.nullif("rent_usd", F.lit(0.0)), "beds": c("bedrooms"), "floor": c("floor"), "phone": c("phone"), "photos": F.when(F.size("image_keys") > 0, c("image_keys")), "numbers": F.when(F.size("numbers") > 0, c("numbers"))}
    # What texts and names can add at most; names that others share are looked at with all the rest.
    more = F.when(c("titled"), 0.10).otherwise(0.0) + F.when(c("long"), 0.30).otherwise(0.0) + F.when(c("url").isNotNull() | c("source_listing_id").isNotNull() | (F.least("rent_usd", *sizes) < 0), 9.0).otherwise(0.0)
    return F.struct(*[v.alias(k) for k, v in kept.items()], more.alias("more"))


def _may(cfg: Config) -> Column:
    """False only where l and r can't be a possible duplicate: an upper bound of their score from ``brief``."""
    l, r = (lambda k: F.col(f"l.brief.{k}")), (lambda k: F.col(f"r.brief.{k}"))
    square = lambda k: (l(k) - r(k)) * (l(k) - r(k))
    chord = square("x") + square("y") + square("z")
    more = F.least(l("more"), r("more"))
    top = F.greatest(l("rent"), r("rent"))
    price = F.abs(l("rent") - r("rent"))
    near_area = (l("a0") * (1 - cfg.area_tolerance) <= r("a1") * (1 + 1e-9)) & (r("a0") * (1 - cfg.area_tolerance) <= l("a1") * (1 + 1e-9))
    far_area = (l("a0") * 0.85 > r("a1") * (1 + 1e-9)) | (r("a0") * 0.85 > l("a1") * (1 + 1e-9))
    terms = [
        F.when(chord <= _CHORD(cfg.coord_match_m, 1 + 1e-6), 0.30).when(chord <= _CHORD(100, 1 + 1e-6), 0.10).when(chord > _CHORD(600, 1 + 1e-6), -0.50).otherwise(0.0),
        F.when(near_area, 0.20).when(far_area, -0.30).otherwise(0.0),
        F.when(price <= top * (cfg.price_tolerance + 1e-9), 0.15).when(price > top * (0.15 + 1e-9), -0.30).otherwise(0.0),
        F.when(l("phone") == r("phone"), 0.25).otherwise(0.0), F.when(l("floor") == r("floor"), 0.05).when(l("floor") != r("floor"), -0.15).otherwise(0.0),
        F.when(F.arrays_overlap(l("photos"), r("photos")), 0.40).otherwise(0.0), F.when(F.arrays_overlap(l("numbers"), r("numbers")), 0.20).when(l("numbers").isNotNull() & r("numbers").isNotNull(), -0.20).otherwise(0.0),
    ]
    return F.when(l("beds") != r("beds"), more > 5.0).otherwise(reduce(lambda x, y: x + y, terms, more) >= cfg.match_threshold - 0.15 - 1e-6)


def _decided(pairs: DataFrame, classes: DataFrame, cfg: Config) -> DataFrame:
    c = F.col
    none = F.lit(False)
    reached = lambda score, anchored: F.when(c("same"), 2).when((score >= cfg.match_threshold) & anchored, 2).when(score >= cfg.match_threshold - 0.15, 1).otherwise(0)
    both = _both(pairs, classes, cfg).withColumns({"low": _total(none, none, none), "high": _total(c("titled"), c("long_texts"), c("streets"))})
    both = both.where(c("same") | ~c("beds_differ"))
    out = both.select("a", "b", reached(c("low"), c("sure")).alias("least"), reached(c("high"), c("sure") | c("streets")).alias("most"))
    return cut(out).where(c("most") > 0).select("a", "b", F.when(c("least") == c("most"), c("most")).alias("verdict"))


def open_pairs(pairs: DataFrame, ready: DataFrame, cfg: Config) -> DataFrame:
    """Both records of each pair, and in ``open`` whether the texts can still decide: only then are they compared."""
    return _compared(pairs, ready, cfg)[0]


def scored(pairs: DataFrame, ready: DataFrame, cfg: Config) -> DataFrame:
    """(a, b, score, anchored, why). Terms are added in a fixed order, as sums of doubles depend on it. Pairs that no text could
    bring to a possible duplicate are scored without their texts."""
    return _compared(pairs, ready, cfg)[1]()


def _both(pairs: DataFrame, rows: DataFrame, cfg: Config) -> DataFrame:
    """``pairs`` with the records l and r of ``rows`` and what they have in common. Evidence is made step by step, as the machine
    code of one long expression would not be compiled."""
    row = F.struct(*rows.columns)
    left, right = rows.select(F.col("row_id").alias("a"), row.alias("l")), rows.select(F.col("row_id").alias("b"), row.alias("r"))
    c = F.col
    l, r = (lambda k: c(f"l.{k}")), (lambda k: c(f"r.{k}"))
    same = lambda k: T.known(l(k)) & (l(k) == r(k))
    yes = lambda x: F.coalesce(x, F.lit(False))
    rent_a, rent_b = F.nullif(l("rent_usd"), F.lit(0.0)), F.nullif(r("rent_usd"), F.lit(0.0))
    far_price = F.coalesce(F.abs(rent_a - rent_b) / F.greatest(rent_a, rent_b) > 0.35, F.lit(False))
    both = pairs.join(left, "a").join(right, "b").where(~far_price | yes(l("url") == r("url")) | (l("no_url") & r("no_url")))
    area_a, area_b = areas("l", "r")
    sisters = lambda k: l(k).isin(*cfg.sister_sources) & r(k).isin(*cfg.sister_sources) & (l(k) != r(k))
    both = both.withColumns({
        "m": geo.haversine(l("latitude"), l("longitude"), r("latitude"), r("longitude")), "areas": F.struct(area_a.alias("a"), area_b.alias("b")),
        "same_url": yes(same("url")), "same_id": yes((l("source") == r("source")) & same("source_listing_id")), "sister": yes(sisters("source") & same("source_listing_id")),
        "numbered": (F.size(l("numbers")) > 0) & (F.size(r("numbers")) > 0), "share_number": F.arrays_overlap(l("numbers"), r("numbers")), "photo": yes(F.arrays_overlap(l("image_keys"), r("image_keys"))),
    })

    def graded(a: Column, b: Column, tolerance: float, gain: float) -> Column:
        tight, loose = close(a, b, tolerance), close(a, b, 0.15)
        return F.when(tight, gain).when(~tight & ~yes(loose), -0.30).otherwise(0.0)

    both = both.withColumns({
        "area": graded(c("areas.a"), c("areas.b"), cfg.area_tolerance, 0.20), "price": graded(l("rent_usd"), r("rent_usd"), cfg.price_tolerance, 0.15), "near": yes(c("m") <= cfg.coord_match_m), "phone": yes(same("phone")),
        "same": c("same_url") | c("same_id"), "beds_differ": yes(l("bedrooms") != r("bedrooms")), "titled": l("titled") & r("titled"), "long_texts": l("long") & r("long"), "streets": yes(c("numbered") & c("share_number")),
    })
    return both.withColumn("sure", c("sister") | c("near") | c("photo"))


def _total(title: Column, text: Column, same_street: Column) -> Column:
    """The score of what ``_both`` gives, once it is known which texts are alike."""
    c = F.col
    terms = [
        F.when(c("sister"), 0.9).otherwise(0.0), F.when(c("near"), 0.30).when(c("m") <= 100, 0.10).when(c("m") > 600, -0.50).otherwise(0.0), c("area"), c("price"),
        F.when(c("phone"), 0.25).otherwise(0.0), F.when(title, 0.10).otherwise(0.0), F.when(text, 0.30).otherwise(0.0),
        F.when(same_street, 0.20).when(c("numbered") & ~c("share_number"), -0.20).otherwise(0.0), F.when(c("photo"), 0.40).otherwise(0.0),
        F.when(c("l.floor") == c("r.floor"), 0.05).when(c("l.floor") != c("r.floor"), -0.15).otherwise(0.0),
    ]
    return reduce(lambda x, y: x + y, terms)


def _compared(pairs: DataFrame, ready: DataFrame, cfg: Config):
    c = F.col
    l, r = (lambda k: c(f"l.{k}")), (lambda k: c(f"r.{k}"))
    # What texts could add at most decides whether they are compared at all.
    both = _both(pairs, ready, cfg).withColumn("best", _total(c("titled"), c("long_texts"), c("streets")))
    both = both.withColumn("open", ~c("same") & ~c("beds_differ") & (c("best") >= cfg.match_threshold - 0.15 - 1e-9))

    def score() -> DataFrame:
        yes = lambda x: F.coalesce(x, F.lit(False))
        ratio = lambda condition, k: token_set_ratio(F.when(c("open") & condition, l(k)), F.when(c("open") & condition, r(k)))
        texts = both.withColumns({"t": ratio(c("titled"), "folded_title"), "d": F.when(c("long_texts"), ratio(c("long_texts"), "folded_text")), "s": ratio(c("streets"), "street")})
        texts = texts.withColumns({"same_street": yes(c("streets") & (c("s") >= 90)), "title": yes((c("t") >= cfg.title_ratio) & c("l.titled")), "text": yes(c("d") >= cfg.description_ratio)})
        why = T.listed(
            F.when(c("sister"), F.lit("same sister-source id")), F.when(c("near"), F.concat(F.lit("coords "), T.plain(c("m")), F.lit(" m apart"))), F.when(c("area") > 0, F.lit("same area")), F.when(c("price") > 0, F.lit("same price")),
            F.when(c("phone"), F.lit("same phone")), F.when(c("title"), F.lit("similar title")), F.when(c("text"), F.concat(F.lit("description "), T.plain(c("d")), F.lit("% similar"))), F.when(c("same_street"), F.lit("same numbered address")), F.when(c("photo"), F.lit("shared photo id")),
        )
        one = lambda label: F.array(F.lit(label))
        return texts.select(
            "a", "b",
            F.when(c("same"), 1.0).when(c("beds_differ"), 0.0).otherwise(_total(c("title"), c("text"), c("same_street"))).alias("score"),
            (c("same") | (~c("beds_differ") & (c("sure") | c("same_street")))).alias("anchored"),
            F.when(c("same_url"), one("same URL")).when(c("same_id"), one("same source id")).when(c("beds_differ"), one("bedrooms differ")).otherwise(why).alias("why"),
        )

    return both, score


def completeness() -> Column:
    return reduce(lambda x, y: x + y, [F.when(T.known(F.col(k)), 1).otherwise(0) for k in COMPLETE])


def canonical_order(cfg: Config) -> list[Column]:
    priority = F.coalesce(*[F.when(F.col("source") == s, k) for k, s in enumerate(cfg.source_priority)], F.lit(9))
    return [completeness().desc(), priority.asc(), F.col("row_id").asc()]


def conflicts(grouped: DataFrame) -> DataFrame:
    """Per group, what its copies disagree on."""
    c = F.col
    street = F.nullif(T.norm_address(c("address")), F.lit(""))
    point = F.when(c("latitude").isNotNull() & c("longitude").isNotNull(), F.struct("latitude", "longitude"))
    inactive = F.coalesce(c("active_status") == "INACTIVE", F.lit(False))
    facts = grouped.withColumn("__street", street).groupBy("root").agg(
        F.min("rent_usd").alias("p0"), F.max("rent_usd").alias("p1"), F.count("rent_usd").alias("pn"), F.min("total_area_m2").alias("a0"), F.max("total_area_m2").alias("a1"), F.count("total_area_m2").alias("an"),
        F.array_sort(F.collect_set("bedrooms")).alias("beds"), F.max(inactive).alias("off"), F.min(inactive).alias("all_off"), F.when(F.min(point) != F.max(point), 2).otherwise(1).alias("places"), F.min_by("__street", F.when(street.isNotNull(), c("row_id"))).alias("first_street"),
    )
    ratios = grouped.withColumn("__street", street).join(facts.select("root", "first_street"), "root").where(c("__street").isNotNull() & c("first_street").isNotNull())
    ratios = ratios.withColumn("__r", token_set_ratio(c("first_street"), c("__street"))).groupBy("root").agg(F.min("__r").alias("ratio"))
    far = extent.spreads(grouped.join(facts.where(c("places") > 1).select("root"), "root", "left_semi"), "root", "latitude", "longitude")
    span = lambda low, high, unit: F.concat(F.lit(" ("), T.plain(c(low)), F.lit("–"), T.plain(c(high)), F.lit(f" {unit})"))
    issues = T.listed(
        F.when((c("pn") > 1) & (c("p1") / F.greatest(c("p0"), F.lit(1.0)) > 1.05), F.concat(F.lit("PRICE_MISMATCH"), span("p0", "p1", "USD"))),
        F.when((c("an") > 1) & (c("a1") / F.greatest(c("a0"), F.lit(1.0)) > 1.10), F.concat(F.lit("AREA_MISMATCH"), span("a0", "a1", "m²"))),
        F.when(F.size("beds") > 1, F.concat(F.lit("BEDROOM_MISMATCH ("), F.array_join(c("beds").cast("array<string>"), ", "), F.lit(")"))),
        F.when(c("off") & ~c("all_off"), F.lit("STATUS_MISMATCH (one copy marked inactive)")),
        F.when(c("spread") > 150, F.concat(F.lit("COORD_MISMATCH ("), T.plain(c("spread")), F.lit(" m apart)"))),
        F.when(c("ratio") < 70, F.lit("ADDRESS_MISMATCH")),
    )
    return facts.join(ratios, "root", "left").join(far, "root", "left").select("root", F.array_join(issues, "; ").alias("issues"))


def deduplicate(df: DataFrame, cfg: Config, evidence: bool = True) -> DataFrame:
    """``df`` (listing columns and a unique row_id) with group, canonical flag, rollup, conflicts and backfill.

    Without ``evidence`` the column dedupe_evidence, which names every merged pair, is not made, so pairs of classes that are merged
    whatever their texts say need not be told apart."""
    c = F.col
    # Read for words, for keys and for either side of a pair, so its texts are folded once, by all cores.
    ready = cut(prepared(df.repartition(df.sparkSession.sparkContext.defaultParallelism)))
    ready = cut(classed(without_lone(ready, cfg)))
    worded = candidates(ready, cfg, WORDED, True)
    told_classes = class_pairs(ready, cfg)
    members = ready.select("cls", "row_id")
    apart = told_classes.where(c("verdict").isNull() | (c("verdict") == 2) if evidence else c("verdict").isNull())
    each = apart.join(members.toDF("a", "l"), "a").join(members.toDF("b", "r"), "b").where((c("a") != c("b")) | (c("l") < c("r")))
    each = each.select(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b"))
    pairs = cut(scored(each.union(worded).distinct(), ready, cfg))
    merged = pairs.where((c("score") >= cfg.match_threshold) & c("anchored"))
    maybe = pairs.where(~((c("score") >= cfg.match_threshold) & c("anchored")) & (c("score") >= cfg.match_threshold - 0.15))
    # Classes that are merged are so with all of their records: those lead to the first of them, and that to the other class's.
    fused = told_classes.where("verdict = 2").select("a", "b")
    inside = members.join(fused.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "cls", "left_semi").where(c("cls") != c("row_id"))
    roots = components(merged.select("a", "b").union(fused.where("a < b")).union(inside.select("cls", "row_id")))
    rooted = df.join(roots.withColumnRenamed("id", "row_id"), "row_id", "left").withColumn("root", F.coalesce("root", "row_id"))
    # Groups are numbered by their first record; the numbers come from one row for each group.
    numbers = numbered(rooted.select("root").distinct(), [], [c("root").asc()], "n")
    named = rooted.join(numbers, "root").withColumn("duplicate_group_id", F.concat(F.lit("G"), F.when(c("n") < 10000, F.lpad(c("n").cast("string"), 4, "0")).otherwise(c("n").cast("string")))).drop("n")
    group_of = named.select("row_id", "duplicate_group_id")
    # Groups of possible pairs, and of all records of possible classes.
    groups = members.join(group_of, "row_id").select("cls", "duplicate_group_id").distinct()
    whole = told_classes.where("verdict = 1").join(groups.toDF("a", "own"), "a").join(groups.toDF("b", "theirs"), "b").select("own", "theirs")
    single = maybe.select("a", "b").join(group_of.toDF("a", "own"), "a").join(group_of.toDF("b", "theirs"), "b").select("own", "theirs")
    other = whole.union(single).where(c("own") != c("theirs"))
    other = other.union(other.select("theirs", "own"))
    possible = other.groupBy(c("own").alias("duplicate_group_id")).agg(F.array_join(F.array_sort(F.collect_set("theirs")), "; ").alias("possible"))
    group = Window.partitionBy("root")
    order = group.orderBy(*canonical_order(cfg))
    ahead = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = {f"__{k}": F.first(F.when(c(k).isNotNull(), F.struct(c(k).alias("v"), c("source").alias("s"))), ignorenulls=True).over(ahead) for k in BACKFILLED}
    ranked = named.withColumns({"__place": F.row_number().over(order), "__size": F.count("*").over(group)} | first)
    canon, several = c("__place") == 1, c("__size") > 1
    filled = T.listed(*[F.when(c(k).isNull() & c(f"__{k}").isNotNull(), F.concat(F.lit(f"{k}←"), c(f"__{k}.s"))) for k in BACKFILLED])
    rollup = named.groupBy("root").agg(F.array_join(F.array_sort(F.collect_set("source")), "; ").alias("duplicate_sources"), F.countDistinct("source").alias("sources"), F.array_sort(F.collect_list(F.when(c("source_url").isNotNull(), F.struct("row_id", "source_url")))).alias("urls"))
    rollup = rollup.withColumn("duplicate_urls", F.array_join(F.array_distinct(c("urls.source_url")), "; ")).drop("urls")
    out = ranked.join(rollup, "root").join(conflicts(named), "root").join(possible, "duplicate_group_id", "left")
    if evidence:
        # Both ways, in order of the other record.
        label = df.select(c("row_id").alias("other"), F.concat(c("source"), F.lit(":"), F.coalesce("source_listing_id", F.lit("None"))).alias("label"))
        ways = merged.select(c("a").alias("row_id"), c("b").alias("other"), "why").union(merged.select("b", "a", "why")).join(label, "other")
        told = ways.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("other", F.concat(F.lit("≈"), "label", F.lit(" ("), F.array_join("why", ", "), F.lit(")")).alias("text")))).alias("e")).select("row_id", F.array_join(c("e.text"), "; ").alias("dedupe_evidence"))
        out = out.join(told, "row_id", "left").withColumn("dedupe_evidence", F.coalesce("dedupe_evidence", F.lit("")))
    new = {
        "is_canonical": canon, "duplicate_sources": F.when(canon, c("duplicate_sources")).otherwise(""), "duplicate_urls": F.when(canon, c("duplicate_urls")).otherwise(""),
        "number_of_sources": F.when(canon, c("sources")).otherwise(1).cast("int"), "number_of_records": F.when(canon, c("__size")).otherwise(1).cast("int"), "dup_inconsistencies": F.when(canon & several, c("issues")).otherwise(""),
        "fields_filled_from_duplicates": F.when(canon & several, F.array_join(filled, "; ")).otherwise(""), "possible_duplicate_of": F.when(canon, F.coalesce("possible", F.lit(""))).otherwise(""),
    }
    out = out.withColumns(new).withColumns({k: F.when(canon, F.coalesce(c(k), c(f"__{k}.v"))).otherwise(c(k)) for k in BACKFILLED})
    total = lambda k: F.when(canon & several, F.coalesce(F.round(c(f"rent_{k}") + c(f"maintenance_{k}"), 2), c(f"estimated_total_monthly_{k}"))).otherwise(c(f"estimated_total_monthly_{k}"))
    out = out.withColumns({f"estimated_total_monthly_{k}": total(k) for k in ("usd", "pen")})
    return out.drop("root", "sources", "issues", "possible", "__place", "__size", *[f"__{k}" for k in BACKFILLED])
