"""Map elements (JSON with an ``elements`` list) -> layers of shapes in metres, and the district's outline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import rings

# Road classes, and which tags put a place in which layer, in order.
MAJOR = ("motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link")
ARTERIAL = ("secondary", "secondary_link")
GEOMETRY = "array<struct<lat:double,lon:double>>"
ELEMENT = f"struct<type:string,id:bigint,lat:double,lon:double,tags:map<string,string>,geometry:{GEOMETRY},center:struct<lat:double,lon:double>,members:array<struct<type:string,role:string,geometry:{GEOMETRY}>>>"

c = F.col


def read_elements(spark: SparkSession, path: str, as_of: str | None = None, days: int = 30) -> DataFrame:
    """(seq, element) of a cached response; ``path`` may name several files. With ``as_of``, only responses that are at most
    ``days`` whole days old then; one that doesn't say when it was fetched is too old."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<_fetched_at:string,elements:array<{ELEMENT}>>").alias("r"))
    if as_of is not None:
        age = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(c("r._fetched_at").try_cast("timestamp"))
        raw = raw.where(F.floor(age / 86400) <= days)
    return raw.select(F.posexplode("r.elements").alias("seq", "element"))


def _tag(name: str) -> Column:
    return F.try_element_at(c("element.tags"), F.lit(name))


def _points(geometry: Column) -> Column:
    def point(g: Column) -> Column:
        x, y = geo.project(g["lat"], g["lon"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(F.filter(geometry, lambda g: g.isNotNull()), point)


def layers(elements: DataFrame) -> DataFrame:
    """(layer, name, seq, kind, points). A waterfront way that is also a road is in both layers."""
    name = F.coalesce(*[F.nullif(_tag(k), F.lit("")) for k in ("name", "brand", "ref")], F.lit("(unnamed)"))
    way, shaped = c("element.type") == "way", c("element.geometry").isNotNull()
    road, amenity, shop = _tag("highway"), _tag("amenity"), _tag("shop")
    front = way & shaped & F.lower(name).startswith("malec")
    green = way & shaped & _tag("leisure").isin("park", "garden")
    at = F.coalesce(F.when(c("element.lat").isNotNull(), F.struct(c("element.lat").alias("lat"), c("element.lon").alias("lon"))), c("element.center"))
    place = (
        F.when(amenity.isin("nightclub", "stripclub") | (_tag("leisure") == "dance"), "nightclub").when(amenity.isin("bar", "pub"), "bar").when(amenity.isin("restaurant", "fast_food"), "restaurant").when(amenity == "cafe", "cafe")
        .when(amenity == "pharmacy", "pharmacy").when(shop.isin("supermarket", "convenience"), "supermarket").when((road == "bus_stop") | _tag("public_transport").isin("station", "platform") | (amenity == "bus_station"), "transit")
    )
    entry = lambda layer, kind, points: F.struct(layer.alias("layer"), F.lit(kind).alias("kind"), points.alias("points"))
    line = _points(c("element.geometry"))
    ways = F.when(way & shaped & road.isin(*MAJOR, *ARTERIAL), F.when(F.size(line) >= 2, entry(F.when(road.isin(*MAJOR), "major").otherwise("arterial"), "line", line)))
    ring = F.concat(line, F.slice(line, 1, 1))
    parks = F.when(green & (F.size(line) >= 4), entry(F.lit("park"), "polygon", ring))
    is_road = F.coalesce(way & shaped & road.isin(*MAJOR, *ARTERIAL), F.lit(False))
    rest = ~is_road & ~F.coalesce(green, F.lit(False)) & ~F.coalesce(front, F.lit(False)) & place.isNotNull() & at.isNotNull()
    dots = F.when(rest, entry(place, "point", _points(F.array(at))))
    fronts = F.when(front & (F.size(line) >= 2), entry(F.lit("malecon"), "line", line))
    plain = elements.where(~F.coalesce((c("element.type") == "relation") & (_tag("boundary") == "administrative"), F.lit(False)))
    return plain.select("seq", name.alias("name"), F.explode(F.array_compact(F.array(fronts, ways, parks, dots))).alias("e")).select("e.layer", "name", "seq", "e.kind", "e.points")


def boundary_ways(elements: DataFrame) -> DataFrame:
    """(boundary, way, points) of the outer members of administrative relations."""
    relation = elements.where((c("element.type") == "relation") & (_tag("boundary") == "administrative"))
    members = relation.select("seq", F.posexplode("element.members").alias("way", "m")).where((c("m.type") == "way") & c("m.role").isin("outer", ""))
    return members.select(c("seq").alias("boundary"), "way", _points(c("m.geometry")).alias("points"))


def outline(elements: DataFrame) -> list[tuple[float, float]]:
    """The largest ring of the last boundary, which alone comes to the driver: a few hundred points."""
    ways = boundary_ways(elements)
    last = ways.agg(F.max("boundary")).first()[0]
    ring = rings.outlines(ways.where(c("boundary") == last)).first() if last is not None else None
    return [(p["x"], p["y"]) for p in ring["points"]] if ring else []
