import json

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.config import Config, dotenv
from millrace.functions import geo, money
from millrace.operators import dedupe, enrich, qa, ranking, scoring
from millrace.operators.components import components
from millrace.operators.normalize import normalize
from millrace.plans import registry, report, views, workbook
from millrace.plans.pipeline import process
from millrace.schema import KINDS, conform
from millrace.sources import files, html_cards, places, portals, records, requests

CFG = Config()
BASE = {"source": "urbania", "source_listing_id": "1", "source_url": "https://a.pe/1", "bedrooms": 1, "rent_usd": 900.0, "total_area_m2": 60.0, "built_area_m2": 58.0, "latitude": -12.12, "longitude": -77.03, "title": "Flat frente al parque", "description": "x" * 90, "address": "Calle Berlin 350", "image_keys": ["abc"]}


def listings(spark, *rows):
    full = [{**{k: None for k in KINDS}, "image_keys": [], "amenities": [], "text_signals": [], **r} for r in rows]
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("row_id", T.LongType()), *[T.StructField(k, v) for k, v in KINDS.items()]])
    return spark.createDataFrame([tuple([n, *[r[k] for k in KINDS]]) for n, r in enumerate(full)], schema)


def test_copies_merge_and_nothing_is_deleted(spark):
    rows = listings(spark, BASE, {**BASE, "source": "mercadolibre", "source_listing_id": "9", "source_url": "https://b.pe/9", "rent_usd": 920.0, "phone": "+51987654321"}, {**BASE, "source": "manual", "source_listing_id": "7", "source_url": "https://c.pe/7", "bedrooms": 2, "image_keys": [], "latitude": -12.10, "address": "Calle Otra 99"})
    out = {r["row_id"]: r for r in dedupe.deduplicate(rows, CFG).collect()}
    assert len(out) == 3
    assert out[0]["duplicate_group_id"] == out[1]["duplicate_group_id"] == "G0001" and out[2]["duplicate_group_id"] == "G0002"
    canon = next(r for r in out.values() if r["is_canonical"] and r["number_of_records"] == 2)
    assert canon["duplicate_sources"] == "mercadolibre; urbania" and canon["phone"] == "+51987654321"


def test_blocking_finds_the_merges_of_all_pairs(spark):
    rows = listings(spark, *[{**BASE, "source_listing_id": str(k), "source_url": f"https://a.pe/{k}", "latitude": -12.12 + (k % 7) * 0.0002, "longitude": -77.03 + (k % 5) * 0.0003, "rent_usd": 800.0 + 10 * (k % 4), "image_keys": [f"p{k % 6}"], "address": f"Calle Berlin {100 + k % 3}"} for k in range(40)])
    ready = dedupe.prepared(rows)
    every = ready.alias("l").join(ready.alias("r"), F.col("l.row_id") < F.col("r.row_id")).select(F.col("l.row_id").alias("a"), F.col("r.row_id").alias("b"))
    merges = lambda pairs: {(r["a"], r["b"]) for r in dedupe.scored(pairs, ready, CFG).where("score >= 0.6 and anchored").collect()}
    assert merges(dedupe.candidates(ready, CFG)) == merges(every)


def test_similar_words_alone_never_merge(spark):
    far = {**BASE, "source": "mercadolibre", "source_listing_id": "9", "source_url": "https://b.pe/9", "latitude": None, "longitude": None, "image_keys": [], "address": None, "phone": "1"}
    out = dedupe.deduplicate(listings(spark, {**BASE, "latitude": None, "longitude": None, "address": None, "image_keys": [], "phone": "1"}, far), CFG).collect()
    assert {r["number_of_records"] for r in out} == {1} and {r["possible_duplicate_of"] for r in out} == {"G0001", "G0002"}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(12)] + [(20, 21)], "a long, b long")
    assert {r["id"]: r["root"] for r in components(edges).collect()} == {**{k: 0 for k in range(13)}, 20: 20, 21: 20}


def test_value_bands_average_ties(spark):
    rows = spark.createDataFrame([(1, 1, 6.0), (2, 1, 12.0), (3, 1, 12.0), (4, 1, 20.0), (5, 1, 30.0), (6, 2, 1.0)], "i int, g int, v double")
    out = {r["i"]: (r["value_band"], r["value_percentile"]) for r in ranking.value_bands(rows, "g", "v", F.lit(True), 5).collect()}
    assert out[1] == ("EXCELLENT_VALUE", 20.0) and out[2] == out[3] == ("GOOD_VALUE", 50.0) and out[5] == ("EXPENSIVE_RELATIVE_TO_SAMPLE", 100.0) and out[6] == ("INSUFFICIENT_SAMPLE", None)


def test_numbered_over_groups(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    out = ranking.numbered(rows, [F.col("g")], [F.col("id").desc()], "n").collect()
    assert all(r["n"] == (999 - r["id"]) // 3 + (1 if r["g"] == 0 else 1) for r in out)


def test_money_keeps_what_is_published(spark):
    rows = conform(spark.createDataFrame([("s", 1000.0, "USD", 3300.0, "PUBLISHED", 200.0, "PEN")], "source string, rent_original double, rent_currency string, rent_pen double, rent_pen_basis string, maintenance_fee double, maintenance_currency string"))
    r = money.with_currencies(rows, 3.4).first()
    assert (r["rent_pen"], r["rent_pen_basis"], r["rent_usd"], r["rent_usd_basis"]) == (3300.0, "PUBLISHED", 1000.0, "PUBLISHED")
    assert (r["maintenance_usd"], r["maintenance_usd_basis"], r["estimated_total_monthly_usd"], r["estimated_total_monthly_pen"]) == (58.82, "CALCULATED", 1058.82, 3500.0)


def test_normalize_prefers_structured_values(spark):
    rows = listings(spark, {"source": "manual", "furnished": True, "title": "Depa 2 dormitorios en Miraflores", "description": "sin amoblar, contrato minimo 1 año, mantenimiento S/ 300", "rent_original": 900.0, "rent_currency": "USD", "phone": "987654321"})
    r = normalize(rows, CFG, 3.4).first()
    assert r["furnished"] is True and r["bedrooms"] == 2 and r["minimum_contract_months"] == 12 and r["maintenance_fee"] == 300.0 and r["maintenance_currency"] == "PEN" and r["district"] == "Miraflores" and r["phone"] == "+51987654321"


def test_gates(spark):
    ok = {"source": "manual", "bedrooms": 1, "rent_usd": 950.0, "district": "Miraflores", "property_type": "Flat", "operation": "Alquiler"}
    cases = {"PRIMARY": {}, "STRETCH": {"rent_usd": 1050.0}, "EXCLUDED": {"bedrooms": 3}}
    for category, change in cases.items():
        rows = listings(spark, {**ok, **change}).withColumns({"inside_district_polygon": F.lit(True), "dist_outside_district_m": F.lit(0)})
        assert rows.select(scoring.gates(CFG)["category"].alias("v")).first()["v"] == category
    near = listings(spark, {**ok, "coord_precision": "EXACT"}).withColumns({"inside_district_polygon": F.lit(False), "dist_outside_district_m": F.lit(120)})
    assert near.select(scoring.gates(CFG)["category"].alias("v")).first()["v"] == "NEAR_MISS_CANDIDATE"


def test_geometry(spark):
    square = [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (0.0, 100.0), (0.0, 0.0)]
    rows = spark.createDataFrame([(50.0, 50.0), (110.0, 50.0), (150.0, 50.0)], "x double, y double")
    inside, beyond = enrich.outline(F.col("x"), F.col("y"), square, 15)
    assert [tuple(r) for r in rows.select(inside, beyond).collect()] == [(True, 0), (True, 0), (False, 50)]


@pytest.mark.parametrize("scale", [1, 40])
def test_nearest_is_that_of_all_pairs(spark, scale):
    """Points, lines and polygons, near and far, with ties, against every pair in plain Python."""
    import math

    points = [(k, float(k * 137 % 4000) * scale, float(k * 71 % 3000) * scale) for k in range(60)] + [(60, -9e4, 8e4)]
    shapes = []
    for k in range(30):
        x, y = float(k * 997 % 4000), float(k * 613 % 3000)
        outline = [[(x, y)], [(x, y), (x + 300, y + 50), (x + 350, y - 400)], [(x, y), (x + 200, y), (x + 200, y + 200), (x, y + 200), (x, y)]][k % 3]
        shapes += [("cafe" if k % 2 else "park", f"n{k}", k, ("point", "line", "polygon")[k % 3], outline)]
    shapes.append(("park", "tie", 99, *shapes[0][3:]))

    def segment(x, y, a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = 0 if dx == dy == 0 else min(1, max(0, ((x - a[0]) * dx + (y - a[1]) * dy) / (dx * dx + dy * dy)))
        return math.hypot(x - a[0] - t * dx, y - a[1] - t * dy)

    def distance(x, y, kind, ring):
        if kind == "polygon" and min(p[0] for p in ring) < x < max(p[0] for p in ring) and min(p[1] for p in ring) < y < max(p[1] for p in ring):
            return 0.0
        return min(segment(x, y, a, b) for a, b in zip(ring, ring[1:] or ring, strict=False))

    wanted = {(i, layer): min((round(distance(x, y, s[3], s[4]), 6), s[2]) for s in shapes if s[0] == layer) for i, x, y in points for layer in ("cafe", "park")}
    names = {s[2]: s[1] for s in shapes}
    table = spark.createDataFrame(shapes, "layer string, name string, seq int, kind string, points array<struct<x:double,y:double>>")
    out = {(r["row_id"], r["layer"]): (round(r["distance"], 6), r["name"]) for r in enrich.nearest(spark.createDataFrame(points, "row_id long, x double, y double"), table).collect()}
    assert out == {k: (m, names[s]) for k, (m, s) in wanted.items()}


def test_places(spark, tmp_path):
    way = lambda **tags: {"type": "way", "tags": tags, "geometry": [{"lat": -12.12, "lon": -77.03}, {"lat": -12.121, "lon": -77.031}]}
    elements = [way(highway="primary", name="Av. A"), way(highway="secondary", name="Malecón B"), {"type": "node", "lat": -12.12, "lon": -77.03, "tags": {"amenity": "bar", "name": "Bar"}}]
    (tmp_path / "map.json").write_text(json.dumps({"elements": elements}))
    out = {(r["layer"], r["name"]) for r in places.layers(places.read_elements(spark, str(tmp_path / "map.json"))).collect()}
    assert out == {("major", "Av. A"), ("arterial", "Malecón B"), ("malecon", "Malecón B"), ("bar", "Bar")}


def test_record_shapes(spark):
    nested = {"postingId": 55, "url": "/x-1.html", "title": "T", "priceOperationTypes": [{"operationType": {"name": "Alquiler"}, "prices": [{"amount": 950, "currency": "USD"}, {"amount": 3200, "currency": "S/"}]}], "mainFeatures": {"a": {"label": "Dormitorios", "value": "2"}, "b": {"label": "Baños", "value": "1"}}, "status": "FINALIZADO", "publishedText": "Publicado hace 3 días"}
    flat = {"id": "7", "url": "https://p.pe/7", "price": "USD 950", "expenses": "S/ 320", "bedrooms": 1, "coveredArea": "72 m²", "latitude": -12.123, "longitude": -77.03}
    rows = spark.createDataFrame([(json.dumps(nested),), (json.dumps(flat),), ("not json",), (None,)], "json string")
    a, b, bad, none = records.map_record(rows, "json", F.lit("urbania"), F.lit("2024-06-01T10:00:00"), "https://p.pe").collect()
    assert (a["source_listing_id"], a["source_url"], a["rent_original"], a["rent_usd"], a["rent_pen"], a["bedrooms"], a["bathrooms"], a["active_status"], a["operation"], a["publication_date"]) == ("55", "https://p.pe/x-1.html", 950.0, 950.0, 3200.0, 2, 1.0, "INACTIVE", "Alquiler", "2024-05-29")
    assert (b["rent_original"], b["rent_currency"], b["maintenance_fee"], b["maintenance_currency"], b["built_area_m2"], b["coord_precision"], b["latitude"]) == (950.0, "USD", 320.0, "PEN", 72.0, "UNSPECIFIED", -12.123)
    assert bad["source_listing_id"] is None and none["rent_original"] is None


def test_html_cards():
    card = '<div data-qa="posting PROPERTY" data-id="9" data-to-posting="/a.html"><div data-qa="POSTING_CARD_PRICE">S/ 3,200</div><h3 data-qa="POSTING_CARD_FEATURES"><span>60 m²</span><span>2 dorm.</span></h3></div>'
    (found,) = html_cards.portal_cards(card)
    assert (found["id"], found["price"], found["features"]) == ("9", "S/ 3,200", ["60 m²", "2 dorm."])
    page = '<tr class="andes-table__row"><th>Dormitorios</th><td>2</td></tr><script>{"latitude": -12.1, "longitude": -77.0}</script><p>Publicado hace 5 días</p>'
    detail = html_cards.detail_page(page)
    assert detail["specs"] == {"Dormitorios": "2"} and detail["latitude"] == -12.1 and detail["published_text"].startswith("Publicado hace 5")


def test_market_cards_and_details():
    card = '<li class="ui-search-layout__item"><h2><a href="https://m.pe/MPE-12345678-x#y">Flat</a></h2><s class="andes-money-amount"><b class="andes-money-amount__fraction">9</b></s><div class="poly-price__current"><span class="andes-money-amount"><b class="andes-money-amount__currency-symbol">S/</b><b class="andes-money-amount__fraction">3,200</b></span></div><i class="poly-attributes_list__item">60 m²</i><i class="poly-component__location">Miraflores</i></li>'
    (found,) = html_cards.market_cards(card + '<li class="ui-search-layout__item"><p>no link</p></li>')
    assert found == {"id": "MPE12345678", "url": "https://m.pe/MPE-12345678-x", "title": "Flat", "price": "S/ 3,200", "features": ["60 m²"], "district": "Miraflores", "address": "Miraflores"}
    page = '<div class="ui-vpp-highlighted-specs__key-value">Piso : 4</div><tr class="ui-vpp-striped-specs__row"><th>Piso</th><td>5</td></tr><figure class="ui-pdp-gallery__figure"><img src="s" data-zoom="z"></figure><script type="application/ld+json">{bad</script><img src="staticmap?center=-12.1%2C-77.0"><p>Publicación pausada</p>'
    detail = html_cards.detail_page(page)
    assert detail["specs"] == {"Piso": "5"} and (detail["latitude"], detail["longitude"], detail["image_count"], detail["main_image"], detail["inactive"], detail["linked_data"], detail["seller"]) == (-12.1, -77.0, 1, "z", True, None, None)


def test_collector_input():
    out, remarks = requests.collector_input({"maxPrice": {"type": "integer"}, "startUrls": {"type": "array"}, "maxItems": {}}, {"max_price": 1150.0, "start_urls": ["https://a"], "currency": "USD"}, 40)
    assert out == {"maxPrice": 1150, "startUrls": [{"url": "https://a"}], "maxItems": 40} and len(remarks) == 1
    schema = {"Operation": {"enum": ["1", "2"], "enumTitles": ["Venta", "Alquiler"]}, "propertyType": {"type": "array", "items": {"enum": ["house"]}}, "url": {"type": "string"}, "location": {"type": "array"}, "token": {"required": True}, "limit": {"type": "integer"}, "details": {"type": "boolean"}}
    out, remarks = requests.collector_input(schema, {"operation": "rent", "property_type": "flat", "start_urls": ["a", "b"], "location": "x", "with_details": 1, "min_bedrooms": None, "raw_input": {}}, 9)
    assert out == {"Operation": "2", "url": "a", "location": ["x"], "limit": 9, "details": True} and len(remarks) == 3
    assert requests.collector_input(None, {"raw_input": {"q": 1}}, 5) == ({"q": 1, "maxItems": 5}, ["no schema: raw input sent as it is"])
    assert requests.pages(600) == [(0, 250), (250, 250), (500, 100)]


def test_page_requests(spark):
    totals = spark.createDataFrame([("a", 600), ("b", 250), ("c", 0), ("d", None)], "source string, total int")
    assert sorted(map(tuple, requests.page_requests(totals).collect())) == [("a", 0, 250), ("a", 250, 250), ("a", 500, 100), ("b", 0, 250)]


def test_portal_runs(spark):
    card = lambda k, price: f'<li class="ui-search-layout__item"><h2><a href="https://m.pe/MPE-{k}-x">Flat</a></h2><span class="andes-money-amount"><b class="andes-money-amount__currency-symbol">{price[0]}</b><b class="andes-money-amount__fraction">{price[1]}</b></span></li>'
    pages = spark.createDataFrame([("s", 1, 200, "".join(card(10000000 + k, ("US$", "900" if k else "5,000")) for k in range(48))), ("s", 2, 200, card(20000000, ("S/", "3,000"))), ("s", 3, 200, card(30000000, ("S/", "1")))], "url string, page int, status int, html string")
    detail = '<tr class="andes-table__row"><th>Dormitorios</th><td>2</td></tr>'
    details = spark.createDataFrame([(f"https://m.pe/MPE-{k}-x", status, detail) for k, status in ((10000000, 200), (10000001, 200), (10000002, 404), (10000003, 200), (20000000, 500))], "url string, status int, html string")
    run = portals.market("mercadolibre", pages, details, "2024-06-01", 1150, 3.4, max_details=1)
    rows = {r["source_listing_id"]: r for r in run.listings.collect()}
    assert len(rows) == 49 and "MPE30000000" not in rows  # a page that isn't full is the last one
    assert [rows[f"MPE{k}"]["bedrooms"] for k in (10000000, 10000001, 10000003, 20000000)] == [None, 2, None, None] and rows["MPE10000002"]["active_status"] == "INACTIVE"
    assert run.statement.select("records", "errors", "status").first() == (49, 0, "SUCCESS")
    assert run.statement.first()["notes"] == ["1 detail pages left out by the limit of 1"]
    few = portals.market("mercadolibre", pages, None, "2024-06-01", 1150, 3.4, max_items=40).statement.first()
    assert (few["records"], few["status"], few["notes"]) == (40, "PARTIAL", ["9 cards left out by the limit of 40"])
    failed = portals.portal("urbania", pages.withColumn("status", F.lit(403)), "2024-06-01").statement.first()
    assert (failed["records"], failed["errors"], failed["status"], failed["notes"]) == (0, 1, "FAILED", ["s page 1: status 403"])
    none = portals.portal("urbania", pages.limit(0), "2024-06-01").statement.first()
    assert (none["records"], none["status"]) == (0, "FAILED")
    audit = report.source_audit(run.listings, run.statement)
    assert audit.first()["status"] == "PARTIAL" and "# Source audit" in report.audit_markdown(audit, "2024-06-01")
    items = spark.createDataFrame([('{"id": "7", "price": "USD 950"}',)], "json string")
    assert portals.collected("urbania", items, "2024-06-01", succeeded=False).statement.first()["status"] == "PARTIAL"
    assert files.collect("urbania", pages.limit(0), "2024-06-01").listings.count() == 0


def test_map_cache_is_fresh(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"_fetched_at": "2024-05-01T00:00:00+00:00", "elements": [{"type": "node", "id": 1}]}))
    read = lambda *at: places.read_elements(spark, str(tmp_path / "m.json"), *at).count()
    assert (read(), read("2024-05-31T12:00:00+00:00"), read("2024-06-01T12:00:00+00:00")) == (1, 1, 0)


def test_places_to_look_up(spark):
    rows = spark.createDataFrame([(1, "b", None, None), (2, "a", None, None), (3, "b", None, None), (4, "known", None, None), (5, "c", -12.1, -77.0), (6, None, None, None)], "row_id long, address string, latitude double, longitude double")
    cache = spark.createDataFrame([("known",)], "query string")
    assert [r[0] for r in enrich.to_geocode(rows, cache, F.col("address"), 5).collect()] == ["b", "a"] and enrich.to_geocode(rows, cache, F.col("address"), 1).count() == 1


def test_workbook(spark, tmp_path):
    import zipfile
    from xml.etree import ElementTree

    rows = spark.createDataFrame([(1, "a & <b>", None, True), (2, "\x0bé", 1.5, False)], "n int, said string, x double, yes boolean")
    assert workbook.write(str(tmp_path / "w.xlsx"), {"stretch": rows, "client_top_picks": rows.limit(0)}) == ["CLIENT_TOP_PICKS", "STRETCH"]
    with zipfile.ZipFile(tmp_path / "w.xlsx") as book:
        parts = {name: ElementTree.fromstring(book.read(name)) for name in book.namelist()}
    space = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    found = [["".join(cell.itertext()) for cell in row] for row in parts["xl/worksheets/sheet2.xml"].iterfind(".//m:row", space)]
    assert found == [["n", "said", "x", "yes"], ["1", "a & <b>", "", "1"], ["2", "é", "1.5", "0"]]
    with pytest.raises(ValueError, match="characters"):
        workbook.write(str(tmp_path / "long.xlsx"), {"stretch": spark.createDataFrame([("x" * 40000,)], "said string")})


def test_manual_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("source_url,rent_original,furnished,amenities,latitude\nhttps://x,950,si,gym; pool,-12.1\n,abc,,,\n")
    (tmp_path / "b.json").write_text(json.dumps([{"source_url": "https://y", "bedrooms": 2}]))
    rows = sorted(files.read_manual(spark, str(tmp_path), "2024-06-01").collect(), key=lambda r: r["source_url"] or "")
    assert [r["source"] for r in rows] == ["manual"] * 3
    assert rows[0]["rent_original"] is None and (rows[1]["furnished"], rows[1]["amenities"], rows[1]["coord_precision"]) == (True, ["gym", "pool"], "UNSPECIFIED") and rows[2]["bedrooms"] == 2


def test_sinks(spark, tmp_path):
    rows = listings(spark, BASE)
    files.write_csv(rows, str(tmp_path / "csv"))
    files.write_ranked(rows, str(tmp_path / "ranked"))
    files.log(spark, str(tmp_path / "log"), "r1", ["a"])
    files.log(spark, str(tmp_path / "log"), "r2", ["b"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1 and spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_whole_pipeline_and_views(spark):
    rows = listings(spark, *[{**BASE, "source_listing_id": str(k), "source_url": f"https://a.pe/{k}", "latitude": -12.13 + k * 0.002, "image_keys": [], "address": f"Calle Berlin {300 + k}", "rent_original": 800.0 + k, "rent_currency": "USD", "rent_usd": None, "district": "Miraflores"} for k in range(6)])
    shapes = spark.createDataFrame([("major", "Av. A", 1, "line", [(0.0, 0.0), (100.0, 0.0)]), ("park", "P", 2, "point", [(0.0, 50.0)])], "layer string, name string, seq int, kind string, points array<struct<x:double,y:double>>")
    ranked = process(rows, shapes, [], CFG, 3.4, "2024-06-01").cache()
    assert sorted(r["rank_in_category"] for r in ranked.where("category = 'PRIMARY'").collect()) == [1, 2, 3, 4, 5, 6]
    shown = views.views(ranked, CFG)
    assert len(shown["client_top_picks"].columns) == 14 and len(shown["executive_shortlist"].columns) == 27 and shown["client_top_picks"].count() == 6
    page = report.html_report(shown, "R", ranked=ranked)
    assert page.count("<circle") == 12 and page.count("<section>") == 5 and "<td>listings</td><td>6</td>" in page
    assert {r["rule"]: r["bad"] for r in qa.final_checks(ranked, CFG).collect()}["bedrooms"] == 0


def test_settings():
    assert dotenv("A=1\n# x\nB = 'two'\n") == {"A": "1", "B": "two"}


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAST = ["value_bands", "rank_in_category", "gates", "noise_score", "fit_components", "red_flags", "geo_nearest", "duplicate_exact_groups", "money_normalise", "signal_flags", "listing_scores", "ranked_listings", "qa_worklist", "final_checks", "topk_quiet_space", "market_snapshot", "record_mapping", "geocode_fill", "map_layers", "geo_lines_polygons", "portal_pages", "portal_run"]


@pytest.mark.parametrize("name", FAST)
def test_against_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    ours, theirs = registry.QUERIES[name](spark, folder), con.sql(registry.SQL[name])
    names = ours.columns
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    rows = lambda found: sorted(str(tuple(map(plain, r))) for r in found)
    assert rows(map(tuple, ours.collect())) == rows(con.sql(f"SELECT {', '.join(names)} FROM ({registry.SQL[name]})").fetchall()) and theirs is not None
