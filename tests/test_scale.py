"""Operators whose groups may hold most of the rows: against plain Python, and by how rows are dealt to tasks."""

import math
import random

from pyspark.sql import functions as F

from millrace.operators import enrich, extent, selection
from millrace.operators.components import components
from millrace.operators.spread import spread


def roots(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


def found(spark, pairs):
    return {r["id"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}


def test_components_equal_union_find(spark):
    r = random.Random(4)
    pairs = [(r.randint(0, 400), r.randint(0, 400)) for _ in range(260)] + [(900, 900), (901, 900)] * 2
    assert found(spark, pairs) == roots(pairs)
    assert components(spark.createDataFrame([(1, None), (None, None)], "a long, b long")).count() == 0
    assert found(spark, []) == {}


def test_components_of_a_hub_and_a_chain(spark):
    star = [(77_777, k) for k in range(20_000)]
    order = list(range(100_000, 103_000))
    random.Random(5).shuffle(order)
    chain = list(zip(order, order[1:], strict=False))
    out = found(spark, star + chain)
    assert out == {**{k: 0 for k in range(20_000)}, 77_777: 0} | {k: 100_000 for k in order}


def test_hot_keys_are_dealt_to_many_tasks(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") < 30_000, 1).otherwise(F.col("id")).alias("k"), "id")
    classes = rows.groupBy("k").agg(F.count("*").alias("n"))
    sizes = [r["count"] for r in spread(rows, classes, ["k"], ["id"]).where("k = 1").groupBy(F.pmod(F.xxhash64(F.lit("salt"), "id"), F.lit(30))).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 1_500


def test_medians_and_modes_of_a_hot_group(spark):
    import statistics

    r = random.Random(6)
    rows = [("hot", r.gauss(0, 1000), r.choice([1, 1, 2, 3])) for _ in range(6001)] + [("ties", float(r.choice([5] * 30 + list(range(90)))), 2) for _ in range(2000)]
    rows += [(None, float(k), None) for k in range(10)] + [("one", -7.5, 4), ("none", None, None)]
    df = spark.createDataFrame(rows, "g string, v double, m int")
    for pivots, few in ((8, 20), (64, 1000)):
        out = {x["g"]: (x["v"], x["m"]) for x in selection.medians(df, ["g"], ["v", "m"], pivots, few).collect()}
        for g in ("hot", "ties", None, "one"):
            values = [[x[k] for x in rows if x[0] == g and x[k] is not None] for k in (1, 2)]
            assert out[g] == tuple(statistics.median(v) if v else None for v in values)
        assert "none" not in out
    modes = {x["g"]: x["v"] for x in selection.modes(df, ["g"], ["v"]).collect()}
    assert modes["ties"] == 5.0 and modes[None] == 0.0
    assert selection.medians(df, [], ["v"], 8, 20).first()["v"] == statistics.median(x[1] for x in rows if x[1] is not None)
    assert selection.medians(df.limit(0), ["g"], ["v"]).count() == 0


def test_spread_of_ten_thousand_points(spark):
    import math

    r = random.Random(7)
    clouds = {"disk": [(-12.1 + r.gauss(0, 0.01), -77.0 + r.gauss(0, 0.02)) for _ in range(10_000)], "few": [(-12.1, -77.0), (-12.2, -77.1), (-12.1, -77.0)], "one": [(0.0, 0.0)], "globe": [(80.0, 10.0), (-80.0, 20.0), (0.0, 170.0), (5.0, -90.0), (1.0, 1.0)]}
    clouds["ring"] = [(-12 + 0.1 * math.sin(k / 300), -77 + 0.1 * math.cos(k / 300)) for k in range(1900)]
    rows = [(k, *p) for k, ps in clouds.items() for p in ps] + [("none", None, 1.0)]
    out = {x["key"]: x["spread"] for x in extent.spreads(spark.createDataFrame(rows, "key string, lat double, lon double"), "key", "lat", "lon", 500).collect()}
    import numpy as np

    assert out.keys() == clouds.keys()
    for k, ps in clouds.items():
        assert abs(out[k] - extent.greatest(*np.array(ps).T)) < 1e-6


def test_cover_of_a_line_grows_with_its_length(spark):
    shapes = [("road", "", n, "line", [(3.0, 5.0), (3.0 + 100.0 * n, 5.0 + 83.0 * n)]) for n in (1, 10, 100)]
    table = spark.createDataFrame(shapes, "layer string, name string, seq int, kind string, points array<struct<x:double,y:double>>")
    n = {r["seq"]: r["count"] for r in enrich.cover(table, 10.0).groupBy("seq").count().collect()}
    assert n[10] < 12 * n[1] and n[100] < 12 * n[10]


def test_rings_of_many_boundaries(spark):
    from millrace.operators import rings

    r = random.Random(8)
    rows, wanted = [], {}
    for b in range(30):
        n = r.randint(3, 40)
        corner = [(float(b * 100 + round(50 * math.cos(2 * math.pi * k / n), 3)), round(50 * math.sin(2 * math.pi * k / n), 3)) for k in range(n)]
        cuts = sorted(r.sample(range(n), r.randint(1, n)))
        ways = [[corner[k % n] for k in range(a, z + 1)] for a, z in zip(cuts, [*cuts[1:], cuts[0] + n], strict=True)]
        ways = [w[::-1] if r.random() < 0.5 else w for w in ways]
        ways += [[(0.0, 1e6), (1.0, 1e6 + b)], [(0.0, 2e6)], [(5.0, 3e6), (6.0, 3e6), (6.0, 3e6 + 1), (5.0, 3e6)]]
        ways += [[(float(k), 4e6 + k * k), (k + 1.0, 4e6 + (k + 1) ** 2)] for k in range(6)]
        r.shuffle(ways)
        rows += [(b, 1000 * b + k, w) for k, w in enumerate(ways)]
        wanted[b] = abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(corner, corner[1:] + corner[:1], strict=True))) / 2, set(corner)
    table = spark.createDataFrame(rows, "boundary int, way int, points array<struct<x:double,y:double>>")
    out = {x["boundary"]: x for x in rings.outlines(table).collect()}
    assert out.keys() == wanted.keys() and rings.rings(table).count() == 60
    for b, (area, corner) in wanted.items():
        ring = [(p["x"], p["y"]) for p in out[b]["points"]]
        own = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:], strict=False)) / 2
        assert abs(out[b]["area"] - area) < 1e-3 and abs(own - area) < 1e-3 and set(ring) == corner and ring[0] == ring[-1] and len(ring) == len(corner) + 1
    assert rings.outlines(table.limit(0)).count() == 0


def test_ranks_over_the_columns_that_are_read(spark):
    from millrace.operators import ranking, scoring
    from millrace.plans import registry

    scored = scoring.score(registry.complete(spark, "/root/testdata/sf0.001"), registry.CFG, registry.AS_OF)
    narrow = ranking.rank(scored, registry.CFG, ["title"])
    assert narrow.columns == [*ranking.ORDERED_BY, "title", "rank_in_category"]
    whole = ranking.rank(scored, registry.CFG).select(*narrow.columns)
    assert whole.exceptAll(narrow).count() == narrow.exceptAll(whole).count() == 0


def test_a_place_meets_one_cell_and_long_spans_stay_few(spark):
    import math

    kind = "layer string, name string, seq int, kind string, points array<struct<x:double,y:double>>"
    spots = [("a", f"s{n}", n, "point", [(37.0 * n % 1000 + 0.5, 91.0 * n % 1000 + 0.5)]) for n in range(40)]
    tall = [("a", "tall", 100, "line", [(500.0, -9000.0), (500.0, 9000.0)]), ("b", "block", 101, "polygon", [(0.0, -5000.0), (300.0, -5000.0), (300.0, 5000.0), (0.0, 5000.0), (0.0, -5000.0)])]
    covered = enrich.cover(spark.createDataFrame(spots, kind), 50.0, 1)
    assert covered.count() == 9 * len(spots) and covered.where("wide").count() == 0
    table = spark.createDataFrame(spots + tall, kind)
    assert enrich.cover(table.where("seq = 100"), 1.0).count() < 18000 / enrich.BAND + 3 * enrich.BAND
    points = [(k, 61.0 * k % 997, 83.0 * k % 991) for k in range(60)]
    placed = spark.createDataFrame(points, "row_id long, x double, y double")
    far = {k: {**{s[2]: math.hypot(x - s[4][0][0], y - s[4][0][1]) for s in spots}, 100: abs(x - 500.0)} for k, x, y in points}
    block = {k: max(0.0, x - 300.0) for k, x, _ in points}
    n = {(r["row_id"], r["layer"]): r["n"] for r in enrich.within(placed, table, 50.0).collect()}
    want = {(k, "a"): sum(d <= 50 for d in far[k].values()) for k in far} | {(k, "b"): int(block[k] <= 50) for k in block}
    assert n == {k: v for k, v in want.items() if v}
    got = {(r["row_id"], r["layer"]): round(r["distance"], 6) for r in enrich.nearest(placed, table).collect()}
    assert got == {(k, "a"): round(min(far[k].values()), 6) for k in far} | {(k, "b"): round(block[k], 6) for k in block}


def test_shared_places_are_met_once_and_shapes_that_fill_a_cell_are_counted_there(spark):
    kind = "layer string, name string, seq int, kind string, points array<struct<x:double,y:double>>"
    slope = lambda n: [(0.0, 7.0 * n), (80.0, 3.0), (-5.0, 60.0 + n), (0.0, 7.0 * n)]
    fields = [("f", f"n{n % 7}", n, "polygon", slope(n % 5)) for n in range(15)]  # each lies three times on the same ground
    split = [("r", "twice", 50, "line", [(0.0, 0.0), (30.0, 9.0)]), ("r", "twice", 50, "line", [(20.0, 20.0), (30.0, 9.0)]), ("r", "far", 51, "point", [(900.0, 900.0)])]
    table = spark.createDataFrame(fields + split, kind)
    spots = [(k, 13.0 * (k % 11) - 30.0, 17.0 * (k % 7) - 20.0) for k in range(77)]
    points = spark.createDataFrame([(100 * copy + k, x, y) for copy in range(4) for k, x, y in spots], "row_id long, x double, y double")
    places = enrich.folded(points)
    assert {(r["row_id"], r["many"]) for r in places.collect()} == {(k, 4) for k, _, _ in spots}
    shape = F.struct("x", "y")
    from millrace.functions import geo

    away = points.crossJoin(table).withColumn("m", F.round(geo.to_shape(shape["x"], shape["y"], F.col("kind"), F.col("points")), 6)).groupBy("row_id", "layer", "seq", "name").agg(F.min("m").alias("m"))
    met = away.where("m <= 30").groupBy("row_id", "layer").agg(F.count("*").cast("int").alias("n"), F.array_join(F.slice(F.array_sort(F.collect_set("name")), 1, 5), ", ").alias("names"))
    got = enrich.within(points, table, 30.0)
    assert sorted(got.collect()) == sorted(met.collect()) and got.where("n >= 15").count() > 0
    first = away.groupBy("row_id", "layer").agg(F.min(F.struct("m", "seq", "name")).alias("s")).select("row_id", "layer", "s.m", "s.name")
    assert sorted(enrich.nearest(points, table).select("row_id", "layer", F.round("distance", 6), "name").collect()) == sorted(first.collect())


def test_scored_listings_are_dealt_before_any_of_them_is_made(spark):
    from millrace.plans import registry

    plan = registry.QUERIES["listing_texts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # A filter would be pushed below a shuffle in the plan, to the few row groups of a file.
    assert "parquet" not in plan and "Repartition" not in plan


def test_listed_texts_stay_in_generated_code(spark):
    from millrace.functions import text as T

    rows = spark.createDataFrame([("a", None), (None, None), (None, ""), ("b", "b")], "x string, y string").select(T.listed(F.col("x"), F.col("y")).alias("z"))
    assert [r["z"] for r in rows.collect()] == [["a"], [], [""], ["b", "b"]]
    assert "lambda" not in rows._jdf.queryExecution().optimizedPlan().toString()
