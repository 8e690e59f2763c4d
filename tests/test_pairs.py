"""Pairs of records that may be duplicates, against comparing every pair."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from millrace.config import Config
from millrace.functions import fuzzy
from millrace.operators import dedupe
from millrace.schema import conform

CFG = Config()
NAMES = "miraflores vista parque balcon moderno luminoso amplio cochera piscina terraza kennedy larco berlin malecon estreno duplex flat loft acogedor remodelado".split()


def flats(n, seed):
    """Records that repeat each other in some pieces of evidence and lack or change others."""
    r = random.Random(seed)
    text = lambda k: " ".join(r.choice(NAMES) + str(r.randint(0, 3) or "") for _ in range(k))
    made = []
    for k in range(n):
        old = dict(r.choice(made)) if made and r.random() < 0.75 else {}
        row = {
            "row_id": k, "source": r.choice(["urbania", "adondevivir", "mercadolibre"]), "source_listing_id": r.choice([None, str(k), str(k % 7)]), "source_url": r.choice([None, f"https://a.pe/{k}", f"https://www.a.pe/{k % 50}/"]),
            "bedrooms": r.choice([None, 1, 1, 2]), "latitude": r.choice([None, -12.12 + r.random() / 50]), "longitude": r.choice([-77.03 + r.random() / 50]), "built_area_m2": r.choice([None, 0.0, 40.0 + r.random() * 50]), "total_area_m2": r.choice([None, 45.0 + r.random() * 50]),
            "rent_usd": r.choice([None, 0.0, 700 + r.random() * 600]), "phone": r.choice([None, "", f"9{r.randint(0, 9)}"]), "title": r.choice([None, "departamento " + text(3)]), "description": r.choice([None, text(9), text(25)]),
            "address": r.choice([None, f"Calle {r.choice(NAMES)} {r.randint(100, 130)}", f"Av. {r.choice(NAMES)} {r.randint(100, 130)}, Miraflores"]), "image_keys": [f"i{r.randint(0, 90)}" for _ in range(r.randint(0, 2))], "floor": r.choice([None, 1, 2, 3]),
        }
        for field in old:
            if field not in ("row_id", "source") and r.random() < 0.7:
                row[field] = old[field]
        if row["latitude"] is not None and old and r.random() < 0.5:
            row["latitude"] += r.choice([0, 0.0003, 0.0008])
        if row["rent_usd"] and r.random() < 0.3:
            row["rent_usd"] *= r.choice([1.04, 1.06, 0.9])
        if r.random() < 0.4:  # nothing to anchor a merge
            row |= {"image_keys": [], "latitude": None, "address": None}
        made.append(row)
    return made


SCHEMA = "row_id long, source string, source_listing_id string, source_url string, bedrooms int, latitude double, longitude double, built_area_m2 double, total_area_m2 double, rent_usd double, phone string, title string, description string, address string, image_keys array<string>, floor int"


def table(spark, rows):
    return conform(spark.createDataFrame([tuple(x[k.split()[0]] for k in SCHEMA.split(", ")) for x in rows], SCHEMA))


def told(pairs, ready):
    rows = dedupe.scored(pairs, ready, CFG).where(F.col("score") >= CFG.match_threshold - 0.15).collect()
    return {(x["a"], x["b"]): (x["score"], x["anchored"], tuple(x["why"])) for x in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_possible_pairs_are_those_of_all_pairs(spark, seed):
    ready = dedupe.prepared(table(spark, flats(260, seed))).cache()
    every = ready.alias("l").join(ready.alias("r"), F.col("l.row_id") < F.col("r.row_id")).select(F.col("l.row_id").alias("a"), F.col("r.row_id").alias("b"))
    wanted = told(every, ready)
    found = dedupe.candidates(ready, CFG)
    assert len(wanted) > 300 and sum(not x[1] for x in wanted.values()) > 20
    assert told(found, ready) == wanted
    assert found.count() < every.count() / 3


def test_blocks_cover_every_sufficient_set_of_evidence():
    gain = {"near": 0.30, "cell": 0.10, "area": 0.20, "price": 0.15, "phone": 0.25, "title": 0.10, "text": 0.30, "number": 0.20, "photo": 0.40, "floor": 0.05}
    for n in range(1, len(gain) + 1):
        for some in itertools.combinations(gain, n):
            if {"near", "cell"} <= set(some) or sum(gain[k] for k in some) < 0.45 - 1e-9:
                continue
            there = set(some) | ({"cell"} if "near" in some else set())
            assert any(set(block) <= there for block in dedupe.BLOCKS), some


@pytest.mark.parametrize("common", [{"title": "departamento en alquiler", "phone": "999"}, {"image_keys": ["logo"]}, {"title": "departamento en alquiler", "address": "Av. Larco 100"}])
def test_common_pieces_alone_make_no_block(spark, common):
    none = dict.fromkeys(("title", "phone", "address", "source_url", "source_listing_id", "description", "latitude", "floor", "total_area_m2")) | {"image_keys": []}
    rows = [{**x, **none, **common, "row_id": k, "built_area_m2": 20.0 * 1.2 ** (k % 40), "rent_usd": 100 * 1.2 ** (k // 40 % 30)} for k, x in enumerate(flats(1, 3) * 1200)]
    ready = dedupe.prepared(table(spark, rows))
    assert dedupe.keys(ready, CFG).groupBy("key").count().agg(F.max("count")).first()[0] <= 80
    assert dedupe.candidates(ready, CFG).count() <= 1200 * 80


def test_ratios_run_only_where_they_can_decide(spark):
    ready = dedupe.prepared(table(spark, flats(120, 4))).cache()
    every = ready.alias("l").join(ready.alias("r"), F.col("l.row_id") < F.col("r.row_id")).select(F.col("l.row_id").alias("a"), F.col("r.row_id").alias("b"))
    plan = dedupe.open_pairs(every, ready, CFG)
    assert plan.where("open").count() < 0.25 * every.count()


def test_token_set_by_hand():
    assert fuzzy.token_set("a b", "a b c d") == 100.0 and fuzzy.token_set("", "a") == 0.0


def test_records_are_dealt_to_all_cores_and_prepared_once(spark, monkeypatch):
    from millrace.plans import pipeline, registry

    class Seen(Exception):
        pass

    def seen(df, *_):
        raise Seen(df)

    def caught(name):
        try:
            registry.QUERIES[name](spark, "/root/testdata/sf0.001")
        except Seen as s:
            return s.args[0]

    with monkeypatch.context() as m:
        m.setattr(pipeline, "process", seen)
        assert f"Repartition {spark.sparkContext.defaultParallelism}, true" in caught("listing_pipeline")._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(dedupe, "candidates", seen)
    for name in ("pair_dedupe_fuzzy", "entity_groups"):
        assert caught(name)._jdf.queryExecution().analyzed().toString().startswith("LogicalRDD")


def test_like_records_are_decided_at_once(spark, monkeypatch):
    flat = {**flats(1, 3)[0], **dict.fromkeys(("title", "description", "phone", "address", "floor", "built_area_m2")), "image_keys": [], "bedrooms": 1, "longitude": -77.03, "total_area_m2": 60.0}
    rows = [{**flat, "row_id": 30 * k + n, "latitude": -12.12 + k / 100, "rent_usd": 700.0 + 100 * k, "title": f"t{n}", "source_listing_id": str(1000 * k + n), "source_url": f"https://a.pe/{k}/{n}"} for k in range(3) for n in range(30)]
    met, whole = [], dedupe.scored
    monkeypatch.setattr(dedupe, "scored", lambda pairs, *rest: (met.append(pairs.count()), whole(pairs, *rest))[1])
    for evidence in (False, True):
        out = dedupe.deduplicate(table(spark, rows), CFG, evidence)
        assert {(r["row_id"] // 30, r["duplicate_group_id"]) for r in out.collect()} == {(k, f"G{k + 1:04}") for k in range(3)}
        assert ("dedupe_evidence" in out.columns) == evidence
    # A place, an area and a price merge copies whatever their titles say; pairs are told apart only to be named.
    assert met == [0, 3 * 30 * 29 // 2]


def test_what_one_record_holds_alone_is_no_evidence_and_null_text_is_none(spark):
    none = dict.fromkeys(("title", "phone", "address", "latitude", "floor", "description")) | {"image_keys": ["x", "y"]}
    rows = [{**flats(1, 3)[0], **none, "row_id": k, "source_listing_id": str(k // 2), "source": "urbania", "source_url": f"https://a.pe/{k}", "phone": f"9{k}"} for k in range(3)]
    ready = dedupe.without_lone(dedupe.prepared(table(spark, rows)), CFG)
    assert {(r["row_id"], r["source_listing_id"], r["url"], r["phone"], tuple(r["image_keys"])) for r in ready.collect()} == {(0, "0", None, None, ("x", "y")), (1, "0", None, None, ("x", "y")), (2, None, None, None, ("x", "y"))}
    assert not ready.where("long OR titled OR no_url").count()


def test_listing_pipeline_makes_no_column_of_pairs_that_it_does_not_read(spark, monkeypatch):
    from millrace.plans import pipeline, registry

    class Seen(Exception):
        pass

    def seen(*given):
        raise Seen(given)

    monkeypatch.setattr(pipeline, "cut", lambda df: df)
    monkeypatch.setattr(pipeline, "deduplicate", seen)
    with pytest.raises(Seen) as told:
        registry.QUERIES["listing_pipeline"](spark, "/root/testdata/sf0.001")
    assert told.value.args[0][2:] == (False,)
