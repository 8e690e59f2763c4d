import pytest
from pyspark.sql import functions as F

from millrace.functions import signals, text
from millrace.functions.fuzzy import common_subsequence, token_set


def value(spark, column, **inputs):
    row = spark.createDataFrame([tuple(inputs.values())], ", ".join(f"{k} string" for k in inputs))
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("said", "expected"), [("3.500", 3500.0), ("3,500", 3500.0), ("1.250,50", 1250.5), ("1,250.50", 1250.5), ("950", 950.0), ("12.5", 12.5), ("", None), ("abc", None)])
def test_amount(spark, said, expected):
    assert value(spark, text.amount(F.col("x")), x=said) == expected


@pytest.mark.parametrize(("said", "expected"), [("-12.05 grados", -12.05), ("72 m²", 72.0), ("sin", None), ("USD 1,200", 1200.0)])
def test_first_number(spark, said, expected):
    assert value(spark, text.to_float(F.col("x")), x=said) == expected


@pytest.mark.parametrize(("said", "expected"), [("Publicado hace 3 días", 3), ("hoy", 0), ("ayer", 1), ("hace 2 meses", 60), ("hace un año", 365), ("nada", None)])
def test_relative_days(spark, said, expected):
    assert value(spark, text.relative_days(F.col("x")), x=said) == expected


def test_null_in_null_out(spark):
    for f in (text.amount, text.to_float, text.relative_days, text.fold, text.norm_url, text.phone):
        assert value(spark, f(F.col("x")), x=None) is None


def test_urls_and_phones(spark):
    assert value(spark, text.norm_url(F.col("x")), x="https://www.Portal.pe/Aviso-1/?a=1#b") == "portal.pe/aviso-1"
    assert value(spark, text.phone(F.col("x")), x="987 654 321") == "+51987654321"
    assert value(spark, text.phone(F.col("x")), x="444-5566") == "+5114445566"
    assert value(spark, text.chat_link(F.col("x")), x="+51987654321") == "https://wa.me/51987654321"


@pytest.mark.parametrize(
    ("said", "feature", "expected"),
    [("Flat amoblado", "furnished", True), ("sin amoblar", "furnished", False), ("semi amoblado", "furnished", False), ("semi amoblado", "semi_furnished", True), ("no se aceptan mascotas", "pets_allowed", False), ("pet friendly", "pets_allowed", True), ("terraza común", "terrace", None), ("linda terraza", "terrace", True)],
)
def test_features(spark, said, feature, expected):
    assert value(spark, signals.signals(signals.reading_text(F.col("x")))[feature], x=said) is expected


def test_evidence_cites_first_pattern_of_the_list(spark):
    said = value(spark, signals.evidence(signals.reading_text(F.col("x"))), x="con lavadora y lavandería")
    assert len(said) == 1 and said[0].startswith("laundry: …") and "lavanderia" in said[0]


def test_lease_terms(spark):
    s = signals.signals(signals.reading_text(F.col("x")))
    assert value(spark, s["minimum_contract_months"], x="contrato mínimo un año") == 12
    assert value(spark, s["deposit_months"], x="dos meses de garantía") == 2.0
    assert value(spark, s["floor"], x="tercer piso") == 3
    assert value(spark, s["floor"], x="7º piso") is None
    assert value(spark, s["maintenance_text_amount"], x="Mantenimiento: S/ 350") == 350.0
    assert value(spark, s["maintenance_text_amount"], x="incluye mantenimiento S/ 350") is None


def test_token_set():
    assert common_subsequence("abcbdab", "bdcaba") == 4
    assert token_set("a b c", "c b a") == 100.0
    assert token_set("vista al mar", "vista al mar y terraza") == 100.0
    assert token_set("", "x") == 0.0
    assert token_set("abc", "xyz") == 0.0


def test_foreign_tenant(spark):
    kind, said = signals.foreign_tenant(F.col("t"), F.col("d"), F.lit(None).cast("boolean"), F.lit(None).cast("int"))
    assert value(spark, kind, t="Depa", d="acepta extranjeros") == "HIGH"
    assert value(spark, kind, t="Depa", d="se requiere aval") == "POTENTIAL_FRICTION"
    assert value(spark, kind, t="Depa", d="sin aval") == "MEDIUM"
    assert value(spark, kind, t=None, d=None) == "UNKNOWN"
    assert value(spark, said, t="Depa", d="acepta extranjeros; ejecutivos") == "accepts foreigners; aimed at executives"


def test_foreign_tenant_reads_its_text_once(spark):
    rows = spark.createDataFrame([("Depa", "Acepta extranjeros; ejecutivos", True, 6), ("Depa", "servicios incluidos", True, 0), ("Depa", "se requiere aval", None, None), (None, None, True, 3)], "t string, d string, f boolean, m int")
    kind, said = signals.foreign_tenant_in(F.col("text"), F.col("f"), F.col("m"))
    out = rows.withColumn("text", signals.foreign_text(F.col("t"), F.col("d"))).select(kind.alias("kind"), said.alias("said"))
    assert [tuple(r) for r in out.collect()] == [("HIGH", "accepts foreigners; aimed at executives; furnished; minimum stay 6 months"), ("MEDIUM", "utilities included; furnished"), ("POTENTIAL_FRICTION", "guarantor (aval/fiador) requested"), ("UNKNOWN", "")]
    # Each mention of the text would be a copy of all that makes it, so its patterns stand in the plan once.
    assert out._jdf.queryExecution().executedPlan().toString().count("</li>") == 1


def test_keys_are_lowered_and_nothing_else(spark):
    from millrace.sources import records

    cases = {
        '{"A": "B", "Cd" : {"E-F": ["G", {"H": "I: \\"J\\": K"}]}}': '{"a": "B", "cd" : {"e-f": ["G", {"h": "I: \\"J\\": K"}]}}',
        '{"X": "Y\\" : Z", "": "Q"}': '{"x": "Y\\" : Z", "": "Q"}', '["A", "B"]': '["A", "B"]', "": "", '{"Ñ": 1.50}': '{"ñ": 1.50}',
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", records.lower_keys(F.col("t")).alias("low"))
    assert {r["t"]: r["low"] for r in rows.collect()} == cases
    # Paths are looked up in generated code, without lambdas.
    found = records.first_text(F.parse_json("t"), ("a", "x"))
    assert "lambda" not in rows.where("t like '{%'").select(found)._jdf.queryExecution().optimizedPlan().toString()
