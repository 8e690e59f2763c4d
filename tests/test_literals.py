"""Substrings that patterns need, and features and evidence read with them, against the patterns alone."""

import random
import re

from pyspark.sql import functions as F

from millrace.functions import signals
from millrace.functions.literals import required


def test_required_substrings():
    assert required(r"\bbalcon") == {"balcon"} and required(r"vista (al |a )?interior") == {"interior"} and required(r"porter(o|ia)") == {"porter"}
    assert required(r"(con|y) estudio\b") == {" estudio"} and required(r"(acepta|admite) mascotas|sin aval") == {" mascotas", "sin aval"} and required(r"\d+") == frozenset()


def phrases(n):
    """Pieces of the patterns themselves, spelt out, cut and glued."""
    r = random.Random(3)
    plain = [re.sub(r"\\b|\(\?[!:].*?\)|[\\^$]", "", p) for stated, denied in signals.FEATURES.values() for p in stated + denied]
    spelt = [re.sub(r"\([^)]*\)\??", lambda m: r.choice(["", re.split(r"[|)]", m[0][1:])[0]]), p) for p in plain]
    spelt = [re.sub(r".\?", lambda m: r.choice(["", m[0][0]]), re.sub(r"\[.*?\]", " ", p)) for p in spelt]
    special = ["terraza comun", "terraza del edificio", "terraza y terraza comun", "no amoblado", "semi amoblado", "vista av. ", "xascensorx"]
    return [" ".join(r.choice(spelt + special)[: r.choice([99, 99, 6])] for _ in range(r.randint(0, 5))) for _ in range(n)]


def test_features_and_evidence_are_those_of_the_patterns_alone(spark):
    texts = phrases(1500)
    table = spark.createDataFrame(list(enumerate([*texts, None, ""])), "id long, t string")
    found = {x["id"]: x for x in table.select("id", *[signals.feature(F.col("t"), k).alias(k) for k in signals.FEATURES], signals.evidence(F.col("t")).alias("evidence")).collect()}
    stated = 0
    for k, text in enumerate(texts):
        for name, (yes, no) in signals.FEATURES.items():
            wanted = False if any(re.search(p, text) for p in no) else True if any(re.search(p, text) for p in yes) else None
            assert found[k][name] is wanted, (text, name)
            stated += wanted is not None
        said = [e.partition(":")[0].removesuffix("=False") for e in found[k]["evidence"]]
        assert said == [name for name, (yes, no) in signals.FEATURES.items() if any(re.search(p, text) for p in yes + no)]
        for e in found[k]["evidence"]:
            name, _, cited = e.partition(": ")
            patterns = signals.FEATURES[name.removesuffix("=False")][name.endswith("=False")]
            m = re.search(next(p for p in patterns if re.search(p, text)), text)
            assert cited == f"…{text[max(0, m.start() - 25) : m.end() + 25].strip(' ')}…"
    assert stated > 2000 and found[len(texts)]["balcony"] is None
