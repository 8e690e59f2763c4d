"""Filter audit, packing and word runs against brute force, on nulls, empties, ties, repeated rows and clashing names."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import filter_audit, packing, word_runs
from tests.llm.test_operators import TEXTS, empty, prose, table

FOLDER = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ filter audit
def audit_brute(rows, labels):
    """rows (doc_id, text, lang), labels (doc_id, quality, toxic): every order, step by step."""
    marks = defaultdict(lambda: [False, False])
    for i, quality, toxic in labels:
        if i is not None:
            marks[i][0] |= quality == 1
            marks[i][1] |= toxic == 1
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = []
    for i, text, lang in rows:
        t = text or ""
        words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in t).split(" ") if w]
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and least[t] < i,
        }
        docs.append((lang or "", {k for k, v in fails.items() if v}, *(marks[i] if i is not None else (False, False))))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                earlier = sum(f in d[1] for d in mine) - len(gone)
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), earlier, sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_every_order(spark):
    r = random.Random(9)
    texts = [None, "", " \t\v\x0c\r\n ", prose(1, 120), prose(1, 120), "w " * 150, "AB " * 120, prose(2, 130) + " #", prose(2, 130) + " #", prose(3, 20000), "x" * 50_000, "é ü" * 40, prose(4, 100), "Ab|" * 120]
    rows = [(r.choice([None, *range(12)]), r.choice(texts), r.choice(["en", "fr", None, ""])) for _ in range(80)]
    rows += [rows[0], rows[1], (5, prose(4, 100), "en"), (5, prose(4, 100), "en"), (4, prose(4, 100), "fr")]
    labels = [(k % 9, r.choice([0, 1, None]), r.choice([0, 1])) for k in range(14)] + [(None, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for clash in ("k", "dg", "part", "mask", "n", "sha", "words", "rows", "first"):
        docs = docs.withColumn(clash, F.lit("x"))
    found = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {tuple(x) for x in found.collect()} == audit_brute(rows, labels) and found.count() == 600 * len({x[2] or "" for x in rows})
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty(spark), none).count() == 0
    assert {tuple(x) for x in filter_audit.audit(docs, none).collect()} == audit_brute(rows, [])


def test_audit_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    ours = filter_audit.query(spark, FOLDER)
    assert {tuple(x) for x in ours.collect()} == set(con.sql(f"SELECT {', '.join(ours.columns)} FROM ({filter_audit.SQL})").fetchall())


def test_audit_uses_no_python(spark):
    plan = filter_audit.failures(table(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ------------------------------------------------------------------ packing
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_tokens_equal_the_library():
    mine, theirs, r = packing.tokens(packing.vocabulary()), library(), random.Random(10)
    odd = ["".join(chr(r.choice([97, 98, 65, 32, 9, 233, 201, 0xDF, 0xD7, 0xAA, 0x4E2D, 0x1F600, 10, 48, 39, 34, 0x1C, 0x85, 0xB2, 0x301, 0xA0, 95, 115, 0x3A3, 0x130, 0x1E9E, 0xAC00, 0x1100, 0x1161])) for _ in range(r.randint(0, 60))) for _ in range(800)]
    plain = ["".join(chr(r.choice([*range(33, 127), *range(0xC0, 0x100), 32, 39, 115])) for _ in range(r.randint(0, 60))) for _ in range(800)]
    for text in odd + plain + ["it's we'LL ' s", "<|endoftext|> a<|startoftext|>b <|endoftext |>"] + [t or "" for t in TEXTS]:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [10, 23, 50])
def test_plan_is_best_two_fit_bin_by_bin(capacity):
    r = random.Random(capacity)
    for _ in range(150):
        lengths = [r.randint(1, capacity) if r.random() < 0.5 else r.choice([3, 4, 7]) for _ in range(r.randint(0, 70))]
        slots, n = packing.plan(Counter(lengths), capacity)
        bins, starts = defaultdict(list), [s[0] for s in slots]
        for number, length in enumerate(sorted(lengths)):
            first, base, uses, offset, own = slots[int(np.searchsorted(starts, number, "right")) - 1]
            assert own == length
            bins[base + (number - first) // uses].append((offset + (number - first) % uses * length, length))
        for placed in bins.values():
            ends = [a + b for a, b in sorted(placed)]
            assert [a for a, _ in sorted(placed)] == [0, *ends[:-1]] and ends[-1] <= capacity
        assert sorted(bins) == list(range(n))
        assert sorted(sorted((length for _, length in b), reverse=True) for b in bins.values()) == sorted(packing.brute(lengths, capacity))


def test_packed(spark):
    theirs = library()
    docs = table(spark, TEXTS * 3).withColumn("length", F.lit("x")).withColumn("piece", F.lit("y")).withColumn("doc_id", F.when(F.col("doc_id") > 3, F.col("doc_id")))
    out = packing.packed(docs, capacity=512).collect()
    want = Counter()
    for i, text in ((k if k > 3 else None, t) for k, t in enumerate(TEXTS * 3)):
        ids = np.array([*theirs.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.update((i, n, at, min(512, len(ids) - at), zlib.crc32(ids[at : at + 512].tobytes())) for n, at in enumerate(range(0, len(ids), 512)))
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in out) == want
    bins = defaultdict(list)
    for x in out:
        bins[x["sequence_id"]].append((x["offset"], x["length"]))
    for placed in bins.values():
        ends = [a + b for a, b in sorted(placed)]
        assert [a for a, _ in sorted(placed)] == [0, *ends[:-1]] and ends[-1] <= 512
    assert len(bins) == len(packing.brute([x["length"] for x in out], 512))
    assert packing.packed(empty(spark)).count() == 0


# ------------------------------------------------------------------ runs
def test_runs_equal_brute_force():
    r = random.Random(11)
    for _ in range(2500):
        k, words = r.choice([1, 1, 2, 3]), []
        base = [r.randint(0, k) for _ in range(r.randint(1, 9))]
        n = r.randint(0, 80)
        while len(words) < n:
            words += base * r.randint(1, 4)
            if r.random() < 0.5:
                base = base[: r.randint(1, len(base))] + [r.randint(0, k)]
        words = [b"%d" % w for w in words]
        for least, periods in ((1, 3), (8, 3), (24, 3)):
            assert word_runs.runs(words, least, periods) == word_runs.brute(words, least, periods)


def test_extensions_are_those_of_all_suffixes_in_linear_steps():
    class Letter(int):
        compared = 0

        def __eq__(self, other):
            Letter.compared += 1
            return int(self) == int(other)

        __hash__ = int.__hash__

    r = random.Random(12)
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 3000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    thue = [bin(k).count("1") % 2 for k in range(3000)]
    for w in (fibonacci[-1], thue, [0] * 3000, [1, 0] * 1500, ([1] * 40 + [0]) * 80, [k % 50 for k in range(3000)], [r.randint(0, 1) for _ in range(3000)]):
        Letter.compared = 0
        found = {i: (p, m) for i, p, m in word_runs.extensions([*map(Letter, w), Letter(-1)])}
        assert Letter.compared < 6 * len(w)
        small = w[:200]
        suffix = [[*small[i:], -1] for i in range(len(small))]
        found = {i: (p, m) for i, p, m in word_runs.extensions([*small, -1])}
        for i in range(len(small)):
            j = next((j for j in range(i + 1, len(small)) if suffix[j] < suffix[i]), len(small))
            m = 0
            while j + m < len(small) and small[i + m] == small[j + m]:
                m += 1
            assert found.get(i) == ((j - i, m) if m > j - i else None)


def test_run_rows(spark):
    phrase = "a b c"
    texts = [None, "", " \n ", " ".join([phrase] * 8), " ".join([phrase] * 7), "x y " + " ".join(["q"] * 24) + "\tz", prose(1, 20000), " ".join(["q"] * 30 + ["r"] + ["q"] * 30)]
    docs = table(spark, texts).withColumn("runs", F.lit("x")).withColumn("length", F.lit("y"))
    out = {x["doc_id"]: x for x in word_runs.describe(docs).collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert [out[k]["n_runs"] for k in range(8)] == [0, 0, 0, 1, 0, 1, 0, 2]
    assert (out[3]["start"], out[3]["length"], out[3]["period"], out[3]["exponent_milli"]) == (0, 24, 3, 8000)
    assert (out[0]["start"], out[0]["runs_sha256"], out[0]["collapsed_sha256"]) == (None, none, none)
    assert out[7]["start"] == 0 and out[7]["runs_sha256"] == hashlib.sha256(b"0,30,1\n31,30,1\n").hexdigest()
    kept = {x["doc_id"]: x["text"] for x in word_runs.collapse(docs).collect()}
    assert kept[3] == phrase and kept[5] == "x y q z" and kept[7] == "q r q" and kept[0] == ""
    assert word_runs.describe(empty(spark)).count() == 0


def test_planted_periods(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for x in word_runs.query(spark, FOLDER).collect():
        h, words = zlib.crc32(str(x["doc_id"]).encode()), (docs[x["doc_id"]] or "").encode().split()
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = word_runs.brute(words) if len(words) < 1500 else word_runs.runs(words)
        kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in found)]
        assert x["n_runs"] == len(found) and x["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest()
        assert x["collapsed_sha256"] == hashlib.sha256(b" ".join(kept)).hexdigest()
        best = max(found, key=lambda f: (f[1] / f[2], -f[0]), default=None)
        assert (x["start"], x["length"], x["period"]) == (best or (None,) * 3)
