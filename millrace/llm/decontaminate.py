"""Benchmark passages in documents, by a stored positional inverted index and joins of posting lists.

1. Windows. Each test item gives windows of WINDOW terms; a shorter item is one window. Equal windows are one.
2. Counts. How often each test term occurs in all documents; windows' terms are ordered by that, rarest first.
3. Index. Postings of the two rarest terms of each window (row, term, places) are written to the shared folder.
4. Intersection. A window's rarest list, less the term's place in the window, gives candidate starts; they are joined with
   the second list at its own place. Only for rows that are left, postings of all test terms are stored too, and the
   remaining terms must stand at their places. What is left are exact phrase matches.
5. Proximity. With ``slop`` > 0, matches in which each term lies within ``slop`` words of its place, counted from the rarest
   term, but some not at it, are counted in n_near.

Terms are 64-bit hashes of words. Tasks know the wanted terms (and rows) by a bit map of BITS bits, whatever their number;
what it lets through by chance finds no partner in the joins. Nothing else is broadcast or collected, but for keys that
``common.spread`` deals to several tasks, so the benchmark may have any size. Documents are read three times and never
shuffled.

Rows are told apart by id and text, so ids may be null or repeated and every row gets one row. Null and wordless
documents have no words and no hits; null and wordless items have no windows; repeated items count each with its own
id, a null item id has no name and isn't counted. Empty tables give no rows, or no hits. Other columns are not looked at.
Words: A-Z lowered, runs of digits, letters a-z and anything beyond ASCII.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_bpe import Memo
from .common import arrow_schema, cut, keyed, spread, text_batches, trimmed, text_bytes

WINDOW, MIN_SHARE, SLOP = 13, 20, 1
#: Bits of a map of terms or rows: a megabyte in all.
BITS = 1 << 23

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


class Terms:
    """Hashes of a text's words, in order."""

    def __init__(self):
        self.memo = Memo(lambda w: int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little", signed=True))

    def of(self, text: bytes) -> np.ndarray:
        found = words(text)
        return np.fromiter(map(self.memo.__getitem__, found), np.int64, len(found))


def bit_map(keys: DataFrame, key: str) -> np.ndarray:
    """The map of a column of 64-bit hashes, put together where the rows are; at most BITS / 64 numbers come back."""
    bit = F.col(key).bitwiseAND(F.lit(BITS - 1))
    words = keys.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({key} & 63 as int))")).alias("bits"))
    out = np.zeros(BITS // 64, np.int64)
    for r in words.collect():
        out[r["at"]] = r["bits"]
    return out.view(np.uint64)


def marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = keys.view(np.uint64) & np.uint64(64 * len(bits) - 1)
    return (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1)).astype(bool)


def windows(benchmark: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """(item, terms array<long>): every window of every item."""
    schema = "item long, terms array<long>"

    def run(batches):
        terms, arrow = Terms(), arrow_schema(schema)
        for batch in batches:
            items, rows = [], []
            for i, value in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                found = terms.of(value).tolist()
                made = [found[at : at + size] for at in range(max(1, len(found) - size + 1) if found else 0)]
                items += [i] * len(made)
                rows += made
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(rows, arrow[1].type)], schema=arrow)

    return benchmark.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text")).mapInArrow(trimmed(run), schema)


def counted(rows: DataFrame, wanted) -> DataFrame:
    """(term, n) of each batch, for the terms in the map."""
    schema = "term long, n long"

    def run(batches):
        terms, bits, arrow = Terms(), wanted.value, arrow_schema(schema)
        for batch in batches:
            found = [terms.of(t) for t in text_bytes(batch.column(0))]
            whole = np.concatenate(found) if found else np.empty(0, np.int64)
            term, n = np.unique(whole[marked(bits, whole)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n.astype(np.int64))], schema=arrow)

    return rows.select("text").mapInArrow(trimmed(run), schema)


def postings(rows: DataFrame, wanted, only=None) -> DataFrame:
    """(id, dg, doc_id, n_words, terms, places): the postings of a row's terms that are in the map ``wanted``, in page order.

    only: a map of ``mark``; other rows have no words here.
    """
    schema = "id long, dg long, doc_id long, n_words long, terms array<long>, places array<int>"

    def run(batches):
        terms, bits, arrow = Terms(), wanted.value, arrow_schema(schema)
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            if only is not None:
                keep = marked(only.value, np.array(batch.column("mark").to_pylist(), np.int64)) if texts else []
                texts = [t if k else b"" for t, k in zip(texts, keep, strict=True)]
            found = [terms.of(t) for t in texts]
            places = [np.nonzero(marked(bits, f))[0] for f in found]
            made = [pa.array([len(f) for f in found], pa.int64()), pa.array([f[p] for f, p in zip(found, places, strict=True)], arrow[4].type), pa.array([p.astype(np.int32) for p in places], arrow[5].type)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("id", "dg", "doc_id")), *made], schema=arrow)

    return rows.mapInArrow(trimmed(run), schema)


def _single(index: DataFrame) -> DataFrame:
    """(id, dg, term, place): one row for each posting; rows that are there twice count once."""
    rows = index.where(F.size("terms") > 0).dropDuplicates(["id", "dg"])
    return rows.select("id", "dg", F.explode(F.arrays_zip("terms", "places")).alias("x")).select("id", "dg", F.col("x.terms").alias("term"), F.col("x.places").alias("place"))


def phrases(docs: DataFrame, tests: DataFrame, index_of, slop: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their number of words, matches (id, dg, w, start, length, exact)) of windows (w, terms)."""
    shared = docs.sparkSession.sparkContext.broadcast
    terms = cut(tests.select(F.explode("terms").alias("term")).distinct())
    all_terms = shared(bit_map(terms, "term"))
    counts = cut(counted(docs, all_terms).groupBy("term").agg(F.sum("n").alias("n")).join(terms, "term", "left_semi"))
    placed = tests.select("w", F.posexplode("terms").alias("place", "term")).join(counts, "term", "left")
    lists = placed.groupBy("w").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "term"))).alias("lists"))
    # A term that occurs nowhere rules its window out.
    plans = cut(lists.where(F.col("lists")[0]["n"] > 0))
    first, second = F.col("lists")[0], F.get("lists", 1)
    pivots = plans.select(F.explode(F.slice("lists", 1, 2)).alias("x")).select("x.term", "x.n").distinct()
    pivots = cut(pivots)
    index = cut(index_of(shared(bit_map(pivots, "term")), None))
    single = cut(_single(index))
    begin = plans.select("w", F.size("lists").alias("length"), first["term"].alias("term"), first["place"].alias("at"), first["n"].alias("n"), second["term"].alias("term2"), second["place"].alias("at2"))
    starts = spread(single, cut(begin), ["term"], ["id", "place"], sizes=pivots).select("id", "dg", "w", "length", (F.col("place") - F.col("at")).alias("start"), "term2", "at2").where(F.col("start") >= 0)
    reach = F.explode(F.sequence(F.lit(-slop), F.lit(slop)))
    probes = starts.where(F.col("term2").isNotNull()).withColumn("off", reach)
    probes = probes.select("id", "dg", "w", "length", "start", "off", F.col("term2").alias("term"), (F.col("start") + F.col("at2") + F.col("off")).alias("place"))
    met = probes.join(single, ["id", "dg", "term", "place"]).groupBy("id", "dg", "w", "length", "start").agg(F.max(F.col("off") == 0).alias("exact"))
    alone = starts.where(F.col("term2").isNull()).select("id", "dg", "w", "length", "start", F.lit(True).alias("exact"))
    left = cut(met.union(alone))
    # The rest of the terms, in the few rows that are left.
    marks = bit_map(left.select(F.xxhash64("id", "dg").alias("mark")), "mark")
    more = cut(_single(index_of(all_terms, shared(marks))))
    often = cut(left.groupBy("w").agg(F.count("*").alias("n")))
    rest = often.join(plans.select("w", F.slice("lists", 3, 1 << 20).alias("rest")), "w")
    todo = spread(left, rest, ["w"], ["id", "start"]).drop("n")
    done = todo.where(F.size("rest") == 0).select("id", "dg", "w", "start", "length", "exact")
    probes = todo.where(F.size("rest") > 0).withColumn("t", F.explode("rest")).withColumn("off", reach)
    probes = probes.select("id", "dg", "w", "start", "length", "exact", F.col("t.place").alias("at"), "off", F.col("t.term").alias("term"), (F.col("start") + F.col("t.place") + F.col("off")).alias("place"))
    each = probes.join(more, ["id", "dg", "term", "place"]).groupBy("id", "dg", "w", "start", "length", "exact", "at").agg(F.max(F.col("off") == 0).alias("here"))
    full = each.groupBy("id", "dg", "w", "start", "length", "exact").agg(F.count("*").alias("terms"), F.min("here").alias("all_here")).where(F.col("terms") == F.col("length") - 2)
    return index, cut(done.union(full.select("id", "dg", "w", "start", "length", (F.col("exact") & F.col("all_here")).alias("exact"))))


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per row: doc_id, n_words, spans (word places: start, end, start, end ... of what windows cover), items, n_near, and (id, dg)."""
    text_batches(docs.sparkSession)
    made = cut(windows(benchmark, item, item_text, window).withColumn("w", F.xxhash64("terms")))
    rows = keyed(docs, key, text, carry=True).withColumn("mark", F.xxhash64("id", "dg"))
    index, found = phrases(rows, made.groupBy("w").agg(F.first("terms").alias("terms")), lambda wanted, only: postings(rows, wanted, only), slop)
    exact = found.where("exact")
    spans = exact.groupBy("id", "dg").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"))
    hits = cut(exact.select("id", "dg", "w").distinct())
    sizes = cut(hits.groupBy("w").agg(F.count("*").alias("n")))
    owners = cut(made.select("w", "item").distinct().join(sizes, "w"))
    items = spread(hits, owners, ["w"], ["id", "dg"], sizes=sizes).groupBy("id", "dg").agg(F.array_sort(F.collect_set("item")).alias("items"))
    near = found.where(~F.col("exact")).groupBy("id", "dg").agg(F.count("*").alias("n_near"))
    told = cut(spans.join(items, ["id", "dg"], "full").join(near, ["id", "dg"], "full"))
    out = index.select("doc_id", "id", "dg", "n_words").join(told, ["id", "dg"], "left")
    none = F.array().cast("array<long>")
    flat = _merged(F.flatten(F.transform("spans", lambda x: F.array(x["start"].cast("long"), x["end"].cast("long")))))
    return out.select("doc_id", "n_words", F.when(F.col("spans").isNotNull(), flat).otherwise(none).alias("spans"), F.coalesce("items", none).alias("items"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "id", "dg")


@F.udf(T.ArrayType(T.LongType()), useArrow=True)
def _merged(spans):
    out: list[int] = []
    for b, e in zip(spans[::2], spans[1::2], strict=True) if spans is not None else ():
        if out and b <= out[-1]:
            out[-1] = max(out[-1], int(e))
        else:
            out += [int(b), int(e)]
    return out


def judged(found: DataFrame) -> DataFrame:
    """n_hit, n_items and contaminated: some hit, and a MIN_SHARE-th of the words at least."""
    hit = F.aggregate(F.sequence(F.lit(0), F.size("spans") - 1), F.lit(0).cast("long"), lambda a, i: a + F.when(i % 2 == 1, F.get("spans", i)).otherwise(-F.get("spans", i)))
    n_hit = F.when(F.size("spans") > 0, hit).otherwise(F.lit(0).cast("long"))
    out = found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (MIN_SHARE * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that the contamination rule names."""
    from .common import without

    return without(docs, judged(matches(docs, benchmark, key, text)).where("contaminated"), key, text)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = judged(matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=SLOP))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(names, 256).alias("items_sha256"), "contaminated", "n_near")


def brute(texts: list[str | None], items: list[tuple[int, str | None]], window: int = WINDOW) -> list[tuple]:
    """(n_words, n_hit, n_items, items_sha256, contaminated) for each text, by sliding along it; for tests."""
    wanted: dict[tuple, set[int]] = defaultdict(set)
    for item, text in items:
        w = words((text or "").encode())
        for at in range(max(1, len(w) - window + 1) if w else 0):
            wanted[tuple(w[at : at + window])].add(item)
    sizes, out = {len(k) for k in wanted}, []
    for text in texts:
        w = words((text or "").encode())
        hit, found = set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if (k := tuple(w[at : at + n])) in wanted:
                    hit.update(range(at, at + n))
                    found |= wanted[k]
        names = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((len(w), len(hit), len(found), names, bool(hit) and MIN_SHARE * len(hit) >= len(w)))
    return out
