"""Near-duplicates by min-max hashing, confirmed on full shingle sets.

Each of PERMUTATIONS hash functions is evaluated once per shingle and keeps its least and its greatest value, which
gives twice as many unbiased signature values as evaluations. BANDS bands of ROWS values each bring documents
together, each from four different functions. Bands k and k + BANDS / 2 share theirs with minima and maxima exchanged,
so at similarity s a pair is missed with probability (1 - 2 * s**4 + t**4)**16 where t is the chance that one function's
minimum and maximum both agree, s**2 at most: at 0.75 5 in a million, for short texts and above it less.

Equal sets are folded first, so a group of copies of any size is one entry. Within a bucket, every entry is paired
with the smallest id (a star, linear in the bucket). The pairs are confirmed and joined into components; then only
buckets that still hold several components are looked at again, in cells of at most 2 * CELL entries, for pairs
across components whose signatures agree on at least EXPECT of their values (5 standard deviations below the
threshold). Every such pair is confirmed on full sets, so buckets have no cap: those of up to SMALL entries by a join,
larger ones inside their cells, where the sets travel and no pair is written. Links within a component are not
expanded; they can't change it.

Hot keys are dealt to several tasks: buckets, the stars' centres, the final look-up of a set's component.

Words: A-Z lowered, split at space and \\x09-\\x0D. Set: distinct runs of SHINGLE words; a shorter text is one run.
Null, empty and wordless texts have an empty set, link with nothing and are kept. Ties: the smallest id stays. Ids may
repeat: equal rows are kept or dropped together, and rows of one id with different texts are judged one by one. Null ids
count as the largest; a group of nothing else has a null component and is kept. An empty table gives no rows; columns
other than the key and the text are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .byte_bpe import Memo
from .common import arrow_schema, cut, keyed, mix, spread, table, text_batches, trimmed, text_bytes, without

SHINGLE, PERCENT = 5, 75
PERMUTATIONS, ROWS = 64, 4
BANDS = 2 * PERMUTATIONS // ROWS
CELL, EXPECT, SMALL = 512, 0.54, 48

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_draw = np.random.RandomState(20240601)
_A = (_draw.randint(0, 1 << 62, PERMUTATIONS).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _draw.randint(0, 1 << 62, PERMUTATIONS).astype(np.uint64)
_PLACES = _draw.randint(0, 1 << 62, SHINGLE).astype(np.uint64) | np.uint64(1)


class Shingles:
    """Sets of shingle hashes of whole texts."""

    def __init__(self, shingle: int = SHINGLE):
        self.k = shingle
        self.places = np.resize(_PLACES, shingle) * (np.arange(shingle, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        self.memo = Memo(lambda w: int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little"))

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct 64-bit hashes of each text's runs."""
        k, get, out = self.k, self.memo.__getitem__, []
        for text in texts:
            words = text.translate(_LOWER).split()
            n = len(words)
            hashes = np.fromiter(map(get, words), np.uint64, n)
            if n == 0:
                out.append(hashes)
            elif n < k:
                out.append(mix((hashes * self.places[:n]).sum(dtype=np.uint64, keepdims=True), n + 1))
            else:
                runs = hashes[: n - k + 1] * self.places[0]
                for j in range(1, k):
                    runs += hashes[j : n - k + 1 + j] * self.places[j]
                out.append(np.unique(mix(runs)))
        return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, 2 * PERMUTATIONS): all minima, then all maxima. No set may be empty."""
    flat, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    for k in range(PERMUTATIONS):
        values = flat * _A[k] + _B[k]
        out[:, k] = np.minimum.reduceat(values, starts)
        out[:, PERMUTATIONS + k] = np.maximum.reduceat(values, starts)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """(sets, BANDS) bucket numbers. A band's values come from different functions."""
    parts = signature.reshape(len(signature), ROWS, BANDS).copy()
    # Minimum and maximum of one function depend on each other in small sets, so the maxima are moved to other bands.
    parts[:, ROWS // 2 :] = np.roll(parts[:, ROWS // 2 :], BANDS // 2, axis=2)
    key = np.zeros((len(signature), BANDS), np.uint64)
    for j in range(ROWS):
        key = mix(key ^ parts[:, j], j + 1)
    return mix(key + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 99).view(np.int64)


def _digest(values: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def sketch(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(id, dg, doc_id, n, a, b, bands, sig): set size, 128 bits of the set, buckets, and a byte of each signature value."""
    schema = "id long, dg long, doc_id long, n long, a long, b long, bands array<long>, sig binary"

    def run(batches):
        shingles, arrow = Shingles(shingle), arrow_schema(schema)
        for batch in batches:
            sets = shingles.sets(text_bytes(batch.column("text")))
            full = [k for k, s in enumerate(sets) if len(s)]
            keys, low = [[]] * len(sets), [b""] * len(sets)
            if full:
                sig = signatures([sets[k] for k in full])
                for k, row, eight in zip(full, bands(sig), (mix(sig, 7) & np.uint64(255)).astype(np.uint8), strict=True):
                    keys[k], low[k] = row, eight.tobytes()
            digests = [_digest(s) for s in sets]
            made = [[len(s) for s in sets], [d[0] for d in digests], [d[1] for d in digests], keys, low]
            columns = [batch.column(k) for k in ("id", "dg", "doc_id")] + [pa.array(c, f.type) for c, f in zip(made, list(arrow)[3:], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return keyed(docs, key, text, carry=True).mapInArrow(trimmed(run), schema)


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(node, values binary): the sorted hashes of the sets of the wanted rows (id, dg, node)."""
    schema = "node long, values binary"

    def run(batches):
        shingles, arrow = Shingles(shingle), arrow_schema(schema)
        for batch in batches:
            values = [s.tobytes() for s in shingles.sets(text_bytes(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(values, pa.binary())], schema=arrow)

    # A row that is there twice has one set.
    return keyed(docs, key, text).join(wanted, ["id", "dg"]).select("node", "text").mapInArrow(trimmed(run), schema).dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    schema = "a long, b long"

    def run(batches):
        arrow = arrow_schema(schema)
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                keep.append(_resemble(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], schema=arrow)

    # A node with very many pairs is ``a`` in all of them, as those of a bucket start from one node.
    often = cut(pairs.groupBy("a").agg(F.count("*").alias("n")))
    x, y = sets.select(F.col("node").alias("a"), F.col("values").alias("x")), sets.select(F.col("node").alias("b"), F.col("values").alias("y"))
    return spread(pairs, often.join(x, "a"), ["a"], ["b"]).join(y, "b").select("a", "b", "x", "y").mapInArrow(trimmed(run), schema)


def _resemble(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Are two sorted sets similar enough?"""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):
        return False
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _candidates(rows: dict[str, np.ndarray], kind: int, i: int, j: int, low: int, percent: int):
    """Pairs (places) of a cell across components, by size and signature; those with the bucket's star are tested."""
    ids, label, n, home, main, sig = (rows[k] for k in ("node", "label", "n", "home", "d", "sig"))
    first = np.nonzero(~main)[0]
    other = np.nonzero(main)[0] if kind == 0 else first[home[first] == j]
    for x in first if kind == 0 else first[home[first] == i]:
        if ids[x] == low:
            continue
        y = other[(label[other] != label[x]) & (ids[other] != low)]
        if kind and i == j:
            y = y[ids[y] > ids[x]]
        y = y[100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])]
        if len(y):
            agree = (sig[y] == sig[x]).mean(axis=1)
            order = np.argsort(-agree, kind="stable")
            yield x, y[order[agree[order] >= EXPECT]]


def _open_buckets(shared: DataFrame, labels: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows of buckets that still hold several components, dealt to cells of at most 2 * CELL rows.

    A bucket's largest component is cut into kd blocks, the rest into ku; every block of the rest meets every block.
    """
    named = shared.join(labels.withColumnRenamed("id", "node"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = named.groupBy("bucket", "size", "label").agg(F.count("*").alias("n"))
    open_ = groups.groupBy("bucket", "size").agg(F.count("*").alias("labels"), F.max(F.struct("n", "label")).alias("top")).where(F.col("labels") > 1)
    open_ = cut(open_.select("bucket", F.col("size").alias("n"), F.col("top.label").alias("main"), F.ceil(F.col("top.n") / CELL).cast("int").alias("kd"), F.greatest(F.lit(1), F.ceil((F.col("size") - F.col("top.n")) / CELL)).cast("int").alias("ku")))
    rows = spread(named, open_, ["bucket"], ["node"]).drop("n").join(entries, "node").withColumn("d", F.col("label") == F.col("main"))
    rows = rows.withColumn("home", F.pmod(F.xxhash64("node"), F.when(F.col("d"), F.col("kd")).otherwise(F.col("ku"))).cast("int"))
    to = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    h = F.col("home")
    rest = F.concat(F.transform(to("kd"), lambda i: cell(0, i, h)), F.transform(to("ku"), lambda j: cell(1, F.least(h, j), F.greatest(h, j))))
    return rows.withColumn("cell", F.explode(F.when(F.col("d"), F.transform(to("ku"), lambda j: cell(0, h, j))).otherwise(rest)))


def _small_buckets(cells: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of buckets with at most SMALL rows; to be confirmed on full sets."""
    lists = cells.groupBy("bucket", "cell").agg(F.collect_list(F.struct("node", "label", "n", "low", "d", "home", "sig")).alias("rows"))
    lists = lists.where((F.size("rows") > 1) & (F.size(F.array_distinct(F.col("rows.label"))) > 1)).select("cell.kind", "cell.i", "cell.j", "rows")
    schema = "a long, b long"

    def run(batches):
        arrow = arrow_schema(schema)
        for batch in batches:
            left, right = [], []
            for kind, i, j, rows in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                columns = {name: np.array([r[name] for r in rows]) for name in ("node", "label", "n", "home", "d")}
                columns["sig"] = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint8).reshape(len(rows), -1)
                for x, y in _candidates(columns, kind, i, j, rows[0]["low"], percent):
                    ids = columns["node"]
                    left += np.minimum(ids[y], ids[x]).tolist()
                    right += np.maximum(ids[y], ids[x]).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=arrow)

    return lists.mapInArrow(trimmed(run), schema).distinct()


def _large_buckets(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of larger buckets, confirmed where the rows meet: pairs are not written, and within a cell two
    components are linked once. A pair is looked at only in the first of the buckets that it shares."""
    schema = "a long, b long"

    def each(table: pa.Table) -> pa.Table:
        rows = {name: table.column(name).to_numpy() for name in ("node", "label", "n", "home", "bucket", "low", "kind", "i", "j")}
        rows["d"] = np.array(table.column("d").to_pylist(), bool)
        rows["sig"] = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(table), -1)
        own = np.array(table.column("bands").to_pylist(), np.int64)
        values = [np.frombuffer(v, np.uint64) for v in table.column("values").to_pylist()]
        bucket, ids, joined = rows["bucket"][0], rows["node"], {}

        def root(k: int) -> int:
            while joined.get(k, k) != k:
                k = joined[k]
            return k

        left, right = [], []
        for x, near in _candidates(rows, int(rows["kind"][0]), int(rows["i"][0]), int(rows["j"][0]), int(rows["low"][0]), percent):
            if not len(near):
                continue
            same = own[near] == own[x]
            near = near[own[x][same.argmax(axis=1)] == bucket]
            for y in near:
                p, q = root(int(rows["label"][x])), root(int(rows["label"][y]))
                if p != q and _resemble(values[x], values[y], percent):
                    joined[max(p, q)] = min(p, q)
                    left.append(min(ids[x], ids[y]))
                    right.append(max(ids[x], ids[y]))
        return pa.table([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=arrow_schema(schema))

    flat = cells.select("bucket", "cell.kind", "cell.i", "cell.j", "node", "label", "n", "low", "d", "home", "sig", "bands").join(sets, "node")
    return flat.groupBy("bucket", "kind", "i", "j").applyInArrow(each, schema)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, small: int = SMALL) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, kept), and (id, dg) that tell rows apart.

    The nodes of the graph are different sets, not ids: rows with one id and different texts are apart.
    """
    text_batches(docs.sparkSession)
    base = cut(sketch(docs, key, text, shingle))
    # Equal sets are one node. The smallest id of a node may be null only if all are.
    sets_of = base.where(F.col("n") > 0).groupBy("a", "b", "n")
    classes = sets_of.agg(F.count("*").alias("size"), F.min("doc_id").alias("least"), F.min(F.struct("id", "dg")).alias("one"), F.min_by(F.struct("bands", "sig"), F.struct("id", "dg")).alias("sketch"))
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()))
    entries = classes.select("node", "n", "sketch.bands", "sketch.sig")
    placed = entries.select("node", F.explode("bands").alias("bucket"))
    buckets = cut(placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("low")).where(F.col("n") > 1))
    shared = cut(spread(placed, buckets, ["bucket"], ["node"]).select("bucket", "node", "low", F.col("n").alias("size")))
    wanted = shared.select("node").distinct().join(classes.select("node", "one.id", "one.dg"), "node")
    sets = cut(full_sets(docs, wanted, key, text, shingle))
    sizes = classes.select("node", "n")
    star = shared.where(F.col("node") != F.col("low")).select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    star = cut(star.join(sizes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b"))
    starts = star.groupBy("a").agg(F.count("*").alias("n")).join(sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
    star = spread(star, cut(starts), ["a"], ["b"]).where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b")
    links = cut(confirmed(cut(star), sets, percent))
    labels = components(links).withColumnRenamed("root", "label")
    cells = cut(_open_buckets(shared, labels, entries))
    pairs = cut(_small_buckets(cells.where(F.col("size") <= small), percent))
    large = cells.where(F.col("size") > small)
    more = confirmed(pairs, sets, percent)
    more = cut(more.union(_large_buckets(large, sets, percent)) if large.limit(1).count() else more)
    labels = components(labels.select(F.col("label").alias("a"), F.col("id").alias("b")).union(more)).withColumnRenamed("root", "label")
    # The smallest id of a component is the smallest of its nodes' smallest ids.
    named = classes.select("node", "a", "b", "n", "size", "least").join(labels, F.col("node") == F.col("id"), "left").withColumn("label", F.coalesce("label", "node")).drop("id")
    groups = cut(named.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("nodes")))
    named = spread(named, groups, ["label"], ["node"], n="nodes").select("a", "b", F.col("n").alias("m"), F.col("size").alias("n"), "component_id")
    rows = base.select("doc_id", "id", "dg", "a", "b", F.col("n").alias("n_shingles"))
    found = spread(rows.where(F.col("n_shingles") > 0), cut(named), ["a", "b"], ["id", "dg"]).select("doc_id", "n_shingles", "component_id", "id", "dg")
    empty = rows.where(F.col("n_shingles") == 0).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "id", "dg")
    return found.union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "n_shingles", "component_id", "kept", "id", "dg")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near-duplicates."""
    return without(docs, near_duplicates(docs, key, text).where(~F.col("kept")), key, text)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("id", "dg")


def brute(rows: list[tuple[int, str | None]], shingle: int = SHINGLE, percent: int = PERCENT) -> dict[int, tuple[int, int, bool]]:
    """doc_id -> (n_shingles, component_id, kept), on word tuples and all pairs that share one; for tests."""
    sets, holders = {}, {}
    for i, t in rows:
        w = (t or "").encode().translate(_LOWER).split()
        sets[i] = {tuple(w[j : j + shingle]) for j in range(max(1, len(w) - shingle + 1))} if w else set()
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, own in sets.items():
        for j in {j for s in own for j in holders[s] if j > i}:
            both = len(own & sets[j])
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}
