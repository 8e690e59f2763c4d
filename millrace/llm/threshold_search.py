"""Exact top-k by inner product with the threshold algorithm over sorted per-dimension lists.

Candidates lie in blocks of about BLOCK vectors. A block's lists, its rows sorted along each dimension, are made once and
written to the shared folder. For a query, the lists are read from the end that its weight prefers; what appears is
scored exactly; the sum over dimensions of the weight times the value at the depth reached bounds everything unseen. A
query stops when its kth score so far, also from blocks seen before in the task, is above that bound (strictly, as an equal
score with a smaller id may be unseen). Queries go round in blocks of QUERIES at most, one after the other, so the
broadcast of a block is bounded; every task returns k rows for each query, and the best of them are merged.

Components x become floor(scale * x). Vectors that are null, empty, or hold a null, a NaN or an infinity take no
part, nor do null ids; queries meet candidates of their own dimension only. Equal scores go to the smaller id. Scores
beyond 64 bits are an error. A query with fewer than k candidates gets all of them. Ids may repeat: a query leaves out its
own row only, and each of several rows of one id asks for itself. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, cut, text_batches

SCALE, K, EVERY = 256, 5, 50
#: Vectors in a block of candidates; numbers (8 bytes each) in a block of queries.
BLOCK, QUERIES = 8192, 1 << 21


class Lists:
    """The sorted lists of a block of candidates (n, dims), which are in order of their ids."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, lists: np.ndarray):
        self.ids, self.rows, self.vectors, self.lists = ids, rows, vectors, lists
        self.small = int(np.abs(vectors).max(initial=0)) < 1 << 22 and vectors.shape[1] < 256  # products are exact as doubles
        self.floats = vectors.astype(np.float64) if self.small else None
        self.values = np.take_along_axis(vectors, lists, axis=0)

    def top(self, query: np.ndarray, own: int, k: int, best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the k best of these and of ``best``, the query's own row left out."""
        n = len(self.ids)
        seen = self.rows == own
        best_scores, best_ids = best
        up = query > 0
        used = np.nonzero(query)[0] if query.any() else np.arange(1)
        falling, rising = used[up[used]], used[~up[used]]
        small = self.small and int(np.abs(query).max(initial=0)) < 1 << 22
        weights = query.astype(np.float64 if small else object)
        depth, step = 0, max(16, n // 32)
        while depth < n:
            to = min(n, depth + step)
            met = np.zeros(n, bool)
            met[self.lists[n - to : n - depth, falling]] = True
            met[self.lists[depth:to, rising]] = True
            new = np.nonzero(met & ~seen)[0]
            seen |= met
            if len(new):
                scores = np.concatenate([best_scores, self._scores(new, weights, small)])
                ids = np.concatenate([best_ids, self.ids[new]])
                if len(scores) > 4 * k:  # what is below the kth can go before the sort
                    keep = np.nonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])[0]
                    scores, ids = scores[keep], ids[keep]
                order = np.lexsort((ids, -scores))[:k]
                best_scores, best_ids = scores[order], ids[order]
            depth, step = to, step * 2
            edge = np.where(up, self.values[n - to], self.values[to - 1])
            if len(best_scores) == k and int(best_scores[-1]) > int((edge * weights).sum()):
                break
        return best_scores, best_ids

    def _scores(self, rows: np.ndarray, weights: np.ndarray, small: bool) -> np.ndarray:
        if small:
            return (self.floats[rows] @ weights).astype(np.int64)
        wide = self.vectors[rows].astype(object) @ weights
        if any(not -(1 << 63) < int(x) < 1 << 63 for x in wide):
            raise OverflowError("an inner product doesn't fit in 64 bits")
        return wide.astype(np.int64)


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v array<long>) of the rows that take part."""
    x = F.col(vector)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    rows = vectors.where(x.isNotNull() & F.col(key).isNotNull()).where((F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)))
    return rows.select(F.col(key).cast("long").alias("id"), F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long")).alias("v"))


def stored_lists(rows: DataFrame, block: int) -> DataFrame:
    """rows (row, id, v) -> one row for each block: (dims, ids, rows, vectors, lists), the arrays as bytes."""
    schema = "dims long, ids binary, rows binary, vectors binary, lists binary"
    sized = rows.withColumn("dims", F.size("v").cast("long"))
    blocks = cut(sized.groupBy("dims").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks")))

    def each(found: pa.Table) -> pa.Table:
        ids, own = found.column("id").to_numpy(), found.column("row").to_numpy()
        vectors = found.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        order = np.argsort(ids, kind="stable")
        ids, own, vectors = ids[order], own[order], vectors[order]
        lists = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        made = [[vectors.shape[1]], *([x.tobytes()] for x in (ids, own, np.ascontiguousarray(vectors), np.ascontiguousarray(lists)))]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(made, arrow_schema(schema), strict=True)], schema=arrow_schema(schema))

    dealt = sized.join(blocks, "dims").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
    # A few blocks keep all tasks busy; of very many, some share a task and so its best rows.
    n, wide = blocks.agg(F.sum("blocks")).first()[0] or 1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(n, max(wide, n // 32))
    return cut(dealt.select("dims", "block", "row", "id", "v").groupBy("dims", "block").applyInArrow(each, schema).repartition(tasks))


def solved(lists: DataFrame, asked: list, k: int) -> DataFrame:
    """(query_row, query_id, vec_id, score): the k best of each task for the queries (row, id, v) of a block."""
    schema = "query_row long, query_id long, vec_id long, score long"
    shared = lists.sparkSession.sparkContext.broadcast([(r["row"], r["id"], np.array(r["v"], np.int64)) for r in asked])

    def run(batches):
        asked, none = shared.value, (np.empty(0, np.int64), np.empty(0, np.int64))
        best = [none] * len(asked)
        for batch in batches:
            for found in batch.to_pylist():
                ids, own = np.frombuffer(found["ids"], np.int64), np.frombuffer(found["rows"], np.int64)
                block = Lists(ids, own, *(np.frombuffer(found[name], kind).reshape(len(ids), -1) for name, kind in (("vectors", np.int64), ("lists", np.int32))))
                for q, (row, _, v) in enumerate(asked):
                    if len(v) == found["dims"]:
                        best[q] = block.top(v, row, k, best[q])
        rows = [(row, i, int(n), int(s)) for (row, i, _), (scores, ids) in zip(asked, best, strict=True) for s, n in zip(scores, ids, strict=True)]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=arrow_schema(schema))

    return lists.mapInArrow(run, schema)


def search(vectors: DataFrame, is_query: Column | None = None, key: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = SCALE, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score). ``is_query`` is a condition on ``id``; by default every EVERY-th id asks."""
    text_batches(vectors.sparkSession)
    rows = cut(quantised(vectors, key, vector, scale).withColumn("row", F.monotonically_increasing_id()))
    asks = rows.where(is_query if is_query is not None else F.col("id") % EVERY == 0)
    rounds = max(1, -(-(asks.agg(F.sum(F.size("v"))).first()[0] or 0) // queries))
    lists, found = stored_lists(rows, block), None
    for n in range(rounds):
        asked = asks.where(F.pmod(F.xxhash64(F.lit("q"), "row"), F.lit(rounds)) == n).collect()
        best = solved(lists, asked, k)
        best = cut(best) if rounds > 1 else best
        found = best if found is None else found.union(best)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return search(table(spark, sf_dir, "embeddings"))


SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= {K}
"""
