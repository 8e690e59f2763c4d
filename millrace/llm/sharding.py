"""Hilbert-curve ordering: rows sorted along a curve through several metadata dimensions, cut into equal runs.

The law is ``rows``: counts of any two shards differ by one at most. The dimensions are source, language, length and id,
each in its own order, so the least and greatest value of each in a run's files tell a reader which to leave out. A group
of equal texts takes the metadata of its smallest id, so that it is one point of the curve; its rows lie together, and
equal counts part a group only at a shard's end. Ties on the curve go by the group's id, then by the row's own.

Source and language are cut into 2 ** BITS ranges of their different values at most. Nulls: a null source or language sorts
first, a null id is the smallest, null text has size 16 and crc32 0 and null texts are a group. Repeated rows each
have a place. An empty table gives no rows. Columns whose names are those of results are replaced in ``write``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import numbered
from .common import cut, spread

SHARDS, BITS = 40, 10


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Distance along the Hilbert curve of each row of ``axes`` (n, dims), integers below 2**bits; dims * bits <= 62.

    Skilling's transform, on whole columns: undo the excess work of Gray codes from the top bit down, then interleave.
    """
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def edges(values: DataFrame, bits: int) -> list[str]:
    """Upper ends of at most 2 ** bits ranges that cut the different values of the only column into equal parts."""
    name = values.columns[0]
    different = cut(values.where(F.col(name).isNotNull()).distinct())
    n = different.count()
    width = max(1, -(-n // ((1 << bits) - 1)))
    if width == 1:
        return sorted(r[0] for r in different.collect())
    places = numbered(different, [], [F.col(name).asc()], "place")
    return sorted(r[0] for r in places.where(F.col("place") % width == 0).select(name).collect())


def curve(docs: DataFrame, key: str, source: str, lang: str, text: str, bits: int = BITS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, size, text_crc32, curve, __group, *carry): only metadata goes to Python."""
    value, code = F.col(text), F.col(key)
    size = F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 16
    marks = {"__t": F.xxhash64(value), "__u": F.xxhash64(F.lit("text"), value), "__v": value.isNull()}
    light = docs.select(code.alias("__key"), size.alias("__size"), F.coalesce(F.crc32(value), F.lit(0)).cast("long").alias("__crc"), F.col(source).cast("string").alias("__source"), F.col(lang).cast("string").alias("__lang"), *(m.alias(k) for k, m in marks.items()), *(F.col(k).alias(f"__c_{k}") for k in carry))
    groups = light.groupBy(*marks).agg(F.count("*").alias("__n"), F.min(F.struct(F.coalesce(F.col("__key").cast("long"), F.lit(-(1 << 63))).alias("id"), F.col("__source").alias("source"), F.col("__lang").alias("lang"))).alias("__one"))
    placed = spread(light, cut(groups.where(F.col("__n") > 1)), list(marks), ["__key", "__source", "__lang"], "left", n="__n")
    own = lambda k, mine: F.when(F.col("__n").isNotNull(), F.col(f"__one.{k}")).otherwise(mine)
    placed = placed.withColumns({"__group": own("id", F.coalesce(F.col("__key").cast("long"), F.lit(-(1 << 63)))), "__s": own("source", F.col("__source")), "__l": own("lang", F.col("__lang"))})
    sources, langs = (np.array(edges(docs.select(F.col(k).cast("string").alias("v")), bits), object) for k in (source, lang))
    low, high = docs.agg(F.min(code.cast("long")), F.max(code.cast("long"))).first()
    low, span, cells = low or 0, max(1, (high or 0) - (low or 0)), 1 << bits

    def ranged(values: pd.Series, ends: np.ndarray) -> np.ndarray:
        at = np.zeros(len(values), np.int64)
        known = values.notna().to_numpy()
        at[known] = np.searchsorted(ends, values[known].to_numpy(object)) + 1
        return at * cells // (len(ends) + 2)  # spread over the axis

    @F.pandas_udf(T.LongType())
    def along(a: pd.Series, b: pd.Series, size: pd.Series, group: pd.Series) -> pd.Series:
        length = np.minimum((np.log2(size.to_numpy().astype(float)) * cells / 40).astype(np.int64), cells - 1)
        ids = np.clip((group.to_numpy().astype(float) - low) / span, 0, 1) * (cells - 1)
        return pd.Series(hilbert_index(np.stack([ranged(a, sources), ranged(b, langs), length, ids.astype(np.int64)], axis=1), bits))

    return placed.select(F.col("__key").alias(key), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), along("__s", "__l", "__size", "__group").alias("curve"), "__group", "__t", *(F.col(f"__c_{k}").alias(k) for k in carry))


def shard(docs: DataFrame, key: str = "doc_id", source: str = "source", lang: str = "lang", text: str = "text", shards: int = SHARDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Shard and slot of every row, by two passes over light rows: order by range, then count before each range."""
    light = curve(docs, key, source, lang, text, carry=carry)
    # The ranges are drawn from a sample, so the ordered rows are written once and read twice.
    order = ["curve", "__group", "__t", key]
    ordered = cut(light.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part, row = F.shiftrightunsigned("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    counts = ordered.groupBy(part.alias("part")).count()
    # One number for each partition, however many rows there are.
    before = {r["part"]: r["count"] for r in counts.collect()}
    starts, total = {}, 0
    for p in sorted(before):
        starts[p], total = total, total + before[p]
    base = docs.sparkSession.createDataFrame(sorted(starts.items()) or [(0, 0)], "__part long, __start long")
    numbered_rows = ordered.join(F.broadcast(base), part == F.col("__part")).withColumn("__rank", F.col("__start") + row)
    # The first total % shards runs hold one row more.
    short, extra = divmod(total, shards)
    head = extra * (short + 1)
    which = F.when(F.col("__rank") < head, F.expr(f"__rank div {short + 1}")).otherwise(F.lit(extra) + F.expr(f"(__rank - {head}) div {max(short, 1)}"))
    first = F.when(F.col("__rank") < head, F.expr(f"__rank % {short + 1}")).otherwise(F.expr(f"(__rank - {head}) % {max(short, 1)}"))
    return numbered_rows.select(key, "size", "text_crc32", "curve", F.lit("rows").alias("law"), which.cast("int").alias("shard"), first.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *carry)


def write(docs: DataFrame, folder: str, key: str = "doc_id", source: str = "source", lang: str = "lang", text: str = "text", shards: int = SHARDS, rows_per_file: int = 1_000_000) -> None:
    """The rows as Parquet, a folder for each shard, in curve order, so that the files' statistics prune all four dimensions."""
    made = {"size", "text_crc32", "curve", "law", "shard", "slot", "grown_shard", key}
    out = shard(docs, key, source, lang, text, shards, tuple(k for k in docs.columns if k not in made))
    dealt = out.drop("law", "grown_shard").repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(folder)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return shard(table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")


def brute(rows: list[tuple], shards: int = SHARDS, bits: int = BITS) -> dict[int, tuple[int, int]]:
    """doc_id -> (shard, slot) of rows (doc_id, text, source, lang) with different ids, by one sort in memory; for tests."""
    from math import log2

    def codes(values: list) -> dict:
        known = sorted({v for v in values if v is not None})
        width = max(1, -(-len(known) // ((1 << bits) - 1)))
        ends = [v for n, v in enumerate(known, 1) if n % width == 0]
        return {v: 0 if v is None else (sum(e < v for e in ends) + 1) * (1 << bits) // (len(ends) + 2) for v in set(values)}

    first: dict = {}
    for i, text, source, lang in sorted(rows, key=lambda r: r[0]):
        first.setdefault(text, (i, source, lang))
    sources, langs = codes([r[2] for r in rows]), codes([r[3] for r in rows])
    low, high = min(r[0] for r in rows), max(r[0] for r in rows)
    points = []
    for i, text, _, _ in rows:
        group, source, lang = first[text]
        size = len((text or "").encode()) + 16
        axes = [sources[source], langs[lang], min(int(log2(size) * (1 << bits) / 40), (1 << bits) - 1), int((group - low) / max(1, high - low) * ((1 << bits) - 1))]
        points.append((int(hilbert_index(np.array([axes]), bits)[0]), group, i))
    out, at = {}, 0
    points.sort()
    for k in range(shards):
        n = len(points) // shards + (k < len(points) % shards)
        for slot, (_, _, i) in enumerate(points[at : at + n]):
            out[i] = (k, slot)
        at += n
    return out
