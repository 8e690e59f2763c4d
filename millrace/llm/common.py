"""What the operators of this subpackage share: tables, Arrow batches, lineage cuts."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import cut, shared_dir
from ..operators.spread import MOST_HOT, spread

__all__ = ["MOST_HOT", "cut", "shared_dir", "spread"]

#: Rows and bytes of an Arrow batch of whole texts; a text is never split or cut.
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, so that very long texts don't add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def keyed_id(key: str, text: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.xxhash64(F.lit("id"), F.coalesce(F.col(text), F.lit(""))))


def keyed_digest(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keyed(docs: DataFrame, key: str, text: str, carry: bool = False) -> DataFrame:
    """(id, dg, text), and with ``carry`` the key itself as doc_id: what tells rows apart where ids repeat or are null.

    dg: 64 bits of the text; a null id is replaced by 64 other bits of it. Rows that agree in both have the same text
    (null counts as empty), so whatever is found for one holds for the other.
    """
    return docs.select(keyed_id(key, text).alias("id"), keyed_digest(text).alias("dg"), F.col(text).alias("text"), *([F.col(key).cast("long").alias("doc_id")] if carry else []))


def without(docs: DataFrame, gone: DataFrame, key: str = "doc_id", text: str = "text", small: int = 100_000) -> DataFrame:
    """``docs`` less the rows that ``gone`` (id, dg of ``keyed``) names: up to ``small`` of them travel as a broadcast, more are
    joined by shuffle. Every row has a key, so either way the same rows go."""
    names = cut(gone.select(F.col("id").alias("__id"), F.col("dg").alias("__dg")).distinct())
    marks = {"__i": keyed_id(key, text), "__d": keyed_digest(text)}
    found = F.broadcast(names) if names.count() <= small else names
    return docs.withColumns(marks).join(found, (F.col("__i") == F.col("__id")) & (F.col("__d") == F.col("__dg")), "left_anti").drop("__i", "__d")


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, giving freed memory back to the system when a task ends: workers live on between tasks, and what each of
    a pipeline's stages had at its peak would add up."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
        if trim:
            trim(0)

    return whole


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], carry: tuple[str, ...] = ()) -> DataFrame:
    """Columns in, columns out, by Arrow batch. ``make()`` runs once in each task and returns the batch function.

    Columns named in ``carry`` are passed on as they are, behind those of ``schema``.
    """
    kind = T.StructType(T._parse_datatype_string(schema).fields + [df.schema[c] for c in carry])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each, arrow = make(), arrow_schema(schema)
        for batch in batches:
            names = batch.schema.names
            out = each({name: batch.column(i).to_pylist() for i, name in enumerate(names)})
            more = [names.index(c) for c in carry]
            columns = [pa.array(out[f.name], f.type) for f in arrow] + [batch.column(i) for i in more]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([*arrow, *(batch.schema.field(i) for i in more)]))

    return df.mapInArrow(trimmed(run), kind)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    return pa.schema([pa.field(name, kinds[kind]) for name, kind in (part.strip().split(" ", 1) for part in ddl.split(","))])


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text of an Arrow string column; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply); a bijection for each seed."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x
