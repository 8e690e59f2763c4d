"""Readers and writers: landed files in, result tables out; and the registry of named sources."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..schema import ARRAYS, KINDS, conform
from . import portals

c = F.col


def coerce(column: str) -> Column:
    """Text of a file column as its listing type; what can't be read is null."""
    kind, value = KINDS[column], F.nullif(F.trim(c(column).cast("string")), F.lit(""))
    if isinstance(kind, T.BooleanType):
        return X.to_bool(value)
    if isinstance(kind, T.IntegerType):
        return X.to_int(value)
    if isinstance(kind, T.DoubleType):
        return X.to_float(value)
    if isinstance(kind, T.ArrayType):
        parts = F.when(value.startswith("["), F.from_json(value, "array<string>")).otherwise(F.split(value, ";"))
        return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")
    return value


def read_manual(spark: SparkSession, folder: str, scraped_at: str) -> DataFrame:
    """All *.csv and *.json files of a folder as listings, in order of file and line; unknown columns go."""
    parts = []
    for pattern, reader in (("*.csv", lambda p: spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE").csv(p)), ("*.json", lambda p: spark.read.option("multiLine", True).option("primitivesAsString", True).json(p))):
        try:
            files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
            if files.limit(1).count():
                parts.append(reader(f"{folder.rstrip('/')}/{pattern}"))
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(k, v) for k, v in KINDS.items()]))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.select(*[F.to_json(k).alias(k) if isinstance(p.schema[k].dataType, T.ArrayType) else c(k) for k in p.columns if k in KINDS]) for p in parts])
    typed = conform(rows.select(*[coerce(k).alias(k) for k in rows.columns]))
    placed = c("latitude").isNotNull()
    return typed.withColumns({
        "source": F.coalesce("source", F.lit("manual")), "scraped_at": F.coalesce("scraped_at", F.lit(scraped_at)), "active_status": F.coalesce("active_status", F.lit("UNKNOWN")),
        "coord_source": F.when(placed, F.coalesce("coord_source", F.lit("LISTING"))).otherwise(c("coord_source")), "coord_precision": F.when(placed, F.coalesce("coord_precision", F.lit("UNSPECIFIED"))).otherwise(c("coord_precision")),
    })


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(json): one raw record a line."""
    return spark.read.text(path).select(c("value").alias("json"))


def union_sources(*tables: DataFrame) -> DataFrame:
    """All sources' listings in one table; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def with_row_ids(df: DataFrame, *order: str) -> DataFrame:
    """An explicit row order, which ties are broken by: by source and place in it."""
    from ..operators.ranking import numbered

    return numbered(df, [], [c(k).asc_nulls_last() for k in order], "row_id")


#: Readers by name: a table, or a portals.Run with its statement.
SOURCES: dict[str, Callable[..., DataFrame | portals.Run]] = {"manual": read_manual, "records": read_records} | {
    "urbania": partial(portals.portal, "urbania"), "adondevivir": partial(portals.portal, "adondevivir"), "mercadolibre": partial(portals.market, "mercadolibre"),
}


def collect(name: str, *args, **kwargs) -> DataFrame | portals.Run:
    if name not in SOURCES:
        raise ValueError(f"unknown source {name!r}; known: {', '.join(sorted(SOURCES))}")
    return SOURCES[name](*args, **kwargs)


def flat(df: DataFrame) -> DataFrame:
    """Arrays as JSON text, for formats without them."""
    return df.select(*[F.to_json(k).alias(k) if isinstance(df.schema[k].dataType, (T.ArrayType, T.MapType, T.StructType)) else c(k) for k in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").option("header", True).csv(path)


def write_ranked(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    write_csv(df.select(*[k for k in df.columns if k not in ARRAYS]), f"{path}/csv")


def write_raw(df: DataFrame, path: str, run: str) -> None:
    """Raw records by source and run; earlier runs stay."""
    df.withColumn("run", F.lit(run)).write.mode("append").partitionBy("source", "run").json(path)


def log(spark: SparkSession, path: str, run: str, lines: list[str]) -> None:
    """Append to the run log."""
    spark.createDataFrame([(run, n, x) for n, x in enumerate(lines)], "run string, seq int, line string").coalesce(1).write.mode("append").parquet(path)
