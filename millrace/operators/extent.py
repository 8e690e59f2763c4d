"""How far apart the points of a group are: the greatest distance on the sphere, by convex hulls that merge.

The two points furthest apart are corners of the group's convex hull, and the hull of a union is that of the hulls' corners.
So big groups are cut into parts of PART points at most, each part is reduced to its corners, and so on until a group fits
a part or nothing is left to drop. Hulls are taken on the gnomonic plane around a part's middle, where great circles are
straight lines, so they are those of the sphere; a part that reaches over a quarter of the globe is kept as it is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_M, haversine
from .components import cut

PART, HANDFUL = 1000, 16


def corners(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Places of the hull's corners. A point that rounding puts a hair inside an edge stays."""
    if len(lat) < 4:
        return np.arange(len(lat))
    p, q = np.radians(lat), np.radians(lon)
    unit = np.stack([np.cos(p) * np.cos(q), np.cos(p) * np.sin(q), np.sin(p)], axis=1)
    middle = unit.mean(axis=0)
    middle /= np.linalg.norm(middle) or 1.0
    height = unit @ middle
    if height.min() <= 1e-6:
        return np.arange(len(lat))
    east = np.cross([0.0, 0.0, 1.0], middle) if abs(middle[2]) < 0.9 else np.cross([1.0, 0.0, 0.0], middle)
    east /= np.linalg.norm(east)
    x, y = unit @ east / height, unit @ np.cross(middle, east) / height
    order = np.lexsort((y, x)).tolist()
    slack = 1e-13 * max(np.ptp(x), np.ptp(y), 1e-300) ** 2
    kept: set[int] = set()
    for turn in (order, order[::-1]):
        chain: list[int] = []
        for k in turn:
            while len(chain) > 1 and (x[chain[-1]] - x[chain[-2]]) * (y[k] - y[chain[-2]]) - (y[chain[-1]] - y[chain[-2]]) * (x[k] - x[chain[-2]]) < -slack:
                chain.pop()
            chain.append(k)
        kept.update(chain)
    return np.array(sorted(kept))


def greatest(lat: np.ndarray, lon: np.ndarray) -> float:
    """The greatest distance of any two points, in metres; row by row, so memory stays linear."""
    p, q, best = np.radians(lat), np.radians(lon), 0.0
    for k in range(len(p) - 1):
        h = np.sin((p[k + 1 :] - p[k]) / 2) ** 2 + np.cos(p[k]) * np.cos(p[k + 1 :]) * np.sin((q[k + 1 :] - q[k]) / 2) ** 2
        best = max(best, float(h.max()))
    return 2 * EARTH_M * float(np.arcsin(np.sqrt(min(best, 1.0))))


def _kept(group: pd.DataFrame) -> pd.DataFrame:
    return group.iloc[corners(group["lat"].to_numpy(), group["lon"].to_numpy())]


def spreads(points: DataFrame, key: str, lat: str, lon: str, part: int = PART) -> DataFrame:
    """(key, spread): metres between the two points of each key that are furthest apart; 0 for one point, no row for none."""
    rows = cut(points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(key).alias("key"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")).distinct())
    kind = rows.schema.simpleString()[len("struct<") : -1]
    while True:
        sizes = cut(rows.groupBy("key").agg(F.count("*").alias("n")))
        big = sizes.where(F.col("n") > part)
        before = big.agg(F.sum("n")).first()[0]
        if not before:
            break
        # Parts are told by a hash of the point, so those of a hot group are spread over all tasks.
        parted = rows.join(big.withColumnRenamed("key", "__key"), F.col("key").eqNullSafe(F.col("__key"))).drop("__key")
        parted = parted.withColumn("part", F.pmod(F.xxhash64("lat", "lon"), F.ceil(F.col("n") / part))).drop("n")
        less = parted.groupBy("key", "part").applyInPandas(lambda g: _kept(g)[["key", "lat", "lon"]], kind)
        rest = rows.join(big.withColumnRenamed("key", "__key"), F.col("key").eqNullSafe(F.col("__key")), "left_anti")
        rows = cut(rest.union(less))
        if rows.count() > 0.9 * before + sizes.agg(F.sum("n")).first()[0] - before:
            break
    # Groups of a handful, which most are, stay in the JVM: all their pairs at once.
    handful = sizes.where(F.col("n") <= HANDFUL).select(F.col("key").alias("__key"))
    same = F.col("key").eqNullSafe(F.col("__key"))
    point = F.struct("lat", "lon")
    pairs = F.transform("p", lambda a: F.array_max(F.transform("p", lambda b: haversine(a["lat"], a["lon"], b["lat"], b["lon"]))))
    small = rows.join(handful, same, "left_semi").groupBy("key").agg(F.collect_list(point).alias("p")).select("key", F.array_max(pairs).alias("spread"))
    rest = rows.join(handful, same, "left_anti").groupBy("key").applyInPandas(lambda g: pd.DataFrame({"key": g["key"].iloc[:1], "spread": [greatest(*(_kept(g)[c].to_numpy() for c in ("lat", "lon")))]}), f"key {rows.schema['key'].dataType.simpleString()}, spread double")
    return small.union(rest).withColumnRenamed("key", key)
