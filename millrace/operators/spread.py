"""A join that no key can overload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key that one task may take in any case, and the most keys that can be called hot.
LEAST_HOT, MOST_HOT = 1000, 100_000


def spread(rows: DataFrame, classes: DataFrame, key: list[str], by: list[str], how: str = "inner", n: str = "n", sizes: DataFrame | None = None, salted: bool = False) -> DataFrame:
    """``rows`` joined with ``classes``, which has one row for each key and in ``n`` the number of its rows.

    If ``classes`` has several rows for a key, ``sizes`` has the one with ``n``, and ``n`` may be part of both.

    A key with more rows than ``limit`` is dealt to several tasks: its rows are numbered by a hash of ``by``, its class is
    written once for each number. With ``limit`` at a MOST_HOT-th of all rows at least, there can't be more than MOST_HOT
    such keys, which bounds the broadcast of them. ``classes`` should be a written table, as it is read three times.
    ``salted`` keeps the number as ``__salt``: rows lie together by the key with it.
    """
    sizes = classes if sizes is None else sizes
    total = sizes.agg(F.sum(n)).first()[0] or 0
    limit = max(LEAST_HOT, -(-total // MOST_HOT))
    parts = F.ceil(F.col(n) / F.lit(limit)).cast("int")
    hot = sizes.where(F.col(n) > limit).select(*key, parts.alias("__parts"))
    salt = F.when(F.col("__parts").isNotNull(), F.pmod(F.xxhash64(F.lit("salt"), *by), F.col("__parts"))).otherwise(F.lit(0)).cast("int")
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("__salt", salt).drop("__parts")
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col(n) > limit, parts - 1).otherwise(F.lit(0))))
    return dealt.join(classes.withColumn("__salt", copies), [*key, "__salt"], how).drop(*([] if salted else ["__salt"]))
