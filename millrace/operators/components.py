"""Connected components of an edge table (a, b) by star contraction."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .spread import spread


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Where it is unset, a local session makes a temporary folder; on a cluster that
    is an error, as executors would not see it."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: what lost executors held is still there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` as Parquet under ``folder``. Unlike a checkpoint it brings no constraints along, which would pile up from round to round."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def removed(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id that each end of an edge can reach; ends that are null join nothing.

    Large stars and small stars in turn (Kiveris and others, 2014). A large star ties each node's greater neighbours to the
    least of all its neighbours; a small star ties its lesser neighbours, and itself, to the least of them. Each keeps what is
    connected, and edges never become more; when nothing changes, every edge leads to its root. A chain takes rounds by the
    logarithm of its length. A node of very many edges meets its least neighbour by ``spread``, in as many tasks as its
    edges need, so no task holds a hub or a component.
    """
    spark = edges.sparkSession
    folder, turn = f"{shared_dir(spark)}/components-{uuid.uuid4().hex}", 0
    known = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    pairs = cut(known.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct())
    loops = pairs.where(F.col("high") == F.col("low")).select(F.col("low").alias("id"))
    stars = pairs.where(F.col("high") != F.col("low"))
    seen = _digest(stars)
    while seen[0]:
        at = f"{folder}/{turn}"
        both = stars.select(F.col("high").alias("node"), F.col("low").alias("other")).union(stars.select("low", "high"))
        # Edges whose lower end is the node are dealt to it; the least is taken over all of its edges.
        least = written(both.groupBy("node").agg(F.min("other").alias("least"), F.count(F.when(F.col("other") > F.col("node"), 1)).alias("n")).where(F.col("n") > 0), at, "1")
        large = written(spread(stars.withColumnRenamed("low", "node"), least, ["node"], ["high"]).select("high", F.least("least", "node").alias("low")).distinct(), at, "2")
        least = written(large.groupBy("high").agg(F.min("low").alias("least"), F.count("*").alias("n")), at, "3")
        small = spread(large, least, ["high"], ["low"]).where(F.col("low") != F.col("least")).select(F.col("low").alias("high"), F.col("least").alias("low"))
        stars = written(small.union(least.select("high", F.col("least").alias("low"))).distinct(), at, "4")
        now = _digest(stars)
        if turn:
            removed(spark, f"{folder}/{turn - 1}")
        turn += 1
        if now == seen:
            break
        seen = now
    stars = cut(stars)
    removed(spark, folder)
    roots = stars.select(F.col("low").alias("id")).union(loops).distinct().join(stars.select(F.col("high").alias("id")), "id", "left_anti")
    return stars.select(F.col("high").alias("id"), F.col("low").alias("root")).union(roots.select("id", F.col("id").alias("root")))


def _digest(stars: DataFrame) -> tuple:
    """The number of edges and a sum over all of them; two tables of one round to the next agree only if nothing changed."""
    return tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())
