"""From raw documents to token ids: five stages, each written as Parquet and read again as the next one's input.

Null and empty texts, and texts without letters, have no language and go in the first stage, so later ones see text only; a text
of which every line is boilerplate stays as an empty one. Null languages and sources are allowed, and a null source is a
host of its own. Ids may be null or repeated: rows are told apart by id and text, and rows repeated as a whole are kept or
dropped together, except that near-duplicates keep the rows of the smallest id. Ties go to the smaller id. Whole texts pass
through every stage, however long. An empty table gives no rows. Columns other than those of ``documents`` end in the first
stage, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, decontaminate, language_id, line_dedup, minhash
from millrace.llm.common import shared_dir, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found go; the others carry the language that was found."""
    model = language_id.learn(docs.where(language_id.training_rows(F.col("doc_id"))).select("doc_id", "text", "lang"))
    found = language_id.predict(docs, model, carry=("text", "source", "n_chars"))
    return found.where(F.col("lang_pred") != language_id.UND).select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; every document stays."""
    return line_dedup.dedup_lines(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near-duplicates stays."""
    return minhash.deduplicated(docs).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule names go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    return byte_bpe.tokenised(docs)


STAGES = [("language_id", languages), ("line_dedup", lines), ("minhash", near_duplicates), ("decontaminate", decontaminated), ("byte_bpe", tokens)]

#: Language ID and MinHash can't be stated in SQL; the pipeline is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. A stage's folder goes when the next one has been written; the last one is read by what is returned."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{before}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
