"""Site-relative line frequency: lines that too many of a host's pages carry are boilerplate and go.

Only DataFrame functions are used. A line's frequency is (pages of the host with the line) / (pages of the host).
A page that repeats another page of its host word for word counts once, in both numbers: else a group of copies that
makes up a tenth of a host would lose its whole prose, in each copy, so that none of it were left for near-duplicate
removal, which deals with the copies themselves.

A host's boilerplate is one list, joined to the host's pages. A line in it is on more than ``ratio`` of the pages, so a list
holds fewer lines than 1 / ratio average pages do. Pages and lines of hot hosts are dealt to several tasks.

Lines are compared trimmed; blank lines never count and stay where they are. Null text stays null; an empty text
stays empty; a null host is a host of its own. Lines repeated within a page count once for it and all go together.
Rows are cleaned one by one, so ids may be null or repeated, and repeated rows are cleaned alike. An empty table gives no
rows. Other columns are passed on; those named n_lines and n_dropped are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, spread

RATIO, MIN_PAGES = 0.1, 5
#: Lists of up to this number of lines in all travel as a broadcast (24 bytes each); the same join is shuffled beyond that.
BROADCAST_LINES = 200_000


def _key(line: Column) -> Column:
    """128 bits of a trimmed line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^\s+|\s+$", "")


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, key): the lines above ``ratio`` of their host's distinct pages and on ``min_pages`` of them at least."""
    pages = docs.select(F.coalesce(F.col(host), F.lit("")).alias("host"), F.col(host).isNull().alias("none"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    # A digest first: copies fold before their lines are made, and partial sums carry digests, never texts.
    digest = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit("page"), F.col("text")).alias("b"))
    keyed = pages.select("host", "none", digest.alias("page"), F.array_distinct(F.transform(F.filter(F.transform(F.split("text", "\n"), _trimmed), lambda x: x != ""), _key)).alias("keys"))
    totals = keyed.groupBy("host", "none").agg(F.count("*").alias("pages"), F.countDistinct("page").alias("distinct_pages"))
    # Lines of copies: each (line, page digest) counts once. Frequent lines are few, so they are found by plain counts first.
    lines = keyed.select("host", "none", "page", F.explode("keys").alias("key"))
    often = lines.groupBy("host", "none", "key").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    often = cut(often.join(totals, ["host", "none"]).where(F.col("n") > ratio * F.col("distinct_pages")).select("host", "none", "key", "n", "distinct_pages"))
    exact = spread(lines, often, ["host", "none", "key"], ["page"]).groupBy("host", "none", "key", "distinct_pages", "page").agg(F.lit(1).alias("one")).groupBy("host", "none", "key").agg(F.count("*").alias("n"), F.first("distinct_pages").alias("distinct_pages"))
    return exact.where((F.col("n") >= min_pages) & (F.col("n") > ratio * F.col("distinct_pages"))).select("host", "none", "key")


def dedup_lines(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and n_lines and n_dropped (long; 0 for null text)."""
    found = boilerplate(docs, host, text, ratio, min_pages)
    lists = cut(found.groupBy(F.col("host").alias("__host"), F.col("none").alias("__none")).agg(F.collect_list("key").alias("__drop")))
    small = (lists.agg(F.sum(F.size("__drop"))).first()[0] or 0) <= broadcast_lines
    same = (F.coalesce(F.col(host), F.lit("")) == F.col("__host")) & (F.col(host).isNull() == F.col("__none"))
    joined = docs.join(F.broadcast(lists) if small else lists, same, "left").drop("__host", "__none")
    whole = F.split(text, "\n")
    kept = F.filter(whole, lambda line: ~F.coalesce(F.array_contains(F.col("__drop"), _key(_trimmed(line))), F.lit(False)))
    touched = F.col("__drop").isNotNull() & F.col(text).isNotNull()
    lines_of = F.coalesce(F.when(F.col(text).isNotNull(), F.size(whole).cast("long")), F.lit(0).cast("long"))
    out = joined.withColumn("__kept", F.when(touched, kept))
    return out.withColumns({"n_lines": lines_of, "n_dropped": F.when(touched, lines_of - F.size("__kept")).otherwise(F.lit(0)).cast("long"), text: F.when(touched, F.array_join("__kept", "\n")).otherwise(F.col(text))}).drop("__kept", "__drop")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "source", "text", "n_lines", "n_dropped")


SQL = rf"""
WITH d AS (SELECT doc_id, source, text, coalesce(source, '') AS host, source IS NULL AS nohost FROM documents),
pages AS (SELECT DISTINCT host, nohost, text FROM d WHERE text IS NOT NULL),
totals AS (SELECT host, nohost, count(*) AS pages FROM pages GROUP BY 1, 2),
lines AS (SELECT DISTINCT host, nohost, text, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line FROM (SELECT host, nohost, text, unnest(string_split(text, chr(10))) AS line FROM pages)),
often AS (SELECT l.host, l.nohost, line FROM lines l JOIN totals t ON l.host = t.host AND l.nohost = t.nohost WHERE line <> '' GROUP BY l.host, l.nohost, line, pages HAVING count(*) >= {MIN_PAGES} AND count(*) > {RATIO} * pages),
parts AS (SELECT doc_id, host, nohost, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d WHERE text IS NOT NULL),
marked AS (SELECT p.doc_id, p.line, p.pos, o.line IS NULL AS keep FROM parts p LEFT JOIN often o ON o.host = p.host AND o.nohost = p.nohost AND o.line = regexp_replace(p.line, '^\s+|\s+$', '', 'g')),
joined AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keep), '') AS text, count(*) AS n_lines, count(*) FILTER (WHERE NOT keep) AS n_dropped FROM marked GROUP BY 1)
SELECT d.doc_id, d.source, j.text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped FROM d LEFT JOIN joined j ON d.doc_id = j.doc_id
"""
