"""How five filters interact: what each removes at each place of every order, alone, and as a share of all orders.

A relational pipeline. Words are exploded and counted by (document, word), then by document, which gives totals and
distinct words; the outer join with the other flags gives each document a mask of the filters it fails; 32 conditional
counts, one for each mask, hold all that any order of the filters can tell. DataFrame functions only.

Failures. A: fewer than 100 words. B: distinct words below 80 % of all. C: A to Z above 10 % of the code points. D: holds one
of ``#$%&*|``. E: the text is that of a row with a smaller id, anywhere in the table, compared by SHA-256.

Null text counts as empty: no words, so A alone fails (and E). Whole texts are read, however long: a text's words are rows, so
they are spilled like any rows. A null id is neither smaller than another nor labelled; rows repeated as a whole, or
texts with the same id, each count, and none of two with one id is the smaller. A null language is the part "". Several
labels of one id: any quality or toxic mark of 1 counts; labels of no row are left out. An empty table gives no rows. Other
columns aren't read, whatever their names.

The explode needs one exchange, of texts by row, behind which both word counts are local. The other exchanges carry a few
numbers for each document, folded before they are sent. Joins by text digest and by id go through ``spread``, so a group
of copies or an id that holds a third of the rows is dealt to many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, keyed_digest, keyed_id, spread

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
#: What is between words, and what D looks for.
SPACE, MARKS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"
#: A, B and C: words at least, percent of distinct words at least, percent of capitals at most.
WORDS, DISTINCT, CAPITALS = 100, 80, 10


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, dg, words, distinct_words) for each row key of ``keyed_id`` and ``keyed_digest`` with any word."""
    rows = docs.select(keyed_id(key, text).alias("k"), keyed_digest(text).alias("dg"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    # A number for each row: rows with one key keep their words apart, and no two of them have to meet in a task.
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartition("row")
    words = dealt.select("row", "k", "dg", F.explode(F.split("text", SPACE)).alias("word")).where(F.col("word") != "")
    by_word = words.groupBy("row", "k", "dg", "word").agg(F.count("*").alias("n"))
    by_row = by_word.groupBy("row", "k", "dg").agg(F.sum("n").alias("words"), F.count("*").alias("distinct_words"))
    return by_row.groupBy("k", "dg").agg(F.max("words").alias("words"), F.max("distinct_words").alias("distinct_words"))


def failures(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, n): rows by part, filters failed (A is bit 0) and labels, folded as far as keys allow."""
    value = F.coalesce(F.col(text), F.lit(""))
    capitals = F.length(value) - F.length(F.regexp_replace(value, "[A-Z]+", ""))
    facts = {
        "id": F.col(key).cast("long"), "k": keyed_id(key, text), "dg": keyed_digest(text), "sha": F.unhex(F.sha2(value, 256)), "part": F.coalesce(F.col(lang).cast("string"), F.lit("")),
        "c": 100 * capitals > CAPITALS * F.length(value), "d": value.rlike(MARKS),
    }
    light = cut(docs.select(*[v.alias(k) for k, v in facts.items()]).groupBy(*facts).agg(F.count("*").alias("rows")))
    # E: only texts of several light rows need to know their smallest id.
    first = cut(light.groupBy("sha").agg(F.count("*").alias("n"), F.min("id").alias("first")).where(F.col("n") > 1))
    found = spread(light, first, ["sha"], ["k"], "left").drop("n")
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("k")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    known = cut(marked.join(light.groupBy("k").agg(F.count("*").alias("n")), "k"))
    found = spread(found, known, ["k"], ["dg", "part"], "left").drop("n")
    found = found.join(word_counts(docs, key, text), ["k", "dg"], "left")
    words, distinct = (F.coalesce(F.col(c), F.lit(0)) for c in ("words", "distinct_words"))
    yes = lambda x: F.coalesce(x, F.lit(False))
    fails = [words < WORDS, 100 * distinct < DISTINCT * words, F.col("c"), F.col("d"), yes(F.col("id") > F.col("first"))]
    mask = sum((F.when(f, 1 << bit).otherwise(0) for bit, f in enumerate(fails)), F.lit(0))
    labelled = lambda name: yes(F.col("id").isNotNull() & F.col(name))
    return found.select("part", mask.alias("mask"), labelled("good").alias("good"), labelled("toxic").alias("toxic"), F.col("rows").alias("n"))


def by_mask(failed: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) from 32 conditional counts for each part and pair of labels."""
    counts = [F.sum(F.when(F.col("mask") == m, F.col("n")).otherwise(0)).alias(f"m{m}") for m in range(MASKS)]
    wide = failed.groupBy("part", "good", "toxic").agg(*counts)
    cells = wide.select("part", "good", "toxic", F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), F.col(f"m{m}").alias("n")) for m in range(MASKS)])).alias("cell")).select("part", "good", "toxic", "cell.*")
    only = lambda label: F.sum(F.when(F.col(label), F.col("n")).otherwise(0)).alias(label)
    return cells.groupBy("part", "mask").agg(F.sum("n").alias("n"), only("good"), only("toxic"))


def _bits(letters: Column) -> Column:
    return sum((F.when(letters.contains(c), 1 << bit).otherwise(0) for bit, c in enumerate(FILTERS)), F.lit(0))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley), 600 rows a part."""
    from itertools import permutations

    orders = F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)])
    cells = by_mask(failures(docs, labels, key, text, lang))
    steps = cells.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    order, step, mask, n = (F.col(c) for c in ("filter_order", "step", "mask", "n"))
    steps = steps.withColumns({"own": _bits(order.substr(step, F.lit(1))), "before": _bits(order.substr(F.lit(1), step - 1))})
    earlier, fails = mask.bitwiseAND(F.col("before")) != 0, mask.bitwiseAND(F.col("own")) != 0
    removed = fails & ~earlier
    total = lambda condition, value: F.sum(F.when(condition, value).otherwise(0)).cast("long")
    # Of the 120 orders, those in which a document's filter comes before its other failing ones are equally many for each.
    share = n * F.floor(F.lit(120) / F.greatest(F.bit_count("mask"), F.lit(1)))
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier, n).alias("kept"), total(removed, n).alias("removed"), total(fails & earlier, n).alias("redundant"), total(mask == F.col("own"), n).alias("unique_fails"),
        total(removed, F.col("good")).alias("good_lost"), total(removed, F.col("toxic")).alias("toxic_lost"), total(fails, share).alias("shapley"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(string_split_regex(t, '{SPACE}')) AS word FROM d) WHERE word <> '' GROUP BY 1, 2),
s AS (SELECT r, sum(n) AS words, count(*) AS different FROM w GROUP BY 1),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  coalesce(words, 0) < {WORDS} AS a, 100 * coalesce(different, 0) < {DISTINCT} * coalesce(words, 0) AS b, 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {CAPITALS} * length(t) AS c,
  regexp_matches(t, '{MARKS}') AS d, coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e FROM d LEFT JOIN s ON s.r = d.r LEFT JOIN l ON l.doc_id = d.doc_id),
m AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(c, bit)),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM x a, x b, x c, x d, x e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
q AS (SELECT filter_order, step::INT AS step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, range(1, 6) g(step)),
p AS (SELECT part, filter_order, step, own, before, mask, n, good, toxic FROM m, q)
SELECT part, filter_order, step, sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
  sum(CASE WHEN mask & own <> 0 THEN n * 120 // bit_count(mask) ELSE 0 END)::BIGINT AS shapley
FROM p GROUP BY 1, 2, 3
"""
