"""Language identification by unigram pieces, summed over all segmentations.

The pieces are the tokens of a fixed public byte-level vocabulary. Each language has a probability for each piece;
a word's probability is the sum over all ways to cut it into pieces (forward algorithm), a text's the product over
its words, runs of letters of any length. Piece probabilities are fitted by expectation-maximisation, each language in a task of its own, on a
bounded sample of labelled texts, whose bounds are the parameters of ``learn``: about ``sample_rows`` texts of each language,
drawn by a hash of their id, and of those the ``sample_words`` most frequent words. Every language with a labelled row
that holds a letter is learned. The model's size is the vocabulary's times the number of languages.

Every text is scored whole. A null text, or one with no letter, is ``und`` with score 0. Score: the posterior of the
language, tempered by the number of words, 0 to 1. With nothing to learn from every text is ``und``. Ties go to the
language that sorts first. Null languages teach nothing. Repeated rows teach as often as they occur and are scored
alike; null ids are drawn together; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import parse_ranks, vocabulary
from .common import MOST_HOT, cut, map_rows, spread, text_batches

SAMPLE_ROWS, SAMPLE_WORDS, ROUNDS, SMOOTH = 400, 20_000, 2, 0.05
UND = "und"
#: Words remembered; letters of a run that are fitted in one go; expected occurrences of a piece that the model keeps.
MEMO, PART, USED = 200_000, 24, 0.5
_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str) -> list[str]:
    """Maximal runs of letters. The pattern also takes signs that are numbers, so what isn't all letters is cut again."""
    found = _WORD.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return [run for w in found for run in "".join(x if x.isalpha() else " " for x in w).split()]


class Model:
    """Pieces as a trie over bytes, and their probabilities in each language."""

    def __init__(self, languages: list[str], pieces: list[bytes], weights: np.ndarray):
        """weights: (pieces, languages), none of them 0."""
        self.languages = languages
        steps: dict[tuple[int, int], int] = {}
        ends = {}
        for k, piece in enumerate(pieces):
            node = 0
            for byte in piece:
                node = steps.setdefault((node, byte), len(steps) + 1)
            ends[node] = k
        # Node 0 is the root, and also where no path goes on: from it nothing starts in the middle of a walk.
        self.next = np.zeros((len(steps) + 1, 256), np.int32)
        for (node, byte), to in steps.items():
            self.next[node, byte] = to
        self.weights = np.zeros((len(steps) + 1, len(languages)))
        for node, k in ends.items():
            self.weights[node] = weights[k]
        self.most = max(map(len, pieces))

    def forward(self, words: list[bytes]) -> np.ndarray:
        """(words, languages): log of the summed probability of all segmentations, the words of a length side by side.

        Only the sums that a piece can still reach are kept, and they are scaled up when they get small, so words may
        have any length.
        """
        out = np.zeros((len(words), len(self.languages)))
        by_length: dict[int, list[int]] = defaultdict(list)
        for k, word in enumerate(words):
            by_length[len(word)].append(k)
        for n, places in by_length.items():
            data = np.frombuffer(b"".join(words[k] for k in places), np.uint8).reshape(len(places), n)
            ring = min(n, self.most) + 1
            sums = np.zeros((ring, len(places), len(self.languages)))
            sums[0] = 1.0
            logs = np.zeros((len(places), len(self.languages)))
            for start in range(n):
                here = sums[start % ring].copy()
                sums[start % ring] = 0.0
                if start % 8 == 7:
                    scale = np.where(here < 1e-60, 1 / np.maximum(here, 1e-290), 1.0)
                    here *= scale
                    sums *= scale
                    logs -= np.log(scale)
                node = self.next[0, data[:, start]]
                rows = None
                for end in range(start + 1, min(n, start + self.most) + 1):
                    if rows is None:
                        sums[end % ring] += here * self.weights[node]
                    else:
                        sums[end % ring, rows] += here[rows] * self.weights[node]
                    if end == n:
                        break
                    node = self.next[node, data[:, end] if rows is None else data[rows, end]]
                    alive = np.nonzero(node)[0]
                    if not len(alive):
                        break
                    if len(alive) < len(node):
                        rows, node = alive if rows is None else rows[alive], node[alive]
            out[places] = np.log(np.maximum(sums[n % ring], 1e-300)) + logs
        return out

    def words(self, words: list[str]) -> np.ndarray:
        return self.forward([b" " + w.encode("utf-8", "surrogatepass") for w in words])


def fit_pieces(words: list[tuple[str, int]], pieces: dict[bytes, int], rounds: int = ROUNDS) -> np.ndarray:
    """Expected occurrences of each piece after EM over the segmentation lattices of words and their counts.

    A very long run of letters is fitted in parts of PART letters.
    """
    parts: dict[bytes, int] = defaultdict(int)
    for word, n in words:
        for at in range(0, len(word), PART):
            parts[(b"" if at else b" ") + word[at : at + PART].encode("utf-8", "surrogatepass")] += n
    most = max(map(len, pieces))
    groups: dict[int, list[bytes]] = defaultdict(list)
    for part in sorted(parts):
        groups[len(part)].append(part)
    lattices = []
    for n, found in groups.items():
        arcs: dict[tuple[int, int], tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))
        for k, part in enumerate(found):
            for start in range(n):
                for end in range(start + 1, min(n, start + most) + 1):
                    piece = pieces.get(part[start:end])
                    if piece is not None:
                        rows, ids = arcs[start, end]
                        rows.append(k)
                        ids.append(piece)
        ordered = [(start, end, np.array(rows), np.array(ids)) for (start, end), (rows, ids) in sorted(arcs.items())]
        lattices.append((n, np.array([parts[p] for p in found], float), ordered))
    p = np.full(len(pieces), 1.0 / len(pieces))
    expected = p
    for _ in range(rounds):
        expected = np.full(len(pieces), SMOOTH)
        for n, counts, arcs in lattices:
            alpha, beta = np.zeros((n + 1, len(counts))), np.zeros((n + 1, len(counts)))
            alpha[0] = beta[n] = 1.0
            for start, end, rows, ids in arcs:
                alpha[end, rows] += alpha[start, rows] * p[ids]
            for start, end, rows, ids in reversed(arcs):
                beta[start, rows] += p[ids] * beta[end, rows]
            share = np.divide(counts, alpha[n], out=np.zeros_like(counts), where=alpha[n] > 0)
            for start, end, rows, ids in arcs:
                expected += np.bincount(ids, alpha[start, rows] * p[ids] * beta[end, rows] * share[rows], len(pieces))
        p = expected / expected.sum()
    return expected


def training_rows(key: Column) -> Column:
    """The contract's split: rows that may teach."""
    return F.crc32(key.cast("string")) % 3 != 1


def learn(rows: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS, sample_words: int = SAMPLE_WORDS) -> Model | None:
    """Fit on the sample that the module's text describes; None if no labelled row holds a letter."""
    labelled = rows.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    scale = 1 << 24
    share = cut(labelled.groupBy("lang").agg(F.count("*").alias("n"), F.least(F.lit(scale), F.ceil(F.lit(float(sample_rows * scale)) / F.count("*"))).alias("share")))
    # Texts stay where they are as long as the languages are few; else a frequent language is dealt to several tasks.
    rated = labelled.join(F.broadcast(share), "lang") if share.count() <= MOST_HOT else spread(labelled, share, ["lang"], ["key"])
    sample = rated.where(F.pmod(F.xxhash64("key"), F.lit(scale)) < F.col("share"))
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    best = words.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("place") <= sample_words)
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary()[0])
    schema = "lang string, pieces array<int>, weights array<double>, rest double"

    def each(found: pa.Table) -> pa.Table:
        names = {b: k for k, b in enumerate(sorted(parse_ranks(shared.value)))}
        columns = found.to_pydict()
        expected = fit_pieces(list(zip(columns["word"], columns["n"], strict=True)), names)
        used = np.nonzero(expected > USED)[0]
        total = expected.sum()
        return pa.table({"lang": columns["lang"][:1], "pieces": [used.tolist()], "weights": [(expected[used] / total).tolist()], "rest": [SMOOTH / total]}, schema=pa.schema([("lang", pa.string()), ("pieces", pa.list_(pa.int32())), ("weights", pa.list_(pa.float64())), ("rest", pa.float64())]))

    # One row for each language, of the vocabulary's size at most.
    fitted = best.select("lang", "word", "n").groupBy("lang").applyInArrow(each, schema).orderBy("lang").collect()
    if not fitted:
        return None
    names = sorted(parse_ranks(vocabulary()[0]))
    kept = sorted({k for r in fitted for k in r["pieces"]} | {k for k, name in enumerate(names) if len(name) == 1})
    place = {k: n for n, k in enumerate(kept)}
    weights = np.repeat([[r["rest"] for r in fitted]], len(kept), axis=0)
    for n, r in enumerate(fitted):
        weights[[place[k] for k in r["pieces"]], n] = r["weights"]
    return Model([r["lang"] for r in fitted], [names[k] for k in kept], weights)


class Scorer:
    """Texts of a batch at a time. Words' probabilities are remembered until there are more than MEMO."""

    def __init__(self, model: Model):
        self.model, self.memo, self.table = model, {}, np.zeros((0, len(model.languages)))

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        split = [letters((t or "").lower()) for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
            self.table = self.table[:0]
        new = list(set(chain.from_iterable(split)).difference(self.memo))
        if new:
            self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new)), strict=True))
            self.table = np.concatenate([self.table, self.model.words(new)])
        get, out = self.memo.__getitem__, []
        for words in split:
            if not words:
                out.append((UND, 0.0))
                continue
            total = self.table[np.fromiter(map(get, words), np.int64, len(words))].sum(axis=0)
            best = int(np.argmax(total))
            # Tempered: a long text's words are not independent, so evidence counts as the square root of their number.
            tempered = (total - total[best]) / math.sqrt(len(words))
            out.append((self.model.languages[best], float(1.0 / np.exp(np.maximum(tempered, -700)).sum())))
        return out


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, lang_pred, score) for every row, and the columns in ``carry``; the text alone decides."""
    text_batches(docs.sparkSession)
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *(c for c in carry if c != text))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value) if shared.value else None

        def each(x: dict[str, list]) -> dict[str, list]:
            found = scorer.score(x["text"]) if scorer else [(UND, 0.0)] * len(x["text"])
            return {"doc_id": x["doc_id"], "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

        return each

    return map_rows(source, "doc_id long, lang_pred string, score double", make, carry)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(training_rows(F.col("doc_id"))).select("doc_id", "text", "lang"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out")
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held, "lang_pred", "score")
