"""Best-two-fit packing of tokenised documents into sequences of one length.

A bin is filled greedily: the longest unpacked piece that fits, again and again. If room is left, its smallest piece is
replaced with two unpacked pieces, if any two fit the expanded gap more tightly. Only lengths matter to this, and there are
``CAPACITY`` different ones at most, so bins are planned over the counts of lengths: one fill stands for as many equal bins as
the counts allow, and each plan uses up a length. Plans are the only thing the driver makes, a few thousand whatever the
corpus. Pieces are then numbered by length over all tasks and look their bin up by number, so one global packing comes out
of a sort of light rows, with no bin, group or task ever holding more than its share.

Null and empty texts are the end token alone. Texts over the capacity are cut into full pieces and a rest; whole texts are
tokenised, however long. Ids may be null or repeated and rows may be repeated: each row's pieces are rows of their own, and
pieces of equal length are told apart by their place in the written pieces. An empty table gives no rows. Other columns
aren't read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import numbered
from .byte_bpe import Memo
from .common import cut, map_rows, text_batches

VOCABULARY, CAPACITY, END = "word_bpe_49k.json", 4096, 1
#: A slot: pieces of one length in one plan: the number of its first piece, its first bin, pieces a bin, offset, length.
Slot = tuple[int, int, int, int, int]


#: Parts of these characters only: the tokenizer's normalizer changes nothing in them but case, and its pieces are found by ``PIECE``.
PLAIN = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
PIECE = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")
#: Byte-level letters of bytes: printable ones stand for themselves, the others follow in order from 256.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
LETTERS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}
#: What a special token of the vocabulary holds; parts with it are left to the tokenizer.
SPECIAL = "<|"


class Tokens:
    """Bytes of the 32-bit ids of parts between ASCII white space, remembered; the tokenizer never joins such parts.

    Plain parts are cut here and only their pieces go to the tokenizer's model; all others go through the whole tokenizer.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model = self.tokenizer.model.tokenize
        self.parts = Memo(self._part)

    def _part(self, part: bytes) -> bytes:
        text = part.decode()
        if PLAIN.fullmatch(text) is None or SPECIAL in text:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        elif part.isalpha():
            ids = [token.id for token in self.model(text.lower())]
        else:
            pieces = [piece if piece.isascii() else piece.encode().decode("latin-1").translate(LETTERS) for piece in PIECE.findall(text.lower())]
            ids = [token.id for piece in pieces for token in self.model(piece)]
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, text.encode().split()))


@lru_cache(maxsize=2)
def tokens(vocabulary: str) -> Tokens:
    return Tokens(vocabulary)


def vocabulary(path: str | None = None) -> str:
    """The tokenizer's file (a few megabytes, whatever the corpus), read on the driver."""
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        return f.read()


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end: int = END, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row, and with ``ids`` the piece's ids as little-endian bytes."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    last, width = np.array([end], "<u4").tobytes(), 4 * capacity
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long" + (", ids binary" if ids else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def make():
        encoder = tokens(shared.value)

        def each(x: dict[str, list]) -> dict[str, list]:
            rows = []
            for doc_id, value in zip(x["doc_id"], x["text"], strict=True):
                whole = encoder.encode(value or "") + last
                for k, at in enumerate(range(0, len(whole), width)):
                    part = whole[at : at + width]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part)[: len(names)])
            return dict(zip(names, [list(c) for c in zip(*rows, strict=True)] or [[] for _ in names], strict=True))

        return each

    return map_rows(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), schema, make)


def two_that_fit(left: dict[int, int], lengths: list[int], room: int, above: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the greatest sum up to ``room``, if it exceeds ``above``; of equals those with the longest piece."""
    known = np.array(lengths[: bisect_right(lengths, room - 1)])
    if not len(known):
        return None
    single = np.array([left[k] < 2 for k in known.tolist()])
    at = np.searchsorted(known, np.minimum(room - known, known), "right") - 1
    at = np.where((at >= 0) & (known[at] == known) & single, at - 1, at)
    total = np.where(at >= 0, known + known[at], 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(known[best]), int(known[at[best]])) if total[best] > above else None


def fill(counts: dict[int, int], lengths: list[int], capacity: int) -> tuple[dict[int, int], int]:
    """One bin as length -> pieces, and how many such bins follow each other. ``lengths`` is sorted and all of ``counts`` > 0."""
    bin_: dict[int, int] = {}
    gap, top = capacity, len(lengths)
    while top := bisect_right(lengths, gap, 0, top):
        length = lengths[top - 1]
        n = min(counts[length], gap // length)
        bin_[length] = n
        gap -= n * length
        top -= 1
    spare, smallest = None, min(bin_)
    if gap:
        spare = smallest
        left = {k: counts[k] - bin_.get(k, 0) for k in lengths}
        pair = two_that_fit(left, [k for k in lengths if left[k]], gap + smallest, smallest)
        if pair:
            bin_[smallest] -= 1
            for k in pair:
                bin_[k] = bin_.get(k, 0) + 1
            bin_ = {k: n for k, n in bin_.items() if n}
    # As long as a length has a piece more than the greedy fill takes, the next bin comes out the same.
    times = min((counts[k] - (k == spare)) // n for k, n in bin_.items())
    return bin_, max(1, times)


def plan(sizes: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Slot], int]:
    """Slots for ``sizes`` (length -> pieces), sorted by their first piece's number, and the number of bins."""
    counts = {k: n for k, n in sizes.items() if n}
    lengths, taken, slots, bins = sorted(counts), dict.fromkeys(counts, 0), [], 0
    first = dict(zip(lengths, np.cumsum([0, *[counts[k] for k in lengths]]).tolist(), strict=False))
    while lengths:
        bin_, times = fill(counts, lengths, capacity)
        offset = 0
        for length, n in sorted(bin_.items(), reverse=True):
            slots.append((first[length] + taken[length], bins, n, offset, length))
            offset += n * length
            taken[length] += n * times
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
                del lengths[bisect_right(lengths, length) - 1]
        bins += times
    return sorted(slots), bins


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut_pieces`` (written, with an int ``length``) with sequence_id and offset (long)."""
    sizes = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    slots, _ = plan(sizes, capacity)
    # Bounded by the plans: two for a length at most, each of fewer than 91 different lengths (1 + 2 + ... + 91 > 4096).
    shared = cut_pieces.sparkSession.sparkContext.broadcast(np.array(slots or [(0, 0, 1, 0, 0)], np.int64).T.copy())

    @F.pandas_udf(T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    def place(number: pd.Series) -> pd.DataFrame:
        starts, bins, uses, offsets, lengths = shared.value
        at = np.searchsorted(starts, number.to_numpy(), "right") - 1
        bin_, turn = np.divmod(number.to_numpy() - starts[at], uses[at])
        return pd.DataFrame({"sequence_id": bins[at] + bin_, "offset": offsets[at] + turn * lengths[at]})

    names = cut_pieces.columns
    rows = cut_pieces.withColumn("__row", F.monotonically_increasing_id())
    placed = numbered(rows, [], [F.col("length").asc(), F.col("__row").asc()], "__place").withColumn("__at", place(F.col("__place") - 1))
    return placed.select(*names, "__at.sequence_id", "__at.offset")


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its place there. Pieces are written first, so no text is tokenised twice."""
    return pack(cut(pieces(docs, key, text, path, capacity, ids=ids)), capacity)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return packed(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32", "sequence_id", "offset")


def brute(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Best-two-fit bin by bin over single pieces; for tests."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        chosen: list[int] = []
        for k in list(left):
            if k <= capacity - sum(chosen):
                chosen.append(k)
                left.remove(k)
        room = capacity - sum(chosen) + chosen[-1]
        if room > chosen[-1]:
            pairs = [(a + b, a, b) for n, a in enumerate(left) for b in left[n + 1 :] if chosen[-1] < a + b <= room]
            if pairs:
                _, a, b = max(pairs)
                left.append(chosen.pop())
                for k in (a, b):
                    chosen.append(k)
                    left.remove(k)
                left.sort(reverse=True)
        out.append(sorted(chosen, reverse=True))
    return out
