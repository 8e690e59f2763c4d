"""Periodic runs of words, and texts with their repeats collapsed.

Ellert and Fischer's way. A run's root is a Lyndon word under an order of the alphabet or under its reverse, and the longest
Lyndon word at each position ends at the next smaller suffix. So both Lyndon arrays are computed, with the length of the
match (the extension) of each suffix with its next smaller one; a match longer than the Lyndon word is a run of at least
two periods.

The array is made from left to right over a chain of previous smaller suffixes, with comparisons of letters only: no suffix
structure and no hash of a part of the text. Letters are words, named by their rank among the text's different words.
Extensions already matched are reused in two ways, so letters behind the furthest match are never compared again and a
text costs time linear in its words (sorting its different words aside):

* Within the furthest match, ``text[left:...] = text[right:reach]``, a pair of positions behaves as the pair ``right - left``
  before it, and its extension is copied; one that gets to ``reach`` goes on from there.
* Down the chain at one position, the next suffix is compared only if its known match with the one above it is exactly as
  long as that one's match with the position; otherwise the order follows without a comparison.

Null text has no words; empty texts and texts of white space have none either. Any text is read whole. A null id is
planted with no period. Rows are told by nothing but themselves, so ids may repeat and rows too. An empty table gives no
rows. Other columns aren't read. No shuffle; each text is one row of one task, a few machine words for each word of it.
"""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run counts from this many words and periods.
LEAST, PERIODS = 24, 3

Run = tuple[int, int, int]


def extensions(w: list[int]) -> list[Run]:
    """(i, p, m): where the longest Lyndon word at i has p letters and m > p letters of the suffix behind it match.

    ``w`` ends with a letter that is smaller than all others and occurs nowhere else; python's w[-1] is that letter, so
    the chain's end needs no test of its own.
    """
    up = [-1] * len(w)  # the previous smaller suffix of each position
    up_match: dict[int, int] = {}  # its match with the position, where not 0
    down_match: dict[int, int] = {}  # the match with the next smaller suffix, where not 0
    shift = right = reach = 0
    found = []
    for j in range(1, len(w)):
        x, i = w[j], j - 1
        if j >= reach:
            while w[i] > x:
                i = up[i]
            if i < 0 or w[i] < x:
                up[j] = i
                continue
        above = -1
        size = 0
        while i >= 0:
            if right <= i and j < reach:  # the pair lies in the furthest match
                twin = j - shift
                size = up_match.get(twin, 0) if up[twin] == i - shift else down_match.get(i - shift, 0)
                open_ = size >= reach - j
                if open_:
                    size = reach - j
            elif above < 0:
                open_ = True
            else:
                known = up_match.get(above, 0)
                if known < size:
                    size = known
                    break
                open_ = known == size
            if open_:
                while w[i + size] == w[j + size]:
                    size += 1
                if j + size >= reach:
                    shift, right, reach = j - i, j, j + size
            if w[i + size] < w[j + size]:
                break
            if size:
                down_match[i] = size
                if size > j - i:
                    found.append((i, j - i, size))
            above, i = i, up[i]
        up[j] = i
        if i >= 0 and size:
            up_match[j] = size
    return found


def runs(words: list[bytes], least: int = LEAST, periods: int = PERIODS) -> list[Run]:
    """(start, length, period) of all maximal runs of ``least`` words and ``periods`` (2 at least, 3 by default) periods, sorted by start and period."""
    order = {word: k for k, word in enumerate(sorted(set(words)))}
    if len(words) < least or len(order) == len(words):
        return []
    w, top = list(map(order.__getitem__, words)), len(order) - 1
    out: dict[tuple[int, int], int] = {}
    for letters in ([*w, -1], [*[top - k for k in w], -1]):
        ends: dict[int, int] = {}
        for i, p, match in sorted(extensions(letters)):
            if i + p < ends.get(p, 0):
                continue  # another root of the run before
            start = i
            while start and w[start - 1] == w[start - 1 + p]:
                start -= 1
            ends[p] = i + p + match
            out[start, p] = ends[p] - start
    return sorted((start, n, p) for (start, p), n in out.items() if n >= max(least, periods * p))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the period that every tenth id (by its CRC-32) is given."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p]
    return words[:a] + (tail * ((n - a) // p + 1))[: n - a]


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words that no run contains behind its first period."""
    gone = bytearray(len(words))
    for start, n, p in found:
        gone[start + p : start + n] = b"\1" * (n - p)
    return [word for word, out in zip(words, gone, strict=True) if not out]


def strongest(found: list[Run]) -> Run | None:
    """The run with the greatest length / period, compared exactly; of equals the first, then that of the smaller period."""
    best = None
    for run in found:  # sorted by start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long, n_kept long"


def describe(docs: DataFrame, key: str = "doc_id", text: str = "text", plant: bool = False, least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """Per row what ``SCHEMA`` names; ``plant`` gives the ids of ``planted`` their periods first."""
    return _each(docs, key, text, SCHEMA, plant, least, periods, False)


def collapse(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """(doc_id, text, runs): the kept words joined by one space and every run as ``start,length,period`` lines."""
    return _each(docs, key, text, "doc_id long, text string, runs string", False, least, periods, True)


def _each(docs: DataFrame, key: str, text: str, schema: str, plant: bool, least: int, periods: int, texts: bool) -> DataFrame:
    from .common import map_rows, text_batches

    text_batches(docs.sparkSession)
    names = [part.split()[0] for part in schema.split(", ")]

    def one(doc_id: int | None, value: str | None) -> tuple:
        words = (value or "").encode().split()  # white space of bytes is x20 and x09 to x0D
        if plant:
            words = planted(doc_id, words)
        found = runs(words, least, periods)
        lines, kept = "".join("%d,%d,%d\n" % run for run in found), collapsed(words, found) if found else words
        if texts:
            return doc_id, b" ".join(kept).decode(), lines
        best = strongest(found)
        head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        return doc_id, len(found), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(), len(words), len(kept)

    def make():
        return lambda x: dict(zip(names, [list(c) for c in zip(*map(one, x["doc_id"], x["text"]), strict=True)] or [[] for _ in names], strict=True))

    return map_rows(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), schema, make)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return describe(table(spark, sf_dir, "documents"), plant=True)


def brute(words: list, least: int = LEAST, periods: int = PERIODS) -> list[Run]:
    """Every period, every stretch of it, smallest period by trial; for tests."""
    n, out = len(words), []
    for p in range(1, n // periods + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            end = i + p
            while end < n and words[end] == words[end - p]:
                end += 1
            size = end - i
            if size >= max(least, periods * p) and not any(all(words[k] == words[k + q] for k in range(i, end - q)) for q in range(1, p)):
                out.append((i, size, p))
            i = end - p + 1
    return sorted(out)
