"""Repeated byte strings of LENGTH bytes, over the whole corpus, by suffixes compared through hashes.

A byte goes if a LENGTH-byte string that covers it starts anywhere else too, in the same document or another.

1. Sampling. Any LENGTH-byte window holds LENGTH - GRAM + 1 grams of GRAM bytes; the one with the least hash is the
   window's anchor. Equal windows have equal anchors at equal offsets, so only suffixes around anchors whose gram
   occurs twice are ever compared. Consecutive windows of one anchor form a run; a run's context is all its bytes.
2. Folding. Runs with equal contexts (by gram hash and 64 bits of BLAKE2b of the bytes) are repeated as a whole; they
   are counted, never brought together.
3. Sorting. Where a gram has several contexts, their suffixes are sorted by mergesort: two suffixes are compared by
   their longest common extension, found by binary search over prefix polynomial hashes, and the byte behind it.
   Neighbours that share LENGTH bytes are repeats, which is verified on the bytes themselves. A gram with more than
   GROUP contexts would make one task too large: its runs are split by binary search over the same hashes instead,
   each range of windows being counted (two 64-bit hashes, partial sums before the shuffle), folded or cut finer.
4. Cutting. The intervals go back to their documents, where overlapping ones are merged.

Rows are told apart by id and text, so ids may be null or repeated, and a row that is repeated as a whole counts twice.
Grams and contexts with very many rows are dealt to several tasks (``common.spread``).

Texts are split into overlapping pieces of PIECE windows, so memory doesn't grow with a text. Null and empty texts
and texts shorter than LENGTH lose nothing; an empty table gives no rows. A text that occurs twice and has LENGTH bytes
goes entirely, both times. Columns other than the key and the text are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, cut, keyed, mix, spread, table, text_batches, text_bytes

LENGTH, GRAM = 400, 96
GROUP = 500
#: Contexts that a task sorts, give or take a gram.
SORTED = 4000
#: Windows in a cell, round by round; each size divides the one before.
CELLS = (80, 20, 5, 1)
PIECE = 1 << 19
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=4)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASES[which] | 1
    inverse = pow(base, -1, 1 << 64)
    up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
    up[1:], down[1:] = np.uint64(base), np.uint64(inverse)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Prefix:
    """Prefix polynomial hashes of a byte array: the hash of any substring in constant time."""

    def __init__(self, data: np.ndarray, which: int = 0):
        size = 1 << max(16, int(len(data) + 1).bit_length())
        up, self.down = _powers(which, size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        """Hashes of data[start : start + length]; comparable whatever the start."""
        return (self.sums[start + length] - self.sums[start]) * self.down[start]


def common(prefix: Prefix, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Longest common extensions of the suffixes at x and y, up to ``limit``, by binary search over hashes."""
    low, high = np.zeros(len(x), np.int64), limit.copy()
    while True:
        wide = low < high
        if not wide.any():
            return low
        middle = (low + high + 1) >> 1
        same = prefix.of(x, middle) == prefix.of(y, middle)
        low, high = np.where(wide & same, middle, low), np.where(wide & ~same, middle - 1, high)


def suffix_sort(data: np.ndarray, prefix: Prefix, starts: np.ndarray, segment: np.ndarray, length: int) -> np.ndarray:
    """Order of the suffixes within their segments (``segment`` ascends), by their first ``length`` bytes: mergesort, all segments side by side."""
    n = len(starts)
    order = np.arange(n)
    first = np.concatenate([[True], segment[1:] != segment[:-1]]) if n else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    end = np.append(np.nonzero(first)[0][1:], n)[np.cumsum(first) - 1] if n else begin
    at = np.arange(n) - begin
    longest = int((end - begin).max(initial=0))
    full = np.full(n, length, np.int64)

    def less(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for each pair of suffixes."""
        shared = common(prefix, a, b, full[: len(a)])
        inside = shared < length
        x, y = data[np.where(inside, a + shared, 0)].astype(np.int16), data[np.where(inside, b + shared, 0)].astype(np.int16)
        return np.where(inside, np.sign(x - y), 0)

    width = 1
    while width < longest:
        run = at // width
        left = run % 2 == 0
        # The other run of the pair: where it starts and ends.
        low = begin + np.where(left, (run + 1) * width, (run - 1) * width)
        low, high = np.minimum(low, end), np.minimum(low + width, end)
        base, me = low.copy(), starts[order]
        while True:
            wide = low < high
            if not wide.any():
                break
            k = np.nonzero(wide)[0]
            middle = (low[k] + high[k]) >> 1
            sign = less(starts[order[middle]], me[k])
            before = (sign < 0) | ((sign == 0) & ~left[k])  # equal ones of the left run stay in front
            low[k] = np.where(before, middle + 1, low[k])
            high[k] = np.where(before, high[k], middle)
        place = begin + (run - np.where(left, 0, 1)) * width + at % width + (low - base)
        merged = np.empty_like(order)
        merged[place] = order
        order = merged
        width *= 2
    return order


def runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, digests: bool = True) -> dict[str, np.ndarray]:
    """All runs of the texts: text number, first and last window start (a, b), anchor place p, gram hash h, context digest c (0 without ``digests``)."""
    out: dict[str, list] = {k: [] for k in "tabphc"}
    chunk: list[tuple[int, int, bytes]] = []
    size = 0

    def work() -> None:
        nonlocal size
        if not chunk:
            return
        data = np.frombuffer(b"".join(c[2] for c in chunk), np.uint8)
        ends = np.cumsum([len(c[2]) for c in chunk])
        begins = ends - [len(c[2]) for c in chunk]
        prefix = Prefix(data)
        grams = len(data) - gram + 1
        hashed = mix(prefix.of(np.arange(grams), gram))
        # The place in the low bits: the leftmost of equal grams wins, and the minimum tells where it is.
        bits = np.uint64((1 << 21) - 1)
        packed = (hashed & ~bits) | np.arange(grams, dtype=np.uint64)
        width = length - gram + 1
        blocks = -(-grams // width)
        padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
        padded[:grams] = packed
        grid = padded.reshape(blocks, width)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = len(data) - length + 1
        anchor = (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & bits).astype(np.int64)
        s = np.concatenate([np.arange(b, e - length + 1) for b, e in zip(begins, ends, strict=True)])
        owner = np.repeat(np.arange(len(chunk)), ends - begins - length + 1)
        p = anchor[s]
        fresh = np.concatenate([[True], (p[1:] != p[:-1]) | (owner[1:] != owner[:-1])])
        a, b = s[fresh], np.append(s[np.nonzero(fresh)[0][1:] - 1], s[-1])
        p, owner = p[fresh], owner[fresh]
        shift = np.array([c[1] for c in chunk])[owner] - begins[owner]
        out["t"].append(np.array([c[0] for c in chunk])[owner])
        out["a"].append(a + shift)
        out["b"].append(b + shift)
        out["p"].append(p + shift)
        out["h"].append(hashed[p].view(np.int64))
        if digests:
            whole, digest = data.tobytes(), hashlib.blake2b
            out["c"].append(np.frombuffer(b"".join([digest(whole[x:y], digest_size=8).digest() for x, y in zip(a.tolist(), (b + length).tolist(), strict=True)]), np.int64))
        else:
            out["c"].append(np.zeros(len(a), np.int64))
        chunk.clear()
        size = 0

    for t, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, PIECE):
            chunk.append((t, at, text[at : at + PIECE + length - 1]))
            size += len(chunk[-1][2])
            if size >= PIECE:
                work()
    work()
    return {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in out.items()}


def _arrow(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def grams(texts: DataFrame) -> DataFrame:
    """texts (id, dg, text binary) -> (h, n): anchor grams of a batch and how many runs they have."""
    schema = "h long, n long"

    def run(batches):
        arrow = arrow_schema(schema)
        for batch in batches:
            h, n = np.unique(runs(text_bytes(batch.column(2)), digests=False)["h"], return_counts=True)
            yield _arrow([h, n], arrow)

    return texts.mapInArrow(run, schema)


def anchors(texts: DataFrame) -> DataFrame:
    """texts (id, dg, text binary) -> (h, c, id, dg, a, b, p)."""
    schema = "h long, c long, id long, dg long, a long, b long, p long"

    def run(batches):
        arrow = arrow_schema(schema)
        for batch in batches:
            r = runs(text_bytes(batch.column(2)))
            t = pa.array(r["t"], pa.int64())
            yield _arrow([r["h"], r["c"], batch.column(0).take(t), batch.column(1).take(t), r["a"], r["b"], r["p"]], arrow)

    return texts.mapInArrow(run, schema)


def contexts(texts: DataFrame, members: DataFrame) -> DataFrame:
    """The members' contexts, cut from the texts: (h, id, dg, a, b, p, need, contexts, context)."""
    schema = "h long, id long, dg long, a long, b long, p long, need boolean, contexts long, context binary"
    lists = members.groupBy("id", "dg").agg(F.collect_list(F.struct("h", "a", "b", "p", "need", "contexts")).alias("runs"))

    def run(batches):
        arrow = arrow_schema(schema)
        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in ("id", "dg", "runs"))
            rows = [(r["h"], i, d, r["a"], r["b"], r["p"], r["need"], r["contexts"], text[r["a"] : r["b"] + LENGTH]) for i, d, found, text in zip(*columns, text_bytes(batch.column("text")), strict=True) for r in found]
            yield _arrow(list(zip(*rows, strict=True)) or [[]] * len(arrow), arrow)

    # A row that is there twice is cut out once: its contexts stand for both.
    return texts.join(lists, ["id", "dg"]).dropDuplicates(["id", "dg"]).select("id", "dg", "text", "runs").mapInArrow(run, schema)


def sorted_repeats(members: list[dict], length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """Members of any grams (h, id, dg, a, b, p, need, context) -> (id, dg, start, end) of what repeats, for those in need."""
    data = np.frombuffer(b"".join(m["context"] for m in members), np.uint8)
    sizes = np.array([m["b"] - m["a"] + 1 for m in members])
    begins = np.cumsum([0] + [len(m["context"]) for m in members[:-1]])
    owner = np.repeat(np.arange(len(members)), sizes)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    starts = begins[owner] + inside
    # Equal windows lie at equal offsets from equal anchors: those are the segments.
    grams = np.unique([m["h"] for m in members], return_inverse=True)[1]
    offset = np.array([m["p"] - m["a"] for m in members])[owner] - inside
    segment = grams[owner] * (2 * length) + offset
    by = np.argsort(segment, kind="stable")
    _, place, count = np.unique(segment[by], return_index=True, return_counts=True)
    by = by[np.repeat(count > 1, count)]
    if not len(by):
        return []
    starts, segment, owner, inside = starts[by], segment[by], owner[by], inside[by]
    prefix = Prefix(data)
    order = suffix_sort(data, prefix, starts, segment, length)
    x, y = order[:-1], order[1:]
    near = segment[x] == segment[y]
    x, y = x[near], y[near]
    same = prefix.of(starts[x], length) == prefix.of(starts[y], length)
    x, y = x[same], y[same]
    # Equal hashes are verified on bytes, a slice at a time.
    good = np.ones(len(x), bool)
    reach = np.arange(length)
    for k in range(0, len(x), 4096):
        good[k : k + 4096] = (data[starts[x[k : k + 4096], None] + reach] == data[starts[y[k : k + 4096], None] + reach]).all(axis=1)
    if not good.all():  # a collision can hide an equal neighbour: compare that segment's windows as they are
        for s in np.unique(segment[x[~good]]):
            seen: dict[bytes, int] = {}
            for k in np.nonzero(segment == s)[0]:
                window = data[starts[k] : starts[k] + length].tobytes()
                if window in seen:
                    x, y, good = np.append(x, seen[window]), np.append(y, k), np.append(good, True)
                seen[window] = k
    repeated = np.unique(np.concatenate([x[good], y[good]]))
    low, high = np.full(len(members), 1 << 60), np.full(len(members), -1)
    np.minimum.at(low, owner[repeated], inside[repeated])
    np.maximum.at(high, owner[repeated], inside[repeated])
    # All windows of a run hold its anchor, so what they cover is one interval.
    return [(m["id"], m["dg"], m["a"] + int(lo), m["a"] + int(hi) + length) for m, lo, hi in zip(members, low, high, strict=True) if hi >= 0 and m["need"]]


def _cold(found: DataFrame, parts: int) -> DataFrame:
    """Intervals from grams of up to GROUP contexts, sorted in ``parts`` tasks."""
    schema = "id long, dg long, start long, end long"
    lists = found.repartition(parts, "h").groupBy("h").agg(F.collect_list(F.struct("h", "id", "dg", "a", "b", "p", "need", "context")).alias("members"))

    def run(batches):
        arrow = arrow_schema(schema)
        for batch in batches:
            groups, out = batch.column("members").to_pylist(), []
            at = 0
            while at < len(groups):  # several groups side by side, up to some thousand contexts
                together: list[dict] = []
                while at < len(groups) and (not together or len(together) + len(groups[at]) <= 1500):
                    together += groups[at]
                    at += 1
                out += sorted_repeats(together)
            yield _arrow(list(zip(*out, strict=True)) or [[]] * 4, arrow)

    return lists.select("members").mapInArrow(run, schema)


def _folded(rows: DataFrame, key: list[str], full: list[str]) -> tuple[DataFrame, DataFrame]:
    """(whole, open) of rows of window ranges [a, b] whose ``key`` they share and whose ``full`` bytes may differ.

    whole: rows whose bytes occur again as they are; all of their windows repeat. open: one row for each of the
    different bytes behind a key; it needs an answer if it stands for itself alone. Rows alone with their key are gone.
    """
    groups = rows.groupBy(*key, *full).agg(F.count("*").alias("n"), F.min(F.struct("id", "dg", "a", "b", "p", "need", "from", "context")).alias("one"))
    kept = cut(groups)
    several = kept.groupBy(*key).agg(F.count("*").alias("m")).where(F.col("m") > 1).select(*key)
    light = rows.where("need").select(*key, *full, "id", "dg", "a", "b")
    whole = spread(light, cut(kept.where(F.col("n") > 1).select(*key, *full, "n")), [*key, *full], ["id", "a"]).select("id", "dg", F.col("a").alias("start"), (F.col("b") + LENGTH).alias("end"))
    one = [F.col(f"one.{k}").alias(k) for k in ("id", "dg", "a", "b", "p", "from", "context")]
    return whole, kept.join(several, key).select(*key, *one, ((F.col("n") == 1) & F.col("one.need")).alias("need"))


def _hot(found: DataFrame) -> DataFrame:
    """Intervals from grams of more contexts: ranges of windows are cut finer from round to round, as in binary search.

    Ranges lie on a grid of offsets from the anchor, so that equal windows fall in equal cells. All windows of a cell
    share its core. A core that occurs nowhere else repeats nowhere; a range whose bytes occur again repeats as a
    whole; only ranges at the edges of what repeats are cut further, down to single windows. Rows are counted by
    64-bit hashes of core and bytes with partial sums, and equal bytes are one row.
    """
    schema = "h long, id long, dg long, a long, b long, p long, need boolean, from long, context binary, core long, other long, whole long"

    def cutter(size: int):
        def run(batches):
            arrow = arrow_schema(schema)
            for batch in batches:
                rows, out = batch.to_pylist(), []
                for at in range(0, len(rows), 500):
                    nodes, data, used = [], [], 0
                    for m in rows[at : at + 500]:
                        lo = m["a"]
                        while lo <= m["b"]:
                            top = m["p"] - (m["p"] - lo) // size * size  # the cell's last window
                            nodes.append((m, lo, min(top, m["b"]), top, used - m["from"]))
                            lo = top + 1
                        data.append(m["context"])
                        used += len(m["context"])
                    joined = np.frombuffer(b"".join(data), np.uint8)
                    lo, hi, top, base = (np.array([x[k] for x in nodes], np.int64) for k in (1, 2, 3, 4))
                    cell = mix(np.array([x[0]["p"] for x in nodes], np.int64) - top)
                    one, two = Prefix(joined), Prefix(joined, 1)
                    core, other = (mix(f.of(base + top, LENGTH - size + 1) ^ cell).view(np.int64) for f in (one, two))
                    whole = mix(two.of(base + lo, LENGTH + hi - lo) ^ mix(hi - lo) ^ mix(top - lo, 3)).view(np.int64)
                    for (m, x, y, _, _), k, o, w in zip(nodes, core.tolist(), other.tolist(), whole.tolist(), strict=True):
                        out.append((m["h"], m["id"], m["dg"], x, y, m["p"], m["need"], x, m["context"][x - m["from"] : y + LENGTH - m["from"]], k, o, w))
                yield _arrow(list(zip(*out, strict=True)) or [[]] * len(arrow), arrow)

        return run

    todo, done = found.select("h", "id", "dg", "a", "b", "p", "need", F.col("a").alias("from"), "context"), None
    for size in CELLS:
        rows = cut(todo.mapInArrow(cutter(size), schema))
        whole, todo = _folded(rows, ["h", "core", "other"], ["whole"])
        done = whole if done is None else done.union(whole)
    return done


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """(id, dg, start, end): byte intervals, overlapping ones not merged, whose union is what goes."""
    text_batches(docs.sparkSession)
    texts = keyed(docs, key, text).select("id", "dg", F.col("text").cast("binary").alias("text")).where(F.octet_length("text") >= LENGTH)
    often = cut(grams(texts).groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > 1))
    # The runs are made again rather than kept: they are cheap, and few of them have a gram that occurs twice.
    shared = cut(spread(anchors(texts), often, ["h"], ["id", "a"]).drop("n"))
    by_context = cut(shared.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("id", "dg", "a", "b", "p")).alias("one")))
    many = by_context.groupBy("h").agg(F.count("*").alias("contexts")).where(F.col("contexts") > 1)
    copied = cut(by_context.where(F.col("n") > 1).select("h", "c", "n"))
    whole = spread(shared, copied, ["h", "c"], ["id", "a"]).select("id", "dg", F.col("a").alias("start"), (F.col("b") + LENGTH).alias("end"))
    # One member stands for equal contexts; it needs no answer if there are several.
    members = by_context.join(many, "h").select("h", "contexts", *[F.col(f"one.{k}").alias(k) for k in ("id", "dg", "a", "b", "p")], (F.col("n") == 1).alias("need"))
    cutout = cut(contexts(texts, members))
    sizes = cutout.agg(F.count(F.when(F.col("contexts") <= group, 1)).alias("cold"), F.count(F.when(F.col("contexts") > group, 1)).alias("hot")).first()
    out = whole.union(_cold(cutout.where(F.col("contexts") <= group), max(1, -(-sizes["cold"] // SORTED))))
    return out.union(_hot(cutout.where(F.col("contexts") > group))) if sizes["hot"] else out


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """Per row: (doc_id, n_bytes, n_removed, n_spans, kept binary)."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    lists = repeats(docs, key, text, group).groupBy("id", "dg").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))

    def run(batches):
        arrow = arrow_schema(schema)
        for batch in batches:
            out = []
            for data, spans in zip(text_bytes(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
                kept, at, n = [], 0, 0
                for s in spans or ():
                    if s["start"] > at or n == 0 and s["start"] == 0:
                        n += 1
                        kept.append(data[at : s["start"]])
                    at = max(at, s["end"])
                kept.append(data[at:])
                rest = b"".join(kept)
                out.append((len(data), len(data) - len(rest), n, rest))
            yield _arrow([batch.column("doc_id"), *(list(zip(*out, strict=True)) or [[]] * 4)], arrow)

    whole = keyed(docs, key, text, carry=True).withColumn("text", F.col("text").cast("binary"))
    return whole.join(lists, ["id", "dg"], "left").select("doc_id", "text", "spans").mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text, by a table of all windows; for tests."""
    data = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for d in data:
        for s in range(len(d) - length + 1):
            k = hashlib.blake2b(d[s : s + length], digest_size=12).digest()
            seen[k] = seen.get(k, 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for s in range(len(d) - length + 1):
            if seen[hashlib.blake2b(d[s : s + length], digest_size=12).digest()] > 1:
                gone[s] += 1
                gone[s + length] -= 1
        mask = np.cumsum(gone)[: len(d)] > 0
        spans = int((np.diff(np.concatenate([[0], mask.astype(np.int8)])) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~mask].tobytes()
        out.append((len(d), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out
