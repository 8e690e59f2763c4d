"""Secrets in whole texts, and weak credential parts that only count in company.

Base spans: ``assign``, ``access`` and ``hex``, as the patterns below say, leftmost and non-overlapping for each
kind. Multipart linking adds ``identifier`` (user or client names and ids), ``weak`` (long mixed strings) and
``endpoint`` (URLs and hosts with a port): none of them means anything alone, so one is reported only where a
complementary part lies within its scope, which is ``SCOPE`` code points to either side within the same paragraph:
an identifier needs a secret, a weak secret needs an identifier, an access id or an endpoint, an endpoint needs a
secret. The value of a secret access key's name is a weak secret however it is mixed. An identifier's value is no weak
secret; a mixed string that reaches beyond it is one, but the two are no company for each other. Scopes are joined as
intervals over sorted starts, so a text costs n log n in its parts.
Null and empty texts have no spans. Spans are in code points, end exclusive; a weak span inside a base span is dropped,
and so is one inside an endpoint unless it is a value behind ``=`` in the query.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "identifier", "weak", "endpoint")
SCOPE = 240

ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Every ASSIGN match holds one of these in any case of its ASCII letters.
WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
IDENTIFIER = re.compile(r"(?ai:user(?:name|_?id)?|login|account(?:_?id)?|client_?id|access_?key_?id|(?<!secret)(?<!secret[_.-])access_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._+-]{3,})")
SECRET_KEY = re.compile(r"(?ai:secret\x20?[a-z0-9_.-]{0,20}?access\x20?[a-z0-9_.-]{0,20}?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_-]+(?:\.[A-Za-z0-9+/_-]+)*={0,2})")
ENDPOINT = re.compile(r"(?ai:[a-z][a-z0-9+.-]{1,20}://[^\s\"'<>]{4,})|(?ai:(?:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[a-z0-9.-]{4,}(?::[0-9]{2,5})?)")
WEAK = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
BREAK = re.compile(r"\n\s*\n")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted; kind is the place in KINDS."""
    spans = []
    lower = text.encode("utf-8", "surrogatepass").lower()  # bytes.lower() changes ASCII only
    if any(word in lower for word in WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # Maximal runs, so asking for the length at once finds the same matches.
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _mixed(piece: str) -> bool:
    """Upper, lower and digits together, and not a few characters over and over."""
    if not (re.search("[0-9]", piece) and re.search("[a-z]", piece) and re.search("[A-Z]", piece)):
        return False
    n = len(piece)
    return -sum(c / n * math.log2(c / n) for c in Counter(piece).values()) >= 3.5


class _Near:
    """Intervals, counted where they meet a scope."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts = sorted(s for s, _ in spans)
        self.ends = sorted(e for _, e in spans)

    def meets(self, low: int, high: int) -> int:
        """How many intervals have start < high and end > low?"""
        return bisect_left(self.starts, high) - bisect_right(self.ends, low)


def linked_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    ids = [(m.start(1), m.end(1)) for m in IDENTIFIER.finditer(text)] if any(c in text for c in ":=") else []
    ends = [m.span() for m in ENDPOINT.finditer(text)] if any(c in text for c in ":=") else []
    access = [(s, e) for s, k, e in base if k == 1]
    if not ids and not ends and not access:
        return []
    strong = [(s, e) for s, k, e in base if k != 1]
    marks = [text.find("?", s, e) for s, e in ends]
    own, tails = _Near([(s, e) for s, _, e in base]), _Near([(k, e) for k, (_, e) in zip(marks, ends, strict=True) if k >= 0])
    heads = _Near([(s, e if k < 0 else k) for k, (s, e) in zip(marks, ends, strict=True)])

    def inside(start: int, end: int) -> bool:
        """Does it lie in a base span or in an endpoint, where only a query's values stand for themselves?"""
        return bool(own.meets(start, end) or heads.meets(start, end) or text[start - 1 : start] != "=" and tails.meets(start, end))

    keys = [m.span(1) for m in SECRET_KEY.finditer(text)]
    known = _Near(keys)
    named = [(s, e) for s, e in keys if e - s >= 6 and not inside(s, e)]
    ids = [x for x in ids if not known.meets(*x)]
    first = [s for s, _ in ids]

    def identifies(start: int, piece: str) -> bool:
        """Is the piece, padding aside, part of one identifier's value?"""
        k = bisect_right(first, start) - 1
        return k >= 0 and ids[k][1] >= start + len(piece.rstrip("="))

    weak = named + [m.span() for m in WEAK.finditer(text) if _mixed(m[0]) and not inside(*m.span()) and not known.meets(*m.span()) and not identifies(m.start(), m[0])]
    breaks = [m.start() for m in BREAK.finditer(text)]

    def scope(span: tuple[int, int]) -> tuple[int, int]:
        k = bisect_left(breaks, span[0])
        low = breaks[k - 1] if k else 0
        k = bisect_left(breaks, span[1])
        high = breaks[k] if k < len(breaks) else len(text)
        return max(low, span[0] - SCOPE), min(high, span[1] + SCOPE)

    secrets, names, places = _Near(strong + weak), _Near(ids), _Near(access + ends)

    def apart(near: _Near, span: tuple[int, int]) -> bool:
        """Is there one in scope that doesn't overlap the span itself?"""
        return near.meets(*scope(span)) > near.meets(*span)

    out = [(s, 3, e) for s, e in ids if not own.meets(s, e) and apart(secrets, (s, e))]
    out += [(s, 4, e) for s, e in weak if places.meets(*scope((s, e))) or apart(names, (s, e))]
    return out + [(s, 5, e) for s, e in ends if secrets.meets(*scope((s, e))) and not own.meets(s, e)]


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: n_assign, n_access, n_hex, base (the base spans as text) and spans (all of them). No shuffle."""
    from .common import map_rows, text_batches

    text_batches(docs.sparkSession)

    def make():
        def each(x: dict[str, list]) -> dict[str, list]:
            out = {name: [] for name in ("n_assign", "n_access", "n_hex", "base", "spans")}
            for value in x["text"]:
                base = base_spans(value or "")
                for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                    out[name].append(sum(s[1] == k for s in base))
                out["base"].append(digest(base))
                out["spans"].append(digest(sorted(base + linked_spans(value or "", base))))
            return {"doc_id": x["doc_id"]} | out

        return each

    from pyspark.sql import functions as F

    return map_rows(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string", make)


def query(spark, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .common import table

    return scan(table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def brute(text: str | None) -> tuple[int, int, int, str]:
    """The base rules word for word, for tests."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    counts = Counter(k for _, k, _ in found)
    return counts[0], counts[1], counts[2], hashlib.sha256(digest(sorted(found)).encode()).hexdigest()
