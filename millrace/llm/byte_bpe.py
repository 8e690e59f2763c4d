"""Byte-level BPE by backtracking over longest matches.

Bytes are mapped to Latin-1 characters, so that one Aho-Corasick automaton finds the tokens that start at each
place. The encoder takes the longest one, and steps back to shorter ones where two neighbours could not stand side
by side in a merge order; that test is memoised. Each place of a piece is given up once at most, so time is linear
in the piece. The ids are those that merging by rank gives. Null text is encoded as the empty text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Entries of the memos, for pieces (those up to PIECE characters) and for pairs; a full memo is emptied.
PIECES, PIECE, PAIRS = 200_000, 48, 400_000


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


class Codec:
    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.length = {i: len(b) for b, i in ranks.items()}
        self.pairs: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.shorter: dict[int, int | None] = {}
        self.memo: dict[int, bool] = {}
        self.whole_only: set[int] = set()
        self.automaton = ahocorasick.Automaton()
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if self._enter(token, rank) or len(token) == 1:
                self.automaton.add_word(token.decode("latin-1"), rank)
            else:
                self.whole_only.add(rank)
        self.automaton.make_automaton()
        self.most = max(map(len, ranks))
        self.prefix = [-1] * (max(ranks.values()) + 1)
        self.shorter.clear()
        for rank in ranks.values():
            self.prefix[rank] = -1 if (found := self._prefix(rank)) is None else found

    def _enter(self, token: bytes, rank: int) -> bool:
        """Find the merge that makes the token; a token that no merge makes occurs only as a whole piece."""
        self.split[rank] = (rank, rank)
        left = self._prefix(rank)
        while left is not None:
            right = self.ranks.get(token[self.length[left] :])
            if right is not None and left < rank and right < rank and self._fits(left, right):
                self.pairs[left, right] = rank
                self.split[rank] = (left, right)
                return True
            left = self._prefix(left)
        return False

    def _prefix(self, token: int) -> int | None:
        """The longest other token that this one starts with."""
        if token not in self.shorter:
            whole = self.bytes_of[token]
            self.shorter[token] = next((self.ranks[whole[:n]] for n in range(len(whole) - 1, 0, -1) if self.ranks.get(whole[:n], -1) not in self.whole_only and whole[:n] in self.ranks), None)
        return self.shorter[token]

    def _fits(self, left: int, right: int) -> bool:
        """Would merging by rank leave these neighbours apart? Undo their merges, latest first, and look across the gap."""
        pairs, split, latest = self.pairs, self.split, 1 << 60
        while True:
            joined = pairs.get((left, right))
            if joined is not None and joined < latest:
                return False
            if left > right:
                latest, left = left, split[left][1]
                if left == latest:
                    latest, right = right + 1, split[right][0]
                    if right + 1 == latest:
                        return True
            else:
                latest, right = right + 1, split[right][0]
                if right + 1 == latest:
                    latest, left = left, split[left][1]
                    if left == latest:
                        return True

    def fits(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.memo.get(key)
        if known is None:
            if len(self.memo) >= PAIRS:
                self.memo.clear()
            known = self.memo[key] = self._fits(left, right)
        return known

    def piece(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        n, get, length, shorter, known, walk, most, alone = len(piece), self.ranks.get, self.length, self.prefix, self.memo.get, self.automaton.longest_prefix, self.most, self.whole_only
        latin = piece.decode("latin-1")
        given_up: set[int] = set()
        ids: list[int] = []
        at, last = 0, -1
        while at < n:
            # The longest token that starts here: the automaton's path, then back to the last token on it.
            reach = walk(latin[at : at + most])
            token = get(piece[at : at + reach])
            while token is None or token in alone:
                reach -= 1
                token = get(piece[at : at + reach])
            while True:
                end = at + length[token]
                if end not in given_up:
                    if last < 0:
                        break
                    good = known(last << 32 | token)
                    if good or good is None and self.fits(last, token):
                        break
                token = shorter[token]
                if token < 0:  # nothing fits behind the last token: take it back and try a shorter one in its place
                    given_up.add(at)
                    token = ids.pop()
                    at -= length[token]
                    last = ids[-1] if ids else -1
            ids.append(token)
            at, last = end, token
        return tuple(ids)


@lru_cache(maxsize=2)
def codec(data: bytes) -> Codec:
    return Codec(parse_ranks(data))


class Memo(dict):
    """key -> make(key). At PIECES entries the young generation grows old, and what was old and unused goes."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= PIECE:
            if len(self) >= PIECES:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


#: Texts of these characters only: for them the standard library's classes and those of the pattern are the same.
PLAIN = re.compile("[\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-\u01ff\u2010-\u2027]*")
#: The pattern that public_tokenizers gives, and the same in terms of the standard library.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_PATTERN = r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"


class Encoder:
    def __init__(self, data: bytes, pattern: str):
        import regex

        self.codec = codec(data)
        self.find = regex.compile(pattern).findall
        self.plain = re.compile(PLAIN_PATTERN).findall if pattern == PATTERN else None
        self.pieces = Memo(lambda piece: self.codec.piece(piece.encode("utf-8", "surrogatepass")))
        self.runs = Memo(self._run)

    def split(self, text: str) -> list[str]:
        return (self.plain if self.plain and PLAIN.fullmatch(text) else self.find)(text)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))

    def _run(self, piece: str) -> tuple[int, str, bytes]:
        """Of one piece: the number of its ids, the ids in decimals, and the bytes that they decode to."""
        ids = self.codec.piece(piece.encode("utf-8", "surrogatepass"))
        return len(ids), ",".join(map(str, ids)), self.decode(ids)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.codec.bytes_of.__getitem__, ids))


def vocabulary(path: str | None = None) -> tuple[bytes, str]:
    """The ranks file (about a megabyte, whatever the corpus) and the pattern of pieces; read on the driver."""
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids array<int>): the whole text of every row."""
    data, pattern = vocabulary(path)
    return _each(docs, key, text, "doc_id long, ids array<int>", data, pattern, lambda encoder, value: {"ids": encoder.encode(value)})


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, bytes): ids back to bytes. An id outside the vocabulary is an error."""
    from .common import map_rows, text_batches

    text_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary(path)[0])

    def make():
        names = codec(shared.value).bytes_of.__getitem__
        return lambda x: {"doc_id": x["doc_id"], "bytes": [b"".join(map(names, ids or ())) for ids in x["ids"]]}

    return map_rows(encoded.select("doc_id", "ids"), "doc_id long, bytes binary", make)


def _digests(encoder: Encoder, value: str) -> dict:
    """Encode piece by piece and decode the ids; ids and decoded bytes of pieces that occur again are remembered."""
    runs = list(map(encoder.runs.__getitem__, encoder.split(value)))
    ids, back = hashlib.sha256(",".join([r[1] for r in runs]).encode()), hashlib.sha256(b"".join([r[2] for r in runs]))
    return {"n_tokens": sum([r[0] for r in runs]), "ids_sha256": ids.hexdigest(), "decoded_sha256": back.hexdigest()}


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), in one pass and without a shuffle."""
    data, pattern = vocabulary(path)
    return _each(docs, key, text, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", data, pattern, _digests)


def _tokens(encoder: Encoder, value: str) -> dict:
    ids = encoder.encode(value)
    return {"ids": ids, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), "decoded_sha256": hashlib.sha256(encoder.decode(ids)).hexdigest()}


def tokenised(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """round_trip() with the ids themselves."""
    data, pattern = vocabulary(path)
    return _each(docs, key, text, "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string", data, pattern, _tokens)


def _each(docs: DataFrame, key: str, text: str, schema: str, data: bytes, pattern: str, work) -> DataFrame:
    from .common import map_rows, text_batches

    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((data, pattern))

    def make():
        encoder = Encoder(*shared.value)

        def each(x: dict[str, list]) -> dict[str, list]:
            rows = [work(encoder, value or "") for value in x["text"]]
            return {"doc_id": x["doc_id"]} | {name.split()[0]: [r[name.split()[0]] for r in rows] for name in schema.split(", ")[1:]}

        return each

    return map_rows(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), schema, make)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return round_trip(table(spark, sf_dir, "documents"))
