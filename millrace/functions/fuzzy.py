"""Token-set similarity of texts, 0 to 100, as Arrow batches: the one scalar that built-ins can't express."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, all of ``a`` side by side in one integer."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    open_ = full
    for c in b:
        hit = open_ & places.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


def _ratio(a: str, b: str) -> float:
    return 200.0 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set(a: str | None, b: str | None) -> float:
    """The best of: the words not shared compared behind those shared, and the shared words against each whole set."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    one, two = " ".join(filter(None, (both, left))), " ".join(filter(None, (both, right)))
    best = _ratio(one, two)
    return max(best, _ratio(both, one), _ratio(both, two)) if both else best


@F.pandas_udf(T.DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set(x, y) for x, y in zip(a, b, strict=True)])
