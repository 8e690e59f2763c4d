"""What a text must hold for a pattern to match: plain substrings, which are far cheaper to look for than patterns."""

from __future__ import annotations

import re
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_parse, _ops = re._parser.parse, re._constants


@lru_cache(maxsize=None)
def required(pattern: str) -> frozenset[str]:
    """Substrings one of which stands in whatever the pattern matches; empty if none can be told."""
    return _of(_parse(pattern))


def _of(parsed) -> frozenset[str]:
    """Of all the parts that have to match, those substrings whose shortest one is longest."""
    found, run = [], ""
    for op, value in [*parsed, (None, None)]:
        if op is _ops.LITERAL:
            run += chr(value)
            continue
        if run:
            found.append(frozenset([run]))
        run = ""
        if op is _ops.SUBPATTERN:
            found.append(_of(value[3]))
        elif op is _ops.BRANCH:
            each = [_of(branch) for branch in value[1]]
            found.append(frozenset().union(*each) if all(each) else frozenset())
        elif op in (_ops.MAX_REPEAT, _ops.MIN_REPEAT) and value[0] > 0:
            found.append(_of(value[2]))
    return max((f for f in found if f), key=lambda f: min(map(len, f)), default=frozenset())


def hinted(text: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    """Can any of the patterns match? False only where none can."""
    each = [required(p) for p in patterns]
    if not all(each):
        return F.lit(True)
    every = frozenset().union(*each)
    least = sorted(x for x in every if not any(y != x and y in x for y in every))
    return reduce(lambda x, y: x | y, [text.contains(x) for x in least])
