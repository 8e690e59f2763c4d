"""From mapped records to ranked listings: each stage is written to the shared folder once, as later ones read it several times."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import Config
from ..operators.components import cut
from ..operators.dedupe import deduplicate
from ..operators.enrich import enrich
from ..operators.normalize import normalize
from ..operators.ranking import rank
from ..operators.scoring import score


def process(records: DataFrame, shapes: DataFrame, ring: list[tuple[float, float]], cfg: Config, rate: float, as_of: str, evidence: bool = True) -> DataFrame:
    """``records``: listing columns and row_id. ``shapes`` and ``ring`` as sources.places gives them. Without ``evidence``
    no listing names the pairs that it was merged by."""
    listings = cut(normalize(records, cfg, rate))
    merged = cut(deduplicate(listings, cfg, evidence))
    scored = cut(score(cut(enrich(merged, shapes, ring, cfg)), cfg, as_of))
    return rank(scored, cfg)
