"""Every parameter of the engine, as one frozen object on the driver; values enter plans as literals."""

from __future__ import annotations

import json
import pkgutil
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import cache
from types import MappingProxyType
from typing import Any


def _frozen(value: Any) -> Any:
    return MappingProxyType({k: _frozen(v) for k, v in value.items()}) if isinstance(value, Mapping) else value


def _table(**values: Any) -> Any:
    return field(default_factory=lambda: _frozen(values))


# Defaults that results must agree with.
@dataclass(frozen=True)
class Config:
    district: str = "Miraflores"
    excluded_districts: tuple[str, ...] = ()
    bbox: tuple[float, float, float, float] = (-12.1420, -77.0620, -12.0960, -77.0000)  # south, west, north, east
    production: bool = False
    target_max_rent: float = 1000
    target_max_total: float = 1000
    stretch_max_rent: float = 1100
    query_ceiling: float = 1150
    strict_margin: float = 5.0
    min_bedrooms: int = 1
    max_bedrooms: int = 2
    #: bedrooms -> (acceptable, good, very spacious) in square metres.
    space_bands: Mapping[int, tuple[float, float, float]] = field(default_factory=lambda: _frozen({1: (40, 50, 60), 2: (55, 70, 85)}))
    very_small_factor: float = 0.85
    weights: Mapping[str, float] = _table(quietness=25, budget=20, space=20, location=10, furnishing=8, building=7, listing_quality=10)
    noise_baseline: float = 72
    #: (up to metres, penalty), nearest first.
    major_road: tuple = ((50, 30), (150, 15), (300, 6))
    arterial_road: tuple = ((30, 14), (100, 6))
    nightclub: tuple = ((150, 25), (300, 12), (500, 4))
    bars_many: tuple[int, float] = (3, 12)
    bars_few_penalty: float = 5
    restaurants_many: tuple[int, float] = (10, 5)
    cluster_radius_m: float = 150
    noise_text: Mapping[str, float] = _table(interior_view=10, acoustic_windows=12, quiet_claim=3, avenue_view=-12, high_floor=3)
    high_floor_from: int = 8
    low_noise_from: float = 70
    medium_noise_from: float = 50
    #: amenity -> (metres, weight).
    livability: Mapping[str, tuple[float, float]] = _table(supermarket=(500, 0.3), pharmacy=(400, 0.2), park=(300, 0.2), cafe=(300, 0.1), transit=(400, 0.1), malecon=(900, 0.1))
    high_deposit_months: float = 3
    long_contract_months: float = 13
    near_miss_m: float = 300
    near_miss_min_fit: float = 70
    coord_match_m: float = 40
    price_tolerance: float = 0.05
    area_tolerance: float = 0.06
    title_ratio: float = 85
    description_ratio: float = 80
    match_threshold: float = 0.60
    source_priority: tuple[str, ...] = ("urbania", "adondevivir", "mercadolibre", "manual")
    sister_sources: tuple[str, ...] = ("urbania", "adondevivir")
    qa_programmatic: int = 30
    qa_deep: int = 10
    top_n: int = 10
    alternatives: int = 20
    min_value_group: int = 5
    fx_fallback: float = 3.385
    boundary_tolerance_m: float = 15

    def with_(self, **changes: Any) -> Config:
        return replace(self, **changes)


def from_mapping(values: Mapping[str, Any]) -> Config:
    """A parsed YAML mapping (flat names of Config) on top of the defaults; unknown names are errors."""
    return Config(**{k: _frozen(v) if isinstance(v, Mapping) else tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def load(path: str) -> Config:
    import yaml

    with open(path, encoding="utf-8") as f:
        return from_mapping(yaml.safe_load(f) or {})


@cache
def wordings() -> dict[str, Any]:
    """The word lists that come with the package, also out of a zip."""
    return json.loads(pkgutil.get_data(__package__, "wordings.json") or b"{}")


def dotenv(text: str) -> dict[str, str]:
    """NAME=value lines; comments and blank lines are skipped, quotes around values go."""
    pairs = (line.split("=", 1) for line in map(str.strip, text.splitlines()) if line and not line.startswith("#") and "=" in line)
    return {k.strip(): v.strip().strip("'\"") for k, v in pairs}
