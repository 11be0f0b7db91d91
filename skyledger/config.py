"""Settings, each overridable from the environment.

The variable names and defaults are fixed values: a deployment that is already
configured through its environment keeps working unchanged.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Self


def _setting(default, variable: str):
    return field(default=default, metadata={"variable": variable})


class _FromEnvironment:
    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Self:
        env = os.environ if env is None else env
        found = {}
        for f in fields(cls):
            text = env.get(f.metadata.get("variable", ""))
            if text is not None:
                found[f.name] = type(f.default)(text)
        return cls(**found)


@dataclass(frozen=True)
class Thresholds(_FromEnvironment):
    """Upper bounds of plausible flight; rules and weak labels share them."""

    altitude_ft: float = _setting(60000.0, "ALT_MAX_FT")
    speed_kt: float = _setting(700.0, "SPEED_MAX_KT")
    vertical_rate_fpm: float = _setting(10000.0, "VS_MAX_FPM")


@dataclass(frozen=True)
class Geofence(_FromEnvironment):
    """The watched box, its four sides included."""

    lat_min: float = _setting(45.40, "GEO_LAT_MIN")
    lat_max: float = _setting(45.55, "GEO_LAT_MAX")
    lon_min: float = _setting(9.10, "GEO_LON_MIN")
    lon_max: float = _setting(9.30, "GEO_LON_MAX")


@dataclass(frozen=True)
class Area(_FromEnvironment):
    """The monitored area around a point."""

    lat: float = _setting(41.9, "AREA_LAT")
    lon: float = _setting(12.5, "AREA_LON")
    radius_nm: float = _setting(250.0, "AREA_DIST_NM")
    half_lat: float = 3.0
    half_lon: float = 4.0


@dataclass(frozen=True)
class Training(_FromEnvironment):
    test_fraction: float = _setting(0.2, "TEST_FRACTION")
    seed: int = _setting(42, "SEED")
    trees: int = 100
    depth: int = 8


@dataclass(frozen=True)
class Scoring(_FromEnvironment):
    """Probabilities from which a prediction is an alert, and a severe one."""

    warn: float = _setting(0.60, "PROB_WARN")
    critical: float = _setting(0.85, "PROB_CRIT")


@dataclass(frozen=True)
class Topics:
    telemetry: str = "flights.telemetry"
    dead_letter: str = "flights.dlq"
    raw: str = "flights.raw"
    rule_alerts: str = "flights.alerts"
    model_alerts: str = "flights.ml-alerts"


@dataclass(frozen=True)
class Index(_FromEnvironment):
    prefix: str = _setting("flights", "ES_INDEX_PREFIX")
    topics: str = _setting("flights.alerts,flights.ml-alerts", "TOPICS")

    def topic_names(self) -> list[str]:
        return [name.strip() for name in self.topics.split(",")]
