"""One configuration source for every tunable (all defaults mirror the
reference pipeline's values)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


# Fixed values that must equal the reference for identical results.
# Lag/rolling source columns, in the reference's order.
LAG_COLS = (
    "collisions",
    "ksi_collisions",
    "ksi_weighted_score",
    "road_events_count",
    "road_events_severity_weighted",
    "road_construction_count",
    "road_construction_severity_weighted",
)
# Road (disruption) measure columns, in the reference's order.
ROAD_COLS = (
    "road_events_count",
    "road_events_severity_weighted",
    "road_events_full_closure_count",
    "road_construction_count",
    "road_construction_severity_weighted",
    "road_construction_full_closure_count",
)
# KSI measure columns.
KSI_COLS = (
    "ksi_collisions",
    "ksi_fatal_collisions",
    "ksi_serious_collisions",
    "ksi_fatal_victims",
    "ksi_victim_count",
    "ksi_weighted_score",
)
WEATHER_COLS = ("tavg", "tmin", "tmax", "prcp", "snow", "wspd")
# Keys, names and measures of the day itself, which a model must not see.
BASE_LEAKAGE = frozenset({
    "date", "nbhd_id", "area_id", "AREA_ID", "area_name", "AREA_NAME",
    "geometry", "collisions", "city_collisions",
    "ksi_collisions", "ksi_weighted_score", "ksi_fatal_collisions",
    "ksi_serious_collisions", "ksi_fatal_victims", "ksi_victim_count",
    "ksi_ratio",
})
# Name fragments that make the city roll-up sum a column instead of averaging it.
SUM_KEYWORDS = ("count", "collisions", "weighted", "score", "victims", "halo",
                "pressure", "lag", "roll", "momentum")
# Legacy three-way roll-up: sum fragments, then max fragments (max wins).
LEGACY_SUM_KEYWORDS = ("count", "collisions", "weighted")
LEGACY_MAX_KEYWORDS = ("is_", "disrupted", "pressure")
# Disruption severity weights (lower-cased, trimmed text); anything else -> 1.
SEVERITY_WEIGHTS = {"minor": 1, "moderate": 2, "major": 3, "unknown": 1}
# Text tokens read as "true".
TRUTHY_TOKENS = ("true", "1", "yes")


@dataclass(frozen=True)
class Settings:
    lags: tuple = (1, 7, 14)
    windows: tuple = (7, 14, 30)
    halo_lags: tuple = (1, 7)
    halo_windows: tuple = (7, 14)
    horizons: tuple = (1, 2)
    surge_pct: float = 0.90
    split_date: _dt.date = _dt.date(2024, 1, 1)
    band_high: float = 0.70
    band_medium: float = 0.40
    blend_collision: float = 0.6
    blend_ksi: float = 0.4
    ks: tuple = (5, 10, 15, 20)
    expected_areas: int = 158
    seasonal_window: int = 60
    seasonal_min_periods: int = 14
    seasonal_min_valid: int = 30
    drift_warn: float = 0.15
    include_observed_holidays: bool = False
    seed: int = 42
    lag_cols: tuple = LAG_COLS
    road_cols: tuple = ROAD_COLS
    extra: dict = field(default_factory=dict)


DEFAULTS = Settings()

# The adapter over the driver's tables uses its own split date and area count.
ADAPTER = Settings(split_date=_dt.date(2000, 1, 1), expected_areas=25)
