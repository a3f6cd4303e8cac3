"""Thresholds shared by the operators."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    # The published definition of "on time" and of a usable delay.
    on_time_minutes: int = 5
    early_tolerance_minutes: int = 60
    min_plausible_minutes: int = -60
    max_plausible_minutes: int = 1440

    # Floors and clips used by the analysis questions.
    min_arrivals: int = 200
    quiet_hour_min_arrivals: int = 2000
    category_min_arrivals: int = 1000
    utc_offset_hours: int = 3
    zone: str = "Europe/Helsinki"
    histogram_low: int = -8
    histogram_high: int = 13
    metadata_max_age_days: int = 7

    # Checks listed here only report, whatever severity they are declared with.
    warn_only: frozenset[str] = field(default_factory=frozenset)

    as_of: dt.date | None = None
