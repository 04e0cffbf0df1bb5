"""Job parameters. Nothing below is read from a global: operators take a Settings."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FreshnessLimit:
    """Age limits in hours for one source."""

    warn_hours: int
    error_hours: int


# Fixed values of the product contract.
FRESHNESS_LIMITS = {
    "orders": FreshnessLimit(24, 48),
    "order_items": FreshnessLimit(24, 48),
    "order_payments": FreshnessLimit(24, 48),
    "order_reviews": FreshnessLimit(48, 96),
    "weather_daily": FreshnessLimit(48, 96),
    "holidays": FreshnessLimit(30 * 24, 60 * 24),
}


@dataclass(frozen=True)
class Settings:
    holiday_country: str = "BR"
    weather_location: str = "sao_paulo"
    low_review_score: float = 2.0
    amount_tolerance: float = 0.01
    rate_tolerance: float = 1e-6
    order_lookback_days: int = 90
    weather_lookback_days: int = 7
    weather_call_budget: int = 900
    now: datetime | None = None
    freshness: dict[str, FreshnessLimit] = field(
        default_factory=lambda: dict(FRESHNESS_LIMITS)
    )

    def now_column(self) -> Column:
        """The run's clock: injected when given, so that reruns are reproducible."""
        if self.now is None:
            return F.current_timestamp()
        return F.lit(self.now).cast("timestamp")
