"""From a tagged question to its dataset: business rule by intent, or metric by dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame

from paylake.plans import business
from paylake.plans.metrics import metric_by_dimension

_USER_RULES = {
    "inactive": business.inactive_by_segment,
    "segment": business.segments,
    "city": business.cities,
    "city_by_failure": lambda users: business.cities(users, by_failure=True),
    "failure": business.failures_by_segment,
    "top_users": business.top_users,
    "merchant": business.merchants,
    "category": business.categories,
    "channel": business.channels,
    "device": business.devices,
    "business_kpis": business.business_kpis,
}


def for_intent(intent: str | None, gold: dict[str, DataFrame]) -> DataFrame | None:
    """Dataset of a business rule over the three Gold tables; None when no rule matched."""
    if intent in _USER_RULES:
        return _USER_RULES[intent](gold["gold_user_360"])
    if intent == "event":
        return business.events(gold["gold_event_summary"])
    if intent == "daily":
        return business.recent_days(gold["gold_daily_metrics"])
    return None


def for_chart(dimension: str | None, metric: str | None, gold: dict[str, DataFrame], chart: str = "bar",
              top_n: int = 10) -> DataFrame | None:
    """Certified dataset of a chart question; None when either key is missing."""
    return metric_by_dimension(gold["gold_user_360"], dimension or "", metric or "", chart, top_n)
