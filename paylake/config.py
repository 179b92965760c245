"""Run settings. Everything a run may want to change is a field here, passed explicitly."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from paylake import fixed_values as fv


@dataclass(frozen=True)
class Settings:
    """One run's parameters: no wall clock or network value is read inside an operator."""

    as_of: dt.date = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).date())
    fx_rate: float = fv.FALLBACK_FX_RATE
    success_events: tuple[str, ...] = fv.SUCCESS_TX_EVENTS
    transactional_events: tuple[str, ...] = fv.TRANSACTIONAL_EVENTS
    pii: tuple[str, ...] = fv.PII_COLUMNS
