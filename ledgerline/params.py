"""Thresholds and trailing windows of the six rules, as plain parameter objects.

The defaults are the published rule values; every rule takes another object to
run with other thresholds (the bundled workload does, its data is sparser).
"""

from __future__ import annotations

from dataclasses import dataclass, field

MINUTE = 60
HOUR = 60 * MINUTE
DAY = 24 * HOUR


# ---- fixed values: rule thresholds and windows ----
@dataclass(frozen=True)
class Velocity:
    window_s: int = 5 * MINUTE
    max_count: int = 10
    max_total: float = 50_000_000


@dataclass(frozen=True)
class ZScore:
    window_s: int = 10 * MINUTE
    baseline_s: int = 30 * DAY
    min_history: int = 5
    max_abs_z: float = 3.0
    critical_abs_z: float = 5.0


@dataclass(frozen=True)
class LargeAmount:
    window_s: int = HOUR
    max_amount: float = 100_000_000
    critical_amount: float = 500_000_000


@dataclass(frozen=True)
class HighRisk:
    window_s: int = HOUR
    risk_level: str = "high"


@dataclass(frozen=True)
class MultiCurrency:
    window_s: int = 10 * MINUTE
    max_currencies: int = 2


@dataclass(frozen=True)
class FailSpike:
    window_s: int = 30 * MINUTE
    min_failed: int = 3
    max_rate_pct: float = 50.0


# Seconds during which an existing case for (account, rule) suppresses a new one.
DEDUP_WINDOW_S = {
    "VELOCITY": 300,
    "ZSCORE": 600,
    "LARGE_AMT": 3600,
    "HIGH_RISK": 3600,
    "MULTI_CCY": 600,
    "FAIL_SPIKE": 1800,
}
DEDUP_WINDOW_UNKNOWN_S = 3600

# Which label groups count as positives for which rule.
POSITIVE_LABELS = {
    "VELOCITY": ("VELOCITY", "LARGE_AMT", "ZSCORE"),
    "ZSCORE": ("ZSCORE",),
    "LARGE_AMT": ("LARGE_AMT", "ZSCORE"),
    "HIGH_RISK": ("HIGH_RISK",),
    "MULTI_CCY": ("MULTI_CCY",),
    "FAIL_SPIKE": ("FAIL_SPIKE",),
}
# ---------------------------------------------------


@dataclass(frozen=True)
class RuleSet:
    """One parameter object per rule."""

    velocity: Velocity = field(default_factory=Velocity)
    zscore: ZScore = field(default_factory=ZScore)
    large_amount: LargeAmount = field(default_factory=LargeAmount)
    high_risk: HighRisk = field(default_factory=HighRisk)
    multi_currency: MultiCurrency = field(default_factory=MultiCurrency)
    fail_spike: FailSpike = field(default_factory=FailSpike)


# The live feed looks back further for three rules than the case rules do.
FEED = RuleSet(
    velocity=Velocity(window_s=10 * MINUTE),
    large_amount=LargeAmount(window_s=10 * MINUTE),
    high_risk=HighRisk(window_s=10 * MINUTE),
)
