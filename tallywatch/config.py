"""Every threshold, length and weight the operators use, as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class WindowConfig:
    """Sliding windows over event time."""

    length: str = "1 hour"
    slide: str = "5 minutes"
    watermark: str = "10 minutes"


@dataclass(frozen=True)
class ScoreConfig:
    """Thresholds (all strict) and score weights."""

    zscore_above: float = 3.0
    txn_count_above: int = 20
    country_count_above: int = 3
    amount_above: float = 5000.0
    # Z-score, velocity, country, large amount.
    weight_zscore: float = 0.4
    weight_velocity: float = 0.2
    weight_country: float = 0.25
    weight_large: float = 0.15


@dataclass(frozen=True)
class ViewConfig:
    """How far back each view looks from its as-of time."""

    profile_lookback: str = "24 hours"
    alert_lookback: str = "5 minutes"
    kpi_lookback: str = "1 hour"


@dataclass(frozen=True)
class RuleConfig:
    """Per-transaction rules."""

    burst_amount_above: float = 10_000.0
    burst_frame: str = "1 minute"
    country_count_above: int = 5
    country_frame: str = "24 hours"
    historical_zscore_above: float = 3.0


@dataclass(frozen=True)
class ForestConfig:
    """Isolation forest settings."""

    trees: int = 200
    sample_size: int = 256
    contamination: float = 0.02
    seed: int = 42


@dataclass(frozen=True)
class StreamConfig:
    """Stream source and trigger settings."""

    max_offsets_per_trigger: int = 10_000
    trigger_interval: str = "5 seconds"
    topic: str = "transactions"


@dataclass(frozen=True)
class HealthConfig:
    """Alert limits of the health checks and of the dashboard."""

    lag_above: float = 5000
    dlq_per_minute_above: float = 10
    check_interval_sec: float = 30
    latency_ms_above: float = 2000
    fraud_rate_below: float = 0.001
    fraud_rate_above: float = 0.20
    dashboard_fraud_rate_pct_above: float = 5
    critical_users_above: float = 0


@dataclass(frozen=True)
class DetectionConfig:
    """All settings of one detection run."""

    window: WindowConfig = field(default_factory=WindowConfig)
    score: ScoreConfig = field(default_factory=ScoreConfig)
    views: ViewConfig = field(default_factory=ViewConfig)
    rules: RuleConfig = field(default_factory=RuleConfig)
    stream: StreamConfig = field(default_factory=StreamConfig)
