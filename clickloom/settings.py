"""Thresholds, weights and windows, as frozen dataclasses that check themselves."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field


@dataclass(frozen=True)
class ZScore:
    min_baseline_views: int = 20
    min_flag_views: int = 50
    threshold: float = 2.0


@dataclass(frozen=True)
class Features:
    rolling_hours: tuple[int, ...] = (168, 720)
    lag_rows: tuple[int, ...] = (1, 24, 168)


@dataclass(frozen=True)
class Ensemble:
    """Weights of the models' scores; they must sum to 1 within 0.01."""

    weights: dict[str, float] = field(default_factory=lambda: {"lstm": 0.30, "prophet": 0.30, "isolation_forest": 0.25, "changepoint": 0.15})
    voting: str = "weighted"
    threshold: float = 0.5
    min_votes: int = 2
    severity: tuple[tuple[str, float], ...] = (("critical", 0.95), ("high", 0.85), ("medium", 0.70), ("low", 0.50))

    def __post_init__(self):
        if abs(sum(self.weights.values()) - 1) > 0.01:
            raise ValueError(f"ensemble weights sum to {sum(self.weights.values())}")


@dataclass(frozen=True)
class Streaming:
    watermark: str = "2 hours"
    window: str = "1 hour"
    slide: str = "5 minutes"
    realtime_watermark: str = "10 minutes"
    trigger: str = "30 seconds"


@dataclass(frozen=True)
class Adaptive:
    """Thresholds that follow a brand: quantiles of its last hours, once it has enough of them."""

    lookback_hours: int = 168
    low: float = 0.05
    high: float = 0.95
    min_history: int = 3

    def __post_init__(self):
        if not 0 <= self.low <= self.high <= 1:
            raise ValueError(f"quantiles {self.low} and {self.high} are not in order")


SECTIONS = {"zscore": ZScore(), "features": Features(), "ensemble": Ensemble(), "streaming": Streaming(), "adaptive": Adaptive()}


def get_config(section: str) -> dict:
    """The section as a dictionary; unknown sections are empty."""
    return asdict(SECTIONS[section]) if section in SECTIONS else {}
