"""Parameters that fix the meaning of the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

SERIES_KEYS = ("series_id", "item_id", "dept_id", "cat_id", "store_id", "state_id")

# The twelve grouping sets of the product/location hierarchy, in
# level order (level 1 is the empty set).
HIERARCHY = (
    (),
    ("state_id",),
    ("store_id",),
    ("cat_id",),
    ("dept_id",),
    ("state_id", "cat_id"),
    ("state_id", "dept_id"),
    ("store_id", "cat_id"),
    ("store_id", "dept_id"),
    ("item_id",),
    ("state_id", "item_id"),
    ("store_id", "item_id"),
)


@dataclass(frozen=True)
class Guardrails:
    """Limits a model must respect before it may win or be promoted."""

    max_abs_bias: float = 0.05
    coverage_min: float = 0.85
    coverage_max: float = 0.95
    max_fold_degradation: float = 0.05
    improvement: float = 0.01


@dataclass(frozen=True)
class ReplayPolicy:
    """Periodic-review order-up-to policy and its cost rates."""

    lead_days: int = 7
    review_days: int = 7
    service_level: float = 0.95
    paths: int = 1000
    order_cost: float = 5.0
    annual_holding_rate: float = 0.2
    stockout_multiplier: float = 1.0
    initial_on_hand: float | None = None
    name: str = "base"

    def __post_init__(self) -> None:
        if self.lead_days < 1 or self.review_days < 1:
            raise ValueError("lead and review periods must be at least one day")
        if not 0 < self.service_level < 1:
            raise ValueError("service level must lie strictly between zero and one")
        if self.paths < 1:
            raise ValueError("at least one path is needed")

    @property
    def protection_days(self) -> int:
        return self.lead_days + self.review_days


@dataclass(frozen=True)
class Settings:
    """Design of the direct multi-horizon data set and of the backtest."""

    horizon: int = 28
    history_days: int = 730
    origin_step: int = 28
    forecast_origin: int = 2471
    backtest_origins: tuple[int, ...] = (2387, 2415, 2443)
    lags: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7, 14, 28, 56, 364)
    target_lags: tuple[int, ...] = (28, 35, 42, 49, 56, 364)
    rolling: tuple[int, ...] = (7, 28, 56)
    price_window: int = 28
    quantiles: tuple[float, float, float] = (0.05, 0.5, 0.95)
    series_per_state: int | None = None
    tune_fraction: float = 0.1
    seed: int = 42
    guardrails: Guardrails = field(default_factory=Guardrails)
    policy: ReplayPolicy = field(default_factory=ReplayPolicy)

    def __post_init__(self) -> None:
        if self.target_lags and min(self.target_lags) < self.horizon:
            raise ValueError("a target lag shorter than the horizon would need unseen demand")
        if list(self.quantiles) != sorted(self.quantiles):
            raise ValueError("quantiles must be ascending")

    def training_origins(self) -> list[int]:
        """Regularly spaced origins over the usable history, plus every backtest origin."""
        newest = max(self.backtest_origins)
        oldest = max(*self.lags, *self.target_lags, newest - self.history_days)
        regular = range(oldest, newest + 1, self.origin_step)
        return sorted({*regular, *self.backtest_origins})


DEFAULTS = Settings()
