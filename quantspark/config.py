"""Frozen run parameters (replaces the YAML/env configuration)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference configuration for equal results:
# trading sessions (UTC, half-open [open, close)), matched in the order us, europe, asia;
# blocked accounts; rolling windows; dedup window; walk-forward windows; annualisation.
SESSION_ORDER = ("us", "europe", "asia")
DEFAULT_SESSIONS = {          # minutes of the day
    "asia": (0, 9 * 60),
    "europe": (7 * 60, 16 * 60),
    "us": (13 * 60 + 30, 20 * 60),
}
DEFAULT_BLOCKED_ACCOUNTS = ("ACC_TEST", "ACC_INVALID", "ACC_DEMO", "ACC_PAPER")
MACRO_SERIES = ("CPIAUCSL", "DGS10", "DGS2", "FEDFUNDS", "UNRATE")


@dataclass(frozen=True)
class Params:
    # cleaning
    dedup_window: str = "500 milliseconds"
    blocked_accounts: tuple = DEFAULT_BLOCKED_ACCOUNTS
    # features
    feature_version: str = "2.0"
    pipeline_version: str = "1.0.0"
    rolling_short: int = 5
    rolling_long: int = 20
    macro_window: int = 12
    ewma_span: int = 12
    sessions: dict = field(default_factory=lambda: dict(DEFAULT_SESSIONS))
    # walk-forward
    train_days: int = 30
    test_days: int = 7
    min_train_rows: int = 10
    min_test_rows: int = 1
    expanding: bool = False
    # model
    seed: int = 42
    target: str = "pnl"
    baseline_permutation: str = "P_DEFAULT"
    tuner: str = "gridsearch"
    sampled_trials: int = 20
    enable_stacking: bool = False
    # evaluation
    annualization: int = 252
    risk_free_rate: float = 0.0
    # ordered operators: rows per block of the position index / halo windows
    block_rows: int = 1 << 16
    # as-of join: width of the equi-join bucket on the time axis
    asof_bucket: str = "day"

    def session_minutes(self):
        """[(name, open_minute, close_minute)] in match order."""
        return [(name, *self.sessions[name]) for name in SESSION_ORDER]
