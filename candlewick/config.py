"""Fixed values and tunables.

Everything that has to equal the behaviour being reproduced lives here, stated
plainly and in its natural order.  Tunables are grouped in ``PipelineConfig``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: feature registry (group -> model columns, in model order) ---
FEATURE_GROUPS: dict[str, list[str]] = {
    "microstructure": [
        "bid_ask_spread", "midpoint", "close_vs_mid",
        "price_range", "ask_range", "bid_range", "close_vs_mean",
    ],
    "momentum": [
        "momentum_1h", "momentum_2h",
        "ask_momentum", "bid_momentum", "spread_change",
    ],
    "volume": [
        "volume_delta", "oi_delta", "vol_to_oi", "log_volume", "log_oi",
    ],
    "time": [
        "hours_to_expiry", "is_final_3h", "is_final_1h", "hour_index",
    ],
    "rolling": [
        "close_roll_mean_2h", "close_roll_mean_3h",
        "close_roll_std_2h", "close_roll_std_3h",
        "vol_roll_sum_2h", "vol_roll_sum_3h",
    ],
    "level": [
        "close_is_floor", "close_is_ceiling",
        "close_vs_open",
    ],
    "raw": [
        "close", "ask_close", "bid_close", "open_interest", "volume",
    ],
    "missing_flags": [
        "price_mean_missing", "bid_close_missing", "ask_close_missing",
    ],
}
ALL_FEATURE_COLS: list[str] = [c for cols in FEATURE_GROUPS.values() for c in cols]

# --- fixed values: market validity rules ---
VALID_STATUSES = ["closed", "determined", "settled", "finalized"]
VALID_RESULTS = ["yes", "no"]

# --- fixed values: political keyword list, as effectively matched (72 entries).
# Two quirks are kept on purpose: the misspelt "Helathcare reform", and
# "Prime MinisterSCOTUS & courts", where two entries run together.
POLITICAL_KEYWORDS: list[str] = [
    "election", "US Elections", "Primaries", "House", "International elections", "Senate", "Governor",
    "Trump", "Congress", "Melania", "presidential election",
    "primary election", "Democratic nominee", "Republican", "Swing state", "House majority",
    "Senate majority", "Mayor election", "referendum", "recall election",
    "Government shutdown", "Debt ceiling", "Tax bill", "Helathcare reform", "recount", "foreign election",
    "National security", "ceasefire", "sanction", "nato",
    "NOMINEE", "Prime MinisterSCOTUS & courts", "Recurring", "Iran", "Hormuz", "Strait", "government",
    "Kash Patel",
    "Attorney", "Cabinet", "Venezuela", "Hegseth", "Americans", "tariffs", "DHS", "citizenship", "voter",
    "legislation", "immigration", "immigrants",
    "Justice", "Supreme Court", "Senators", "Fed chair", "federal crime", "approval rating",
    "defense funding", "boycott", "executive order", "Powell", "Commissioner", "Cory Mills",
    "pardon", "embassy", "Truth Social", "Secretary of Labor", "Presidency", "Pam Bondi", "Mamdani",
    "Kamala Harris", "House of Representatives", "Legislature",
]

# --- fixed values: question fallback key inside custom_strike ---
ASSOCIATED_MARKETS_KEY = "Associated Markets"

# --- fixed values: error buckets of hours to expiry (right-closed) ---
EXPIRY_BUCKETS: list[tuple[str, float, float | None]] = [
    ("<1h", 0.0, 1.0),
    ("1-3h", 1.0, 3.0),
    ("3-6h", 3.0, 6.0),
    ("6-12h", 6.0, 12.0),
    (">12h", 12.0, None),
]

# --- fixed values: live signal wording and thresholds ---
SIGNAL_TOO_EARLY = "TOO EARLY — need more candles"
SIGNAL_MIN_CANDLES = 3
SIGNAL_YES_ABOVE = 0.65
SIGNAL_NO_BELOW = 0.35

# --- fixed values: boosted-tree search grid (names and settings) ---
HYPERPARAM_CONFIGS: dict[str, dict[str, float]] = {
    "Config-A (default)": {
        "learning_rate": 0.05, "num_leaves": 20,
        "min_data_in_leaf": 10, "lambda_l2": 1,
        "feature_fraction": 0.8, "bagging_fraction": 0.8,
    },
    "Config-B (deep+reg)": {
        "learning_rate": 0.02, "num_leaves": 50,
        "min_data_in_leaf": 10, "lambda_l2": 5.0,
        "feature_fraction": 0.7, "bagging_fraction": 0.7,
    },
    "Config-C (shallow+fast)": {
        "learning_rate": 0.10, "num_leaves": 15,
        "min_data_in_leaf": 20, "lambda_l2": 5.0,
        "feature_fraction": 0.9, "bagging_fraction": 0.9,
    },
}
# primary model defaults (used when no search result overrides them)
PRIMARY_MODEL = {
    "learning_rate": 0.05, "num_leaves": 31, "min_data_in_leaf": 10, "lambda_l2": 1.0,
    "feature_fraction": 0.8, "bagging_fraction": 0.8,
}
# secondary (depth-wise) model
SECONDARY_MODEL = {
    "learning_rate": 0.05, "max_depth": 5, "subsample": 0.8, "colsample_bytree": 0.8, "lambda": 1.0,
}
BAGGING_FREQ = 5                 # rounds of the primary model that share a sample of rows
ENSEMBLE_PRIMARY_WEIGHT = 0.6
SEED = 42
SENTINEL = -999.0


@dataclass(frozen=True)
class PipelineConfig:
    train_ratio: float = 0.70
    val_ratio: float = 0.15
    test_ratio: float = 0.15
    min_hours_to_expiry: float = 6.0
    backtest_threshold: float = 0.60
    feature_selection_threshold: float = 0.001
    clip_quantile: float = 0.99
    max_samples: int | None = None   # optional cap of the sample builder (it keeps max_samples + 1 rows)
    n_folds: int = 5
    seed: int = SEED
    max_rounds: int = 500            # boosting rounds before early stopping
    patience: int = 30
    ablation_rounds: int = 200
    ablation_patience: int = 20
    lookback_days: int = 100
    skew_safe: bool = False          # per-market block on bounded row chunks (see operators/chunked.py)
    keywords: tuple[str, ...] = field(default_factory=lambda: tuple(POLITICAL_KEYWORDS))


DEFAULT_CONFIG = PipelineConfig()
