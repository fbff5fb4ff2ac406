"""Job settings. Everything that changes an answer is a parameter here."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

DAY_NS = 86_400_000_000_000
MINUTE_NS = 60_000_000_000

# Production defaults whose results must be reproduced.
DEFAULT_INTERVAL_NS = 20_000_000
DEFAULT_VOL_WINDOWS = (1, 3, 5, 10, 15, 30, 60, 120)
DEFAULT_LABEL_WINDOW = 5
DEFAULT_TRAIN_DAYS = 7
DEFAULT_VAL_DAYS = 1
DEFAULT_TEST_DAYS = 1
DEFAULT_MODEL_LOOKBACK_DAYS = 30
DEFAULT_LIVE_WARMUP_MINUTES = 5
LABEL_QUANTILES = 1000


@dataclass(frozen=True)
class GridConfig:
    """A regular time grid cut into days.

    ``utc_offset_minutes`` moves the day boundary; the interval must divide a day.
    ``min_block_points`` is the least number of grid points one window task owns.
    """

    interval_ns: int = DEFAULT_INTERVAL_NS
    use_prev_day: bool = True
    utc_offset_minutes: int = 0
    min_block_points: int = 100_000

    def __post_init__(self):
        if self.interval_ns <= 0 or DAY_NS % self.interval_ns:
            raise ValueError("interval_ns must divide one day")

    @property
    def offset_ns(self) -> int:
        return self.utc_offset_minutes * MINUTE_NS

    @property
    def origin_ns(self) -> int:
        return -self.offset_ns % self.interval_ns

    @property
    def points_per_day(self) -> int:
        return DAY_NS // self.interval_ns

    @property
    def session_points(self) -> int:
        return self.points_per_day * (2 if self.use_prev_day else 1)

    @property
    def target_from(self) -> int:
        """Index of the first grid point that belongs to the feature date itself."""
        return self.points_per_day if self.use_prev_day else 0

    def ticks(self, minutes: int) -> int:
        return minutes * MINUTE_NS // self.interval_ns


@dataclass(frozen=True)
class FeatureConfig:
    grid: GridConfig = field(default_factory=GridConfig)
    vol_windows: tuple[int, ...] = DEFAULT_VOL_WINDOWS
    label_window: int = DEFAULT_LABEL_WINDOW
    warmup_minutes: int = 0

    def __post_init__(self):
        if self.label_window not in self.vol_windows:
            raise ValueError(f"vol_windows must contain the label window {self.label_window}")
        if any(self.grid.ticks(w) < 1 for w in self.vol_windows):
            raise ValueError("every window must span at least one grid interval")

    @property
    def vol_columns(self) -> list[str]:
        return [f"vol_{w}m" for w in self.vol_windows]

    @property
    def ratio_pairs(self) -> list[tuple[int, int]]:
        return [(a, b) for a, b in combinations(self.vol_windows, 2) if b > a]

    @property
    def feature_columns(self) -> list[str]:
        ratios = [f"vol_ratio_{a}m_{b}m" for a, b in self.ratio_pairs]
        return self.vol_columns + ratios + ["hour", "minute", "tod_sin", "tod_cos"]

    @property
    def label_column(self) -> str:
        return f"y_vol_{self.label_window}m"


@dataclass(frozen=True)
class TrainConfig:
    train_days: int = DEFAULT_TRAIN_DAYS
    val_days: int = DEFAULT_VAL_DAYS
    test_days: int = DEFAULT_TEST_DAYS
    downsample_ns: int | None = None
    quantiles: int = LABEL_QUANTILES
    # Boosted-tree settings. Depth 6 gives the 64 leaves of the leaf-wise original.
    max_iter: int = 1000
    max_depth: int = 6
    step_size: float = 0.05
    min_instances: int = 50
    feature_fraction: float = 0.8
    max_bins: int = 255
    seed: int = 42
    # Fixed value: trees without a lower validation error after which a fit looks no further.
    patience: int = 50

    def tree_params(self) -> dict[str, str]:
        names = ("max_iter", "max_depth", "step_size", "min_instances", "feature_fraction", "max_bins", "seed")
        return {n: str(getattr(self, n)) for n in names}
