"""Job settings from a YAML file; unknown keys are errors."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from quotegrid.config import (
    DEFAULT_LIVE_WARMUP_MINUTES,
    DEFAULT_MODEL_LOOKBACK_DAYS,
    FeatureConfig,
    GridConfig,
    TrainConfig,
)
from quotegrid.sources.assets import read_assets, tick_sizes
from quotegrid.sources.quotes import QuoteFiles
from quotegrid.sources.rawdays import BackfilledQuotes, RawDays, vendor_fetch
from quotegrid.sources.vendor_source import VendorStore


def _make(cls, values: dict | None, **more):
    values = dict(values or {})
    unknown = set(values) - {f.name for f in fields(cls)}
    if unknown:
        raise ValueError(f"unknown {cls.__name__} settings: {sorted(unknown)}")
    return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()}, **more)


@dataclass(frozen=True)
class LiveConfig:
    """``events`` is a folder of JSON lines and ``out`` a folder of messages; with ``kafka_servers`` both are topics.

    ``clock_per_second`` ticks move the grid on while the feed is silent; 0 is for recorded feeds.
    """

    events: str = ""
    out: str = ""
    checkpoint: str = ""
    kafka_servers: str | None = None
    warmup_minutes: int = DEFAULT_LIVE_WARMUP_MINUTES
    lookback_days: int = DEFAULT_MODEL_LOOKBACK_DAYS
    delay: str = "1 second"
    clock_per_second: int = 0
    max_ahead_s: int = 60
    max_age_s: int | None = None
    log: str | None = None  # folder of the log of sent batches; beside the checkpoint, if not set


@dataclass(frozen=True)
class JobConfig:
    store: str
    assets: str
    symbols: tuple[str, ...]
    first_day: date
    last_day: date
    instrument_type: str = "future"
    quotes: str | None = None
    quote_files: dict[str, str] = field(default_factory=dict)
    vendor: VendorStore | None = None  # where raw days come from that the quotes lack
    raw_days: str | None = None  # folder of fetched raw days; below the store, if not set
    features: FeatureConfig = field(default_factory=FeatureConfig)
    train: TrainConfig = field(default_factory=TrainConfig)
    live: LiveConfig = field(default_factory=LiveConfig)
    parallel_fits: int = 4

    @classmethod
    def parse(cls, conf: dict) -> JobConfig:
        conf = dict(conf)
        grid = _make(GridConfig, conf.pop("grid", None))
        features = _make(FeatureConfig, conf.pop("features", None), grid=grid)
        train = _make(TrainConfig, conf.pop("train", None))
        live = _make(LiveConfig, conf.pop("live", None))
        vendor = conf.pop("vendor", None)
        vendor = None if vendor is None else _make(VendorStore, vendor)
        return _make(cls, conf, features=features, train=train, live=live, vendor=vendor)

    def tick_sizes(self, spark: SparkSession) -> DataFrame:
        return tick_sizes(read_assets(spark, self.assets), self.instrument_type)

    def load_quotes(self, spark: SparkSession, now: datetime) -> DataFrame | QuoteFiles | BackfilledQuotes:
        """The quote table, or the best file of every symbol-day below the roots, opened as days are asked for.

        With a vendor store, days that are in neither are fetched from it once and kept as raw days.
        """
        if self.quotes:
            quotes = spark.read.parquet(self.quotes)
        elif self.quote_files:
            quotes = QuoteFiles(spark, self.quote_files, may_be_empty=self.vendor is not None)
        else:
            raise ValueError("set quotes or quote_files")
        if self.vendor is None and self.raw_days is None:
            return quotes
        days = RawDays(self.raw_days or f"{self.store}/raw_days")
        return BackfilledQuotes(quotes, days, self.vendor and vendor_fetch(self.vendor, now), now)


def load_config(path: str) -> JobConfig:
    try:
        import yaml
    except ImportError as exc:  # the library itself needs no YAML
        raise RuntimeError("reading a job file needs PyYAML") from exc
    with open(path, encoding="utf-8") as f:
        return JobConfig.parse(yaml.safe_load(f))
