"""The feature and label matrix over all asked symbol-days at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.config import FeatureConfig, MINUTE_NS
from quotegrid.functions.time import cell_ns, day_start_ns, session_origin_cell, time_of_day_columns
from quotegrid.operators.asof import (
    BlockLayout,
    block_runs,
    daily_frames,
    daily_points,
    endless_frames,
    endless_points,
    snap_to_cells,
)
from quotegrid.operators.rolling import dense_sums, ratio, rolling_std
from quotegrid.session import compile_wide_projections, small_side


def feature_layout(cfg: FeatureConfig) -> BlockLayout:
    ticks = [cfg.grid.ticks(w) for w in cfg.vol_windows]
    return BlockLayout.daily(cfg.grid, back=max(ticks), ahead=cfg.grid.ticks(cfg.label_window))


def daily_runs(
    quotes: DataFrame, sessions: DataFrame, cfg: FeatureConfig, strict: bool = False, prune: bool = False
) -> DataFrame:
    """Quote runs per block. ``sessions`` holds ``symbol, feature_date, tick_size``.

    ``prune`` drops the points of other sessions before they are shuffled. It reads
    ``sessions`` once more, so it is for a stored list of tasks.
    """
    layout = feature_layout(cfg)
    points = daily_points(snap_to_cells(quotes, cfg.grid, strict), cfg.grid)
    if prune:
        points = points.join(small_side(sessions.select("symbol", "feature_date")), ["symbol", "feature_date"], "left_semi")
    frames = daily_frames(sessions.select("symbol", "feature_date", "tick_size"), layout)
    return block_runs(points, frames, layout)


def sampled_volatility(
    quotes: DataFrame,
    sessions: DataFrame,
    cfg: FeatureConfig,
    ddof: int = 1,
    strict: bool = False,
    prune: bool = False,
) -> DataFrame:
    """Grid points of the feature dates with quote, move, volatilities and label, nothing dropped."""
    compile_wide_projections(quotes.sparkSession)
    layout = feature_layout(cfg)
    dense = dense_sums(daily_runs(quotes, sessions, cfg, strict, prune), layout)
    windows = {c: cfg.grid.ticks(w) for c, w in zip(cfg.vol_columns, cfg.vol_windows, strict=True)}
    label = (cfg.label_column, cfg.grid.ticks(cfg.label_window))
    return (
        rolling_std(dense, windows, ddof, forward=label)
        .where(layout.owns(F.col("point"), F.col("block")))
        .select(
            "symbol",
            "feature_date",
            cell_ns(session_origin_cell(F.col("feature_date"), cfg.grid) + F.col("point"), cfg.grid).alias("timestamp"),
            "quote",
            "whole",
            "mid_tick",
            F.when(F.col("point") == F.col("i"), F.col("move")).otherwise(0.0).alias("mid_chg"),
            *cfg.vol_columns,
            cfg.label_column,
        )
    )


def ratio_columns(cfg: FeatureConfig) -> list:
    return [
        ratio(F.col(f"vol_{a}m"), F.col(f"vol_{b}m")).alias(f"vol_ratio_{a}m_{b}m") for a, b in cfg.ratio_pairs
    ]


def keep_complete(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Drop rows with a null quote field or label. NaN is a value and stays."""
    return df.where(F.col("whole") & F.col(cfg.label_column).isNotNull())


def trim_warmup(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    start = day_start_ns(F.col("feature_date"), cfg.grid) + F.lit(cfg.warmup_minutes * MINUTE_NS)
    return df.where(F.col("timestamp") >= start)


def feature_matrix(
    quotes: DataFrame, sessions: DataFrame, cfg: FeatureConfig, strict: bool = False, prune: bool = False
) -> DataFrame:
    """``symbol, feature_date, timestamp``, the feature columns and the label."""
    sampled = sampled_volatility(quotes, sessions, cfg, strict=strict, prune=prune)
    rows = trim_warmup(keep_complete(sampled, cfg), cfg)
    return rows.select(
        "symbol",
        "feature_date",
        "timestamp",
        *cfg.vol_columns,
        *ratio_columns(cfg),
        *time_of_day_columns(F.col("timestamp")),
        cfg.label_column,
    )


def live_volatility(quotes: DataFrame, assets: DataFrame, cfg: FeatureConfig, warmup_minutes: int) -> DataFrame:
    """What the live service computes, over all history: one endless session per symbol.

    Population std, windows counted from the symbol's first sample, and
    ``warm`` set once ``warmup_minutes`` of samples were seen.
    """
    compile_wide_projections(quotes.sparkSession)
    windows = {c: cfg.grid.ticks(w) for c, w in zip(cfg.vol_columns, cfg.vol_windows, strict=True)}
    layout = BlockLayout.endless(cfg.grid, back=max(windows.values()))
    cells = snap_to_cells(quotes, cfg.grid)
    frames = endless_frames(cells, cfg.grid, layout).join(assets.select("symbol", "tick_size"), "symbol")
    dense = dense_sums(block_runs(endless_points(cells), frames, layout), layout)
    samples = F.col("point") - F.col("first_cell") + 1
    return (
        rolling_std(dense, windows, ddof=0, first_point=F.col("first_cell"))
        .where(layout.owns(F.col("point"), F.col("block")))
        .where("point >= first_cell and point <= last_cell")
        .select(
            "symbol",
            cell_ns(F.col("point"), cfg.grid).alias("timestamp"),
            samples.alias("samples"),
            (samples >= F.lit(cfg.grid.ticks(warmup_minutes))).alias("warm"),
            "mid_tick",
            *cfg.vol_columns,
        )
    )
