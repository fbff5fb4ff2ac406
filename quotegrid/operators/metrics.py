"""Forecast scores and last-value downsampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotegrid.functions.time import floor_div

NAN = float("nan")


def qlike_term(y: Column, yhat: Column) -> Column:
    """``r - ln r - 1`` for ``r = y / yhat`` with the limits of IEEE arithmetic written out.

    A ratio of 0, from a zero value or an infinite forecast, gives infinity.
    """
    r = F.try_divide(y, yhat)
    return (
        F.when(yhat == 0, F.lit(NAN))
        .when(r == 0, F.lit(float("inf")))
        .when(r < 0, F.lit(NAN))
        .otherwise(r - F.ln(r) - 1)
    )


def evaluate(df: DataFrame, keys: Sequence[str], y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """Rows used, RMSE, MAE, Pearson correlation and QLIKE per group.

    Rows with NaN (or null) on either side do not count. A group without rows,
    a one-row or constant group's correlation: NaN.
    """
    ok = F.col(y).isNotNull() & F.col(yhat).isNotNull() & ~F.isnan(y) & ~F.isnan(yhat)
    a, b = F.when(ok, F.col(y)), F.when(ok, F.col(yhat))
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    nan = F.lit(NAN)
    return df.groupBy(*keys).agg(
        F.count(F.when(ok, 1)).alias("n"),
        F.coalesce(F.sqrt(F.avg((a - b) * (a - b))), nan).alias("rmse"),
        F.coalesce(F.avg(F.abs(a - b)), nan).alias("mae"),
        F.coalesce(
            F.when((F.count(a) > 1) & (spread > 0), F.try_divide(F.covar_pop(a, b), spread)), nan
        ).alias("corr"),
        F.coalesce(F.avg(F.when(ok, qlike_term(a, b))), nan).alias("qlike"),
    )


# What the scores of rows follow from: sums, and moments about the means.
STATE = ("n", "sum_sq", "sum_abs", "sum_qlike", "mean_y", "mean_p", "m_yy", "m_pp", "m_yp")


def score_states(df: DataFrame, keys: Sequence[str], y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """A mergeable state of the scores per group, see ``STATE``; stored by day it serves any longer span."""
    ok = F.col(y).isNotNull() & F.col(yhat).isNotNull() & ~F.isnan(y) & ~F.isnan(yhat)
    a, b = F.when(ok, F.col(y)), F.when(ok, F.col(yhat))
    n = F.count(F.when(ok, 1))
    none = F.lit(0.0)
    return df.groupBy(*keys).agg(
        n.alias("n"),
        F.coalesce(F.sum((a - b) * (a - b)), none).alias("sum_sq"),
        F.coalesce(F.sum(F.abs(a - b)), none).alias("sum_abs"),
        F.coalesce(F.sum(F.when(ok, qlike_term(a, b))), none).alias("sum_qlike"),
        F.coalesce(F.avg(a), none).alias("mean_y"),
        F.coalesce(F.avg(b), none).alias("mean_p"),
        F.coalesce(F.var_pop(a) * n, none).alias("m_yy"),
        F.coalesce(F.var_pop(b) * n, none).alias("m_pp"),
        F.coalesce(F.covar_pop(a, b) * n, none).alias("m_yp"),
    )


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per group out of many, in any order and grouping."""
    group = Window.partitionBy(*keys)
    n = F.sum("n").over(group)
    mean = lambda c: F.coalesce(F.try_divide(F.sum(F.col("n") * F.col(c)).over(group), n), F.lit(0.0))
    rows = states.withColumns({"_y": mean("mean_y"), "_p": mean("mean_p")})
    dy, dp = F.col("mean_y") - F.col("_y"), F.col("mean_p") - F.col("_p")
    about = lambda c, by: F.sum(F.col(c) + F.col("n") * by).alias(c)
    return rows.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        *[F.sum(c).alias(c) for c in ("sum_sq", "sum_abs", "sum_qlike")],
        F.first("_y").alias("mean_y"),
        F.first("_p").alias("mean_p"),
        about("m_yy", dy * dy),
        about("m_pp", dp * dp),
        about("m_yp", dy * dp),
    )


def scores_of(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The columns of ``evaluate`` from states."""
    nan = F.lit(NAN)
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("n")), nan)
    spread = F.sqrt(F.greatest("m_yy", F.lit(0.0))) * F.sqrt(F.greatest("m_pp", F.lit(0.0)))
    return states.select(
        *keys,
        "n",
        F.sqrt(share("sum_sq")).alias("rmse"),
        share("sum_abs").alias("mae"),
        F.coalesce(F.when((F.col("n") > 1) & (spread > 0), F.try_divide(F.col("m_yp"), spread)), nan).alias("corr"),
        share("sum_qlike").alias("qlike"),
    )


def downsample_last(df: DataFrame, freq_ns: int, ts_col: str = "timestamp", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Last whole row of each time bucket, stamped with the bucket's start."""
    bucket = floor_div(F.col(ts_col), freq_ns) * F.lit(freq_ns).cast("bigint")
    rest = [c for c in df.columns if c not in (*keys, ts_col)]
    last = F.max_by(F.struct(*rest), F.col("_ts"))
    return (
        df.withColumn("_ts", F.col(ts_col))
        .withColumn(ts_col, bucket)
        .groupBy(*keys, ts_col)
        .agg(last.alias("_last"))
        .select(*keys, ts_col, *[F.col(f"_last.{c}").alias(c) for c in rest])
    )
