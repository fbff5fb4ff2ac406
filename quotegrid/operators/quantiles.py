"""Exact quantiles of groups of any size, and the label's quantile-to-normal map."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotegrid.session import materialize, small_side

# Distance to the outer quantiles that counts as outside, and the end of the normal scale.
EDGE = 1e-7
NORMAL_LIMIT = NormalDist().inv_cdf(1 - (EDGE - 2.0**-52))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float] | None = None, count: int | None = None
) -> DataFrame:
    """``keys, n, quantiles``: linear-interpolated quantiles of the non-null, non-NaN values.

    Either explicit ``probs``, or ``min(n, count)`` evenly spaced ones.

    Equal values are merged first, and the merged values are cut into ranges of
    about equal size. Ranks are then found inside single ranges, so a group
    holding most of the rows is spread like any other. The cut is written once:
    its totals and its ranks must agree even if an executor is lost.
    """
    keys = list(keys)
    merged = (
        df.where(F.col(value).isNotNull() & ~F.isnan(value))
        .select(*keys, F.col(value).alias("_value"))
        .groupBy(*keys, "_value")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = materialize(
        merged.repartitionByRange(width, *keys, "_value").withColumn("_bin", F.spark_partition_id()), "quantile-cut"
    )

    # Rows before each range, and per group.
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    totals = (
        cut.groupBy(*keys, "_bin")
        .agg(F.sum("_rows").alias("_rows"))
        .withColumn("_at", F.sum("_rows").over(by_bin) - F.col("_rows"))
    )
    sizes = totals.groupBy(*keys).agg(F.sum("_rows").alias("_n"))

    # The two ranks around each asked quantile.
    if probs is not None:
        asked = sizes.select(*keys, "_n", F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_k", "_p"))
    else:
        last = F.least(F.col("_n"), F.lit(count).cast("bigint")) - 1
        asked = sizes.select(*keys, "_n", last.alias("_last"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_k"))
        asked = asked.withColumn("_p", F.when(F.col("_last") > 0, F.col("_k") / F.col("_last")).otherwise(0.0))
    asked = asked.withColumn("_pos", F.col("_p") * (F.col("_n") - 1))
    either = F.explode(F.array(F.floor("_pos"), F.ceil("_pos"))).alias("_at")
    ranks = asked.select(*keys, "_n", "_k", "_pos", either, F.lit(1).alias("_is_rank")).distinct()

    # Which range holds each rank, then which value in it: the last one at or before the rank.
    order = ("_at", "_is_rank")
    starts = totals.select(*keys, "_at", "_bin", F.lit(0).alias("_is_rank"))
    located = (
        starts.unionByName(ranks, allowMissingColumns=True)
        .withColumn("_bin", F.last("_bin", True).over(Window.partitionBy(*keys).orderBy(*order)))
        .where("_is_rank = 1")
    )
    inside = Window.partitionBy(*keys, "_bin")
    placed = (
        cut.join(located.select(*keys, "_bin").distinct(), [*keys, "_bin"], "left_semi")
        .join(totals.select(*keys, "_bin", F.col("_at").alias("_base")), [*keys, "_bin"])
        .withColumn("_at", F.col("_base") + F.sum("_rows").over(inside.orderBy("_value")) - F.col("_rows"))
        .select(*keys, "_bin", "_at", "_value", F.lit(0).alias("_is_rank"))
    )
    found = (
        placed.unionByName(located, allowMissingColumns=True)
        .withColumn("_value", F.last("_value", True).over(inside.orderBy(*order)))
        .where("_is_rank = 1")
    )
    part = F.col("_pos") - F.floor("_pos")
    lo, hi = F.min("_value"), F.max("_value")
    points = found.groupBy(*keys, "_n", "_k", "_pos").agg((lo + (hi - lo) * part).alias("_q"))
    return points.groupBy(*keys).agg(
        F.first("_n").alias("n"),
        F.transform(F.sort_array(F.collect_list(F.struct("_k", "_q"))), lambda s: s["_q"]).alias("quantiles"),
    )


def describe(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, mean, sample std, min, quartiles and max; NaN and null are left out."""
    keep = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    moments = keep.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    q = exact_quantiles(df, keys, value, probs=(0.25, 0.5, 0.75)).drop("n")
    return moments.join(q, list(keys)).select(
        *keys, "n", "mean", "std", "min", *[F.col("quantiles")[i].alias(c) for i, c in enumerate(("p25", "p50", "p75"))], "max"
    )


# -- sketches, for groups of which not all rows can be merged and sorted again


SKETCH_K = 1600  # ranks are right within about 1.65 / k of the rows, with 99 % confidence


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """``keys, n, low, high, sketch``: a KLL sketch of a group's values, to be stored by day and merged over any days."""
    good = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    sketch = F.kll_sketch_agg_double(value, F.lit(k))
    return good.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), sketch.alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """One sketch per group out of many; the values are not read again."""
    merged = F.kll_merge_agg_double("sketch", F.lit(k))
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), merged.alias("sketch"))


def sketched_quantiles(sketches: DataFrame, keys: Sequence[str], count: int) -> DataFrame:
    """``keys, n, quantiles``: ``count`` (2 or more) evenly spaced ones within the sketches' error; the ends are exact.

    Each is a value of the group, also where ``exact_quantiles`` would interpolate.
    """
    inner = F.array(*[F.lit(i / (count - 1)) for i in range(1, count - 1)])
    found = [F.kll_sketch_get_quantile_double("sketch", inner)] if count > 2 else []
    return sketches.select(*keys, "n", F.concat(F.array("low"), *found, F.array("high")).alias("quantiles"))


def quantile_array(table: DataFrame) -> np.ndarray:
    """The quantiles of a table of one group, to be kept with the model they belong to."""
    rows = table.select("quantiles").limit(2).collect()
    if len(rows) != 1:
        raise ValueError("the quantiles of exactly one group are wanted")
    return np.asarray(rows[0][0], dtype=float)


# Coefficients of algorithm AS 241 (Wichura 1988) for the normal quantile,
# highest power first, numerator then denominator: the centre, the tails, the far tails.
AS241 = (
    (
        (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
         13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.3871328727963666080),
        (5226.4952788528545610, 28729.085735721942674, 39307.895800092710610, 21213.794301586595867,
         5394.1960214247511077, 687.18700749205790830, 42.313330701600911252, 1.0),
    ),
    (
        (7.7454501427834140764e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258,
         3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734),
        (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
         6.89767334985100004550e-1, 1.67638483018380384940, 2.05319162663775882187, 1.0),
    ),
    (
        (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
         2.96560571828504891230e-1, 1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720),
        (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
         1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
    ),
)


def normal_quantile(p: np.ndarray) -> np.ndarray:
    """Inverse of the normal distribution function; infinite at 0 and 1."""
    q = p - 0.5
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.sqrt(-np.log(np.minimum(p, 1 - p)))
        c = 0.180625 - q * q
        ratio = lambda k, x: np.polyval(AS241[k][0], x) / np.polyval(AS241[k][1], x)
        tail = np.where(r <= 5.0, ratio(1, r - 1.6), ratio(2, r - 5.0))
        z = np.where(np.abs(q) <= 0.425, q * ratio(0, c), np.copysign(tail, q))
    return np.where(p <= 0.0, -np.inf, np.where(p >= 1.0, np.inf, z))


def _uniform(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Rank in [0, 1]; a value equal to several quantiles takes the middle of their ranks."""
    r = np.linspace(0.0, 1.0, len(q))
    return 0.5 * (np.interp(x, q, r) - np.interp(-x, -q[::-1], -r[::-1]))


def to_uniform_array(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    u = _uniform(x, q)
    u[x == q[-1]] = 1.0
    u[x == q[0]] = 0.0
    return u


def to_normal_array(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    u = _uniform(x, q)
    u[x + EDGE > q[-1]] = 1.0
    u[x - EDGE < q[0]] = 0.0
    return np.clip(normal_quantile(u), -NORMAL_LIMIT, NORMAL_LIMIT)


# The distribution function at multiples of 1 / GRID, where it is developed into a series.
GRID = 256
_AT = np.arange(-8 * GRID, 8 * GRID + 1) / GRID
_CDF = np.array([0.5 * math.erfc(-x * math.sqrt(0.5)) for x in _AT])
_DENSITY = np.exp(-0.5 * _AT * _AT) / math.sqrt(2 * math.pi)


def normal_cdf(z: np.ndarray) -> np.ndarray:
    """The normal distribution function, from five terms of its series at the nearest grid point."""
    x = np.clip(z, -8.0, 8.0)
    with np.errstate(invalid="ignore"):
        k = np.where(np.isnan(x), 0.0, np.rint(x * GRID)).astype(np.int64) + 8 * GRID
    c, d = _AT[k], x - _AT[k]
    terms = 1 - d / 2 * (c - d / 3 * ((c * c - 1) - d / 4 * ((c * c - 3) * c - d / 5 * ((c * c - 6) * c * c + 3))))
    return _CDF[k] + _DENSITY[k] * d * terms


def from_normal_array(z: np.ndarray, q: np.ndarray) -> np.ndarray:
    u = normal_cdf(z)
    x = np.interp(u, np.linspace(0.0, 1.0, len(q)), q)
    x[u + EDGE > 1] = q[-1]
    x[u - EDGE < 0] = q[0]
    return x


def _mapped(fn, q: np.ndarray, value: Column) -> Column:
    @F.pandas_udf("double")
    def apply(v: pd.Series) -> pd.Series:
        out = pd.Series(np.nan, index=v.index, dtype=float)
        good = v.dropna()
        if len(good):
            out.loc[good.index] = fn(good.to_numpy(dtype=float).copy(), q)
        return out

    return apply(value)


def to_normal(q: np.ndarray, value: Column) -> Column:
    """A model's own label on the normal scale."""
    return _mapped(to_normal_array, q, value)


def from_normal(q: np.ndarray, value: Column) -> Column:
    return _mapped(from_normal_array, q, value)


# -- all groups at once: quantiles are rows, and are met by joins


def quantile_steps(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``q``, ``p0`` and ``p`` (its first and last rank), ``q2`` and ``p2`` (the next quantile, its first rank), ``lo``, ``hi``.

    One for each different quantile, and one that begins below all values. A group has as many as its table, so few.
    """
    keys = list(keys)
    ranked = table.select(*keys, F.size("quantiles").alias("_m"), F.posexplode("quantiles").alias("_k", "q"))
    p = F.when(F.col("_m") > 1, F.col("_k") / (F.col("_m") - 1)).otherwise(0.0)
    each = ranked.groupBy(*keys, "q").agg(F.min(p).alias("p0"), F.max(p).alias("p"))
    low = table.select(*keys, F.lit(float("-inf")).alias("q"), F.lit(0.0).alias("p0"), F.lit(0.0).alias("p"))
    group = Window.partitionBy(*keys)
    ends = {"lo": F.min(F.when(F.col("q") > float("-inf"), F.col("q"))).over(group), "hi": F.max("q").over(group)}
    after = {c: F.lead(of).over(group.orderBy("q")) for c, of in (("q2", "q"), ("p2", "p0"))}
    return each.unionByName(low).withColumns(ends | after)


STEP = ("q", "p0", "p", "q2", "p2", "lo", "hi")


def with_steps(df: DataFrame, steps: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``df`` with ``step``: the last one at or below each value; null for a group without steps.

    Values and steps are dealt into the same ranges, and a range takes the step it begins in from
    those before it: a group that holds most of the rows is many tasks, and nothing is broadcast or collected.
    """
    keys, spark = list(keys), df.sparkSession
    packed = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], F.col(value).alias("_v"), F.lit(1).alias("_kind"), packed.alias("_row"))
    marks = steps.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], F.col("q").alias("_v"), F.lit(0).alias("_kind"), F.struct(*STEP).alias("_step"))
    group = [f"_k{i}" for i in range(len(keys))]
    both = rows.unionByName(marks, allowMissingColumns=True)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartitionByRange(width, *group, "_v", "_kind")
    cut = materialize(dealt.withColumn("_piece", F.spark_partition_id()), "quantile-steps")
    last = F.max_by("_step", F.when(F.col("_kind") == 0, F.col("_v"))).alias("_step")
    pieces = cut.groupBy(*group, "_piece").agg(last)
    earlier = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(*[F.col(c).alias(f"{c}_") for c in group], F.col("_piece").alias("_piece_"), F.last("_step", True).over(earlier).alias("_before"))
    here = Window.partitionBy(*group, "_piece").orderBy("_v", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    met = cut.withColumn("_here", F.last("_step", True).over(here)).where("_kind = 1")
    on = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in (*group, "_piece")]
    found = met.join(carried, on, "left")
    return found.select("_row.*", F.coalesce("_here", "_before").alias("step"))


def uniform_score(value: Column, step: Column) -> Column:
    """Rank in [0, 1]; a value equal to several quantiles takes the middle of their ranks."""
    slope = (step["p2"] - step["p"]) / (step["q2"] - step["q"])
    return (
        F.when(value.isNull() | F.isnan(value) | step.isNull(), F.lit(None))
        .when(value <= step["lo"], 0.0)
        .when(value >= step["hi"], 1.0)
        .when(value == step["q"], (step["p0"] + step["p"]) / 2)
        .otherwise(step["p"] + (value - step["q"]) * slope)
    )


def _polynomial(coefficients: Sequence[float], x: Column) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + c
    return out


def normal_quantile_column(p: Column) -> Column:
    """Inverse of the normal distribution function for 0 < p < 1."""
    q = p - 0.5
    r = F.sqrt(-F.ln(F.least(p, 1 - p)))
    ratio = lambda k, x: _polynomial(AS241[k][0], x) / _polynomial(AS241[k][1], x)
    tail = F.when(r <= 5.0, ratio(1, r - 1.6)).otherwise(ratio(2, r - 5.0))
    return F.when(F.abs(q) <= 0.425, q * ratio(0, 0.180625 - q * q)).otherwise(F.signum(q) * tail)


def normal_score(value: Column, step: Column) -> Column:
    """The value on the normal scale; what lies at or beyond the outer quantiles goes to the scale's ends."""
    u = uniform_score(value, step)
    z = normal_quantile_column(F.when((u > 0) & (u < 1), u))
    inner = F.least(F.greatest(z, F.lit(-NORMAL_LIMIT)), F.lit(NORMAL_LIMIT))
    return (
        F.when(u.isNull(), F.lit(None))
        .when(value - EDGE < step["lo"], -NORMAL_LIMIT)
        .when(value + EDGE > step["hi"], NORMAL_LIMIT)
        .otherwise(inner)
    )


def normal_cdf_column(z: Column | str) -> Column:
    @F.pandas_udf("double")
    def cdf(v: pd.Series) -> pd.Series:
        return pd.Series(normal_cdf(v.to_numpy(dtype=float)), index=v.index)

    return cdf(z)


def with_values(df: DataFrame, table: DataFrame, keys: Sequence[str], score: str, out: str) -> DataFrame:
    """``df`` with the value ``out`` that each normal score stands for; null for a group without quantiles.

    A score's rank tells the two quantiles around it, which are met by an equi-join on group and rank.
    """
    keys = list(keys)
    names = {c: f"_k{i}" for i, c in enumerate(keys)}
    sizes = table.select(*[F.col(c).alias(n) for c, n in names.items()], F.size("quantiles").alias("_m"))
    on = lambda: [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    ranked = df.withColumn("_u", normal_cdf_column(score)).join(small_side(sizes), on(), "left").drop(*names.values())
    ranked = ranked.withColumn("_pos", F.col("_u") * (F.col("_m") - 1))
    ranked = ranked.withColumn("_at", F.least(F.floor("_pos"), F.greatest(F.col("_m") - 2, F.lit(0))))
    pairs = table.select(
        *[F.col(c).alias(n) for c, n in names.items()],
        F.array_min("quantiles").alias("_lo"),
        F.array_max("quantiles").alias("_hi"),
        F.posexplode(F.transform("quantiles", lambda x, i: F.struct(x.alias("a"), F.get("quantiles", i + 1).alias("b")))).alias("_i", "_q"),
    )
    met = ranked.join(pairs, [*on(), F.col("_at") == F.col("_i")], "left")
    inner = F.col("_q.a") + (F.coalesce("_q.b", "_q.a") - F.col("_q.a")) * (F.col("_pos") - F.col("_at"))
    known = F.col(score).isNotNull() & ~F.isnan(score)
    value = F.when(F.col("_u") - EDGE < 0, F.col("_lo")).when(F.col("_u") + EDGE > 1, F.col("_hi")).otherwise(inner)
    return met.select(*df.columns, F.when(known, value).alias(out))
