"""Rolling volatility of tick moves from exact prefix sums.

A mid price in ticks is rounded to one decimal, so a move in tenths of a tick is
an integer. Prefix sums are taken over the sparse runs; on the dense grid a
window needs only the sums ``w`` points back, whatever its length.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotegrid.operators.asof import BLOCK_KEYS, QUOTE_FIELDS, RUN_ORDER, BlockLayout, expand_runs

MAX_LONG = 2**63 - 1
# A move of this many tenths of a tick is beyond what a double holds exactly.
MOVE_LIMIT = float(2**53)
PREFIXES = ("s1", "s2", "big", "bad")


def mid_price() -> Column:
    return (F.col("ask_price") + F.col("bid_price")) / 2


def mid_tick(mid: Column, tick_size: Column) -> Column:
    return F.round(F.try_divide(mid, tick_size), 1)


def add_moves(runs: DataFrame) -> DataFrame:
    """Mid in ticks, its change at each run start (0 beside a null) and whether the quote is whole."""
    w = Window.partitionBy(*BLOCK_KEYS).orderBy(*RUN_ORDER)
    mid = (F.col("quote.ask_price") + F.col("quote.bid_price")) / 2
    whole = F.col("mid_tick").isNotNull()
    for c in QUOTE_FIELDS:
        whole = whole & F.col(f"quote.{c}").isNotNull()
    return (
        runs.withColumn("mid_tick", mid_tick(mid, F.col("tick_size")))
        .withColumn("whole", whole)
        .withColumn("move", F.coalesce(F.col("mid_tick") - F.lag("mid_tick").over(w), F.lit(0.0)))
    )


def add_prefix_sums(runs: DataFrame, layout: BlockLayout) -> DataFrame:
    """Running sums of the moves in tenths of a tick.

    ``s1`` and ``s2`` are exact. A move too large for its square to be summed
    in a long goes to ``big`` as a double; NaN moves are counted in ``bad``.
    """
    w = Window.partitionBy(*BLOCK_KEYS).orderBy(*RUN_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    tenths = F.rint(F.col("move") * 10)
    usable = ~F.isnan(tenths) & (F.abs(tenths) < MOVE_LIMIT)
    largest = math.isqrt(MAX_LONG // layout.max_rows)
    x = F.col("x")
    small = F.abs(x) <= F.lit(largest)
    return (
        runs.withColumn("x", F.when(usable, tenths).otherwise(0.0).cast("bigint"))
        .withColumn("nan", F.when(usable, 0).otherwise(1))
        .withColumns(
            {
                "s1": F.sum(x).over(w),
                "s2": F.sum(F.when(small, x * x).otherwise(F.lit(0).cast("bigint"))).over(w),
                "big": F.sum(F.when(small, F.lit(0.0)).otherwise(x.cast("double") * x.cast("double"))).over(w),
                "bad": F.sum("nan").over(w),
            }
        )
        .drop("x", "nan")
    )


def _std(later: dict[str, Column], earlier: dict[str, Column], w: int, ddof: int) -> Column:
    """Standard deviation in ticks of the ``w`` moves between two prefix sums.

    The sums are exact integers, so nothing is lost to cancellation between them.
    Kept short on purpose: eight windows share one generated method.
    """
    if w <= ddof:
        return F.lit(float("nan"))
    a = (later["s1"] - earlier["s1"]).cast("double")
    b = (later["s2"] - earlier["s2"]).cast("double") + (later["big"] - earlier["big"])
    spread = F.greatest(F.lit(float(w)) * b - a * a, F.lit(0.0))
    return F.sqrt(spread / F.lit(100.0 * w * (w - ddof)))


def _window_sums(d: DataFrame, windows: Iterable[int], ahead: int | None) -> DataFrame:
    """Prefix sums ``w`` points back, and ``ahead`` points on, in one window pass."""
    w = Window.partitionBy(*BLOCK_KEYS).orderBy("point")
    zero = {"s1": 0, "s2": 0, "big": 0.0, "bad": 0}
    cols = {f"{p}_back_{t}": F.lag(p, t, zero[p]).over(w) for t in windows for p in PREFIXES}
    if ahead is not None:
        cols |= {f"{p}_ahead": F.lead(p, ahead).over(w) for p in PREFIXES}
    return d.withColumns(cols)


def rolling_std(
    dense: DataFrame,
    windows: Mapping[str, int],
    ddof: int = 1,
    first_point: Column | None = None,
    forward: tuple[str, int] | None = None,
) -> DataFrame:
    """Add the rolling std of the moves for each named window length in points.

    NaN until ``w`` points were seen, counted from ``first_point`` (default 0).
    ``forward`` names a column for the std that the given length later takes;
    it is null where the session ends first.
    """
    point = F.col("point") if first_point is None else F.col("point") - first_point
    nan = F.lit(float("nan"))
    summed = _window_sums(dense, set(windows.values()), forward[1] if forward else None)
    here = {p: F.col(p) for p in PREFIXES}
    out = {}
    for name, ticks in windows.items():
        back = {p: F.col(f"{p}_back_{ticks}") for p in PREFIXES}
        empty = (point < ticks - 1) | (here["bad"] > back["bad"])
        out[name] = F.when(empty, nan).otherwise(_std(here, back, ticks, ddof))
    if forward:
        later = {p: F.col(f"{p}_ahead") for p in PREFIXES}
        std = F.when(later["bad"] > here["bad"], nan).otherwise(_std(later, here, forward[1], ddof))
        out[forward[0]] = F.when(later["s1"].isNotNull(), std)
    return summed.withColumns(out)


def dense_sums(runs: DataFrame, layout: BlockLayout) -> DataFrame:
    """Every grid point of every block with its prefix sums."""
    return expand_runs(add_prefix_sums(add_moves(runs), layout))


def ratio(short: Column, long: Column) -> Column:
    """Ratio of two volatilities: 1 if both are zero; NaN if either is NaN or only the long one is zero."""
    return (
        F.when(long != 0, short / long)  # NaN on either side gives NaN
        .when(short == 0, F.lit(1.0))
        .otherwise(F.lit(float("nan")))
    )
