"""Backward as-of sampling of quotes onto a regular grid.

Each quote is snapped to the first grid point it can serve, and the newest quote
per point is kept by a map-side combining aggregate. The sparse points are then
laid out in blocks of bounded length. A block also holds ``back`` points before
and ``ahead`` points after the ones it owns, so every later window runs inside
one block. The quote in force when a block opens comes from a small table of
block tails. No group grows with the number of quotes: a symbol with a third of
all rows is spread over its blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotegrid.config import DAY_NS, GridConfig
from quotegrid.functions.time import (
    cell_ns,
    day_of_ns,
    div,
    floor_div,
    session_origin_cell,
    session_start_ns,
)

QUOTE_FIELDS = ("bid_price", "ask_price", "bid_amount", "ask_amount")
BLOCK_KEYS = ("symbol", "feature_date", "block")
# Runs of a block in time order; the opening row comes before a cell at the same point.
RUN_ORDER = ("i", "kind")


def valid_quotes(quotes: DataFrame) -> DataFrame:
    """Quotes received no earlier than they were made."""
    return quotes.where(F.col("local_ts_ns") >= F.col("ts_ns"))


def snap_to_cells(quotes: DataFrame, grid: GridConfig, strict: bool = False) -> DataFrame:
    """Newest valid quote per ``(symbol, cell)``.

    A quote serves the first grid point at or after its arrival; with ``strict``
    the first point after it. The order is total, so ties give one answer.
    """
    rel = F.col("local_ts_ns") - F.lit(grid.origin_ns)
    base = floor_div(rel, grid.interval_ns)
    if strict:
        cell = base + 1
    else:
        cell = base + F.when(F.pmod(rel, F.lit(grid.interval_ns).cast("bigint")) == 0, 0).otherwise(1)
    quote = F.struct("local_ts_ns", "ts_ns", "update_id", *QUOTE_FIELDS)
    return (
        valid_quotes(quotes)
        .select("symbol", cell.alias("cell"), quote.alias("quote"))
        .groupBy("symbol", "cell")
        .agg(F.max("quote").alias("quote"))
    )


def sessions_of(quotes: DataFrame, grid: GridConfig) -> DataFrame:
    """``(symbol, feature_date)`` pairs whose needed raw days are all present."""
    days = quotes.select("symbol", day_of_ns(F.col("local_ts_ns"), grid).alias("feature_date")).distinct()
    if not grid.use_prev_day:
        return days
    prev = days.select("symbol", F.date_add("feature_date", 1).alias("feature_date"))
    return days.join(prev, ["symbol", "feature_date"], "left_semi")


@dataclass(frozen=True)
class BlockLayout:
    """How a session's points ``[0, points)`` are cut; owned points start at ``first``.

    ``points`` is None for one endless session, whose index is the absolute cell.
    """

    length: int
    back: int
    ahead: int
    first: int
    points: int | None

    @classmethod
    def daily(cls, grid: GridConfig, back: int = 0, ahead: int = 0, whole_session: bool = False):
        first = 0 if whole_session else grid.target_from
        length = min(cls._length(grid, back, ahead), grid.session_points)
        return cls(length, back, ahead, first, grid.session_points)

    @classmethod
    def endless(cls, grid: GridConfig, back: int = 0, ahead: int = 0):
        return cls(cls._length(grid, back, ahead), back, ahead, 0, None)

    @staticmethod
    def _length(grid: GridConfig, back: int, ahead: int) -> int:
        """At least twice the lead-in, so that at most a third of a block's points are repeated."""
        return max(2 * back, ahead, grid.min_block_points, 1)

    @property
    def blocks(self) -> int:
        return -(-(self.points - self.first) // self.length)

    @property
    def max_rows(self) -> int:
        """Most grid points one block can hold."""
        return self.length + self.back + self.ahead

    def owned_from(self, block: Column) -> Column:
        return F.lit(self.first) + block * F.lit(self.length).cast("bigint")

    def opens(self, block: Column) -> Column:
        lo = self.owned_from(block) - F.lit(self.back)
        return lo if self.points is None else F.greatest(lo, F.lit(0).cast("bigint"))

    def closes(self, block: Column) -> Column:
        hi = self.owned_from(block + 1) + F.lit(self.ahead)
        return hi if self.points is None else F.least(hi, F.lit(self.points).cast("bigint"))

    def holders(self, i: Column) -> tuple[Column, Column]:
        """First and last block whose extent holds point ``i``; empty if first > last."""
        lo = floor_div(i - F.lit(self.first + self.ahead), self.length)
        hi = floor_div(i - F.lit(self.first - self.back), self.length)
        if self.points is None:
            return lo, hi
        return F.greatest(lo, F.lit(0).cast("bigint")), F.least(hi, F.lit(self.blocks - 1).cast("bigint"))

    def first_opening_after(self, i: Column) -> Column:
        """First block that opens after point ``i``."""
        k = floor_div(i - F.lit(self.first - self.back), self.length) + 1
        return k if self.points is None else F.greatest(k, F.lit(0).cast("bigint"))

    def owns(self, point: Column, block: Column) -> Column:
        inside = (point >= self.owned_from(block)) & (point < self.owned_from(block + 1))
        return inside if self.points is None else inside & (point < F.lit(self.points))


def daily_points(cells: DataFrame, grid: GridConfig) -> DataFrame:
    """Give each cell to the sessions it serves: its own day and, if asked, the next."""
    own = day_of_ns(cell_ns(F.col("cell"), grid), grid)
    days = F.array(own, F.date_add(own, 1)) if grid.use_prev_day else F.array(own)
    return (
        cells.select("symbol", "cell", "quote", F.explode(days).alias("feature_date"))
        .where(F.col("quote.local_ts_ns") >= session_start_ns(F.col("feature_date"), grid))
        .select(
            "symbol",
            "feature_date",
            (F.col("cell") - session_origin_cell(F.col("feature_date"), grid)).alias("i"),
            "quote",
        )
    )


# One endless session has a fixed date, since its index is the absolute cell.
ENDLESS_DATE = "DATE'1970-01-01'"


def endless_points(cells: DataFrame) -> DataFrame:
    return cells.select("symbol", F.expr(ENDLESS_DATE).alias("feature_date"), F.col("cell").alias("i"), "quote")


def daily_frames(sessions: DataFrame, layout: BlockLayout) -> DataFrame:
    """One row per session block; further session columns ride along."""
    blocks = F.sequence(F.lit(0).cast("bigint"), F.lit(layout.blocks - 1).cast("bigint"))
    return sessions.withColumn("block", F.explode(blocks))


def endless_frames(cells: DataFrame, grid: GridConfig, layout: BlockLayout) -> DataFrame:
    """Blocks from a symbol's first cell to the end of the day of its last quote."""
    next_day = floor_div(F.max("quote.local_ts_ns") + F.lit(grid.offset_ns), DAY_NS) + 1
    last_cell = div(next_day * F.lit(DAY_NS) - F.lit(grid.offset_ns + grid.origin_ns), grid.interval_ns) - 1
    span = cells.groupBy("symbol").agg(F.min("cell").alias("first_cell"), last_cell.alias("last_cell"))
    span = span.where("first_cell <= last_cell")
    blocks = F.sequence(floor_div(F.col("first_cell"), layout.length), floor_div(F.col("last_cell"), layout.length))
    return span.select(
        "symbol",
        F.expr(ENDLESS_DATE).alias("feature_date"),
        "first_cell",
        "last_cell",
        F.explode(blocks).alias("block"),
    )


def block_runs(points: DataFrame, frames: DataFrame, layout: BlockLayout) -> DataFrame:
    """Runs ``[i, next_i)`` of grid points served by one quote, per block.

    Every block starts with an opening row that holds the quote in force before
    it (null if there is none) and the session columns of ``frames``; a cell whose
    block has no opening row belongs to a session nobody asked for and is dropped.
    """
    extra = [c for c in frames.columns if c not in BLOCK_KEYS]
    tails = (
        points.withColumn("block", layout.first_opening_after(F.col("i")))
        .groupBy(*BLOCK_KEYS)
        .agg(F.max(F.struct("i", "quote")).alias("tail"))
    )
    if layout.points is not None:
        tails = tails.where(F.col("block") < layout.blocks)
    # A tail may fall in a block no frame has, so frames and tails meet by union. All rows up
    # to a block count for it, its own tail included.
    so_far = Window.partitionBy("symbol", "feature_date").orderBy("block").rangeBetween(Window.unboundedPreceding, 0)
    openings = (
        frames.withColumn("wanted", F.lit(True))
        .unionByName(tails, allowMissingColumns=True)
        .withColumn("tail", F.max("tail").over(so_far))
        .where("wanted")
        .select(
            *BLOCK_KEYS,
            *extra,
            layout.opens(F.col("block")).alias("i"),
            F.lit(0).alias("kind"),
            F.col("tail.quote").alias("quote"),
        )
    )
    lo, hi = layout.holders(F.col("i"))
    placed = (
        points.select("symbol", "feature_date", "i", "quote", lo.alias("lo"), hi.alias("hi"))
        .where("lo <= hi")
        .select(
            "symbol",
            "feature_date",
            F.explode(F.sequence("lo", "hi")).alias("block"),
            "i",
            F.lit(1).alias("kind"),
            "quote",
        )
    )
    w = Window.partitionBy(*BLOCK_KEYS).orderBy(*RUN_ORDER)
    # Sparse runs grow on expansion, so their shuffle must not be coalesced by its small size.
    width = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        placed.unionByName(openings, allowMissingColumns=True)
        .repartition(width, *BLOCK_KEYS)
        .select(
            *BLOCK_KEYS,
            *RUN_ORDER,
            F.coalesce(F.lead("i").over(w), layout.closes(F.col("block"))).alias("next_i"),
            "quote",
            F.first("kind").over(w).alias("opened_by"),
            *[F.first(c).over(w).alias(c) for c in extra],
        )
        .where("opened_by = 0")
        .drop("opened_by")
    )


def expand_runs(runs: DataFrame) -> DataFrame:
    """One row per grid point; ``i`` stays the start of the run the point lies in."""
    return runs.where("next_i > i").withColumn("point", F.explode(F.sequence(F.col("i"), F.col("next_i") - 1)))


def asof_sample(
    quotes: DataFrame,
    sessions: DataFrame,
    grid: GridConfig,
    strict: bool = False,
    max_staleness_ns: int | None = None,
) -> DataFrame:
    """Grid left-joined to the newest quote at or before each point, per session."""
    layout = BlockLayout.daily(grid, whole_session=True)
    points = daily_points(snap_to_cells(quotes, grid, strict), grid)
    runs = block_runs(points, daily_frames(sessions.select("symbol", "feature_date"), layout), layout)
    ns = cell_ns(session_origin_cell(F.col("feature_date"), grid) + F.col("point"), grid)
    out = expand_runs(runs).select("symbol", "feature_date", ns.alias("timestamp"), "quote")
    if max_staleness_ns is not None:
        fresh = F.col("timestamp") - F.col("quote.local_ts_ns") <= F.lit(max_staleness_ns)
        out = out.withColumn("quote", F.when(fresh, F.col("quote")))
    return out.select(
        "symbol",
        "feature_date",
        "timestamp",
        F.col("quote.local_ts_ns").alias("local_ts_ns"),
        *[F.col(f"quote.{c}").alias(c) for c in QUOTE_FIELDS],
    )


def time_grid(sessions: DataFrame, grid: GridConfig) -> DataFrame:
    """All grid instants of the sessions, made block by block."""
    layout = BlockLayout.daily(grid, whole_session=True)
    b = F.col("block")
    point = F.explode(F.sequence(layout.opens(b), layout.closes(b) - 1))
    frames = daily_frames(sessions.select("symbol", "feature_date"), layout).withColumn("point", point)
    ns = cell_ns(session_origin_cell(F.col("feature_date"), grid) + F.col("point"), grid)
    return frames.select("symbol", "feature_date", ns.alias("timestamp"))
