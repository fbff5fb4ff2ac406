import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import DAY, QUOTE_SCHEMA, random_quotes, sample
from quotegrid.config import GridConfig
from quotegrid.operators.asof import BlockLayout, asof_sample, sessions_of, snap_to_cells, time_grid

STEP = 1_800_000_000_000


def day_number(d):
    return (np.datetime64(d) - np.datetime64("1970-01-01")).astype(int)


@pytest.mark.parametrize("prev_day", [True, False])
@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("block", [5, 100_000])
def test_asof_equals_brute_force(spark, prev_day, strict, block):
    rows = random_quotes(1, ["a", "b"], 4, 12, STEP, null_share=0.2)
    q = spark.createDataFrame(rows, QUOTE_SCHEMA)
    grid = GridConfig(STEP, use_prev_day=prev_day, min_block_points=block)
    got = asof_sample(q, sessions_of(q, grid), grid, strict=strict).toPandas()
    assert len(got) == 2 * (3 if prev_day else 4) * grid.session_points
    for (symbol, day), part in got.groupby(["symbol", "feature_date"]):
        part = part.sort_values("timestamp").reset_index(drop=True)
        want = sample(rows, symbol, day_number(day), STEP, prev_day, strict)
        assert (part.timestamp == want.timestamp).all()
        for c in ("local_ts_ns", "bid_price", "ask_price", "ask_amount"):
            np.testing.assert_array_equal(part[c].astype(float), want[c].astype(float))


def test_no_quote_from_the_future_and_staleness(spark):
    rows = random_quotes(2, ["a"], 2, 10, STEP)
    q = spark.createDataFrame(rows, QUOTE_SCHEMA)
    grid = GridConfig(STEP)
    got = asof_sample(q, sessions_of(q, grid), grid, max_staleness_ns=2 * STEP).toPandas().dropna()
    age = got.timestamp - got.local_ts_ns
    assert (age >= 0).all() and (age <= 2 * STEP).all()
    newest = asof_sample(q, sessions_of(q, grid), grid, strict=True).toPandas().dropna()
    assert (newest.timestamp > newest.local_ts_ns).all()


def test_ties_have_one_answer_and_null_prices_are_not_skipped(spark):
    base = 19_000 * DAY
    rows = [
        ("a", base, base, 1, 9.0, 9.1, 1.0, 1.0),
        ("a", base - 5, base, 2, 8.0, 8.1, 1.0, 1.0),
        ("a", base, base, 3, 7.0, 7.1, 1.0, 1.0),
        ("a", base, base + STEP, 4, None, 7.1, 1.0, 1.0),
    ]
    q = spark.createDataFrame(rows, QUOTE_SCHEMA)
    grid = GridConfig(STEP, use_prev_day=False)
    got = asof_sample(q, sessions_of(q, grid), grid).orderBy("timestamp").limit(3).toPandas()
    assert got.bid_price.iloc[0] == 7.0
    assert np.isnan(got.bid_price.iloc[1]) and got.ask_price.iloc[1] == 7.1
    assert got.local_ts_ns.iloc[2] == base + STEP


def test_time_grid_has_every_instant_once(spark):
    s = spark.sql("select 'a' symbol, date'2024-01-02' feature_date")
    for grid in (GridConfig(STEP, min_block_points=7), GridConfig(STEP, use_prev_day=False)):
        got = [r[0] for r in time_grid(s, grid).select("timestamp").collect()]
        end = (day_number("2024-01-02") + 1) * DAY
        assert sorted(got) == list(range(end - grid.session_points * STEP, end, STEP))


def test_day_boundary_moves_with_the_offset(spark):
    s = spark.sql("select 'a' symbol, date'2024-01-02' feature_date")
    grid = GridConfig(STEP, use_prev_day=False, utc_offset_minutes=480)
    first = time_grid(s, grid).agg(F.min("timestamp")).first()[0]
    assert first == day_number("2024-01-02") * DAY - 8 * 3_600_000_000_000


def test_hot_symbol_is_spread_over_bounded_groups(spark):
    """Many quotes of one symbol: at most one per instant is left, and no block is longer than its layout."""
    q = spark.range(200_000).select(
        F.lit("hot").alias("symbol"),
        (F.lit(19_000 * DAY) + F.col("id") * 400_000_000).alias("local_ts_ns"),
        (F.lit(19_000 * DAY) + F.col("id") * 400_000_000).alias("ts_ns"),
        F.col("id").alias("update_id"),
        *[F.rand(1).alias(c) for c in ("bid_price", "ask_price", "bid_amount", "ask_amount")],
    )
    grid = GridConfig(60_000_000_000, use_prev_day=False, min_block_points=100)
    cells = snap_to_cells(q, grid)
    assert cells.count() <= grid.points_per_day
    layout = BlockLayout.daily(grid, back=50, ahead=10)
    assert layout.max_rows == 160 and layout.blocks == 15


def test_interval_must_divide_a_day():
    with pytest.raises(ValueError):
        GridConfig(7_000_000_000)
