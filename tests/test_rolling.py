import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import DAY, QUOTE_SCHEMA, random_quotes, sample, volatility
from quotegrid.config import FeatureConfig, GridConfig
from quotegrid.functions.time import time_of_day_columns
from quotegrid.operators.asof import sessions_of
from quotegrid.operators.features import feature_matrix, live_volatility, sampled_volatility
from quotegrid.operators.rolling import ratio

STEP = 600_000_000_000
TICK = 0.01


def config(block, windows=(30, 60, 120), label=60, prev_day=True, warmup=0):
    return FeatureConfig(GridConfig(STEP, prev_day, min_block_points=block), windows, label, warmup)


def sessions(q, cfg, tick=TICK):
    return sessions_of(q, cfg.grid).withColumn("tick_size", F.lit(tick))


@pytest.mark.parametrize("block", [1, 17, 100_000])
@pytest.mark.parametrize("ddof", [0, 1])
def test_rolling_std_and_label_equal_the_sliding_definition(spark, block, ddof):
    rows = random_quotes(3, ["a", "b"], 3, 20, STEP, null_share=0.1)
    q = spark.createDataFrame(rows, QUOTE_SCHEMA)
    cfg = config(block)
    got = sampled_volatility(q, sessions(q, cfg), cfg, ddof).toPandas()
    assert len(got) == 2 * 2 * cfg.grid.points_per_day
    for (symbol, day), part in got.groupby(["symbol", "feature_date"]):
        part = part.sort_values("timestamp").reset_index(drop=True)
        n = (np.datetime64(day) - np.datetime64("1970-01-01")).astype(int)
        want = volatility(sample(rows, symbol, n, STEP), TICK, [3, 6, 12], 6, ddof)
        want = want[want.timestamp >= n * DAY].reset_index(drop=True)
        np.testing.assert_allclose(part.mid_tick.astype(float), want.mid_tick, rtol=0, atol=1e-9)
        np.testing.assert_allclose(part.mid_chg, want.mid_chg, rtol=0, atol=1e-6)
        for m, w in ((30, 3), (60, 6), (120, 12)):
            np.testing.assert_allclose(part[f"vol_{m}m"], want[f"w{w}"], rtol=1e-7, atol=1e-4)
        np.testing.assert_allclose(part.y_vol_60m.astype(float), want.y.where(want.labelled), rtol=1e-7, atol=1e-4)


def test_unfilled_windows_are_nan_and_survive_the_null_filter(spark):
    rows = random_quotes(4, ["a"], 1, 40, STEP)
    rows.append(("a", 19_000 * DAY + STEP // 2, 19_000 * DAY + STEP // 2, 0, 10.0, 10.01, 1.0, 1.0))
    q = spark.createDataFrame(rows, QUOTE_SCHEMA)
    cfg = config(100_000, prev_day=False)
    got = feature_matrix(q, sessions(q, cfg), cfg).orderBy("timestamp").toPandas()
    assert got.vol_120m.isna().sum() > 0
    # The last label window of the day has no label, and points before the first quote have no price.
    assert got.timestamp.max() == 19_001 * DAY - 7 * STEP
    first = min(r[2] for r in rows if r[2] >= r[1])
    assert got.timestamp.min() == -(-first // STEP) * STEP


def test_warmup_drops_the_start_of_the_feature_day(spark):
    rows = random_quotes(5, ["a"], 2, 30, STEP)
    q = spark.createDataFrame(rows, QUOTE_SCHEMA)
    cfg = config(100_000, warmup=90)
    got = feature_matrix(q, sessions(q, cfg), cfg).agg(F.min("timestamp")).first()[0]
    assert got == 19_001 * DAY + 9 * STEP


def test_null_amount_drops_the_row(spark):
    rows = [(*r[:6], None, r[7]) if k % 2 else r for k, r in enumerate(random_quotes(6, ["a"], 2, 30, STEP))]
    q = spark.createDataFrame(rows, QUOTE_SCHEMA)
    cfg = config(100_000)
    s = sampled_volatility(q, sessions(q, cfg), cfg)
    kept = feature_matrix(q, sessions(q, cfg), cfg)
    want = s.where("quote.bid_amount is not null and mid_tick is not null and y_vol_60m is not null").count()
    assert 0 < kept.count() == want < s.count()


def test_nan_price_poisons_only_the_windows_that_hold_it(spark):
    base = 19_000 * DAY
    rows = [("a", base + k * STEP, base + k * STEP, k, 10.0 + (k % 3) / 100, 10.02 + (k % 3) / 100, 1.0, 1.0) for k in range(140)]
    rows[50] = (*rows[50][:4], float("nan"), *rows[50][5:])
    q = spark.createDataFrame(rows, QUOTE_SCHEMA)
    cfg = config(20, prev_day=False)
    got = sampled_volatility(q, sessions(q, cfg), cfg).orderBy("timestamp").toPandas().vol_30m
    assert got[:2].isna().all() and got[50:54].isna().all()
    assert got[2:50].notna().all() and got[54:].notna().all()


def test_huge_moves_do_not_overflow(spark):
    base = 19_000 * DAY
    price = lambda k: 1.0e9 if k % 2 else 1.0
    rows = [("a", base + k * STEP, base + k * STEP, k, price(k), price(k), 1.0, 1.0) for k in range(144)]
    q = spark.createDataFrame(rows, QUOTE_SCHEMA)
    cfg = config(100_000, prev_day=False)
    got = sampled_volatility(q, sessions(q, cfg, 1e-3), cfg).orderBy("timestamp").toPandas()
    want = got.mid_chg.rolling(12).std(ddof=1)
    np.testing.assert_allclose(got.vol_120m[12:], want[12:], rtol=1e-9)


def test_window_of_one_point_has_no_sample_std(spark):
    rows = random_quotes(7, ["a"], 1, 20, STEP)
    q = spark.createDataFrame(rows, QUOTE_SCHEMA)
    cfg = config(100_000, windows=(10, 60), label=60, prev_day=False)
    got = sampled_volatility(q, sessions(q, cfg), cfg).toPandas()
    assert got.vol_10m.isna().all() and got.vol_60m.notna().any()


def test_ratio_rules(spark):
    nan = float("nan")
    cases = [(2.0, 4.0, 0.5), (0.0, 0.0, 1.0), (0.0, 3.0, 0.0), (3.0, 0.0, nan), (nan, 1.0, nan), (1.0, nan, nan), (nan, 0.0, nan), (nan, nan, nan)]
    df = spark.createDataFrame(cases, "s double, l double, want double")
    for r in df.select(ratio(F.col("s"), F.col("l")).alias("got"), "want", "s", "l").collect():
        assert (math.isnan(r.got) and math.isnan(r.want)) or r.got == r.want, r


def test_time_of_day(spark):
    ns = (19_000 * 86_400 + 6 * 3600 + 30 * 60 + 59) * 1_000_000_000
    r = spark.range(1).select(*time_of_day_columns(F.lit(ns).cast("bigint"))).first()
    assert (r.hour, r.minute) == (6.0, 30.0)
    assert r.tod_sin == pytest.approx(math.sin(2 * math.pi * 390 / 1440))
    assert r.tod_cos == pytest.approx(math.cos(2 * math.pi * 390 / 1440))


@pytest.mark.parametrize("block", [13, 100_000])
def test_live_form_counts_from_the_first_sample(spark, block):
    rows = [r for r in random_quotes(8, ["a", "b"], 3, 15, STEP) if r[0] == "a" or r[2] > 19_001 * DAY]
    q = spark.createDataFrame(rows, QUOTE_SCHEMA)
    sizes = spark.createDataFrame([("a", TICK), ("b", TICK)], "symbol string, tick_size double")
    cfg = config(block)
    got = live_volatility(q, sizes, cfg, warmup_minutes=60).toPandas()
    for symbol, part in got.groupby("symbol"):
        part = part.sort_values("timestamp").reset_index(drop=True)
        assert (part.samples == np.arange(1, len(part) + 1)).all()
        assert (part.warm == (part.samples >= 6)).all()
        chg = part.mid_tick.diff().fillna(0.0)
        for m, w in ((30, 3), (120, 12)):
            np.testing.assert_allclose(part[f"vol_{m}m"], chg.rolling(w).std(ddof=0), rtol=1e-7, atol=1e-4)
        assert part.timestamp.iloc[-1] == 19_003 * DAY - STEP
