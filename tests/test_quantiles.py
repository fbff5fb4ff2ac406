import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotegrid.operators.quantiles import (
    NORMAL_LIMIT,
    describe,
    exact_quantiles,
    from_normal,
    from_normal_array,
    merge_sketches,
    normal_cdf,
    normal_score,
    quantile_array,
    quantile_sketches,
    quantile_steps,
    sketched_quantiles,
    to_normal,
    to_normal_array,
    to_uniform_array,
    uniform_score,
    with_steps,
    with_values,
)


def frame(spark, groups):
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs]
    return spark.createDataFrame(rows, "k string, v double")


GROUPS = {
    "spread": np.random.default_rng(1).normal(size=3000),
    "ties": np.random.default_rng(2).integers(0, 5, 2000),
    "one": [3.0],
    "two": [1.0, 2.0],
    "same": [7.0] * 50,
}


@pytest.mark.parametrize("probs", [(0.0, 0.25, 0.5, 0.75, 1.0), (0.1, 0.333)])
def test_quantiles_are_exact(spark, probs):
    df = frame(spark, GROUPS).unionByName(spark.sql("select 'one' k, double('nan') v union all select 'two', null"))
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", probs=probs).collect()}
    assert set(got) == set(GROUPS)
    for k, vs in GROUPS.items():
        assert got[k].n == len(vs)
        np.testing.assert_allclose(got[k].quantiles, np.quantile(vs, probs), rtol=0, atol=1e-12)


def test_evenly_spaced_quantiles_are_at_most_the_rows(spark):
    got = {r.k: r.quantiles for r in exact_quantiles(frame(spark, GROUPS), ["k"], "v", count=1000).collect()}
    for k, vs in GROUPS.items():
        m = min(len(vs), 1000)
        np.testing.assert_allclose(got[k], np.quantile(vs, np.linspace(0, 1, m) if m > 1 else [0.0]), rtol=0, atol=1e-12)


def test_describe(spark):
    r = describe(frame(spark, {"a": GROUPS["spread"]}), ["k"], "v").first()
    v = GROUPS["spread"]
    assert (r.n, r["min"], r["max"]) == (len(v), v.min(), v.max())
    np.testing.assert_allclose([r["mean"], r["std"], r.p50], [v.mean(), v.std(ddof=1), np.median(v)], rtol=1e-9)


def test_transform_and_inverse(spark):
    y = np.random.default_rng(3).lognormal(size=4000)
    df = frame(spark, {"a": y})
    q = quantile_array(exact_quantiles(df, ["k"], "v", count=1000))
    got = df.withColumn("z", to_normal(q, F.col("v"))).withColumn("b", from_normal(q, F.col("z"))).toPandas()
    np.testing.assert_allclose(got.b, got.v, rtol=1e-6)
    a = got.sort_values("v").z.to_numpy()
    assert (np.diff(a) >= 0).all() and abs(a.mean()) < 0.01 and abs(a.std() - 1) < 0.05
    assert a[0] == -NORMAL_LIMIT and a[-1] == NORMAL_LIMIT


def test_one_group_has_one_array(spark):
    table = exact_quantiles(frame(spark, GROUPS), ["k"], "v", count=10)
    with pytest.raises(ValueError):
        quantile_array(table)
    with pytest.raises(ValueError):
        quantile_array(table.where("k = 'none'"))


def test_distribution_function():
    z = np.concatenate([np.linspace(-9, 9, 20_001), np.random.default_rng(0).normal(size=5000)])
    want = np.array([0.5 * math.erfc(-x * math.sqrt(0.5)) for x in z])
    np.testing.assert_allclose(normal_cdf(z), want, rtol=0, atol=3e-15)
    inner = np.abs(z) < 7.9
    np.testing.assert_allclose(normal_cdf(z)[inner], want[inner], rtol=1e-11)
    assert np.isnan(normal_cdf(np.array([np.nan]))[0]) or normal_cdf(np.array([0.0]))[0] == 0.5


def test_joins_equal_the_arrays_for_every_group(spark):
    """Groups of all kinds, also of values that were not among those the quantiles are of."""
    table = exact_quantiles(frame(spark, GROUPS), ["k"], "v", count=1000)
    arrays = {r.k: np.asarray(r.quantiles) for r in table.collect()}
    rng = np.random.default_rng(7)
    asked = {k: np.concatenate([v, rng.normal(2, 4, 500), [min(v) - 1, max(v) + 1, np.median(v)]]) for k, v in GROUPS.items()}
    df = frame(spark, asked).unionByName(spark.sql("select 'nobody' k, 1d v union all select 'two', null union all select 'two', double('nan')"))
    df = df.withColumn("_v", F.lit("clash"))
    met = with_steps(df, quantile_steps(table, ["k"]), ["k"], "v")
    assert met.columns == ["k", "v", "_v", "step"]
    scored = met.select("k", "v", uniform_score(F.col("v"), F.col("step")).alias("u"), normal_score(F.col("v"), F.col("step")).alias("z"))
    got = with_values(scored, table, ["k"], "z", "back").toPandas()
    assert len(got) == df.count()
    odd = got[(got.k == "nobody") | got.v.isna()]
    assert len(odd) == 3 and odd[["u", "z", "back"]].isna().all().all()
    for k, part in got[~got.index.isin(odd.index)].groupby("k"):
        v, q = part.v.to_numpy(), arrays[k]
        if len(q) > 1 and q[0] < q[-1]:
            np.testing.assert_allclose(part.u, to_uniform_array(v.copy(), q), rtol=0, atol=1e-12)
        np.testing.assert_allclose(part.z, to_normal_array(v.copy(), q), rtol=0, atol=1e-8)
        np.testing.assert_allclose(part.back, from_normal_array(part.z.to_numpy(), q), rtol=0, atol=1e-9)


def test_values_outside_the_range_go_to_its_ends():
    q = np.array([1.0, 2.0, 2.0, 2.0, 5.0])
    z = to_normal_array(np.array([0.0, 9.0]), q)
    assert list(z) == [-NORMAL_LIMIT, NORMAL_LIMIT]
    assert list(from_normal_array(np.array([-9.0, 9.0, 0.0]), q)) == [1.0, 5.0, 2.0]
    assert list(to_uniform_array(np.array([1.0, 2.0, 3.5, 5.0]), q)) == [0.0, 0.5, 0.875, 1.0]


def test_null_values_have_no_rank(spark):
    df = spark.createDataFrame([("a", None), ("a", 1.0)], "k string, v double")
    z = df.select("v", to_normal(np.array([0.0, 2.0]), F.col("v")).alias("z")).collect()
    assert [r.z is None or np.isnan(r.z) for r in z] == [True, False]


def test_a_large_group_is_met_in_many_pieces(spark):
    """No task of the join holds a group: a range begins with the step carried into it."""
    df = spark.range(20_000).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("v"))
    table = spark.createDataFrame([("a", [0.0, 1.0, 19_999.0])], "k string, quantiles array<double>")
    met = with_steps(df, quantile_steps(table, ["k"]), ["k"], "v")
    got = met.select("v", uniform_score(F.col("v"), F.col("step")).alias("u")).toPandas()
    np.testing.assert_allclose(got.u, to_uniform_array(got.v.to_numpy().copy(), np.array([0.0, 1.0, 19_999.0])), atol=1e-12)


def test_merged_sketches_stay_within_their_rank_error(spark):
    """A sketch per day, merged over the days, next to the exact quantiles of all rows."""
    rng = np.random.default_rng(11)
    values = {"wide": rng.lognormal(0, 3, 60_000), "ties": rng.integers(0, 40, 30_000).astype(float), "two": np.array([1.0, 2.0]), "one": np.array([3.0])}
    rows = [(k, int(i % 9), float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, d int, v double").unionByName(spark.sql("select 'one' k, 1 d, double('nan') v"))
    days = quantile_sketches(df, ["k", "d"], "v")
    assert days.count() == 9 * 2 + 2 + 1
    merged = merge_sketches(days.withColumn("half", F.col("d") % 2), ["k", "half"])
    got = {r.k: r for r in sketched_quantiles(merge_sketches(merged, ["k"]), ["k"], 101).collect()}
    for k, vs in values.items():
        q = np.asarray(got[k].quantiles)
        assert got[k].n == len(vs) and len(q) == 101 and q[0] == vs.min() and q[-1] == vs.max()
        s = np.sort(vs)
        for want, x in zip(np.linspace(0, 1, 101), q, strict=True):
            low, high = np.searchsorted(s, x, "left") / len(s), np.searchsorted(s, x, "right") / len(s)
            assert low - 0.004 <= want <= high + 0.004, (k, want, low, high)
