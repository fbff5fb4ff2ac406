import datetime as dt
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import DAY, QUOTE_SCHEMA, random_quotes
from quotegrid.config import FeatureConfig, GridConfig, TrainConfig
from quotegrid.models.boosting import VolatilityModel, fit_model, fit_symbols, labelled, score_stored, stored_importance, verify_model
from quotegrid.models.worker import ModelCache
from quotegrid.operators import registry as rg
from quotegrid.plans.jobs import Store, build_features, day_batches, run_production, run_walk_forward
from quotegrid.streaming.scoring import score_live

STEP = 600_000_000_000
NOW = dt.datetime(2024, 5, 1)
CFG = TrainConfig(train_days=2, val_days=1, test_days=1, max_iter=4, max_depth=3, step_size=0.3, min_instances=2, max_bins=16)
FEATURES = FeatureConfig(GridConfig(STEP), (30, 60, 120), 60)
FIRST = dt.date(2022, 1, 8)


def day(k):
    return FIRST + dt.timedelta(days=k)


@pytest.fixture(scope="module")
def quotes(spark):
    rows = random_quotes(9, ["a", "b", "gap"], 8, 60, STEP)
    rows = [r for r in rows if not (r[0] == "gap" and r[2] // DAY == 19_004)]
    return spark.createDataFrame(rows, QUOTE_SCHEMA).cache()


@pytest.fixture(scope="module")
def sizes(spark):
    return spark.createDataFrame([(s, 0.01) for s in ("a", "b", "gap")], "symbol string, tick_size double")


def tasks(spark, symbols, days):
    return spark.createDataFrame([(s, day(d)) for s in symbols for d in days], "symbol string, date date")


@pytest.fixture(scope="module")
def store(spark, quotes, sizes, tmp_path_factory):
    s = Store(str(tmp_path_factory.mktemp("store")))
    build_features(quotes, tasks(spark, ["a", "b"], range(1, 8)), sizes, FEATURES, s, NOW)
    return s


def test_feature_build_is_incremental(spark, quotes, sizes, tmp_path):
    s = Store(str(tmp_path))
    failed = build_features(quotes, tasks(spark, ["a", "gap"], range(0, 8)), sizes, FEATURES, s, NOW)
    # Day 0 has no day before it; the gap fails its own day and the next.
    assert {(r.symbol, r.feature_date) for r in failed.collect()} == {("a", day(0)), ("gap", day(0)), ("gap", day(4)), ("gap", day(5))}
    first = {(r.symbol, r.date): r.rows for r in s.ledger(spark, "feature_ledger").collect()}
    assert len(first) == 12 and min(first.values()) > 100
    files = sorted(str(f) for f in (tmp_path / "features").rglob("*.parquet"))
    assert build_features(quotes, tasks(spark, ["a"], range(1, 8)), sizes, FEATURES, s, NOW).count() == 0
    assert sorted(str(f) for f in (tmp_path / "features").rglob("*.parquet")) == files
    assert s.ledger(spark, "feature_ledger").count() == 12


def test_a_backfill_in_many_spans_equals_one(spark, quotes, sizes, store, tmp_path):
    s = Store(str(tmp_path))
    wanted = tasks(spark, ["a", "b"], range(1, 8))
    pending = wanted.withColumnRenamed("date", "feature_date")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(day_batches(pending, FEATURES, 4)) == -(-7 // (4 * width // 2))
    assert len(day_batches(pending, FEATURES, 1)) == -(-7 // (width // 2)) > 1
    assert build_features(quotes, wanted, sizes, FEATURES, s, NOW, blocks_per_task=1).count() == 0
    a, b = (spark.read.parquet(x.path("features")) for x in (s, store))
    assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).isEmpty()
    assert s.ledger(spark, "feature_ledger").count() == 14


def test_unrecorded_partition_is_recorded_not_rebuilt(spark, quotes, sizes, tmp_path):
    s = Store(str(tmp_path))
    build_features(quotes, tasks(spark, ["a"], [2, 3]), sizes, FEATURES, s, NOW)
    files = sorted(str(f) for f in (tmp_path / "features").rglob("*.parquet"))
    other = Store(str(tmp_path / "second"))
    spark.read.parquet(s.path("features")).write.partitionBy("symbol", "date").parquet(other.path("features"))
    build_features(quotes, tasks(spark, ["a"], [2, 3]), sizes, FEATURES, other, NOW)
    assert other.ledger(spark, "feature_ledger").count() == 2
    assert sorted(str(f) for f in (tmp_path / "features").rglob("*.parquet")) == files


def test_broken_partition_is_built_again(spark, quotes, sizes, tmp_path):
    s = Store(str(tmp_path))
    build_features(quotes, tasks(spark, ["a"], [2, 3]), sizes, FEATURES, s, NOW)
    before = {r.date: r.rows for r in s.stats(spark, "features").collect()}
    for f in (tmp_path / "features" / "symbol=a" / f"date={day(3)}").glob("*.parquet"):
        f.write_bytes(b"broken")
    assert {r.date for r in s.stats(spark, "features").where("rows > 0").collect()} == {day(2)}
    assert build_features(quotes, tasks(spark, ["a"], [2, 3]), sizes, FEATURES, s, NOW).count() == 0
    assert {r.date: r.rows for r in s.stats(spark, "features").collect()} == before


def test_walk_forward_run(spark, store):
    spans = spark.createDataFrame([("a", day(4), day(5)), ("b", day(4), day(5))], "symbol string, first_day date, last_day date")
    assert run_walk_forward(spans, FEATURES.feature_columns, FEATURES.label_column, CFG, store, NOW) == {}
    predictions = spark.read.parquet(store.path("predictions"))
    assert predictions.where("y_pred is null or isnan(y_pred)").count() == 0
    got = {(r.symbol, r.date) for r in predictions.select("symbol", "date").distinct().collect()}
    assert got == {(s, day(d)) for s in "ab" for d in (4, 5)}
    summary = spark.read.parquet(store.path("run_summary")).collect()
    assert all(r.metrics.n > 0 and math.isfinite(r.metrics.rmse) and r.features_used == FEATURES.feature_columns for r in summary)
    imp = spark.read.parquet(store.path("feature_importance")).where(F.col("symbol") == "a").where(F.col("date") == day(4))
    assert imp.count() == len(FEATURES.feature_columns)
    assert imp.agg(F.sum("importance_gain")).first()[0] == pytest.approx(1.0)
    assert imp.agg(F.sum("importance_split")).first()[0] > 0
    assert store.ledger(spark, "result_ledger").count() == 4
    # All recorded: a second run does nothing.
    run_walk_forward(spans, FEATURES.feature_columns, FEATURES.label_column, CFG, store, dt.datetime(2025, 1, 1))
    assert store.ledger(spark, "result_ledger").count() == 4
    assert {r.path for r in summary} == {r.path for r in spark.read.parquet(store.path("run_summary")).collect()}


def test_production_run_publishes_good_symbols(spark, quotes, sizes, tmp_path):
    s = Store(str(tmp_path))
    status = run_production(quotes, ["a", "gap"], sizes, day(6), FEATURES, CFG, s, NOW).first()
    assert (status.symbols, status.trained, status.published, status.exit_code) == (2, 1, 1, 1)
    row = rg.read_registry(spark, s.path("registry")).first()
    assert (row.symbol, row.model_date) == ("a", day(5)) and verify_model(row.path)
    assert not verify_model(str(tmp_path / "nothing"))
    summary = spark.read.parquet(s.path("production_run_summary")).collect()
    assert [(r.symbol, r.date) for r in summary] == [("a", day(5))]


def test_saved_model_scores_alike(spark, store, tmp_path):
    rows = spark.read.parquet(store.path("features")).where("symbol = 'a'")
    m = fit_model("a", rows.where(F.col("date") <= day(4)), rows.where(F.col("date") == day(5)), FEATURES.feature_columns, FEATURES.label_column, CFG)
    m.save(str(tmp_path / "m"))
    back = VolatilityModel.load(str(tmp_path / "m"))
    test = rows.where(F.col("date") == day(6))
    a = [r.y_pred for r in m.score(test).orderBy("timestamp").collect()]
    b = [r.y_pred for r in back.score(test).orderBy("timestamp").collect()]
    assert a == b and len(set(a)) > 1
    assert min(m.quantiles) <= min(a) and max(a) <= max(m.quantiles)


def test_empty_training_data_fails_that_symbol_only(spark, store):
    rows = spark.read.parquet(store.path("features"))
    roles = rows.withColumn("role", F.when(F.col("date") == day(5), "val").otherwise("train"))
    models, failed = fit_symbols(roles, ["a", "none"], FEATURES.feature_columns, FEATURES.label_column, CFG)
    assert list(models) == ["a"] and list(failed) == ["none"]


def test_live_scoring_equals_batch_scoring_and_reloads(spark, store, tmp_path):
    rows = spark.read.parquet(store.path("features")).where("symbol in ('a', 'b')")
    a = rows.where("symbol = 'a'")
    first = fit_model("a", a.where(F.col("date") <= day(4)), a.where(F.col("date") == day(5)), FEATURES.feature_columns, FEATURES.label_column, CFG)
    second = fit_model("a", a.where(F.col("date") <= day(2)), a.where(F.col("date") == day(3)), FEATURES.feature_columns, FEATURES.label_column, CFG)
    path = str(tmp_path / "m")
    live = rows.where(F.col("date") == day(6)).drop("date").withColumn("warm", F.col("hour") >= 2)
    live = live.withColumn("vol_30m", F.when(F.col("minute") == 10, F.lit(float("nan"))).otherwise(F.col("vol_30m")))

    def scored(at, where=path):
        registry = spark.createDataFrame([("a", day(5), where, at)], rg.REGISTRY_SCHEMA)
        return score_live(live, registry, FEATURES.feature_columns, 2, FEATURES.grid)

    def check(model, out):
        want = {r.timestamp: r.y_pred for r in model.score(live.where("warm and symbol = 'a'")).collect()}
        got = {r.timestamp: r.volatility for r in out.where("status = 'ok'").collect()}
        assert got.keys() == want.keys() and len(got) > 50
        assert all(got[t] == pytest.approx(want[t], rel=1e-9) for t in got)

    first.save(path)
    out = scored(NOW)
    check(first, out)
    counts = {(r.symbol, r.status) for r in out.select("symbol", "status").distinct().collect()}
    assert counts == {("a", "ok"), ("a", "warmup"), ("b", "no_model"), ("b", "warmup")}
    assert out.where("status <> 'ok' and volatility is not null").isEmpty()
    second.save(path)
    check(second, scored(NOW + dt.timedelta(hours=1)))


def test_workers_agree_on_the_model_in_force(spark, store, tmp_path):
    """The newest model that can be read, also for a worker that knew another one before."""
    rows = spark.read.parquet(store.path("features")).where("symbol = 'a'")
    m = fit_model("a", rows.where(F.col("date") <= day(4)), rows.where(F.col("date") == day(5)), FEATURES.feature_columns, FEATURES.label_column, CFG)
    m.save(str(tmp_path / "old"))
    m.save(str(tmp_path / "new"))
    old, new = ({"path": str(tmp_path / p), "version": "1"} for p in ("old", "new"))
    names = FEATURES.feature_columns
    asked = json.dumps([new, old])
    veteran, novice = ModelCache(), ModelCache()
    kept = veteran.first(asked, names)
    assert kept is veteran.first(asked, names) and kept is veteran.get(new["path"], "1")
    for f in (tmp_path / "new" / "nodes").glob("*.parquet"):
        f.write_bytes(b"broken")
    again = json.dumps([dict(new, version="2"), old])  # published once more, and broken
    for worker in (veteran, novice):
        found = worker.first(again, names)
        assert found is worker.get(old["path"], "1") and found is not None
        assert worker.first(json.dumps([dict(new, version="2")]), names) is None
        assert worker.first(json.dumps([old]), names[:2]) is None
    assert veteran.get("file:" + old["path"], "1") is not None


def test_a_broken_model_gives_way_to_the_one_before(spark, store, tmp_path):
    rows = spark.read.parquet(store.path("features")).where("symbol = 'a'")
    m = fit_model("a", rows.where(F.col("date") <= day(4)), rows.where(F.col("date") == day(5)), FEATURES.feature_columns, FEATURES.label_column, CFG)
    m.save(str(tmp_path / "old"))
    live = rows.where(F.col("date") == day(7)).drop("date").withColumn("warm", F.lit(True))
    registry = spark.createDataFrame([("a", day(5), str(tmp_path / "old"), NOW), ("a", day(6), str(tmp_path / "gone"), NOW)], rg.REGISTRY_SCHEMA)
    got = {r.timestamp: r.volatility for r in score_live(live, registry, FEATURES.feature_columns, 3, FEATURES.grid).where("status = 'ok'").collect()}
    want = {r.timestamp: r.y_pred for r in m.score(live).collect()}
    assert got.keys() == want.keys() and all(got[t] == pytest.approx(want[t], rel=1e-9) for t in got)
    short = score_live(live, registry, FEATURES.feature_columns, 1, FEATURES.grid)
    assert {r.status for r in short.select("status").distinct().collect()} == {"no_model"}


def test_importances_of_stored_nodes_equal_the_models_own(spark, store, tmp_path):
    rows = spark.read.parquet(store.path("features"))
    paths, own = [], {}
    for symbol in "ab":
        mine = rows.where(F.col("symbol") == symbol)
        m = fit_model(symbol, mine.where(F.col("date") <= day(4)), mine.where(F.col("date") == day(5)), FEATURES.feature_columns, FEATURES.label_column, CFG)
        m.save(path := str(tmp_path / symbol))
        paths.append(path)
        own |= {(symbol, r.feature): (r.importance_gain, r.importance_split) for r in m.importance(spark).collect()}
    got = {(r.symbol, r.feature): (r.importance_gain, r.importance_split) for r in stored_importance(spark, paths).collect()}
    assert got.keys() == own.keys()
    for k, (gain, splits) in own.items():
        assert got[k][0] == pytest.approx(gain, abs=1e-9) and got[k][1] == splits
    assert stored_importance(spark, []).count() == 0


def test_all_symbols_are_scored_in_one_pass(spark, store, tmp_path):
    rows = spark.read.parquet(store.path("features"))
    test, paths, want = rows.where(F.col("date") == day(6)), {}, {}
    for symbol in "ab":
        mine = rows.where(F.col("symbol") == symbol)
        m = fit_model(symbol, mine.where(F.col("date") <= day(4)), mine.where(F.col("date") == day(5)), FEATURES.feature_columns, FEATURES.label_column, CFG)
        m.save(path := str(tmp_path / symbol))
        paths[symbol] = path
        scored = m.score(labelled(test.where(F.col("symbol") == symbol), FEATURES.label_column))
        want |= {(symbol, r.timestamp): r.y_pred for r in scored.collect()}
    out = score_stored(test, paths, FEATURES.label_column, FEATURES.feature_columns, ["timestamp"])
    got = {(r.symbol, r.timestamp): r.y_pred for r in out.collect()}
    assert got.keys() == want.keys() and len(got) > 100
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in got)


def test_an_overfitting_fit_stops_growing(spark, monkeypatch):
    """It grows little more than the trees up to the best one and ``patience`` more, and the same ones as a long fit."""
    import quotegrid.models.boosting as boosting

    rng = np.random.default_rng(4)
    x = rng.uniform(0, 1, (300, len(FEATURES.feature_columns)))
    names = ", ".join(f"`{c}` double" for c in [*FEATURES.feature_columns, FEATURES.label_column])
    data = [(*map(float, r), float(1 + 0.2 * r[0] + rng.uniform(0, 1))) for r in x]
    train, val = (spark.createDataFrame(part, names).withColumn("symbol", F.lit("a")) for part in (data[:200], data[200:]))
    grown = []

    class Counted(boosting.GBTRegressor):
        def fit(self, rows):
            grown.append(self.getMaxIter())
            return super().fit(rows)

    monkeypatch.setattr(boosting, "GBTRegressor", Counted)
    short = TrainConfig(max_iter=400, max_depth=2, step_size=0.05, min_instances=2, max_bins=16, patience=4)
    m = fit_model("a", train, val, FEATURES.feature_columns, FEATURES.label_column, short)
    assert grown[0] == 10 and all(b == 2 * a for a, b in zip(grown, grown[1:], strict=False))
    assert m.trees.getNumTrees + 4 <= grown[-1] < 400
    grown.clear()
    whole = TrainConfig(max_iter=40, max_depth=2, step_size=0.05, min_instances=2, max_bins=16, patience=40)
    n = fit_model("a", train, val, FEATURES.feature_columns, FEATURES.label_column, whole)
    both = min(m.trees.getNumTrees, n.trees.getNumTrees)
    assert [t.toDebugString.split("\n", 1)[1] for t in m.trees.trees[:both]] == [t.toDebugString.split("\n", 1)[1] for t in n.trees.trees[:both]]
