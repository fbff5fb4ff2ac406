"""Queries that fit boosted trees. SQL checks what they store and report, tests check the fits."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quotegrid.config import TrainConfig
from quotegrid.functions.time import day_of_ns
from quotegrid.models.boosting import fit_symbols, score_stored, stored_importance
from quotegrid.operators import splits as sp
from quotegrid.operators.metrics import evaluate
from quotegrid.plans.catalog import query
from quotegrid.operators.registry import read_registry
from quotegrid.plans.grid_queries import COARSE, COARSE_SQL, KEPT_SQL, LIVE_SQL, features, live
from quotegrid.plans.jobs import Store, run_production, run_walk_forward
from quotegrid.plans.table_queries import LOOKBACK_DAYS
from quotegrid.session import scratch_path
from quotegrid.sources import testdata as td
from quotegrid.sources.quotes import write_by_symbol_day
from quotegrid.streaming.live import with_live_columns
from quotegrid.streaming.scoring import score_live

LABEL = COARSE.label_column
# One window over all 30 days: the whole feature table is used, as train, validation or test rows. Longer tables have
# more windows. Small trees, but as many as the validation days ask for.
WINDOW = TrainConfig(train_days=20, val_days=2, test_days=7, max_iter=60, patience=4, max_depth=4, step_size=0.3, max_bins=64)
LEAD_DAYS = WINDOW.train_days + WINDOW.val_days + 1
PRODUCTION = TrainConfig(train_days=26, val_days=3, max_iter=60, patience=4, max_depth=3, step_size=0.3, max_bins=64)
MODEL_AFTER_DAYS = 20
NOW = datetime(2024, 2, 1)


def first_feature_span(spark, sf):
    """The days a single walk-forward window can test: those after its train and validation days."""
    return td.symbol_spans(spark, sf).withColumn("first_day", F.date_add("first_day", LEAD_DAYS))


def window_rows(spark, sf):
    """Feature rows with window and role, written once by window and symbol since every fit reads its own."""
    split = sp.walk_forward_splits(first_feature_span(spark, sf), WINDOW.train_days, WINDOW.val_days, WINDOW.test_days)
    f = features(spark, sf)
    days = split.select("symbol", F.col("date").alias("feature_date"), "window_id", "role")
    path = scratch_path(spark, "window-rows")
    rows = f.join(days, ["symbol", "feature_date"]).withColumn("part", F.col("symbol"))
    rows.repartition("window_id", "part", "feature_date").write.partitionBy("window_id", "part").parquet(path)
    return spark.read.parquet(path)


def symbols_of(spark, sf) -> list[str]:
    return sorted(r["symbol"] for r in td.symbol_days(spark, sf).select("symbol").distinct().collect())


def fitted(spark, sf):
    """The rows, and by window the paths of the symbols' stored models."""
    rows = window_rows(spark, sf)
    base = scratch_path(spark, "models")
    paths: dict[int, dict[str, str]] = {}
    for window in sorted(r["window_id"] for r in rows.select("window_id").distinct().collect()):

        def save(model, window=window) -> str:
            model.save(path := f"{base}/{window}/{model.symbol}")
            return path

        mine = rows.where(F.col("window_id") == window)
        paths[window], failed = fit_symbols(mine, symbols_of(spark, sf), COARSE.feature_columns, LABEL, WINDOW, save)
        if failed:
            raise RuntimeError(f"fits failed: {failed}")
    return rows, paths


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("gbt_predict")
def gbt_predict(spark, sf):
    """Every test row, scored by the stored model of its window and symbol; all symbols in one pass."""
    rows, paths = fitted(spark, sf)
    tests = rows.where("role = 'test'")
    keys = ["feature_date", "timestamp"]
    return _union([score_stored(tests.where(F.col("window_id") == w), p, LABEL, COARSE.feature_columns, keys) for w, p in paths.items()])


@query("feature_importance")
def feature_importance(spark, sf):
    """Gain share and splits of every feature, from the stored trees' nodes."""
    _, paths = fitted(spark, sf)
    parts = [stored_importance(spark, sorted(p.values())).withColumn("window_id", F.lit(w).cast("bigint")) for w, p in paths.items()]
    return _union(parts).orderBy("window_id", "symbol", F.desc("importance_gain"), "feature")


@query(
    "results_tables",
    f"""WITH {COARSE_SQL}, b AS (SELECT min(date) AS first_day FROM days),
    r AS (SELECT symbol, feature_date AS date, count(*) AS n FROM f, b WHERE {KEPT_SQL} AND feature_date >= first_day + {LEAD_DAYS} GROUP BY ALL)
    SELECT symbol, date, n, n AS stored_rows, true AS scores_agree, true AS scores_finite, {len(COARSE.feature_columns)} AS features, 1.0::DOUBLE AS gain FROM r""",
)
def results_tables(spark, sf):
    """Stored run summaries of a walk-forward run next to scores made anew from its stored predictions."""
    store = Store(scratch_path(spark, "research"))
    write_by_symbol_day(features(spark, sf).withColumnRenamed("feature_date", "date"), store.path("features"), "timestamp")
    failures = run_walk_forward(first_feature_span(spark, sf), COARSE.feature_columns, LABEL, WINDOW, store, NOW)
    if failures:
        raise RuntimeError(f"windows failed: {failures}")
    summary = spark.read.parquet(store.path("run_summary"))
    again = evaluate(spark.read.parquet(store.path("predictions")), ["symbol", "date"])
    imp = spark.read.parquet(store.path("feature_importance")).groupBy("symbol", "date").agg(
        F.count(F.lit(1)).alias("features"), F.round(F.sum("importance_gain"), 6).alias("gain")
    )
    agree = F.abs(F.col("metrics.rmse") - F.col("rmse")) + F.abs(F.col("metrics.mae") - F.col("mae")) < 1e-6
    finite = ~F.isnan("rmse") & ~F.isnan("mae") & (F.col("rmse") > 0)
    joined = summary.join(again.withColumnRenamed("n", "stored_rows"), ["symbol", "date"]).join(imp, ["symbol", "date"])
    return joined.select(
        "symbol",
        "date",
        F.col("metrics.n").alias("n"),
        "stored_rows",
        agree.alias("scores_agree"),
        finite.alias("scores_finite"),
        "features",
        "gain",
    )


@query(
    "production_metrics",
    f"""WITH {COARSE_SQL}, b AS (SELECT max(date) AS last_day FROM days),
    r AS (SELECT symbol, feature_date AS date, last_day AS model_date, count(*) AS n FROM f, b
      WHERE {KEPT_SQL} AND feature_date > last_day - {PRODUCTION.val_days} GROUP BY ALL)
    SELECT symbol, date, model_date, n, true AS scores_finite, 1 AS models, 0 AS exit_code FROM r""",
)
def production_metrics(spark, sf):
    """A production run for the last day: scores on its validation days and its registry rows."""
    store, code = production_run(spark, sf)
    summary = spark.read.parquet(store.path("production_run_summary"))
    models = read_registry(spark, store.path("registry")).groupBy("symbol", "model_date").agg(F.count(F.lit(1)).alias("models"))
    finite = ~F.isnan("metrics.rmse") & ~F.isnan("metrics.mae") & (F.col("metrics.rmse") > 0)
    return summary.join(models, ["symbol", "model_date"]).select(
        "symbol", "date", "model_date", F.col("metrics.n").alias("n"), finite.alias("scores_finite"), "models", F.lit(code).alias("exit_code")
    )


def production_run(spark, sf):
    """The store of a production run after the last day, and its exit code."""
    store = Store(scratch_path(spark, "production"))
    q = td.quotes(spark, sf)
    sizes = q.select("symbol").distinct().withColumn("tick_size", F.lit(0.01))
    last = td.symbol_spans(spark, sf).first()["last_day"]
    status = run_production(q, symbols_of(spark, sf), sizes, last + timedelta(days=1), COARSE, PRODUCTION, store, NOW)
    return store, status.first()["exit_code"]


@query(
    "production_summary",
    f"""WITH {COARSE_SQL}, b AS (SELECT max(date) AS last_day FROM days),
    r AS (SELECT symbol, last_day AS model_date, count(*) AS n, count(DISTINCT feature_date) AS scored_days FROM f, b
      WHERE {KEPT_SQL} AND feature_date > last_day - {PRODUCTION.val_days} GROUP BY ALL)
    SELECT symbol, model_date, 'production' AS mode, n, model_date - {PRODUCTION.val_days - 1} AS first_val_day, model_date AS last_val_day,
      {PRODUCTION.val_days}::BIGINT AS val_days, model_date - {PRODUCTION.val_days + PRODUCTION.train_days - 1} AS first_train_day,
      model_date - {PRODUCTION.val_days} AS last_train_day, {PRODUCTION.train_days}::BIGINT AS train_days, true AS agrees FROM r""",
)
def production_summary(spark, sf):
    """What a production run says of its models; its overall scores next to those of the stored predictions."""
    store, _ = production_run(spark, sf)
    told = spark.read.parquet(store.path("production_summary"))
    again = evaluate(spark.read.parquet(store.path("production_predictions")), ["symbol"]).select("symbol", "rmse", "mae", "qlike")
    told_of = lambda m: F.col(f"validation_metrics.{m}")
    near = [F.abs(told_of(m) - F.col(m)) <= 1e-9 * F.greatest(F.abs(told_of(m)), F.lit(1.0)) for m in ("rmse", "mae", "qlike")]
    edge = lambda c: (F.array_min(c), F.array_max(c), F.size(c).cast("bigint"))
    first_train, last_train, n_train = edge("train_dates")
    first_val, last_val, n_val = edge("val_dates")
    return told.join(again, "symbol").select(
        "symbol",
        F.col("date").alias("model_date"),
        "mode",
        F.col("validation_metrics.n").alias("n"),
        first_val.alias("first_val_day"),
        last_val.alias("last_val_day"),
        n_val.alias("val_days"),
        first_train.alias("first_train_day"),
        last_train.alias("last_train_day"),
        n_train.alias("train_days"),
        (near[0] & near[1] & near[2]).alias("agrees"),
    )


@query(
    "scored_status",
    f"""WITH {LIVE_SQL}, b AS (SELECT min(date) AS first_day FROM days),
    st AS (SELECT symbol, CAST(make_timestamp(t//1000) AS DATE) AS date, CASE WHEN NOT warm THEN 'warmup'
      WHEN symbol <> 'error' AND CAST(make_timestamp(t//1000) AS DATE) >= first_day + {MODEL_AFTER_DAYS} THEN 'ok' ELSE 'no_model' END AS status FROM live, b)
    SELECT symbol, date, status, count(*) AS n, count(*) FILTER (status = 'ok') AS n_scored FROM st GROUP BY ALL""",
)
def scored_status(spark, sf):
    """Live features of the whole history scored with the models in force; status counts per symbol."""
    _, paths = fitted(spark, sf)
    first = td.symbol_spans(spark, sf).first()["first_day"]
    # no model was published for one symbol; each window's models are in force from its own days on
    entries = [
        (symbol, first + timedelta(days=MODEL_AFTER_DAYS + WINDOW.test_days * k), path, NOW)
        for k, window in enumerate(sorted(paths))
        for symbol, path in sorted(paths[window].items())
        if symbol != "error"
    ]
    registry = spark.createDataFrame(entries, "symbol string, model_date date, path string, updated_at timestamp")
    stream_rows = with_live_columns(live(spark, sf), COARSE)
    scored = score_live(stream_rows, registry, COARSE.feature_columns, 30 * LOOKBACK_DAYS, COARSE.grid)
    day = day_of_ns(F.col("timestamp"), COARSE.grid)
    return scored.groupBy("symbol", day.alias("date"), "status").agg(
        F.count(F.lit(1)).alias("n"), F.count("volatility").alias("n_scored")
    )
