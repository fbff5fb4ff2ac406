"""Daily jobs over tables: raw backfill, feature build, research runs, production training."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from quotegrid.config import FeatureConfig, TrainConfig
from quotegrid.models.boosting import VolatilityModel, fit_symbols, labelled, score_stored, stored_importance, verify_model
from quotegrid.operators import ledger as lg
from quotegrid.operators import registry as rg
from quotegrid.operators import splits as sp
from quotegrid.operators.features import feature_layout, feature_matrix
from quotegrid.operators.metrics import merge_states, score_states, scores_of
from quotegrid.session import materialize, small_side
from quotegrid.sources.quotes import QuoteFiles, quotes_for, write_by_symbol_day
from quotegrid.sources.rawdays import BackfilledQuotes


@dataclass(frozen=True)
class Store:
    """Where a run keeps its tables, all under one folder that executors share."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str, skip_corrupt: bool = False) -> DataFrame | None:
        try:
            return spark.read.option("ignoreCorruptFiles", skip_corrupt).parquet(self.path(name))
        except AnalysisException:
            return None

    def day_folders(self, spark: SparkSession, name: str, days: DataFrame) -> list[str]:
        """The folders that there are of these ``(symbol, date)``s. Only their symbols' folders are listed.

        The driver holds the asked days, a span of a job; the store may have any number of others.
        """
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        base = hadoop.Path(self.path(name))
        fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        by_symbol = days.select("symbol", "date").distinct().groupBy("symbol").agg(F.collect_list(F.col("date").cast("string")).alias("dates"))
        found = []
        for r in by_symbol.collect():
            folder = hadoop.Path(base, f"symbol={partition_name(r['symbol'])}")
            if fs.exists(folder):
                there = {f.getPath().getName(): f.getPath().toString() for f in fs.listStatus(folder)}
                found += [there[d] for d in (f"date={x}" for x in r["dates"]) if d in there]
        return sorted(found)

    def _days(self, spark: SparkSession, name: str, days: DataFrame | None, reader: DataFrameReader) -> DataFrame | None:
        """A scan of some days of a table, or of all."""
        paths = [self.path(name)] if days is None else self.day_folders(spark, name, days)
        if not paths:
            return None
        try:
            return reader.option("basePath", self.path(name)).load(paths)
        except AnalysisException:
            return None

    def stats(self, spark: SparkSession, name: str, only: DataFrame | None = None) -> DataFrame:
        """Rows of each stored symbol-day; with ``only`` nothing but its symbol-days is listed and read.

        A symbol-day with a file that cannot be read counts as empty: what is left of it is not the day.
        """
        keys = spark.read.schema("symbol string, date date").option("ignoreCorruptFiles", True).format("parquet")
        table = self._days(spark, name, only, keys)
        if table is None:
            return spark.createDataFrame([], "symbol string, date date, rows bigint")
        files = self.files(spark, name, only).groupBy("symbol", "date").agg(F.count("*").alias("stored"))
        rows = table.select("symbol", "date", F.col("_metadata.file_name").alias("file"))
        read = rows.groupBy("symbol", "date", "file").agg(F.count("*").alias("n"))
        read = read.groupBy("symbol", "date").agg(F.sum("n").alias("n"), F.count("*").alias("readable"))
        whole = F.when(F.col("readable") == F.col("stored"), F.col("n"))
        return files.join(read, ["symbol", "date"], "left").select("symbol", "date", F.coalesce(whole, F.lit(0)).alias("rows"))

    def files(self, spark: SparkSession, name: str, days: DataFrame | None = None) -> DataFrame:
        """``symbol, date, file`` of the stored files, from the listing alone."""
        listed = self._days(spark, name, days, spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet"))
        if listed is None:
            return spark.createDataFrame([], "symbol string, date date, file string")
        name_of = F.element_at(F.split("path", "/"), -1).alias("file")
        return listed.select(F.col("symbol").cast("string").alias("symbol"), F.col("date").cast("date").alias("date"), name_of)

    def ledger(self, spark: SparkSession, name: str) -> DataFrame:
        return lg.read_ledger(spark, self.path(name))

    def record(self, spark: SparkSession, name: str, stats: DataFrame, at: datetime) -> None:
        """Append the verified partitions that the ledger lacks."""
        fresh = lg.append_ledger(self.ledger(spark, name), stats, F.lit(at))
        materialize(fresh).coalesce(1).write.mode("append").parquet(self.path(name))


# Characters that Spark writes as % and two hexadecimal digits in the name of a partition's folder.
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def partition_name(value: str) -> str:
    """The value of a partition column as its folder is named."""
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in value)


def day_batches(pending: DataFrame, cfg: FeatureConfig, blocks_per_task: int) -> list[tuple[date, date]]:
    """Spans of feature dates, each small enough that a task sorts few blocks of grid points."""
    width = int(pending.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(blocks_per_task * width // feature_layout(cfg).blocks, 1)
    spans: list[list] = []
    for r in pending.groupBy("feature_date").count().orderBy("feature_date").collect():
        if spans and spans[-1][2] + r["count"] <= most:
            spans[-1][1:] = [r["feature_date"], spans[-1][2] + r["count"]]
        else:
            spans.append([r["feature_date"], r["feature_date"], r["count"]])
    return [(first, last) for first, last, _ in spans]


def build_features(
    quotes: DataFrame | QuoteFiles | BackfilledQuotes,
    tasks: DataFrame,
    sizes: DataFrame,
    cfg: FeatureConfig,
    store: Store,
    now: datetime,
    blocks_per_task: int = 4,
) -> DataFrame:
    """Build all pending symbol-days; returns ``symbol, feature_date`` of those that failed.

    ``tasks`` holds ``symbol, date``. Recorded and whole partitions are skipped,
    unrecorded ones are counted and recorded, missing or broken ones are built. A task
    fails if a raw day, its tick size or every row is missing. What an earlier run left of a
    failed partition stays on disk, but is not the day: the task is returned as failed.

    A long backfill runs as one job per span of days, as wide as the cluster, and
    each is recorded when it is done: a broken run goes on where it stopped.
    """
    spark = quotes.sparkSession
    recorded = store.ledger(spark, "feature_ledger")
    plan = materialize(lg.classify_tasks(tasks, recorded, store.stats(spark, "features", tasks)))
    found = plan.where("action = 'verify'").select("symbol", "date")
    if not found.isEmpty():
        store.record(spark, "feature_ledger", store.stats(spark, "features", found), now)
    pending = plan.where("action = 'build'").select("symbol", F.col("date").alias("feature_date"))
    wanted = pending.withColumnRenamed("feature_date", "date")
    old = materialize(store.files(spark, "features", wanted))
    for first, last in day_batches(pending, cfg, blocks_per_task):
        batch = pending.where(F.col("feature_date").between(first, last))
        raw, days = quotes_for(quotes, batch, cfg.grid)
        lacking = lg.failed_tasks(batch, days, cfg.grid.use_prev_day)
        ready = batch.join(lacking, ["symbol", "feature_date"], "left_anti").join(small_side(sizes), "symbol")
        ready = materialize(ready.select("symbol", "feature_date", "tick_size"))
        rows = feature_matrix(raw, ready, cfg, prune=True).withColumnRenamed("feature_date", "date")
        write_by_symbol_day(rows, store.path("features"), "timestamp")
        built = _written(store, spark, ready.select("symbol", F.col("feature_date").alias("date")), old)
        store.record(spark, "feature_ledger", store.stats(spark, "features", built), now)
    present = _written(store, spark, wanted, old).withColumnRenamed("date", "feature_date")
    return materialize(pending.join(present, ["symbol", "feature_date"], "left_anti"))


def _written(store: Store, spark: SparkSession, days: DataFrame, old: DataFrame) -> DataFrame:
    """Those of the days that have a file which was not there before."""
    new = store.files(spark, "features", days).join(old, ["symbol", "date", "file"], "left_anti")
    return materialize(new.select("symbol", "date").distinct())


def _write_days(df: DataFrame, path: str) -> None:
    """A small table by date; only the days it holds are replaced, and of those the symbols it holds."""
    (
        df.repartition("date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "symbol")
        .parquet(path)
    )


def save_model(model: VolatilityModel, store: Store, model_date: date) -> str:
    """Store the model of one fit under a new path."""
    path = store.path(f"models/{model.symbol}/{model_date}/{uuid4().hex}")
    model.save(path)
    if not verify_model(path):
        raise RuntimeError("the stored model does not load")
    return path


def save_results(
    paths: dict[str, str], test: DataFrame, features: Sequence[str], label: str, cfg: TrainConfig, store: Store, prefix: str, model_date: date
) -> DataFrame:
    """Score the test rows of all fits of a window; store predictions, score states by day, importances and summaries.

    Returns the states, from which scores over any days follow without the predictions. Each table is written once for all symbols. A rerun replaces the symbol-days it tests and no others.
    """
    spark = test.sparkSession
    scored = score_stored(test, paths, label, features, ["date", "timestamp"])
    write_by_symbol_day(scored, store.path(f"{prefix}predictions"), "timestamp")
    days = materialize(labelled(test, label).select("symbol", "date").distinct())
    stored = spark.read.parquet(store.path(f"{prefix}predictions")).join(small_side(days), ["symbol", "date"], "left_semi")
    params = F.create_map(*[F.lit(v) for kv in cfg.tree_params().items() for v in kv])
    of = spark.createDataFrame(sorted(paths.items()), "symbol string, path string")
    importance = materialize(stored_importance(spark, sorted(paths.values())))
    states = materialize(score_states(stored, ["symbol", "date"]))
    _write_days(states, store.path(f"{prefix}score_states"))
    summary = scores_of(states, ["symbol", "date"]).join(of, "symbol")
    summary = summary.select(
        "symbol",
        "date",
        F.lit(model_date).alias("model_date"),
        F.struct("n", "rmse", "mae", "corr", "qlike").alias("metrics"),
        F.array(*[F.lit(c) for c in features if c in test.columns]).alias("features_used"),
        params.alias("params"),
        "path",
    )
    _write_days(summary, store.path(f"{prefix}run_summary"))
    # Importances are the same for all test days of a fit.
    _write_days(importance.join(days, "symbol"), store.path(f"{prefix}feature_importance"))
    return states


def _split_rows(table: DataFrame, split: DataFrame) -> DataFrame:
    """Feature rows with their role; the split is a few days per symbol."""
    return table.join(small_side(split.select("symbol", "date", "role")), ["symbol", "date"])


def run_walk_forward(
    spans: DataFrame, features: Sequence[str], label: str, cfg: TrainConfig, store: Store, now: datetime, parallel: int = 4
) -> dict[str, str]:
    """Fit and score every complete, unrecorded window of ``spans`` (symbol, first_day, last_day).

    Returns the failures by symbol and window, a window with missing days among them. Windows are
    few (days over ``test_days``); each is a set of distributed fits, one per symbol.
    """
    spark = spans.sparkSession
    table = store.read(spark, "features")
    splits = sp.walk_forward_splits(spans, cfg.train_days, cfg.val_days, cfg.test_days)
    splits = materialize(splits)
    stored = materialize(store.stats(spark, "features", splits).where("rows > 0"))
    ready = sp.complete_windows(splits, stored)
    recorded = store.ledger(spark, "result_ledger").select("symbol", "date").distinct()
    todo = (
        ready.where("role = 'test'")
        .join(recorded, ["symbol", "date"], "left_anti")
        .groupBy("symbol", "window_id")
        .agg(F.min("date").alias("first_test"))
    )
    ready = materialize(ready)
    failures = {
        f"{r['symbol']}/{r['window_id']}": "missing feature days: " + ", ".join(map(str, r["days"]))
        for r in sp.missing_days(splits, stored).collect()
    }
    by_window: dict[int, list[str]] = {}
    for r in todo.collect():
        by_window.setdefault(r["window_id"], []).append(r["symbol"])
    for window, symbols in sorted(by_window.items()):
        split = ready.where(F.col("window_id") == window)
        rows = _split_rows(table, split)
        first = split.where("role = 'test'").agg(F.min("date")).first()[0]

        done, failed = fit_symbols(
            rows, sorted(symbols), features, label, cfg, lambda m, first=first: save_model(m, store, first), parallel
        )
        failures |= {f"{s}/{window}": why for s, why in failed.items()}
        if not done:
            continue
        test = rows.where("role = 'test'").drop("role")
        save_results(done, test, features, label, cfg, store, "", first)
        tested = split.where("role = 'test'").where(F.col("symbol").isin(sorted(done)))
        store.record(spark, "result_ledger", store.stats(spark, "predictions", tested), now)
    return failures


def run_production(
    quotes: DataFrame | QuoteFiles | BackfilledQuotes,
    symbols: Sequence[str],
    sizes: DataFrame,
    reference_date: date,
    fcfg: FeatureConfig,
    cfg: TrainConfig,
    store: Store,
    now: datetime,
    parallel: int = 4,
    reasons: dict[str, str] | None = None,
) -> DataFrame:
    """The daily run: prepare features, fit all symbols, publish, report.

    The model date is the day before ``reference_date``. Symbols whose features
    could not be prepared are skipped. A model is published by its registry row,
    written only after the stored model was verified. Returns the exit code row;
    ``reasons`` is filled with why symbols failed.
    """
    spark = quotes.sparkSession
    refs = spark.createDataFrame([(s, reference_date) for s in symbols], "symbol string, reference_date date")
    needed = sp.required_feature_dates(refs, cfg.train_days, cfg.val_days).drop("reference_date")
    tasks = needed.withColumnRenamed("feature_date", "date")
    failed_tasks = build_features(quotes, tasks, sizes, fcfg, store, now)
    bad = {r["symbol"] for r in failed_tasks.select("symbol").distinct().collect()}

    targets = refs.select("symbol", sp.latest_complete_day(F.col("reference_date")).alias("target_date"))
    split = materialize(sp.production_split(targets, cfg.train_days, cfg.val_days))
    model_date = split.agg(F.max("target_date")).first()[0]
    table = store.read(spark, "features")
    good = [s for s in symbols if s not in bad] if table is not None else []
    unfit = {s: "there are no feature rows" for s in symbols if s not in bad and s not in good}
    published: dict[str, str] = {}
    if good:
        rows = _split_rows(table, split)
        published, failed = fit_symbols(
            rows, good, fcfg.feature_columns, fcfg.label_column, cfg, lambda m: save_model(m, store, model_date), parallel
        )
        unfit |= failed
    if published:
        val = rows.where("role = 'val'").drop("role")
        states = save_results(published, val, fcfg.feature_columns, fcfg.label_column, cfg, store, "production_", model_date)
        production_summary(states, split, published, fcfg, cfg, store, model_date, now)
        entries = [(s, model_date, p, now) for s, p in sorted(published.items())]
        rg.register(spark.createDataFrame(entries, rg.REGISTRY_SCHEMA), store.path("registry"))
    if reasons is not None:
        reasons |= {s: "features could not be prepared" for s in bad} | unfit
        if isinstance(quotes, BackfilledQuotes):
            for (s, d), why in sorted(quotes.why.items()):
                reasons[s] = f"{reasons.get(s, '')}; raw day {d}: {why}".removeprefix("; ")
    outcomes = [(s, s in published, s in published) for s in symbols]
    return lg.job_status(spark.createDataFrame(outcomes, "symbol string, trained boolean, published boolean"))


def production_summary(
    states: DataFrame, split: DataFrame, paths: dict[str, str], fcfg: FeatureConfig, cfg: TrainConfig, store: Store, model_date: date, now: datetime
) -> None:
    """One row per published model: its train and validation dates, and its scores over all validation rows."""
    spark = states.sparkSession
    dates = lambda role: F.array_sort(F.collect_set(F.when(F.col("role") == role, F.col("date"))))
    days = split.groupBy("symbol").agg(dates("train").alias("train_dates"), dates("val").alias("val_dates"))
    of = spark.createDataFrame(sorted(paths.items()), "symbol string, path string")
    overall = scores_of(merge_states(states, ["symbol"]), ["symbol"]).join(of, "symbol").join(days, "symbol")
    params = F.create_map(*[F.lit(v) for kv in cfg.tree_params().items() for v in kv])
    rows = overall.select(
        "symbol",
        F.lit("production").alias("mode"),
        "train_dates",
        "val_dates",
        F.struct("n", "rmse", "mae", "corr", "qlike").alias("validation_metrics"),
        F.array(*[F.lit(c) for c in fcfg.feature_columns]).alias("features_used"),
        params.alias("params"),
        "path",
        F.lit(now).alias("updated_at"),
        F.lit(model_date).alias("date"),
    )
    _write_days(rows, store.path("production_summary"))
