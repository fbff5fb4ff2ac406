"""Boosted-tree forecasts of the volatility label: fit, score, importance, storage."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotegrid.config import TrainConfig
from quotegrid.models.worker import MISSING, model_list, predicted_volatility
from quotegrid.operators.metrics import downsample_last
from quotegrid.operators.quantiles import exact_quantiles, from_normal, quantile_array, to_normal
from quotegrid.session import small_side


IMPORTANCE = "symbol string, feature string, importance_gain double, importance_split bigint"


@dataclass
class VolatilityModel:
    symbol: str
    trees: GBTRegressionModel
    quantiles: np.ndarray
    features: list[str]

    def score(self, rows: DataFrame, out: str = "y_pred") -> DataFrame:
        """Add the predicted volatility."""
        scored = self.trees.transform(assemble(rows, self.features)).drop("features")
        return scored.withColumn(out, from_normal(self.quantiles, F.col("prediction"))).drop("prediction")

    def importance(self, spark: SparkSession) -> DataFrame:
        """Gain share and split count per feature, highest gain first."""
        gains = self.trees.featureImportances.toArray()
        splits: Counter[int] = Counter()
        for tree in self.trees.trees:
            splits.update(int(i) for i in re.findall(r"If \(feature (\d+) ", tree.toDebugString))
        rows = [(self.symbol, f, float(gains[i]), splits[i]) for i, f in enumerate(self.features)]
        return spark.createDataFrame(rows, IMPORTANCE).orderBy(F.desc("importance_gain"), "feature")

    def save(self, path: str) -> None:
        """Store the trees, the feature list and the quantiles; the nodes once more as a flat table."""
        spark = SparkSession.active()
        self.trees.write().overwrite().save(f"{path}/trees")
        meta = [(self.symbol, self.features, [float(v) for v in self.quantiles], list(self.trees.treeWeights))]
        schema = "symbol string, features array<string>, quantiles array<double>, weights array<double>"
        spark.createDataFrame(meta, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
        node = F.col("nodeData")
        nodes = spark.read.parquet(f"{path}/trees/data").select(
            F.col("treeID").alias("tree"),
            node["id"].alias("id"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            node["split"]["featureIndex"].alias("feature"),
            F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
            node["prediction"].alias("value"),
            (node["gain"] * F.get(node["impurityStats"], F.lit(0))).alias("gain"),
        )
        nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")

    @classmethod
    def load(cls, path: str) -> VolatilityModel:
        meta = SparkSession.active().read.parquet(f"{path}/meta").first()
        if not meta["features"]:
            raise ValueError(f"{path} has no feature list")
        return cls(
            meta["symbol"], GBTRegressionModel.load(f"{path}/trees"), np.asarray(meta["quantiles"]), list(meta["features"])
        )


def stored_importance(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Gain share and split count of every feature of all the stored models, from their nodes, in one pass."""
    if not paths:
        return spark.createDataFrame([], IMPORTANCE)
    model = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/(?:meta|nodes)/[^/]*$", 1).alias("model")
    meta = spark.read.parquet(*[f"{p}/meta" for p in paths]).select("symbol", model, F.posexplode("features").alias("k", "feature"))
    nodes = spark.read.parquet(*[f"{p}/nodes" for p in paths]).where("left >= 0")
    used = nodes.select(model, F.col("feature").alias("k"), "gain").groupBy("model", "k")
    used = used.agg(F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("splits"))
    both = meta.join(used, ["model", "k"], "left")
    # models are few trees: a window over the features of one
    share = F.col("gain") / F.sum("gain").over(Window.partitionBy("model"))
    return both.select(
        "symbol",
        "feature",
        F.coalesce(share, F.lit(0.0)).alias("importance_gain"),
        F.coalesce("splits", F.lit(0)).cast("bigint").alias("importance_split"),
    )


def verify_model(path: str) -> bool:
    """Whether a stored model loads and has features."""
    try:
        VolatilityModel.load(path)
        return True
    except Exception:
        return False


def assemble(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """One vector column; trees cannot split on NaN, so it becomes a value below all others."""
    filled = rows.withColumns({f"_f_{c}": F.coalesce(F.nanvl(c, F.lit(MISSING)), F.lit(MISSING)) for c in features})
    vec = VectorAssembler(inputCols=[f"_f_{c}" for c in features], outputCol="features")
    return vec.transform(filled).drop(*[f"_f_{c}" for c in features])


def labelled(rows: DataFrame, label: str) -> DataFrame:
    return rows.where(F.col(label).isNotNull() & ~F.isnan(label))


def fit_model(
    symbol: str, train: DataFrame, val: DataFrame, features: Sequence[str], label: str, cfg: TrainConfig
) -> VolatilityModel:
    """Fit one symbol on ``train``, cut where ``val`` is predicted best; rows hold that symbol only.

    Spark's own early stopping ends at the first tree that brings little. So two and a half times ``patience`` trees are grown, then
    twice as many as long as fewer than ``patience`` follow the best one. A longer fit begins with the same trees.
    """
    features = [c for c in features if c in train.columns]
    if cfg.downsample_ns:
        train, val = downsample_last(train, cfg.downsample_ns), downsample_last(val, cfg.downsample_ns)
    train, val = labelled(train, label), labelled(val, label)
    if train.isEmpty() or val.isEmpty():
        raise ValueError(f"{symbol}: train or validation data is empty")
    quantiles = quantile_array(exact_quantiles(train, ["symbol"], label, count=cfg.quantiles))
    z = to_normal(quantiles, F.col(label)).alias("z")
    rows, held = (assemble(df, features).select("features", z) for df in (train, val))
    grower = GBTRegressor(
        featuresCol="features",
        labelCol="z",
        lossType="squared",
        maxDepth=cfg.max_depth,
        stepSize=cfg.step_size,
        minInstancesPerNode=cfg.min_instances,
        featureSubsetStrategy=str(cfg.feature_fraction),
        subsamplingRate=1.0,
        maxBins=cfg.max_bins,
        seed=cfg.seed,
    )
    rows.persist()  # read by every tree
    try:
        grown = min(cfg.max_iter, max(1, 5 * cfg.patience // 2))
        while True:
            trees = grower.setMaxIter(grown).fit(rows)
            best = best_iteration(trees.evaluateEachIteration(held, "squared"), cfg.patience)
            if best + cfg.patience <= grown or grown >= cfg.max_iter:
                break
            grown = min(cfg.max_iter, 2 * grown)
    finally:
        rows.unpersist()
    return VolatilityModel(symbol, first_trees(trees, best), quantiles, features)


def best_iteration(errors: Sequence[float], patience: int) -> int:
    """Trees up to the lowest validation error, looking no further once ``patience`` trees brought none lower."""
    best = 0
    for k, error in enumerate(errors):
        if error < errors[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The model of the first ``n`` trees."""
    old = model._java_obj
    if n >= len(old.trees()):
        return model
    jvm, sc = SparkSession.active()._jvm, SparkSession.active().sparkContext
    trees = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = sc._gateway.new_array(jvm.double, n)
    for k in range(n):
        trees[k], weights[k] = old.trees()[k], old.treeWeights()[k]
    cut = jvm.org.apache.spark.ml.regression.GBTRegressionModel(old.uid(), trees, weights, old.numFeatures())
    old.copyValues(cut, old.extractParamMap())
    return GBTRegressionModel(cut)


def fit_symbols(
    data: DataFrame,
    symbols: Sequence[str],
    features: Sequence[str],
    label: str,
    cfg: TrainConfig,
    each: Callable[[VolatilityModel], object] | None = None,
    parallel: int = 4,
) -> tuple[dict[str, object], dict[str, str]]:
    """One model per symbol from rows with a ``role`` column; a failed symbol does not stop the others.

    Each fit is a distributed job; ``parallel`` of them share the cluster.
    Returns what ``each`` made of every model, and the failures by symbol.
    """

    def one(symbol: str):
        rows = data.where(F.col("symbol") == symbol)
        model = fit_model(
            symbol,
            rows.where("role = 'train'").drop("role"),
            rows.where("role = 'val'").drop("role"),
            features,
            label,
            cfg,
        )
        return each(model) if each else model

    done, failed = {}, {}
    with ThreadPoolExecutor(parallel) as pool:
        jobs = {s: pool.submit(one, s) for s in symbols}
        for s, job in jobs.items():
            try:
                done[s] = job.result()
            except Exception as exc:  # one symbol's failure is reported, not raised
                failed[s] = str(exc)
    return done, failed


def score_stored(rows: DataFrame, paths: dict[str, str], label: str, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``symbol``, the keys, ``y_true`` and ``y_pred`` of labelled rows: all symbols in one pass, each by its stored model."""
    models = rows.sparkSession.createDataFrame(sorted(paths.items()), "symbol string, path string")
    named = labelled(rows, label).join(small_side(models), "symbol")
    names = [c for c in features if c in rows.columns]
    scored = predicted_volatility(model_list((F.col("path"), F.lit(0))), names)
    return named.select("symbol", *keys, F.col(label).alias("y_true"), scored.alias("y_pred"))
