"""Model registry: a model is published by its row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.operators.ledger import AnalysisException

REGISTRY_SCHEMA = "symbol string, model_date date, path string, updated_at timestamp"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(REGISTRY_SCHEMA).option("ignoreCorruptFiles", True).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], REGISTRY_SCHEMA)


def register(rows: DataFrame, path: str) -> None:
    rows.select("symbol", "model_date", "path", "updated_at").coalesce(1).write.mode("append").parquet(path)


def current_models(registry: DataFrame) -> DataFrame:
    """The last published row per ``(symbol, model_date)``."""
    last = F.max(F.struct("updated_at", "path")).alias("m")
    return registry.groupBy("symbol", "model_date").agg(last).select("symbol", "model_date", "m.path", "m.updated_at")


def latest_models(asks: DataFrame, registry: DataFrame, lookback_days: int) -> DataFrame:
    """Newest model dated ``date`` or up to ``lookback_days - 1`` days before, null if none.

    Each model is laid out on the days it can serve, which makes this an equi-join.
    """
    served = registry.select(
        "symbol",
        F.explode(F.sequence("model_date", F.date_add("model_date", lookback_days - 1))).alias("date"),
        F.struct("model_date", "updated_at", "path").alias("m"),
    )
    best = served.groupBy("symbol", "date").agg(F.max("m").alias("m"))
    return asks.join(best, ["symbol", "date"], "left").select(
        *asks.columns, *[F.col(f"m.{c}").alias(c) for c in ("model_date", "path", "updated_at")]
    )


def candidate_models(asks: DataFrame, registry: DataFrame, lookback_days: int) -> DataFrame:
    """The models that may serve each ask, as ``models``: newest date first, one for each date, so ``lookback_days`` at most."""
    served = registry.select(
        "symbol",
        F.explode(F.sequence("model_date", F.date_add("model_date", lookback_days - 1))).alias("date"),
        F.struct("model_date", "updated_at", "path").alias("m"),
    )
    listed = served.groupBy("symbol", "date").agg(F.sort_array(F.collect_set("m"), asc=False).alias("models"))
    return asks.join(listed, ["symbol", "date"], "left").select(*asks.columns, "models")
