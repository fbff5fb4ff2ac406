"""Score live feature batches with the newest registered models and emit status messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.config import GridConfig
from quotegrid.functions.time import day_of_ns
from quotegrid.models.worker import predicted_volatility
from quotegrid.operators.registry import candidate_models, current_models
from quotegrid.streaming.events import status_message, status_of


def score_live(
    rows: DataFrame, registry: DataFrame, features: Sequence[str], lookback_days: int, grid: GridConfig
) -> DataFrame:
    """Add ``status`` and ``volatility`` to feature rows, all symbols in one pass.

    The registry names the models that may serve each symbol and day, newest first. The newest that can be read is
    taken, by whichever worker; a row without one has status ``no_model``.
    """
    dated = rows.withColumn("date", day_of_ns(F.col("timestamp"), grid))
    asks = dated.where("warm").select("symbol", "date").distinct()
    models = candidate_models(asks, current_models(registry), lookback_days).withColumn("warm", F.lit(True))
    found = dated.join(models, ["symbol", "date", "warm"], "left")
    listed = F.transform("models", lambda m: F.struct(m["path"].alias("path"), m["updated_at"].cast("string").alias("version")))
    vol = predicted_volatility(listed, features)
    scored = found.withColumn("volatility", vol)
    return scored.withColumn("status", status_of(F.col("warm"), F.col("volatility").isNotNull()))


def score_and_send(
    read_registry: Callable[[], DataFrame],
    send: Callable[[DataFrame, int], None],
    features: Sequence[str],
    lookback_days: int,
    grid: GridConfig,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body: look up models, score, hand JSON messages (``value``) to ``send``.

    The registry is read anew for every batch, so a published model is used from the next batch on.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read for the days asked and for the rows
        try:
            scored = score_live(batch, read_registry(), features, lookback_days, grid)
            send(scored.select("timestamp", "symbol", "status", status_message().alias("value")), batch_id)
        finally:
            batch.unpersist()

    return run
