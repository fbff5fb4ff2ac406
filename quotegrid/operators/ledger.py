"""Ledger-driven incremental work as table operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "symbol string, date date, rows bigint, verified_at timestamp"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table; a missing one, and each unreadable file of it, is empty."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).option("ignoreCorruptFiles", True).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], LEDGER_SCHEMA)


def newest(ledger: DataFrame) -> DataFrame:
    """The rows recorded last for each partition."""
    return ledger.groupBy("symbol", "date").agg(F.max_by("rows", "verified_at").alias("recorded_rows"))


def append_ledger(ledger: DataFrame, stats: DataFrame, verified_at: Column) -> DataFrame:
    """New ledger rows: non-empty partitions that are not recorded with this count; the newest row holds."""
    known = newest(ledger).select("symbol", "date", F.col("recorded_rows").alias("rows"))
    fresh = stats.where("rows > 0").join(known, ["symbol", "date", "rows"], "left_anti")
    return fresh.select("symbol", "date", "rows", verified_at.cast("timestamp").alias("verified_at"))


def classify_tasks(tasks: DataFrame, ledger: DataFrame, stats: DataFrame) -> DataFrame:
    """``done``: recorded and present in full. ``verify``: present but not recorded. ``build``: the rest.

    A partition with fewer rows than were recorded has lost files and is built again.
    """
    recorded = newest(ledger)
    present = stats.select("symbol", "date", F.col("rows").alias("present_rows"))
    joined = tasks.join(recorded, ["symbol", "date"], "left").join(present, ["symbol", "date"], "left")
    action = (
        F.when(F.col("present_rows") >= F.col("recorded_rows"), "done")
        .when(F.col("recorded_rows").isNull() & (F.col("present_rows") > 0), "verify")
        .otherwise("build")
    )
    return joined.select(*tasks.columns, action.alias("action"))


def pending_tasks(tasks: DataFrame, ledger: DataFrame, stats: DataFrame) -> DataFrame:
    return classify_tasks(tasks, ledger, stats).where("action = 'build'").drop("action")


def failed_tasks(tasks: DataFrame, available_raw: DataFrame, use_prev_day: bool) -> DataFrame:
    """``symbol, feature_date`` of the tasks that lack a raw day."""
    days = [F.col("feature_date")] + ([F.date_sub("feature_date", 1)] if use_prev_day else [])
    needed = tasks.select("symbol", "feature_date", F.explode(F.array(*days)).alias("date"))
    lacking = needed.join(available_raw.select("symbol", "date").distinct(), ["symbol", "date"], "left_anti")
    return lacking.select("symbol", "feature_date").distinct()


def failed_symbols(tasks: DataFrame, available_raw: DataFrame, use_prev_day: bool) -> DataFrame:
    """Symbols with a task that lacks a raw day, which training skips, and how many such days they have."""
    failed = failed_tasks(tasks, available_raw, use_prev_day)
    return failed.groupBy("symbol").agg(F.count(F.lit(1)).alias("failed_dates"))


def job_status(outcomes: DataFrame) -> DataFrame:
    """Exit code of a daily run from ``symbol, trained, published`` flags.

    0 if nothing failed, 1 if something was trained and published, else 2.
    A symbol that was not trained is not published either, but counts once.
    """
    train_failed = F.bool_or(~F.col("trained"))
    publish_failed = F.bool_or(F.col("trained") & ~F.col("published"))
    some = F.bool_or("trained") & F.bool_or(F.col("trained") & F.col("published"))
    counted = outcomes.agg(
        F.count(F.lit(1)).alias("symbols"),
        F.count(F.when(F.col("trained"), 1)).alias("trained"),
        F.count(F.when(F.col("trained") & F.col("published"), 1)).alias("published"),
        F.coalesce(train_failed, F.lit(False)).alias("tf"),
        F.coalesce(publish_failed, F.lit(False)).alias("pf"),
        F.coalesce(some, F.lit(False)).alias("some"),
    )
    code = F.when(~F.col("tf") & ~F.col("pf"), 0).when(F.col("some"), 1).otherwise(2)
    return counted.select("symbols", "trained", "published", code.alias("exit_code"))
