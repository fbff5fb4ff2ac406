"""Calendars and train/validation/test date splits as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def days_between(first: Column, last: Column) -> Column:
    """Array of days, both ends included; empty if ``last`` is before ``first``."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def calendar(spans: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day of each row's span."""
    return spans.withColumn("date", F.explode(days_between(F.col(first), F.col(last)))).drop(first, last)


def latest_complete_day(reference_date: Column) -> Column:
    return F.date_sub(reference_date, 1)


def required_feature_dates(refs: DataFrame, train_days: int, val_days: int) -> DataFrame:
    """The ``train_days + val_days`` days before each row's ``reference_date``."""
    first = F.date_sub("reference_date", train_days + val_days)
    return refs.withColumn(
        "feature_date", F.explode(days_between(first, latest_complete_day(F.col("reference_date"))))
    )


def required_raw_dates(tasks: DataFrame, use_prev_day: bool) -> DataFrame:
    """Distinct raw days the ``(symbol, feature_date)`` tasks read."""
    days = [F.col("feature_date")]
    if use_prev_day:
        days.insert(0, F.date_sub("feature_date", 1))
    return tasks.select("symbol", F.explode(F.array(*days)).alias("date")).distinct()


def _roles(val_first: Column, val_last: Column, train_days: int, test: Column | None) -> Column:
    """Array of ``(role, days)`` with the train days right before the validation days."""
    train = days_between(F.date_sub(val_first, train_days), F.date_sub(val_first, 1))
    rows = [("train", train), ("val", days_between(val_first, val_last))]
    if test is not None:
        rows.append(("test", test))
    return F.array(*[F.struct(F.lit(r).alias("role"), d.alias("days")) for r, d in rows])


def _explode_roles(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("r", F.explode("roles"))
        .withColumn("date", F.explode("r.days"))
        .withColumn("role", F.col("r.role"))
        .drop("r", "roles")
    )


def production_split(targets: DataFrame, train_days: int, val_days: int) -> DataFrame:
    """Validation is the last ``val_days`` days up to ``target_date``, training the days before."""
    last = F.col("target_date")
    return _explode_roles(targets.withColumn("roles", _roles(F.date_sub(last, val_days - 1), last, train_days, None)))


def walk_forward_splits(spans: DataFrame, train_days: int, val_days: int, test_days: int) -> DataFrame:
    """Test windows of ``test_days`` over ``[first_day, last_day]``, each with the days before it."""
    n = F.datediff("last_day", "first_day")
    starts = F.sequence(F.lit(0), F.floor(n / test_days).cast("int"))
    windows = spans.withColumn("window_id", F.explode(starts))
    test_first = F.date_add("first_day", (F.col("window_id") * test_days).cast("int"))
    test_last = F.least(F.date_add(test_first, test_days - 1), F.col("last_day"))
    roles = _roles(F.date_sub(test_first, val_days), F.date_sub(test_first, 1), train_days, days_between(test_first, test_last))
    return _explode_roles(windows.withColumn("roles", roles)).drop("first_day", "last_day")


def missing_days(splits: DataFrame, present: DataFrame) -> DataFrame:
    """``symbol, window_id, days``: the days that keep a window from being complete."""
    absent = splits.join(present.select("symbol", "date").distinct(), ["symbol", "date"], "left_anti")
    return absent.groupBy("symbol", "window_id").agg(F.array_sort(F.collect_set("date")).alias("days"))


def complete_windows(splits: DataFrame, present: DataFrame) -> DataFrame:
    """Splits of the windows of which every day is present; one missing day fails the window."""
    have = present.select("symbol", "date").distinct().withColumn("have", F.lit(True))
    checked = splits.join(have, ["symbol", "date"], "left")
    good = checked.groupBy("symbol", "window_id").agg(F.bool_and(F.coalesce("have", F.lit(False))).alias("ok"))
    return splits.join(good.where("ok").drop("ok"), ["symbol", "window_id"], "left_semi")
