"""Audits of partitions, calendars and arrival order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotegrid.functions.time import floor_div
from quotegrid.session import materialize, small_side


def partition_stats(df: DataFrame, time_col: str, date_col: str = "date") -> DataFrame:
    return df.groupBy("symbol", date_col).agg(
        F.count(F.lit(1)).alias("rows"), F.min(time_col).alias("first_ns"), F.max(time_col).alias("last_ns")
    )


def verify_partitions(expected: DataFrame, stats: DataFrame) -> DataFrame:
    """Row count of each expected partition, -1 if it is absent or empty."""
    counts = stats.select("symbol", "date", "rows")
    return expected.join(counts, ["symbol", "date"], "left").select(
        "symbol", "date", F.when(F.col("rows") > 0, F.col("rows")).otherwise(F.lit(-1).cast("bigint")).alias("rows")
    )


def completeness(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Days expected, present and missing per symbol with the share as a percent text."""
    have = present.select("symbol", "date").distinct().withColumn("have", F.lit(1))
    joined = expected.join(have, ["symbol", "date"], "left")
    counted = joined.groupBy("symbol").agg(F.count(F.lit(1)).alias("total"), F.count("have").alias("present"))
    return counted.select(
        "symbol",
        "total",
        "present",
        (F.col("total") - F.col("present")).alias("missing"),
        F.format_string("%.1f%%", F.col("present") * 100.0 / F.col("total")).alias("percent"),
    )


def missing_ranges(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Consecutive missing days per symbol as ranges."""
    missing = expected.join(present.select("symbol", "date").distinct(), ["symbol", "date"], "left_anti")
    w = Window.partitionBy("symbol").orderBy("date")
    island = F.date_sub("date", F.row_number().over(w))
    return (
        missing.withColumn("island", island)
        .groupBy("symbol", "island")
        .agg(F.min("date").alias("range_start"), F.max("date").alias("range_end"), F.count(F.lit(1)).alias("days"))
        .drop("island")
    )


def duplicates_and_order(df: DataFrame, arrival: str, time_col: str, chunk: int) -> DataFrame:
    """Per symbol: any repeated time, and times never falling in arrival order.

    The order test runs in chunks of the arrival number and once more on the
    last time seen before each chunk, so no task holds a whole symbol.
    """
    dup = (
        df.groupBy("symbol", time_col)
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("symbol")
        .agg(F.sum("c").alias("rows"), F.bool_or(F.col("c") > 1).alias("has_duplicates"))
    )
    part = df.withColumn("chunk", floor_div(F.col(arrival), chunk))
    inside = Window.partitionBy("symbol", "chunk").orderBy(arrival)
    falls = part.withColumn("falls", F.coalesce(F.col(time_col) < F.lag(time_col).over(inside), F.lit(False)))
    ends = falls.groupBy("symbol", "chunk").agg(
        F.bool_or("falls").alias("falls"),
        F.min_by(time_col, arrival).alias("first_time"),
        F.max_by(time_col, arrival).alias("last_time"),
    )
    across = Window.partitionBy("symbol").orderBy("chunk")
    seam = F.coalesce(F.col("first_time") < F.lag("last_time").over(across), F.lit(False))
    order = (
        ends.withColumn("seam", seam)
        .groupBy("symbol")
        .agg((~F.bool_or(F.col("falls") | F.col("seam"))).alias("is_monotonic"))
    )
    return dup.join(order, "symbol")


def audit_files(df: DataFrame, arrival: str, time_col: str, file: str, chunk: int) -> DataFrame:
    """A summary of each file of each symbol, from which ``merge_audits`` tells what holds for all files."""
    by = df.withColumnsRenamed({file: "file"}) if file != "file" else df
    named = by.withColumn("_of", F.struct("symbol", "file"))
    found = duplicates_and_order(named.drop("symbol").withColumnRenamed("_of", "symbol"), arrival, time_col, chunk)
    ends = by.groupBy("symbol", "file").agg(
        F.min(arrival).alias("first_arrival"),
        F.max(arrival).alias("last_arrival"),
        F.min_by(time_col, arrival).alias("first_time"),
        F.max_by(time_col, arrival).alias("last_time"),
        F.min(time_col).alias("least_time"),
        F.max(time_col).alias("greatest_time"),
    )
    told = found.select("symbol.symbol", "symbol.file", "rows", "has_duplicates", "is_monotonic")
    return told.join(ends, ["symbol", "file"])


def overlapping_files(audits: DataFrame) -> DataFrame:
    """``audits`` with ``run``: files of one run overlap in arrival or in time, and only their rows can tell more.

    A symbol has a file a day, so its summaries are few.
    """
    before = Window.partitionBy("symbol").orderBy("first_arrival", "file").rowsBetween(Window.unboundedPreceding, -1)
    apart = (F.col("first_arrival") > F.max("last_arrival").over(before)) & (F.col("least_time") > F.max("greatest_time").over(before))
    opened = audits.withColumn("_opens", F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0))
    upto = Window.partitionBy("symbol").orderBy("first_arrival", "file").rowsBetween(Window.unboundedPreceding, 0)
    return opened.withColumn("run", F.sum("_opens").over(upto)).drop("_opens")


def merge_audits(audits: DataFrame, rows_of: Callable[[DataFrame], DataFrame], arrival: str, time_col: str, chunk: int) -> DataFrame:
    """What ``duplicates_and_order`` says of all files, from their summaries.

    ``rows_of`` gives the rows of some files (symbol, file); only those of files that overlap are asked for.
    """
    runs = materialize(overlapping_files(audits), "audits")
    many = runs.groupBy("symbol", "run").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("symbol", "run")
    mixed = materialize(runs.join(many, ["symbol", "run"], "left_semi").select("symbol", "file", "run"), "mixed-files")
    whole = runs.join(many, ["symbol", "run"], "left_anti")
    if not mixed.isEmpty():
        rows = rows_of(mixed.select("symbol", "file")).join(small_side(mixed), ["symbol", "file"])
        again = audit_files(rows.drop("file"), arrival, time_col, "run", chunk).withColumn("run", F.col("file"))
        whole = whole.drop("file").unionByName(again.drop("file"))
    in_order = Window.partitionBy("symbol").orderBy("run")
    seam = F.coalesce(F.col("first_time") < F.lag("last_time").over(in_order), F.lit(False))
    return (
        whole.withColumn("seam", seam)
        .groupBy("symbol")
        .agg(
            F.sum("rows").alias("rows"),
            F.bool_or("has_duplicates").alias("has_duplicates"),
            (~F.bool_or(~F.col("is_monotonic") | F.col("seam"))).alias("is_monotonic"),
        )
    )


def drop_null_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a null in the columns. NaN is a value and stays."""
    keep = F.lit(True)
    for c in columns or df.columns:
        keep = keep & F.col(c).isNotNull()
    return df.where(keep)
