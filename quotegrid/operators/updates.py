"""Newest quote by update id, and which arriving updates are accepted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotegrid.functions.time import floor_div


def latest_by_update_id(quotes: DataFrame, fields: list[str]) -> DataFrame:
    newest = F.max(F.struct("update_id", *fields)).alias("q")
    return quotes.groupBy("symbol").agg(newest).select("symbol", "q.*")


def accepted_updates(quotes: DataFrame, arrival: str, chunk: int) -> DataFrame:
    """Rows whose update id is above all earlier ones of the symbol, in arrival order.

    The running maximum is taken in chunks of the arrival number; the maximum
    before a chunk comes from the chunk totals, so a hot symbol is many tasks.
    """
    part = quotes.withColumn("chunk", floor_div(F.col(arrival), chunk))
    earlier = Window.partitionBy("symbol").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        part.groupBy("symbol", "chunk")
        .agg(F.max("update_id").alias("top"))
        .select("symbol", "chunk", F.max("top").over(earlier).alias("before"))
    )
    inside = (
        Window.partitionBy("symbol", "chunk").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    )
    bar = F.greatest(F.max("update_id").over(inside), F.col("before"))
    return (
        part.join(before, ["symbol", "chunk"])
        .withColumn("bar", bar)
        .where(F.col("bar").isNull() | (F.col("update_id") > F.col("bar")))
        .drop("bar", "before", "chunk")
    )
