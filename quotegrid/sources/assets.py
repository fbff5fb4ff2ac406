"""Instrument metadata: JSON documents to a dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.session import small_side

ASSET_TYPE = "map<string,map<string,struct<tick_size:double,lot_size:double>>>"


def parse_assets(docs: DataFrame, column: str = "value") -> DataFrame:
    """``instrument_type, symbol, tick_size, lot_size`` from documents type -> symbol -> sizes."""
    by_type = docs.select(F.explode(F.from_json(column, ASSET_TYPE)).alias("instrument_type", "symbols"))
    rows = by_type.select("instrument_type", F.explode("symbols").alias("symbol", "sizes"))
    return rows.select("instrument_type", "symbol", "sizes.tick_size", "sizes.lot_size")


def read_assets(spark: SparkSession, path: str) -> DataFrame:
    return parse_assets(spark.read.text(path, wholetext=True))


def tick_sizes(assets: DataFrame, instrument_type: str) -> DataFrame:
    """Sizes of one instrument type; an unknown type is an error."""
    chosen = assets.where(F.col("instrument_type") == instrument_type).drop("instrument_type")
    if chosen.isEmpty():
        raise KeyError(f"instrument type {instrument_type!r} not found")
    return chosen


def join_tick_size(df: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of known symbols with their sizes."""
    return df.join(small_side(sizes), "symbol")


def unknown_symbols(df: DataFrame, sizes: DataFrame) -> DataFrame:
    return df.select("symbol").distinct().join(sizes, "symbol", "left_anti")
