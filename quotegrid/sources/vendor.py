"""Best-price rows of the vendor store and their standard quote form."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.functions.epochs import epoch_to_micros, exchange_name

# Vendor column behind each optional quote field.
VENDOR_FIELDS = {"ask_amount": "askQty", "ask_price": "askPrice", "bid_price": "bidPrice", "bid_amount": "bidQty"}


def hour_predicates(first_day: date, last_day: date, column: str = "receiveTime") -> list[str]:
    """One condition per hour of the days, both ends included; each becomes a read task."""
    first = datetime.combine(first_day, time())
    hours = ((last_day - first_day).days + 1) * 24
    edges = [first + timedelta(hours=h) for h in range(hours + 1)]
    return [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(edges, edges[1:])]


def read_vendor_table(
    spark: SparkSession, url: str, table: str, first_day: date, last_day: date, **options: str
) -> DataFrame:
    """JDBC scan of whole days; the time filter runs in the store, other filters are pushed down by Spark."""
    return spark.read.jdbc(url, table, predicates=hour_predicates(first_day, last_day), properties=options)


def vendor_day_scan(vendor: DataFrame) -> DataFrame:
    """Rows with the UTC day they were received on; rows without a receive time belong to no day."""
    micros = epoch_to_micros(F.col("receiveTime"))
    day = F.date_from_unix_date(F.floor(micros / 86_400_000_000).cast("int"))
    return vendor.withColumn("date", day).where(F.col("date").isNotNull())


def _number(vendor: DataFrame, name: str) -> Column:
    """A numeric column read from text; bad text and an absent column are null."""
    if name not in vendor.columns:
        return F.lit(None).cast("double")
    return F.col(name).try_cast("double")


def vendor_to_quotes(vendor: DataFrame, ingest_time_us: int, exchange: str | None = None) -> DataFrame:
    """Standard quotes from vendor rows. A missing receive time becomes ``ingest_time_us``."""
    code = F.col("exchange") if "exchange" in vendor.columns else None
    update_id = F.col("updateId") if "updateId" in vendor.columns else F.lit(None)
    local_us = F.coalesce(epoch_to_micros(F.col("receiveTime")), F.lit(ingest_time_us).cast("bigint"))
    return vendor.select(
        exchange_name(code, exchange).alias("exchange"),
        "symbol",
        (epoch_to_micros(F.col("eventTimeUnix")) * 1000).alias("ts_ns"),
        (local_us * 1000).alias("local_ts_ns"),
        update_id.cast("bigint").alias("update_id"),
        *[_number(vendor, src).alias(dst) for dst, src in VENDOR_FIELDS.items()],
    ).where(F.col("ts_ns").isNotNull())
