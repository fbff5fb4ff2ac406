"""Market-shaped views of the test tables: events become top-of-book quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.functions.time import ntz_to_ns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a quote; one in ten is stamped later than it was received."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    local = ntz_to_ns("ts")
    return ev.select(
        F.lit("binance-futures").alias("exchange"),
        F.col("event_type").alias("symbol"),
        (local - (eid % 10 - 1) * F.lit(1_000_000_000).cast("bigint")).alias("ts_ns"),
        local.alias("local_ts_ns"),
        eid.alias("update_id"),
        F.col("value").cast("double").alias("bid_price"),
        F.round(F.col("value") + F.lit(0.01) * (1 + eid % 3), 2).alias("ask_price"),
        (1 + eid % 50).cast("double").alias("bid_amount"),
        (1 + eid % 40).cast("double").alias("ask_amount"),
    )


# Sizes of the test instruments; one event type has none, to exercise unknown symbols.
TEST_SIZES = {"click": (0.01, 1.0), "purchase": (0.05, 0.1), "view": (0.005, 0.001), "signup": (0.25, 10.0)}


def asset_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per traded symbol, as an exchange would publish them."""
    sizes = spark.createDataFrame([(s, t, l) for s, (t, l) in TEST_SIZES.items()], "symbol string, tick_size double, lot_size double")
    symbols = table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol")).distinct()
    inner = F.create_map(F.col("symbol"), F.struct("tick_size", "lot_size"))
    return symbols.join(sizes, "symbol").select(F.to_json(F.create_map(F.lit("future"), inner)).alias("value"))


def with_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quotegrid.sources.assets import parse_assets, tick_sizes

    return tick_sizes(parse_assets(asset_documents(spark, sf_dir)), "future")


def vendor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw vendor rows: times in four units, some text broken, some receive times missing."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    ask = F.round(F.col("value") + F.lit(0.01) * (1 + eid % 3), 2)

    def text(divisor: int, digits: int):
        whole = F.call_function("div", us, F.lit(divisor).cast("bigint"))
        return F.concat(whole.cast("string"), F.lit("."), F.lpad((us % divisor).cast("string"), digits, "0"))

    event_time = (
        F.when(eid % 4 == 0, text(1_000_000, 6))
        .when(eid % 4 == 1, text(1_000, 3))
        .when(eid % 4 == 2, us.cast("string"))
        .otherwise((us * 1000).cast("string"))
    )
    return ev.select(
        F.col("event_type").alias("symbol"),
        F.when(eid % 29 == 0, "n/a").otherwise(event_time).alias("eventTimeUnix"),
        F.when(eid % 17 != 0, us.cast("string")).alias("receiveTime"),
        (1 + eid % 40).cast("string").alias("askQty"),
        F.when(eid % 23 == 0, "bad").otherwise(ask.cast("string")).alias("askPrice"),
        F.col("value").cast("string").alias("bidPrice"),
        F.when(eid % 3 == 0, F.lit(0)).when(eid % 3 == 2, F.lit(7)).alias("exchange"),
        eid.alias("updateId"),
    )


def symbol_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which each symbol has quotes."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("symbol"), F.col("ts").cast("date").alias("date")).distinct()


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of quote files under two roots, with gaps, in up to two formats."""
    d = F.day("date")
    days = symbol_days(spark, sf_dir)
    name = F.concat(F.lit("binance-futures_book_ticker_"), F.col("date").cast("string"), F.lit("_"), F.col("symbol"))
    files = []
    for root, ext, gap in (
        ("primary", ".csv.zst", (d % 5 == 0) | (d % 3 == 0)),
        ("primary", ".csv.gz", d % 5 == 0),
        ("fallback", ".csv.gz", (d % 10 == 0) | (d % 7 == 0)),
    ):
        path = F.concat(F.lit(f"/{root}/"), name, F.lit(ext))
        files.append(days.where(~gap).select("symbol", "date", F.lit(root).alias("root"), F.lit(ext).alias("ext"), path.alias("path")))
    out = files[0]
    for f in files[1:]:
        out = out.unionByName(f)
    return out


def symbol_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every symbol with the first and last day of the whole data."""
    days = symbol_days(spark, sf_dir)
    span = days.agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    bounds = span.first()
    return days.select("symbol").distinct().select(
        "symbol", F.lit(bounds["first_day"]).alias("first_day"), F.lit(bounds["last_day"]).alias("last_day")
    )


def partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of feature partitions: day 4 of each month was never built, day 9 is empty."""
    rows = table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("symbol"), F.col("ts").cast("date").alias("date")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return rows.where(F.day("date") != 4).withColumn("rows", F.when(F.day("date") == 9, F.lit(0).cast("bigint")).otherwise(F.col("rows")))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        symbol_days(spark, sf_dir)
        .where(F.day("date") <= 12)
        .select("symbol", "date", F.lit(1).cast("bigint").alias("rows"), F.lit("2024-02-01 00:00:00").cast("timestamp").alias("verified_at"))
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model every third day, for all symbols but ``error``; day 6 was published twice."""
    days = symbol_days(spark, sf_dir).where((F.day("date") % 3 == 0) & (F.col("symbol") != "error"))
    version = F.explode(F.when(F.day("date") == 6, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return days.withColumn("v", version).select(
        "symbol",
        F.col("date").alias("model_date"),
        F.concat_ws("/", F.lit("models"), F.col("symbol"), F.col("date").cast("string"), F.concat(F.lit("v"), F.col("v"))).alias("path"),
        F.timestamp_add("HOUR", F.col("v"), F.col("date").cast("timestamp")).alias("updated_at"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the JSON feed would carry them, with ``event_id``.

    Of twenty messages one is a tick size, one a trade, one a depth update, one
    broken, one names its event under ``type``, one has no name; the rest are quotes.
    """
    q = quotes(spark, sf_dir)
    eid = F.col("update_id")
    us = F.call_function("div", F.col("local_ts_ns"), F.lit(1000).cast("bigint"))

    def ticker(field: str):
        return F.struct(
            F.lit("bookTicker").alias(field),
            "symbol",
            F.col("update_id").alias("updateID"),
            F.col("bid_price").alias("bidPrice"),
            F.col("bid_amount").alias("bidQty"),
            F.col("ask_price").alias("askPrice"),
            F.col("ask_amount").alias("askQty"),
            us.alias("updateTime"),
        )

    size = F.struct(F.lit("symbol").alias("Event"), F.col("symbol").alias("Symbol"), F.lit(0.01).alias("TickSize"))
    trade = F.struct(F.lit("trade").alias("event"), "symbol", F.col("bid_price").alias("price"), F.col("bid_amount").alias("qty"))
    nameless = F.struct("symbol", F.col("bid_price").alias("price"))
    step = F.sequence(F.lit(0), (eid % 3).cast("int"))
    side = lambda start, sign, amount: F.transform(step, lambda k: F.array(F.round(start + sign * k * 0.01, 2), amount + k))
    depth = F.struct(
        F.lit("depth").alias("event"),
        "symbol",
        (F.col("update_id") - 2).alias("prevLastUpdateID"),
        (F.col("update_id") - 1).alias("firstUpdateID"),
        F.col("update_id").alias("lastUpdateID"),
        side(F.col("bid_price"), -1, F.col("bid_amount")).alias("bids"),
        side(F.col("ask_price"), 1, F.col("ask_amount")).alias("asks"),
        us.alias("updateTime"),
    )
    k = eid % 20
    value = (
        F.when(k == 0, F.to_json(size))
        .when(k == 1, F.to_json(trade))
        .when(k == 2, F.substring(F.to_json(ticker("event")), 1, 40))
        .when(k == 3, F.to_json(ticker("type")))
        .when(k == 4, F.to_json(depth))
        .when(k == 5, F.to_json(nameless))
        .otherwise(F.to_json(ticker("event")))
    )
    return q.select(F.col("update_id").alias("event_id"), value.alias("value"))


def quote_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid quotes as bookTicker messages, and a tick size per symbol with each hundredth."""
    q = quotes(spark, sf_dir).where("local_ts_ns >= ts_ns")
    us = F.call_function("div", F.col("local_ts_ns"), F.lit(1000).cast("bigint"))
    ticker = F.struct(
        F.lit("bookTicker").alias("event"),
        "symbol",
        F.col("update_id").alias("updateID"),
        F.col("bid_price").alias("bidPrice"),
        F.col("ask_price").alias("askPrice"),
        us.alias("updateTime"),
    )
    sizes = q.select("symbol").distinct().select(
        F.lit(0).cast("bigint").alias("us"),
        F.to_json(F.struct(F.lit("symbol").alias("Event"), F.col("symbol").alias("Symbol"), F.lit(0.01).alias("TickSize"))).alias("value"),
    )
    return q.select(us.alias("us"), F.to_json(ticker).alias("value")).unionByName(sizes)
