"""JSON market events: schemas, routing, and the quotes and tick sizes they carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event names and message fields of the feed; times are in microseconds.
BOOK_TICKER = "bookTicker"
SYMBOL = "symbol"
CLOCK = "clock"  # not of the feed: the time, told to a stream whose feed is silent
IGNORED_EVENTS = ("trade", "depth", "account", "order", "position", "balance")
EVENT_SCHEMAS = {
    "order": "event string, account string, clOrdID string, orderID string, symbol string, side string, "
    "positionSide string, price double, quantity double, avgPrice double, filledQuantity double, "
    "status string, tradeTime bigint, updateTime bigint",
    "position": "event string, account string, symbol string, positionSide string, entryPrice double, "
    "quantity double, updateTime bigint",
    "balance": "event string, account string, balance double, updateTime bigint",
    "trade": "event string, symbol string, tradeID bigint, side string, price double, qty double, "
    "tradeTime bigint, updateTime bigint",
    "bookTicker": "event string, symbol string, updateID bigint, bidPrice double, bidQty double, askPrice double, "
    "askQty double, tradeTime bigint, updateTime bigint, time bigint",
    "depth": "event string, symbol string, prevLastUpdateID bigint, firstUpdateID bigint, lastUpdateID bigint, "
    "bids array<array<double>>, asks array<array<double>>, tradeTime bigint, updateTime bigint",
    "account": "type string, symbol string, entryPrice double, qty double, latestPrice double, value string, "
    "maxValue string, time bigint",
    "symbol": "Event string, Symbol string, TickSize double, updateTime bigint",
}


def read_event_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of JSON lines from a folder, as column ``value``."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def read_event_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Stream of JSON messages from a Kafka topic, as column ``value``."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))


def _envelope(value: Column | str) -> Column:
    """A message as a map of texts: events name themselves in one of three fields."""
    return F.from_json(value, "map<string,string>")


def _field(envelope: Column, *names: str) -> Column:
    return F.coalesce(*[F.try_element_at(envelope, F.lit(n)) for n in names])


def _route(envelope: Column) -> Column:
    name = F.coalesce(_field(envelope, "event", "Event", "type"), F.lit("unknown"))
    return F.when(envelope.isNull(), "bad").otherwise(name)


def route(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``route``: the event name, ``unknown`` without one, or ``bad`` for broken JSON."""
    return df.withColumn("_m", _envelope(value)).withColumn("route", _route(F.col("_m"))).drop("_m")


def parse(df: DataFrame, event: str, value: str = "value") -> DataFrame:
    """Messages of one event with their fields as columns."""
    return df.where(F.col("route") == event).select(F.from_json(value, EVENT_SCHEMAS[event]).alias("m")).select("m.*")


# Microseconds from the year 2000 to the year 2200; seconds, milliseconds and nanoseconds lie outside.
PLAUSIBLE_US = (946_684_800_000_000, 7_258_118_400_000_000)


def live_messages(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The two events the live features use, tagged by ``route``; all else is skipped."""
    return tag_messages(df, value, keep).where("used").drop("used")


def tag_messages(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """All messages with their ``route``, the live features' fields, and whether they are ``used``. Parsed once.

    Numbers may come as JSON numbers or as text. Quotes without id, time or price
    and sizes that are not positive are skipped like broken JSON, and so are infinite values and
    times outside ``PLAUSIBLE_US``: one of them would move the watermark for all symbols.
    """
    m = F.col("_m")
    is_size = F.col("route") == SYMBOL

    def number(name: str, kind: str, *names: str) -> Column:
        return _field(m, *names).try_cast(kind).alias(name)

    tagged = df.select(*keep, _envelope(value).alias("_m")).withColumn("route", _route(m))
    rows = tagged.select(
        *keep,
        "route",
        F.when(is_size, _field(m, "Symbol")).otherwise(_field(m, "symbol")).alias("symbol"),
        number("time_us", "bigint", "updateTime", "time", "tradeTime"),
        number("update_id", "bigint", "updateID"),
        number("bid_price", "double", "bidPrice"),
        number("ask_price", "double", "askPrice"),
        number("tick_size", "double", "TickSize"),
    )
    rows = rows.withColumns(
        {
            **{c: F.when(~is_size, F.col(c)) for c in ("update_id", "bid_price", "ask_price")},
            "tick_size": F.when(is_size, F.col("tick_size")),
        }
    )
    finite = lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))
    quote_ok = F.col("update_id").isNotNull() & F.coalesce(F.col("time_us").between(*PLAUSIBLE_US), F.lit(False))
    for price in ("bid_price", "ask_price"):
        quote_ok = quote_ok & finite(price)
    size_ok = F.coalesce(F.col("tick_size") > 0, F.lit(False)) & finite("tick_size")
    ok = F.when(F.col("route") == SYMBOL, size_ok).otherwise(quote_ok)
    used = F.col("route").isin(BOOK_TICKER, SYMBOL) & F.col("symbol").isNotNull() & ok
    return rows.withColumn("used", F.coalesce(used, F.lit(False)))


def depth_levels(depth: DataFrame) -> DataFrame:
    """One row per order book level."""
    sides = F.array(
        *[F.struct(F.lit(s).alias("side"), F.col(c).alias("levels")) for s, c in (("bid", "bids"), ("ask", "asks"))]
    )
    by_side = depth.select("symbol", "lastUpdateID", F.inline(sides))
    levels = by_side.select("symbol", "lastUpdateID", "side", F.posexplode("levels").alias("level", "pq"))
    return levels.select(
        "symbol",
        F.col("lastUpdateID").alias("update_id"),
        "side",
        "level",
        F.col("pq")[0].alias("price"),
        F.col("pq")[1].alias("qty"),
    )


def status_message(volatility: str = "volatility") -> Column:
    """The outgoing JSON; ``volatility`` is left out unless the status is ``ok``."""
    vol = F.when(F.col("status") == "ok", F.col(volatility))
    return F.to_json(F.struct("timestamp", "symbol", "status", vol.alias("volatility")))


def status_of(warm: Column, has_model: Column) -> Column:
    return F.when(~warm, "warmup").when(~has_model, "no_model").otherwise("ok")
