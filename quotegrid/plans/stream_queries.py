"""Queries of the event feed and its live features."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotegrid.functions.time import day_of_ns
from quotegrid.operators.registry import current_models, latest_models
from quotegrid.plans.catalog import query
from quotegrid.plans.grid_queries import COARSE, LIVE_SQL, LIVE_WARMUP_MINUTES, STEP_S, VOLS_SQL, live, nan_to_null
from quotegrid.plans.table_queries import LOOKBACK_DAYS
from quotegrid.session import scratch_path
from quotegrid.sources import testdata as td
from quotegrid.streaming.events import depth_levels, parse, read_event_files, route, status_message, status_of, tag_messages
from quotegrid.streaming.live import live_features, use_rocksdb
from quotegrid.streaming.scoring import score_and_send
from quotegrid.streaming.sinks import CommitLog, folder_sink, sent_once

DELAY_MS = 1000


@query(
    "event_router",
    """SELECT event_id, CASE event_id % 20 WHEN 0 THEN 'symbol' WHEN 1 THEN 'trade' WHEN 2 THEN 'bad' WHEN 4 THEN 'depth'
     WHEN 5 THEN 'unknown' ELSE 'bookTicker' END AS route,
     CASE WHEN event_id % 20 NOT IN (1, 2, 4, 5) THEN event_type END AS symbol,
     CASE WHEN event_id % 20 NOT IN (0, 1, 2, 4, 5) THEN event_id END AS update_id,
     CASE WHEN event_id % 20 NOT IN (0, 1, 2, 4, 5) THEN CAST(value AS DOUBLE) END AS bid_price,
     CASE WHEN event_id % 20 = 0 THEN 0.01::DOUBLE END AS tick_size FROM events""",
)
def event_router(spark, sf):
    """Every message with its route; fields only for the two routes the live features use."""
    tagged = tag_messages(td.event_messages(spark, sf), keep=("event_id",))
    fields = [F.when(F.col("used"), F.col(c)).alias(c) for c in ("symbol", "update_id", "bid_price", "tick_size")]
    return tagged.select("event_id", "route", *fields)


@query(
    "depth_levels",
    """WITH d AS (SELECT event_id, event_type AS symbol, unnest(range(event_id % 3 + 1)) AS level, CAST(value AS DOUBLE) AS bid,
      round(value + 0.01*(1 + event_id % 3), 2) AS ask, 1 + event_id % 50 AS bq, 1 + event_id % 40 AS aq FROM events WHERE event_id % 20 = 4)
    SELECT symbol, event_id AS update_id, 'bid' AS side, level, round(bid - level*0.01, 2) AS price, CAST(bq + level AS DOUBLE) AS qty FROM d
    UNION ALL SELECT symbol, event_id, 'ask', level, round(ask + level*0.01, 2), CAST(aq + level AS DOUBLE) FROM d""",
)
def depth_levels_query(spark, sf):
    return depth_levels(parse(route(td.event_messages(spark, sf)), "depth"))


@query(
    "status_json",
    f"""WITH {LIVE_SQL}, rg AS (SELECT DISTINCT event_type AS symbol, CAST(ts AS DATE) AS model_date FROM events
      WHERE day(CAST(ts AS DATE)) % 3 = 0 AND event_type <> 'error'),
    st AS (SELECT symbol, t, CAST(round(vol_60m, 6) AS DECIMAL(18,6)) AS vol, CASE WHEN NOT warm THEN 'warmup' WHEN EXISTS (SELECT 1 FROM rg WHERE rg.symbol = live.symbol
      AND model_date <= CAST(make_timestamp(t//1000) AS DATE) AND model_date > CAST(make_timestamp(t//1000) AS DATE) - {LOOKBACK_DAYS})
      THEN 'ok' ELSE 'no_model' END AS status FROM live)
    SELECT symbol, t AS "timestamp", status, '{{"timestamp":' || t || ',"symbol":"' || symbol || '","status":"' || status || '"' ||
      CASE WHEN status = 'ok' THEN ',"volatility":' || vol ELSE '' END || '}}' AS message FROM st""",
)
def status_json(spark, sf):
    """What would be sent per instant, with the volatility of now as the forecast."""
    rows = live(spark, sf).withColumn("date", day_of_ns(F.col("timestamp"), COARSE.grid))
    days = rows.select("symbol", "date").distinct()
    models = latest_models(days, current_models(td.registry(spark, sf)), LOOKBACK_DAYS)
    joined = rows.join(models, ["symbol", "date"], "left")
    joined = joined.withColumn("status", status_of(F.col("warm"), F.col("model_date").isNotNull()))
    vol = F.when(~F.isnan("vol_60m"), F.round("vol_60m", 6)).cast("decimal(18,6)")
    joined = joined.withColumn("volatility", vol)
    return joined.select("symbol", "timestamp", "status", status_message().alias("message"))


@query(
    "stream_vs_batch_asof",
    f"""WITH {LIVE_SQL}, wm AS (SELECT (max(local_ts_ns)//1000000 - {DELAY_MS})*1000000 AS until FROM v)
    SELECT symbol, t AS "timestamp", samples, warm, mid_tick, {VOLS_SQL} FROM live, wm WHERE t < until""",
)
def stream_vs_batch_asof(spark, sf):
    """The live stream run over files of messages; its SQL is the batch form up to the last watermark."""
    rows = streamed(spark, td.quote_messages(spark, sf))
    return nan_to_null(rows.select("symbol", "timestamp", "samples", "warm", "mid_tick", *COARSE.vol_columns), COARSE.vol_columns)


def message_stream(spark, messages):
    """Live features of messages (``us``, ``value``) that are written to files in order of time."""
    folder = scratch_path(spark, "messages")
    messages.repartitionByRange(4, "us").sortWithinPartitions("us").select("value").write.text(folder)
    use_rocksdb(spark)
    return live_features(read_event_files(spark, folder), COARSE, LIVE_WARMUP_MINUTES, delay=f"{DELAY_MS} milliseconds")


def streamed(spark, messages):
    """The rows of that stream."""
    out, state = (scratch_path(spark, n) for n in ("live", "state"))
    writer = message_stream(spark, messages).writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@query(
    "live_tick_size",
    f"""WITH {LIVE_SQL}, wm AS (SELECT (max(local_ts_ns)//1000000 - {DELAY_MS})*1000000 AS until FROM v)
    SELECT g.symbol, g.c*{STEP_S}000000000 AS "timestamp", g.c - g.c0 + 1 AS samples,
      round((ask_price + bid_price)/2/(CASE WHEN day(CAST(make_timestamp(g.c*{STEP_S}000000) AS DATE)) % 2 = 0 THEN 0.01 ELSE 0.005 END), 1) AS mid_tick
    FROM g ASOF JOIN v ON g.symbol = v.symbol AND g.c*{STEP_S}000000000 >= v.local_ts_ns, wm WHERE g.c*{STEP_S}000000000 < until""",
)
def live_tick_size(spark, sf):
    """Live mid prices in ticks while the feed changes each symbol's tick size at midnight."""
    days = td.symbol_days(spark, sf).select("symbol", "date").distinct()
    us = F.unix_date("date").cast("bigint") * 86_400_000_000
    size = F.when(F.day("date") % 2 == 0, 0.01).otherwise(0.005)
    told = F.struct(F.lit("symbol").alias("Event"), F.col("symbol").alias("Symbol"), size.alias("TickSize"), us.alias("updateTime"))
    rows = streamed(spark, td.quote_messages(spark, sf).unionByName(days.select(us.alias("us"), F.to_json(told).alias("value"))))
    return rows.select("symbol", "timestamp", "samples", "mid_tick")


@query(
    "pushed_messages",
    f"""WITH {LIVE_SQL}, wm AS (SELECT (max(local_ts_ns)//1000000 - {DELAY_MS})*1000000 AS until FROM v)
    SELECT symbol, CAST(make_timestamp(t//1000) AS DATE) AS date, CASE WHEN warm THEN 'no_model' ELSE 'warmup' END AS status,
      count(*) AS messages, count(DISTINCT t) AS instants FROM live, wm WHERE t < until GROUP BY ALL""",
)
def pushed_messages(spark, sf):
    """The live job's messages as its sink got them. The stream is run twice over the same feed; no batch is sent twice."""
    out, log = scratch_path(spark, "pushed"), CommitLog(spark, scratch_path(spark, "pushed-log"))
    registry = td.registry(spark, sf)  # names models that no store has
    body = score_and_send(lambda: registry, sent_once(folder_sink(out), log), COARSE.feature_columns, LOOKBACK_DAYS, COARSE.grid)
    stream = message_stream(spark, td.quote_messages(spark, sf))
    for _ in range(2):
        writer = stream.writeStream.foreachBatch(body).option("checkpointLocation", scratch_path(spark, "state"))
        writer.trigger(availableNow=True).start().awaitTermination()
    sent = spark.read.text(out).select(F.from_json("value", "timestamp bigint, symbol string, status string").alias("m")).select("m.*")
    return sent.groupBy("symbol", day_of_ns(F.col("timestamp"), COARSE.grid).alias("date"), "status").agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct("timestamp").alias("instants")
    )
