"""Queries of sources, sinks, calendars, ledgers, audits and the model registry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from quotegrid.config import GridConfig, TrainConfig
from quotegrid.functions.epochs import epoch_to_micros, exchange_name
from quotegrid.operators import ledger as lg
from quotegrid.operators import quality as qa
from quotegrid.operators import registry as rg
from quotegrid.operators import splits as sp
from quotegrid.operators.asof import sessions_of
from quotegrid.operators.updates import accepted_updates, latest_by_update_id
from quotegrid.plans.catalog import QUOTES_SQL, query
from quotegrid.plans.grid_queries import ASSETS_SQL, COARSE, COARSE_SQL, KEPT_SQL, features
from quotegrid.plans.jobs import Store, build_features, run_walk_forward
from quotegrid.session import materialize, scratch_path, small_side
from quotegrid.sources import testdata as td
from quotegrid.sources.assets import join_tick_size, parse_assets, unknown_symbols
from quotegrid.sources.quotes import (
    QuoteTable,
    missing_partitions,
    read_partition,
    read_quote_files,
    resolve_sources,
    serve_feature_days,
    source_priority,
    with_day,
    write_by_symbol_day,
    write_quote_csv,
)
from quotegrid.sources.rawdays import BackfilledQuotes, RawDays, dated_quotes
from quotegrid.sources.vendor import vendor_day_scan, vendor_to_quotes

UTC_DAYS = GridConfig()
INGEST_TIME_US = 1_706_745_600_000_000
INGEST_TIME = datetime(2024, 2, 1)
TRAIN_DAYS, VAL_DAYS, TEST_DAYS = 7, 1, 2
LOOKBACK_DAYS = 2

DAYS_SQL = "sd AS (SELECT DISTINCT event_type AS symbol, CAST(ts AS DATE) AS date FROM events)"
CALENDAR_SQL = """sd AS (SELECT DISTINCT event_type AS symbol, CAST(ts AS DATE) AS date FROM events),
b AS (SELECT min(date) AS first_day, max(date) AS last_day FROM sd),
spans AS (SELECT DISTINCT symbol, first_day, last_day FROM sd, b),
cal AS (SELECT symbol, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS date FROM spans)"""
SPANS_SQL = f"""{DAYS_SQL}, b AS (SELECT min(date) AS first_day, max(date) AS last_day FROM sd),
spans AS (SELECT DISTINCT symbol, first_day, last_day FROM sd, b),
cal AS (SELECT symbol, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS date FROM spans)"""
PRIMARY_SQL = "day(date) % 5 <> 0"
FALLBACK_SQL = "day(date) % 10 <> 0 AND day(date) % 7 <> 0"
PARTITIONS_SQL = f"""pt AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS date,
  CASE WHEN day(CAST(ts AS DATE)) = 9 THEN 0 ELSE count(*) END AS rows FROM events WHERE day(CAST(ts AS DATE)) <> 4 GROUP BY 1, CAST(ts AS DATE))"""


# --- sources and sinks ----------------------------------------------------------------


@query(
    "quote_scan",
    f"""WITH {QUOTES_SQL} SELECT symbol, date, count(*) AS rows, min(ts_ns) AS first_ns, max(local_ts_ns) AS last_ns,
     round(sum(ask_price), 2) AS ask_sum, round(sum(bid_amount), 2) AS bid_amount_sum FROM q GROUP BY ALL""",
)
def quote_scan(spark, sf):
    path = scratch_path(spark, "quote-csv")
    write_quote_csv(td.quotes(spark, sf), path)
    q = with_day(read_quote_files(spark, path), UTC_DAYS)
    return q.groupBy("symbol", "date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("ts_ns").alias("first_ns"),
        F.max("local_ts_ns").alias("last_ns"),
        F.round(F.sum("ask_price"), 2).alias("ask_sum"),
        F.round(F.sum("bid_amount"), 2).alias("bid_amount_sum"),
    )


@query(
    "quote_sink_roundtrip",
    f"""WITH {QUOTES_SQL} SELECT symbol, date, ts_ns, local_ts_ns, update_id, bid_price, ask_price, bid_amount, ask_amount FROM q""",
)
def quote_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "quotes")
    q = with_day(td.quotes(spark, sf), UTC_DAYS)
    write_by_symbol_day(q, path, "local_ts_ns")
    back = read_partition(spark, path, q.schema)
    return back.drop("exchange")


@query(
    "source_priority",
    f"""WITH {DAYS_SQL}, m AS (
      SELECT symbol, date, 0 AS priority, 'primary' AS r, '.csv.zst' AS e FROM sd WHERE {PRIMARY_SQL} AND day(date) % 3 <> 0 UNION ALL
      SELECT symbol, date, 1, 'primary', '.csv.gz' FROM sd WHERE {PRIMARY_SQL} UNION ALL
      SELECT symbol, date, 3, 'fallback', '.csv.gz' FROM sd WHERE {FALLBACK_SQL})
    SELECT symbol, date, min(priority) AS priority,
      '/' || arg_min(r, priority) || '/binance-futures_book_ticker_' || strftime(date, '%Y-%m-%d') || '_' || symbol || arg_min(e, priority) AS path
    FROM m GROUP BY symbol, date""",
)
def source_priority_query(spark, sf):
    m = td.manifest(spark, sf)
    return resolve_sources(m.withColumn("priority", source_priority(F.col("root"), F.col("ext"))))


@query(
    "missing_partitions",
    f"WITH {SPANS_SQL} SELECT symbol, date FROM cal WHERE NOT ({PRIMARY_SQL}) AND NOT ({FALLBACK_SQL})",
)
def missing_partitions_query(spark, sf):
    required = sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day")
    return missing_partitions(required, td.manifest(spark, sf))


@query(
    "prev_day_union",
    f"""WITH {QUOTES_SQL}, u AS (SELECT *, date AS feature_date FROM q UNION ALL SELECT *, date + 1 FROM q)
    SELECT symbol, feature_date, date, update_id, ts_ns, local_ts_ns FROM u JOIN (SELECT symbol, date AS fd FROM days
      WHERE (symbol, date - 1) IN (SELECT (symbol, date) FROM days)) w USING (symbol) WHERE w.fd = u.feature_date""",
)
def prev_day_union(spark, sf):
    q = td.quotes(spark, sf)
    served = serve_feature_days(q, UTC_DAYS).join(sessions_of(q, UTC_DAYS), ["symbol", "feature_date"], "left_semi")
    return served.select("symbol", "feature_date", "date", "update_id", "ts_ns", "local_ts_ns")


@query(
    "vendor_day_scan",
    """SELECT event_type AS symbol, CAST(ts AS DATE) AS date, event_id AS "updateId" FROM events WHERE event_id % 17 <> 0""",
)
def vendor_day_scan_query(spark, sf):
    return vendor_day_scan(td.vendor_rows(spark, sf)).select("symbol", "date", "updateId")


@query(
    "epoch_to_micros",
    """SELECT event_id AS "updateId", CASE WHEN event_id % 29 <> 0 THEN epoch_us(ts) END AS micros FROM events""",
)
def epoch_to_micros_query(spark, sf):
    return td.vendor_rows(spark, sf).select("updateId", epoch_to_micros(F.col("eventTimeUnix")).alias("micros"))


VENDOR_SQL = f"""vq AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'binance-futures' WHEN event_id % 3 = 1 THEN 'unknown' ELSE '7' END AS exchange,
  event_type AS symbol, epoch_us(ts)*1000 AS ts_ns, CASE WHEN event_id % 17 = 0 THEN {INGEST_TIME_US} ELSE epoch_us(ts) END * 1000 AS local_ts_ns,
  event_id AS update_id, CAST(1 + event_id % 40 AS DOUBLE) AS ask_amount,
  CASE WHEN event_id % 23 <> 0 THEN round(value + 0.01*(1 + event_id % 3), 2) END AS ask_price, CAST(value AS DOUBLE) AS bid_price,
  CAST(NULL AS DOUBLE) AS bid_amount, CAST(ts AS DATE) AS date FROM events WHERE event_id % 29 <> 0)"""


@query("vendor_to_quote", f"WITH {VENDOR_SQL} SELECT * EXCLUDE (date) FROM vq")
def vendor_to_quote(spark, sf):
    out = vendor_to_quotes(td.vendor_rows(spark, sf), INGEST_TIME_US)
    return out.withColumn("bid_amount", F.when(~F.isnan("bid_amount"), F.col("bid_amount")))


@query(
    "exchange_map",
    """SELECT event_id % 3 AS code_kind, CASE WHEN event_id % 3 = 0 THEN 'binance-futures' WHEN event_id % 3 = 1 THEN 'unknown' ELSE '7' END AS by_code,
     'other' AS by_override, 'binance-futures' AS by_default, count(*) AS rows FROM events GROUP BY ALL""",
)
def exchange_map(spark, sf):
    v = td.vendor_rows(spark, sf).select(
        (F.col("updateId") % 3).alias("code_kind"),
        exchange_name(F.col("exchange")).alias("by_code"),
        exchange_name(F.col("exchange"), "other").alias("by_override"),
        exchange_name(None).alias("by_default"),
    )
    return v.groupBy("code_kind", "by_code", "by_override", "by_default").agg(F.count(F.lit(1)).alias("rows"))


RAW_TASKS_SQL = f"""{SPANS_SQL}, resolved AS (SELECT symbol, date FROM cal WHERE ({PRIMARY_SQL}) OR ({FALLBACK_SQL}))"""


@query(
    "raw_backfill",
    f"""WITH {RAW_TASKS_SQL}, {VENDOR_SQL.replace("FROM events WHERE", "FROM events WHERE event_id % 17 <> 0 AND")}
    SELECT symbol, date, 'vendor' AS source, count(*) AS rows FROM vq
    WHERE (symbol, date) IN (SELECT (symbol, date) FROM cal) AND (symbol, date) NOT IN (SELECT (symbol, date) FROM resolved) GROUP BY ALL
    UNION ALL SELECT event_type, CAST(ts AS DATE), 'files', count(*) FROM events
    WHERE (event_type, CAST(ts AS DATE)) IN (SELECT (symbol, date) FROM resolved) GROUP BY ALL""",
)
def raw_backfill(spark, sf):
    """Days without a file are fetched, committed and read back; files serve the others."""
    required = sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day").select("symbol", "date")
    present = td.manifest(spark, sf).select("symbol", "date").distinct()
    files = with_day(td.quotes(spark, sf), UTC_DAYS).join(present, ["symbol", "date"], "left_semi")
    vendor = vendor_day_scan(td.vendor_rows(spark, sf))
    source = BackfilledQuotes(
        QuoteTable(files, UTC_DAYS, present),
        RawDays(scratch_path(spark, "raw-days")),
        lambda _, days: dated_quotes(vendor, INGEST_TIME),
        INGEST_TIME,
    )
    raw, _ = source.for_days(required)
    return raw.groupBy("symbol", "date", "source").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "asset_dim",
    f"""WITH {ASSETS_SQL} SELECT event_type AS symbol, 'future' AS instrument_type, any_value(tick_size) AS tick_size, any_value(lot_size) AS lot_size,
    bool_and(tick_size IS NOT NULL) AS known, count(*) AS quotes FROM events LEFT JOIN assets ON symbol = event_type GROUP BY ALL""",
)
def asset_dim(spark, sf):
    dim = parse_assets(td.asset_documents(spark, sf))
    traded = td.quotes(spark, sf).groupBy("symbol").agg(F.count(F.lit(1)).alias("quotes"))
    unknown = unknown_symbols(traded, dim).withColumn("known", F.lit(False))
    joined = traded.join(dim, "symbol", "left").join(unknown, "symbol", "left")
    return joined.select(
        "symbol",
        F.coalesce("instrument_type", F.lit("future")).alias("instrument_type"),
        "tick_size",
        "lot_size",
        F.coalesce("known", F.lit(True)).alias("known"),
        "quotes",
    )


@query(
    "tick_size_join",
    f"""WITH {QUOTES_SQL}, {ASSETS_SQL} SELECT symbol, update_id, tick_size, lot_size,
     round(bid_amount/lot_size, 6) AS bid_lots FROM q JOIN assets USING (symbol)""",
)
def tick_size_join(spark, sf):
    q = join_tick_size(td.quotes(spark, sf), td.with_assets(spark, sf))
    lots = F.round(F.col("bid_amount") / F.col("lot_size"), 6)
    return q.select("symbol", "update_id", "tick_size", "lot_size", lots.alias("bid_lots"))


def feature_table(spark, sf) -> str:
    path = scratch_path(spark, "features")
    f = features(spark, sf).withColumnRenamed("feature_date", "date")
    write_by_symbol_day(f, path, "timestamp")
    return path


@query(
    "feature_sink_roundtrip",
    f"""WITH {COARSE_SQL} SELECT symbol, feature_date AS date, t AS "timestamp", vol_120m, y_vol_30m FROM f WHERE {KEPT_SQL}""",
)
def feature_sink_roundtrip(spark, sf):
    back = read_partition(spark, feature_table(spark, sf))
    keep = back.select("symbol", "date", "timestamp", "vol_120m", "y_vol_30m")
    return keep.withColumn("vol_120m", F.when(~F.isnan("vol_120m"), F.col("vol_120m")))


@query(
    "feature_partition_read",
    f"""WITH {COARSE_SQL}, sp AS (SELECT symbol, min(date) AS a, max(date) AS b FROM days GROUP BY symbol),
    want AS (SELECT symbol, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM sp),
    have AS (SELECT symbol, feature_date AS date, count(*) AS rows, round(sum(y_vol_30m), 4) AS label_sum FROM f WHERE {KEPT_SQL} GROUP BY ALL)
    SELECT symbol, date, rows, label_sum, rows IS NULL AS absent FROM want LEFT JOIN have USING (symbol, date)""",
)
def feature_partition_read(spark, sf):
    """Asked symbol-days read from the feature table; those without a partition are absent."""
    back = read_partition(spark, feature_table(spark, sf))
    got = back.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("y_vol_30m"), 4).alias("label_sum"))
    want = sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day")
    return want.join(got, ["symbol", "date"], "left").withColumn("absent", F.col("rows").isNull())


# --- calendars and splits -------------------------------------------------------------


@query("calendar", f"WITH {SPANS_SQL} SELECT symbol, date FROM cal")
def calendar(spark, sf):
    return sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day")


REQUIRED_SQL = f"""{SPANS_SQL}, req AS (SELECT symbol, date AS reference_date,
  CAST(unnest(generate_series(date - {TRAIN_DAYS + VAL_DAYS}, date - 1, INTERVAL 1 DAY)) AS DATE) AS feature_date FROM cal)"""


def required(spark, sf):
    """The feature days every calendar day's retraining needs."""
    refs = sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day").withColumnRenamed("date", "reference_date")
    return sp.required_feature_dates(refs, TRAIN_DAYS, VAL_DAYS)


@query("required_feature_dates", f"WITH {REQUIRED_SQL} SELECT symbol, reference_date, feature_date FROM req")
def required_feature_dates(spark, sf):
    return required(spark, sf)


@query(
    "required_raw_dates",
    f"WITH {REQUIRED_SQL} SELECT DISTINCT symbol, feature_date - o AS date FROM req, (VALUES (0), (1)) t(o)",
)
def required_raw_dates(spark, sf):
    return sp.required_raw_dates(required(spark, sf), use_prev_day=True)


@query(
    "production_split",
    f"""WITH {SPANS_SQL} SELECT symbol, date AS target_date, CASE WHEN o < {VAL_DAYS} THEN 'val' ELSE 'train' END AS role, date - CAST(o AS INTEGER) AS date
    FROM cal, range({TRAIN_DAYS + VAL_DAYS}) r(o)""",
)
def production_split(spark, sf):
    targets = sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day").withColumnRenamed("date", "target_date")
    return sp.production_split(targets, TRAIN_DAYS, VAL_DAYS)


WINDOWS_SQL = f"""{SPANS_SQL},
tests AS (SELECT symbol, date, date_diff('day', first_day, date) AS o, last_day FROM cal JOIN spans USING (symbol)),
w AS (SELECT symbol, CAST(o // {TEST_DAYS} AS INTEGER) AS window_id, min(date) AS t0, max(date) AS t1 FROM tests GROUP BY ALL),
r AS (SELECT symbol, window_id, 'test' AS role, unnest(generate_series(t0, t1, INTERVAL 1 DAY)) AS date FROM w UNION ALL
      SELECT symbol, window_id, 'val', unnest(generate_series(t0 - {VAL_DAYS}, t0 - 1, INTERVAL 1 DAY)) FROM w UNION ALL
      SELECT symbol, window_id, 'train', unnest(generate_series(t0 - {VAL_DAYS + TRAIN_DAYS}, t0 - {VAL_DAYS + 1}, INTERVAL 1 DAY)) FROM w),
rd AS (SELECT symbol, window_id, role, CAST(date AS DATE) AS date FROM r),
fd AS (SELECT symbol, date FROM sd x WHERE EXISTS (SELECT 1 FROM sd y WHERE y.symbol = x.symbol AND y.date = x.date - 1)),
good AS (SELECT rd.symbol, window_id FROM rd LEFT JOIN fd ON rd.symbol = fd.symbol AND rd.date = fd.date
  GROUP BY rd.symbol, window_id HAVING count(*) = count(fd.date)),
ws AS (SELECT rd.* FROM rd JOIN good USING (symbol, window_id))"""


def windows(spark, sf):
    splits = sp.walk_forward_splits(td.symbol_spans(spark, sf), TRAIN_DAYS, VAL_DAYS, TEST_DAYS)
    present = sessions_of(td.quotes(spark, sf), COARSE.grid).withColumnRenamed("feature_date", "date")
    return sp.complete_windows(splits, present)


@query(
    "walk_forward_splits",
    f"WITH {WINDOWS_SQL} SELECT symbol, window_id, role, date FROM ws",
)
def walk_forward_splits(spark, sf):
    return windows(spark, sf)


@query(
    "train_split",
    f"""WITH {COARSE_SQL}, fc AS (SELECT symbol, feature_date AS date, count(*) AS n FROM f WHERE {KEPT_SQL} GROUP BY ALL),
    {WINDOWS_SQL}
    SELECT symbol, window_id, role, count(*) AS days, CAST(sum(n) AS BIGINT) AS rows FROM ws JOIN fc USING (symbol, date) GROUP BY ALL""",
)
def train_split(spark, sf):
    """Labelled rows per window and role; features are counted per day before they meet the windows."""
    labelled = features(spark, sf).where(F.col("y_vol_30m").isNotNull())
    per_day = labelled.groupBy("symbol", F.col("feature_date").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    joined = windows(spark, sf).join(per_day, ["symbol", "date"])
    return joined.groupBy("symbol", "window_id", "role").agg(F.count(F.lit(1)).alias("days"), F.sum("n").alias("rows"))


# --- audits ---------------------------------------------------------------------------


@query(
    "partition_row_counts",
    f"WITH {QUOTES_SQL} SELECT symbol, date, count(*) AS rows, min(local_ts_ns) AS first_ns, max(local_ts_ns) AS last_ns FROM q GROUP BY ALL",
)
def partition_row_counts(spark, sf):
    return qa.partition_stats(with_day(td.quotes(spark, sf), UTC_DAYS), "local_ts_ns")


@query(
    "verify_partitions",
    f"WITH {SPANS_SQL}, {PARTITIONS_SQL} SELECT symbol, date, CASE WHEN rows > 0 THEN rows ELSE -1 END AS rows FROM cal LEFT JOIN pt USING (symbol, date)",
)
def verify_partitions(spark, sf):
    expected = sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day")
    return qa.verify_partitions(expected, td.partitions(spark, sf))


@query(
    "completeness",
    f"""WITH {SPANS_SQL}, c AS (SELECT symbol, count(*) AS total, count(*) FILTER ({PRIMARY_SQL} OR ({FALLBACK_SQL})) AS present FROM cal GROUP BY symbol)
    SELECT symbol, total, present, total - present AS missing, printf('%.1f%%', present*100.0/total) AS percent FROM c""",
)
def completeness(spark, sf):
    expected = sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day")
    return qa.completeness(expected, td.manifest(spark, sf))


@query(
    "missing_ranges",
    f"""WITH {SPANS_SQL}, m AS (SELECT symbol, date FROM cal WHERE day(date) % 7 = 0 OR day(date) % 5 = 0 OR day(date) % 8 = 0),
    i AS (SELECT *, date - CAST(row_number() OVER (PARTITION BY symbol ORDER BY date) AS INTEGER) AS isl FROM m)
    SELECT symbol, min(date) AS range_start, max(date) AS range_end, count(*) AS days FROM i GROUP BY symbol, isl""",
)
def missing_ranges(spark, sf):
    expected = sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day")
    d = F.day("date")
    return qa.missing_ranges(expected, td.symbol_days(spark, sf).where((d % 7 != 0) & (d % 5 != 0) & (d % 8 != 0)))


def arrivals(spark, sf):
    """Quotes numbered by arrival, locally out of order, with some times repeated."""
    uid = F.col("update_id")
    q = td.quotes(spark, sf).withColumn("arrival", (uid + (uid * 7919) % 13) * 100 + uid % 100)
    step = F.when(F.col("symbol") == "view", F.lit(1)).otherwise(F.lit(1_000_000_000)).cast("bigint")
    return q.withColumn("seen_ns", F.col("local_ts_ns") - F.pmod("local_ts_ns", step))


ARRIVALS_SQL = f"""{QUOTES_SQL}, ar AS (SELECT *, (update_id + (update_id*7919) % 13)*100 + update_id % 100 AS arrival,
  local_ts_ns - local_ts_ns % (CASE WHEN symbol = 'view' THEN 1 ELSE 1000000000 END) AS seen_ns FROM q)"""


@query(
    "dup_monotonic_check",
    f"""WITH {ARRIVALS_SQL}, l AS (SELECT *, seen_ns < lag(seen_ns) OVER (PARTITION BY symbol ORDER BY arrival) AS falls FROM ar)
    SELECT symbol, count(*) AS rows, count(*) > count(DISTINCT seen_ns) AS has_duplicates, NOT bool_or(coalesce(falls, false)) AS is_monotonic
    FROM l GROUP BY symbol""",
)
def dup_monotonic_check(spark, sf):
    return qa.duplicates_and_order(arrivals(spark, sf), "arrival", "seen_ns", chunk=100_000)


@query(
    "audit_by_file",
    f"""WITH {ARRIVALS_SQL}, l AS (SELECT *, seen_ns < lag(seen_ns) OVER (PARTITION BY symbol ORDER BY arrival) AS falls FROM ar)
    SELECT symbol, count(*) AS rows, count(*) > count(DISTINCT seen_ns) AS has_duplicates, NOT bool_or(coalesce(falls, false)) AS is_monotonic
    FROM l GROUP BY symbol""",
)
def audit_by_file(spark, sf):
    """The same verdict from one summary per symbol-day; only days that run into each other are read again."""
    rows = materialize(arrivals(spark, sf).select("symbol", "arrival", "seen_ns", F.to_date(F.timestamp_micros(F.expr("local_ts_ns div 1000"))).alias("file")), "arrivals")
    audits = qa.audit_files(rows, "arrival", "seen_ns", "file", chunk=100_000)
    again = lambda files: rows.join(small_side(files), ["symbol", "file"], "left_semi")
    return qa.merge_audits(audits, again, "arrival", "seen_ns", chunk=100_000)


@query(
    "build_outcomes",
    f"""WITH {COARSE_SQL}, {CALENDAR_SQL},
    fc AS (SELECT symbol, feature_date AS date, count(*) AS n FROM f WHERE {KEPT_SQL} AND symbol <> 'error' GROUP BY ALL)
    SELECT symbol, date, CASE WHEN n IS NULL THEN 'failed' ELSE 'built' END AS outcome, n AS rows FROM cal LEFT JOIN fc USING (symbol, date)""",
)
def build_outcomes(spark, sf):
    """A feature build of every calendar day: what was built and recorded, and what failed."""
    store = Store(scratch_path(spark, "outcomes"))
    tasks = sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day").select("symbol", "date")
    quotes = td.quotes(spark, sf)
    sizes = quotes.select("symbol").distinct().where("symbol <> 'error'").withColumn("tick_size", F.lit(0.01))
    failed = build_features(quotes, tasks, sizes, COARSE, store, INGEST_TIME)
    built = store.ledger(spark, "feature_ledger").select("symbol", "date", F.lit("built").alias("outcome"), "rows")
    lost = failed.select("symbol", F.col("feature_date").alias("date"), F.lit("failed").alias("outcome"))
    return built.unionByName(lost, allowMissingColumns=True)


@query(
    "window_failures",
    f"""WITH {WINDOWS_SQL}, lost AS (SELECT DISTINCT rd.symbol, rd.window_id, rd.date FROM rd LEFT JOIN fd ON rd.symbol = fd.symbol AND rd.date = fd.date
      WHERE fd.date IS NULL OR day(rd.date) % 5 = 0)
    SELECT symbol, window_id::BIGINT AS window_id, 'missing feature days: ' || string_agg(date::VARCHAR, ', ' ORDER BY date) AS why FROM lost GROUP BY ALL""",
)
def window_failures(spark, sf):
    """A walk-forward run over a feature table with gaps, so wide that every window has one."""
    store = Store(scratch_path(spark, "gaps"))
    stored = sessions_of(td.quotes(spark, sf), COARSE.grid).withColumnRenamed("feature_date", "date").where(F.day("date") % 5 != 0)
    rows = stored.select("symbol", "date", F.lit(0).cast("bigint").alias("timestamp"))
    write_by_symbol_day(rows, store.path("features"), "timestamp")
    cfg = TrainConfig(train_days=TRAIN_DAYS, val_days=VAL_DAYS, test_days=TEST_DAYS)
    failures = run_walk_forward(td.symbol_spans(spark, sf), COARSE.feature_columns, COARSE.label_column, cfg, store, INGEST_TIME)
    listed = [(*key.rsplit("/", 1), why) for key, why in failures.items()]
    found = spark.createDataFrame(listed, "symbol string, window_id string, why string")
    return found.select("symbol", F.col("window_id").cast("bigint").alias("window_id"), "why")


@query(
    "latest_by_update_id",
    f"""WITH {QUOTES_SQL} SELECT symbol, max(update_id) AS update_id, arg_max(bid_price, update_id) AS bid_price,
    arg_max(ask_price, update_id) AS ask_price, arg_max(local_ts_ns, update_id) AS local_ts_ns FROM q GROUP BY symbol""",
)
def latest_by_update_id_query(spark, sf):
    return latest_by_update_id(td.quotes(spark, sf), ["bid_price", "ask_price", "local_ts_ns"])


@query(
    "accepted_updates",
    f"""WITH {ARRIVALS_SQL}, b AS (SELECT *, max(update_id) OVER (PARTITION BY symbol ORDER BY arrival
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bar FROM ar)
    SELECT symbol, arrival, update_id, bid_price, ask_price FROM b WHERE bar IS NULL OR update_id > bar""",
)
def accepted_updates_query(spark, sf):
    out = accepted_updates(arrivals(spark, sf), "arrival", chunk=100_000)
    return out.select("symbol", "arrival", "update_id", "bid_price", "ask_price")


# --- ledgers, failures, registry, status ----------------------------------------------


@query(
    "pending_tasks",
    f"""WITH {SPANS_SQL}, {PARTITIONS_SQL} SELECT symbol, date, CASE WHEN day(date) <= 12 AND rows >= 1 THEN 'done'
     WHEN day(date) > 12 AND rows > 0 THEN 'verify' ELSE 'build' END AS action FROM cal LEFT JOIN pt USING (symbol, date)""",
)
def pending_tasks(spark, sf):
    tasks = sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day")
    return lg.classify_tasks(tasks, td.ledger(spark, sf), td.partitions(spark, sf))


@query("ledger_append", f"WITH {PARTITIONS_SQL} SELECT symbol, date, rows, TIMESTAMP '2024-02-02 03:04:05' AS verified_at FROM pt WHERE rows > 0 AND (day(date) > 12 OR rows <> 1)")
def ledger_append(spark, sf):
    """New ledger rows, and those whose count (recorded as 1) is another, are appended to the stored ledger and read back."""
    path = scratch_path(spark, "ledger")
    old = td.ledger(spark, sf)
    old.write.parquet(path)
    at = F.lit("2024-02-02 03:04:05")
    lg.append_ledger(lg.read_ledger(spark, path), td.partitions(spark, sf), at).write.mode("append").parquet(path)
    out = lg.read_ledger(spark, path).where(F.col("verified_at") == at.cast("timestamp"))
    return out.withColumn("verified_at", F.col("verified_at").cast("timestamp_ntz"))


FAILED_SQL = f"""{REQUIRED_SQL}, tk AS (SELECT DISTINCT symbol, feature_date FROM req WHERE feature_date > (SELECT first_day FROM b)),
av AS (SELECT symbol, date FROM sd WHERE NOT (length(symbol) = 5 AND day(date) = 11)),
need AS (SELECT symbol, feature_date, feature_date - o AS date FROM tk, (VALUES (0), (1)) t(o)),
fl AS (SELECT symbol, count(DISTINCT feature_date) AS failed_dates FROM need WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM av) GROUP BY symbol)"""


def failures(spark, sf):
    """Raw day 11 is lost for the symbols of five letters."""
    spans = td.symbol_spans(spark, sf).select("symbol", "first_day")
    tasks = required(spark, sf).join(spans, "symbol").where("feature_date > first_day").select("symbol", "feature_date").distinct()
    available = td.symbol_days(spark, sf).where(~((F.length("symbol") == 5) & (F.day("date") == 11)))
    return lg.failed_symbols(tasks, available, use_prev_day=True)


@query("failed_symbols", f"WITH {FAILED_SQL} SELECT symbol, failed_dates FROM fl")
def failed_symbols(spark, sf):
    return failures(spark, sf)


@query(
    "job_status",
    f"""WITH {FAILED_SQL}, oc AS (SELECT DISTINCT sd.symbol, fl.symbol IS NULL AS trained, sd.symbol <> 'view' AS published FROM sd LEFT JOIN fl USING (symbol))
    SELECT count(*) AS symbols, count(*) FILTER (trained) AS trained, count(*) FILTER (trained AND published) AS published,
     CASE WHEN bool_and(trained) AND NOT bool_or(trained AND NOT published) THEN 0 WHEN bool_or(trained) AND bool_or(trained AND published) THEN 1 ELSE 2 END AS exit_code
    FROM oc""",
)
def job_status(spark, sf):
    symbols = td.symbol_days(spark, sf).select("symbol").distinct()
    trained = symbols.join(failures(spark, sf).withColumn("bad", F.lit(True)), "symbol", "left")
    outcomes = trained.select("symbol", F.col("bad").isNull().alias("trained"), (F.col("symbol") != "view").alias("published"))
    return lg.job_status(outcomes)


REGISTRY_SQL = f"""{SPANS_SQL}, rg AS (SELECT symbol, date AS model_date, 'models/' || symbol || '/' || strftime(date, '%Y-%m-%d') || '/v' ||
  CASE WHEN day(date) = 6 THEN 2 ELSE 1 END AS path FROM sd WHERE day(date) % 3 = 0 AND symbol <> 'error')"""


@query("model_registry", f"WITH {REGISTRY_SQL} SELECT symbol, model_date, path FROM rg")
def model_registry(spark, sf):
    path = scratch_path(spark, "registry")
    rg.register(td.registry(spark, sf), path)
    return rg.current_models(rg.read_registry(spark, path)).drop("updated_at")


@query(
    "latest_model",
    f"""WITH {REGISTRY_SQL} SELECT cal.symbol, date, max(model_date) AS model_date, arg_max(path, model_date) AS path FROM cal
    LEFT JOIN rg ON rg.symbol = cal.symbol AND model_date <= date AND model_date > date - {LOOKBACK_DAYS} GROUP BY cal.symbol, date""",
)
def latest_model(spark, sf):
    asks = sp.calendar(td.symbol_spans(spark, sf), "first_day", "last_day")
    return rg.latest_models(asks, rg.current_models(td.registry(spark, sf)), LOOKBACK_DAYS).drop("updated_at")
