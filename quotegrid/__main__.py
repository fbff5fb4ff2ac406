"""Run a job: ``python -m quotegrid {features,research,production,live} job.yaml [--date YYYY-MM-DD]``."""

from __future__ import annotations

import argparse
import sys
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from quotegrid.jobconfig import JobConfig, load_config
from quotegrid.operators import splits as sp
from quotegrid.operators.registry import read_registry
from quotegrid.plans.jobs import Store, build_features, run_production, run_walk_forward
from quotegrid.session import build_session
from quotegrid.streaming.events import read_event_files, read_event_topic
from quotegrid.streaming.live import clock, live_features, use_rocksdb
from quotegrid.streaming.scoring import score_and_send
from quotegrid.streaming.sinks import CommitLog, folder_sink, sent_once, topic_sink


def _spans(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    rows = [(s, cfg.first_day, cfg.last_day) for s in cfg.symbols]
    return spark.createDataFrame(rows, "symbol string, first_day date, last_day date")


def features(spark: SparkSession, cfg: JobConfig, now: datetime) -> int:
    tasks = sp.calendar(_spans(spark, cfg), "first_day", "last_day")
    failed = build_features(cfg.load_quotes(spark, now), tasks, cfg.tick_sizes(spark), cfg.features, Store(cfg.store), now)
    for r in failed.orderBy("symbol", "feature_date").collect():
        print(f"failed: {r['symbol']} {r['feature_date']}")
    return 0 if failed.isEmpty() else 1


def research(spark: SparkSession, cfg: JobConfig, now: datetime) -> int:
    names, label = cfg.features.feature_columns, cfg.features.label_column
    failures = run_walk_forward(_spans(spark, cfg), names, label, cfg.train, Store(cfg.store), now, cfg.parallel_fits)
    for what, why in failures.items():
        print(f"failed: {what}: {why}")
    return 1 if failures else 0


def production(spark: SparkSession, cfg: JobConfig, now: datetime, reference_date: date) -> int:
    sizes = cfg.tick_sizes(spark)
    store = Store(cfg.store)
    quotes = cfg.load_quotes(spark, now)
    reasons: dict[str, str] = {}
    status = run_production(
        quotes, cfg.symbols, sizes, reference_date, cfg.features, cfg.train, store, now, cfg.parallel_fits, reasons
    ).first()
    for symbol, why in sorted(reasons.items()):
        print(f"failed: {symbol}: {why}")
    print(f"trained {status['trained']} of {status['symbols']} symbols, published {status['published']}")
    return status["exit_code"]


def live(spark: SparkSession, cfg: JobConfig, available_now: bool) -> int:
    """Score the event stream and send one JSON message per instant until stopped."""
    use_rocksdb(spark)
    if cfg.live.kafka_servers:
        events = read_event_topic(spark, cfg.live.kafka_servers, cfg.live.events)
    else:
        events = read_event_files(spark, cfg.live.events)

    conf = cfg.live
    sink = topic_sink(conf.kafka_servers, conf.out) if conf.kafka_servers else folder_sink(conf.out)
    log = CommitLog(spark, conf.log or f"{conf.checkpoint.rstrip('/')}-sent")
    body = score_and_send(
        lambda: read_registry(spark, Store(cfg.store).path("registry")),
        sent_once(sink, log),
        cfg.features.feature_columns,
        cfg.live.lookback_days,
        cfg.features.grid,
    )
    ticks = clock(spark, conf.clock_per_second) if conf.clock_per_second else None
    rows = live_features(
        events, cfg.features, conf.warmup_minutes, conf.delay, ticks=ticks, max_ahead_s=conf.max_ahead_s, max_age_s=conf.max_age_s
    )
    writer = (
        rows.writeStream.foreachBatch(body)
        .option("checkpointLocation", cfg.live.checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    writer.start().awaitTermination()
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quotegrid", description=__doc__)
    p.add_argument("job", choices=("features", "research", "production", "live"))
    p.add_argument("config")
    p.add_argument("--date", type=date.fromisoformat, help="reference date of a production run (default: today, UTC)")
    p.add_argument("--available-now", action="store_true", help="live: stop when all present events were read")
    args = p.parse_args(argv)
    cfg = load_config(args.config)
    spark = build_session(f"quotegrid {args.job}")
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    if args.job == "features":
        return features(spark, cfg, now)
    if args.job == "research":
        return research(spark, cfg, now)
    if args.job == "production":
        return production(spark, cfg, now, args.date or now.date())
    return live(spark, cfg, args.available_now)


if __name__ == "__main__":
    sys.exit(main())
