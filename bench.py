"""Time the headline queries and one production-size symbol-day; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) holds the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from quotegrid.config import FeatureConfig, GridConfig  # noqa: E402
from quotegrid.operators.asof import sessions_of  # noqa: E402
from quotegrid.operators.features import feature_matrix  # noqa: E402
from quotegrid.plans import all_queries  # noqa: E402
from quotegrid.session import build_session  # noqa: E402
from quotegrid.sources.testdata import quotes  # noqa: E402

HEADLINE = [
    "feature_matrix",
    "asof_sample",
    "rolling_vol",
    "rolling_vol_pop",
    "vol_ratios",
    "downsample_last",
    "eval_metrics",
    "metrics_by_day",
    "describe_vol",
    "label_quantiles",
    "label_uniform",
    "quote_sink_roundtrip",
    "feature_sink_roundtrip",
    "prev_day_union",
    "vendor_to_quote",
    "accepted_updates",
    "dup_monotonic_check",
    "event_router",
    "status_json",
    "train_split",
    "stream_vs_batch_asof",
    "gbt_predict",
    "raw_backfill",
    "inverse_transform",
    "merged_scores",
    "audit_by_file",
    "production_summary",
    "scored_status",
]
COPIES = 40  # of each quote on the busy day


def production_day(spark, sf):
    """One symbol-day on the 20 ms grid with all windows: 4.3 million rows of 42 columns."""
    q = quotes(spark, sf)
    cfg = FeatureConfig()
    s = sessions_of(q, cfg.grid).withColumn("tick_size", F.lit(0.01))
    return feature_matrix(q, s.where("symbol = 'click' and feature_date = '2024-01-10'"), cfg)


def busy_day(spark, sf):
    """All quotes of one symbol moved into one day, each many times: many quotes for every point of a one-second grid."""
    day_ns = 86_400_000_000_000
    q = quotes(spark, sf).where("symbol = 'click'").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    first = F.unix_date(F.lit("2024-01-10").cast("date")).cast("bigint") * F.lit(day_ns)
    at = first + (F.col("local_ts_ns") + F.col("k") * 1_234_567_891_011) % F.lit(day_ns)
    q = q.withColumn("ts_ns", at - 1_000_000).withColumn("local_ts_ns", at).drop("k")
    cfg = FeatureConfig(GridConfig(1_000_000_000, use_prev_day=False))
    return feature_matrix(q, sessions_of(q, cfg.grid).withColumn("tick_size", F.lit(0.01)), cfg)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": str(2 * int(cpus)), "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(all_queries()["mid_price"](spark, sf))  # start the JVM's compiler
    todo = {n: all_queries()[n] for n in HEADLINE} | {"production_day_20ms": production_day, "busy_day_1s": busy_day}
    only = sys.argv[1:]
    times = {}
    for name, fn in todo.items():
        if only and name not in only:
            continue
        t = time.perf_counter()
        run(fn(spark, sf))
        times[name] = round(time.perf_counter() - t, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total query time", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
