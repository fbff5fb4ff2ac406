"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from quotegrid.config import FeatureConfig
from quotegrid.operators.asof import sessions_of, valid_quotes
from quotegrid.operators.features import feature_matrix
from quotegrid.plans import all_oracles, all_queries
from quotegrid.session import MAX_BROADCAST_ROWS, materialize, scratch_path, shared_dir, small_side
from quotegrid.sources.quotes import write_by_symbol_day
from quotegrid.sources.testdata import quotes

SF = "/root/testdata/sf0.001"
LIGHT = ["asof_sample", "rolling_vol", "feature_matrix", "downsample_last", "completeness", "accepted_updates", "latest_model", "required_raw_dates", "train_split"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LIGHT)
def test_no_all_pairs_join_and_no_python_in_table_queries(spark, name):
    text = plan(all_queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition"):
        assert bad not in text, bad


def test_feature_windows_run_inside_blocks_and_share_one_shuffle(spark):
    q = quotes(spark, SF)
    cfg = FeatureConfig()
    s = sessions_of(q, cfg.grid).withColumn("tick_size", F.lit(0.01))
    text = plan(feature_matrix(q, s, cfg))
    main = text[: text.index("Union")]
    assert main.count("Window ") == 4 and main.count("Exchange hashpartitioning") == 1
    assert re.search(r"Exchange hashpartitioning\(symbol#\d+, feature_date#\d+, block#", main)
    # One sort for the runs, one for the grid points.
    assert main.count("Sort [") == 2
    # Aggregation happens before the quotes are shuffled.
    assert "partial_max" in text


def test_scan_reads_only_used_columns_and_filters_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "q")
    q = quotes(spark, SF).withColumn("date", F.date_from_unix_date(F.expr("cast(local_ts_ns div 86400000000000 as int)")))
    write_by_symbol_day(q, path, "local_ts_ns")
    back = spark.read.parquet(path).where("date >= date'2024-01-20' and bid_price > 50")
    text = plan(valid_quotes(back).select("symbol", "ask_price"))
    assert "PartitionFilters: [isnotnull(date" in text
    assert "GreaterThan(bid_price,50.0)" in text
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "bid_amount" not in schema and "update_id" not in schema


def test_small_side_is_checked(spark):
    key = lambda n: spark.range(n).withColumnRenamed("id", "k")
    big = key(10)
    joined = big.join(small_side(key(5)), "k")
    assert "ResolvedHint (strategy=broadcast)" in joined._jdf.queryExecution().analyzed().toString()
    joined = big.join(small_side(key(50), max_rows=49), "k")
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
    assert MAX_BROADCAST_ROWS <= 1_000_000
    hinted = lambda df, **most: "ResolvedHint" in big.join(small_side(df, **most), "k")._jdf.queryExecution().analyzed().toString()
    wide = key(3).withColumn("text", F.repeat(F.lit("x"), 1000)).withColumn("list", F.array_repeat(F.lit(1234567), 200))
    assert not hinted(wide, max_bytes=7000) and hinted(wide, max_bytes=9000)
    assert hinted(key(0)) and hinted(key(3).withColumn("text", F.lit(None).cast("string")))


def test_stages_go_to_the_named_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named and scratch_path(spark, "x").startswith(named)
    df = spark.range(5).withColumn("x", F.rand())
    once = materialize(df)
    assert once.collect() == once.collect()
    assert named in once.inputFiles()[0]


def test_every_query_is_registered_once_with_sql_unless_it_cannot_be():
    no_sql = {"gbt_predict", "feature_importance"}
    assert set(all_queries()) - set(all_oracles()) == no_sql
    assert len(all_queries()) >= 65
