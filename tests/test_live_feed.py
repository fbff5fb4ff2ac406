"""A silent feed, times that cannot be, huge moves, and batches that are run again."""

import datetime as dt
import json
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import DAY
from quotegrid.config import FeatureConfig, GridConfig
from quotegrid.streaming.events import read_event_files
from quotegrid.streaming.live import clock, live_features, use_rocksdb
from quotegrid.streaming.scoring import score_and_send
from quotegrid.streaming.sinks import CommitLog, folder_sink, sent_once, topic_rows
from test_streaming import CFG, COLUMNS, STEP, messages, run, stream_rows, write_lines

BASE = 19_000 * DAY // 1000
SIZE = {"Event": "symbol", "Symbol": "a", "TickSize": 1.0, "updateTime": BASE}


def quote(k, price, uid, symbol="a"):
    return {"event": "bookTicker", "symbol": symbol, "updateID": uid, "bidPrice": price, "askPrice": price, "updateTime": BASE + k * STEP // 1000}


def started(spark, tmp_path, **settings):
    use_rocksdb(spark)
    stream = live_features(read_event_files(spark, str(tmp_path / "in")), CFG, 60, **settings)
    writer = stream.select(*COLUMNS).writeStream.format("parquet").option("path", str(tmp_path / "out"))
    return writer.option("checkpointLocation", str(tmp_path / "state"))


def test_a_silent_feed_is_sampled_by_the_clock(spark, tmp_path):
    """Instants are emitted at the clock's pace with the quote in force, though no message comes."""
    write_lines(tmp_path / "in", "0.json", [SIZE, quote(0, 10.0, 1), quote(1, 12.0, 2)])
    ticks = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", 1)
        .option("numPartitions", 1)
        .option("startTimestamp", BASE // 1000 + 2 * STEP // 1_000_000)
        .option("advanceMillisPerBatch", 5 * STEP // 1_000_000)
        .load()
        .select(F.unix_micros("timestamp").alias("time_us"))
    )
    q = started(spark, tmp_path, ticks=ticks).trigger(processingTime="0 seconds").start()
    got, until = None, time.time() + 90
    while time.time() < until and (got is None or len(got) < 30):
        time.sleep(1)
        assert q.exception() is None
        try:
            got = spark.read.schema("symbol string, timestamp bigint, mid_tick double, samples bigint").parquet(str(tmp_path / "out")).toPandas()
        except Exception:  # nothing was written yet
            got = None
    q.stop()
    got = got.sort_values("timestamp").reset_index(drop=True)
    assert len(got) >= 30 and set(got.symbol) == {"a"}
    assert list(got.timestamp) == [BASE * 1000 + k * STEP for k in range(len(got))]
    assert list(got.mid_tick) == [10.0] + [12.0] * (len(got) - 1)
    assert list(got.samples) == list(range(1, len(got) + 1))


def test_the_clock_tells_the_time(spark):
    ticks = clock(spark, 5)
    assert ticks.isStreaming and ticks.columns == ["time_us"]


def test_a_message_from_the_future_does_not_move_the_stream(spark, tmp_path):
    ahead = dict(quote(0, 99.0, 10), updateTime=int((dt.datetime.now().timestamp() + 86_400 * 365) * 1e6))
    write_lines(tmp_path / "in", "0.json", [SIZE, quote(0, 10.0, 1), ahead, quote(3, 11.0, 2)])
    got = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "state")
    assert got.timestamp.max() == (BASE + 2 * STEP // 1000) * 1000 and set(got.mid_tick) == {10.0}


def test_a_message_from_the_past_does_not_pull_a_symbol_back(spark, tmp_path):
    now = int(time.time() * 1e6) // (STEP // 1000) * (STEP // 1000)
    at = lambda k, price, uid: dict(quote(0, price, uid), updateTime=now - (4 - k) * STEP // 1000)
    old = dict(quote(0, 5.0, 1), updateTime=now - 10**6 * 86_400 * 3000)
    write_lines(tmp_path / "in", "0.json", [dict(SIZE, updateTime=now - 4 * STEP // 1000), old, at(0, 10.0, 2), at(3, 11.0, 3)])
    started(spark, tmp_path, max_age_s=86_400).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 3 and got.agg(F.min("timestamp")).first()[0] == (now - 4 * STEP // 1000) * 1000


def test_huge_moves_leave_no_volatility_and_then_nothing(spark, tmp_path):
    prices = [100.0, 101.0, 1e12, 101.0, 1e308, 100.0] + [100.0 + k % 3 for k in range(30)]
    msgs = [dict(SIZE, TickSize=1e-3)] + [quote(k, p, k + 1) for k, p in enumerate(prices)]
    write_lines(tmp_path / "in", "0.json", msgs)
    got = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "state")
    width = {30: 3, 60: 6, 120: 12}
    mids = np.array(prices[: len(got)]) / 1e-3
    for m, w in width.items():
        vols = got[f"vol_{m}m"].to_numpy()
        for k in range(len(got)):
            window = np.diff(mids[max(k - w, 0) : k + 1]) if k else np.zeros(0)
            moves = window[-w:]
            if k + 1 < w or (np.abs(moves) > 1e9).any() or ~np.isfinite(moves).all():
                assert math.isnan(vols[k]), (m, k)
            else:
                x = np.concatenate([np.zeros(w - len(moves)), moves])
                assert vols[k] == pytest.approx(x.std(), rel=1e-9), (m, k)


def test_a_batch_that_is_run_again_is_sent_once(spark, tmp_path):
    sent = []
    log = CommitLog(spark, str(tmp_path / "log"))
    send = sent_once(lambda df, k: sent.append((k, sorted(r.value for r in df.collect()))), log)
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "symbol string, timestamp bigint, value string")
    send(df, 0)
    send(df, 0)
    send(df.where("timestamp = 1"), 1)
    send(df.limit(0), 2)
    for k in (0, 1, 2):
        sent_once(lambda *_: sent.append("again"), CommitLog(spark, str(tmp_path / "log")))(df, k)
    assert sent == [(0, ["x", "y"]), (1, ["x"])]
    assert not log.has(64) and log.has(2)
    send(df, 64)  # takes the place of batch 0 in the log
    assert log.has(64) and not log.has(0)


def test_a_batch_that_failed_is_sent_again(spark, tmp_path):
    tries = []

    def sink(df, k):
        tries.append(k)
        if len(tries) == 1:
            raise OSError("no connection")

    send = sent_once(sink, CommitLog(spark, str(tmp_path / "log")))
    df = spark.createDataFrame([("a", 1, "x")], "symbol string, timestamp bigint, value string")
    with pytest.raises(OSError):
        send(df, 7)
    send(df, 7)
    send(df, 7)
    assert tries == [7, 7]


def test_topic_rows_name_symbol_and_instant(spark):
    df = spark.createDataFrame([("a", 5, "x")], "symbol string, timestamp bigint, value string")
    assert tuple(topic_rows(df).first()) == ("a/5", "x")


def test_a_stream_writes_its_batches_to_the_folder_once(spark, tmp_path):
    write_lines(tmp_path / "in", "0.json", messages(stream_rows(13, ("a",), 1)))
    use_rocksdb(spark)
    none = lambda: spark.createDataFrame([], "symbol string, model_date date, path string, updated_at timestamp")
    sink = sent_once(folder_sink(str(tmp_path / "out")), CommitLog(spark, str(tmp_path / "log")))
    for _ in range(2):  # the second run starts from an empty state and repeats the batches
        state = tmp_path / f"state{_}"
        stream = live_features(read_event_files(spark, str(tmp_path / "in")), CFG, 60)
        body = score_and_send(none, sink, CFG.feature_columns, 30, CFG.grid)
        stream.writeStream.foreachBatch(body).option("checkpointLocation", str(state)).trigger(availableNow=True).start().awaitTermination()
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(lines) == len({(m["symbol"], m["timestamp"]) for m in lines}) > 50


def test_settings_of_the_grid_hold(spark):
    assert FeatureConfig(GridConfig(STEP), (30, 60, 120), 60) == CFG
