import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import DAY, QUOTE_SCHEMA, random_quotes
from quotegrid.config import FeatureConfig, GridConfig
from quotegrid.operators.features import live_volatility
from quotegrid.streaming.events import depth_levels, live_messages, parse, read_event_files, route, status_message
from quotegrid.streaming.live import live_features, use_rocksdb
from quotegrid.streaming.scoring import score_and_send

STEP = 600_000_000_000
CFG = FeatureConfig(GridConfig(STEP), (30, 60, 120), 60)
COLUMNS = ["symbol", "timestamp", "samples", "warm", "mid_tick", "vol_30m", "vol_60m", "vol_120m"]


def messages(rows, tick=0.01):
    """Valid quotes in order of receipt, without two at one time, after a size per symbol."""
    out = [{"Event": "symbol", "Symbol": s, "TickSize": tick} for s in sorted({r[0] for r in rows})]
    for r in rows:
        out.append({"event": "bookTicker", "symbol": r[0], "updateID": r[3], "bidPrice": r[4], "askPrice": r[5], "updateTime": r[2] // 1000})
    return out


def stream_rows(seed=11, symbols=("a", "b"), days=3):
    rows = [r for r in random_quotes(seed, list(symbols), days, 25, STEP) if r[2] >= r[1]]
    rows = [(*r[:2], r[2] // 1000 * 1000, *r[3:]) for r in rows]
    rows.sort(key=lambda r: (r[2], r[1], r[3]))
    last = {}
    for r in rows:  # the newest id must also be the newest by time
        last[r[0], r[2]] = r
    rows = [(*r[:3], k + 1, *r[4:]) for k, r in enumerate(sorted(last.values(), key=lambda r: r[2]))]
    return [(r[0], min(r[1], r[2]), *r[2:]) for r in rows]


def write_lines(folder, name, msgs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in msgs))


def run(spark, folder, out, state, files_per_batch=1, chunk=4096):
    use_rocksdb(spark)
    stream = live_features(read_event_files(spark, str(folder), files_per_batch), CFG, 60, chunk=chunk)
    q = (
        stream.select(*COLUMNS)
        .writeStream.format("parquet")
        .option("path", str(out))
        .option("checkpointLocation", str(state))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    got = spark.read.parquet(str(out))
    assert got.where(" or ".join(f"{c} is null" for c in COLUMNS)).isEmpty()  # unfilled windows are NaN
    return got.orderBy("symbol", "timestamp").toPandas()


def batch(spark, rows):
    sizes = spark.createDataFrame([(s, 0.01) for s in sorted({r[0] for r in rows})], "symbol string, tick_size double")
    out = live_volatility(spark.createDataFrame(rows, QUOTE_SCHEMA), sizes, CFG, 60)
    return out.select(*COLUMNS).orderBy("symbol", "timestamp").toPandas()


def assert_same(got, want, until):
    want = want[want.timestamp < until].reset_index(drop=True)
    got = got[got.timestamp < until].reset_index(drop=True)
    assert len(got) == len(want) > 500
    for c in COLUMNS[:5]:
        assert (got[c] == want[c]).all(), c
    for c in COLUMNS[5:]:
        np.testing.assert_array_equal(got[c], want[c])


@pytest.mark.parametrize("chunk", [5, 4096])
def test_stream_equals_batch_at_any_split_and_after_a_restart(spark, tmp_path, chunk):
    rows = stream_rows()
    msgs = messages(rows)
    rng = np.random.default_rng(0)
    cuts = sorted(rng.choice(len(msgs), 3, replace=False))
    parts = [msgs[a:b] for a, b in zip([0, *cuts], [*cuts, len(msgs)])]
    for k, part in enumerate(parts[:2]):
        write_lines(tmp_path / "in", f"{k}.json", part)
    run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "state", chunk=chunk)
    # A second start goes on from the stored state.
    for k, part in enumerate(parts[2:], 2):
        write_lines(tmp_path / "in", f"{k}.json", part)
    got = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "state", chunk=chunk)
    assert not got.duplicated(["symbol", "timestamp"]).any()
    until = (max(r[2] for r in rows) // 1_000_000 - 1000) * 1_000_000
    assert_same(got, batch(spark, rows), until)


def test_older_update_ids_and_broken_messages_change_nothing(spark, tmp_path):
    rows = stream_rows(12)
    msgs = messages(rows)
    noise = ["{broken", '{"event": "trade", "symbol": "a"}', '{"event": "bookTicker", "symbol": "a", "updateID": 10}', "[1]", ""]
    stale = [dict(m, updateID=0, bidPrice=1.0, askPrice=1.0) for m in msgs if "updateID" in m][1::5]
    write_lines(tmp_path / "in", "0.json", msgs[:2] + noise + msgs[2:] + stale)
    got = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "state")
    until = (max(r[2] for r in rows) // 1_000_000 - 1000) * 1_000_000
    assert_same(got, batch(spark, rows), until)


def test_nothing_is_emitted_before_size_and_quote_and_sizes_can_change(spark, tmp_path):
    base = 19_000 * DAY // 1000
    step = STEP // 1000
    quote = lambda k, price, sym="a": {"event": "bookTicker", "symbol": sym, "updateID": k, "bidPrice": price, "askPrice": price, "updateTime": base + k * step}
    size = lambda k, tick, sym="a": {"Event": "symbol", "Symbol": sym, "TickSize": tick, "updateTime": base + k * step}
    msgs = [quote(0, 10.0), quote(1, 10.0), size(2, 0.1), quote(3, 11.0), size(5, 0.01), quote(8, 11.0), quote(8, 1.0, "b"), quote(20, 1.0, "b")]
    write_lines(tmp_path / "in", "0.json", msgs)
    got = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "state")
    assert set(got.symbol) == {"a"}
    assert list(got.mid_tick[:7]) == [100.0, 110.0, 110.0, 1100.0, 1100.0, 1100.0, 1100.0]
    assert got.timestamp.iloc[0] == (base + 2 * step) * 1000 and got.samples.iloc[0] == 1
    assert got.timestamp.max() == (base + 19 * step) * 1000  # a quiet symbol goes on with the shared watermark


def test_scored_stream_sends_status_messages(spark, tmp_path):
    rows = stream_rows(13, ("a",), 1)
    write_lines(tmp_path / "in", "0.json", messages(rows))
    use_rocksdb(spark)
    sent = []
    registry = lambda: spark.createDataFrame([], "symbol string, model_date date, path string, updated_at timestamp")
    body = score_and_send(registry, lambda df, _: sent.extend(df.collect()), CFG.feature_columns, 30, CFG.grid)
    stream = live_features(read_event_files(spark, str(tmp_path / "in")), CFG, 60)
    q = stream.writeStream.foreachBatch(body).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    parsed = [json.loads(r.value) for r in sent]
    assert {p["status"] for p in parsed} == {"warmup", "no_model"}
    assert sum(p["status"] == "warmup" for p in parsed) == 5
    assert all(set(p) == {"timestamp", "symbol", "status"} for p in parsed)


def test_routes_and_depth(spark):
    lines = [
        '{"event": "bookTicker", "symbol": "a", "updateID": 1, "bidPrice": 1, "askPrice": 2, "updateTime": 1700000000000005}',
        '{"type": "bookTicker", "symbol": "a", "updateID": 2, "bidPrice": 1, "askPrice": 2, "time": 1700000000000006}',
        '{"Event": "symbol", "Symbol": "a", "TickSize": "0.5"}',
        '{"event": "depth", "symbol": "a", "lastUpdateID": 9, "bids": [[1.5, 2], [1.4, 3]], "asks": [[1.6, 4]]}',
        '{"symbol": "a"}',
        "nonsense",
    ]
    df = route(spark.createDataFrame([(l,) for l in lines], "value string"))
    assert [r.route for r in df.collect()] == ["bookTicker", "bookTicker", "symbol", "depth", "unknown", "bad"]
    live = live_messages(df).collect()
    assert [(r.route, r.update_id, r.time_us, r.tick_size) for r in live] == [("bookTicker", 1, 1700000000000005, None), ("bookTicker", 2, 1700000000000006, None), ("symbol", None, None, 0.5)]
    levels = [tuple(r) for r in depth_levels(parse(df, "depth")).collect()]
    assert sorted(levels) == [("a", 9, "ask", 0, 1.6, 4.0), ("a", 9, "bid", 0, 1.5, 2.0), ("a", 9, "bid", 1, 1.4, 3.0)]


def test_status_message_leaves_volatility_out_unless_ok(spark):
    df = spark.createDataFrame([(1, "a", "ok", 0.5), (1, "a", "warmup", 0.5)], "timestamp bigint, symbol string, status string, volatility double")
    got = [json.loads(r[0]) for r in df.select(status_message()).collect()]
    assert got == [{"timestamp": 1, "symbol": "a", "status": "ok", "volatility": 0.5}, {"timestamp": 1, "symbol": "a", "status": "warmup"}]


def test_downsampled_stream_equals_batch(spark, tmp_path):
    from quotegrid.operators.metrics import downsample_last
    from quotegrid.streaming.windows import downsample_last_stream

    df = spark.range(200).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("symbol"),
        (F.lit(19_000 * DAY) + F.col("id") * STEP).alias("timestamp"),
        F.when(F.col("id") % 5 != 0, F.col("id").cast("double")).alias("x"),
    )
    df.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (
        downsample_last_stream(stream, "1 hour")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {tuple(r) for r in downsample_last(df, 3_600_000_000_000).collect()}
    end = max(t for _, t, _ in want)
    assert got == {w for w in want if w[1] < end} and len(got) > 30
