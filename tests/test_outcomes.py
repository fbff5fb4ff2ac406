"""Jobs report what they could not do; sources refuse what they cannot read; streams keep late updates."""

import datetime as dt
import gzip
import json
import math
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import DAY, QUOTE_SCHEMA, random_quotes
from quotegrid.config import TrainConfig
from quotegrid.models.boosting import best_iteration, fit_model
from quotegrid.operators import ledger as lg
from quotegrid.operators import registry as rg
from quotegrid.operators.metrics import evaluate
from quotegrid.plans.jobs import Store, build_features, run_walk_forward
from quotegrid.sources.quotes import QUOTE_CSV_SCHEMA, QuoteFiles, list_quote_files, read_quote_files
from test_models import CFG, FEATURES, FIRST, NOW, day, tasks
from test_streaming import STEP, batch, messages, run, stream_rows, write_lines


@pytest.fixture(scope="module")
def rows():
    return random_quotes(9, ["a"], 6, 60, FEATURES.grid.interval_ns)


def frame(spark, rows):
    return spark.createDataFrame(rows, QUOTE_SCHEMA)


@pytest.fixture(scope="module")
def sizes(spark):
    return spark.createDataFrame([("a", 0.01)], "symbol string, tick_size double")


def without_day(rows, k):
    first = (FIRST - dt.date(1970, 1, 1)).days
    return [r for r in rows if r[2] // DAY != first + k]


def truncate(spark, store, k, n):
    """Leaves ``n`` rows of a stored day."""
    where = f"{store.root}/features/symbol=a/date={day(k)}"
    kept = spark.read.parquet(where).limit(n).toPandas()
    shutil.rmtree(where)
    spark.createDataFrame(kept).coalesce(1).write.parquet(where)


def test_a_rebuild_without_its_raw_day_is_a_failure(spark, rows, sizes, tmp_path):
    s = Store(str(tmp_path))
    assert build_features(frame(spark, rows), tasks(spark, ["a"], [2, 3]), sizes, FEATURES, s, NOW).count() == 0
    truncate(spark, s, 3, 5)
    failed = build_features(frame(spark, without_day(rows, 3)), tasks(spark, ["a"], [2, 3]), sizes, FEATURES, s, NOW)
    assert [r.feature_date for r in failed.collect()] == [day(3)]


def test_a_rebuild_with_fewer_rows_is_recorded_once(spark, rows, sizes, tmp_path):
    s = Store(str(tmp_path))
    build_features(frame(spark, rows), tasks(spark, ["a"], [2]), sizes, FEATURES, s, NOW)
    n = s.ledger(spark, "feature_ledger").first().rows
    high = spark.createDataFrame([("a", day(2), n + 9)], "symbol string, date date, rows bigint")
    s.record(spark, "feature_ledger", high, NOW + dt.timedelta(1))
    assert build_features(frame(spark, rows), tasks(spark, ["a"], [2]), sizes, FEATURES, s, NOW + dt.timedelta(2)).count() == 0
    files = sorted(str(f) for f in (tmp_path / "features").rglob("*.parquet"))
    build_features(frame(spark, rows), tasks(spark, ["a"], [2]), sizes, FEATURES, s, NOW + dt.timedelta(3))
    assert sorted(str(f) for f in (tmp_path / "features").rglob("*.parquet")) == files


def test_a_partly_readable_partition_is_not_the_day(spark, rows, sizes, tmp_path):
    s = Store(str(tmp_path))
    build_features(frame(spark, rows), tasks(spark, ["a"], [2]), sizes, FEATURES, s, NOW)
    (tmp_path / "features" / "symbol=a" / f"date={day(2)}" / "part-broken.parquet").write_bytes(b"broken")
    assert [r.rows for r in s.stats(spark, "features").collect()] == [0]


def test_only_the_asked_days_are_listed(spark, rows, sizes, tmp_path):
    """Other days of the store may be anything: they are neither listed nor read."""
    s = Store(str(tmp_path))
    build_features(frame(spark, rows), tasks(spark, ["a"], [2, 3]), sizes, FEATURES, s, NOW)
    asked = tasks(spark, ["a"], [2, 9]).unionByName(tasks(spark, ["nobody"], [2]))
    assert [f.rsplit("/", 2)[1:] for f in s.day_folders(spark, "features", asked)] == [["symbol=a", f"date={day(2)}"]]
    other = tmp_path / "features" / "symbol=a" / f"date={day(3)}"
    for f in other.glob("*.parquet"):
        f.write_bytes(b"broken")
    assert {r.date for r in s.files(spark, "features", asked).collect()} == {day(2)}
    assert [(r.date, r.rows > 0) for r in s.stats(spark, "features", asked).collect()] == [(day(2), True)]
    assert s.files(spark, "features", tasks(spark, ["b"], [1])).count() == 0
    assert s.files(spark, "nothing", asked).count() == 0 and s.stats(spark, "nothing").count() == 0


def test_folders_of_odd_symbols_are_found(spark, tmp_path):
    odd = ["A/B:C", "x y", "50%", "é", "a=b{1}"]
    s = Store(str(tmp_path))
    rows = spark.createDataFrame([(x, day(1), 5) for x in odd], "symbol string, date date, timestamp bigint")
    rows.write.partitionBy("symbol", "date").parquet(s.path("features"))
    asked = rows.select("symbol", "date")
    assert len(s.day_folders(spark, "features", asked)) == len(odd)
    assert {(r.symbol, r.rows) for r in s.stats(spark, "features", asked).collect()} == {(x, 1) for x in odd}


def test_a_window_with_missing_days_is_a_failure(spark, rows, sizes, tmp_path):
    s = Store(str(tmp_path))
    build_features(frame(spark, rows), tasks(spark, ["a"], [2, 3, 5]), sizes, FEATURES, s, NOW)
    spans = spark.createDataFrame([("a", day(5), day(5))], "symbol string, first_day date, last_day date")
    got = run_walk_forward(spans, FEATURES.feature_columns, FEATURES.label_column, CFG, s, NOW)
    assert list(got) == ["a/0"] and str(day(4)) in got["a/0"] and str(day(5)) not in got["a/0"]


def test_corrupt_ledger_and_registry_are_empty(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "part-0.parquet").write_bytes(b"broken")
    assert lg.read_ledger(spark, str(tmp_path / "l")).count() == 0
    assert rg.read_registry(spark, str(tmp_path / "l")).count() == 0


def quote_file(path, symbol, d, names=None):
    names = names or QUOTE_CSV_SCHEMA.names
    at = (d - dt.date(1970, 1, 1)).days * DAY // 1000
    row = dict(exchange="x", symbol=symbol, timestamp=at, local_timestamp=at + 1, ask_amount=1, ask_price=101, bid_price=100, bid_amount=2)
    path.mkdir(parents=True, exist_ok=True)
    with gzip.open(path / f"binance-futures_book_ticker_{d}_{symbol}.csv.gz", "wt") as f:
        f.write(",".join(names) + "\n" + ",".join(str(row[c]) for c in names) + "\n")


def test_swapped_columns_are_refused(spark, tmp_path):
    quote_file(tmp_path, "A", day(0))
    assert read_quote_files(spark, str(tmp_path)).first().ask_price == 101
    names = list(QUOTE_CSV_SCHEMA.names)
    names[5], names[6] = names[6], names[5]
    quote_file(tmp_path / "swapped", "A", day(0), names)
    with pytest.raises(Exception, match="(?i)header"):
        read_quote_files(spark, str(tmp_path / "swapped")).collect()


def test_only_files_of_the_asked_days_are_opened(spark, tmp_path):
    for k in range(6):
        quote_file(tmp_path / "p", "A", day(k))
        quote_file(tmp_path / "p", "B", day(k))
    files = QuoteFiles(spark, {"primary": str(tmp_path / "p"), "fallback": str(tmp_path / "none")})
    asked = spark.createDataFrame([("A", day(1)), ("A", day(2)), ("B", day(9))], "symbol string, date date")
    got, have = files.for_days(asked)
    assert len(got.inputFiles()) == 2 and {r.date for r in have.collect()} == {day(1), day(2)}
    none, have = files.for_days(asked.where("symbol = 'B'"))
    assert none.count() == 0 and have.count() == 0 and none.columns == got.columns
    with pytest.raises(ValueError, match="unknown quote roots"):
        list_quote_files(spark, {"other": str(tmp_path / "p")})


@pytest.mark.parametrize("rows, want", [([(1.0, math.inf)], math.inf), ([(0.0, 1.0), (1.0, 1.0)], math.inf), ([(1.0, 1.0)], 0.0)])
def test_qlike_of_a_zero_ratio_is_infinite(spark, rows, want):
    df = spark.createDataFrame([("a", *r) for r in rows], "symbol string, y_true double, y_pred double")
    assert evaluate(df, ["symbol"]).first().qlike == want


def test_patience():
    assert best_iteration([3, 2, 1.9999, 1.9998, 1.9997], 2) == 5  # slow, but still better
    assert best_iteration([3, 1, 2, 2, 0.5], 2) == 2
    assert best_iteration([3, 1, 2, 2, 0.5], 50) == 5


def test_a_slowly_improving_fit_keeps_its_trees_and_an_overfitting_one_is_cut(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(0, 1, (400, len(FEATURES.feature_columns)))
    slow = [(*map(float, r), float(r[0] + 2)) for r in x]
    noise = [(*map(float, r), float(v)) for r, v in zip(x, rng.uniform(1, 2, 400), strict=True)]
    names = ", ".join(f"`{c}` double" for c in [*FEATURES.feature_columns, FEATURES.label_column])
    cfg = TrainConfig(max_iter=25, max_depth=3, step_size=0.05, min_instances=2, max_bins=16, patience=4)
    trees = {}
    for what, rows in (("slow", slow), ("noise", noise)):
        train, val = (spark.createDataFrame(part, names).withColumn("symbol", F.lit("a")) for part in (rows[:300], rows[300:]))
        m = fit_model("a", train, val, FEATURES.feature_columns, FEATURES.label_column, cfg)
        trees[what] = m.trees.getNumTrees
        assert m.score(val).where("y_pred is null").count() == 0
    assert trees["slow"] == 25 and trees["noise"] < 25


def test_a_late_update_with_a_newer_id_takes_effect(spark, tmp_path):
    base, step = 19_000 * DAY // 1000, STEP // 1000
    quote = lambda k, price, uid: {"event": "bookTicker", "symbol": "a", "updateID": uid, "bidPrice": price, "askPrice": price, "updateTime": base + k * step}
    size = {"Event": "symbol", "Symbol": "a", "TickSize": 1.0, "updateTime": base}
    parts = [[size, quote(0, 10.0, 1), quote(10, 10.0, 2)], [quote(3, 50.0, 999)], [quote(20, 20.0, 3), quote(21, 20.0, 4)]]
    for k, part in enumerate(parts):  # each after the watermark of the one before
        write_lines(tmp_path / "in", f"{k}.json", part)
        got = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "state")
    assert set(got.mid_tick[:9]) == {10.0} and got.mid_tick.iloc[-1] == 50.0


def test_infinite_prices_and_implausible_times_change_nothing(spark, tmp_path):
    rows = stream_rows(13)
    msgs = messages(rows)
    bad = [dict(msgs[5], updateID=10**6, bidPrice="Infinity"), dict(msgs[6], updateID=10**6, askPrice="-Infinity")]
    bad += [dict(msgs[7], updateID=10**6, updateTime=msgs[7]["updateTime"] * 1000), dict(msgs[8], updateID=10**6, updateTime=5)]
    bad += [{"Event": "symbol", "Symbol": "a", "TickSize": "Infinity"}]
    assert all("bidPrice" in json.loads(json.dumps(m)) for m in msgs[5:9])
    write_lines(tmp_path / "in", "0.json", msgs[:9] + bad + msgs[9:])
    got = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "state")
    until = (max(r[2] for r in rows) // 1_000_000 - 1000) * 1_000_000
    want = batch(spark, rows)
    assert got[got.timestamp < until].mid_tick.tolist() == want[want.timestamp < until].mid_tick.tolist()


