import datetime as dt
import math
from decimal import Decimal

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from quotegrid.functions.epochs import epoch_to_micros, exchange_name
from quotegrid.operators import ledger as lg
from quotegrid.operators import quality as qa
from quotegrid.operators import registry as rg
from quotegrid.operators import splits as sp
from quotegrid.operators.metrics import downsample_last, evaluate
from quotegrid.operators.updates import accepted_updates, latest_by_update_id
from quotegrid.sources.assets import parse_assets, read_assets, tick_sizes, unknown_symbols
from quotegrid.sources.quotes import list_quote_files, read_quote_files, resolve_sources, write_by_symbol_day
from quotegrid.sources.vendor import vendor_to_quotes

D = dt.date


def test_epoch_units(spark):
    cases = [
        ("0", 0),
        ("99999999999", 99_999_999_999_000_000),
        ("100000000000", 100_000_000_000_000),
        ("99999999999999", 99_999_999_999_999_000),
        ("100000000000000", 100_000_000_000_000),
        ("99999999999999999", 99_999_999_999_999_999),
        ("100000000000000000", 100_000_000_000_000),
        ("1704067200123456789", 1_704_067_200_123_456),
        ("1704067200.5", 1_704_067_200_500_000),
        ("1704067200000.0005", 1_704_067_200_000_000),
        ("1704067200000.0015", 1_704_067_200_000_002),
        ("1.7040672e9", 1_704_067_200_000_000),
        ("oops", None),
        (None, None),
    ]
    df = spark.createDataFrame(cases, "v string, want bigint")
    for r in df.select("v", "want", epoch_to_micros(F.col("v")).alias("got")).collect():
        assert r.got == r.want, r


def test_exchange_names(spark):
    df = spark.createDataFrame([(0,), (None,), (7,)], "c int")
    assert [r[0] for r in df.select(exchange_name(F.col("c"))).collect()] == ["binance-futures", "unknown", "7"]


def test_vendor_rows_without_optional_columns(spark):
    v = spark.createDataFrame([("a", "1704067200", None), ("a", "x", "5")], "symbol string, eventTimeUnix string, receiveTime string")
    rows = vendor_to_quotes(v, 42).collect()
    assert len(rows) == 1 and rows[0].local_ts_ns == 42_000 and rows[0].exchange == "binance-futures"
    assert rows[0].ask_price is None and rows[0].update_id is None


def test_quote_files_in_three_formats_and_their_priority(spark, tmp_path):
    head = "exchange,symbol,timestamp,local_timestamp,ask_amount,ask_price,bid_price,bid_amount\n"
    line = "binance-futures,{s},1704067200000001,1704067200000002,1.5,10.25,10,2\n"
    name = "binance-futures_book_ticker_2024-01-01_{}"
    for root in ("primary", "fallback"):
        (tmp_path / root / "A" / "book_ticker").mkdir(parents=True)
    p = tmp_path / "primary" / "A" / "book_ticker"
    f = tmp_path / "fallback" / "A" / "book_ticker"
    (p / (name.format("A") + ".csv.zst")).write_bytes(zstandard.compress((head + line.format(s="A")).encode()))
    import gzip

    (p / (name.format("A") + ".csv.gz")).write_bytes(gzip.compress((head + line.format(s="gz")).encode()))
    (f / (name.format("B") + ".csv.gz")).write_bytes(gzip.compress((head + line.format(s="B")).encode()))
    (f / (name.format("A") + ".csv.gz")).write_bytes(gzip.compress((head + line.format(s="old")).encode()))
    listing = list_quote_files(spark, {r: str(tmp_path / r) for r in ("primary", "fallback")})
    best = {r.symbol: r.path for r in resolve_sources(listing).collect()}
    assert best["A"].endswith("primary/A/book_ticker/" + name.format("A") + ".csv.zst")
    assert "/fallback/" in best["B"]
    got = read_quote_files(spark, sorted(best.values())).orderBy("symbol").collect()
    assert [r.symbol for r in got] == ["A", "B"]
    assert (got[0].ts_ns, got[0].local_ts_ns, got[0].ask_price) == (1704067200000001000, 1704067200000002000, 10.25)


def test_rewriting_a_day_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([("a", D(2024, 1, 1), 1, 1.0), ("a", D(2024, 1, 2), 2, 2.0)], "symbol string, date date, timestamp bigint, v double")
    write_by_symbol_day(a, path, "timestamp")
    write_by_symbol_day(a.where("v = 2").withColumn("v", F.lit(5.0)), path, "timestamp")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1.0, 5.0]


def test_assets(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"future": {"A": {"tick_size": 0.1, "lot_size": 1}}, "spot": {"A": {"tick_size": 0.2, "lot_size": 2}}}')
    dim = read_assets(spark, str(tmp_path / "a.json"))
    assert dim.count() == 2 and tick_sizes(dim, "spot").first().tick_size == 0.2
    with pytest.raises(KeyError):
        tick_sizes(dim, "option")
    asked = spark.createDataFrame([("A",), ("B",)], "symbol string")
    assert [r.symbol for r in unknown_symbols(asked, tick_sizes(dim, "future")).collect()] == ["B"]
    assert parse_assets(spark.createDataFrame([("broken",)], "value string")).count() == 0


def test_date_splits(spark):
    one = spark.createDataFrame([("a", D(2024, 3, 10))], "symbol string, target_date date")
    rows = sp.production_split(one, 7, 1).collect()
    days = lambda role: sorted(r.date for r in rows if r.role == role)
    assert days("val") == [D(2024, 3, 10)]
    assert days("train") == [D(2024, 3, d) for d in range(3, 10)]
    refs = spark.createDataFrame([("a", D(2024, 3, 10))], "symbol string, reference_date date")
    need = sorted(r.feature_date for r in sp.required_feature_dates(refs, 7, 1).collect())
    assert need == [D(2024, 3, d) for d in range(2, 10)]
    raw = sp.required_raw_dates(sp.required_feature_dates(refs, 7, 1), True)
    assert sorted(r.date for r in raw.collect()) == [D(2024, 3, d) for d in range(1, 10)]


def test_walk_forward_windows(spark):
    span = spark.createDataFrame([("a", D(2024, 3, 10), D(2024, 3, 14))], "symbol string, first_day date, last_day date")
    rows = sp.walk_forward_splits(span, 3, 2, 2).collect()
    w1 = {role: sorted(r.date.day for r in rows if r.window_id == 1 and r.role == role) for role in ("train", "val", "test")}
    assert w1 == {"train": [7, 8, 9], "val": [10, 11], "test": [12, 13]}
    assert [r.date.day for r in rows if r.window_id == 2 and r.role == "test"] == [14]
    have = spark.createDataFrame([("a", D(2024, 3, d)) for d in range(5, 15) if d != 9], "symbol string, date date")
    good = sp.complete_windows(sp.walk_forward_splits(span, 3, 2, 2), have)
    assert {r.window_id for r in good.collect()} == set()
    have = spark.createDataFrame([("a", D(2024, 3, d)) for d in range(6, 15)], "symbol string, date date")
    good = sp.complete_windows(sp.walk_forward_splits(span, 3, 2, 2), have)
    assert {r.window_id for r in good.collect()} == {1, 2}


def test_scores(spark):
    nan = float("nan")
    rng = np.random.default_rng(0)
    y, p = rng.random(50) + 0.1, rng.random(50) + 0.1
    rows = [("a", float(a), float(b)) for a, b in zip(y, p)] + [("a", nan, 1.0), ("a", 1.0, nan), ("a", None, 1.0)]
    rows += [("one", 2.0, 1.0), ("none", nan, 1.0), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0)]
    rows += [("zero", 0.0, 1.0), ("both", 0.0, 0.0), ("div", 1.0, 0.0), ("neg", 1.0, -1.0), ("negs", -1.0, -2.0)]
    got = {r.k: r for r in evaluate(spark.createDataFrame(rows, "k string, y_true double, y_pred double"), ["k"]).collect()}
    a = got["a"]
    assert a.n == 50
    assert a.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert a.mae == pytest.approx(np.mean(np.abs(y - p)))
    assert a["corr"] == pytest.approx(np.corrcoef(y, p)[0, 1])
    assert a.qlike == pytest.approx(np.mean(y / p - np.log(y / p) - 1))
    assert math.isnan(got["one"]["corr"]) and got["one"].qlike == pytest.approx(1 - math.log(2))
    assert all(math.isnan(got["none"][c]) for c in ("rmse", "mae", "corr", "qlike")) and got["none"].n == 0
    assert math.isnan(got["flat"]["corr"])
    assert got["zero"].qlike == math.inf
    assert all(math.isnan(got[k].qlike) for k in ("both", "div", "neg"))
    assert got["negs"].qlike == pytest.approx(0.5 - math.log(0.5) - 1)


def test_downsample_keeps_the_last_whole_row(spark):
    rows = [("a", 10, 1.0, None), ("a", 19, None, 2.0), ("a", 20, 3.0, 3.0), ("b", 5, 4.0, 4.0)]
    df = spark.createDataFrame(rows, "symbol string, timestamp bigint, x double, y double")
    once = downsample_last(df, 10)
    assert sorted(map(tuple, once.collect()), key=str) == sorted([("a", 10, None, 2.0), ("a", 20, 3.0, 3.0), ("b", 0, 4.0, 4.0)], key=str)
    assert sorted(map(str, downsample_last(once, 10).collect())) == sorted(map(str, once.collect()))


@pytest.mark.parametrize("chunk", [3, 1000])
def test_updates_and_order(spark, chunk):
    rng = np.random.default_rng(5)
    ids = rng.permutation(60)
    rows = [("a", int(k), int(u)) for k, u in enumerate(ids)] + [("b", k, k // 2) for k in range(20)]
    df = spark.createDataFrame(rows, "symbol string, arrival bigint, update_id bigint")
    got = {(r.symbol, r.arrival) for r in accepted_updates(df, "arrival", chunk).collect()}
    want, top = set(), {}
    for s, k, u in rows:
        if u > top.get(s, -1):
            want.add((s, k))
            top[s] = u
    assert got == want
    assert {r.symbol: r.update_id for r in latest_by_update_id(df, ["arrival"]).collect()} == {"a": 59, "b": 9}
    audit = {r.symbol: r for r in qa.duplicates_and_order(df, "arrival", "update_id", chunk).collect()}
    assert (audit["a"].has_duplicates, audit["a"].is_monotonic) == (False, False)
    assert (audit["b"].has_duplicates, audit["b"].is_monotonic) == (True, True)


def test_missing_ranges_and_completeness(spark):
    cal = spark.createDataFrame([("a", D(2024, 1, d)) for d in range(1, 11)], "symbol string, date date")
    have = cal.where("day(date) not in (2, 3, 7, 10)")
    got = sorted((r.range_start.day, r.range_end.day, r.days) for r in qa.missing_ranges(cal, have).collect())
    assert got == [(2, 3, 2), (7, 7, 1), (10, 10, 1)]
    assert qa.completeness(cal, have).first().percent == "60.0%"


def test_task_actions(spark):
    at = dt.datetime(2024, 1, 2)
    tasks = spark.createDataFrame([(s, D(2024, 1, 1)) for s in "abcde"], "symbol string, date date")
    ledger = spark.createDataFrame([(s, D(2024, 1, 1), 5, at) for s in "abe"], lg.LEDGER_SCHEMA)
    rows = [("a", D(2024, 1, 1), 5), ("c", D(2024, 1, 1), 7), ("d", D(2024, 1, 1), 0), ("e", D(2024, 1, 1), 4)]
    stats = spark.createDataFrame(rows, "symbol string, date date, rows bigint")
    got = {r.symbol: r.action for r in lg.classify_tasks(tasks, ledger, stats).collect()}
    assert got == {"a": "done", "b": "build", "c": "verify", "d": "build", "e": "build"}
    stats = stats.where("symbol in ('a', 'c', 'd')")
    assert [r.symbol for r in lg.append_ledger(ledger, stats, F.lit("2024-01-01")).collect()] == ["c"]


def test_unreadable_ledger_is_empty(spark, tmp_path):
    assert lg.read_ledger(spark, str(tmp_path / "none")).count() == 0
    assert rg.read_registry(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize(
    "rows, code",
    [
        ([("a", True, True), ("b", True, True)], 0),
        ([], 0),
        ([("a", True, True), ("b", False, False)], 1),
        ([("a", True, True), ("b", True, False)], 1),
        ([("a", True, False)], 2),
        ([("a", False, False)], 2),
    ],
)
def test_exit_code(spark, rows, code):
    df = spark.createDataFrame(rows, "symbol string, trained boolean, published boolean")
    assert lg.job_status(df).first().exit_code == code


def test_latest_model_lookback(spark):
    at = dt.datetime(2024, 1, 9)
    reg = spark.createDataFrame([("a", D(2024, 1, 1), "p1", at), ("a", D(2024, 1, 3), "p3", at)], rg.REGISTRY_SCHEMA)
    asks = spark.createDataFrame([("a", D(2024, 1, d)) for d in range(1, 8)], "symbol string, date date")
    got = {r.date.day: r.path for r in rg.latest_models(asks, reg, 3).collect()}
    assert got == {1: "p1", 2: "p1", 3: "p3", 4: "p3", 5: "p3", 6: None, 7: None}


def test_decimal_keeps_nanosecond_digits(spark):
    r = spark.range(1).select(epoch_to_micros(F.lit(Decimal("1704067200123456789"))).alias("us")).first()
    assert r.us == 1_704_067_200_123_456


def test_vendor_hours_cover_the_days_once():
    from quotegrid.sources.vendor import hour_predicates

    got = hour_predicates(D(2024, 2, 28), D(2024, 2, 29))
    assert len(got) == 48
    assert got[0] == "receiveTime >= '2024-02-28 00:00:00' AND receiveTime < '2024-02-28 01:00:00'"
    assert got[-1].endswith("receiveTime < '2024-03-01 00:00:00'")


def test_merged_score_states_equal_a_full_pass(spark):
    """However rows are dealt out to states, and states to merges; with NaN, null, constant and one-row groups."""
    import math

    from quotegrid.operators.metrics import evaluate, merge_states, score_states, scores_of

    rng = np.random.default_rng(2)
    rows = [("a", int(rng.integers(0, 12)), float(1e6 + y), float(1e6 + y + e)) for y, e in rng.normal(size=(500, 2))]
    rows += [("b", d, 2.0, 1.0 + d) for d in range(5)] + [("c", 0, 1.0, 2.0), ("d", 0, float("nan"), 1.0), ("d", 1, None, 1.0)]
    rows += [("e", 0, 0.0, 1.0), ("e", 1, 1.0, 1.0), ("a", 3, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "symbol string, date int, y_true double, y_pred double")
    states = score_states(df, ["symbol", "date"])
    halves = merge_states(states.withColumn("half", F.col("date") % 2), ["symbol", "half"])
    got = {r.symbol: r for r in scores_of(merge_states(halves, ["symbol"]), ["symbol"]).collect()}
    for want in evaluate(df, ["symbol"]).collect():
        r = got[want.symbol]
        assert r.n == want.n
        for c in ("rmse", "mae", "corr", "qlike"):
            assert r[c] == pytest.approx(want[c], rel=1e-9) or (math.isnan(r[c]) and math.isnan(want[c])), (want.symbol, c)


@pytest.mark.parametrize("files", [1, 7, 40])
def test_audits_by_file_equal_the_full_audit(spark, files):
    """However the rows are dealt out to files; rows are read again only where files overlap."""
    rng = np.random.default_rng(files)
    rows = []
    for s, step, falls, repeat in (("good", 3, 0, 0), ("falls", 3, 2, 0), ("repeats", 3, 0, 2), ("both", 3, 2, 2)):
        t = np.arange(300) * step
        for k in rng.integers(1, 299, falls):
            t[k] -= 4 * step
        for k in rng.integers(1, 299, repeat):
            t[k] = t[k - 1]
        rows += [(s, int(i), int(x), int(i * files // 300)) for i, x in enumerate(t)]
    rows += [("mixed", i, i * 3, int(rng.integers(0, files))) for i in range(300)]
    df = spark.createDataFrame(rows, "symbol string, arrival long, t long, file long")
    asked = []

    def rows_of(wanted):
        asked.extend((r.symbol, r.file) for r in wanted.collect())
        return df.join(wanted, ["symbol", "file"], "left_semi")

    audits = qa.audit_files(df, "arrival", "t", "file", chunk=50)
    got = {tuple(r) for r in qa.merge_audits(audits, rows_of, "arrival", "t", chunk=50).collect()}
    assert got == {tuple(r) for r in qa.duplicates_and_order(df, "arrival", "t", chunk=50).collect()}
    read = {s for s, _ in asked}
    assert "good" not in read and (files == 1 or "mixed" in read)
    # a new day's summary is put to the others; these are not made again
    old, new = df.where(f"file < {files - 1}"), df.where(f"file = {files - 1}")
    parts = qa.audit_files(old, "arrival", "t", "file", chunk=50).unionByName(qa.audit_files(new, "arrival", "t", "file", chunk=50))
    assert {tuple(r) for r in qa.merge_audits(parts, rows_of, "arrival", "t", chunk=50).collect()} == got
