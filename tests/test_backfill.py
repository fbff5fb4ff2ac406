"""Raw days that the quotes lack come from the vendor store, once, and are committed as a whole."""

import datetime as dt
import sqlite3

import pytest
from pyspark.sql import functions as F

from brute import DAY, QUOTE_SCHEMA, random_quotes
from quotegrid.jobconfig import JobConfig
from quotegrid.operators import registry as rg
from quotegrid.plans.jobs import Store, build_features, run_production, run_walk_forward
from quotegrid.sources.quotes import QuoteTable, quotes_for
from quotegrid.sources.rawdays import BackfilledQuotes, RawDays, dated_quotes, vendor_fetch
from quotegrid.sources.vendor_source import VendorReader, VendorStore, read_vendor
from test_models import CFG, FEATURES, FIRST, NOW, STEP, day, tasks

COLUMNS = "symbol text, eventTimeUnix integer, receiveTime {time}, askQty real, askPrice real, bidPrice real, bidQty real, exchange integer, updateId integer"


def vendor_file(path, rows, unit="datetime"):
    """A store file with these quotes (as ``random_quotes`` makes them)."""
    con = sqlite3.connect(path)
    con.execute(f"create table perpBestPrice ({COLUMNS.format(time='text' if unit == 'datetime' else 'integer')})")
    for s, ts, local, uid, bid, ask, bid_n, ask_n in rows:
        at = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=local // 1000)
        received = str(at) if unit == "datetime" else local // 1000
        con.execute("insert into perpBestPrice values (?,?,?,?,?,?,?,?,?)", (s, ts // 1000, received, ask_n, ask, bid, bid_n, 0, uid))
    con.commit()
    con.close()
    return VendorStore("sqlite3", {"database": str(path)}, time_unit=unit, hours=6)


@pytest.fixture(scope="module")
def rows():
    found = random_quotes(9, ["a", "b"], 8, 60, STEP)
    # whole microseconds, as the vendor keeps them
    return [(s, ts // 1000 * 1000, at // 1000 * 1000, *rest) for s, ts, at, *rest in found]


@pytest.fixture(scope="module")
def vendor(rows, tmp_path_factory):
    return vendor_file(tmp_path_factory.mktemp("vendor") / "store.db", rows, "us")


def frame(spark, rows):
    return spark.createDataFrame(rows, QUOTE_SCHEMA)


def on(rows, symbol, k):
    first = (FIRST - dt.date(1970, 1, 1)).days
    return [r for r in rows if r[0] == symbol and r[2] // DAY == first + k]


def without(rows, *days):
    gone = {r for s, k in days for r in on(rows, s, k)}
    return [r for r in rows if r not in gone]


def keys(df):
    return sorted(tuple(r) for r in df.select("symbol", "ts_ns", "local_ts_ns", "update_id", "bid_price", "ask_price").collect())


def test_a_scan_opens_the_asked_hours_only(spark, vendor, rows):
    days = [("a", day(2)), ("a", day(3)), ("b", day(3))]
    df = read_vendor(spark, vendor, days)
    assert df.rdd.getNumPartitions() == 3 * 4
    assert df.count() == sum(len(on(rows, s, (d - FIRST).days)) for s, d in days)
    one = df.where((F.col("symbol") == "a") & (F.col("date") >= day(3)) & (F.col("hour") < 8))
    assert one.rdd.getNumPartitions() == 2
    hour = lambda r: r[2] % DAY // 3_600_000_000_000
    assert one.count() == sum(hour(r) < 8 for r in on(rows, "a", 3)) > 0
    assert df.where("symbol = 'c'").count() == 0
    odd = df.where("hour in (1, 5) and updateId is not null")
    assert odd.count() == sum(hour(r) in (1, 5) for s, d in days for r in on(rows, s, (d - FIRST).days))


def test_filters_alone_can_name_the_days(spark, vendor, rows):
    df = read_vendor(spark, vendor)
    span = df.where(F.col("symbol").isin("a", "b") & F.col("date").between(day(1), day(2)))
    assert span.rdd.getNumPartitions() == 2 * 2 * 4
    assert span.count() == sum(len(on(rows, s, k)) for s in "ab" for k in (1, 2))
    with pytest.raises(Exception, match="symbol-days"):
        df.where("symbol = 'a'").count()


def test_times_as_datetimes(spark, rows, tmp_path):
    store = vendor_file(tmp_path / "t.db", on(rows, "a", 1))
    assert read_vendor(spark, store, [("a", day(1)), ("a", day(2))]).count() == len(on(rows, "a", 1))


def test_driver_styles():
    for module, want in (("sqlite3", ["?", "?"]),):
        assert VendorStore(module).marks(["symbol", "low"])[0] == want
    with pytest.raises(ValueError):
        VendorStore("sqlite3", time_unit="weeks")
    reader = VendorReader(VendorStore("sqlite3"), None, [])
    assert len(reader.partitions()) == 1


def test_missing_days_are_fetched_once(spark, rows, vendor, tmp_path):
    asked = []
    fetch = vendor_fetch(vendor, NOW)

    def counted(session, days):
        asked.append(days)
        return fetch(session, days)

    def source():
        kept = frame(spark, without(rows, ("a", 3), ("b", 5)))
        return BackfilledQuotes(QuoteTable(kept, FEATURES.grid), RawDays(str(tmp_path)), counted, NOW)

    wanted = spark.createDataFrame([(s, day(k)) for s in "ab" for k in (3, 4, 5, 6)], "symbol string, feature_date date")
    for _ in range(2):
        got, have = quotes_for(source(), wanted, FEATURES.grid)
        assert keys(got) == keys(frame(spark, [r for s in "ab" for k in (2, 3, 4, 5, 6) for r in on(rows, s, k)]))
        assert have.count() == 10
        assert {(r.symbol, r.date) for r in got.where("source = 'vendor'").select("symbol", "date").distinct().collect()} == {("a", day(3)), ("b", day(5))}
    assert asked == [[("a", day(3)), ("b", day(5))]]


def test_what_was_not_committed_is_not_read(spark, rows, tmp_path):
    days = RawDays(str(tmp_path))
    quotes = frame(spark, on(rows, "a", 2)).withColumn("date", F.lit(day(2))).withColumn("exchange", F.lit("x"))
    raw = spark.createDataFrame([("a", day(2)), ("a", day(3))], "symbol string, date date")
    folder, n = days.stage(quotes)  # and a crash
    assert days.for_days(raw)[0].count() == 0 and days.for_days(raw)[1].count() == 0
    days.commit(days.verify(spark, folder, n), folder, NOW)
    assert keys(days.for_days(raw)[0]) == keys(quotes)
    # another version of the day: staged only, the old one is read; committed, it takes its place as a whole
    folder, n = days.stage(quotes.limit(3))
    assert days.for_days(raw)[0].count() == len(on(rows, "a", 2))
    days.commit(days.verify(spark, folder, n), folder, NOW + dt.timedelta(1))
    assert days.for_days(raw)[0].count() == 3 and [r.rows for r in days.pointers(spark).collect()] == [3]


def test_lost_rows_are_not_committed(spark, rows, tmp_path):
    days = RawDays(str(tmp_path))
    quotes = frame(spark, on(rows, "a", 2)).withColumn("date", F.lit(day(2))).withColumn("exchange", F.lit("x"))
    folder, n = days.stage(quotes)
    with pytest.raises(RuntimeError, match="were written"):
        days.verify(spark, folder, n + 1)
    for f in (tmp_path / "data").rglob("*.parquet"):
        f.write_bytes(b"broken")
    with pytest.raises(Exception):
        days.verify(spark, folder, n)


def test_a_bad_day_does_not_stop_the_others(spark, rows, tmp_path):
    def fetch(session, days):
        if ("a", day(3)) in days:
            raise OSError("the store does not answer")
        vendor = frame(session, [r for s, d in days for r in on(rows, s, (d - FIRST).days)])
        return vendor.withColumn("exchange", F.lit("x")).withColumn("date", F.to_date(F.timestamp_micros(F.expr("local_ts_ns div 1000"))))

    source = BackfilledQuotes(QuoteTable(frame(spark, []), FEATURES.grid), RawDays(str(tmp_path)), fetch, NOW)
    raw = spark.createDataFrame([("a", day(k)) for k in range(1, 6)] + [("nobody", day(1))], "symbol string, date date")
    got, have = source.for_days(raw)
    assert {(r.symbol, r.date) for r in have.collect()} == {("a", day(k)) for k in (1, 2, 4, 5)}
    assert list(source.why) == [("a", day(3))] and "answer" in source.why["a", day(3)]


def test_a_production_run_fetches_a_missing_raw_day(spark, rows, vendor, tmp_path):
    sizes = spark.createDataFrame([("a", 0.01), ("b", 0.01)], "symbol string, tick_size double")
    days = RawDays(str(tmp_path / "raw"))
    kept = QuoteTable(frame(spark, without(rows, ("a", 4))), FEATURES.grid)
    s = Store(str(tmp_path))
    status = run_production(BackfilledQuotes(kept, days, vendor_fetch(vendor, NOW), NOW), ["a", "b"], sizes, day(6), FEATURES, CFG, s, NOW).first()
    assert (status.published, status.exit_code) == (2, 0)
    assert [(r.symbol, r.date) for r in days.pointers(spark).collect()] == [("a", day(4))]
    told = {r.symbol: r for r in spark.read.parquet(s.path("production_summary")).collect()}
    assert set(told) == {"a", "b"} and told["a"]["mode"] == "production" and told["a"].train_dates == [day(3), day(4)] and told["a"].val_dates == [day(5)]
    assert told["a"].validation_metrics.n > 0 and told["a"].path == rg.read_registry(spark, s.path("registry")).where("symbol = 'a'").first().path


def test_a_production_run_with_nothing_to_build_ends_with_2(spark, rows, tmp_path):
    sizes = spark.createDataFrame([("a", 0.01)], "symbol string, tick_size double")
    reasons = {}
    quotes = frame(spark, on(rows, "a", 0))
    status = run_production(quotes, ["a"], sizes, day(6), FEATURES, CFG, Store(str(tmp_path)), NOW, reasons=reasons).first()
    assert (status.trained, status.published, status.exit_code) == (0, 0, 2)
    assert reasons == {"a": "features could not be prepared"}


def test_walk_forward_without_features_reports_every_window(spark, tmp_path):
    spans = spark.createDataFrame([("a", day(4), day(5))], "symbol string, first_day date, last_day date")
    got = run_walk_forward(spans, FEATURES.feature_columns, FEATURES.label_column, CFG, Store(str(tmp_path)), NOW)
    assert set(got) == {"a/0", "a/1"} and all(str(day(3)) in why for why in got.values())


def test_job_settings_name_the_vendor(spark, rows, tmp_path):
    conf = {
        "store": str(tmp_path / "s"),
        "assets": "x",
        "symbols": ["a"],
        "first_day": day(0),
        "last_day": day(5),
        "quote_files": {"primary": str(tmp_path / "none")},
        "vendor": {"module": "sqlite3", "connect": {"database": str(tmp_path / "v.db")}, "time_unit": "us"},
    }
    vendor_file(tmp_path / "v.db", rows, "us")
    quotes = JobConfig.parse(conf).load_quotes(spark, NOW)
    sizes = spark.createDataFrame([("a", 0.01)], "symbol string, tick_size double")
    s = Store(str(tmp_path / "s"))
    assert build_features(quotes, tasks(spark, ["a"], [3]), sizes, FEATURES, s, NOW).count() == 0
    assert {r.date for r in RawDays(s.path("raw_days")).pointers(spark).collect()} == {day(2), day(3)}
    with pytest.raises(ValueError, match="unknown"):
        JobConfig.parse(conf | {"vendor": {"modul": "sqlite3"}})


def test_dated_quotes_take_the_day_of_receipt(spark):
    v = spark.createDataFrame([("a", "1704067199.5", "1704067200.25", "1", "2", "1", "1", "0", "7")], "symbol string, eventTimeUnix string, receiveTime string, askQty string, askPrice string, bidPrice string, bidQty string, exchange string, updateId string")
    r = dated_quotes(v.withColumn("date", F.lit(None).cast("date")), NOW).first()
    assert r.date == dt.date(2024, 1, 1) and r.update_id == 7 and r.exchange == "binance-futures"
