"""Raw days fetched from the vendor store, committed as a whole, and quotes that fall back to them.

A batch of days is written to a folder of its own, read back and counted. Only then are pointer rows appended, in one
file: symbol, day, folder, rows. Readers find a day through its newest pointer, so it is there as a whole or not at all, and a
day that is fetched again is swapped at once. A batch that was not committed is never read.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quotegrid.session import materialize, small_side
from quotegrid.sources.quotes import QUOTE_COLUMNS, QuoteFiles, QuoteTable, missing_partitions, write_by_symbol_day
from quotegrid.sources.vendor import vendor_to_quotes
from quotegrid.sources.vendor_source import VendorStore, read_vendor

POINTERS = "symbol string, date date, folder string, rows bigint, committed_at timestamp"
QUOTES = f"{QUOTE_COLUMNS}, date date"
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RawDays:
    """Committed raw days below one folder that executors share."""

    root: str

    def pointers(self, spark: SparkSession) -> DataFrame:
        """The pointer in force of every committed day: symbol, date, folder, rows."""
        try:
            rows = spark.read.schema(POINTERS).parquet(f"{self.root}/pointers")
        except AnalysisException:
            rows = spark.createDataFrame([], POINTERS)
        last = F.max(F.struct("committed_at", "folder", "rows")).alias("p")
        return rows.groupBy("symbol", "date").agg(last).select("symbol", "date", "p.folder", "p.rows")

    def stage(self, quotes: DataFrame) -> tuple[str, int]:
        """Write dated quotes to a new folder, which nobody reads yet; returns it and the rows written."""
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        seen = Observation()
        columns = [F.col(c.split()[0]).cast(c.split()[1]) for c in QUOTES.split(", ")]
        counted = quotes.select(*columns).observe(seen, F.count(F.lit(1)).alias("n"))
        write_by_symbol_day(counted, folder, "local_ts_ns", mode="errorifexists")
        return folder, seen.get["n"]

    def verify(self, spark: SparkSession, folder: str, written: int) -> DataFrame:
        """Rows of each day of a staged folder as they are read back; raises if they are not all there."""
        if not written:
            return spark.createDataFrame([], "symbol string, date date, rows bigint")
        rows = self._read(spark, folder, [folder]).groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("rows"))
        rows = materialize(rows, "staged-days")
        found = rows.agg(F.sum("rows")).first()[0]
        if found != written:
            raise RuntimeError(f"{folder}: {written} rows were written, {found} are read")
        return rows

    def commit(self, days: DataFrame, folder: str, now: datetime) -> None:
        """Let these verified days (symbol, date, rows) of a staged folder be the ones that are read."""
        rows = days.select("symbol", "date", F.lit(folder).alias("folder"), "rows", F.lit(now).alias("committed_at"))
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/pointers")

    def add(self, quotes: DataFrame, now: datetime) -> None:
        """Stage, verify and commit the days of dated quotes."""
        folder, written = self.stage(quotes)
        days = self.verify(quotes.sparkSession, folder, written)
        if written:
            self.commit(days, folder, now)

    @staticmethod
    def _read(spark: SparkSession, folder: str, paths: Sequence[str]) -> DataFrame:
        return spark.read.schema(QUOTES).option("basePath", folder).parquet(*paths)

    def for_days(self, raw: DataFrame, spark: SparkSession | None = None) -> tuple[DataFrame, DataFrame]:
        """Quotes of the committed ones of the ``(symbol, date)`` days, and these days; other days' files are not opened."""
        spark = spark or raw.sparkSession
        have = materialize(self.pointers(spark).join(raw, ["symbol", "date"], "left_semi"), "raw-days")
        by_folder: dict[str, list[str]] = {}
        for r in have.collect():  # folders of the asked days only; a scan needs them in the driver anyway
            by_folder.setdefault(r["folder"], []).append(f"{r['folder']}/symbol={r['symbol']}/date={r['date']}")
        quotes = spark.createDataFrame([], QUOTES)
        for folder, paths in sorted(by_folder.items()):
            quotes = quotes.unionByName(self._read(spark, folder, sorted(paths)))
        return quotes, have.select("symbol", "date")


def vendor_fetch(store: VendorStore, now: datetime) -> Callable[[SparkSession, list[tuple[str, date]]], DataFrame]:
    """Dated quotes of symbol-days from the vendor store."""

    def fetch(spark: SparkSession, days: list[tuple[str, date]]) -> DataFrame:
        return dated_quotes(read_vendor(spark, store, days).drop("hour"), now, store.exchange)

    return fetch


def dated_quotes(vendor: DataFrame, now: datetime, exchange: str | None = None) -> DataFrame:
    """Standard quotes of vendor rows, with the UTC day they were received on."""
    micros = int((now - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    quotes = vendor_to_quotes(vendor.drop("date"), micros, exchange)
    return quotes.withColumn("date", F.date_from_unix_date(F.floor(F.col("local_ts_ns") / 86_400_000_000_000).cast("int")))


class BackfilledQuotes:
    """Quotes of a primary source. Days it lacks are fetched once, committed, and read from there ever after.

    A day that cannot be fetched stays missing and does not keep others from being fetched: after ``attempts`` a batch
    that fails is cut in halves. ``why`` tells what went wrong with single days.
    """

    def __init__(
        self,
        primary: DataFrame | QuoteFiles | QuoteTable,
        days: RawDays,
        fetch: Callable[[SparkSession, list[tuple[str, date]]], DataFrame] | None,
        now: datetime,
        attempts: int = 2,
    ):
        self.sparkSession = primary.sparkSession
        self.primary = QuoteTable(primary) if isinstance(primary, DataFrame) else primary
        self.days, self.fetch, self.now, self.attempts = days, fetch, now, attempts
        self.why: dict[tuple[str, date], str] = {}

    def for_days(self, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Quotes of the days, with their ``source``, and which of the days are there."""
        spark = self.sparkSession
        raw = materialize(raw.select("symbol", "date").distinct(), "raw-asked")
        files, have = self.primary.for_days(raw)
        have = materialize(have.select("symbol", "date").distinct(), "raw-there")
        lacking = materialize(missing_partitions(raw, have), "raw-lacking")
        if self.fetch is not None:
            absent = missing_partitions(lacking, self.days.pointers(spark))
            self._backfill(sorted((r["symbol"], r["date"]) for r in absent.collect()))
        fetched, more = self.days.for_days(lacking, spark)
        both = files.withColumn("source", F.lit("files")).unionByName(
            fetched.withColumn("source", F.lit("vendor")), allowMissingColumns=True
        )
        return both, have.unionByName(more)

    def _backfill(self, days: list[tuple[str, date]]) -> None:
        if not days:
            return
        for attempt in range(self.attempts):
            try:
                wanted = small_side(self.sparkSession.createDataFrame(days, "symbol string, date date"))
                quotes = self.fetch(self.sparkSession, days).join(wanted, ["symbol", "date"], "left_semi")
                self.days.add(quotes, self.now)
                return
            except Exception as exc:  # one bad day must not stop the others
                log.warning("fetching %d raw days failed (attempt %d of %d): %s", len(days), attempt + 1, self.attempts, exc)
                why = str(exc)
        if len(days) == 1:
            self.why[days[0]] = why
            return
        half = len(days) // 2
        self._backfill(days[:half])
        self._backfill(days[half:])
