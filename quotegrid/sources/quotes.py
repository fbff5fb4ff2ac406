"""Quote files and tables: scan, source choice, day layout, sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotegrid.config import GridConfig
from quotegrid.functions.time import day_of_ns, div
from quotegrid.session import materialize, small_side

QUOTE_CSV_SCHEMA = T.StructType(
    [
        T.StructField("exchange", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("local_timestamp", T.LongType()),
        T.StructField("ask_amount", T.DoubleType()),
        T.StructField("ask_price", T.DoubleType()),
        T.StructField("bid_price", T.DoubleType()),
        T.StructField("bid_amount", T.DoubleType()),
    ]
)

QUOTE_COLUMNS = (
    "exchange string, symbol string, ts_ns bigint, local_ts_ns bigint, update_id bigint, bid_price double,"
    " ask_price double, bid_amount double, ask_amount double"
)

# Name of a symbol-day quote file and the order in which candidates are tried.
QUOTE_FILE_PATTERN = r"binance-futures_book_ticker_(\d{4}-\d{2}-\d{2})_([^/]+?)(\.csv\.zst|\.csv\.gz)$"
SOURCE_ORDER = (("primary", ".csv.zst"), ("primary", ".csv.gz"), ("fallback", ".csv.zst"), ("fallback", ".csv.gz"))

# A day's rows are written by several tasks, cut by time, so no symbol-day is one task.
WRITE_SLICE_NS = 4 * 3_600_000_000_000


def read_quote_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Scan quote CSV files (plain, gzip or zstd); microseconds become nanoseconds.

    A file whose header names other columns, or in another order, is an error and never bound by position.
    """
    raw = spark.read.schema(QUOTE_CSV_SCHEMA).option("header", True).option("enforceSchema", False).csv(paths)
    return raw.select(
        "exchange",
        "symbol",
        (F.col("timestamp") * 1000).alias("ts_ns"),
        (F.col("local_timestamp") * 1000).alias("local_ts_ns"),
        F.lit(None).cast("bigint").alias("update_id"),
        "bid_price",
        "ask_price",
        "bid_amount",
        "ask_amount",
    )


def source_priority(root: Column, extension: Column) -> Column:
    out = F.lit(None).cast("int")
    for rank, (name, ext) in reversed(list(enumerate(SOURCE_ORDER))):
        out = F.when((root == name) & (extension == ext), rank).otherwise(out)
    return out


def list_quote_files(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Manifest ``symbol, date, priority, path`` of the quote files below each root.

    A root that does not exist has no files; a root of another name is an error.
    """
    known = {name for name, _ in SOURCE_ORDER}
    if unknown := set(roots) - known:
        raise ValueError(f"unknown quote roots {sorted(unknown)}; known are {sorted(known)}")
    parts = [spark.createDataFrame([], "path string, root string")]
    for name, path in roots.items():
        try:
            files = (
                spark.read.format("binaryFile")
                .option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*_book_ticker_*")
                .load(path)
            )
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        parts.append(files.select("path", F.lit(name).alias("root")))
    listing = parts[0]
    for p in parts[1:]:
        listing = listing.unionByName(p)
    part = [F.regexp_extract("path", QUOTE_FILE_PATTERN, k) for k in (1, 2, 3)]
    return listing.select(
        part[1].alias("symbol"),
        part[0].try_cast("date").alias("date"),
        source_priority(F.col("root"), part[2]).alias("priority"),
        "path",
    ).where("priority is not null and date is not null")


def resolve_sources(manifest: DataFrame) -> DataFrame:
    """Best candidate per ``(symbol, date)``: lowest priority number, then path."""
    best = F.min(F.struct("priority", "path")).alias("best")
    return manifest.groupBy("symbol", "date").agg(best).select("symbol", "date", "best.priority", "best.path")


class QuoteFiles:
    """Quote files below some roots; a job opens those of the raw days it needs.

    The listing is read once and kept as a small table.
    """

    def __init__(self, spark: SparkSession, roots: dict[str, str], may_be_empty: bool = False):
        self.sparkSession = spark
        self.best = materialize(resolve_sources(list_quote_files(spark, roots)), "quote-files")
        if not may_be_empty and self.best.isEmpty():
            raise FileNotFoundError(f"no quote files below {sorted(roots.values())}")

    def for_days(self, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Quotes of the ``(symbol, date)`` days, and which of the days have a file."""
        have = materialize(self.best.join(raw, ["symbol", "date"], "left_semi"), "quote-files")
        # file names of the asked days only; a scan needs them in the driver anyway
        paths = [r["path"] for r in have.select("path").orderBy("path").collect()]
        if not paths:
            return self.sparkSession.createDataFrame([], QUOTE_COLUMNS), have
        return read_quote_files(self.sparkSession, paths), have


def missing_partitions(required: DataFrame, present: DataFrame) -> DataFrame:
    return required.join(present.select("symbol", "date").distinct(), ["symbol", "date"], "left_anti")


def with_day(quotes: DataFrame, grid: GridConfig) -> DataFrame:
    return quotes.withColumn("date", day_of_ns(F.col("local_ts_ns"), grid))


def serve_feature_days(quotes: DataFrame, grid: GridConfig) -> DataFrame:
    """Each quote once per feature date it is loaded for: its own day and, if asked, the next."""
    days = F.array("date", F.date_add("date", 1)) if grid.use_prev_day else F.array("date")
    return with_day(quotes, grid).withColumn("feature_date", F.explode(days))


class QuoteTable:
    """Quotes of a table, which should have a ``date`` column it is partitioned by, or it is scanned as a whole.

    Days with a row are there, unless ``present`` (symbol, date) says which.
    """

    def __init__(self, quotes: DataFrame, grid: GridConfig = GridConfig(), present: DataFrame | None = None):
        self.sparkSession, self.present = quotes.sparkSession, present
        self.quotes = quotes if "date" in quotes.columns else with_day(quotes, grid)

    def for_days(self, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = self.quotes.join(small_side(raw), ["symbol", "date"], "left_semi")
        there = rows.select("symbol", "date").distinct() if self.present is None else self.present.join(raw, ["symbol", "date"], "left_semi")
        return rows, there


def quotes_for(quotes, tasks: DataFrame, grid: GridConfig) -> tuple[DataFrame, DataFrame]:
    """Quotes of the raw days that the ``(symbol, feature_date)`` tasks need, and the days that are there.

    ``quotes`` is a table or something with ``for_days``: of quote files only those days' files are opened.
    """
    days = [F.col("feature_date"), F.date_sub("feature_date", 1)] if grid.use_prev_day else [F.col("feature_date")]
    raw = tasks.select("symbol", F.explode(F.array(*days)).alias("date")).distinct()
    if isinstance(quotes, DataFrame):
        return QuoteTable(quotes, grid).for_days(raw)
    rows, have = quotes.for_days(raw)
    return with_day(rows, grid).join(small_side(raw), ["symbol", "date"], "left_semi"), have.select("symbol", "date")


def write_by_symbol_day(df: DataFrame, path: str, time_col: str, mode: str = "overwrite", date_col: str = "date") -> None:
    """Parquet in ``symbol``/day folders; an overwrite replaces only the days it holds.

    A rebalance lets AQE split what is still too large for one file and join what is too small.
    """
    sliced = df.withColumn("_slice", div(F.col(time_col), WRITE_SLICE_NS))
    (
        sliced.hint("rebalance", F.col("symbol"), F.col(date_col), F.col("_slice"))
        .sortWithinPartitions("symbol", date_col, time_col)
        .drop("_slice")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("symbol", date_col)
        .parquet(path)
    )


def write_quote_csv(quotes: DataFrame, path: str) -> None:
    """Gzip CSV in the vendor file layout (Spark writes no zstd CSV), cut by time of day."""
    sliced = quotes.withColumn("_slice", div(F.col("local_ts_ns"), WRITE_SLICE_NS))
    (
        sliced.repartition("symbol", "_slice")
        .sortWithinPartitions("ts_ns", "local_ts_ns")
        .select(
            "exchange",
            "symbol",
            div(F.col("ts_ns"), 1000).alias("timestamp"),
            div(F.col("local_ts_ns"), 1000).alias("local_timestamp"),
            "ask_amount",
            "ask_price",
            "bid_price",
            "bid_amount",
        )
        .write.mode("overwrite")
        .option("header", True)
        .option("compression", "gzip")
        .csv(path)
    )


def read_partition(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table written by day; with a schema nothing is inferred from the files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)
