"""Spark data source over the vendor's best-price store, reached by any DB-API 2 driver.

A scan is planned from symbol-days: those it is given, or those that filters on ``symbol`` and ``date`` name. Each
read task asks the store for a few hours of one symbol-day, so a long backfill is many small queries, and
only hours and symbols that the query's filters leave are asked for.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import date, datetime, time, timedelta, timezone
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

FORMAT = "quotegrid_vendor"
ROWS = 8192  # fetched at a time
UNITS = {"s": 1, "ms": 10**3, "us": 10**6, "ns": 10**9}


@dataclass(frozen=True)
class VendorStore:
    """Where the store is and how it keeps times.

    ``module`` is a DB-API 2 driver that executors can import and ``connect`` the arguments of its ``connect``.
    ``time_unit`` is ``datetime`` if the column of receive times holds dates with times (UTC), else the unit of its epochs.
    """

    module: str
    connect: dict[str, Any] = field(default_factory=dict)
    table: str = "perpBestPrice"
    symbol_column: str = "symbol"
    time_column: str = "receiveTime"
    time_unit: str = "datetime"
    hours: int = 4  # of a read task
    exchange: str | None = None

    def __post_init__(self):
        if self.time_unit != "datetime" and self.time_unit not in UNITS:
            raise ValueError(f"unknown time unit {self.time_unit}")
        if not 1 <= self.hours <= 24:
            raise ValueError("a read task covers 1 to 24 hours")

    def open(self):
        return importlib.import_module(self.module).connect(**self.connect)

    def marks(self, names: list[str]) -> tuple[list[str], bool]:
        """A placeholder per name in the driver's style, and whether it takes values by name."""
        style = importlib.import_module(self.module).paramstyle
        marks = {
            "qmark": lambda k, n: "?",
            "numeric": lambda k, n: f":{k + 1}",
            "format": lambda k, n: "%s",
            "named": lambda k, n: f":{n}",
            "pyformat": lambda k, n: f"%({n})s",
        }[style]
        return [marks(k, n) for k, n in enumerate(names)], style in ("named", "pyformat")

    def bound(self, at: datetime) -> str | int:
        if self.time_unit == "datetime":
            return at.strftime("%Y-%m-%d %H:%M:%S")
        return int(at.replace(tzinfo=timezone.utc).timestamp()) * UNITS[self.time_unit]


@dataclass
class Slice(InputPartition):
    """Hours ``first`` to ``last`` of a symbol-day, both included."""

    symbol: str
    day: date
    first: int
    last: int


def _text(value: Any) -> str | None:
    """Dates with times become microseconds of the epoch, other values their text."""
    if isinstance(value, datetime):
        utc = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        return str((utc - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1))
    return None if value is None else str(value)


class VendorReader(DataSourceReader):
    def __init__(self, store: VendorStore, schema: StructType, days: list[tuple[str, date]] | None):
        self.store, self.schema, self.days = store, schema, days
        self.symbols: set[str] | None = None
        self.from_day, self.to_day = date.min, date.max
        self.only_days: set[date] | None = None
        self.from_hour, self.to_hour = 0, 23

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality and ranges of symbol, date and hour; Spark checks all other filters."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if not (name in ("symbol", "date", "hour") and self._take(name, f)):
                yield f

    def _take(self, name: str, f: Filter) -> bool:
        if isinstance(f, EqualTo | EqualNullSafe | In):
            values = set(f.value if isinstance(f, In) else [f.value]) - {None}
            if name == "symbol":
                self.symbols = values if self.symbols is None else self.symbols & values
            elif name == "date":
                self.only_days = values if self.only_days is None else self.only_days & values
            elif len(values) == 1:
                self.from_hour, self.to_hour = max(self.from_hour, *values), min(self.to_hour, *values)
            else:
                return False
            return True
        if name == "symbol" or getattr(f, "value", None) is None:
            return False
        step = timedelta(1) if name == "date" else 1
        at = {"date": ("from_day", "to_day"), "hour": ("from_hour", "to_hour")}[name]
        if isinstance(f, GreaterThan | GreaterThanOrEqual):
            low = f.value + step if isinstance(f, GreaterThan) else f.value
            setattr(self, at[0], max(getattr(self, at[0]), low))
        elif isinstance(f, LessThan | LessThanOrEqual):
            high = f.value - step if isinstance(f, LessThan) else f.value
            setattr(self, at[1], min(getattr(self, at[1]), high))
        else:
            return False
        return True

    def _symbol_days(self) -> list[tuple[str, date]]:
        days = self.days
        if days is None:
            among = self.only_days
            if among is None and self.from_day > date.min and self.to_day < date.max:
                among = {self.from_day + timedelta(k) for k in range((self.to_day - self.from_day).days + 1)}
            if among is None or self.symbols is None:
                raise ValueError("name the symbol-days to read, or filter on symbol and on a span of dates")
            days = [(s, d) for s in self.symbols for d in among]
        return sorted(
            (s, d)
            for s, d in set(days)
            if (self.symbols is None or s in self.symbols)
            and (self.only_days is None or d in self.only_days)
            and self.from_day <= d <= self.to_day
        )

    def partitions(self) -> list[Slice]:
        first = range(self.from_hour, self.to_hour + 1, self.store.hours)
        last = lambda h: min(h + self.store.hours - 1, self.to_hour)
        found = [Slice(s, d, h, last(h)) for s, d in self._symbol_days() for h in first]
        return found or [Slice("", date.min, 1, 0)]  # a scan has a partition at least

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if partition.last < partition.first:
            return
        asked = [f.name for f in self.schema.fields if f.name not in ("symbol", "date", "hour")]
        (symbol, low, high), by_name = self.store.marks(["symbol", "low", "high"])
        sql = (
            f"SELECT {', '.join(asked)} FROM {self.store.table} WHERE {self.store.symbol_column} = {symbol}"
            f" AND {self.store.time_column} >= {low} AND {self.store.time_column} < {high}"
        )
        types = [pa.string(), pa.date32(), pa.int32()] + [pa.string()] * len(asked)
        names = ["symbol", "date", "hour", *asked]
        connection = self.store.open()
        try:
            for hour in range(partition.first, partition.last + 1):
                start = datetime.combine(partition.day, time()) + timedelta(hours=hour)
                values = [partition.symbol, self.store.bound(start), self.store.bound(start + timedelta(hours=1))]
                cursor = connection.cursor()
                cursor.execute(sql, dict(zip(("symbol", "low", "high"), values, strict=True)) if by_name else values)
                while rows := cursor.fetchmany(ROWS):
                    same = [[x] * len(rows) for x in (partition.symbol, partition.day, hour)]
                    columns = same + [[_text(v) for v in c] for c in zip(*rows, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        finally:
            connection.close()


class VendorSource(DataSource):
    """Options: ``store`` (JSON of a ``VendorStore``) and ``days`` (JSON list of symbol and day), which may be left out."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _store(self) -> VendorStore:
        return VendorStore(**json.loads(self.options["store"]))

    def schema(self) -> StructType:
        """The symbol, the UTC day and hour of receipt, and the store's other columns as text."""
        store = self._store()
        connection = store.open()
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT * FROM {store.table} WHERE 1 = 0")
            names = [c[0] for c in cursor.description]
        finally:
            connection.close()
        ahead = [StructField("symbol", StringType()), StructField("date", DateType()), StructField("hour", IntegerType())]
        rest = [n for n in names if n not in (store.symbol_column, "date", "hour")]
        return StructType(ahead + [StructField(n, StringType()) for n in rest])

    def reader(self, schema: StructType) -> VendorReader:
        days = self.options.get("days")
        listed = None if days is None else [(s, date.fromisoformat(d)) for s, d in json.loads(days)]
        return VendorReader(self._store(), schema, listed)


def read_vendor(spark: SparkSession, store: VendorStore, days: list[tuple[str, date]] | None = None) -> DataFrame:
    """Vendor rows with ``symbol``, ``date`` and ``hour``; of these symbol-days only, if they are given."""
    spark.dataSource.register(VendorSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format(FORMAT).option("store", json.dumps(store.__dict__))
    if days is not None:
        reader = reader.option("days", json.dumps([(s, d.isoformat()) for s, d in days]))
    return reader.load()
