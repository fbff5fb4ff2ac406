"""Integer time arithmetic on nanosecond epochs and civil dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotegrid.config import DAY_NS, GridConfig


def div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("bigint"))


def floor_div(a: Column, b: int) -> Column:
    """Integer division rounding down, also below zero."""
    step = F.lit(b).cast("bigint")
    return div(a - F.pmod(a, step), step)


def day_of_ns(ns: Column, grid: GridConfig) -> Column:
    days = floor_div(ns + F.lit(grid.offset_ns), DAY_NS)
    return F.date_from_unix_date(days.cast("int"))


def day_start_ns(day: Column, grid: GridConfig) -> Column:
    return F.unix_date(day).cast("bigint") * F.lit(DAY_NS) - F.lit(grid.offset_ns)


def session_start_ns(day: Column, grid: GridConfig) -> Column:
    return day_start_ns(day, grid) - F.lit(DAY_NS if grid.use_prev_day else 0)


def session_origin_cell(day: Column, grid: GridConfig) -> Column:
    return div(session_start_ns(day, grid) - F.lit(grid.origin_ns), grid.interval_ns)


def cell_ns(cell: Column, grid: GridConfig) -> Column:
    return cell * F.lit(grid.interval_ns).cast("bigint") + F.lit(grid.origin_ns)


def ntz_to_ns(ts: str) -> Column:
    """Nanosecond epoch of a TIMESTAMP_NTZ column, whatever the session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts}) * 1000")


def time_of_day_columns(ns: Column) -> list[Column]:
    """UTC hour and minute as doubles with their place on the daily circle."""
    sec = F.pmod(div(ns, 1_000_000_000), F.lit(86_400).cast("bigint"))
    hour = div(sec, 3600).cast("double")
    minute = div(F.pmod(sec, F.lit(3600).cast("bigint")), 60).cast("double")
    angle = (F.lit(2.0) * F.pi() * (hour * 60 + minute)) / F.lit(1440.0)
    return [
        hour.alias("hour"),
        minute.alias("minute"),
        F.sin(angle).alias("tod_sin"),
        F.cos(angle).alias("tod_cos"),
    ]
