"""Mixed-unit epochs and exchange codes of vendor rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number below each bound is in seconds, milliseconds, microseconds; at or above the last, nanoseconds.
SECONDS_BELOW = 10**11
MILLIS_BELOW = 10**14
MICROS_BELOW = 10**17

# Names of the exchange codes.
DEFAULT_EXCHANGE = "binance-futures"
UNKNOWN_EXCHANGE = "unknown"


def epoch_to_micros(value: Column) -> Column:
    """Microseconds from an epoch whose unit is told by its size; null if not a number.

    Decimal arithmetic keeps all digits of a nanosecond epoch.
    """
    v = value.try_cast("decimal(30,6)")
    return (
        F.when(v < SECONDS_BELOW, F.bround(v * 1_000_000, 0))
        .when(v < MILLIS_BELOW, F.bround(v * 1_000, 0))
        .when(v < MICROS_BELOW, F.bround(v, 0))
        .otherwise(F.floor(v / 1_000))
        .cast("bigint")
    )


def exchange_name(code: Column | None, override: str | None = None) -> Column:
    """Exchange of a vendor row: the override, else by code, else the default if there is no code column."""
    if override:
        return F.lit(override)
    if code is None:
        return F.lit(DEFAULT_EXCHANGE)
    text = code.cast("string")
    return F.when(text.isNull(), UNKNOWN_EXCHANGE).when(text == "0", DEFAULT_EXCHANGE).otherwise(text)
