"""Registry of the queries and the SQL each one is checked against."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quotegrid.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)  # the session may be anyone's
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# Quotes as in sources/testdata.py.
QUOTES_SQL = """q AS (
  SELECT event_type AS symbol,
         epoch_us(ts)*1000 - ((event_id % 10) - 1)*1000000000 AS ts_ns,
         epoch_us(ts)*1000 AS local_ts_ns,
         event_id AS update_id,
         CAST(value AS DOUBLE) AS bid_price,
         round(value + 0.01*(1 + event_id % 3), 2) AS ask_price,
         CAST(1 + event_id % 50 AS DOUBLE) AS bid_amount,
         CAST(1 + event_id % 40 AS DOUBLE) AS ask_amount,
         CAST(ts AS DATE) AS date
  FROM events),
v AS (SELECT * FROM q WHERE local_ts_ns >= ts_ns),
days AS (SELECT DISTINCT symbol, date FROM q)"""


def session_sql(step_s: int, prev_day: bool, strict: bool = False) -> str:
    """Grid points ``g`` of each symbol-day session and the quote ``a`` in force at each."""
    n = 86400 // step_s * (2 if prev_day else 1)
    back = 1 if prev_day else 0
    sess = (
        "SELECT x.symbol, x.date AS feature_date FROM days x JOIN days y ON x.symbol = y.symbol AND y.date = x.date - 1"
        if prev_day
        else "SELECT symbol, date AS feature_date FROM days"
    )
    op = ">" if strict else ">="
    return f"""{QUOTES_SQL},
s AS (SELECT symbol, feature_date, epoch_us(CAST(feature_date - {back} AS TIMESTAMP))*1000 AS s0 FROM ({sess})),
g AS (SELECT symbol, feature_date, s0, i, s0 + i*{step_s}000000000 AS t FROM s, range({n}) r(i)),
a0 AS (SELECT g.*, v.local_ts_ns, v.bid_price, v.ask_price, v.bid_amount, v.ask_amount
       FROM g ASOF LEFT JOIN v ON g.symbol = v.symbol AND g.t {op} v.local_ts_ns),
a AS (SELECT symbol, feature_date, s0, i, t,
             CASE WHEN local_ts_ns >= s0 THEN local_ts_ns END AS local_ts_ns,
             CASE WHEN local_ts_ns >= s0 THEN bid_price END AS bid_price,
             CASE WHEN local_ts_ns >= s0 THEN ask_price END AS ask_price,
             CASE WHEN local_ts_ns >= s0 THEN bid_amount END AS bid_amount,
             CASE WHEN local_ts_ns >= s0 THEN ask_amount END AS ask_amount
      FROM a0)"""


def std_sql(w: int, ddof: int, keys: str, order: str, at_least: str) -> str:
    frame = f"OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    a = f"CAST(sum(x) {frame} AS DOUBLE)"
    b = f"CAST(sum(x*x) {frame} AS DOUBLE)"
    return f"CASE WHEN {at_least} THEN sqrt(greatest({w}.0::DOUBLE*{b} - {a}*{a}, 0.0)/({100 * w * (w - ddof)}.0::DOUBLE)) END"


def volatility_sql(step_s: int, windows: tuple[int, ...], label: int, ddof: int = 1) -> str:
    """``f``: every point of the two-day sessions with move, volatilities and label."""
    per_min = {m: m * 60 // step_s for m in windows}
    vols = ",\n".join(
        f"{std_sql(w, ddof, 'symbol, feature_date', 'i', f'i >= {w - 1}')} AS vol_{m}m" for m, w in per_min.items()
    )
    ahead = per_min[label]
    return f"""{session_sql(step_s, True)},
m AS (SELECT *, round((ask_price + bid_price)/2/0.01, 1) AS mid_tick FROM a),
c AS (SELECT *, coalesce(mid_tick - lag(mid_tick) OVER (PARTITION BY symbol, feature_date ORDER BY i), 0.0) AS mid_chg FROM m),
x AS (SELECT *, CAST(round(mid_chg*10) AS BIGINT) AS x FROM c),
d AS (SELECT *, {vols} FROM x),
f AS (SELECT *, lead(vol_{label}m, {ahead}) OVER (PARTITION BY symbol, feature_date ORDER BY i) AS y_vol_{label}m FROM d)"""


def ratio_sql(a: int, b: int) -> str:
    s, g = f"vol_{a}m", f"vol_{b}m"
    return (
        f"CASE WHEN {s} IS NULL OR {g} IS NULL THEN NULL WHEN {s} = 0 AND {g} = 0 THEN 1.0 "
        f"WHEN {g} = 0 THEN NULL ELSE {s}/{g} END AS vol_ratio_{a}m_{b}m"
    )


TIME_SQL = """CAST(hour(make_timestamp(t//1000)) AS DOUBLE) AS "hour",
CAST(minute(make_timestamp(t//1000)) AS DOUBLE) AS "minute",
round(sin(2*pi()*(hour(make_timestamp(t//1000))*60 + minute(make_timestamp(t//1000)))/1440), 9) AS tod_sin,
round(cos(2*pi()*(hour(make_timestamp(t//1000))*60 + minute(make_timestamp(t//1000)))/1440), 9) AS tod_cos"""


# Coefficients of algorithm AS 241 (Wichura 1988) for the normal quantile,
# highest power first, numerator then denominator; good for 1e-11 < p < 1 - 1e-11.
NORMAL_CENTRE = (
    (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
     13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.3871328727963666080),
    (5226.4952788528545610, 28729.085735721942674, 39307.895800092710610, 21213.794301586595867,
     5394.1960214247511077, 687.18700749205790830, 42.313330701600911252, 1.0),
)
NORMAL_TAIL = (
    (7.7454501427834140764e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258,
     3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940, 2.05319162663775882187, 1.0),
)


def _poly_sql(coefficients: tuple[float, ...], r: str) -> str:
    out = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        out = f"({out}*{r} + {c!r}::DOUBLE)"
    return out


def normal_quantile_sql(p: str) -> str:
    """Inverse of the normal distribution function for a column strictly between 0 and 1."""
    c = f"(0.180625::DOUBLE - ({p} - 0.5::DOUBLE)*({p} - 0.5::DOUBLE))"
    t = f"(sqrt(-ln(least({p}, 1.0::DOUBLE - {p}))) - 1.6::DOUBLE)"
    centre = f"({p} - 0.5::DOUBLE)*{_poly_sql(NORMAL_CENTRE[0], c)}/{_poly_sql(NORMAL_CENTRE[1], c)}"
    tail = f"{_poly_sql(NORMAL_TAIL[0], t)}/{_poly_sql(NORMAL_TAIL[1], t)}"
    return f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN {centre} WHEN {p} < 0.5 THEN -({tail}) ELSE {tail} END"
