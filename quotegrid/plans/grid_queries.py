"""Queries of the sampled grid: as-of, moves, volatilities, labels, features, scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.config import MINUTE_NS, FeatureConfig, GridConfig
from quotegrid.functions.time import time_of_day_columns
from quotegrid.operators import features as ft
from quotegrid.operators.asof import QUOTE_FIELDS, asof_sample, sessions_of, valid_quotes
from quotegrid.operators.metrics import downsample_last, evaluate, merge_states, score_states, scores_of
from quotegrid.operators.quality import drop_null_rows
from quotegrid.operators.quantiles import (
    EDGE,
    NORMAL_LIMIT,
    describe,
    exact_quantiles,
    normal_score,
    quantile_steps,
    uniform_score,
    with_steps,
    with_values,
)
from quotegrid.session import materialize
from quotegrid.operators.rolling import mid_price, mid_tick
from quotegrid.plans.catalog import (
    QUOTES_SQL,
    TIME_SQL,
    normal_quantile_sql,
    query,
    ratio_sql,
    session_sql,
    std_sql,
    volatility_sql,
)
from quotegrid.sources.assets import join_tick_size
from quotegrid.sources.testdata import quotes, with_assets

STEP_S = 300
DAY_GRID = GridConfig(STEP_S * 10**9, use_prev_day=False)
FINE = FeatureConfig(GridConfig(60 * 10**9), (5, 15, 30, 60, 120), 15)
COARSE = FeatureConfig(GridConfig(STEP_S * 10**9), (15, 30, 60, 120), 30)
WARM = FeatureConfig(COARSE.grid, COARSE.vol_windows, COARSE.label_window, warmup_minutes=90)
LIVE_WARMUP_MINUTES = 60
TICK_SIZE = 0.01
COARSE_SQL = volatility_sql(STEP_S, COARSE.vol_windows, COARSE.label_window)
WHOLE_SQL = f"bid_price IS NOT NULL AND ask_price IS NOT NULL AND bid_amount IS NOT NULL AND ask_amount IS NOT NULL"
TODAY_SQL = f"i >= {86400 // STEP_S}"
KEPT_SQL = f"{TODAY_SQL} AND {WHOLE_SQL} AND y_vol_30m IS NOT NULL"


def nan_to_null(df: DataFrame, columns) -> DataFrame:
    """Let results with NaN be compared as null."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


def sized_sessions(q: DataFrame, cfg: FeatureConfig) -> DataFrame:
    return sessions_of(q, cfg.grid).withColumn("tick_size", F.lit(TICK_SIZE))


def sampled(spark: SparkSession, sf: str, cfg: FeatureConfig = COARSE, ddof: int = 1) -> DataFrame:
    q = quotes(spark, sf)
    return ft.sampled_volatility(q, sized_sessions(q, cfg), cfg, ddof)


def features(spark: SparkSession, sf: str, cfg: FeatureConfig = COARSE) -> DataFrame:
    q = quotes(spark, sf)
    return ft.feature_matrix(q, sized_sessions(q, cfg), cfg)


def persistence(spark: SparkSession, sf: str) -> DataFrame:
    """The volatility of now as the forecast; on full hours the forecast is missing (NaN)."""
    f = features(spark, sf)
    pred = F.when(F.col("minute") == 0, F.lit(float("nan"))).otherwise(F.col("vol_30m"))
    return f.select("symbol", "feature_date", "timestamp", F.col("y_vol_30m").alias("y_true"), pred.alias("y_pred"))


PERSISTENCE_SQL = f"""{COARSE_SQL},
p AS (SELECT symbol, feature_date, t, y_vol_30m AS y,
             CASE WHEN t % 3600000000000 = 0 THEN NULL ELSE vol_30m END AS p
      FROM f WHERE {KEPT_SQL})"""
QLIKE_SQL = """CASE WHEN p = 0 THEN 'NaN'::DOUBLE WHEN y = 0 THEN 'Infinity'::DOUBLE ELSE y/p - ln(y/p) - 1 END"""


def finite(df: DataFrame, name: str) -> DataFrame:
    """Split a score into its kind and its value, null unless finite."""
    c = F.col(name)
    kind = F.when(F.isnan(c), "nan").when(F.abs(c) == float("inf"), "inf").otherwise("finite")
    return df.withColumn(f"{name}_kind", kind).withColumn(
        name, F.when(F.col(f"{name}_kind") == "finite", F.round(c, 6))
    )


def finite_sql(expr: str, name: str) -> str:
    return (
        f"CASE WHEN isnan({expr}) THEN 'nan' WHEN isinf({expr}) THEN 'inf' ELSE 'finite' END AS {name}_kind, "
        f"CASE WHEN isfinite({expr}) THEN round({expr}, 6) END AS {name}"
    )


# --- filters and scalar columns -------------------------------------------------------


@query(
    "valid_quotes",
    f"WITH {QUOTES_SQL} SELECT symbol, ts_ns, local_ts_ns, update_id, bid_price, ask_price FROM v",
)
def valid_quotes_query(spark, sf):
    cols = ("symbol", "ts_ns", "local_ts_ns", "update_id", "bid_price", "ask_price")
    return valid_quotes(quotes(spark, sf)).select(*cols)


@query("mid_price", f"WITH {QUOTES_SQL} SELECT symbol, update_id, (ask_price + bid_price)/2 AS mid_price FROM q")
def mid_price_query(spark, sf):
    return quotes(spark, sf).select("symbol", "update_id", mid_price().alias("mid_price"))


ASSETS_SQL = """assets AS (SELECT * FROM (VALUES ('click', 0.01::DOUBLE, 1.0::DOUBLE), ('purchase', 0.05, 0.1), ('view', 0.005, 0.001),
 ('signup', 0.25, 10.0)) t(symbol, tick_size, lot_size))"""


@query(
    "mid_tick",
    f"""WITH {QUOTES_SQL}, {ASSETS_SQL}
    SELECT symbol, update_id, tick_size, round((ask_price + bid_price)/2/tick_size, 1) AS mid_tick FROM q JOIN assets USING (symbol)""",
)
def mid_tick_query(spark, sf):
    q = join_tick_size(quotes(spark, sf), with_assets(spark, sf))
    return q.select("symbol", "update_id", "tick_size", mid_tick(mid_price(), F.col("tick_size")).alias("mid_tick"))


@query("time_features", f"WITH {QUOTES_SQL} SELECT symbol, update_id, {TIME_SQL} FROM (SELECT *, local_ts_ns AS t FROM q)")
def time_features_query(spark, sf):
    out = quotes(spark, sf).select("symbol", "update_id", *time_of_day_columns(F.col("local_ts_ns")))
    return out.withColumns({c: F.round(c, 9) for c in ("tod_sin", "tod_cos")})


@query(
    "null_filter",
    f"""WITH {QUOTES_SQL} SELECT symbol, update_id, ask_price,
      CASE WHEN update_id % 13 = 0 THEN NULL ELSE bid_price END AS bid_price, update_id % 13 = 0 AS price_is_nan
    FROM q WHERE NOT update_id % 11 = 0""",
)
def null_filter_query(spark, sf):
    """Rows with a null amount go, rows with a NaN price stay."""
    uid = F.col("update_id")
    q = quotes(spark, sf).withColumns(
        {
            "bid_amount": F.when(uid % 11 != 0, F.col("bid_amount")),
            "bid_price": F.when(uid % 13 == 0, F.lit(float("nan"))).otherwise(F.col("bid_price")),
        }
    )
    kept = drop_null_rows(q, ["ts_ns", "local_ts_ns", *QUOTE_FIELDS])
    kept = kept.select("symbol", "update_id", "ask_price", "bid_price", F.isnan("bid_price").alias("price_is_nan"))
    return nan_to_null(kept, ["bid_price"])


# --- as-of sampling -------------------------------------------------------------------

ASOF_COLUMNS = "symbol, feature_date, t AS \"timestamp\", local_ts_ns, bid_price, ask_price, bid_amount, ask_amount"


@query("asof_sample", f"WITH {session_sql(STEP_S, False)} SELECT {ASOF_COLUMNS} FROM a")
def asof_sample_query(spark, sf):
    q = quotes(spark, sf)
    return asof_sample(q, sessions_of(q, DAY_GRID), DAY_GRID)


def quotes_on_grid(spark, sf) -> DataFrame:
    """Quotes moved back onto grid instants, the newest per instant."""
    q = valid_quotes(quotes(spark, sf))
    lts = F.col("local_ts_ns") - F.pmod("local_ts_ns", F.lit(STEP_S * 10**9))
    newest = F.max_by(F.struct(*QUOTE_FIELDS), "update_id").alias("b")
    g = q.withColumn("lts", lts).groupBy("symbol", "lts").agg(F.max("update_id").alias("update_id"), newest)
    return g.select("symbol", F.col("lts").alias("ts_ns"), F.col("lts").alias("local_ts_ns"), "update_id", "b.*")


ON_GRID_SQL = f"""q0 AS (SELECT *, local_ts_ns - local_ts_ns % {STEP_S}000000000 AS lts FROM v),
q1 AS (SELECT symbol, lts, max(update_id) AS update_id FROM q0 GROUP BY ALL),
"""


def strict_sql() -> str:
    body = session_sql(STEP_S, False, strict=True)
    base, rest = body.split("\ns AS (", 1)
    on_grid = f"""og AS (SELECT q0.symbol, q0.lts AS local_ts_ns, q0.bid_price, q0.ask_price, q0.bid_amount, q0.ask_amount
      FROM q0 JOIN q1 ON q0.symbol = q1.symbol AND q0.lts = q1.lts AND q0.update_id = q1.update_id)"""
    rest = rest.replace("ASOF LEFT JOIN v ON", "ASOF LEFT JOIN og v ON")
    return f"WITH {base}\n{ON_GRID_SQL}{on_grid},\ns AS ({rest} SELECT {ASOF_COLUMNS} FROM a"


@query("asof_sample_strict", strict_sql())
def asof_sample_strict_query(spark, sf):
    q = quotes_on_grid(spark, sf)
    return asof_sample(q, sessions_of(quotes(spark, sf), DAY_GRID), DAY_GRID, strict=True)


@query(
    "asof_with_staleness",
    f"""WITH {session_sql(STEP_S, False)}, st AS (SELECT *, t - local_ts_ns <= 1800000000000 AS fresh FROM a)
    SELECT symbol, feature_date, t AS "timestamp", CASE WHEN fresh THEN local_ts_ns END AS local_ts_ns,
     CASE WHEN fresh THEN bid_price END AS bid_price, CASE WHEN fresh THEN ask_price END AS ask_price,
     CASE WHEN fresh THEN bid_amount END AS bid_amount, CASE WHEN fresh THEN ask_amount END AS ask_amount FROM st""",
)
def asof_with_staleness_query(spark, sf):
    q = quotes(spark, sf)
    return asof_sample(q, sessions_of(q, DAY_GRID), DAY_GRID, max_staleness_ns=30 * MINUTE_NS)


@query(
    "time_grid",
    f"""WITH {session_sql(STEP_S, True)} SELECT symbol, feature_date, count(*) AS points, min(t) AS first_ns, max(t) AS last_ns,
    count(DISTINCT t) AS distinct_points FROM g GROUP BY ALL""",
)
def time_grid_query(spark, sf):
    from quotegrid.operators.asof import time_grid

    g = time_grid(sessions_of(quotes(spark, sf), COARSE.grid), COARSE.grid)
    return g.groupBy("symbol", "feature_date").agg(
        F.count(F.lit(1)).alias("points"),
        F.min("timestamp").alias("first_ns"),
        F.max("timestamp").alias("last_ns"),
        F.count_distinct("timestamp").alias("distinct_points"),
    )


# --- moves, volatilities, labels ------------------------------------------------------


@query(
    "mid_change",
    f'WITH {COARSE_SQL} SELECT symbol, feature_date, t AS "timestamp", mid_tick, mid_chg FROM f WHERE {TODAY_SQL}',
)
def mid_change_query(spark, sf):
    return sampled(spark, sf).select("symbol", "feature_date", "timestamp", "mid_tick", "mid_chg")


VOLS_SQL = ", ".join(COARSE.vol_columns)


@query("rolling_vol", f'WITH {COARSE_SQL} SELECT symbol, feature_date, t AS "timestamp", {VOLS_SQL} FROM f WHERE {TODAY_SQL}')
def rolling_vol_query(spark, sf):
    out = sampled(spark, sf).select("symbol", "feature_date", "timestamp", *COARSE.vol_columns)
    return nan_to_null(out, COARSE.vol_columns)


@query(
    "label_lead",
    f'WITH {COARSE_SQL} SELECT symbol, feature_date, t AS "timestamp", vol_30m, y_vol_30m FROM f WHERE {TODAY_SQL}',
)
def label_lead_query(spark, sf):
    out = sampled(spark, sf).select("symbol", "feature_date", "timestamp", "vol_30m", "y_vol_30m")
    return nan_to_null(out, ["vol_30m", "y_vol_30m"])


RATIOS_SQL = ", ".join(ratio_sql(a, b) for a, b in COARSE.ratio_pairs)


@query("vol_ratios", f'WITH {COARSE_SQL} SELECT symbol, feature_date, t AS "timestamp", {RATIOS_SQL} FROM f WHERE {TODAY_SQL}')
def vol_ratios_query(spark, sf):
    out = sampled(spark, sf).select("symbol", "feature_date", "timestamp", *ft.ratio_columns(COARSE))
    return nan_to_null(out, out.columns[3:])


def matrix_sql(step_s: int, cfg: FeatureConfig, where: str) -> str:
    ratios = ", ".join(ratio_sql(a, b) for a, b in cfg.ratio_pairs)
    return f"""WITH {volatility_sql(step_s, cfg.vol_windows, cfg.label_window)}
    SELECT symbol, feature_date, t AS "timestamp", {", ".join(cfg.vol_columns)}, {ratios}, {TIME_SQL}, {cfg.label_column}
    FROM f WHERE {where} AND {WHOLE_SQL} AND {cfg.label_column} IS NOT NULL"""


def compared_matrix(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    df = df.withColumns({c: F.round(c, 9) for c in ("tod_sin", "tod_cos")})
    return nan_to_null(df, [*cfg.feature_columns, cfg.label_column])


@query("feature_matrix", matrix_sql(60, FINE, "i >= 1440"))
def feature_matrix_query(spark, sf):
    return compared_matrix(features(spark, sf, FINE), FINE)


@query(
    "day_trim",
    f"""WITH {COARSE_SQL} SELECT symbol, feature_date, count(*) AS rows, min(t) AS first_ns, max(t) AS last_ns
    FROM f WHERE {KEPT_SQL} GROUP BY ALL""",
)
def day_trim_query(spark, sf):
    return features(spark, sf).groupBy("symbol", "feature_date").agg(
        F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_ns"), F.max("timestamp").alias("last_ns")
    )


@query("warmup_trim", matrix_sql(STEP_S, WARM, f"i >= {86400 // STEP_S + 90 * 60 // STEP_S}"))
def warmup_trim_query(spark, sf):
    return compared_matrix(features(spark, sf, WARM), WARM)


# --- live form ------------------------------------------------------------------------

LIVE_WINDOWS = {m: m * 60 // STEP_S for m in COARSE.vol_windows}
LIVE_SQL = f"""{QUOTES_SQL},
e AS (SELECT symbol, min((local_ts_ns + {STEP_S}000000000 - 1)//{STEP_S}000000000) AS c0,
             (max(local_ts_ns)//86400000000000 + 1)*{86400 // STEP_S} - 1 AS c1
      FROM v GROUP BY symbol),
g AS (SELECT symbol, c0, unnest(range(c0, c1 + 1)) AS c FROM e),
a AS (SELECT g.symbol, g.c, g.c - g.c0 + 1 AS samples, g.c*{STEP_S}000000000 AS t, round((ask_price + bid_price)/2/0.01, 1) AS mid_tick
      FROM g ASOF JOIN v ON g.symbol = v.symbol AND g.c*{STEP_S}000000000 >= v.local_ts_ns),
x AS (SELECT *, CAST(round(10*coalesce(mid_tick - lag(mid_tick) OVER (PARTITION BY symbol ORDER BY c), 0.0)) AS BIGINT) AS x FROM a),
live AS (SELECT symbol, t, samples, samples >= {LIVE_WARMUP_MINUTES * 60 // STEP_S} AS warm, mid_tick,
  {", ".join(f"{std_sql(w, 0, 'symbol', 'c', f'samples >= {w}')} AS vol_{m}m" for m, w in LIVE_WINDOWS.items())} FROM x)"""


def live(spark, sf) -> DataFrame:
    q = quotes(spark, sf)
    sizes = q.select("symbol").distinct().withColumn("tick_size", F.lit(TICK_SIZE))
    return ft.live_volatility(q, sizes, COARSE, LIVE_WARMUP_MINUTES)


@query("rolling_vol_pop", f'WITH {LIVE_SQL} SELECT symbol, t AS "timestamp", mid_tick, {VOLS_SQL} FROM live')
def rolling_vol_pop_query(spark, sf):
    out = live(spark, sf).select("symbol", "timestamp", "mid_tick", *COARSE.vol_columns)
    return nan_to_null(out, COARSE.vol_columns)


@query("warmup_status", f'WITH {LIVE_SQL} SELECT symbol, t AS "timestamp", samples, warm FROM live')
def warmup_status_query(spark, sf):
    return live(spark, sf).select("symbol", "timestamp", "samples", "warm")


# --- downsampling, scores, summaries --------------------------------------------------


@query(
    "downsample_last",
    f"""WITH {COARSE_SQL}, k AS (SELECT *, t//3600000000000*3600000000000 AS b FROM f WHERE {KEPT_SQL})
    SELECT symbol, feature_date, b AS "timestamp", arg_max(coalesce(vol_120m, -1), t) AS vol_120m, arg_max(y_vol_30m, t) AS y_vol_30m
    FROM k GROUP BY symbol, feature_date, b""",
)
def downsample_last_query(spark, sf):
    f = features(spark, sf).select("symbol", "feature_date", "timestamp", "vol_120m", "y_vol_30m")
    out = downsample_last(f, 60 * MINUTE_NS, keys=("symbol", "feature_date"))
    return out.withColumn("vol_120m", F.nanvl("vol_120m", F.lit(-1.0)))




def scores_sql(keys: str) -> str:
    q = f"avg({QLIKE_SQL})"
    return f"""WITH {PERSISTENCE_SQL}, k AS (SELECT * FROM p WHERE p IS NOT NULL)
    SELECT {keys}, count(*) AS n, round(sqrt(avg((y-p)*(y-p))), 6) AS rmse, round(avg(abs(y-p)), 6) AS mae,
      CASE WHEN count(*) > 1 AND stddev_pop(y)*stddev_pop(p) > 0
           THEN round(covar_pop(y, p)/(stddev_pop(y)*stddev_pop(p)), 6) END AS corr, {finite_sql(q, "qlike")}
    FROM k GROUP BY {keys}"""


def scored(df: DataFrame, keys) -> DataFrame:
    out = nan_to_null(evaluate(df, keys), ["corr"])
    return finite(out.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "corr")}), "qlike")


@query("eval_metrics", scores_sql("symbol"))
def eval_metrics_query(spark, sf):
    return scored(persistence(spark, sf), ["symbol"])


@query("metrics_by_day", scores_sql("symbol, feature_date"))
def metrics_by_day_query(spark, sf):
    return scored(persistence(spark, sf), ["symbol", "feature_date"])


@query(
    "qlike",
    f"""WITH {PERSISTENCE_SQL} SELECT symbol, hour(make_timestamp(t//1000)) AS hour, count(p) AS n,
    {finite_sql(f"avg({QLIKE_SQL})", "qlike")} FROM p WHERE p IS NOT NULL AND y > 0 AND p > 0 GROUP BY ALL""",
)
def qlike_query(spark, sf):
    p = persistence(spark, sf).where("y_true > 0 and y_pred > 0 and not isnan(y_pred)")
    p = p.withColumn("hour", F.expr("cast(pmod(timestamp div 3600000000000, 24L) as bigint)"))
    return finite(evaluate(p, ["symbol", "hour"]).select("symbol", "hour", "n", "qlike"), "qlike")


@query(
    "persistence_metrics",
    f"""WITH {COARSE_SQL} SELECT symbol, count(*) AS n, round(sqrt(avg((y_vol_30m - vol_30m)*(y_vol_30m - vol_30m))), 6) AS rmse,
     round(avg(abs(y_vol_30m - vol_30m)), 6) AS mae FROM f WHERE {KEPT_SQL} AND vol_30m IS NOT NULL GROUP BY symbol""",
)
def persistence_metrics_query(spark, sf):
    f = features(spark, sf).withColumnsRenamed({"y_vol_30m": "y_true", "vol_30m": "y_pred"})
    out = evaluate(f, ["symbol"])
    return out.select("symbol", "n", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


@query(
    "merged_scores",
    f"""WITH {COARSE_SQL} SELECT symbol, count(*) AS n, round(sqrt(avg((y_vol_30m - vol_30m)*(y_vol_30m - vol_30m))), 6) AS rmse,
     round(avg(abs(y_vol_30m - vol_30m)), 6) AS mae, round(corr(y_vol_30m, vol_30m), 6) AS corr, count(DISTINCT feature_date) AS days
     FROM f WHERE {KEPT_SQL} AND vol_30m IS NOT NULL GROUP BY symbol""",
)
def merged_scores_query(spark, sf):
    """Scores of all days from one state per symbol-day, without looking at the rows again."""
    f = features(spark, sf).where(~F.isnan("vol_30m")).withColumnsRenamed({"y_vol_30m": "y_true", "vol_30m": "y_pred"})
    states = score_states(f, ["symbol", "feature_date"])
    merged = merge_states(states, ["symbol"]).join(states.groupBy("symbol").agg(F.count(F.lit(1)).alias("days")), "symbol")
    out = scores_of(merged, ["symbol", "days"])
    return out.select("symbol", "n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "corr")], "days")


@query(
    "scaled_vol_mean",
    f"WITH {COARSE_SQL} SELECT symbol, round(avg(vol_60m*sqrt(50)), 6) AS scaled_vol FROM f WHERE {KEPT_SQL} GROUP BY symbol",
)
def scaled_vol_mean_query(spark, sf):
    f = features(spark, sf).where(~F.isnan("vol_60m"))
    return f.groupBy("symbol").agg(F.round(F.avg(F.col("vol_60m") * F.sqrt(F.lit(50.0))), 6).alias("scaled_vol"))


@query(
    "describe_vol",
    f"""WITH {COARSE_SQL} SELECT symbol, count(vol_60m) AS n, round(avg(vol_60m), 6) AS mean, round(stddev_samp(vol_60m), 6) AS std,
    min(vol_60m) AS "min", round(quantile_cont(vol_60m, 0.25), 6) AS p25, round(quantile_cont(vol_60m, 0.5), 6) AS p50,
    round(quantile_cont(vol_60m, 0.75), 6) AS p75, max(vol_60m) AS "max" FROM f WHERE {KEPT_SQL} GROUP BY symbol""",
)
def describe_vol_query(spark, sf):
    vols = materialize(features(spark, sf).select("symbol", "vol_60m"), "volatilities")  # read for moments and quantiles
    out = describe(vols, ["symbol"], "vol_60m")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


# --- label transform ------------------------------------------------------------------

QUANTILES_SQL = f"""{COARSE_SQL},
y AS (SELECT symbol, t, feature_date, y_vol_30m AS y, row_number() OVER (PARTITION BY symbol ORDER BY y_vol_30m) - 1 AS r
      FROM f WHERE {KEPT_SQL}),
nn AS (SELECT symbol, count(*) AS n, least(count(*), 1000) AS m FROM y GROUP BY symbol),
ks AS (SELECT symbol, n, m, unnest(range(m)) AS k FROM nn),
pos AS (SELECT *, k/(m-1)::DOUBLE AS p, k/(m-1)::DOUBLE*(n-1) AS pos FROM ks),
qt AS (SELECT pos.symbol, k, p, a.y + (b.y - a.y)*(pos - floor(pos)) AS q FROM pos
       JOIN y a ON a.symbol = pos.symbol AND a.r = floor(pos)::BIGINT JOIN y b ON b.symbol = pos.symbol AND b.r = ceil(pos)::BIGINT)"""


def label_quantile_table(f: DataFrame) -> DataFrame:
    return exact_quantiles(f, ["symbol"], "y_vol_30m", count=1000)


@query("label_quantiles", f"WITH {QUANTILES_SQL} SELECT symbol, k, round(q, 6) AS quantile FROM qt")
def label_quantiles_query(spark, sf):
    t = label_quantile_table(features(spark, sf))
    out = t.select("symbol", F.posexplode("quantiles").alias("k", "quantile"))
    return out.select("symbol", F.col("k").cast("bigint").alias("k"), F.round("quantile", 6).alias("quantile"))


RANKS_SQL = f"""{QUANTILES_SQL},
    e AS (SELECT symbol, min(q) AS lo, max(q) AS hi FROM qt GROUP BY symbol),
    dn AS (SELECT symbol, q, max(p) AS p FROM qt GROUP BY symbol, q),
    up AS (SELECT symbol, q, min(p) AS p FROM qt GROUP BY symbol, q),
    ds AS (SELECT *, lead(q) OVER w AS q2 FROM dn WINDOW w AS (PARTITION BY symbol ORDER BY q)),
    us AS (SELECT ds.symbol, ds.q, ds.p, ds.q2, up.p AS p2 FROM ds LEFT JOIN up ON up.symbol = ds.symbol AND up.q = ds.q2),
    at0 AS (SELECT y.symbol, y.feature_date, y.t, y.y, us.q, us.p, us.q2, us.p2, up.p AS first_p
           FROM y ASOF JOIN us ON y.symbol = us.symbol AND y.y >= us.q LEFT JOIN up ON up.symbol = y.symbol AND up.q = y.y),
    ranks AS (SELECT a.symbol, a.feature_date, t, y, lo, hi,
      CASE WHEN y = a.q THEN (a.p + first_p)/2 ELSE a.p + (y - a.q)*(p2 - a.p)/(q2 - a.q) END AS u
      FROM at0 a JOIN e ON e.symbol = a.symbol)"""


@query(
    "label_uniform",
    f"""WITH {RANKS_SQL} SELECT symbol, feature_date, t AS "timestamp",
      round(CASE WHEN y = lo THEN 0.0 WHEN y = hi THEN 1.0 ELSE u END, 6) AS u FROM ranks""",
)
def label_uniform_query(spark, sf):
    u = uniform_score(F.col("y_vol_30m"), F.col("step"))
    return labels_with_steps(spark, sf).select("symbol", "feature_date", "timestamp", F.round(u, 6).alias("u"))


def labels(spark, sf):
    """The labels alone, written once: they are read for their quantiles and to be mapped."""
    return materialize(features(spark, sf).select("symbol", "feature_date", "timestamp", "y_vol_30m"), "labels")


def labels_with_steps(spark, sf):
    y = labels(spark, sf)
    return with_steps(y, quantile_steps(label_quantile_table(y), ["symbol"]), ["symbol"], "y_vol_30m")


@query(
    "label_normal",
    f"""WITH {RANKS_SQL} SELECT symbol, feature_date, t AS "timestamp", round(CASE WHEN y - {EDGE!r} < lo THEN -{NORMAL_LIMIT!r}::DOUBLE
      WHEN y + {EDGE!r} > hi THEN {NORMAL_LIMIT!r}::DOUBLE ELSE {normal_quantile_sql("u")} END, 6) AS z FROM ranks""",
)
def label_normal_query(spark, sf):
    z = normal_score(F.col("y_vol_30m"), F.col("step"))
    return labels_with_steps(spark, sf).select("symbol", "feature_date", "timestamp", F.round(z, 6).alias("z"))


@query(
    "inverse_transform",
    f"""WITH {QUANTILES_SQL}, e AS (SELECT symbol, min(q) AS lo, max(q) AS hi FROM qt GROUP BY symbol)
    SELECT symbol, feature_date, t AS "timestamp",
      round(CASE WHEN y - {EDGE!r} < lo THEN lo WHEN y + {EDGE!r} > hi THEN hi ELSE y END, 5) AS back FROM y JOIN e USING (symbol)""",
)
def inverse_transform_query(spark, sf):
    """Labels to the normal scale and back: the label again, or the outer quantile it lies at."""
    y = labels(spark, sf)
    table = materialize(label_quantile_table(y), "quantiles")
    there = with_steps(y, quantile_steps(table, ["symbol"]), ["symbol"], "y_vol_30m")
    scored = there.select("symbol", "feature_date", "timestamp", normal_score(F.col("y_vol_30m"), F.col("step")).alias("z"))
    back = with_values(scored, table, ["symbol"], "z", "back")
    return back.select("symbol", "feature_date", "timestamp", F.round("back", 5).alias("back"))
