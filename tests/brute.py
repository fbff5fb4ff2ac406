"""Plain pandas forms of the grid operators, written from their definitions."""

import numpy as np
import pandas as pd

DAY = 86_400_000_000_000
QUOTE_SCHEMA = (
    "symbol string, ts_ns bigint, local_ts_ns bigint, update_id bigint, "
    "bid_price double, ask_price double, bid_amount double, ask_amount double"
)


def random_quotes(seed, symbols, days, per_day, step_ns, null_share=0.0, first_day=19_000):
    """Quotes with ties, off-grid and on-grid times and some that are not valid."""
    rng = np.random.default_rng(seed)
    rows = []
    uid = 0
    for s in symbols:
        for d in range(days):
            n = int(per_day)
            t = (first_day + d) * DAY + rng.integers(0, DAY, n)
            t = np.where(rng.random(n) < 0.3, t // step_ns * step_ns, t)
            t = np.where(rng.random(n) < 0.2, np.roll(t, 1), t)  # equal receive times
            for local in np.sort(t):
                uid += 1
                ts = int(local) - int(rng.integers(-2, 20)) * 1_000_000
                bid = round(float(rng.integers(1000, 1100)) / 100, 2)
                null = rng.random() < null_share
                rows.append((s, ts, int(local), uid, None if null else bid, bid + 0.01, 1.0, 2.0))
    return rows


def quote_frame(rows):
    names = [c.split()[0] for c in QUOTE_SCHEMA.split(", ")]
    return pd.DataFrame(rows, columns=names)


def sample(rows, symbol, day, step_ns, prev_day=True, strict=False):
    """One session: the newest valid quote of its days at each grid point."""
    q = quote_frame(rows)
    start = (day - (1 if prev_day else 0)) * DAY
    q = q[(q.symbol == symbol) & (q.local_ts_ns >= q.ts_ns) & (q.local_ts_ns >= start) & (q.local_ts_ns < (day + 1) * DAY)]
    q = q.sort_values(["local_ts_ns", "ts_ns", "update_id"]).reset_index(drop=True)
    grid = np.arange(start, (day + 1) * DAY, step_ns)
    k = np.searchsorted(q.local_ts_ns.to_numpy(), grid, side="left" if strict else "right") - 1
    out = q.reindex(np.where(k < 0, -1, k)).reset_index(drop=True)
    out["timestamp"] = grid
    return out


def volatility(sampled, tick, windows, label, ddof=1):
    """Moves, rolling std and label from their definitions."""
    mid = ((sampled.ask_price + sampled.bid_price) / 2 / tick).round(1)
    chg = mid.diff().fillna(0.0)
    out = pd.DataFrame({"timestamp": sampled.timestamp, "mid_tick": mid, "mid_chg": chg})
    for w in windows:
        out[f"w{w}"] = chg.rolling(w, min_periods=w).std(ddof=ddof) if w > ddof else np.nan
    out["y"] = out[f"w{label}"].shift(-label)
    out["labelled"] = np.arange(len(out)) + label < len(out)
    return out
