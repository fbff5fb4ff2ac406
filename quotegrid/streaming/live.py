"""Live features as a keyed stateful stream on event time.

For each symbol every grid instant the watermark has passed is emitted once, with
the newest quote by update id as of that instant. A window reads only the chunks
of prefix sums at its far end, so its length costs state but no time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quotegrid.config import FeatureConfig
from quotegrid.functions.time import floor_div, time_of_day_columns
from quotegrid.operators.features import ratio_columns
from quotegrid.streaming.events import CLOCK, SYMBOL, live_messages

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Instants packed into one state value; a burst is emitted in batches of some chunks.
CHUNK = 4096
CHUNKS_PER_BATCH = 16


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _newest_per_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Map-side reduction: of the quotes for one instant only the highest update id matters. Clock rows end here."""
    for pdf in batches:
        pdf = pdf[pdf["symbol"].notna()]
        sizes = pdf[pdf["tick_size"].notna()]
        quotes = pdf[pdf["tick_size"].isna()].sort_values("update_id", kind="stable")
        yield pd.concat([sizes, quotes.drop_duplicates(["symbol", "cell"], keep="last")])


ARRIVAL = np.dtype([("cell", "i8"), ("uid", "i8"), ("bid", "f8"), ("ask", "f8"), ("tick", "f8")])
NO_ID = -(2**62)


class LiveVolatility(StatefulProcessor):
    """State: ``head`` (next instant, quote and size in force, last sums), arrivals not
    yet reached and prefix sums, the latter two packed in chunks of instants."""

    def __init__(self, windows: list[int], warmup: int, interval_ns: int, origin_ns: int, chunk: int = CHUNK):
        self.windows, self.warmup, self.chunk = windows, warmup, chunk
        self.interval_ns, self.origin_ns = interval_ns, origin_ns
        # as many squares of it as a window has points still fit in a long; windows with a larger move have no volatility
        self.largest = math.isqrt((2**63 - 1) // (2 * max(windows)))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState(
            "head",
            "next_cell bigint, samples bigint, update_id bigint, bid double, ask double, tick double, "
            "mid_tick double, s1 bigint, s2 bigint, bad bigint",
        )
        self.pending = handle.getMapState("pending", "chunk bigint", "rows binary")
        self.sums = handle.getMapState("sums", "chunk bigint", "s1 binary, s2 binary, bad binary")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        head = self.head.get() if self.head.exists() else (None, 0, NO_ID, None, None, None, None, 0, 0, 0)
        for pdf in rows:
            head = self._take(head, pdf)
        yield from self._emit(key, head, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.head.exists():
            yield from self._emit(key, self.head.get(), timerValues)

    def _take(self, head, pdf):
        """Store arrivals by the instant they serve."""
        untimed = pdf["cell"].isna()
        if untimed.any():  # a size without a time holds from the next instant on
            head = (*head[:5], float(pdf.loc[untimed, "tick_size"].iloc[-1]), *head[6:])
        pdf = pdf[~untimed]
        if not len(pdf):
            return head
        new = np.empty(len(pdf), ARRIVAL)
        new["cell"] = pdf["cell"].to_numpy(dtype="i8")
        new["uid"] = pdf["update_id"].fillna(NO_ID).to_numpy(dtype="i8")
        for f, c in (("bid", "bid_price"), ("ask", "ask_price"), ("tick", "tick_size")):
            new[f] = pdf[c].to_numpy(dtype="f8")
        if head[1]:  # a late update can still serve the next instant
            new["cell"] = np.maximum(new["cell"], head[0])
        else:
            start = int(new["cell"].min())
            head = (start if head[0] is None else min(start, head[0]), *head[1:])
        chunk = new["cell"] // self.chunk
        for c in np.unique(chunk):
            rows = new[chunk == c]
            old = self.pending.getValue((int(c),)) if self.pending.containsKey((int(c),)) else None
            if old is not None:
                rows = np.concatenate([np.frombuffer(old[0], ARRIVAL), rows])
            self.pending.updateValue((int(c),), (_newest(rows).tobytes(),))
        return head

    def _emit(self, key, head, timerValues):
        """Emit all instants before the watermark and wait for the next one."""
        if head[0] is not None:
            passed_ns = timerValues.getCurrentWatermarkInMs() * 1_000_000 - 1 - self.origin_ns
            last = passed_ns // self.interval_ns
            if last >= head[0]:
                chunks = sorted(k[0] for k in self.pending.keys())
                batch = CHUNKS_PER_BATCH * self.chunk
                while head[0] <= last:
                    upto = min(last, (head[0] // batch + 1) * batch - 1)
                    due = self._due(chunks, upto)
                    head, out = self._advance(key, head, upto, due)
                    if out is not None:
                        yield out
            at = (head[0] * self.interval_ns + self.origin_ns) // 1_000_000 + 1
            if at not in set(self.handle.listTimers()):
                self.handle.registerTimer(at)
        self.head.update(head)

    def _due(self, chunks, upto):
        """Take the arrivals up to an instant out of the state, in order."""
        taken = [np.empty(0, ARRIVAL)]
        while chunks and chunks[0] <= upto // self.chunk:
            rows = np.frombuffer(self.pending.getValue((chunks[0],))[0], ARRIVAL)
            taken.append(rows[rows["cell"] <= upto])
            rest = rows[rows["cell"] > upto]
            if len(rest):
                self.pending.updateValue((chunks[0],), (rest.tobytes(),))
                break
            self.pending.removeKey((chunks.pop(0),))
        return np.concatenate(taken)

    def _advance(self, key, head, upto, due):
        start, samples, uid, bid, ask, tick, mid, *sums = head
        quotes, sizes = due[np.isnan(due["tick"])], due[~np.isnan(due["tick"])]
        best = np.maximum.accumulate(np.concatenate([[uid], quotes["uid"]]))
        quotes = quotes[quotes["uid"] > best[:-1]]  # an older id never replaces a newer one
        at = np.arange(start, upto + 1)
        bids = _in_force(at, quotes["cell"], quotes["bid"], bid)
        asks = _in_force(at, quotes["cell"], quotes["ask"], ask)
        ticks = _in_force(at, sizes["cell"], sizes["tick"], tick)
        with np.errstate(over="ignore"):
            mids = np.round((bids + asks) / 2.0 / ticks, 1)
        if len(quotes):
            uid, bid, ask = int(quotes["uid"][-1]), float(quotes["bid"][-1]), float(quotes["ask"][-1])
        if len(sizes):
            tick = float(sizes["tick"][-1])
        known = np.flatnonzero(~np.isnan(mids))
        if len(known) == 0:
            return (upto + 1, samples, uid, bid, ask, tick, mid, *sums), None
        mids, cells = mids[known[0] :], at[known[0] :]  # once quote and size are known they stay known
        before = np.concatenate([[mids[0] if mid is None else mid], mids[:-1]])
        with np.errstate(invalid="ignore", over="ignore"):
            tenths = np.rint((mids - before) * 10)
            usable = np.abs(tenths) <= self.largest  # not so for infinite mids either
        x = np.where(usable, tenths, 0.0).astype(np.int64)
        # sums may run over the ends of a long: the difference of two of them is right all the same
        sums = [np.int64(s) + np.cumsum(v) for s, v in zip(sums, (x, x * x, (~usable).astype(np.int64)), strict=True)]
        counts = samples + 1 + np.arange(len(mids))
        vols = self._volatilities(counts, samples, sums)
        self._store(samples, sums)
        out = pd.DataFrame(
            {
                "symbol": key[0],
                "timestamp": cells * self.interval_ns + self.origin_ns,
                "samples": counts,
                "warm": counts >= self.warmup,
                "mid_tick": mids,
                **{f"v{k}": v for k, v in enumerate(vols)},
            }
        )
        return (upto + 1, int(counts[-1]), uid, bid, ask, tick, float(mids[-1]), *(int(s[-1]) for s in sums)), out

    def _volatilities(self, counts, samples, sums):
        """Population std per window; sample ``k`` (from 1) has its sums at position ``k``."""
        out = []
        for w in self.windows:
            a, b, bad = (s - far for s, far in zip(sums, self._sums_at(counts - w, samples, sums), strict=True))
            a, b = a.astype(float), b.astype(float)
            std = np.sqrt(np.maximum(w * b - a * a, 0.0) / (100.0 * w * w))
            out.append(np.where((counts < w) | (bad > 0), np.nan, std))
        return out

    def _sums_at(self, pos, samples, sums):
        """Prefix sums at consecutive sample positions; zero at and before position 0."""
        found = [np.zeros(len(pos), np.int64) for _ in sums]
        new = pos > samples
        for f, s in zip(found, sums, strict=True):
            f[new] = s[pos[new] - samples - 1]
        old = np.flatnonzero((pos > 0) & ~new)
        if len(old):
            index = pos[old] - 1
            for chunk in range(int(index[0]) // self.chunk, int(index[-1]) // self.chunk + 1):
                here = index // self.chunk == chunk
                for f, kept in zip(found, self.sums.getValue((chunk,)), strict=True):
                    f[old[here]] = np.frombuffer(kept, np.int64)[index[here] % self.chunk]
        return found

    def _store(self, samples, sums):
        """Append the new sums to their chunks and drop chunks no window reaches any more."""
        index = samples + np.arange(len(sums[0]))
        for chunk in range(int(index[0]) // self.chunk, int(index[-1]) // self.chunk + 1):
            here = index // self.chunk == chunk
            new = [s[here].tobytes() for s in sums]
            if index[here][0] % self.chunk:
                new = [bytes(o) + n for o, n in zip(self.sums.getValue((chunk,)), new, strict=True)]
            self.sums.updateValue((chunk,), tuple(new))
        oldest = (int(index[-1]) + 1 - max(self.windows)) // self.chunk - 1
        for chunk in range(oldest, max(oldest - len(sums[0]) // self.chunk - 2, -1), -1):
            if chunk >= 0 and self.sums.containsKey((chunk,)):
                self.sums.removeKey((chunk,))


def _newest(rows: np.ndarray) -> np.ndarray:
    """Per instant the quote with the highest update id and the last size, in order of instants."""
    rows = rows[np.argsort(rows["uid"], kind="stable")]  # sizes carry no id and keep their arrival order
    rows = rows[np.lexsort((np.isnan(rows["tick"]), rows["cell"]))]
    is_last = np.ones(len(rows), bool)
    is_last[:-1] = (rows["cell"][1:] != rows["cell"][:-1]) | (np.isnan(rows["tick"][1:]) != np.isnan(rows["tick"][:-1]))
    return rows[is_last]


def _in_force(at: np.ndarray, cells: np.ndarray, values: np.ndarray, before: float | None) -> np.ndarray:
    """Value of the last change at or before each instant, else the one before all of them."""
    k = np.searchsorted(cells, at, side="right")
    return np.concatenate([[np.nan if before is None else before], values])[k]


def clock(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """A stream of the times at which it is read, as ``time_us``."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return ticks.select(F.unix_micros("timestamp").alias("time_us"))


def live_features(
    events: DataFrame,
    cfg: FeatureConfig,
    warmup_minutes: int,
    delay: str = "1 second",
    chunk: int = CHUNK,
    ticks: DataFrame | None = None,
    max_ahead_s: int = 60,
    max_age_s: int | None = None,
) -> DataFrame:
    """Feature rows per grid instant from a stream of JSON events in column ``value``.

    Event time moves on with the messages and, with a stream ``ticks`` of times (``clock``), also while no
    message comes: every instant is then emitted with the quote that is still in force. A message whose time lies more than
    ``max_ahead_s`` after its arrival, or more than ``max_age_s`` before it, is skipped: it would move all symbols
    to its time, or a new symbol's first instant back to it. Without ``max_age_s`` a recorded feed can be played.
    """
    grid = cfg.grid
    ns = F.col("time_us") * 1000 - F.lit(grid.origin_ns)
    cell = floor_div(ns + F.lit(grid.interval_ns - 1), grid.interval_ns)
    arrived = F.unix_micros(F.current_timestamp())
    timely = F.col("time_us") <= arrived + max_ahead_s * 1_000_000
    if max_age_s is not None:
        timely = timely & (F.col("time_us") >= arrived - max_age_s * 1_000_000)
    messages = live_messages(events).where(F.col("time_us").isNull() | timely)
    if ticks is not None:
        messages = messages.unionByName(ticks.select("time_us", F.lit(CLOCK).alias("route")), allowMissingColumns=True)
    rows = (
        messages.withColumn("cell", cell)
        .withColumn("event_time", F.when(F.col("route") != SYMBOL, F.timestamp_micros("time_us")))
        .withWatermark("event_time", delay)
        # The watermark only drives the timers: without the time column no late row is dropped,
        # and a late quote with a newer id serves the next instant.
        .select("symbol", "cell", "update_id", "bid_price", "ask_price", "tick_size")
    )
    reduced = rows.mapInPandas(_newest_per_cell, rows.schema)
    vols = ", ".join(f"v{i} double" for i in range(len(cfg.vol_windows)))
    windows = [grid.ticks(w) for w in cfg.vol_windows]
    processor = LiveVolatility(windows, grid.ticks(warmup_minutes), grid.interval_ns, grid.origin_ns, chunk)
    sampled = reduced.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=f"symbol string, timestamp bigint, samples bigint, warm boolean, mid_tick double, {vols}",
        outputMode="Append",
        timeMode="EventTime",
    )
    # NaN of an unfilled window leaves pandas as null.
    named = sampled.select(
        "symbol",
        "timestamp",
        "samples",
        "warm",
        "mid_tick",
        *[F.coalesce(f"v{i}", F.lit(float("nan"))).alias(c) for i, c in enumerate(cfg.vol_columns)],
    )
    return with_live_columns(named, cfg)


def with_live_columns(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Ratios and time of day beside the volatilities."""
    extra: list[Column] = [*ratio_columns(cfg), *time_of_day_columns(F.col("timestamp"))]
    return df.select("*", *extra)
