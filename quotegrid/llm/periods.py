"""Periodic runs of words: maximal stretches that repeat a block, and texts with the repetitions taken out.

Words between ASCII white space are letters. Phase one of Baier's suffix sorter groups places by the longest Lyndon word that
starts there; the groups' lengths are the Lyndon array at once, without sorting suffixes. It is run under an order
of the letters and under the opposite one: by the runs theorem every run has a Lyndon root under one of the two. A root is
extended to both sides by longest common extensions (LCE) between it and the place one period on, which gives the run.

Phase one is linear, but runs step by step in Python, so it gets only what can lie in a run: with the
default rule every word of a run stands in some five neighbouring words that occur again in the text (see ``RunRule.gram``), and
numpy finds those stretches. That test loses no run. A batch of texts is one sequence with walls between stretches, so
memory is bounded by a slice of texts, or by one text if that is longer.

Defined results: a null or blank text has no words and no runs; repeated rows and ids are rows like others, a null id too;
texts are taken whole, however long; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import WORD, row_slices, texts

SLICE = 4 << 20  # bytes of text that are worked on together
FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


@dataclass(frozen=True)
class RunRule:
    """What counts as a run: at least ``least`` words, and ``periods`` (2 or more) of its periods."""

    least: int = 6
    periods: int = 4

    def __post_init__(self):
        if self.periods < 2:
            raise ValueError("a run has two periods at least")

    def length(self, period):
        return np.maximum(self.least, self.periods * period)

    @property
    def gram(self) -> int:
        """The most neighbouring words of which every place in a run holds some that occur twice in the run.

        Of k words at place i of a run of length n and period q, the same stand at i + q or i - q within the
        run if n >= 2q + k - 1.
        """
        return max(1, min(int(self.length(q)) - 2 * q + 1 for q in range(1, max(self.least, 2) + 1)))


def lyndon_array(letters: list[int], wall: list[bool]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place and crosses no wall; 0 at walls.

    Place 0 has to be a wall. Groups are worked off from the highest on. A group's members are final; each
    prolongs the nearest place to its left that is not final yet, as often as members of the group follow there.
    """
    n = len(letters)
    order = {x: g for g, x in enumerate(sorted({x for x, w in zip(letters, wall, strict=True) if not w}))}
    group = [-1 if w else order[x] for x, w in zip(letters, wall, strict=True)]
    members: list[list[int]] = [[] for _ in order]
    for i, g in enumerate(group):
        if g >= 0:
            members[g].append(i)
    length, below, above = [1] * len(order), list(range(-1, len(order) - 1)), list(range(1, len(order) + 1))
    left = list(range(n))  # itself, or a place to the left of a final one
    found = [0] * n
    now = len(order) - 1
    while now >= 0:
        here = [s for s in members[now] if group[s] == now]
        members[now] = []
        size = length[now]
        for s in here:
            found[s] = size
            left[s] = s - 1
        met: dict[int, int] = {}
        for s in here:
            p = s - 1
            while left[p] != p:
                left[p] = left[left[p]]
                p = left[p]
            left[s] = p
            if group[p] >= 0:
                met[p] = met.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, times in met.items():
            moved.setdefault((group[p], times), []).append(p)
        # above the old group, the longer the higher
        for old, times in sorted(moved, reverse=True):
            new = len(members)
            members.append(moved[old, times])
            length.append(length[old] + times * size)
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = new
            if up < new:
                below[up] = new
            for p in members[new]:
                group[p] = new
        now = below[now]
    return found


def _common(buf: bytes, i: int, j: int) -> int:
    """Equal letters (of 4 bytes) from i and from a larger j on."""
    n, step = 0, 8
    same = lambda k: buf[4 * (i + n) : 4 * (i + n + k)] == buf[4 * (j + n) : 4 * (j + n + k)]
    while same(step):
        n += step
        step *= 2
    while step > 1:
        step //= 2
        if same(step):
            n += step
    return n


def _roots(ids: np.ndarray, wall: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and lengths of Lyndon roots under both orders that have a repeated word beside them, by length and place."""
    walls, at = wall.tolist(), np.arange(len(ids))
    both = []
    for letters in (ids, -ids):
        lyndon = np.array(lyndon_array(letters.tolist(), walls), dtype=np.int64)
        i = at[lyndon > 0]
        p = lyndon[i]
        fits = i + p < len(ids)
        i, p = i[fits], p[fits]
        near = (ids[i] == ids[i + p]) | (ids[i - 1] == ids[i + p - 1])
        both.append(np.stack([p[near], i[near]]))
    p, i = np.concatenate(both, axis=1)
    by = np.lexsort((i, p))
    return i[by], p[by]


def runs_between_walls(ids: np.ndarray, wall: np.ndarray, rule: RunRule) -> np.ndarray:
    """Rows of start, length, period by start and period. Letters at walls have to differ from all others; the ends are walls."""
    buf = ids.astype("<i4").tobytes()
    back = ids[::-1].astype("<i4").tobytes()
    last = len(ids) - 1
    out = []
    period = end = -1
    places, lengths = _roots(ids, wall)
    for i, p in zip(places.tolist(), lengths.tolist(), strict=True):
        if p == period and i + p < end:
            continue  # in the stretch that was extended last
        end = i + p + _common(buf, i, i + p)
        period = p
        start = i - _common(back, last - (i + p - 1), last - (i - 1))
        if end - start >= rule.length(p):
            out.append((start, end - start, p))
    return np.array(sorted({(s, n, p) for s, n, p in out}), dtype=np.int64).reshape(-1, 3)


def _repeating(ids: np.ndarray, doc: np.ndarray, gram: int) -> np.ndarray:
    """Places that stand in ``gram`` neighbouring words which their document has twice."""
    if len(ids) < gram:
        return np.zeros(len(ids), dtype=bool)
    n = len(ids) - gram + 1
    h = doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(gram):
        h = (h ^ ids[k : k + n].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    whole = doc[:n] == doc[gram - 1 :]
    twice = pd.Series(h).duplicated(keep=False).to_numpy() & whole
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    edge[:n] += twice
    edge[gram:] -= twice
    return np.cumsum(edge[:-1]) > 0


def runs_of(ids: np.ndarray, doc: np.ndarray, rule: RunRule = RunRule()) -> np.ndarray:
    """Runs as rows of start, length, period, by start; no run reaches over two documents (``doc`` ascends)."""
    at = np.flatnonzero(_repeating(ids, doc, rule.gram))
    if not len(at):
        return np.zeros((0, 3), dtype=np.int64)
    # a wall before every stretch and one at the end; its letter occurs nowhere else
    first = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (np.diff(doc[at]) != 0)])
    walls = first + np.arange(len(first))
    size = len(at) + len(first) + 1
    wall = np.zeros(size, dtype=bool)
    wall[walls] = wall[-1] = True
    letters, origin = np.empty(size, dtype=np.int64), np.empty(size, dtype=np.int64)
    letters[~wall], origin[~wall] = np.unique(ids[at], return_inverse=True)[1] + 1, at
    letters[wall] = len(at) + 2 + np.arange(len(first) + 1)
    runs = runs_between_walls(letters, wall, rule)
    runs[:, 0] = origin[runs[:, 0]]
    return runs


def _slice_rows(doc_ids: list, said: list[bytes], rule: RunRule) -> list[tuple]:
    words = [t.split() for t in said]
    number = defaultdict(count().__next__).__getitem__
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    ids = np.fromiter((number(w) for ws in words for w in ws), dtype=np.int64, count=int(sizes.sum()))
    runs = runs_of(ids, np.repeat(np.arange(len(words)), sizes), rule)
    ends = np.cumsum(sizes)
    cuts = np.searchsorted(runs[:, 0], ends)
    out, before = [], 0
    for doc_id, ws, end, cut in zip(doc_ids, words, ends.tolist(), cuts.tolist(), strict=True):
        mine = runs[before:cut] - np.array([end - len(ws), 0, 0])
        before = cut
        if len(mine):
            gone = np.zeros(len(ws) + 1, dtype=np.int64)
            np.add.at(gone, mine[:, 0] + mine[:, 2], 1)
            np.add.at(gone, mine[:, 0] + mine[:, 1], -1)
            kept = b" ".join([w for w, g in zip(ws, np.cumsum(gone).tolist(), strict=False) if not g])
        else:
            kept = b" ".join(ws)
        out.append((doc_id, len(ws), [dict(zip(("start", "length", "period"), r, strict=True)) for r in mine.tolist()], kept))
    return out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def find_runs(docs: DataFrame, rule: RunRule = RunRule()) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` by start and period, and ``collapsed``: the text without repetitions.

    A word is left out of ``collapsed`` if a run holds it after the run's first period; the words that stay are
    joined by one space. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches, "text", SLICE):
            rows = _slice_rows(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), rule)
            ids, sizes, runs, kept = zip(*rows, strict=True)
            text = pa.array(kept, pa.binary()).cast(pa.string())
            columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(runs, _ARROW.field("runs").type), text]
            yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    return texts(docs).mapInArrow(run, FOUND)


def longest(runs: Column) -> Column:
    """The run of the greatest length; of several the first one, then the one of the smaller period."""
    first = lambda r: F.struct(-r["length"], r["start"], r["period"])
    better = lambda a, b: F.when(a.isNull() | (first(b) < first(a)), b).otherwise(a)
    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def run_digests(found: DataFrame) -> DataFrame:
    """Per document: number of runs, its longest run, digests of all runs and of the collapsed text."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    every = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    best = longest(F.col("runs")).alias("best")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best, every.alias("every"), "collapsed")
    return rows.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("every", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_made_runs(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, chosen by a hash of the id, repeat a block of words from some word on to their end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", F.coalesce(h % 10 == 0, F.lit(False)).alias("made"), g.alias("g"))
    plain = rows.where("not made").select("doc_id", "text")
    made = rows.where("made").select("doc_id", F.regexp_extract_all("text", F.lit(f"({WORD})")).alias("w"), "g")
    n = F.size("w")
    made = made.where("w is not null").select("doc_id", "w", F.when(n > 0, F.col("g") % n).alias("a"), "g").withColumn(
        "p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))
    )
    word = lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    again = made.select("doc_id", F.array_join(F.transform("w", word), " ").alias("text"))
    nulls = rows.where("made and text is null").select("doc_id", "text")
    return plain.unionByName(again).unionByName(nulls)
