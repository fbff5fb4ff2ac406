"""Toxicity by the nearest labelled examples, with exact TF-IDF cosines from a block-max inverted index.

Terms are all lower-cased words of a text, and the first letters of its longer words, both as 20-bit hashes. Document frequencies
are counted over all documents. Every word has its TF-IDF weight. Terms that go with the label weigh ``LIFTED``
times as much: those that come more often in the toxic ones of a bounded sample of labelled documents, several times
as often and by a chi-square test that is corrected for the number of terms tested. First letters weigh nothing without it. So texts
are near by such terms if they have any, and by their other words in any case: a copy of an example has cosine 1.

The examples' vectors form an inverted index in blocks of ``BLOCK`` examples that knows each term's largest weight in
each block, and so the cosine that a block can at most reach. A search looks at the highest blocks first, and then only
at blocks that can reach the k-th best cosine, so the nearest examples are exact; where no term has half of the text's weight, bounds
exclude no block, and all postings of the text's terms are added up at once. Neighbours vote with weights that fall with
distance. Votes of the examples themselves, each left out of its own search, calibrate the vote (isotonic).
The nearest examples are the evidence.

Labels are taken from the given rows only; terms are tested on about ``PER_CLASS`` documents of either label at most, and about ``INDEXED``
of either are examples, whatever the corpus. Weights restore the share of the labels.

Defined results: null and empty texts, and texts that share no term with an example, get the share of toxic examples among
the examples without a term (of all examples, if each has one); without labels the score is 0. Several labels of one document are
toxic if one is; null labels are none. Examples of equal texts and labels are one, of the smallest id. Equal cosines go to the smaller id. Repeated rows give
repeated rows; an empty table gives no rows; very long texts are read whole; other columns are not looked at.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import md5
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import row_slices, texts
from quotegrid.session import materialize

PER_CLASS = 8192  # labelled documents of each label that terms are tested on
INDEXED = 2048  # of each label that are examples
TERM_BITS = 20
TERMS = 1 << TERM_BITS  # words are hashed to; first letters to as many behind them
PRIME, MIX = 0x100000001B3, 0x9E3779B97F4A7C15  # of the hash
LONG = 64  # letters; a longer word is hashed as a whole
LEAST = 3  # toxic documents that have a term which goes with the label
LIFT = 3  # times as often in toxic documents, at least
CHANCE = 0.01  # that any term is taken without going with the label
LIFTED = 100.0
STEM = 4  # letters
NEIGHBOURS = 16
BLOCK = 32
FIRST = 2  # blocks looked at first
PRIOR = 0.02  # votes for the share of toxic examples
KNOWN = 10_000  # texts whose scores a task keeps
COMMON = 16  # a term is common if one in so many examples has it
AT_ONCE = 64  # texts whose common terms are looked up together
HEAVY = 0.5  # part of a vector from which bounds are asked first
SLICE = 1 << 20


@lru_cache
def _letters() -> np.ndarray:
    """Whether a code point stands in words: letters and numbers that are no decimal digits."""
    every = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    every[0xD800:0xE000] = 0  # no characters
    chars = every.view("U1")
    return np.char.isalnum(chars) & ~np.char.isdecimal(chars)


def _hash(h: np.ndarray) -> np.ndarray:
    """The upper bits of a product, as a place among the ``TERMS``."""
    return ((h * np.uint64(MIX)) >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def term_lists(rows: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms (ascending in a text) and counts of some texts, one behind the other, and where each text's begin.

    Words are hashed letter by letter, all words at once; behind the words' hashes lie those of the first letters of longer words.
    """
    lower = [t.lower() for t in rows]
    codes = np.frombuffer("\n".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    edges = np.flatnonzero(np.diff(_letters()[codes], prepend=False, append=False))
    start, size = edges[::2], edges[1::2] - edges[::2]
    of = np.searchsorted(np.cumsum([0] + [len(t) + 1 for t in lower[:-1]]), start, "right") - 1
    h, stem, live = np.zeros(start.size, np.uint64), np.zeros(start.size, np.uint64), np.flatnonzero(size <= LONG)
    for k in range(min(LONG, int(size.max(initial=0)))):
        live = live[size[live] > k]
        h[live] = h[live] * np.uint64(PRIME) + codes[start[live] + k]
        if k + 1 == STEM:
            stem[live] = h[live]
    for i in np.flatnonzero(size > LONG).tolist():
        word = codes[start[i] : start[i] + size[i]]
        h[i] = int.from_bytes(md5(word.tobytes(), usedforsecurity=False).digest()[:8], "little")
        for c in word[:STEM].tolist():
            stem[i] = (int(stem[i]) * PRIME + c) % (1 << 64)
    longer = size > STEM
    at = np.concatenate([_hash(h), TERMS + _hash(stem[longer])])
    of = np.concatenate([of, of[longer]])
    if wanted is not None:
        some = wanted[at]
        at, of = at[some], of[some]
    key = np.sort(of * (2 * TERMS) + at)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key, n = key[first], np.diff(first, append=key.size)
    return key % (2 * TERMS), n, np.searchsorted(key, np.arange(len(rows) + 1) * (2 * TERMS))


def term_counts(rows: list[str], wanted: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Terms and counts of each of some texts."""
    at, n, first = term_lists(rows, wanted)
    return [(at[i:j], n[i:j]) for i, j in zip(first.tolist(), first[1:].tolist(), strict=False)]


def sampled_labels(labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, toxic and weight of about ``per_class`` documents of either label, chosen by a hash of the id."""
    once = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in once.groupBy("toxic").count().collect()}
    share = {t: min(1.0, per_class / n) for t, n in counts.items() if t in (0, 1)}
    if not share:
        return once.where("false").withColumn("weight", F.lit(1.0))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    of = F.create_map(*[F.lit(x) for t, s in share.items() for x in (t, s)])[F.col("toxic")]
    return once.where(chance < of).withColumn("weight", 1 / of)


def document_frequencies(docs: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """term, n: how many rows of ``text`` have it. A task counts its own rows before the shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(2 * TERMS, np.int64)
        for part in row_slices(batches, "text", SLICE):
            seen += np.bincount(term_lists(part.column(0).to_pylist(), held.value)[0], minlength=2 * TERMS)
        at = np.flatnonzero(seen)
        for i in range(0, at.size, 1 << 16):
            some = at[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["term", "n"])

    return docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _dense(counted: DataFrame) -> np.ndarray:
    """The counts of all hashes, of which there are 2 * ``TERMS``."""
    found, out = counted.toArrow(), np.zeros(2 * TERMS, np.int64)
    out[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return out


def lifted(clean: np.ndarray, toxic: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """Whether a term goes with the label, from the clean and the toxic documents that have it, of ``n0`` and ``n1``."""
    tested = toxic >= LEAST
    if not (n0 and n1 and tested.any()):
        return np.zeros(toxic.size, bool)
    c, a, n = clean.astype(np.float64), toxic.astype(np.float64), n0 + n1
    lean = a * n0 - c * n1
    chi = lean * lean / n1 * n / n0 / np.maximum(a + c, 1) / np.maximum(n - a - c, 1)
    z = NormalDist().inv_cdf(1 - CHANCE / 2 / tested.sum())
    return tested & (lean > 0) & (a * n0 >= LIFT * c * n1) & (chi >= z * z)


def term_weights(df: np.ndarray, total: int, goes: np.ndarray) -> np.ndarray:
    """The weight of every term: that of rare words, more for terms that go with the label, none for other first letters."""
    idf = np.log((1 + total) / (1 + np.minimum(df, total)))
    factor = np.where(goes, LIFTED, 1.0)
    factor[TERMS:][~goes[TERMS:]] = 0
    return (idf * factor).astype(np.float32)


def _unit(terms: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms of some weight, and their parts of a vector of length 1."""
    w = (1 + np.log(np.asarray(counts, np.float64))) * weights[terms]
    some = w > 0
    at, w = np.asarray(terms)[some], w[some]
    return at, w / math.sqrt(float(w @ w)) if w.size else w


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1 ... of each span, one behind the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


@dataclass
class BlockMaxIndex:
    """Postings of the examples by term, cut into blocks, with each term's largest weight in a block."""

    weights: np.ndarray  # of terms
    ids: np.ndarray  # of the examples
    toxic: np.ndarray
    weight: np.ndarray
    plain: float  # share of toxic examples among those without a term, or of all
    # postings by term: its place, examples and weights; the blocks by term with the largest weights
    terms: np.ndarray
    first: np.ndarray
    rows: np.ndarray
    parts: np.ndarray
    first_block: np.ndarray
    blocks: np.ndarray
    most: np.ndarray
    # the same by example, for single blocks; terms by their place in ``terms``
    own_first: np.ndarray
    own_terms: np.ndarray
    own_parts: np.ndarray
    _query: np.ndarray | None = None  # a query's parts while blocks are looked at
    _common: tuple[np.ndarray, np.ndarray] | None = None  # see ``common``

    @classmethod
    def build(cls, examples: list[tuple], weights: np.ndarray) -> BlockMaxIndex:
        """``examples``: (doc_id, toxic, weight, terms, counts)."""
        units = [(e, *_unit(e[3], e[4], weights)) for e in examples]
        bare = [e for e, at, _ in units if not at.size] or examples
        whole = sum(e[2] for e in bare)
        some = [x for x in units if x[1].size]
        # examples with the same leading term share blocks, so that the largest weights say more
        some.sort(key=lambda x: (int(x[1][np.argmax(x[2])]), x[0][0]))
        size = np.array([x[1].size for x in some], np.int64)
        own_terms = np.concatenate([x[1] for x in some]) if some else np.empty(0, np.int64)
        own_parts = np.concatenate([x[2] for x in some]) if some else np.empty(0)
        row = np.repeat(np.arange(len(some)), size)
        order = np.lexsort((row, own_terms))
        of, rows, parts = own_terms[order], row[order], own_parts[order]
        terms, first = np.unique(of, return_index=True)
        new = np.flatnonzero(np.diff(of, prepend=-1) | np.diff(rows // BLOCK, prepend=-1)) if rows.size else np.empty(0, np.int64)
        end = lambda at, n: np.append(at, n).astype(np.int64)
        return cls(
            weights,
            np.array([x[0][0] for x in some], np.int64),
            np.array([x[0][1] for x in some], np.float64),
            np.array([x[0][2] for x in some], np.float64),
            sum(e[2] for e in bare if e[1]) / whole if whole else 0.0,
            terms,
            end(first, rows.size),
            rows.astype(np.int32),
            parts,
            end(np.searchsorted(new, first), new.size),
            (rows[new] // BLOCK).astype(np.int32),
            np.maximum.reduceat(parts, new) if new.size else parts,
            end(np.cumsum(size) - size, own_terms.size),
            np.searchsorted(terms, own_terms).astype(np.int32),
            own_parts,
        )

    def search(self, terms, counts, k: int = NEIGHBOURS, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k nearest examples with a term in common, nearest first."""
        return self.search_places(*self._places(terms, counts), k, without)

    def search_many(self, queries: list[tuple], k: int = NEIGHBOURS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for several (terms, counts); the postings of common terms are added up for ``AT_ONCE`` of them at a time."""
        order, full = self.common()
        for i in range(0, len(queries), AT_ONCE):
            found = [self._places(*q) for q in queries[i : i + AT_ONCE]]
            parts = np.zeros((len(found), full.shape[0]))
            for row, (place, w) in zip(parts, found, strict=True):
                of = order[place]
                row[of[of >= 0]] = w[of >= 0]
            for (place, w), head in zip(found, parts @ full, strict=True):
                yield self.search_places(place, w, k, head=head)

    def common(self) -> tuple[np.ndarray, np.ndarray]:
        """The number of each term among those that at least one in ``COMMON`` examples have, else -1; and their postings as rows."""
        if self._common is None:
            often = np.flatnonzero(np.diff(self.first) * COMMON >= max(1, self.ids.size))
            order, full = np.full(self.terms.size, -1), np.zeros((often.size, self.ids.size))
            order[often] = np.arange(often.size)
            for row, t in zip(full, often.tolist(), strict=True):
                row[self.rows[self.first[t] : self.first[t + 1]]] = self.parts[self.first[t] : self.first[t + 1]]
            self._common = order, full
        return self._common

    def _places(self, terms, counts) -> tuple[np.ndarray, np.ndarray]:
        """A text's terms that examples have, by their place in ``terms``, and their parts of its vector of length 1."""
        at, q = _unit(np.asarray(terms, np.int64), counts, self.weights)
        place = np.searchsorted(self.terms, at)
        here = place < self.terms.size
        here[here] = self.terms[place[here]] == at[here]
        return place[here], q[here]

    def search_places(
        self, place: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, without: int | None = None, head: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The same, of places and parts; ``head`` are all examples' cosines by common terms alone, if known."""
        if not place.size:
            return np.empty(0, np.int64), np.empty(0)
        # without a heavy term no block is out of reach of the k-th best: then at once along the postings
        if w.max() >= HEAVY:
            n = -(-self.ids.size // BLOCK)
            start = self.first_block[place]
            size = self.first_block[place + 1] - start
            spans = _spans(start, size)
            bound = np.bincount(self.blocks[spans], np.repeat(w, size) * self.most[spans], minlength=n)
            # the blocks with the highest bounds give a k-th best; then all blocks that may still reach it
            top = np.argpartition(bound, -FIRST)[-FIRST:] if n > FIRST else np.arange(n)
            rows, cosines = self._best(*self._blocks(np.sort(top), place, w), k, without)
            least = cosines[-1] if rows.size == k else 0.0
            more = (bound >= least - 1e-9) & (bound > 0)
            more[top] = False
            if not more.any():
                return rows, cosines
            if 8 * more.sum() < n:
                return self._best(*self._blocks(np.sort(np.append(top, np.flatnonzero(more))), place, w), k, without)
        if head is not None:
            rare = self.common()[0][place] < 0
            place, w = place[rare], w[rare]
        start = self.first[place]
        size = self.first[place + 1] - start
        spans = _spans(start, size)
        part = np.repeat(w, size)
        part *= self.parts[spans]
        score = np.bincount(self.rows[spans], part, minlength=self.ids.size)
        if head is not None:
            score = score + head
        got = np.flatnonzero(score)
        return self._best(got, score[got], k, without)

    def _blocks(self, blocks: np.ndarray, place: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the examples of some blocks that share a term."""
        if self._query is None:
            self._query = np.zeros(self.terms.size)
        query = self._query
        query[place] = w
        rows, score = [], []
        for block in blocks.tolist():
            first = self.own_first[block * BLOCK : (block + 1) * BLOCK + 1]
            part = query[self.own_terms[first[0] : first[-1]]]
            part *= self.own_parts[first[0] : first[-1]]
            score.append(np.add.reduceat(part, first[:-1] - first[0]))
            rows.append(block * BLOCK + np.arange(first.size - 1))
        query[place] = 0
        rows, score = np.concatenate(rows), np.concatenate(score)
        return rows[score > 0], score[score > 0]

    def _best(self, rows: np.ndarray, score: np.ndarray, k: int, without: int | None) -> tuple[np.ndarray, np.ndarray]:
        if without is not None:
            rows, score = rows[self.ids[rows] != without], score[self.ids[rows] != without]
        value = np.round(score, 12)
        if rows.size > 4 * k:  # ties of the k-th stay for the id to decide
            near = value >= np.partition(value, -k)[-k]
            rows, value = rows[near], value[near]
        order = np.lexsort((self.ids[rows], -value))[:k]
        return rows[order], value[order]

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic examples; one with cosine c weighs c^2 / (1.02 - c), beside ``PRIOR`` for the share without neighbours."""
        near = np.minimum(cosines, 1.0)
        w = self.weight[rows] * near * near / (1.02 - near)
        return float(((w * self.toxic[rows]).sum() + PRIOR * self.plain) / (w.sum() + PRIOR))


@dataclass
class Calibration:
    """A rising step function from votes to shares, by pooling neighbours that fall."""

    votes: np.ndarray
    shares: np.ndarray

    @classmethod
    def fit(cls, vote: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> Calibration:
        order = np.argsort(vote, kind="stable")
        pools: list[list[float]] = []  # weight, weighted share, largest vote
        for v, y, w in zip(vote[order], toxic[order], weight[order], strict=True):
            if pools and pools[-1][2] == v:
                pools[-1][0] += w
                pools[-1][1] += w * y
            else:
                pools.append([w, w * y, v])
            while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
                w2, y2, v2 = pools.pop()
                pools[-1] = [pools[-1][0] + w2, pools[-1][1] + y2, v2]
        return cls(np.array([p[2] for p in pools]), np.array([p[1] / p[0] for p in pools]))

    def __call__(self, vote: float) -> float:
        if not self.votes.size:
            return vote
        if vote > self.votes[-1]:  # nearer than any example had one: on the line to a vote of 1, which is certain
            return float(np.interp(vote, [self.votes[-1], max(1.0, vote)], [self.shares[-1], 1.0]))
        return float(self.shares[np.searchsorted(self.votes, vote)])


@dataclass
class ToxicityModel:
    index: BlockMaxIndex
    calibration: Calibration

    def scores(self, queries: list[tuple]) -> Iterator[tuple[float, list[tuple[int, float, int]]]]:
        for rows, cosines in self.index.search_many(queries):
            if rows.size:
                near = [(int(self.index.ids[r]), float(c), int(self.index.toxic[r])) for r, c in zip(rows[:3], cosines, strict=False)]
                yield self.calibration(self.index.vote(rows, cosines)), near
            else:
                yield self.index.plain, []


def _examples(found: DataFrame) -> list[tuple]:
    """(doc_id, toxic, weight, terms, counts) of the examples, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches, "text", SLICE):
            both = term_counts(part.column(3).to_pylist())
            lists = [pa.array([b[k].tolist() for b in both], pa.list_(pa.int32())) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *lists], names=["doc_id", "toxic", "weight", "terms", "counts"])

    rows = found.select("doc_id", F.col("toxic").cast("int"), F.col("weight").cast("double"), "text")
    got = rows.mapInArrow(run, "doc_id long, toxic int, weight double, terms array<int>, counts array<int>").toArrow()
    some = lambda c: [np.asarray(x.values) for x in got.column(c)]
    plain = [got.column(c).to_pylist() for c in ("doc_id", "toxic", "weight")]
    return sorted(zip(*plain, some("terms"), some("counts"), strict=True), key=lambda e: e[:3])


def learn(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """The model; labels of ``PER_CLASS`` documents and vectors of ``INDEXED`` examples are all that reaches the driver, and counts by hash."""
    spark, rows = docs.sparkSession, texts(docs)
    sample = F.broadcast(sampled_labels(labels))  # 2 * PER_CLASS rows, about
    once = lambda s: rows.join(s, "doc_id").groupBy("text", "toxic").agg(F.min("doc_id").alias("doc_id"), F.max("weight").alias("weight"))
    tested = materialize(once(sample), "tested")  # copies once
    totals = {r["toxic"]: r["count"] for r in tested.groupBy("toxic").count().collect()}
    clean, toxic = (_dense(document_frequencies(tested.where(F.col("toxic") == y))) for y in (0, 1))
    goes = lifted(clean, toxic, totals.get(0, 0), totals.get(1, 0))
    wanted = goes.copy()
    wanted[:TERMS] = True  # first letters that weigh nothing are not counted
    weights = term_weights(_dense(document_frequencies(rows, wanted)), rows.count(), goes)
    index = BlockMaxIndex.build(_examples(once(F.broadcast(sampled_labels(labels, INDEXED)))), weights)
    held = spark.sparkContext.broadcast(index)

    def leave_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            out = []
            for row in batch.column(0).to_pylist():
                own = slice(index.own_first[row], index.own_first[row + 1])
                found, cosines = index.search_places(index.own_terms[own], index.own_parts[own], without=int(index.ids[row]))
                if found.size:
                    out.append((index.vote(found, cosines), index.toxic[row], index.weight[row]))
            cols = list(zip(*out, strict=True)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in cols], names=["vote", "toxic", "weight"])

    votes = spark.range(index.ids.size).mapInArrow(leave_out, "vote double, toxic double, weight double").collect()
    v = np.array([tuple(r) for r in sorted(votes)]).reshape(-1, 3)
    return ToxicityModel(index, Calibration.fit(*v.T))


def scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, evidence: the three nearest examples with cosine and label."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        known: dict[bytes, tuple] = {}
        model, wanted = held.value, held.value.index.weights > 0
        for part in row_slices(batches, "text", SLICE):
            lines = part.column(1).to_pylist()
            keys = [md5(t.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest() for t in lines]
            if len(known) > KNOWN:
                known.clear()
            new = {k: t for k, t in zip(keys, lines, strict=True) if k not in known}  # copies once
            known.update(zip(new, model.scores(term_counts(list(new.values()), wanted)), strict=True))
            found = [known[k] for k in keys]
            near = [[{"doc_id": i, "cosine": c, "toxic": y} for i, c, y in e] for _, e in found]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([s for s, _ in found], pa.float64()), pa.array(near, kind)], names=["doc_id", "score", "evidence"]
            )

    return texts(docs).mapInArrow(run, "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,toxic:int>>")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score, predicted (1 from 0.5 on) and evidence of every document, learnt from ``labels``."""
    return scores(docs, learn(docs, labels)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
