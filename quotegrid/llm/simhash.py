"""SimHash near-duplicates of documents by tiled exact comparison.

A text is lower-cased (A-Z), cut into words and into shingles of ``shingle`` words (all its words if
it has fewer); a bit of its fingerprint is 1 if it is set in over half of the shingles' XXH64 values.
Fingerprints link at ``radius`` differing bits or fewer.

The comparison runs over different fingerprints only: copies are one row. Fingerprints are dealt into
tiles by their number of set bits; as two fingerprints differ in at least as many bits as their
counts do, pairs of tiles with counts further apart than the radius are never made. Inside a pair
of tiles, rows are sorted by the counts of their four quarters, cut into strips, and a strip meets only those
rows whose four counts are near enough; the rest are compared with exclusive-or and bit counts.
What is left of a pair of tiles is a forest of its links, at most one row per fingerprint, so a group of
thousands of near copies does not become millions of links.

The work grows with the square of the number of different fingerprints, a tile pair being the unit
of it; a tile has a bounded number of rows, so memory does not grow.

Defined results: null and blank texts have fingerprint zero and link like any other; a null id takes
part and is the smallest of a group only if no other is there; repeated rows give repeated rows;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.bitfilter import bit_filter, without_ids
from quotegrid.llm.common import row_slices, texts
from quotegrid.llm.components import connected_components
from quotegrid.session import materialize

SEED = 42
SLICE = 1 << 20
TILE = 1 << 16  # fingerprints
STRIP = 128
CHUNK = 8192

# A byte's bits, one in each byte of a word.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]


def fingerprints_of(batch: list[str], shingle: int) -> np.ndarray:
    """One unsigned fingerprint per text."""
    digest = xxhash.xxh64_digest
    hashes: list[bytes] = []
    counts = np.zeros(len(batch), np.int64)
    for i, text in enumerate(batch):
        words = text.encode().lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            hashes.append(digest(joined, SEED))
            counts[i] = 1
            continue
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        begins = (ends - sizes)[: len(words) - shingle + 1].tolist()
        ends = ends[shingle - 1 :].tolist()
        hashes.append(b"".join([digest(joined[a:b], SEED) for a, b in zip(begins, ends, strict=True)]))
        counts[i] = len(begins)
    out = np.zeros(len(batch), np.uint64)
    if not hashes:
        return out
    bits = np.frombuffer(b"".join(hashes), ">u8").astype("<u8").view(np.uint8).reshape(-1, 8)
    some = np.flatnonzero(counts)
    starts = np.cumsum(counts[some]) - counts[some]
    # sums of up to 255 shingles fit the bytes of a word
    groups = -(-counts[some] // 255)
    first = np.cumsum(groups) - groups
    within = np.arange(groups.sum()) - np.repeat(first, groups)
    cuts = np.repeat(starts, groups) + 255 * within
    total = np.empty((some.size, 64), np.int64)
    for c in range(8):
        sums = np.add.reduceat(_LANES[bits[:, c]], cuts).view(np.uint8).reshape(-1, 8)
        total[:, 8 * c : 8 * c + 8] = np.add.reduceat(sums.astype(np.int64), first, axis=0)
    over = (2 * total > counts[some, None]).astype(np.uint8)
    out[some] = np.packbits(over, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def document_fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches, "text", SLICE):
            fp = fingerprints_of(part.column(1).to_pylist(), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def _quarters(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(fp).view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the sets of each i and j; every label is its set's root."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(label, np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart]))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links inside tile ``a``, or between ``a`` and ``b``."""
    rows = a if b is None else np.concatenate([a, b])
    counts = _quarters(rows)
    own = np.arange(a.size)
    own = own[np.lexsort(counts[own].T[::-1])]
    other = own if b is None else np.arange(a.size, rows.size)
    if b is not None:
        other = other[np.lexsort(counts[other].T[::-1])]
    theirs, values = counts[other], rows[other]
    label = np.arange(rows.size)
    for at in range(0, own.size, STRIP):
        strip = own[at : at + STRIP]
        low, high = counts[strip].min(axis=0), counts[strip].max(axis=0)
        gap = (np.maximum(low - theirs, 0) + np.maximum(theirs - high, 0)).sum(axis=1)
        if b is None:
            gap[:at] = radius + 1  # met already
        near = np.flatnonzero(gap <= radius)
        for k in range(0, near.size, CHUNK):
            some = near[k : k + CHUNK]
            close = np.bitwise_count(rows[strip][:, None] ^ values[some][None, :]) <= radius
            x, y = np.nonzero(close)
            if x.size:
                _merge(label, strip[x], other[some[y]])
    tied = np.flatnonzero(label != np.arange(rows.size))
    return rows[tied], rows[label[tied]]


def fingerprint_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links ``a``, ``b`` that connect all of ``fp`` (different longs) within ``radius`` bits, in some way."""
    spark = distinct.sparkSession
    rows = distinct.select("fp", F.bit_count("fp").alias("n"))
    sizes = rows.groupBy("n").count().collect()  # 65 counts at most
    per = spark.createDataFrame([(r["n"], -(-r["count"] // TILE)) for r in sizes], "n int, tiles long")
    tiles = per.select("n", "tiles", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("k"))
    ahead = tiles.select("n", "k", F.explode(F.sequence(F.lit(0), F.lit(radius))).alias("d"))
    pairs = ahead.alias("x").join(
        tiles.alias("y"),
        (F.col("y.n") == F.col("x.n") + F.col("d")) & ((F.col("d") > 0) | (F.col("y.k") >= F.col("x.k"))),
    )
    ident = lambda t: F.shiftleft(F.col(f"{t}.n").cast("long"), 40) + F.col(f"{t}.k")
    pairs = pairs.select(ident("x").alias("p"), ident("y").alias("q"))
    sides = pairs.select("p", "q", F.col("p").alias("tile")).unionByName(
        pairs.where("p <> q").select("p", "q", F.col("q").alias("tile"))
    )
    dealt = rows.join(F.broadcast(per), "n").select(
        "fp", (F.shiftleft(F.col("n").cast("long"), 40) + F.pmod(F.xxhash64("fp"), F.col("tiles"))).alias("tile")
    )

    def compare(group: pa.Table) -> pa.Table:
        p, q, tile, fp = (group.column(c).to_numpy() for c in ("p", "q", "tile", "fp"))
        fp = fp.astype(np.int64, copy=False).view(np.uint64)
        first = tile == p
        x, y = tile_links(fp[first], None if p[0] == q[0] else fp[~first], radius)
        return pa.table({"a": x.view(np.int64), "b": y.view(np.int64)})

    met = dealt.join(sides, "tile").select("p", "q", "tile", "fp")
    return met.groupBy("p", "q").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``: the smallest id that can be reached over links."""
    marked = materialize(document_fingerprints(docs, shingle), "simhash")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash")
    tied = connected_components(fingerprint_links(distinct, radius))
    rooted = distinct.join(tied.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the document with the smallest id stays, once."""
    found = materialize(near_duplicates(docs, shingle, radius), "near-copies")
    copies = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id")
    left = without_ids(docs, copies)
    again = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not again.limit(1).count():
        return left
    # rows that repeat an id: one of them stays
    again = materialize(again, "ids")
    hit = bit_filter(again, "doc_id")(F.col("doc_id"))
    return left.where(~hit).unionByName(left.where(hit).dropDuplicates(["doc_id"]))
