"""Improbable-feature digests of texts and how alike two digests are.

A feature is a window of bytes. Its entropy puts it into one of 1000 bins; the fewer windows of the
corpus fall into a bin, the more improbable is a feature of it. Of each neighbourhood of
consecutive windows the most improbable one (leftmost on a tie) wins, and features that win often
enough are hashed into a chain of Bloom filters, so many per filter. Two digests are compared filter
by filter: the bits in common, less those expected by chance, over the most there could be.

Defined results: a null text is an empty one; a text without a single improbable window (shorter
than a window, or all one character) has one feature, the whole text; an empty text has none, and is
like other empty texts (1) and unlike the rest (0). Equal texts have equal digests. Other columns are
not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import row_slices, texts, width

BINS = 1000
FILTER_BITS = 2048
SUB_HASHES = 5
SLICE = 1 << 20
NEIGHBOURS = 6  # log2 of the largest neighbourhood


@dataclass(frozen=True)
class DigestConfig:
    window: int = 16  # bytes, a power of two
    per_filter: int = 160  # features
    min_bin: int = 300  # windows of less entropy say nothing
    popularity: int = 4  # a feature must win one part in so many of a neighbourhood


def _entropy_bins(buf: np.ndarray, w: int) -> np.ndarray:
    """Entropy bin of the window that starts at each byte but the last w - 1."""
    n = buf.size - w + 1
    full = 1 << 20  # stands for w * log2(w)
    k = np.arange(w + 1, dtype=np.float64)
    k[0] = 1
    g = np.rint(k * np.log2(k) * full / (w * np.log2(w))).astype(np.int64)
    dg = np.diff(g)
    before = np.zeros(buf.size, np.uint8)
    after = np.zeros(buf.size, np.uint8)
    for d in range(1, w):  # equal bytes among the w - 1 before and after each byte
        same = (buf[d:] == buf[:-d]).view(np.uint8)
        before[d:] += same
        after[:-d] += same
    s = np.empty(n, np.int64)
    s[0] = g[np.bincount(buf[:w], minlength=256)].sum()
    np.subtract(dg[before[w:]], dg[after[: n - 1]], out=s[1:])
    np.cumsum(s, out=s)
    return np.minimum(((full - s) * BINS) >> 20, BINS - 1)


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start .. start + count - 1 of each pair, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - ends + counts, counts)


def _hash_windows(buf: np.ndarray, at: np.ndarray, w: int) -> np.ndarray:
    """A 64-bit hash of the window at each position."""
    view = np.lib.stride_tricks.sliding_window_view(buf, w)[at]
    words = np.zeros((at.size, -(-w // 8) * 8), np.uint8)
    words[:, :w] = view
    h = np.full(at.size, 0x9E3779B97F4A7C15, np.uint64)
    for part in words.view(np.uint64).T:
        h ^= part
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(29)
    return h


def _pieces(lengths: list[int], w: int) -> list[tuple[int, int, int]]:
    """(text, first byte, bytes) of parts of at most a slice; parts of a text overlap by a neighbourhood."""
    lap = (1 << NEIGHBOURS) + w
    out = []
    for i, n in enumerate(lengths):
        at = 0
        while True:
            size = min(n - at, SLICE + lap)
            out.append((i, at, size))
            if at + size >= n:
                break
            at += size - lap + 2  # neighbourhoods start once
    return out


def features(blobs: list[bytes], ranks: np.ndarray, cfg: DigestConfig) -> list[np.ndarray]:
    """Hashes of the selected features of each text, in their order, each once."""
    w = cfg.window
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(blobs)
    found: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in blobs]
    todo = [p for p in _pieces([len(b) for b in blobs], w) if p[2] >= w]
    while todo:
        part, held = [], 0
        while todo and (not part or held + todo[0][2] <= SLICE):
            part.append(todo.pop(0))
            held += part[-1][2]
        for i, at, h, n in _winners(blobs, part, ranks, cfg):
            found[i].append((at, h, n))
    for i, blob in enumerate(blobs):
        if found[i]:
            at, h, n = (np.concatenate(x) for x in zip(*found[i], strict=True))
            if len(found[i]) > 1:  # a window that won in two parts
                at, first, back = np.unique(at, return_index=True, return_inverse=True)
                n = np.bincount(back, weights=n).astype(np.int64)
                h = h[first]
            h = h[n >= _least(len(blob), cfg)]
            _, first = np.unique(h, return_index=True)
            out[i] = h[np.sort(first)]
        if blob and not out[i].size:
            out[i] = np.frombuffer(hashlib.blake2b(blob, digest_size=8).digest(), np.uint64)
    return out


def _level(n_bytes: int, w: int) -> int:
    """log2 of a text's neighbourhood: an eighth of its windows, 64 at most."""
    return min(NEIGHBOURS, max(0, ((n_bytes - w + 1) // 8).bit_length() - 1))


def _least(n_bytes: int, cfg: DigestConfig) -> int:
    return max(1, (1 << _level(n_bytes, cfg.window)) // cfg.popularity)


def _winners(blobs, part, ranks, cfg):
    """Of each part: text, positions, hashes and wins of the windows that win a neighbourhood."""
    w = cfg.window
    buf = np.frombuffer(b"".join(blobs[i][a : a + n] for i, a, n in part), np.uint8)
    sizes = np.array([n for _, _, n in part])
    starts = np.cumsum(sizes) - sizes
    rank = ranks[_entropy_bins(buf, w)]
    key = (rank << 32) | np.arange(rank.size)
    levels = np.array([_level(len(blobs[i]), w) for i, _, _ in part])
    wins = np.zeros(rank.size, np.int64)
    for level in range(NEIGHBOURS + 1):
        if level:
            half = 1 << (level - 1)
            key = np.minimum(key[:-half], key[half:]) if key.size > half else key[:0]
        mine = levels == level
        if mine.any():
            hoods = np.maximum(sizes[mine] - w + 1 - (1 << level) + 1, 0)
            won = key[_ragged(starts[mine], hoods)]
            won = won[(won >> 32) < BINS] & 0xFFFFFFFF
            wins += np.bincount(won, minlength=wins.size)
    at = np.flatnonzero(wins)
    least = np.repeat([_least(len(blobs[i]), cfg) for i, _, _ in part], sizes)[at]
    edge = np.array([blobs[i].__len__() > n for i, _, n in part])
    keep = (wins[at] >= least) | np.repeat(edge, sizes)[at]  # parts of a text are added up first
    at = at[keep]
    h = _hash_windows(buf, at, w)
    cut = np.searchsorted(at, np.append(starts, buf.size))
    for j, (i, a, _) in enumerate(part):
        s = slice(cut[j], cut[j + 1])
        if cut[j + 1] > cut[j]:
            yield i, at[s] - starts[j] + a, h[s], wins[at[s]]


def filters(hashes: np.ndarray, cfg: DigestConfig) -> np.ndarray:
    """The chain of Bloom filters, one row of 32 words each."""
    n = -(-hashes.size // cfg.per_filter)
    bits = np.zeros((n, FILTER_BITS), np.uint8)
    row = np.arange(hashes.size) // cfg.per_filter
    for k in range(SUB_HASHES):
        bits[row, (hashes >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)] = 1
    return np.packbits(bits, axis=1).view(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: each filter of the smaller digest against the best of the other, weighted by its bits."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    na, nb = (np.bitwise_count(x).sum(axis=1).astype(np.float64) for x in (a, b))
    if (na.sum(), a.tobytes()) > (nb.sum(), b.tobytes()):
        a, b, na, nb = b, a, nb, na
    total = 0.0
    step = max(1, (1 << 20) // len(b))
    for i in range(0, len(a), step):
        common = np.zeros((len(a[i : i + step]), len(b)))
        for k in range(a.shape[1]):
            common += np.bitwise_count(a[i : i + step, k, None] & b[None, :, k])
        chance = na[i : i + step, None] * nb[None, :] / FILTER_BITS
        most = np.minimum(na[i : i + step, None], nb[None, :])
        best = ((common - chance) / np.maximum(most - chance, 1e-9)).max(axis=1)
        total += float((np.clip(best, 0, 1) * na[i : i + step]).sum())
    return min(1.0, total / float(na.sum()))


def encode(hashes: np.ndarray, chain: np.ndarray) -> str:
    return f"{hashes.size}:{base64.b64encode(chain.tobytes()).decode()}"


def decode(fingerprint: str) -> np.ndarray:
    """The chain of filters of a fingerprint, for :func:`likeness`."""
    return np.frombuffer(base64.b64decode(fingerprint.partition(":")[2]), np.uint64).reshape(-1, FILTER_BITS // 64)


def rarity_ranks(docs: DataFrame, cfg: DigestConfig = DigestConfig()) -> np.ndarray:
    """Rank of each entropy bin, counted over every window of every text; fewer windows, lower rank.

    The driver gets at most 1000 sums. Bins of too little entropy get rank 1000: never selected.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BINS, np.int64)
        for part in row_slices(batches, "text", SLICE):
            blobs = [x.encode() for x in part.column(0).to_pylist()]
            for buf, owned in _joined(blobs, cfg.window):
                sums += np.bincount(_entropy_bins(buf, cfg.window)[owned], minlength=BINS)
        yield pa.RecordBatch.from_pydict({"bin": np.arange(BINS), "n": sums})

    counted = texts(docs).select("text").mapInArrow(count, "bin long, n long")
    n = np.zeros(BINS, np.int64)
    for r in counted.where("n > 0").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        n[r["bin"]] = r["n"]
    ranks = np.empty(BINS, np.int64)
    ranks[np.lexsort((np.arange(BINS), n))] = np.arange(BINS)
    ranks[: cfg.min_bin] = BINS
    return ranks


def _joined(blobs: list[bytes], w: int):
    """Texts laid end to end in slices, with a mask of the windows inside one text."""
    parts = [p for p in _pieces([len(b) for b in blobs], w) if p[2] >= w]
    while parts:
        part, held = [], 0
        while parts and (not part or held + parts[0][2] <= SLICE):
            part.append(parts.pop(0))
            held += part[-1][2]
        buf = np.frombuffer(b"".join(blobs[i][a : a + n] for i, a, n in part), np.uint8)
        sizes = np.array([n for _, _, n in part])
        starts = np.cumsum(sizes) - sizes
        lap = np.array([(1 << NEIGHBOURS) - 1 if a else 0 for _, a, _ in part])  # counted in the part before
        yield buf, _ragged(starts + lap, np.maximum(sizes - w + 1 - lap, 0))


def with_successor(docs: DataFrame) -> DataFrame:
    """Rows dealt into ranges of ``doc_id``, sorted, each range closed by the first row of the next one.

    ``bucket``, ``guest`` (1: the row of the next range), ``doc_id``, ``text``. After the last range
    comes the first. Ranges are cut at quantiles, so they are even whatever the ids; the driver gets
    one id per range. Null ids come first; rows of one id are ordered by text.
    """
    spark = docs.sparkSession
    rows = texts(docs).withColumn("at", F.col("doc_id").cast("double"))
    n = 8 * width(spark)
    cuts = sorted(set(rows.approxQuantile("at", [i / n for i in range(1, n)], 1 / (4 * n))))
    splits = [-float("inf"), *(cuts or [0.0]), float("inf")]
    rows = Bucketizer(splits=splits, inputCol="at", outputCol="cut", handleInvalid="keep").transform(rows)
    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("cut")).cast("int")
    rows = rows.select(bucket.alias("bucket"), F.lit(0).alias("guest"), "doc_id", "text")
    first = [tuple(r) for r in rows.groupBy("bucket").agg(F.min("doc_id")).orderBy("bucket").collect()]
    if not first:
        return rows
    follows = [(first[i - 1][0], first[i][0], first[i][1]) for i in range(len(first))]
    of = spark.createDataFrame(follows, "before int, b int, first long")
    guests = (
        rows.join(F.broadcast(of), (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("before", "doc_id")
        .agg(F.min("text").alias("text"))
        .select(F.col("before").alias("bucket"), F.lit(1).alias("guest"), "doc_id", "text")
    )
    both = rows.unionByName(guests).repartition(width(spark), "bucket")
    return both.sortWithinPartitions("bucket", "guest", "doc_id", "text")


def fingerprint_pairs(docs: DataFrame, ranks: np.ndarray, cfg: DigestConfig = DigestConfig()) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and two likenesses.

    The edited text has its last quarter of characters replaced by the first as many of the next
    document. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. A text is shuffled once; each task holds a slice of about 1 MB at a time.
    """

    def emit(rows, edits, prints, ahead):
        out = []
        hashed = features([e.encode() for e in edits], ranks, cfg)
        for (doc_id, text), edited, h, own, nxt in zip(rows, edits, hashed, prints, ahead, strict=True):
            chain = filters(h, cfg)
            digest = hashlib.sha256(edited.encode()).hexdigest()
            near = (likeness(own[1], chain), likeness(own[1], nxt[1]))
            out.append((doc_id, len(text), digest, encode(*own), encode(h, chain), *near))
        cols = [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in SCHEMA]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, SCHEMA.types, strict=True)], schema=SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far and its digest
        for part in row_slices(batches, "text", SLICE):
            rows = list(zip(*(part.column(c).to_pylist() for c in ("guest", "doc_id", "text")), strict=True))
            hashed = features([r[2].encode() for r in rows], ranks, cfg)
            seq = [(r, (h, filters(h, cfg))) for r, h in zip(rows, hashed, strict=True)]
            seq = [held, *seq] if held else seq
            pairs = [(a, b) for a, b in zip(seq, seq[1:], strict=False) if not a[0][0]]
            held = seq[-1]
            if pairs:
                edits = []
                for ((_, _, t), _), ((_, _, nxt), _) in pairs:
                    q = len(t) // 4
                    edits.append(t[: len(t) - q] + nxt[:q])
                yield emit([a[0][1:] for a, _ in pairs], edits, [a[1] for a, _ in pairs], [b[1] for _, b in pairs])

    return with_successor(docs).mapInArrow(run, SPARK_SCHEMA)


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
SPARK_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
