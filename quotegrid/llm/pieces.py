"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text becomes words that no merge can join: runs of the space mark with what follows them. The new
words of a slice of texts are laid end to end as one flat symbol array. Each round finds, word by
word, the smallest rank among the neighbouring pairs, merges the leftmost such pair of every word at
once, and closes the gaps; a word leaves when it has no pair left. One merge per word and round, as a
merge may make a pair that ranks before the next occurrence. Words of more than ``LONG`` symbols are
merged with a heap instead, in the same order. Characters without a piece become their bytes.

Ids equal the library's, for any text: null is empty, an empty text has the begin and end ids only.
Repeated rows give repeated rows; other columns are not looked at. There is no shuffle, and a task
holds one slice of texts and a bounded table of the words it met.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import row_slices, texts

SPACE = "▁"
LONG = 256  # symbols in a word
KNOWN_WORDS = 300_000  # kept between the slices of a task
SLICE = 2 << 20
NONE = np.iinfo(np.int64).max


class PieceModel:
    """Pieces, ranks and pairs of a BPE model, as flat tables."""

    def __init__(self, path: str):
        import sentencepiece  # reads the file; texts are not given to it

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.begin, self.end, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        ids = {p: i for i, p in enumerate(names) if not special[i]}
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("a piece of this model has a space inside")
        # characters that are no piece of their own still take part in merges
        for c in sorted({c for p in ids for c in p} - ids.keys()):
            ids[c] = len(names)
            names.append(c)
        self.chars = {p: i for p, i in ids.items() if len(p) == 1}
        scores = np.array([-sp.get_score(i) for i in range(n)] + [0.0] * (len(names) - n))
        self.rank = np.unique(scores, return_inverse=True)[1].astype(np.int64)
        pairs = {
            (ids[p[:k]], ids[p[k:]]): i
            for p, i in ids.items()
            for k in range(1, len(p))
            if p[:k] in ids and p[k:] in ids
        }
        self.size = len(names)
        # pairs in a table with open places, looked up many at a time
        self.places = max(1 << 10, 4 * len(pairs)).bit_length()
        self.pair_keys = np.full(1 << self.places, -1, np.int64)
        self.pair_ids = np.full(1 << self.places, -1, np.int64)
        keys = np.array([a * self.size + b for a, b in pairs], np.int64)
        made = np.array([*pairs.values()], np.int64)
        at = self._place(keys)
        while keys.size:
            free = np.flatnonzero(self.pair_keys[at] == -1)
            _, first = np.unique(at[free], return_index=True)
            took = free[first]
            self.pair_keys[at[took]], self.pair_ids[at[took]] = keys[took], made[took]
            rest = np.ones(keys.size, bool)
            rest[took] = False
            keys, made, at = keys[rest], made[rest], (at[rest] + 1) & ((1 << self.places) - 1)
        self.pairs = pairs
        self.pieces = n
        self.names = names
        self.char_ids = np.full(0x110000, -1, np.int32)
        for c, i in self.chars.items():
            self.char_ids[ord(c)] = i
        self.surface = [
            b"" if i < n and sp.is_control(i) else names[i].replace(SPACE, " ").encode() for i in range(len(names))
        ]
        for b, i in self.bytes.items():
            self.surface[i] = bytes([b])
        self.surface[self.unknown] = " ⁇ ".encode()
        self.char_counts = np.array([*map(len, names), 1])  # the last stands for an unknown character
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.byte_ids = set(self.bytes.values())

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.places)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        key = np.where((left < 0) | (right < 0), np.int64(-2), left * self.size + right)
        at = self._place(key)
        held = self.pair_keys[at]
        out = np.where(held == key, self.pair_ids[at], -1)
        open_ = np.flatnonzero((held != key) & (held != -1))
        while open_.size:  # another pair has the place: look at the next one
            at[open_] = (at[open_] + 1) & ((1 << self.places) - 1)
            held = self.pair_keys[at[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.pair_ids[at[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out


@functools.lru_cache(maxsize=4)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def _heap_merge(m: PieceModel, sym: list[int]) -> list[int]:
    """One long word: best rank first, leftmost on a tie."""
    n = len(sym)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and (made := m.pairs.get((sym[i], sym[j]))) is not None:
            heapq.heappush(heap, (int(m.rank[made]), i, sym[i], sym[j]))

    alive = [True] * n
    for i in range(n):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j < 0 or sym[i] != a or sym[j] != b:
            continue
        sym[i] = m.pairs[a, b]
        alive[j] = False
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [s for s, x in zip(sym, alive, strict=True) if x]


def merge_rounds(m: PieceModel, sym: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The final symbols of words laid end to end, and the word of each."""
    done: list[tuple[np.ndarray, np.ndarray]] = [(sym[:0], sym[:0])]
    word = np.repeat(np.arange(sizes.size), sizes)
    made = np.full(sym.size, -1, np.int64)  # what each symbol makes with the next one
    inside = word[1:] == word[:-1]
    made[:-1][inside] = m.merged(sym[:-1][inside], sym[1:][inside])
    while sym.size:
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        order = np.where(made >= 0, (m.rank[made] << 32) | np.arange(sym.size), NONE)
        best = np.minimum.reduceat(order, starts)
        over = best == NONE
        if over.any():  # words without a pair leave
            stay = np.repeat(~over, np.diff(np.append(starts, sym.size)))
            done.append((sym[~stay], word[~stay]))
            moved = np.cumsum(stay) - 1
            sym, word, made = sym[stay], word[stay], made[stay]
            best = moved[best[~over] & 0xFFFFFFFF]
        else:
            best = best & 0xFFFFFFFF
        if not sym.size:
            break
        sym[best] = made[best]
        stay = np.ones(sym.size, bool)
        stay[best + 1] = False
        best -= np.arange(best.size)  # one gap per word before it
        sym, word, made = sym[stay], word[stay], made[stay]
        made[best] = -1
        for left in (best, best[best > 0] - 1):
            left = left[left + 1 < sym.size]
            left = left[word[left] == word[left + 1]]
            made[left] = m.merged(sym[left], sym[left + 1])
    sym, word = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(word, kind="stable")
    return sym[order], word[order]


class Encoder:
    """Encodes texts; remembers the words it has met, up to a bound."""

    def __init__(self, path: str):
        self.m = load(path)
        self.known: dict[str, bytes] = {}
        self.split = re.compile(f"{SPACE}+[^{SPACE}]*").findall

    def _learn(self, words: list[str]) -> None:
        m = self.m
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        sym = m.char_ids[codes].astype(np.int64)
        long = sizes > LONG
        inside = np.repeat(long, sizes)
        out, word = merge_rounds(m, sym[~inside], np.where(long, 0, sizes))
        for k in np.flatnonzero(long).tolist():
            a = int(sizes[:k].sum())
            merged = np.array(_heap_merge(m, sym[a : a + sizes[k]].tolist()))
            at = np.searchsorted(word, k)
            out, word = np.insert(out, at, merged), np.insert(word, at, np.full(merged.size, k))
        bare = (out < 0) | (out >= m.pieces)  # characters without a piece: their bytes
        if bare.any():
            size = m.char_counts[np.where(out < 0, -1, out)]
            first = np.cumsum(size) - size
            raw = [[m.bytes[b] for b in chr(c).encode()] for c in codes[first[bare]].tolist()]
            counts = np.ones(out.size, np.int64)
            counts[bare] = [len(r) for r in raw]
            out, word, bare = np.repeat(out, counts), np.repeat(word, counts), np.repeat(bare, counts)
            out[bare] = [b for r in raw for b in r]
        flat = out.astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        self.known.update(zip(words, [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))

    def encode(self, batch: Iterable[str]) -> list[np.ndarray]:
        split = [self.split(SPACE + t.replace(" ", SPACE)) if t else [] for t in batch]
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        new = set().union(*split) - self.known.keys()
        if new:
            self._learn(list(new))
        ends = [np.array([x], "<u4").tobytes() for x in (self.m.begin, self.m.end)]
        get = self.known.__getitem__
        return [np.frombuffer(b"".join([ends[0], *map(get, words), ends[1]]), "<u4") for words in split]


def decode(m: PieceModel, ids: list[int]) -> str:
    """The text of any ids. Bytes that are no UTF-8 become U+FFFD, one for each."""
    parts = list(map(m.surface.__getitem__, ids))
    for i, part in zip(ids, parts, strict=True):
        if i not in m.control:  # the space put before the text goes
            drop = part.startswith(b" ") and i not in m.byte_ids and i != m.unknown
            raw = b"".join(parts)[1 if drop else 0 :]
            break
    else:
        return ""
    try:
        text = raw.decode()
        if not m.byte_ids.isdisjoint(ids):
            text = _piecewise(m, ids, drop)
        return text
    except UnicodeDecodeError:
        return _piecewise(m, ids, drop)


def _piecewise(m: PieceModel, ids: list[int], drop: bool) -> str:
    """Runs of byte ids are read for themselves."""
    out, run = [], bytearray()

    def close() -> None:
        raw = bytes(run)
        run.clear()
        while raw:
            try:
                out.append(raw.decode())
                return
            except UnicodeDecodeError as bad:
                out.append(raw[: bad.start].decode() + "�")
                raw = raw[bad.start + 1 :]

    for i in ids:
        if i in m.byte_ids:
            run += m.surface[i]
        else:
            close()
            out.append(m.surface[i].decode())
    close()
    return "".join(out)[1 if drop else 0 :]


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.concatenate(ids).view("<i4") if ids else np.empty(0, "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (with the begin and end ids) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for part in row_slices(batches, "text", SLICE):
            ids = encoder.encode(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), _id_lists(ids)], names=["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` of each row's ids; null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                text = [decode(m, ids or []) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Encodes each text, decodes the ids, and returns digests of both, in one pass without a shuffle.

    doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256; ids on request.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for part in row_slices(batches, "text", SLICE):
            ids = encoder.encode(part.column(1).to_pylist())
            sha = lambda raw: hashlib.sha256(raw).hexdigest()
            columns = {
                "doc_id": part.column(0),
                "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "ids_sha256": pa.array([sha(x) for x in ids], pa.string()),
                "decoded_sha256": pa.array([sha(decode(encoder.m, x.tolist()).encode()) for x in ids], pa.string()),
            }
            if with_ids:
                columns["ids"] = _id_lists(ids)
            yield pa.RecordBatch.from_pydict(columns)

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts(docs).mapInArrow(run, kind + ", ids array<int>" * with_ids)


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``n_tokens``, with the begin and end ids."""
    return encode_texts(docs, path).select("doc_id", F.size("ids").cast("long").alias("n_tokens"))
