import hashlib

import numpy as np
import odd
import pytest

from quotegrid.llm import fingerprints as X

CFG = X.DigestConfig()


def brute_bins(blob, w):
    """Entropy bin of each window, counted afresh."""
    k = np.arange(w + 1, dtype=float)
    k[0] = 1
    g = np.rint(k * np.log2(k) * (1 << 20) / (w * np.log2(w))).astype(int)
    out = []
    for i in range(len(blob) - w + 1):
        counts = [blob[i : i + w].count(bytes([b])) for b in set(blob[i : i + w])]
        out.append(min(999, ((1 << 20) - sum(int(g[c]) for c in counts)) * 1000 >> 20))
    return out


def brute_features(blob, ranks, cfg):
    """Positions that win often enough, by looking at every neighbourhood."""
    w = cfg.window
    n = len(blob) - w + 1
    if n < 1:
        return []
    rank = [int(ranks[b]) for b in brute_bins(blob, w)]
    size = 1 << X._level(len(blob), w)
    wins = {}
    for i in range(n - size + 1):
        best = min(range(i, i + size), key=lambda k: (rank[k], k))
        if rank[best] < X.BINS:
            wins[best] = wins.get(best, 0) + 1
    return [k for k in sorted(wins) if wins[k] >= max(1, size // cfg.popularity)]


@pytest.fixture(scope="module")
def ranks():
    rng = np.random.default_rng(1)
    r = rng.permutation(X.BINS).astype(np.int64)
    r[: CFG.min_bin] = X.BINS
    return r


TEXTS = [b"", b"a", b"short text here ok", b"the quick brown fox jumps over the lazy dog " * 9, bytes(range(256)) * 3, b"a" * 500, bytes(i * i % 251 for i in range(3000))]


def test_entropy_bins_equal_counting():
    for blob in TEXTS[2:]:
        assert X._entropy_bins(np.frombuffer(blob, np.uint8), 16).tolist() == brute_bins(blob, 16)


@pytest.mark.parametrize("slice_bytes", [1 << 20, 700])
def test_features_equal_brute_force_however_texts_are_cut(ranks, monkeypatch, slice_bytes):
    monkeypatch.setattr(X, "SLICE", slice_bytes)
    got = X.features(TEXTS, ranks, CFG)
    for blob, h in zip(TEXTS, got, strict=True):
        at = brute_features(blob, ranks, CFG)
        if at:
            want = X._hash_windows(np.frombuffer(blob, np.uint8), np.array(at), CFG.window).tolist()
            assert h.tolist() == list(dict.fromkeys(want))
        else:
            assert len(h) == (1 if blob else 0)


def test_likeness_bounds_and_symmetry(ranks):
    text = b" ".join(b"%d" % (i * i) for i in range(200))
    a, b = (X.filters(h, CFG) for h in X.features([text, text[:600] + b"other words come now" * 9], ranks, CFG))
    none = X.filters(np.empty(0, np.uint64), CFG)
    assert X.likeness(a, a) == 1 and X.likeness(none, none) == 1 and X.likeness(a, none) == 0
    assert 0 < X.likeness(a, b) < 1 and X.likeness(a, b) == X.likeness(b, a)
    assert np.array_equal(X.decode(X.encode(X.features([text], ranks, CFG)[0], a)), a)


def test_pairs_over_odd_rows(spark):
    docs = odd.documents(spark)
    got = X.fingerprint_pairs(docs, X.rarity_ranks(docs)).toPandas()
    rows = sorted(((r[0], r[1] or "") for r in odd.DOCS), key=lambda r: (r[0] is not None, r[0], r[1]))
    assert len(got) == len(rows)
    want = []
    for i, (doc_id, text) in enumerate(rows):
        q = len(text) // 4
        edited = text[: len(text) - q] + rows[(i + 1) % len(rows)][1][:q]
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    have = [(None if d != d else int(d), n, h) for d, n, h in got[["doc_id", "n_chars", "edited_sha256"]].itertuples(index=False)]
    assert sorted(have, key=str) == sorted(want, key=str)
    same = got[got.doc_id.isin([5, 13])]
    assert same.fingerprint.nunique() == 1 and got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()


def test_empty_table(spark):
    docs = odd.documents(spark, [])
    assert X.fingerprint_pairs(docs, X.rarity_ranks(docs)).count() == 0


def test_edits_are_near_and_neighbours_are_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = X.fingerprint_pairs(docs, X.rarity_ranks(docs)).toPandas()
    long = got[got.n_chars > 200]
    assert long.near_edited.median() > 0.6 and long.near_next.median() < 0.1
