import numpy as np
import odd
import pytest
import regex
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quotegrid.llm import simhash as X
from quotegrid.llm.components import connected_components


def brute_fp(text, k):
    text = regex.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius):
    """Smallest id reachable, for rows of (id, fingerprint)."""
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                up[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), doc_id) if x is not None), default=None)
    return [least[find(i)] for i in range(len(rows))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB \t\n\x0bÀé日  ")), max_size=4), st.integers(1, 5))
def test_fingerprints_equal_counting(batch, k):
    assert X.fingerprints_of(batch, k).tolist() == [brute_fp(t, k) for t in batch]


def test_texts_of_very_many_shingles():
    text = " ".join(str(i * i % 997) for i in range(3000))
    assert X.fingerprints_of([text, odd.LONG], 4).tolist() == [brute_fp(text, 4), brute_fp(odd.LONG, 4)]


@pytest.mark.parametrize("strip", [3, 128])
@pytest.mark.parametrize("radius", [0, 3, 4])
def test_tiles_connect_what_all_pairs_connect(monkeypatch, strip, radius):
    monkeypatch.setattr(X, "STRIP", strip)
    monkeypatch.setattr(X, "CHUNK", 7)
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    flips = [np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, 3).astype(np.uint64)) for _ in range(200)]
    fps = np.unique(np.concatenate([base, base[rng.integers(0, 12, 200)] ^ np.array(flips)]))
    a, b = fps[::2], fps[1::2]
    up = {int(x): int(x) for x in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in (X.tile_links(a, None, radius), X.tile_links(b, None, radius), X.tile_links(a, b, radius)):
        for p, q in zip(x.tolist(), y.tolist(), strict=True):
            up[find(p)] = find(q)
    rows = [(int(x), int(x)) for x in fps]
    want = brute_components(rows, radius)
    got = [find(x) for x, _ in rows]
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


@pytest.mark.parametrize("tile", [5, 1 << 16])
def test_documents_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(X, "TILE", tile)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, brute_fp(r.text, 4)) for r in docs.collect()]
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in X.near_duplicates(docs, 4, 4).collect()}
    assert got == {i: (fp, c) for (i, fp), c in zip(rows, brute_components(rows, 4), strict=True)}


def test_odd_rows(spark):
    rows = [(r[0], brute_fp(r[1], 4)) for r in odd.DOCS]
    want = sorted(((i, c) for (i, _), c in zip(rows, brute_components(rows, 4), strict=True)), key=str)
    got = X.near_duplicates(odd.documents(spark), 4, 4).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == want
    kept = X.keep_one(odd.documents(spark), 4, 4)
    assert kept.columns == odd.documents(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({str(i) for i, c in want if i == c})
    empty = odd.documents(spark, [])
    assert X.near_duplicates(empty).count() == 0 and X.keep_one(empty).count() == 0


def test_components_of_chains_stars_and_odd_links(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(1, 1), (None, 3), (9, 8), (8, 9)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 260)]} | {8: 8, 9: 8}
    assert got == want
