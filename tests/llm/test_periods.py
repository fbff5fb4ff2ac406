import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import LONG, documents

from quotegrid.llm import catalog, periods
from quotegrid.llm.periods import RunRule


def brute_runs(words, rule=RunRule()):
    """Every stretch of places that equal the ones p further on, for every p; the smallest p of a stretch counts."""
    ids = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if len(words) else np.zeros(0)
    out = {}
    for p in range(1, len(ids) // rule.periods + 1):
        same = np.flatnonzero(np.diff(np.r_[False, ids[:-p] == ids[p:], False].astype(int)))
        for start, end in same.reshape(-1, 2).tolist():
            size = end - start + p
            if size >= max(rule.least, rule.periods * p):
                out.setdefault((start, size), p)
    return sorted((s, n, p) for (s, n), p in out.items())


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def brute_rows(rows):
    """Rows of the registered query."""
    out = []
    for doc_id, text in rows:
        words = words_of(text)
        n = len(words)
        if doc_id is not None and n:
            h = zlib.crc32(str(doc_id).encode())
            g = h // 10
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        out.append((doc_id, words, brute_runs(words)))
    return out


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=24))
def test_lyndon_array(word):
    def lyndon(x):
        return all(x < x[k:] for k in range(1, len(x)))

    want = [max(j - i for j in range(i + 1, len(word) + 1) if lyndon(word[i:j])) for i in range(len(word))]
    assert periods.lyndon_array([9, *word], [True] + [False] * len(word))[1:] == want


BLOCKS = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 7)), max_size=7)
DOCS = st.lists(BLOCKS.map(lambda bs: [x for b, k in bs for x in b * k]), min_size=1, max_size=4)


@pytest.mark.parametrize("rule", [RunRule(), RunRule(2, 2), RunRule(3, 3), RunRule(12, 2), RunRule(1, 5)])
def test_runs_equal_brute_force(rule):
    @settings(max_examples=150, deadline=None)
    @given(DOCS)
    def check(docs):
        ids = np.array([x for d in docs for x in d], dtype=np.int64)
        got = periods.runs_of(ids, np.repeat(np.arange(len(docs)), [len(d) for d in docs]), rule)
        want, at = [], 0
        for d in docs:
            want += [(s + at, n, p) for s, n, p in brute_runs(d, rule)]
            at += len(d)
        assert [tuple(r) for r in got.tolist()] == want

    check()


def test_a_rule_needs_two_periods():
    with pytest.raises(ValueError):
        RunRule(6, 1)


def test_long_texts_take_little_time():
    n = 100_000
    same = periods.runs_of(np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64))
    assert same.tolist() == [[0, n, 1]]
    pairs = periods.runs_of(np.arange(n) % 777, np.zeros(n, dtype=np.int64))
    assert pairs.tolist() == [[0, n, 777]]


def test_find_runs_on_odd_rows(spark):
    extra = [(20, "a b " * 4 + "c " * 9 + "é\x00 " * 6, None, None), (21, "x\x1cy\x85 z " * 6, "l", "s")]
    docs = documents(spark).unionByName(documents(spark, extra))
    got = periods.find_runs(docs).collect()
    assert len(got) == docs.count()
    said = dict(tuple(d) for d in docs.select("doc_id", "text").collect())
    for r in got:
        words = words_of(said[r.doc_id])
        assert r.n_words == len(words)
        want = [(0, len(words), 6)] if said[r.doc_id] == LONG else brute_runs(words)
        assert [tuple(x) for x in r.runs] == want
        assert r.collapsed == collapse(words, want)
    assert periods.run_digests(periods.find_runs(docs.limit(0))).collect() == []


def test_whole_table(spark):
    got = {r.doc_id: tuple(r)[1:] for r in catalog.op11_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    found = made = 0
    for doc_id, words, runs in brute_rows(rows):
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2])
        want += (digest("".join("%d,%d,%d\n" % r for r in runs)), digest(collapse(words, runs)))
        assert got[doc_id] == want
        found += bool(runs)
        made += zlib.crc32(str(doc_id).encode()) % 10 == 0
    assert found >= made / 2 > 3


def test_made_runs_of_null_and_blank_texts(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    docs = spark.createDataFrame([(ids[0], None), (ids[1], " \n"), (ids[2], "a b c d"), (None, "a b")], "doc_id long, text string")
    got = dict(tuple(r) for r in periods.with_made_runs(docs).collect())
    want = {i: " ".join(w) for i, w, _ in brute_rows([(ids[2], "a b c d")])}
    assert got == {ids[0]: None, ids[1]: "", None: "a b"} | want
