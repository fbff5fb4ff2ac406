import re
from hashlib import md5

import numpy as np
import odd
from pyspark.sql import functions as F

from quotegrid.llm import toxicity as X
from quotegrid.llm.common import held_out


def word(w):
    h = 0
    for c in w:
        h = (h * X.PRIME + ord(c)) % (1 << 64)
    return (h * X.MIX % (1 << 64)) >> 44


def stem(w):
    return X.TERMS + word(w[:4])


def counts(text, wanted=None):
    at, n = X.term_counts([text], wanted)[0]
    assert (np.diff(at) > 0).all()
    return dict(zip(at.tolist(), n.tolist(), strict=True))


def test_terms():
    text = "Idiot, idiots! IDIOT x2 é"
    want = {word("idiot"): 2, word("idiots"): 1, word("x"): 1, word("é"): 1}
    assert counts(text) == want | {stem("idio"): 3}
    wanted = np.ones(2 * X.TERMS, bool)
    wanted[X.TERMS :] = False
    assert counts(text, wanted) == want and counts("") == counts(" 12 _") == {}
    assert counts("a" * 64)[word("a" * 64)] == 1 and len(counts("b" * 65 + " " + "b" * 65)) == 2 and counts("b" * 65)[stem("bbbb")] == 1
    each = ["", text, "İİ ½ Ⅷ", "\U0001f600 \ud800x", text, "", "日本語 " * 5000]
    for got, t in zip(X.term_counts(each), each, strict=True):
        by_hand = {}
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            for h in [word(w)] + [stem(w)] * (len(w) > 4):
                by_hand[h] = by_hand.get(h, 0) + 1
        assert dict(zip(*(x.tolist() for x in got), strict=True)) == by_hand
    assert X.term_counts([]) == []


def dense(examples, weights):
    out = np.zeros((len(examples), weights.size))
    for row, (_, _, _, t, c) in enumerate(examples):
        at, w = X._unit(np.array(t, np.int64), c, weights)
        out[row, at] = w
    return out


def test_block_max_search_is_exact():
    rng = np.random.default_rng(5)
    weights = rng.uniform(0.5, 5, 60)
    weights[:5] *= 100
    weights[59] = 0
    often = np.arange(60, 0, -1) / 1830
    vector = lambda: sorted(rng.choice(60, rng.integers(1, 9), replace=False, p=often).tolist())
    examples = [(i * 3, int(rng.integers(2)), 1.0, t := vector(), rng.integers(1, 5, len(t)).tolist()) for i in range(3000)]
    examples += [(9001, 1, 2.0, [], []), (9002, 0, 5.0, [], []), (9003, 0, 1.0, [59], [2])]
    index = X.BlockMaxIndex.build(examples, weights)
    bare = [e for e in examples if not set(e[3]) - {59}]
    assert index.plain == sum(e[2] for e in bare if e[1]) / sum(e[2] for e in bare)
    of = dense(examples, weights)
    some = [examples[row][3:] for row in range(0, 3000, 50)] + [([], []), ([59], [1])]
    for one, many in zip((index.search(*q) for q in some), index.search_many(some), strict=True):
        assert one[0].tolist() == many[0].tolist() and np.allclose(one[1], many[1], atol=1e-9)
    assert 0 < (index.common()[0] >= 0).sum() < 60
    for row in range(0, 3000, 50):
        doc_id, _, _, t, c = examples[row]
        cosine = np.round(of @ of[row], 12)
        cosine[row] = 0
        want = sorted((-s, examples[i][0]) for i, s in enumerate(cosine) if s > 0)[: X.NEIGHBOURS]
        rows, got = index.search(t, c, without=doc_id)
        assert index.ids[rows].tolist() == [i for _, i in want]
        np.testing.assert_allclose(got, [-s for s, _ in want], atol=1e-9)


def test_a_search_skips_blocks(monkeypatch):
    """With a heavy term in few examples only their blocks are looked at."""
    examples = [(i, 0, 1.0, [i % 7, 7 + i % 11], [1, 1]) for i in range(6400)] + [(7000 + i, 1, 1.0, [0, 20 + i % 2], [1, 1]) for i in range(40)]
    weights = np.ones(22)
    weights[20:] = 100
    index, seen = X.BlockMaxIndex.build(examples, weights), []
    plain = X.BlockMaxIndex._blocks
    monkeypatch.setattr(X.BlockMaxIndex, "_blocks", lambda self, blocks, *a: seen.extend(blocks.tolist()) or plain(self, blocks, *a))
    rows, cosines = index.search([0, 20], [1, 1])
    assert index.ids[rows].tolist() == [7000 + 2 * i for i in range(16)] and np.allclose(cosines, 1)
    assert len(set(seen)) <= 4 and len(index.own_first) == 6441
    seen.clear()
    index.search([0, 1, 7, 8, 9], [1] * 5)  # no heavy term
    assert not seen


def test_scores_equal_dense_cosines(spark):
    """Neighbours of every document of a table, against cosines with all examples over all terms."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = X.learn(docs, labels)
    index, texts = model.index, {r.doc_id: r.text or "" for r in docs.collect()}
    n = {}
    for text in texts.values():
        for t in counts(text):
            n[t] = n.get(t, 0) + 1
    weight = lambda t: 0 if t not in n or (t >= X.TERMS and not index.weights[t]) else np.log((1 + len(texts)) / (1 + n[t]))
    lifts = {round(float(index.weights[t]) / weight(t)) for t in n if weight(t) > 0}
    assert lifts <= {1, 100} and 1 in lifts

    def vector(text):
        v = {t: (1 + np.log(c)) * float(index.weights[t]) for t, c in counts(text).items() if index.weights[t] > 0}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    examples = {int(i): vector(texts[int(i)]) for i in index.ids}
    for r in X.scores(docs, model).collect():
        v = vector(texts[r.doc_id])
        every = {i: sum(x * e.get(t, 0) for t, x in v.items()) for i, e in examples.items()}
        want = sorted(((-c, i) for i, c in every.items() if c > 0))[:3]
        np.testing.assert_allclose([e.cosine for e in r.evidence], [-c for c, _ in want], atol=1e-6)
        if r.doc_id in examples:
            assert abs(r.evidence[0].cosine - 1) < 1e-9


def test_copies_of_toxic_examples_of_rare_words_are_found(spark):
    name = lambda i, k: "".join(chr(97 + x % 26) for x in md5(f"{i} {k}".encode()).digest()[:9])
    toxic = [" ".join(name(i, k) for k in range(12)) for i in range(50)]
    clean = [f"the river and the bank of town {'north south east west'.split()[i % 4]} {name(900 + i, 1)} went by" for i in range(400)]
    rows = [(i, t, 1) for i, t in enumerate(toxic)] + [(100 + i, t, 0) for i, t in enumerate(clean)]
    rows += [(1000 + i, t, None) for i, t in enumerate(toxic)] + [(2000 + i, t, None) for i, t in enumerate(clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    got = {r.doc_id: r for r in X.toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")).collect()}
    assert all(got[1000 + i].predicted == 1 and got[1000 + i].evidence[0].doc_id == i for i in range(50))
    assert not any(got[2000 + i].predicted for i in range(400))


def test_copies_of_all_toxic_examples_find_them_first(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = X.toxicity(docs, labels).join(labels.where("toxic = 1"), "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert len(found) == 51 and all(text[r.evidence[0].doc_id] == r.text and r.evidence[0].cosine > 1 - 1e-9 for r in found)


def test_calibration_rises_and_keeps_the_mean():
    rng = np.random.default_rng(0)
    vote = rng.uniform(0, 1, 500).round(2)
    y = (rng.uniform(0, 1, 500) < vote**2).astype(float)
    w = rng.uniform(1, 3, 500)
    c = X.Calibration.fit(vote, y, w)
    assert (np.diff(c.shares) > 0).all()
    got = np.array([c(v) for v in vote])
    assert np.isclose((got * w).sum(), (y * w).sum()) and ((got >= 0) & (got <= 1)).all()


def test_sample_has_a_bound_and_keeps_the_shares(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    got = X.sampled_labels(rows, 1000).groupBy("toxic").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()
    assert all(800 < r.n < 1200 for r in got)
    assert {r.toxic: round(r.w, -3) for r in got}.keys() == {0, 1} and all(abs(r.w / {0: 18000, 1: 2000}[r.toxic] - 1) < 0.15 for r in got)


def test_held_out_toxic_documents_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = X.toxicity(docs, labels.where(~held_out(F.col("doc_id"))))
    t = found.join(labels.where(held_out(F.col("doc_id"))), "doc_id").select("score", "predicted", "toxic").toPandas()
    toxic = t[t.toxic == 1]
    assert toxic.predicted.mean() > 0.75 and t[t.toxic == 0].predicted.mean() < 0.04
    assert ((t.score - t.toxic) ** 2).mean() < 0.5 * toxic.shape[0] / t.shape[0]


def test_odd_rows(spark):
    docs = odd.documents(spark)
    got = X.toxicity(docs, odd.labels(spark)).collect()
    assert len(got) == len(odd.DOCS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert X.toxicity(odd.documents(spark, []), odd.labels(spark)).count() == 0
    none = X.toxicity(docs, odd.labels(spark).limit(0)).collect()
    assert len(none) == len(odd.DOCS) and {r.score for r in none} == {0.0}
