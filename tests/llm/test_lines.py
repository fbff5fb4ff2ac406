import numpy as np
import odd
import plans
import pytest
import regex
import xxhash

from quotegrid.llm import components
from quotegrid.llm import lines as X
from quotegrid.llm.bitfilter import bit_filter, without_ids

CFG = X.LineConfig()


def words(line):
    return [w for w in regex.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", line.lower()) if w]


def simhash(ws):
    h = [xxhash.xxh64_intdigest(b.encode(), xxhash.xxh64_intdigest(a.encode(), 42)) for a, b in zip(ws, ws[1:], strict=False)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def edits(a, b):
    row = np.arange(len(b) + 1)
    codes = np.array([ord(c) for c in b])
    for i, c in enumerate(a):
        new = np.concatenate([[i + 1], np.minimum(row[1:] + 1, row[:-1] + (codes != ord(c)))])
        at = np.arange(new.size)
        row = np.minimum.accumulate(new - at) + at
    return int(row[-1])


def brute(rows):
    """Texts after deduplication, for (id, text)."""
    places = {}
    for d, (doc_id, text) in enumerate(rows):
        for i, line in enumerate((text or "").split("\n")):
            if text is not None and len(words(line)) >= CFG.min_words:
                places.setdefault(" ".join(words(line)), set()).add(((doc_id is not None, doc_id or 0, text), i, d))
    keys = list(places)
    sims = [simhash(k.split(" ")) for k in keys]
    up = list(range(len(keys)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            m = max(len(keys[i]), len(keys[j]))
            if (sims[i] ^ sims[j]).bit_count() <= CFG.radius and edits(keys[i], keys[j]) <= int(0.2 * m + 1e-9):
                up[find(i)] = find(j)
    first = {}
    for i, k in enumerate(keys):
        best = min((p[0][:2], p[1]) for p in places[k])
        first[find(i)] = min(first.get(find(i), best), best)
    out = []
    for d, (doc_id, text) in enumerate(rows):
        if text is None:
            out.append((doc_id, None))
            continue
        kept = []
        for i, line in enumerate(text.split("\n")):
            k = " ".join(words(line))
            if k not in places or first[find(keys.index(k))] == ((doc_id is not None, doc_id or 0), i):
                kept.append(line)
        out.append((doc_id, "\n".join(kept)))
    return out


BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def test_small_cases(spark):
    long = " ".join(f"word{i}" for i in range(300))
    rows = [
        (1, f"{BASE}\nshort line\n{long}"),
        (2, f"short line\n{BASE.upper()}!\nshort line"),
        (3, f"{long} changed\n\n  \n{BASE}\n{BASE}"),
        (4, f"{long.replace('word7 ', 'werd7 ')}\n{' '.join(reversed(BASE.split()))}"),
        (5, None),
        (6, ""),
        (None, f"unlike all the other lines here\n{BASE}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = X.dedup_lines(docs, counts=True).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(brute(rows), key=str)
    by = {r.doc_id: (r.n_lines, r.n_removed) for r in got}
    assert by[5] == (0, 0) and by[6] == (1, 0) and by[2] == (3, 1) and by[3] == (5, 3)


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(map(tuple, X.dedup_lines(docs).collect())) == sorted(brute(rows))


def test_groups_of_near_copies_lose_no_link(spark):
    """Many variants of one line, in chains of small edits, next to lines that only share blocks."""
    rng = np.random.default_rng(3)
    ws = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(60):
        ws = list(ws)
        ws[rng.integers(len(ws))] = f"x{d}"
        rows.append((d, " ".join(ws)))
    rows += [(100 + d, "to " * (5 + d)) for d in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, X.dedup_lines(docs).collect())) == sorted(brute(rows))


def test_odd_rows(spark):
    docs = odd.documents(spark)
    got = X.dedup_lines(docs)
    assert got.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in got.collect()}
    assert (13, "") in texts and (5, odd.DOCS[0][1]) in texts and (7, None) in texts and (None, odd.DOCS[7][1]) in texts
    assert got.count() == len(odd.DOCS)
    assert X.dedup_lines(odd.documents(spark, [])).count() == 0


@pytest.mark.parametrize("copies", [2, 4])
def test_rows_that_repeat_a_document_lose_no_short_line(spark, copies):
    base = [(1, "x y z\nalpha\n\n\n" + BASE), (2, "x y z\nbeta\n\n"), (3, BASE + "\n\nx y z")]
    docs = spark.createDataFrame(base * copies, "doc_id long, text string")
    got = X.dedup_lines(docs).collect()
    want = {1: base[0][1], 2: base[1][1], 3: "\nx y z"}
    assert len(got) == 3 * copies
    assert {(r.doc_id, r.text) for r in got} == set(want.items())


def test_lines_of_very_many_words(spark, monkeypatch):
    """Counters of 14 and of 30 bits give the same hashes."""
    rows = [(1, " ".join(f"w{i % 97}" for i in range(40))), (2, " ".join(f"w{i % 89}" for i in range(40_000)) + "\nfive words are in here")]
    docs = spark.createDataFrame(rows + rows[1:], "doc_id long, text string")
    found = {(r.doc_id, r.pos): r.sim % 2**64 for r in X.line_table(docs).collect()}
    assert found == {(d, i): simhash(words(line)) for d, text in rows for i, line in enumerate(text.split("\n"))}
    monkeypatch.setattr(X, "SHORT", 16)
    assert {(r.doc_id, r.pos): r.sim % 2**64 for r in X.line_table(docs).collect()} == found


def test_replaced_words_need_no_edit_distance_and_no_pair_is_lost(spark):
    """Word by word there are never fewer edits; pairs it says nothing about, or too many for, go by the edit distance."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(60):
        ws = [f"wörd{rng.integers(90)}" for _ in range(5 + k % 9)]
        other = [w if rng.random() < 0.8 else f"v{rng.integers(9)}" for w in ws]
        if k % 3 == 0:
            other.insert(int(rng.integers(len(ws))), "more")
        rows.append((2 * k, 2 * k + 1, " ".join(ws), " ".join(other)))
    pairs = spark.createDataFrame(rows, "a long, b long, x string, y string")
    bound = {r.a: r.n for r in pairs.select("a", X._word_edits("x", "y").alias("n")).collect()}
    assert all((bound[a] is None) == (a % 6 == 0) and (bound[a] is None or bound[a] >= edits(x, y)) for a, _, x, y in rows)
    assert sum(n == 0 for n in bound.values()) == sum(x == y for _, _, x, y in rows)
    both = spark.createDataFrame([(h, s) for a, b, x, y in rows for h, s in ((a, x), (b, y))], "h long, line string")
    want = {(a, b) for a, b, x, y in rows if edits(x, y) <= int(0.2 * max(len(x), len(y)) + 1e-9)}
    assert {tuple(r) for r in X._verified(pairs.select("a", "b"), both, CFG).collect()} == want and 0 < len(want) < 60


def test_documents_of_very_many_lines(spark):
    text = "\n".join(f"this is line number {i % 50} of them" for i in range(5000))
    got = X.dedup_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
    assert got == brute([(1, text)])[0][1]


def test_no_python_and_no_cross_join(spark):
    docs = odd.documents(spark)
    for df in (X.line_table(docs), X.dropped_lines(docs), X.dedup_lines(docs)):
        assert not plans.python_nodes(df) and not plans.cross_joins(df)


@pytest.mark.parametrize("n", [0, 3, 5000])
def test_bit_filter_lets_all_through_and_few_others(spark, n):
    test = bit_filter(spark.range(n), "id")
    seen = {r.id for r in spark.range(20000).where(test("id")).collect()}
    assert set(range(n)) <= seen and len(seen) - n < 0.2 * 20000


def test_without_ids(spark):
    docs = odd.documents(spark)
    left = without_ids(docs, spark.createDataFrame([(5,), (None,), (77,)], "doc_id long"))
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {r[0] for r in odd.DOCS} - {5, None}


@pytest.mark.parametrize("n", [127, 128, 129, 700])
def test_counters_of_eight_bits_do_not_overflow(spark, n):
    """A line of one pair repeated has counters as large as the line is long."""
    lines = ["same " * n, " ".join(f"w{i % 3}" for i in range(n)), BASE]
    docs = spark.createDataFrame([(1, "\n".join(lines))] * 2, "doc_id long, text string")
    want = [(i, simhash(words(line))) for i, line in enumerate(lines)]
    assert sorted((r.pos, r.sim % 2**64) for r in X.line_table(docs).collect()) == sorted(want * 2)


def test_lines_that_share_a_key_by_chance_are_joined_with_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(1, BASE)], "doc_id long, text string")
    occurrences, written, keep = X.line_table(docs), {}, X.materialize

    def materialize(df, name):
        out = keep(df, name)
        written.setdefault(name, out)
        return out

    monkeypatch.setattr(X, "materialize", materialize)
    unique = spark.createDataFrame([(1, 0, 9, 1), (2, -1 << 26, 9, 1), (3, 5, 9, 1)], "h long, sim long, chars int, n long")
    X.similar_lines(docs, occurrences, unique)
    groups = written["shared-keys"].collect()
    assert {(r.first, r.first ^ r.ends) for r in groups if r.n == 2} == {(1, 3)} and {r.n for r in groups} == {2}
    assert {tuple(r) for r in written["near"].collect()} == {(1, 3)}


def test_every_character_that_parts_words(spark):
    line = "".join(f"Ab{chr(c)}" for c in range(400) if chr(c) != "\n") + " z"
    assert spark.createDataFrame([(line,)], "line string").select(X.normal("line")).first()[0] == " ".join(words(line))


def test_groups_take_few_queries(spark, monkeypatch):
    """Each query leaves its plan, code and figures in the driver."""
    written = []
    for module in (X, components):
        monkeypatch.setattr(module, "materialize", lambda df, name="stage", f=module.materialize: written.append(name) or f(df, name))
    rows = [(k, BASE if k % 2 else BASE + f" and {k}\n" + BASE.replace("nine", f"n{k}")) for k in range(6)]
    got = X.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows)) and len(written) <= 18, written


def test_further_links_join_components_that_are_known(spark):
    rng = np.random.default_rng(7)
    pairs = [tuple(map(int, rng.integers(0, 200, 2))) for _ in range(150)]
    frame = lambda p: spark.createDataFrame(p, "a long, b long")
    at_once = components.connected_components(frame(pairs))
    later = components.with_links(components.connected_components(frame(pairs[:90])), frame(pairs[90:]))
    assert sorted(map(tuple, at_once.collect())) == sorted(map(tuple, later.collect()))


def test_stars_are_taken_for_components_without_a_round(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(components, "_large_star", lambda edges, f=components._large_star: rounds.append(1) or f(edges))
    frame = lambda p: spark.createDataFrame(p, "a long, b long")
    stars = components.connected_components(frame([(1, 5), (6, 1), (2, 9), (9, 2), (3, 3)]))
    assert sorted(map(tuple, stars.collect())) == [(1, 1), (2, 2), (5, 1), (6, 1), (9, 2)] and not rounds
    for links in ([(1, 5), (5, 7)], [(1, 5), (2, 5)]):
        least = min(min(p) for p in links)
        assert {tuple(r) for r in components.connected_components(frame(links)).collect()} == {(n, least) for p in links for n in p} and rounds.pop()
        rounds.clear()
