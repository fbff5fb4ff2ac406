import math

import duckdb
import odd
import plans
import pytest
import regex
from pyspark.sql import functions as F

from quotegrid.llm import quality as X
from quotegrid.llm import sql


def brute(text):
    text = text or ""
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup, n_lines = set(), 0, 0
    for line in text.split("\n"):
        if regex.search(r"[^\x20\x09-\x0D]", line):
            n_lines += 1
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    cover = {k for places in at.values() if len(places) > 1 for i in places for k in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(regex.findall(r"[#*$%&|<>]", text)), n_lines, dup, len(cover)


CASES = [
    "a b c d e a b c d e",
    "a b c d e f a b c d e\na b c d e",
    "x " * 40,
    "one two three four five\none two three four five\n\n \t\none two three four five ",
    "#tag *star* $5 % & | <b> é日 \U0001f600",
    " leading\x0bvertical\x0cfeed\rreturn\xa0nbsp ",
    "a b c d",
]


def test_figures_equal_counting(spark):
    rows = [(t,) for t in CASES] + [(r[1],) for r in odd.DOCS]
    rows += [(r.text,) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = X.text_figures(spark.createDataFrame(rows, "text string").withColumn("n_words", F.lit("clash")), "text").collect()
    for r in got:
        assert tuple(r)[1:] == tuple(brute(r.text)[k] for k in (1, 2, 0, 3, 4, 5)), r.text


@pytest.mark.parametrize(("n", "k", "p"), [(10, 0, 0.3), (50, 3, 0.2), (400, 1, 0.01), (7, 7, 0.5), (2000, 5, 0.01), (0, 0, 0.01)])
def test_binomial_tail_is_exact(spark, n, k, p):
    df = spark.createDataFrame([(n, k)], "n long, k long")
    got = df.select(X.binomial_tail(F.col("n"), F.col("k"), p)).first()[0]
    want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if k < n * p else 1.0
    assert got == pytest.approx(want, rel=1e-9)


def labelled(spark, n_good, rejected_good, n_bad, rejected_bad):
    """Rows of one stratum with so many documents of symbols, on either side."""
    row = lambda good, hit: ("en", good, 100, 500, 60 if hit else 0, 10, 0, 0)
    rows = [row(True, i < rejected_good) for i in range(n_good)] + [row(False, i < rejected_bad) for i in range(n_bad)]
    names = "stratum string, good boolean, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
    return spark.createDataFrame(rows, names)


def test_a_cutoff_needs_enough_good_documents(spark):
    cut = lambda *n: X.certified_cutoffs(labelled(spark, *n)).collect()
    assert [r.cut_symbols for r in cut(3000, 0, 100, 90)] == [0.5]  # the most lenient that rejects as many
    assert cut(100, 0, 100, 90) == []  # too few to be sure of
    assert cut(3000, 300, 100, 90) == []  # rejects too many good ones
    assert cut(3000, 0, 100, 0) == []  # rejects nothing bad


def test_verdicts_on_odd_rows(spark):
    docs = odd.documents(spark)
    got = X.quality_verdicts(docs, odd.labels(spark)).collect()
    assert len(got) == len(odd.DOCS)
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[7, 0].base_failed and by[8, 0].base_failed and not by[7, 0].kept
    assert by[5, 14].kept and not by[10, 36000].kept
    assert X.quality_verdicts(odd.documents(spark, []), odd.labels(spark)).count() == 0
    assert X.quality_verdicts(docs, odd.labels(spark).limit(0)).count() == len(odd.DOCS)


def test_sql_and_plan(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    want = con.execute(f"select * from ({sql.OP9}) order by doc_id").fetchall()
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    df = X.quality_verdicts(docs, labels)
    assert [tuple(r) for r in df.orderBy("doc_id").collect()] == want
    assert not plans.python_nodes(df) and not plans.cross_joins(df)


def test_sql_with_certified_cutoffs(spark):
    """A table with labels enough for cutoffs: the operator's method decides rows, and SQL agrees on each."""
    sf = "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.execute(f"select * from ({sql.OP9}) order by doc_id").fetchall()
    got = X.quality_verdicts(*(spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want
    assert sum(not r.kept and not r.base_failed for r in got) > 100
