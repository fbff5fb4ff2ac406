import duckdb
import odd
import plans
import pytest
import regex
from pyspark.sql import functions as F

from quotegrid.llm import mixing as X
from quotegrid.llm import sql


def test_word_count(spark):
    rows = [(r[1],) for r in odd.DOCS] + [("a\xa0b c\x0bd",)]
    got = spark.createDataFrame(rows, "text string").select("text", X.word_count(F.col("text")).alias("n")).collect()
    assert all(r.n == len(regex.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in got)


def brute_targets(sizes, most=3):
    """Shares handed out, and what a source cannot take handed out again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        t = {s: most * sizes[s] if s in full else w[s] * left / free for s in names}
        above = {s for s in names if s not in full and t[s] > most * sizes[s]}
        if not above:
            return t
        full |= above


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 20, None: 5}, {"a": 1000, "b": 1, "c": 1, "d": 2, "é": 3}, {"a": 0, "b": 7}, {"x": 4}, {"a": 100, "b": 30, "c": 5, "d": 1000}],
)
def test_targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    got = X.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()
    assert {r.source: r.target for r in got} == pytest.approx(brute_targets(sizes))


def test_balance_of_two_margins_meets_both(spark):
    cells = spark.createDataFrame([("a", "x", 100.0), ("a", "y", 50.0), ("b", "x", 30.0), ("b", "y", 200.0)], "source string, lang string, size double")
    goal = lambda c, **t: spark.createDataFrame(list(t.items()), f"{c} string, target double")
    got = X.balance(cells, {"source": goal("source", a=200.0, b=180.0), "lang": goal("lang", x=190.0, y=190.0)}, close=1e-9)
    rows = got.collect()
    for col, name, want in (("source", "a", 200), ("source", "b", 180), ("lang", "x", 190), ("lang", "y", 190)):
        assert sum(r["size"] * r.rate for r in rows if r[col] == name) == pytest.approx(want, rel=1e-6)


def test_newton_returns_from_the_cap(spark):
    cells = spark.createDataFrame([("a", 100.0), ("b", 100.0), ("c", 100.0)], "source string, size double")
    goal = spark.createDataFrame([("a", 211.8), ("b", 300.0), ("c", 0.5)], "source string, target double")
    got = {r.source: r.rate for r in X.balance(cells, {"source": goal}).collect()}
    assert got == pytest.approx({"a": 2.118, "b": 3.0, "c": 0.005})


@pytest.mark.parametrize("cell", [4, 1 << 16])
def test_sources_come_near_their_targets(spark, monkeypatch, cell):
    monkeypatch.setattr(X, "CELL", cell)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = X.mix(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    assert (got.taken <= 3 * got["size"]).all() and (got.copies >= 0).all() and len(got) == docs.count()
    sums = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"))
    assert ((sums.taken - sums.target).abs() <= 0.02 * sums.target + 100).all()
    assert sums.target.to_dict() == pytest.approx(brute_targets(sums["size"].to_dict()))
    again = X.mix(docs.repartition(7)).toPandas()
    key = ["doc_id", "copies"]
    assert got[key].sort_values("doc_id").values.tolist() == again[key].sort_values("doc_id").values.tolist()


def test_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(f"select doc_id, size, source_size, target, taken from ({sql.OP8}) order by doc_id").fetchall()
    assert [tuple(r) for r in X.mix(docs).orderBy("doc_id").select("doc_id", "size", "source_size", "target", "taken").collect()] == want


def test_odd_rows(spark):
    docs = odd.documents(spark)
    got = X.mix(docs).collect()
    assert len(got) == len(odd.DOCS) and all(0 <= r.taken <= 3 * r["size"] for r in got)
    mixed = X.take(docs)
    assert mixed.columns == docs.columns
    per = {}
    for r in got:
        per[r.doc_id] = per.get(r.doc_id, 0) + r.copies
    rows = [r.doc_id for r in mixed.collect()]
    assert {i: rows.count(i) for i in per} == per
    empty = odd.documents(spark, [])
    assert X.mix(empty).count() == 0 and X.take(empty).count() == 0


def test_no_python(spark):
    docs = odd.documents(spark)
    assert not plans.python_nodes(X.mix(docs)) and not plans.cross_joins(X.mix(docs)) and not plans.python_nodes(X.take(docs))
