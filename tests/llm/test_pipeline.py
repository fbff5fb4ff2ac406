"""The pipeline's stages, each on what its predecessor kept, against brute force; and what is registered."""

import collections
import hashlib

import corpus_pipeline
import odd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_lines import brute as brute_lines
from test_lines import words
from test_mixing import brute_targets
from test_simhash import brute_components, brute_fp

from quotegrid.llm import all_oracles, all_queries
from quotegrid.llm.common import held_out
from quotegrid.llm.toxicity import toxicity
from quotegrid.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """Rows after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        out.append(docs)
    return out


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_columns(kept):
    assert all(df.columns == kept[0].columns for df in kept[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity",
        "line dedup",
        "SimHash near-dedup",
        "mixing sources to target weights",
        "SentencePiece encoding and decoding",
    ]


def test_toxic_documents_go(spark, kept):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~held_out(F.col("doc_id")))
    gone = {r.doc_id for r in toxicity(kept[0], labels).where("predicted = 1").collect()}
    assert gone and {r for r in rows(kept[1], *kept[0].columns)} == {r for r in rows(kept[0], *kept[0].columns) if r[0] not in gone}


def test_lines(kept):
    want = {}
    texts = dict(rows(kept[1], "doc_id", "text"))
    for doc_id, text in brute_lines(list(texts.items())):
        if text == texts[doc_id] or words(text):
            want[doc_id] = (text, len(text))
    assert {i: (t, n) for i, t, n in rows(kept[2], "doc_id", "text", "n_chars")} == want


def test_one_of_each_group(kept):
    marked = [(i, brute_fp(t, 4)) for i, t in rows(kept[2], "doc_id", "text")]
    want = {i for (i, _), c in zip(marked, brute_components(marked, 4), strict=True) if i == c}
    assert {r for r in rows(kept[3], "doc_id", "text")} == {r for r in rows(kept[2], "doc_id", "text") if r[0] in want}


def test_mix(kept):
    size = {i: (s, len((t or "").split())) for i, s, t in rows(kept[3], "doc_id", "source", "text")}
    sums = collections.Counter()
    for s, n in size.values():
        sums[s] += n
    taken = collections.Counter()
    copies = collections.Counter(i for (i,) in rows(kept[4], "doc_id"))
    for i, n in copies.items():
        assert n <= 3
        taken[size[i][0]] += n * size[i][1]
    for s, t in brute_targets(dict(sums)).items():  # ten documents a source here: off by less than the largest of them
        assert abs(taken[s] - t) < max(n for at, n in size.values() if at == s)


def test_tokens(kept):
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for i, t in rows(kept[4], "doc_id", "text"):
        ids = lib.encode(t, add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(lib.decode(ids).encode()).hexdigest(), ids))
    assert sorted(rows(kept[5], "doc_id", "n_tokens", "decoded_sha256", "ids")) == sorted(want)


def test_odd_and_empty_tables_go_through(spark):
    left = {}
    for what, docs in (("odd", odd.documents(spark)), ("empty", odd.documents(spark, []))):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), "test-stage")
        left[what] = docs.collect()
    assert left["empty"] == []
    ids = {r.doc_id for r in left["odd"]}
    # copies of 5 lose their line to it, and of the group of blank texts the first stays
    assert {5, 10} <= ids <= {r[0] for r in odd.DOCS} - {8, 9, 13}
    assert all(r.n_tokens == len(r.ids) >= 2 for r in left["odd"])


def test_a_document_with_any_word_left_stays(spark):
    licence = "this text may be copied under the terms of the licence"
    poem = "\n".join(f"verse {i}" for i in range(300))
    rows = [(1, licence), (2, f"{licence}\n{poem}"), (3, licence), (4, f"{licence}\n...\n"), (5, "..."), (6, f"日本語\n{licence}")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.dedup_lines(spark, docs, SF).collect()}
    assert got == {i: (t, len(t)) for i, t in {1: licence, 2: poem, 5: "...", 6: "日本語"}.items()}


def test_registered():
    import __spark_entry__ as entry

    names = list(all_queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert set(all_oracles()) <= set(names) and set(names) | {"pipeline"} <= set(entry.queries())
    assert set(all_oracles()) <= set(entry.oracle_sql())
