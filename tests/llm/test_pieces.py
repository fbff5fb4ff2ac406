import hashlib

import odd
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from quotegrid.llm import pieces as X

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
ENCODER = X.Encoder(PATH)


def library(text):
    return LIB.encode(text, add_bos=True, add_eos=True)


@pytest.mark.parametrize(
    "text",
    ["", " ", "  a  b\n\tc ", "é é ﬁ Ａ▁x\r\n\x00y　z", " " * 1000, "a" * 3000, "ab" * 400 + " " * 37 + "日本語" * 200, "<s></s><0x0A>", odd.LONG],
)
def test_ids_equal_the_library(text):
    assert ENCODER.encode([text])[0].tolist() == library(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("  abethinors▁\n<>é日\U0001f600"), st.characters(codec="utf-8"))), max_size=5))
def test_any_texts(batch):
    assert [x.tolist() for x in ENCODER.encode(batch)] == [library(t) for t in batch]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 260)), max_size=12))
def test_any_ids_decode_as_in_the_library(ids):
    assert X.decode(ENCODER.m, ids) == LIB.decode(ids)


def test_long_words_by_heap_equal_rounds(monkeypatch):
    text = "antidisestablishmentarianism" * 9
    want = library(text)
    for bound in (4, 100_000):
        monkeypatch.setattr(X, "LONG", bound)
        assert X.Encoder(PATH).encode([text])[0].tolist() == want


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(X, "KNOWN_WORDS", 2)
    e = X.Encoder(PATH)
    for text in ("one two three", "two three four", "one five"):
        assert e.encode([text])[0].tolist() == library(text)


def test_odd_rows(spark):
    got = X.round_trip_digests(odd.documents(spark), PATH).collect()
    want = []
    for doc_id, text, *_ in odd.DOCS:
        ids = library(text or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(LIB.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert X.round_trip_digests(odd.documents(spark, []), PATH).count() == 0


def test_separate_encoding_and_decoding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    ids = X.encode_texts(docs, PATH)
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == text[r.doc_id] for r in X.decode_ids(ids, PATH).collect())
    assert {r.doc_id: r.n_tokens for r in X.count_tokens(docs, PATH).collect()} == {k: len(library(t)) for k, t in text.items()}
