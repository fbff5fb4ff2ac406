import odd
import pytest
import zstandard
from pyspark.sql import functions as F

from quotegrid.llm import language as X
from quotegrid.llm.common import held_out


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = X.learn(docs.where(~held_out(F.col("doc_id"))))
    assert set(model.dictionaries) == {"de", "en", "es", "fr"}
    assert max(map(len, model.dictionaries.values())) <= X.PIECES * (4 * X.PIECE + 1)
    got = X.predict_languages(docs, model).join(docs.where(held_out(F.col("doc_id"))).select("doc_id", "lang"), "doc_id").toPandas()
    right = got.lang == got.lang_pred
    assert right.mean() > 0.98 and got.score.between(0, 1).all()
    assert got.accepted.mean() > 0.98 and right[got.accepted].mean() > 0.98


def test_odd_rows(spark):
    docs = odd.documents(spark)
    got = {(r.doc_id, r.lang_pred) for r in X.predict_languages(docs, X.learn(docs)).collect()}
    assert {(7, "und"), (8, "und"), (9, "und"), (-3, "und")} <= got and (5, "en") in got
    assert X.predict_languages(odd.documents(spark, []), X.learn(odd.documents(spark, []))).count() == 0
    assert {r.lang_pred for r in X.predict_languages(docs, X.LanguageModel({})).collect()} == {"und"}


def test_narrow_margins_are_rejected():
    m = X.LanguageModel({"aa": b"lorem ipsum dolor sit amet " * 4, "bb": b"lorem ipsum dolor sit amet " * 4})
    assert X.Classifier(m).predict("lorem ipsum") == ("aa", 0.5, 0.0, False)
    m = X.LanguageModel({"aa": b"lorem ipsum dolor sit amet " * 4, "bb": b"quick brown foxes jump over lazy dogs " * 4})
    lang, score, margin, accepted = X.Classifier(m).predict("Foxes jump over the lazy dogs")
    assert lang == "bb" and score > 0.5 and margin > X.REJECT and accepted


def test_copies_of_one_text_are_learnt_once(spark):
    rows = [("the same text again and again, a hundred times over", "en")] * 3000 + [(f"text number {i} of its own kind", "en") for i in range(50)]
    rows += [(f"ein deutscher satz nummer {i} der sammlung", "de") for i in range(50)]
    model = X.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert model.dictionaries["en"].count(b"the same text again") <= 1


def test_a_common_opening_does_not_fill_the_dictionary(spark):
    header = "all rights reserved by the publisher of this archive " * 12
    body = lambda i: " ".join(f"w{chr(97 + (i * k) % 26)}{chr(97 + (i + k) % 26)}{chr(97 + k % 26)}" for k in range(2000))
    model = X.learn(spark.createDataFrame([(header + body(i), "en") for i in range(100)], "text string, lang string"))
    raw = model.dictionaries["en"]
    assert len(raw) > 20 * X.PIECE and raw.count(b"publisher") < 60


@pytest.mark.parametrize("text", ["½ ² 12", "Ⅷ ⅷ ①", "٣٤ _", "\u0300 \u20dd", "…!?"])
def test_texts_without_a_letter_have_no_language(text):
    classifier = X.Classifier(X.LanguageModel({"aa": b"lorem ipsum dolor sit amet " * 4}))
    assert classifier.predict(text)[0] == "und" and classifier.predict(text + "ª")[0] == "aa"


def test_languages_equal_plain_compression(spark):
    """Against one call of the library for each language and text, with nothing prepared or cut into a fast and a deep look."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = X.learn(docs.where(~held_out(F.col("doc_id"))))
    texts = dict(tuple(r) for r in docs.select("doc_id", "text").collect())
    seen = 0
    for r in X.predict_languages(docs, model).collect():
        raw = X.letters(texts[r.doc_id] or "")
        if r.lang_pred == "und":
            assert not raw or not any(c.isalpha() for c in texts[r.doc_id])
            continue
        sizes = {}
        for lang, words in model.dictionaries.items():
            held = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            plain = zstandard.ZstdCompressor(level=X.LEVEL, dict_data=held, write_content_size=False, write_dict_id=False)
            sizes[lang] = sum(len(plain.compress(raw[k : k + X.BLOCK])) for k in range(0, len(raw), X.BLOCK))
        first, second = sorted(sizes.values())[:2]
        if second - first > max(8, 2 * X.NARROW * first):
            assert r.lang_pred == min(sizes, key=sizes.get), (r, sizes)
            seen += 1
    assert seen > 800
