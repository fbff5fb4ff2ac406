"""Tables with everything an operator has to put up with."""

from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet consectetur " * 6000
DOCS = [
    (5, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (5, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (7, None, "en", "a"),
    (8, "", None, None),
    (9, " \t\n\r ", "de", ""),
    (10, LONG, "en", "b"),
    (11, "日本語テキスト \U0001f600 é\x00 ▁ <s>\\", None, "b"),
    (None, "A text without an id but with some words in it.", "en", None),
    (12, "x", "fr", "c"),
    (13, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "c"),
    (-3, "12345 67890", "en", "c"),
]
# names that operators use inside
CLASHES = (
    "fp first bucket guest h t n pos sim chars size rate tilt copies component component_id node root terms counts score"
    " stratum good words line _h _t _d key a b u v target source_size toxic weight ids host"
).split()


def documents(spark, rows=DOCS):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.withColumns({c: F.lit("clash") for c in CLASHES})


def labels(spark, rows=((5, 1, 0), (5, 1, 0), (10, 0, 1), (None, 1, 1), (11, None, None), (99, 1, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int").withColumn("score", F.lit("clash"))
