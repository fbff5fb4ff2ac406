"""Pipeline over ``documents``: from raw documents to token ids of a deduplicated, mixed corpus.

Each stage works on all rows of its predecessor, which are written to the shared folder and read again. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.llm import bitfilter, lines, mixing, pieces, simhash, toxicity
from quotegrid.llm.catalog import piece_model
from quotegrid.llm.common import held_out, table
from quotegrid.session import materialize, ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go; all others stay as they are."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    found = toxicity.toxicity(docs, labels)
    return bitfilter.without_ids(docs, found.where("predicted = 1"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go. A document that lost lines and has no word left was a copy and goes, too."""
    ship_package(spark)
    marked = docs.withColumn("_before", F.length("text"))
    found = lines.dedup_lines(marked)
    lost = F.coalesce(F.length("text") < F.col("_before"), F.lit(False))
    kept = found.where(~lost | (lines.normal(F.col("text")) != "")).drop("_before")
    return kept.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHashes (4-word shingles) are linked by 4 bits or fewer, the one of the smallest id stays."""
    ship_package(spark)
    return simhash.keep_one(docs, shingle=4, radius=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ship_package(spark)
    return mixing.take(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the text they decode to."""
    ship_package(spark)
    return pieces.round_trip_digests(docs, piece_model(), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_documents),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", tokenize),
]

# No SQL expresses the nearest neighbours of the first stage; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
