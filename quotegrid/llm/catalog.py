"""Queries over the test tables, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.llm import (
    archives,
    chat,
    fingerprints,
    language,
    lines,
    mixing,
    periods,
    pieces,
    quality,
    simhash,
    sql,
    toxicity,
    tries,
    wrappers,
)
from quotegrid.llm.common import held_out, table


def op1_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return fingerprints.fingerprint_pairs(docs, fingerprints.rarity_ranks(docs))


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.round_trip_digests(table(spark, sf, "documents"), piece_model())


def op3_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    said = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], said.schema)
    return chat.read_back(chat.format_turns(said.unionByName(more)))


def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs, counts=True).select("doc_id", "text", "n_lines", "n_removed")


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language.learn(docs.where(~held_out(F.col("doc_id"))))
    out = held_out(F.col("doc_id")).alias("held_out")
    return language.predict_languages(docs, model).select("doc_id", out, "lang_pred", "score", "margin", "accepted")


def op6_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    found = toxicity.toxicity(docs, labels.where(~held_out(F.col("doc_id"))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")


def op8_mixing_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return wrappers.main_texts(table(spark, sf, "pages"))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = periods.with_made_runs(table(spark, sf, "documents"))
    return periods.run_digests(periods.find_runs(docs))


def op12_warc(spark: SparkSession, sf: str) -> DataFrame:
    return archives.archive_and_read_back(table(spark, sf, "pages"))


def op13_conversation_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    turns = tries.turn_table(table(spark, sf, "conversations"))
    return tries.prefix_trie(tries.rebuilt_turns(turns))


QUERIES = (
    op1_document_fingerprints,
    op2_sentencepiece,
    op3_chat_formatting,
    op4_line_dedup,
    op5_language_id,
    op6_simhash_near_dedup,
    op7_toxicity,
    op8_mixing_sources,
    op9_quality_rules,
    op10_html_extraction,
    op11_periodic_runs,
    op12_warc,
    op13_conversation_prefix_trie,
)


def queries():
    return {f.__name__: f for f in QUERIES}


def oracles():
    return {
        op8_mixing_sources.__name__: sql.OP8,
        op9_quality_rules.__name__: sql.OP9,
        op12_warc.__name__: sql.OP12,
        op13_conversation_prefix_trie.__name__: sql.OP13,
    }
