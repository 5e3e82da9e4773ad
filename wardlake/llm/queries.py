"""Registered queries of the operators: each applies one to its whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import (
    bit_packing,
    language,
    line_cleaning,
    link_trust,
    ngram_join,
    packing,
    pair_merges,
    projection_passes,
    revisits,
    spelling,
    transducer,
    turn_automaton,
    unlabelled_risk,
)
from wardlake.llm.common import table
from wardlake.session import fresh_path

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op1_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judged_pages(table(spark, sf_dir, "pages"), RULES)


def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = revisits.captures_of(table(spark, sf_dir, "pages"))
    return revisits.resolve_revisits(captures).withColumn("headers", revisits.headers_text(F.col("headers")))


def op3_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "packed-ids")
    bit_packing.write_packed(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, path)
    return bit_packing.read_documents(bit_packing.open_packed(spark, path))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.held_out(F.col("doc_id"))
    model = language.fit(docs, ~out)
    return language.with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score"
    )


def op5_projection_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_passes.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"), BYTE_VOCABULARY).drop("ids")


def op7_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_cleaning.with_line_cleaning(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_pair_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_merges.round_trip_digests(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.token_counts(table(spark, sf_dir, "documents"), PIECE_MODEL, 4096)


def op11_unlabelled_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    scores = unlabelled_risk.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scores.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op12_turn_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_automaton.repaired_conversations(table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.word_counts(spelling.damaged_words(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_link_trust": op1_link_trust,
    "op2_revisits": op2_revisits,
    "op3_bit_packing": op3_bit_packing,
    "op4_language": op4_language,
    "op5_projection_passes": op5_projection_passes,
    "op6_packing": op6_packing,
    "op7_line_cleaning": op7_line_cleaning,
    "op8_pair_merges": op8_pair_merges,
    "op9_ngram_join": op9_ngram_join,
    "op10_token_counts": op10_token_counts,
    "op11_unlabelled_risk": op11_unlabelled_risk,
    "op12_turn_automaton": op12_turn_automaton,
    "op13_spelling": op13_spelling,
}


def oracle_sql() -> dict[str, str]:
    return {"op2_revisits": revisits.SQL, "op7_line_cleaning": line_cleaning.cleaning_sql()}
