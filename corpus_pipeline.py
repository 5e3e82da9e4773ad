"""A corpus prepared for training, stage by stage: language, quality, near duplicates, packing.

Each stage gets what the one before kept, as ``documents`` rows, and works on all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import language, line_cleaning, ngram_join, packing
from wardlake.llm.common import staged, table
from wardlake.llm.queries import BYTE_VOCABULARY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A document whose language is less sure than this goes.
LEAST_SCORE = 0.1


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined and sure enough; labels are learned from these documents."""
    rows = docs.select(*COLUMNS)
    model = language.fit(rows, ~language.held_out(F.col("doc_id")))
    judged = language.with_language(rows, model)
    return judged.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, with the failing lines taken out."""
    judged = line_cleaning.with_line_cleaning(docs.select(*COLUMNS)).where("kept")
    return judged.select(
        "doc_id",
        F.col("clean_text").alias("text"),
        "lang",
        "source",
        F.char_length("clean_text").cast(docs.schema["n_chars"].dataType).alias("n_chars"),
    )


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; one row where an id repeats, all without id."""
    groups = ngram_join.near_duplicates(docs.select("doc_id", "text")).where(
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
    staying = groups.select("doc_id").distinct().withColumnRenamed("doc_id", "_id")
    rows = docs.select(*COLUMNS)
    named = rows.join(staying, F.col("doc_id") == F.col("_id"), "left_semi")
    one = named.groupBy("doc_id").agg(F.max(F.struct(*COLUMNS[1:])).alias("_row")).select("doc_id", "_row.*")
    return one.unionByName(rows.where("doc_id is null"))


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens, with their ids."""
    return packing.packed_pieces(docs, BYTE_VOCABULARY)


STAGES = [
    ("language", by_language),
    ("quality", by_quality),
    ("near duplicates", without_near_copies),
    ("packing", into_sequences),
]

# The stages learn, link and pack; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
