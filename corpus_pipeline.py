"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame
that is written and read again as the next one's ``docs``; all but the last return the columns of
``documents``. The stages are those of a whole run; each can run on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.exact import exact_dedup
from bindery.llm.mixing import mix_sources
from bindery.llm.neardup import near_duplicates
from bindery.llm.packing import best_fit_pack
from bindery.llm.quality import quality_scores
from bindery.llm.queries import special_tokens, table, vocabulary
from bindery.llm.stages import WORD, keep


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a row number, written so that it stays the same, under a name not in use."""
    row = "_row_number"
    while row in docs.columns:
        row += "_"
    return keep(docs.withColumn(row, F.monotonically_increasing_id()), "documents"), row


def _only(docs: DataFrame, row: str, kept: DataFrame) -> DataFrame:
    return docs.join(kept.select(row).hint("merge"), row, "left_semi").drop(row)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from all labels."""
    numbered, row = _numbered(docs)
    scores = quality_scores(numbered, table(spark, sf_dir, "labels"), row=row)
    return _only(numbered, row, scores.filter("predicted = 1"))


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    numbered, row = _numbered(docs)
    return _only(numbered, row, exact_dedup(numbered, row=row).filter("kept"))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    numbered, row = _numbered(docs)
    return _only(numbered, row, near_duplicates(numbered, row=row).filter("stays"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes, as one row per document and pass over its source.

    A document taken whole keeps its text; otherwise its text is the taken words joined by one space.
    """
    numbered, row = _numbered(docs)
    mix = mix_sources(numbered, row=row)
    parts = f"{row}_parts"
    taken = mix.pieces.groupBy("_row", "pass").agg(
        F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("_list"), F.sum("n_words").alias("_taken")
    )
    taken = taken.join(mix.rows.select("_row", "size"), "_row").select(
        F.col("_row").alias(row), F.when(F.col("_taken") < F.col("size"), F.col("_list")).alias(parts)
    )
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    runs = F.transform(parts, lambda p: F.slice(words, p["first_word"].cast("int") + 1, p["n_words"].cast("int")))
    text = F.when(F.col(parts).isNull(), F.col("text")).otherwise(F.array_join(F.flatten(runs), " "))
    mixed = numbered.join(taken, row).withColumn("text", text)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))
    return mixed.select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    return best_fit_pack(docs, **vocabulary(), specials=special_tokens())


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_deduplication),
    ("MinHash near-dedup", near_deduplication),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

# The classifier and the pseudorandom draws have no SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
