"""Pipeline over documents: stages applied one after the other, each stored before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import decontaminate, jaccard_join, language_id, packing, substring_dedup
from stopwise.llm.queries import ranks_path, table
from stopwise.llm.shared import crc_remainder, delete, reclaim, scratch, shared_folder, stored_until


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language is predicted for; those without a letter go."""
    learned = docs.where(crc_remainder(F.col("doc_id"), 4) != 2)
    own = "\u00b7prediction"  # no table has such a name
    found = language_id.predict(docs, language_id.fit(learned), own)
    return found.where(F.col(f"{own}.lang") != language_id.UNKNOWN).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at five words and 0.8 the one with the smallest id."""
    return jaccard_join.first_of_each(docs)


def distinct_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occur earlier."""
    return substring_dedup.without_repeats(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of a controlled mixture."""
    return packing.pack(docs, ranks_path())


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", distinct_documents),
    ("substring dedup", distinct_passages),
    ("benchmark decontamination", clean_of_benchmark),
    ("packing", packed),
]

# Language identification has no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``.

    What a stage kept is deleted as soon as the next one is stored, and so are its own tables.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        path = shared_folder(spark)
        with scratch(spark):
            docs, path = stored_until(stage(spark, docs, sf_dir), path)
        if before is not None:
            delete(spark, before)
        before = path
        reclaim(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
