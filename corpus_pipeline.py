"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from footform.llm.common import fresh_dir, remove
from footform.llm.decontaminate import drop_contaminated
from footform.llm.exact_dedup import drop_exact_duplicates
from footform.llm.jaccard_join import drop_near_duplicates
from footform.llm.language_id import with_known_language
from footform.llm.packing import packed_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter or a likely language go, null and empty texts with them.

    Rows are judged one by one, so repeated rows and null ids are as others. Where no row names a language, all stay.
    """
    return with_known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest, then of the smallest id. Null texts count as empty.

    Rows that repeat an id are judged by their own texts; of fully equal rows one stays.
    """
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: five-word shingles, Jaccard similarity of 0.8 or more.

    Null and wordless texts are alone and stay; rows that repeat an id are judged by their own texts.
    """
    return drop_near_duplicates(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten-word window with the benchmark; null and wordless texts stay, ids play no part."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 4096 tokens; a null or empty text is the end id alone."""
    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", decontaminate), ("packing", pack)]

#: A trained network decides the first stage, so SQL can't express the rows; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's table is deleted once the next one is written; an empty table gives no rows."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            remove(before)
        before = folder
    packed = STAGES[-1][1](spark, docs, sf_dir)
    remove(before)  # the pieces were written down, and only they are read
    return packed
