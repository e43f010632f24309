"""A training corpus from raw documents: quality rules, language, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; all but the last return the columns of ``documents``. Nulls,
empty tables, repeated rows and further columns are handled as the operators'
docstrings say; further columns pass through the filtering stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.llm.common import table
from staylake.llm.lang_id import UNKNOWN, fit_languages, with_language
from staylake.llm.packing import pack_documents
from staylake.llm.quality import quality_rules
from staylake.llm.simhash import keep_one
from staylake.session import scratch_path

#: Lowest language score of a kept document.
MIN_LANGUAGE_SCORE = 0.1


def _packed(docs: DataFrame) -> DataFrame:
    """The row as one column next to its id, text and language: no other column can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row).select("row", *[F.col(f"row.{c}").alias(c) for c in ("doc_id", "text", "lang")])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; those labelled good are the trusted ones."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules(_packed(docs), trusted).where("kept").select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language the classifier knows.

    It is fitted on the documents at hand; one without a letter, or with a
    score below ``MIN_LANGUAGE_SCORE``, goes. Where no document has a language,
    there is nothing to learn from, and only documents without a letter go.
    """
    rows = _packed(docs)
    model = fit_languages(rows.select("doc_id", "text", "lang"))
    if not model.langs:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return with_language(rows, model).where(known).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 4-word-shingle fingerprints link at 4 or fewer bits."""
    return keep_one(docs, shingle=4, max_bits=4)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes in sequences of the permitted lengths."""
    return pack_documents(docs)


STAGES = [("quality_rules", quality), ("language_id", language), ("simhash_near_dedup", near_dedup), ("best_fit_packing", packing)]

#: SQL cannot express the classifier and the fingerprints; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result but the last written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, "pipeline", name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
