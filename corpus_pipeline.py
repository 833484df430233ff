"""From raw documents to packed training sequences, stage by stage.

Every stage takes the documents that the one before it kept, is written as Parquet to the shared
folder and read again. The first four drop documents and keep their columns; the last one packs.

All stages judge a row by its text alone, so repeated rows share a verdict, except that of exact and
near copies one stays; they take null ids and texts, extra columns of any name and empty
tables. What a stage does with null and empty texts is said at the stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.byte_language import fold, keep_known_languages
from blotter.llm.common import stored, table
from blotter.llm.decontaminate import drop_contaminated
from blotter.llm.line_quality import keep_good
from blotter.llm.packing import Capacity, pack_documents
from blotter.llm.simhash_links import keep_one_per_group

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, so also null and empty ones, or without a clear language go."""
    return keep_known_languages(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted bad go; null and empty texts are scored like any other."""
    labels = table(spark, sf_dir, "labels")
    return keep_good(docs, labels.where(fold(F.col("doc_id"), 5) != 0))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, of repeated rows one.

    Null and empty texts are one group; documents without an id all stay.
    """
    return keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go; null and empty texts have none and stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a null or empty text is one piece, the end id."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), Capacity.of_tokens(4096))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Trained models decide about documents, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
