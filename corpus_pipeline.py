"""From raw documents to packed sequences, in stages that each apply one operator.

A stage takes (spark, documents, table folder) and returns the documents that it
keeps, with their columns; the last returns the places of their tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import best_fit, pii, plans, quality, simhash_pivots, tiling
from tidemark.session import stage
from tidemark.sources.tables import table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group within two bits, by three-word shingles."""
    return simhash_pivots.keep_one(docs, words_per_shingle=3, max_bits=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return tiling.clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies."""
    ranks = plans.tokenizer_path(plans.PACKING_RANKS)
    return best_fit.pack(best_fit.token_pieces(docs, plans.tokenizer_path(), ranks=ranks))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", decontaminated),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Trained scores, near search, tiling and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each but the last keeps is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
