"""From raw documents to packed training sequences: five stages, each on everything that the one before kept.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``. What a stage decides takes
effect: rejected documents go, of equal and of near-equal documents the one with the smallest id stays, personal data
is masked, and the last stage returns the pieces of the packed sequences. ORACLE_SQL is None, as SQL cannot express
fingerprint components, the models and the tokenizer; tests hold the stages against brute force.

Defined cases are those of the operators: null texts count as empty (and keep their null until the last stage); of equal and near-equal
documents a null id goes before any other; rows that share an id with different texts are judged each by its own text; an empty table gives an
empty result; further columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from facetlake.functions.storage import materialize
from facetlake.llm import exact_dedup, nbsvm, packing, pii, simhash
from facetlake.llm.text import documents, labels


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score, learned from labels of rows that the stage was given, is at least 0.3."""
    return nbsvm.keep_quality(docs, nbsvm.train(docs, labels(spark, sf_dir)))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal up to white space the one with the smallest id."""
    return exact_dedup.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by close fingerprints the one with the smallest id."""
    return simhash.near_dedup(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and n_chars counted anew."""
    return pii.mask_pii(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("pii", personal_data),
    ("packing", sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
