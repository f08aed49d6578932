"""A corpus from raw documents to token ids, in five stages; each stage's result is written and read again by the next.

Stages decide row by row, never by id alone: rows with one id and different texts are different documents, and of rows that
repeat both the dedup stages leave one. Null texts count as empty, null ids are kept as they are. An empty table gives an empty result, texts are
read whole, and columns that documents does not have are carried along, whatever their names, up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chainloom.llm import bpe, exact_dedup, mixing, quality, queries, simhash
from chainloom.llm.shared import held_out, materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels outside the held-out fold, does not reject."""
    labels = table(spark, sf_dir, "labels")
    return quality.keep_good(docs, quality.train(docs, labels.where(~held_out(labels.doc_id))))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, white space aside, the one with the longest text, then the smallest id."""
    return exact_dedup.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more the smallest id,
    and of an id with several such texts the one of least digest."""
    return simhash.keep_one_similar(docs, shingle_words=5, similarity=0.8)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled, or repeated where a cell is too small, so that sources, languages and topics meet their flattened shares."""
    return mixing.sample(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of what they decode to."""
    return bpe.digests(bpe.round_trip(docs, queries.vocabulary()), keep=("ids",))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("simhash near-dedup", without_near_copies),
    ("mixing to target weights", mixed),
    ("bpe encoding", encoded),
]

#: SQL has no classifier, XXH64 or BPE; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
