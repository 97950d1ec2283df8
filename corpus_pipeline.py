"""Corpus pipeline over ``documents``: quality rules, line dedup, near-dedup, pseudonyms, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before has kept. All but the last return the
columns of documents; n_chars follows the text. Packing and keyed pseudonyms have no SQL, so the whole is tested
against a plain version. ``run`` deletes what a stage has made besides its result, and the result when the next
stage's is stored; the last stage reads tables that stay until ``workspace.release``.

Defined results: null and empty texts go in the first stage, as texts of under ten words do; a null id is no duplicate of
anything; rows that repeat an id are judged row by row, and as one document by near-dedup; null sources are one site;
n_chars of a null text is null; an empty table gives an empty result; extra columns pass through to the last stage,
whatever their names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonarloom import workspace
from sonarloom.llm import best_fit_packing, line_dedup, minhash_dedup, pseudonyms, quality_rules


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality_rules.filtered(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are spread over many sources."""
    return _counted(line_dedup.dedup_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 or more over five-word shingles."""
    return minhash_dedup.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with private values replaced."""
    return _counted(pseudonyms.pseudonymise(docs, pseudonyms.TEST_KEY))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return best_fit_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("minhash_dedup", near_duplicates), ("pseudonyms", private), ("best_fit_packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = workspace.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = workspace.new_folder(spark, name)
        with workspace.scratch(spark, path):
            docs = workspace.materialize(stage(spark, docs, sf_dir), name, path)
        if before:
            workspace.delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
