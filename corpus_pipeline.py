"""The training-data pipeline: every stage works on all that the stage before it kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns a frame. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from billframe.llm import decontaminate, line_dedup, mixture, quality_fm, simhash
from billframe.llm.common import DOCUMENT_COLUMNS, tune, write_stage
from billframe.sources.tables import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones, scores at 0.5 or more."""
    tune(spark)
    docs = docs.select(*DOCUMENT_COLUMNS)
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"))
    return quality_fm.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document or line has; texts that lose all lines go."""
    return line_dedup.without_repeats(docs.select(*DOCUMENT_COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id."""
    return simhash.keep_first(docs.select(*DOCUMENT_COLUMNS), shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean_documents(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mixture: doc_id, source, block, n_tokens, progress, one row for each use of a document."""
    return mixture.mixture(docs.select(*DOCUMENT_COLUMNS), filled=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mix),
]

#: A trained model and 64-bit fingerprints are beyond SQL: tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_stage(docs, name.replace(" ", "-"))
    return docs
