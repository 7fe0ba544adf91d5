"""A training corpus from raw documents: stages of the operators in ``adlens.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written and reread as the next one's ``docs``. All but the last return
the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlens.llm import mixing, nbsvm, packing, quality_rules, simhash, tokens
from adlens.llm.common import staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a risk-controlled cutoff reject go."""
    return quality_rules.keep(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below 0.3 go."""
    return nbsvm.keep(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), threshold=0.3)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (smallest doc_id); 3-word shingles, 2 bits."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut or repeated to their target weights."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, each with its sequence and place."""
    return packing.pack(docs, tokens.public_path(), capacity=2048, end_id=0)


STAGES = [("quality_rules", quality_stage), ("quality_classifier", classifier_stage), ("simhash_dedup", simhash_stage),
          ("source_mix", mixing_stage), ("best_fit_packing", packing_stage)]

#: SimHash, a trained classifier and a tokenizer's ids are out of SQL's reach; the tests
#: compare run() with a plain Python version of the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
