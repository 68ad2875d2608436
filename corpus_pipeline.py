"""The training-data pipeline: the stages in order, each on all that its predecessor kept.

``run`` writes every stage's documents as Parquet into the shared checkpoint folder and reads them back as the
next stage's input. All stages but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finsight.llm import decontaminate, langid, minhash, packing, toxicity
from finsight.llm.common import table, written


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; profiles are learned from the labelled rows of the training folds."""
    return langid.keep_identified(docs, langid.training_rows(docs))


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic."""
    return toxicity.keep_harmless(docs, docs, table(spark, sf_dir, "labels"))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (5-word shingles, similarity 0.8)."""
    return minhash.keep_one(docs, threshold_pct=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in bins of one training sequence each."""
    return packing.pack(docs)


STAGES = [("language ID", identified), ("toxicity", harmless), ("near-duplicates", deduplicated),
          ("decontamination", decontaminated), ("packing", packed)]

#: Profiles, trained models and MinHash candidates are beyond SQL; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
