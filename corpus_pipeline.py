"""A corpus pipeline: documents in, packed bins out; each stage is written as Parquet before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import best_fit, decontaminate, line_dedup, quality_model, simhash
from starmart.llm.common import ready, stage_table, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents likely to be of good quality and not toxic; the model is fitted on a bounded sample of labelled ones."""
    ready(spark)
    model = quality_model.train(docs, quality_model.graded(table(spark, sf_dir, "labels")))
    return quality_model.drop_rejected(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that at least three documents share, but for one holder; n_chars follows the text."""
    ready(spark)
    kept = line_dedup.drop_repeated_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ready(spark)
    return simhash.drop_near_duplicates(docs)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    ready(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of bounded size, without two texts of one source in a bin. Of each group of near duplicates `dedup_documents`
    has left one document, so every group is that document alone and none needs to be kept apart."""
    ready(spark)
    return best_fit.best_fit_bins(docs)


STAGES = [
    ("quality_classifier", classify),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("decontamination", decontaminate_documents),
    ("best_fit_packing", pack),
]
#: the classifier, fingerprints and packing have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
