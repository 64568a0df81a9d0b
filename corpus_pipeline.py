"""From raw documents to packed training sequences, one operator a stage.

Each stage gets the documents that the one before it left and returns documents with the same columns;
the last returns packed pieces. Stages meet through Parquet in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.llm import toxicity
from stratalog.llm.common import written
from stratalog.llm.line_dedup import line_dedup
from stratalog.llm.mixing import Mixture, remixed
from stratalog.llm.near_dedup import without_near_copies
from stratalog.llm.packing import packed
from stratalog.llm.queries import domain_labels, table

#: Target weights of the domains of the documents that stay.
WEIGHTS = {"good": 0.85, "low": 0.15}

# Token ids and fitted models can't be said in SQL; tests hold the rows of the line stage against brute
# force, and the other stages only by columns, counts and ids.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold; the model learns from the labelled ones."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without blocks of lines that an earlier document has. A document of which nothing is left
    goes; one that was blank before stays. ``n_chars`` follows the text."""
    cut = line_dedup(docs).filter("removed_lines = 0 OR btrim(text, ' \t\n\r') <> ''")
    chars = F.when(F.col("removed_lines") > 0, F.length("text").cast("bigint")).otherwise(
        F.col("n_chars"))
    return cut.withColumn("n_chars", chars).select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return without_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that domains get their weights; none goes."""
    domains = domain_labels(table(spark, sf_dir, "labels"))
    return remixed(docs, domains, WEIGHTS, Mixture(keep_all=True))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and offset."""
    return packed(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
