"""A corpus pipeline over ``documents``: quality rules, toxicity, near-duplicates, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and its
result is written and read again as the next one's ``docs``. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prefmill.llm.fertility import kept_documents
from prefmill.llm.packing import pack
from prefmill.llm.simhash import one_of_each
from prefmill.llm.toxicity import clean_documents
from prefmill.llm.util import stored
from prefmill.session import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fertility bands reject go."""
    return kept_documents(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxic score of a half or more go."""
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates stays."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece with its sequence."""
    return pack(docs)


STAGES = [("quality_rules", quality_rules), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("packing", packing)]

#: Tokenisers, learned scores and components are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
