"""A training corpus from raw documents: quality, language, near-duplicates, mixing, packing.

Every stage takes null, empty, repeated and very long texts, null and repeated ids, columns of other names and an empty table;
what it makes of them is said where it calls an operator. All but the last give the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlake.llm.common import table
from wardlake.llm.language import known_language
from wardlake.llm.mixing import mixed_documents
from wardlake.llm.packing import pack
from wardlake.llm.quality import good_documents
from wardlake.llm.simhash import one_of_each
from wardlake.sources import scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is known with some certainty."""
    return known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and as far as the mix takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in full sequences."""
    return pack(docs)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

#: Two stages fit models and two hash with functions that DuckDB lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result over the table of documents. What a stage keeps is written as Parquet in the cluster's shared
    folder and read again, so the passes of the stages after it neither score texts anew nor read more columns than they use.
    What no stage reads any more is removed; what the last one reads stays for as long as its result is asked for."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        at = scratch.folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
        if last:
            scratch.remove(spark, last)
        last = at
    return STAGES[-1][1](spark, docs, sf_dir)
