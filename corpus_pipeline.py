"""The corpus pipeline: toxicity, near-duplicates, decontamination, mix, token files.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents.
Stages work on whatever they get: NULLs, empty and repeated rows and extra columns as each operator states.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.llm.common import free_name, stage
from voltstream.llm.decontaminate import without_leaks
from voltstream.llm.mix import mixed_documents
from voltstream.llm.simhash import keep_one
from voltstream.llm.token_files import encode_documents
from voltstream.llm.toxicity import fit, without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, fitted on ``labels``, scores below the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without_toxic(docs, fit(spark, docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash (3-word shingles, 2 bits)."""
    return keep_one(spark, docs, shingle=3, distance=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ``benchmark`` item (5-word template windows, coverage 0.8)."""
    return without_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources interleaved to tempered weights, in mix order; no document is lost, short sources start over."""
    return mixed_documents(spark, docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mix, read back: doc_id, start, n_tokens, ids_crc32.

    The order is that of the rows in docs' Parquet files (part number, file name, row); docs that are not read from
    files are written in ascending doc_id order.
    """
    file, row = free_name(docs, "_file"), free_name(docs, "_row")
    try:
        placed = docs.select("*", F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(row))
    except AnalysisException as e:
        if not (e.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            raise
        return encode_documents(spark, docs)  # no file columns
    part = F.regexp_extract(file, r"^part-(\d+)", 1).try_cast("bigint")  # as a number: names of many parts don't sort by it
    return encode_documents(spark, placed, order=[part, F.col(file), F.col(row)])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mix", mix),
    ("token_files", token_files),
]

#: A trained network and token files can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(spark, function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
