"""Token counts: the exact histogram of encoded lengths, and what its suffix sums answer.

Documents are encoded in their scan tasks (only lengths leave them, summed up by length), then added up by length.
From the suffix sums over lengths every question about a context limit is one lookup: how many documents and tokens
are that long or longer, what is left if texts are cut at the limit, which length a quantile falls on. Suffix sums
are taken within blocks of ``BLOCK`` lengths and over the blocks, so no window holds more than ``BLOCK`` rows of
lengths or one row for each block.

Cases: very long texts are encoded whole; NULL and empty texts have length 0; repeated rows count each; an empty table gives an empty histogram, totals
and cut totals of 0 and no quantiles; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltstream.llm.common import filled, stage, text_slices
from voltstream.llm.encode import WordEncoder, default_path

BLOCK = 4096


def length_histogram(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(length, n_docs): documents of each encoded length."""
    tokenizer = tokenizer or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        for part in text_slices(batches, "text"):
            length, n = np.unique(encoder.lengths(filled(part, "text")), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length), pa.array(n)], ["length", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "length long, n long").groupBy("length").agg(F.sum("n").alias("n_docs"))


def suffix_sums(spark: SparkSession, histogram: DataFrame) -> DataFrame:
    """The histogram with, for each length L: docs_from and tokens_from (documents of L tokens or more, and their
    tokens), cut_tokens (all documents' tokens when cut at L) and share_below (documents shorter than L)."""
    rows = stage(spark, histogram.withColumn("block", F.floor(F.col("length") / BLOCK)), "histogram")
    tokens = F.col("length") * F.col("n_docs")
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    later, after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("block").orderBy(F.desc("length"))
    zero = F.lit(0).cast("long")
    blocks = stage(spark, blocks.select(
        F.col("block").alias("_b"), F.coalesce(F.sum("d").over(later), zero).alias("_d"), F.coalesce(F.sum("t").over(later), zero).alias("_t")), "blocks")
    total = F.broadcast(rows.agg(F.sum("n_docs").alias("_docs"), F.sum(tokens).alias("_tokens")))  # one row
    found = rows.withColumn("docs_from", F.sum("n_docs").over(after)).withColumn("tokens_from", F.sum(tokens).over(after))
    found = found.join(blocks, F.col("block") == F.col("_b")).withColumns({"docs_from": F.col("docs_from") + F.col("_d"), "tokens_from": F.col("tokens_from") + F.col("_t")})
    return found.join(total).select(
        "length", "n_docs", "docs_from", "tokens_from", (F.col("_tokens") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("cut_tokens"),
        ((F.col("_docs") - F.col("docs_from")) / F.col("_docs")).alias("share_below"))


def totals_at(sums: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: documents longer than it and all documents' tokens when cut at it."""
    spark = sums.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in limits], "context long")
    # the sums of the shortest length beyond the limit; a row for each limit
    beyond = wanted.join(sums, F.col("length") > F.col("context"), "left").groupBy("context").agg(
        F.min_by(F.struct("docs_from", "tokens_from"), "length").alias("s"))
    total = sums.agg(F.max("tokens_from").alias("all"))
    docs, tokens = F.coalesce("s.docs_from", F.lit(0)), F.coalesce("s.tokens_from", F.lit(0))
    return beyond.join(F.broadcast(total)).select(
        "context", docs.alias("docs_over"), (F.coalesce("all", F.lit(0)) - tokens + F.col("context") * docs).alias("cut_tokens"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that at least this share of the documents doesn't exceed."""
    spark = sums.sparkSession
    wanted = spark.createDataFrame([(float(x),) for x in shares], "share double")
    docs = F.broadcast(sums.agg(F.max("docs_from").alias("docs")))
    up_to = sums.join(docs).select("length", ((F.col("docs") - F.col("docs_from") + F.col("n_docs")) / F.col("docs")).alias("reached"))
    return wanted.join(up_to, F.col("reached") >= F.col("share")).groupBy("share").agg(F.min("length").alias("length"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sums(spark, length_histogram(spark.read.parquet(f"{sf_dir}/documents.parquet")))
