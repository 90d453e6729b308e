"""Structured Streaming ingest of landed CSV files (bronze and master).

The open-source file source with a checkpoint gives exactly-once file
discovery: the first run takes every existing file, later runs only new
ones (ST1). ``availableNow`` processes what is there and stops, so a
scheduled job ends instead of blocking forever (SK6). Glob the dated load
folders only, so other folders of the landing zone (master files, temp
folders) never enter bronze.

A streaming CSV source takes columns by position. So the stream is one of
*files* (path and time, no content), and each micro-batch reads its files by
header (``sources.csv``): files with swapped, missing or added columns may
arrive at any time. A batch is written to a partition of its own
(``ingest_batch``) with a dynamic overwrite, so a repeated batch replaces
itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltstream import schemas
from voltstream.operators import bronze
from voltstream.sources.csv import escaped, read_master_csv, read_ocpp_csv

#: partition column of streamed tables: the micro-batch that wrote the rows
BATCH = "ingest_batch"


@dataclass(frozen=True)
class CsvStream:
    """The new files of a folder as a stream, and how rows are read from some of them."""

    files: DataFrame
    read: Callable[[SparkSession, list[str]], DataFrame]

    def rows(self, batch: DataFrame) -> DataFrame | None:
        """The rows of a micro-batch of files (a list that the file source keeps on the driver anyway)."""
        paths = sorted(escaped(r["path"]) for r in batch.select("path").collect())
        return self.read(batch.sparkSession, paths) if paths else None


def stream_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming rows (path, modificationTime) of files; their content is not read."""
    r = spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).select("path", "modificationTime")


def stream_ocpp_csv(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, with_keys: bool = True
) -> CsvStream:
    """Streaming bronze rows from OCPP CSV files, by header (SC3, PJ1, PJ2, ST3, ST5).

    ``with_keys`` adds ``load``, ``frame_kind`` (to partition bronze by, see
    ``append_stream(partition_by=bronze.PARTITIONS)``) and ``message_ids``.
    """

    def read(session: SparkSession, files: list[str]) -> DataFrame:
        rows = read_ocpp_csv(session, files, with_file=True)
        out = bronze.conform(bronze.add_ingest_metadata(rows, source_file=F.col("source_file")))
        return bronze.add_frame_keys(out) if with_keys else out

    return CsvStream(stream_files(spark, path, max_files_per_trigger), read)


def stream_master_csv(spark: SparkSession, path: str) -> CsvStream:
    """Streaming master rows (SC4), by header: the text columns and ``MASTER_LOAD_TIME``, the file's time,
    so that a reload can be told from what it replaces."""

    def read(session: SparkSession, files: list[str]) -> DataFrame:
        rows = read_master_csv(session, files, with_file=True)
        return rows.withColumn(schemas.MASTER_LOAD, F.col("file_time")).drop("source_file", "file_time")

    return CsvStream(stream_files(spark, path), read)


def append_stream(
    df: DataFrame | CsvStream,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = True,
    timeout: float | None = None,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Append a stream to a file table with a checkpoint (SK5); waits when ``available_now``."""
    if isinstance(df, CsvStream):

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = df.rows(batch)
            if rows is not None:
                (rows.withColumn(BATCH, F.lit(batch_id)).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(BATCH, *(partition_by or [])).save(path))

        return foreach_batch_stream(df.files, checkpoint, write, available_now=available_now, timeout=timeout)
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start(path)
    if available_now:
        q.awaitTermination(timeout)
    return q


def foreach_batch_stream(
    df: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None], available_now: bool = True,
    timeout: float | None = None,
) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` per micro-batch (e.g. an upsert into gold)."""
    w = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fn)
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if available_now:
        q.awaitTermination(timeout)
    return q
