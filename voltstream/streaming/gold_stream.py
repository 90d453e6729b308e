"""Incremental bronze → silver → gold with Structured Streaming.

The landed files are streamed once. Each micro-batch becomes a load of the
load tables (``plans.load_tables``: lines, frames parsed once, keys; a
repeated batch replaces itself) and that load's silver, with the earlier
requests whose answer it changes, is merged into day-partitioned gold: a
request is in gold as soon as its batch is, and its result fills it in
whenever it lands, hours or months later. There is no watermark and no time
bound, and no pairing state beside the key table; the result equals the batch
plan after every batch. Days that are over are folded, so a batch lists the
loads of open days only.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from voltstream.plans import load_tables
from voltstream.plans.medallion import gold_partition_value, merge_into_gold_table
from voltstream.session import FRUGAL, settings
from voltstream.sources.tables import discard
from voltstream.streaming.ingest import CsvStream, foreach_batch_stream, stream_ocpp_csv


def _ingest(batch: DataFrame, batch_id: int, lines: CsvStream, tables: load_tables.LoadTables) -> tuple[str, str] | None:
    """Write a micro-batch's lines as a load; (load, day), or None for an empty batch."""
    rows, session = lines.rows(batch), batch.sparkSession
    if rows is None:
        return None
    load = f"batch-{batch_id:09d}"
    today = _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d")
    day = load_tables.day_of_load(session, tables, load) or today  # a repeated batch keeps its day
    load_tables.close_days(session, tables, min(day, today))
    load_tables.ingest_load(session, tables, rows, load, day)
    return load, day


def run_load_stream(
    spark: SparkSession,
    landing_glob: str,
    bronze_path: str,
    checkpoint: str,
    available_now: bool = True,
    timeout: float | None = None,
    max_files_per_trigger: int | None = None,
    key_buckets: int = 64,
) -> StreamingQuery:
    """Stream landed OCPP CSV into the load tables at ``bronze_path``."""
    lines = stream_ocpp_csv(spark, landing_glob, max_files_per_trigger, with_keys=False)
    tables = load_tables.LoadTables(bronze_path, buckets=key_buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        with settings(batch.sparkSession, FRUGAL):
            _ingest(batch, batch_id, lines, tables)

    return foreach_batch_stream(lines.files, checkpoint, write, available_now=available_now, timeout=timeout)


def run_gold_stream(
    spark: SparkSession,
    landing_glob: str,
    master: DataFrame,
    bronze_path: str,
    gold_path: str,
    checkpoint: str,
    stage_root: str,
    stamp: Column | None = None,
    available_now: bool = True,
    timeout: float | None = None,
    max_files_per_trigger: int | None = None,
    key_buckets: int = 64,
) -> StreamingQuery:
    """Stream landed OCPP CSV into the load tables at ``bronze_path`` and the gold table."""
    lines = stream_ocpp_csv(spark, landing_glob, max_files_per_trigger, with_keys=False)
    tables = load_tables.LoadTables(bronze_path, buckets=key_buckets)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        session, work = batch.sparkSession, f"{stage_root}/work-{batch_id:09d}-{uuid.uuid4().hex[:8]}"
        with settings(session, FRUGAL):
            written = _ingest(batch, batch_id, lines, tables)
            if written:
                increment = load_tables.silver_of_load(session, tables, *written, master, stage_time=stamp, arrange=gold_partition_value(), work=work)
                merge_into_gold_table(gold_path, increment, f"{stage_root}/{written[0]}", stamp=stamp, arranged=True)
                discard(session, work)

    return foreach_batch_stream(lines.files, checkpoint, merge_batch, available_now=available_now, timeout=timeout)
