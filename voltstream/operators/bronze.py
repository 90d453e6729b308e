"""Bronze: typed projection of the raw OCPP CSV plus ingest metadata.

Works unchanged on batch and streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltstream import schemas

def add_ingest_metadata(df: DataFrame, source_file: Column | None = None, ingest_time: Column | None = None) -> DataFrame:
    """Stamp each row with the load time and its source file.

    For file sources the path comes from the hidden ``_metadata.file_path``
    column (also inside a stream); other inputs pass ``source_file``.
    """
    if source_file is None:
        source_file = F.col("_metadata.file_path")
    if ingest_time is None:
        ingest_time = F.current_timestamp()
    return df.withColumns({"ingest_load_timestamp": ingest_time, "source_file": source_file})


#: bronze partition columns (additions to the 11-column layout)
LOAD, FRAME_KIND = "load", "frame_kind"
PARTITIONS = [LOAD, FRAME_KIND]


def add_frame_keys(df: DataFrame, load: Column | None = None) -> DataFrame:
    """Add what later steps look rows up by, parsed once at ingest: the partition
    columns ``load`` (default: from the landing path) and ``frame_kind`` (see
    ``frames.frame_kind``), and the array ``message_ids`` of the line's frames."""
    from voltstream.functions import frames

    raw = F.col("raw_log")
    if load is None:
        load = F.regexp_extract("source_file", r"/load=([^/]+)/", 1)
    return df.withColumns({"message_ids": frames.message_ids(raw), LOAD: load, FRAME_KIND: frames.frame_kind(raw)})


def conform(df: DataFrame) -> DataFrame:
    """The 11 bronze columns in table order; casts never fail (``try_cast``)."""
    out = []
    for part in schemas.ddl(schemas.BRONZE_DDL).split(","):
        name, typ = part.split()
        if name in df.columns:
            out.append(F.col(name).try_cast(typ).alias(name))
        else:
            out.append(F.lit(None).cast(typ).alias(name))
    return df.select(*out)
