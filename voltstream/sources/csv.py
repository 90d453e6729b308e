"""CSV readers and writers for the raw OCPP logs and the station master file.

OCPP CSV rows hold quoted log lines with ``""`` escapes and embedded
newlines, so they are read with ``multiLine`` (a multi-line CSV file is one
split; parallelism comes from many files, which the landing writer produces).

Columns are matched by the names in each file's header, not by position:
files are grouped by header (the first line, read in a text scan), each group
is read as text columns in its own order, and a projection picks the table's
columns by name and converts them. What has no place in the table is kept by
field in ``_rescued_data``, as JSON: values of unknown columns, text that is
no value of its column's type (which becomes NULL), and under ``_row`` the
whole text of a row with too few or too many fields.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream import schemas

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
CORRUPT_COLUMN = "_rescued_data"

#: reader / writer options for the raw OCPP CSV
OCPP_CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
    "timestampFormat": TIMESTAMP_FORMAT,
}
MASTER_CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
}
#: writer options: keep text byte-exact (no whitespace trimming), quote as needed
WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": TIMESTAMP_FORMAT,
}


#: key of ``_rescued_data`` for the text of a row whose fields can't be told apart by the header
WHOLE_ROW = "_row"


def file_headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. A header is a file's first line; the driver holds one name per file, as any scan's does."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                                         "value", F.monotonically_increasing_id().alias("nth"))
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "nth").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    for r in first.orderBy("file").collect():
        names = next(csv.reader([r["header"].lstrip("\ufeff")]), [])
        found.setdefault(tuple(n.strip() for n in names), []).append(unquote(r["file"]))
    return found


def _typed(text: Column, kind: str) -> Column:
    """The text as a value of the type, NULL if it is none."""
    if kind == "STRING":
        return text
    if kind == "TIMESTAMP":
        return F.coalesce(F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT)), text.try_cast("timestamp"))
    return text.try_cast(kind)


def _aligned(raw: DataFrame, header: Sequence[str], ddl: str, kept_too: Sequence[str] = ()) -> DataFrame:
    """The table's columns (and those in ``kept_too``) out of ``raw``, whose columns c0, c1, ... are the header's, and ``_row``.

    Values, what is rescued, and its text are three projections, as each is needed twice by the next: a text is
    converted once.
    """
    fields = [part.split() for part in schemas.ddl(ddl).split(",")]
    place: dict[str, int] = {}
    for i, name in enumerate(header):
        place.setdefault(name.lower(), i)
    out, rescued, taken, values = [], [], set(), []
    for name, kind in fields:
        i = place.get(name.lower())
        if name == CORRUPT_COLUMN or i is None:
            out.append(F.lit(None).cast(kind).alias(name))
            continue
        taken.add(i)
        text = F.col(f"c{i}")
        if kind == "STRING":
            out.append(text.alias(name))
            continue
        values.append(_typed(text, kind).alias(f"_v{i}"))
        out.append(F.col(f"_v{i}").alias(name))
        rescued.append((name, F.when(F.col(f"_v{i}").isNull(), text)))
    keys = {name for name, _ in rescued}
    earlier = place.get(CORRUPT_COLUMN)
    for i, name in enumerate(header):
        if i not in taken and i != earlier:
            key, n = name or f"_c{i}", 1
            while key in keys:
                key, n = f"{name or f'_c{i}'}#{n + 1}", n + 1
            keys.add(key)
            rescued.append((key, F.col(f"c{i}")))
    rescued.append((WHOLE_ROW, F.col(WHOLE_ROW)))
    kept = F.map_filter(F.create_map(*[x for key, value in rescued for x in (F.lit(key), value)]), lambda k, v: v.isNotNull())
    text = F.when(F.size("_kept") > 0, F.to_json("_kept"))
    if earlier is not None:  # a landed file brings what was rescued at the source
        text = F.coalesce(F.col(f"c{earlier}"), text)
    columns = [text.alias(CORRUPT_COLUMN) if name == CORRUPT_COLUMN else c for c, (name, _) in zip(out, fields)]
    return raw.select("*", *values).withColumn("_kept", kept).select(*columns, *kept_too)


def read_csv_by_header(spark: SparkSession, path: str | list[str], ddl: str, options: dict, with_file: bool = False) -> DataFrame:
    """Rows of CSV files with the columns of ``ddl``, matched by name (any case) file by file.

    ``with_file`` adds ``source_file`` and ``file_time``; they stay where files with several headers are put together,
    which hides Spark's ``_metadata``.
    """
    groups = file_headers(spark, path)
    opts = {**options, "columnNameOfCorruptRecord": WHOLE_ROW}
    parts = []
    if not groups:  # files without any line
        return spark.createDataFrame([], schemas.ddl(ddl) + (", source_file STRING, file_time TIMESTAMP" if with_file else ""))
    for header, files in groups.items():
        columns = ", ".join([*(f"c{i} STRING" for i in range(len(header))), f"{WHOLE_ROW} STRING"])
        raw = spark.read.options(**opts).schema(columns).csv(path if len(groups) < 2 else [escaped(f) for f in files])
        of_file = [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("file_time")] if with_file else []
        raw = raw.select(*raw.columns, *of_file)
        parts.append(_aligned(raw, header, ddl, ["source_file", "file_time"] if with_file else []))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def escaped(file: str) -> str:
    """A file's name as a path pattern that matches it alone."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in file)


def read_ocpp_csv(spark: SparkSession, path: str | list[str], with_file: bool = False) -> DataFrame:
    """Raw OCPP CSV (SC2) with the bronze reader's columns, by header."""
    return read_csv_by_header(spark, path, schemas.BRONZE_INPUT_DDL, OCPP_CSV_OPTIONS, with_file)


def read_master_csv(spark: SparkSession, path: str | list[str], with_file: bool = False) -> DataFrame:
    """Station master CSV (SC1): all 21 columns as text plus ``_rescued_data``, by header."""
    return read_csv_by_header(spark, path, schemas.MASTER_DDL, MASTER_CSV_OPTIONS, with_file)


def read_text_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Any multi-line quoted CSV with a fixed schema."""
    opts = dict(OCPP_CSV_OPTIONS)
    opts.pop("columnNameOfCorruptRecord")
    return spark.read.options(**opts).schema(schema).csv(path)


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, compression: str | None = None
) -> None:
    """CSV with header and ``""`` escapes; right-sized files (no single-file funnel).

    A multi-line CSV file is one split for its readers, so rows are rebalanced
    by the partition columns: not a file per task and day, and a large day in
    several files. ``_rescued_data`` is a column like any other. ``compression``
    (e.g. ``"gzip"``) costs readers no splits either.
    """
    rows = df
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    w = rows.write.mode(mode).options(**WRITE_OPTIONS)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_snapshot_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV snapshot (SK1), e.g. the master file in the landing zone."""
    write_csv(df, path, mode="overwrite")
