"""Batch incremental loads (ST6): what the source has and the landing zone doesn't.

``land_increment`` writes the source's new rows to a new
``load=<id>/dt=<date>/`` folder of the landing zone (one Spark-committed
write, many gzip files, no driver-side renames), keeps their ids, and appends the
new high-water mark. Row count and the new maximum are gathered *during* the
write with ``DataFrame.observe``, so the increment is computed once, not
three times. An empty increment writes nothing to the landing zone.

A row is new if its id has not been landed for its day: ties at the mark,
late rows and rows without a time are landed, each once. Landed ids are kept
in day partitions (the row's own day), so with ``overlap`` only the days that
can still bring rows are read, whatever the length of the history.

If the job dies after the write but before the ids and the mark are appended,
the next run lands the same rows again; downstream steps are keyed upserts,
so the duplicates collapse there.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from voltstream.functions.frames import check_mode
from voltstream.session import FRUGAL, settings
from voltstream.sources.csv import CORRUPT_COLUMN, write_csv
from voltstream.sources.tables import discard, read_parquet_if_exists


def read_high_water_mark(spark: SparkSession, mark_path: str):
    """Greatest stored ``last_load_time`` (SC7); None when the table is absent or empty."""
    marks = read_parquet_if_exists(spark, mark_path)
    if marks is None:
        return None
    return marks.agg(F.max("last_load_time")).first()[0]


def append_high_water_mark(spark: SparkSession, mark_path: str, mark) -> None:
    """Append one mark row (SK4); the value is passed as a literal, not spliced into SQL text."""
    row = spark.range(1).select(F.lit(mark).cast("timestamp").alias("last_load_time"))
    row.write.mode("append").parquet(mark_path)


def since(df: DataFrame, mark, column: str = "request_date", mode: str = "fixed", overlap: str | None = None) -> DataFrame:
    """Rows strictly newer than ``mark`` (FL1).

    fixed: a missing mark means a full load; ``overlap`` (e.g. ``"10 minutes"``)
    re-reads a window before the mark for late rows (de-duplicate by key
    downstream). faithful: a missing mark selects nothing (NULL comparison).
    """
    check_mode(mode)
    c = F.col(column)
    if mark is None:
        return df if mode == "fixed" else df.filter(F.lit(False))
    bound: Column = F.lit(mark).cast("timestamp")
    if overlap:
        bound = bound - F.expr(f"INTERVAL {overlap}")
        return df.filter(c >= bound)
    return df.filter(c > bound)


def new_load_id() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d%H%M%S") + "-" + uuid.uuid4().hex[:8]


#: partition of the landed ids: the row's own day
ID_DAY = "dt"


def landed_id(columns: list[str], column: str) -> Column:
    """What tells a source row: its id, or a hash over all columns where it has no id or no time."""
    return F.when(F.col("id").isNotNull() & F.col(column).isNotNull(), F.col("id").cast("string")).otherwise(
        F.concat(F.lit("row-"), F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256)))


def not_landed(source: DataFrame, known: DataFrame | None, mark, column: str = "request_date", overlap: str | None = None) -> DataFrame:
    """Rows of ``source`` whose id ``known(_row_id, dt)`` doesn't have, with ``_row_id`` and ``dt``.

    With ``overlap``, rows older than the mark by more than that are no candidates, and only the days from there on
    (and of rows without a time) are read from ``known``.
    """
    rows = source
    bound = None if overlap is None or mark is None else F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {overlap}")
    if bound is not None:
        rows = rows.filter((F.col(column) >= bound) | F.col(column).isNull())
    rows = rows.withColumns({"_row_id": landed_id(source.columns, column), ID_DAY: F.to_date(F.col(column))})
    if known is None:
        return rows
    if bound is not None:
        known = known.filter((F.col(ID_DAY) >= F.to_date(bound)) | F.col(ID_DAY).isNull())
    known = known.select(F.col("_row_id").alias("_known"), F.col(ID_DAY).alias("_day"))
    return rows.join(known, (F.col("_row_id") == F.col("_known")) & F.col(ID_DAY).eqNullSafe(F.col("_day")), "left_anti")


def _increment(spark: SparkSession, source: DataFrame, known: DataFrame | None, mark, column: str, overlap: str | None, path: str) -> DataFrame:
    """``not_landed`` without moving whole rows that are known or can't be: rows of days without any known id are new as
    they are; of the other days the new ids are found first, written to ``path``, and only if there are some, their rows."""
    rows = not_landed(source, None, mark, column, overlap)
    if known is None:
        return rows
    with settings(spark, {"spark.sql.optimizer.metadataOnly": "true"}):
        days = [r[0] for r in known.select(ID_DAY).distinct().collect()]  # one value per day

    def there(day: Column) -> Column:
        return F.when(day.isNull(), F.lit(None in days)).otherwise(day.isin([d for d in days if d is not None]))

    ids = not_landed(source.filter(there(F.to_date(F.col(column)))), known, mark, column, overlap).select("_row_id", ID_DAY).distinct()
    ids.write.parquet(path)
    ids = spark.read.schema(ids.schema).parquet(path).select(F.col("_row_id").alias("_new"), F.col(ID_DAY).alias("_day"))
    if ids.isEmpty():
        return rows.filter(~there(F.col(ID_DAY)))
    late = rows.filter(there(F.col(ID_DAY))).join(ids, (F.col("_row_id") == F.col("_new")) & F.col(ID_DAY).eqNullSafe(F.col("_day")), "left_semi")
    return rows.filter(~there(F.col(ID_DAY))).unionByName(late)


def land_increment(
    spark: SparkSession,
    source: DataFrame,
    landing_path: str,
    mark_path: str,
    load_id: str | None = None,
    column: str = "request_date",
    mode: str = "fixed",
    overlap: str | None = None,
    landed_ids: str | None = None,
) -> dict:
    """Land the source's new rows as CSV and advance the mark (FL8, SK2-SK4).

    fixed: a row is new if it has not been landed (see the module's text);
    ids are kept at ``landed_ids``, by default beside the marks. ``overlap``
    (e.g. ``"3 days"``) bounds how late a row may come; without it any age is
    landed. A row whose time was corrected at the source counts as new.
    faithful: rows strictly newer than the mark, no ids.

    Every row is landed, malformed ones too: fields that could not be read are
    NULL, with their text in ``_rescued_data``.

    Returns ``{"load_id", "rows", "rescued", "mark"}``. When no row is new
    nothing is written and the mark is unchanged.
    """
    with settings(spark, FRUGAL):
        return _land(spark, source, landing_path, mark_path, load_id or new_load_id(), column, check_mode(mode), overlap,
                     landed_ids or f"{mark_path.rstrip('/')}__ids")


def _land(
    spark: SparkSession, source: DataFrame, landing_path: str, mark_path: str, load_id: str, column: str, mode: str,
    overlap: str | None, landed_ids: str,
) -> dict:
    mark = read_high_water_mark(spark, mark_path)
    # computed once: written to a staging folder, then read for each of its uses
    work = f"{mark_path.rstrip('/')}__increment/{load_id}-{uuid.uuid4().hex[:8]}"
    staged = f"{work}/rows"
    if mode == "fixed":
        inc = _increment(spark, source, read_parquet_if_exists(spark, landed_ids), mark, column, overlap, f"{work}/ids")
    else:
        inc = since(source, mark, column, mode).withColumn(ID_DAY, F.to_date(F.col(column)))
    obs = Observation(f"land_{load_id.replace('-', '_')}_{uuid.uuid4().hex[:8]}")
    rescued = F.count(CORRUPT_COLUMN if CORRUPT_COLUMN in source.columns else F.lit(None))
    inc.observe(obs, F.count(F.lit(1)).alias("rows"), F.max(column).alias("mark"), rescued.alias("rescued")).write.parquet(staged)
    found = obs.get
    rows, new_mark = found.get("rows", 0), found.get("mark")
    if not rows:
        discard(spark, work)
        return {"load_id": load_id, "rows": 0, "rescued": 0, "mark": None}
    out = spark.read.schema(inc.schema).parquet(staged)
    write_csv(out.drop("_row_id"), f"{landing_path}/load={load_id}", mode="errorifexists", partition_by=[ID_DAY], compression="gzip")
    if mode == "fixed":
        ids = out.select("_row_id", F.lit(load_id).alias("load_id"), ID_DAY)
        ids.hint("rebalance", ID_DAY).write.mode("append").partitionBy(ID_DAY).parquet(landed_ids)
    if new_mark is not None:
        append_high_water_mark(spark, mark_path, new_mark)
    discard(spark, work)
    return {"load_id": load_id, "rows": rows, "rescued": found.get("rescued", 0), "mark": new_mark}
