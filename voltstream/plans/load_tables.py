"""Bronze by loads: every line parsed once, looked up by key, folded into days, with a quarantine that can be replayed.

``ingest_load`` writes a load's lines and, parsed in the same job, its frames:

====================================  ====================================================================
``open/lines/dt=/load=``              the bronze columns of the lines
``open/frames/dt=/load=/kind=``       a row per frame: type, id, action, time, text, and where its body begins
``open/keys/dt=/load=/bucket=``       (station, message id, time) of calls and results, by hash bucket
``quarantine/dt=/load=``              lines that can't become silver rows, with the reasons
``closed/lines/dt=``, ``closed/frames/dt=/kind=``, ``closed/keys/bucket=/dt=``
                                      the same tables of days that are over, loads folded together
====================================  ====================================================================

``dt`` is the day of the load, ``kind`` a frame's type. Silver reads frames with pushed filters and runs no pattern
over log text. A load's silver looks up the keys of its own frames in the buckets they fall in, works out which
calls get another answer than before, and reads whole frames only from the loads that hold those: requests whose
answer stays the same are not emitted again.

``close_days`` folds the loads of past days, so that what a new load lists and reads doesn't grow with the number of
earlier loads. A day's folder is written (again, if a run died), then noted in ``closed_days``; readers take a day from
``closed`` if it is noted there, else from ``open``. ``sweep`` removes the open folders of noted days.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voltstream import schemas
from voltstream.functions import frames as frame_ops
from voltstream.operators import silver
from voltstream.operators.dedup import latest_by_key
from voltstream.session import run_dir, settings
from voltstream.sources.csv import CORRUPT_COLUMN, WHOLE_ROW
from voltstream.sources.tables import delete_folder, folder_exists

DAY, LOAD, KIND, BUCKET = "dt", "load", "kind", "bucket"
#: a task writes the few kinds of frames side by side; without this it sorts its whole frames by kind first, and spills
CONCURRENT_KINDS = {"spark.sql.maxConcurrentOutputFileWriters": "4"}
_PLACE = f"{DAY} DATE, {LOAD} STRING"
#: columns of a stored frame beside its place and kind
FRAME_DDL = (
    "id BIGINT, request_uuid STRING, request_date TIMESTAMP, entity_id BIGINT, serial_number STRING, identity_key STRING, "
    "ingest_load_timestamp TIMESTAMP, _frame_no INT, _frame_type STRING, OCPP_MESSAGE_UNIQUE_ID STRING, OCPP_ACTION STRING, "
    "OCPP_REQUEST_MESSAGE STRING, OCPP_RESPONSE_MESSAGE STRING, _body_at INT, SOURCE_CONNECTOR_ID STRING, "
    "SOURCE_MESSAGE_TIMESTAMP_CREATED TIMESTAMP, SOURCE_MESSAGE_TIMESTAMP_UPDATED TIMESTAMP"
)
KEY_DDL = "identity_key STRING, OCPP_MESSAGE_UNIQUE_ID STRING, at TIMESTAMP, frame_type STRING, id BIGINT, _frame_no INT"
TABLES = {
    "lines": schemas.ddl(schemas.BRONZE_DDL),
    "frames": f"{FRAME_DDL}, {KIND} STRING",
    "keys": f"{KEY_DDL}, {BUCKET} INT",
}
_CLOSED_LAYOUT = {"lines": [DAY], "frames": [DAY, KIND], "keys": [BUCKET, DAY]}

# ---------------------------------------------------------------------------
# reasons for the quarantine
# ---------------------------------------------------------------------------

NO_ID, NO_FRAME, IMPOSSIBLE_TIME, BROKEN_ROW = "no id", "no frame", "impossible time", "broken row"


@dataclass(frozen=True)
class LoadTables:
    """Where the tables are, and how many key buckets there are (fixed for their lifetime)."""

    root: str
    buckets: int = 64

    def open(self, table: str, day: str | None = None, load: str | None = None) -> str:
        path = f"{self.root}/open/{table}"
        return path if day is None else f"{path}/{DAY}={day}/{LOAD}={load}"

    def closed(self, table: str) -> str:
        return f"{self.root}/closed/{table}"

    @property
    def closed_days(self) -> str:
        return f"{self.root}/closed_days"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"


def quarantine_reasons(lines: DataFrame) -> Column:
    """Why a line can't become silver rows: NULL bronze id, no frame in its text, a time that no calendar has, or a
    source row whose fields could not be told apart. Empty for a good line (NULL fields elsewhere do no harm)."""
    raw = F.col("raw_log")
    times = F.regexp_extract_all(raw, F.lit(frame_ops.CREATED_PATTERN), F.lit(1))
    impossible = F.exists(times, lambda t: F.try_to_timestamp(t, F.lit(frame_ops.CREATED_FORMAT)).isNull())
    no_frame = raw.isNull() | (F.regexp_extract(raw, frame_ops.SEGMENT_PATTERN, 1) == "")
    broken = F.get_json_object(F.col(CORRUPT_COLUMN), f"$.{WHOLE_ROW}").isNotNull()
    return F.array_compact(F.array(F.when(F.col("id").isNull(), NO_ID), F.when(no_frame, NO_FRAME),
                                   F.when(impossible, IMPOSSIBLE_TIME), F.when(broken, BROKEN_ROW)))


def frame_rows(lines: DataFrame, log_tz: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Stored frames of bronze lines (with the columns in ``keep``): the only place where patterns run over log text."""
    parsed = silver.parse_frames(lines, log_tz=log_tz)
    kind = F.col("_frame_type")
    text = F.coalesce("OCPP_REQUEST_MESSAGE", "OCPP_RESPONSE_MESSAGE")
    body = F.when(kind == frame_ops.CALL, F.col("_request_body")).when(kind == frame_ops.CALL_RESULT, F.col("_response_body"))
    body_at = F.when(body != "", F.length(text) - F.length(body) + 1)
    columns = [part.split()[0] for part in FRAME_DDL.split(", ")]
    return parsed.withColumns({"_body_at": body_at, KIND: kind}).select(*columns, *keep, KIND)


def key_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("identity_key", "OCPP_MESSAGE_UNIQUE_ID"), F.lit(buckets)).cast("int")


def ingest_load(spark: SparkSession, tables: LoadTables, rows: DataFrame, load: str, day: str, log_tz: str | None = None) -> dict:
    """Write a load's tables; a repeated load replaces itself. Returns the rows of lines and of the quarantine.

    A load can't be added to a day that is folded: readers take such a day from its folded copy.
    """
    if day in closed_days(spark, tables):
        raise ValueError(f"day {day} is closed; ingest load {load!r} under a later day")
    lines_ddl = TABLES["lines"]
    path = tables.open("lines", day, load)
    rows.write.mode("overwrite").parquet(path)
    lines = spark.read.schema(lines_ddl).parquet(path).withColumn("_reasons", quarantine_reasons(rows))
    good = F.size("_reasons") == 0
    seen = Observation()
    frames = frame_rows(lines.observe(seen, F.count(F.lit(1)).alias("lines"), F.count(F.when(~good, 1)).alias("bad")).filter(good).drop("_reasons"), log_tz)
    place = tables.open("frames", day, load)
    with settings(spark, CONCURRENT_KINDS):
        frames.write.mode("overwrite").partitionBy(KIND).parquet(place)
    counts = seen.get
    if counts.get("bad"):
        bad = lines.filter(~good).withColumn("reasons", F.col("_reasons")).drop("_reasons")
        bad.write.mode("overwrite").parquet(f"{tables.quarantine}/{DAY}={day}/{LOAD}={load}")
    if counts.get("lines", 0) > counts.get("bad", 0):
        stored = spark.read.schema(TABLES["frames"]).parquet(place).filter(F.col(KIND).isin(frame_ops.CALL, frame_ops.CALL_RESULT))
        keys = stored.filter(F.col("identity_key").isNotNull()).select(
            "identity_key", "OCPP_MESSAGE_UNIQUE_ID", F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED").alias("at"), F.col("_frame_type").alias("frame_type"),
            "id", "_frame_no", key_bucket(tables.buckets).alias(BUCKET))
        # rebalanced: a bucket of many keys is split, so that tasks grow with the load, not with the number of buckets
        keys.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "identity_key", "OCPP_MESSAGE_UNIQUE_ID").write.mode("overwrite").partitionBy(BUCKET).parquet(tables.open("keys", day, load))
    return {"lines": counts.get("lines", 0), "quarantined": counts.get("bad", 0)}


def closed_days(spark: SparkSession, tables: LoadTables) -> list[str]:
    """Days whose loads have been folded (one row each)."""
    if folder_exists(spark, tables.closed_days) is False:
        return []
    return sorted({str(r[0]) for r in spark.read.schema(f"{DAY} DATE").parquet(tables.closed_days).collect()})


def _none(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], f"{TABLES[table]}, {_PLACE}")


def read(spark: SparkSession, tables: LoadTables, table: str, days: list[str] | None = None, loads: list[tuple[str, str]] | None = None,
         buckets: list[int] | None = None) -> DataFrame:
    """Rows of a table with their place. Only the named days and loads (of open days), or key buckets, are listed and read."""
    ddl, done = f"{TABLES[table]}, {_PLACE}", closed_days(spark, tables)
    parts = []

    def add(base: str, paths: list[str]) -> None:
        paths = [p for p in paths if folder_exists(spark, p) is not False]
        if paths:
            parts.append(spark.read.schema(ddl).option("basePath", base).parquet(*paths))

    base = tables.closed(table)
    wanted = [d for d in done if days is None or d in days]
    if _CLOSED_LAYOUT[table][0] == DAY:
        add(base, [f"{base}/{DAY}={d}" for d in wanted])
    elif wanted:
        add(base, [base] if buckets is None else [f"{base}/{BUCKET}={b}" for b in buckets])
        parts = [p.filter(F.col(DAY).isin([_dt.date.fromisoformat(d) for d in wanted])) for p in parts]
    base = tables.open(table)
    if loads is not None:
        add(base, [tables.open(table, d, n) for d, n in loads if d not in done])
    elif folder_exists(spark, base) is not False:
        rows = spark.read.schema(ddl).parquet(base)
        rows = rows.filter(~F.col(DAY).isin([_dt.date.fromisoformat(d) for d in done])) if done else rows
        parts.append(rows.filter(F.col(BUCKET).isin(buckets)) if buckets is not None else rows)
    out = parts[0] if parts else _none(spark, table)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def silver_of_all(spark: SparkSession, tables: LoadTables, master: DataFrame, stage_time: Column | None = None,
                  defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Silver of every load, from the stored frames."""
    return silver.silver_from_frames(read(spark, tables, "frames"), master, stage_time=stage_time, defaults=defaults)


# ---------------------------------------------------------------------------
# what a load changes
# ---------------------------------------------------------------------------


#: columns of a changed call beside its and its result's place
_CHANGE = ("identity_key", "OCPP_MESSAGE_UNIQUE_ID", "at")


def _narrow(keys: DataFrame, kind: str) -> DataFrame:
    rows = keys.filter(F.col("frame_type") == kind)
    if kind == frame_ops.CALL:
        return rows.select("identity_key", "OCPP_MESSAGE_UNIQUE_ID", F.col("at").alias("_call_created"), F.struct("id", "_frame_no", DAY, LOAD).alias("_call"))
    return rows.select("identity_key", "OCPP_MESSAGE_UNIQUE_ID", F.col("at").alias("_res_created"), F.col("id").alias("_res_id"), F.col("_frame_no").alias("_res_no"),
                       F.struct("id", "_frame_no", DAY, LOAD).alias("_res"))


def changed_answers(history: DataFrame, is_new: Column) -> DataFrame:
    """Calls that are new, or whose answer differs once the new frames are there: key, time, ``_call`` and ``_res`` (both id,
    frame number and place; ``_res`` NULL without an answer). ``history``: narrow key rows of all frames that share a
    (station, message id) with a new one; a frame that was landed again counts once, at its latest place."""
    found = history.withColumn("_new", is_new)
    once = latest_by_key(found, ["identity_key", "OCPP_MESSAGE_UNIQUE_ID", "frame_type", "id", "_frame_no"], ["at", DAY, LOAD])
    fresh = once.filter("_new").select(F.col("id").alias("_n_id"), F.col("_frame_no").alias("_n_no"), F.lit(True).alias("_fresh"))

    def paired(rows: DataFrame) -> DataFrame:
        return silver.answers(_narrow(rows, frame_ops.CALL), _narrow(rows, frame_ops.CALL_RESULT), ["_res"])

    every = once.filter(F.col("frame_type") == frame_ops.CALL).select(*_CHANGE, F.struct("id", "_frame_no", DAY, LOAD).alias("_c"))
    known = found.filter("not _new")
    known = latest_by_key(known, ["identity_key", "OCPP_MESSAGE_UNIQUE_ID", "frame_type", "id", "_frame_no"], ["at", DAY, LOAD])
    told = lambda c: [F.col(f"{c}.id"), F.col(f"{c}._frame_no")]
    after = paired(once).select(*[x.alias(n) for x, n in zip(told("_call"), ("_a_id", "_a_no"))], "_res")
    before = paired(known).select(*[x.alias(n) for x, n in zip(told("_call"), ("_b_id", "_b_no"))], F.struct(*told("_res")).alias("_was"))
    rows = every.join(after, (F.col("_c.id") == F.col("_a_id")) & (F.col("_c._frame_no") == F.col("_a_no")), "left")
    rows = rows.join(before, (F.col("_c.id") == F.col("_b_id")) & (F.col("_c._frame_no") == F.col("_b_no")), "left")
    rows = rows.join(fresh, (F.col("_c.id") == F.col("_n_id")) & (F.col("_c._frame_no") == F.col("_n_no")), "left")
    same = F.col("_res.id").eqNullSafe(F.col("_was.id")) & F.col("_res._frame_no").eqNullSafe(F.col("_was._frame_no"))
    return rows.filter(F.col("_fresh") | ~same).select(*_CHANGE, F.col("_c").alias("_call"), "_res")


def key_groups(keys: DataFrame, is_new: Column) -> DataFrame:
    """Per (station, message id) with new frames and calls: whether these are one new call and one new result at most
    (``_plain``), and then the call's and the result's id, frame number and time. One pass of partial aggregates."""
    call = F.col("frame_type") == frame_ops.CALL
    count = lambda c: F.count(F.when(c, 1))
    of = {f"{p}_{c}": F.max(F.when(kind, F.col(c))) for p, kind in (("_c", call), ("_r", ~call)) for c in ("id", "_frame_no", "at")}
    groups = keys.filter(F.col("identity_key").isNotNull() & F.col("OCPP_MESSAGE_UNIQUE_ID").isNotNull()).groupBy(
        "identity_key", "OCPP_MESSAGE_UNIQUE_ID").agg(
        count(is_new).alias("_new"), count(~is_new).alias("_old"), count(call).alias("_calls"), count(~call).alias("_results"),
        *[c.alias(n) for n, c in of.items()])
    plain = (F.col("_old") == 0) & (F.col("_calls") == 1) & (F.col("_results") <= 1)
    return groups.filter("_new > 0 AND _calls > 0").select("identity_key", "OCPP_MESSAGE_UNIQUE_ID", plain.alias("_plain"), *of)


def plain_answers(groups: DataFrame, load: str, day: str) -> DataFrame:
    """``changed_answers`` of groups with one call, which is the load's, and no result but one of the load."""
    place = (F.lit(day).cast("date").alias(DAY), F.lit(load).alias(LOAD))
    frame = lambda p: F.struct(F.col(f"{p}_id").alias("id"), F.col(f"{p}__frame_no").alias("_frame_no"), *place)
    answered = F.col("_c_at") <= F.col("_r_at")
    return groups.select("identity_key", "OCPP_MESSAGE_UNIQUE_ID", F.col("_c_at").alias("at"), frame("_c").alias("_call"), F.when(answered, frame("_r")).alias("_res"))


def silver_of_load(spark: SparkSession, tables: LoadTables, load: str, day: str, master: DataFrame, stage_time: Column | None = None,
                   defaults: Mapping[str, object] | None = None, arrange: Column | None = None, work: str | None = None) -> DataFrame:
    """Silver rows that a load adds or changes: its own requests, and earlier ones whose answer is another one now.

    A result may come any time after its request. Keys are read from the buckets of the load's keys only, whole frames
    only from the loads of the changed calls and their results. A message id with one call and one result, both of this
    load, needs no search in the history. Results and master columns are put to the narrow rows of the changed calls, so
    that whole calls are moved once; with ``arrange`` once more, by that value, before their payloads are parsed.
    ``work``: where to write what the result reads (default: a folder of this run's own).
    """
    place = tables.open("keys", day, load)
    if folder_exists(spark, place) is False:
        return silver.silver_from_frames(_none(spark, "frames"), master, stage_time=stage_time, defaults=defaults)
    base = work or run_dir(spark, "load")

    def once(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    mine = spark.read.schema(f"{TABLES['keys']}, {_PLACE}").option("basePath", tables.open("keys")).parquet(place)
    touched = [r[0] for r in mine.select(BUCKET).distinct().collect()]  # at most ``buckets``
    keys = read(spark, tables, "keys", buckets=sorted(touched))
    is_new = (F.col(LOAD) == load) & (F.col(DAY) == F.lit(day).cast("date"))
    groups = once(key_groups(keys, is_new), "groups")
    changes = plain_answers(groups.filter("_plain"), load, day)
    others = groups.filter("NOT _plain").select(F.col("identity_key").alias("_k"), F.col("OCPP_MESSAGE_UNIQUE_ID").alias("_m"))
    if not others.isEmpty():
        shared = keys.join(others, (F.col("identity_key") == F.col("_k")) & (F.col("OCPP_MESSAGE_UNIQUE_ID") == F.col("_m")), "left_semi")
        changes = changes.unionByName(changed_answers(once(shared, "history"), is_new))
    changes = once(changes, "changes")

    def frames_at(ref: str, kind: str) -> DataFrame:
        # the loads that hold some, a list bounded by their number; of closed days, the days
        at = [(str(r[0]), r[1]) for r in changes.filter(F.col(ref).isNotNull()).select(f"{ref}.{DAY}", f"{ref}.{LOAD}").distinct().collect()]
        rows = read(spark, tables, "frames", days=sorted({d for d, _ in at}), loads=sorted(at))
        return rows.filter(F.col(KIND) == kind)

    def of(ref: str) -> Column:
        return (F.col("id") == F.col(f"{ref}.id")) & (F.col("_frame_no") == F.col(f"{ref}._frame_no")) & (F.col(DAY) == F.col(f"{ref}.{DAY}")) & (F.col(LOAD) == F.col(f"{ref}.{LOAD}"))

    results = frames_at("_res", frame_ops.CALL_RESULT).select("id", "_frame_no", DAY, LOAD, "OCPP_RESPONSE_MESSAGE", F.col("_body_at").alias("_res_at"))
    found = results.join(changes.filter(F.col("_res").isNotNull()), of("_res")).select(*_CHANGE, "_call", "OCPP_RESPONSE_MESSAGE", "_res_at")
    none = changes.filter(F.col("_res").isNull()).select(*_CHANGE, "_call", F.lit(None).cast("string").alias("OCPP_RESPONSE_MESSAGE"), F.lit(None).cast("int").alias("_res_at"))
    told = found.unionByName(none).withColumns({"id": F.col("_call.id"), "SOURCE_MESSAGE_TIMESTAMP_CREATED": F.col("at")})
    told = silver.enrich_with_master(told, master).select(
        "_call", F.col("identity_key").alias("_k"), F.col("OCPP_MESSAGE_UNIQUE_ID").alias("_m"), "OCPP_RESPONSE_MESSAGE", "_res_at", *silver.MASTER_KEEP)
    calls = silver.requests(frames_at("_call", frame_ops.CALL)).drop("OCPP_RESPONSE_MESSAGE")
    paired = calls.join(told, of("_call") & (F.col("identity_key") == F.col("_k")) & (F.col("OCPP_MESSAGE_UNIQUE_ID") == F.col("_m"))).drop("_call", "_k", "_m")
    if arrange is not None:
        paired = paired.withColumn("_arranged", arrange).hint("rebalance", "_arranged").drop("_arranged")
    return silver.silver_of_calls(paired, defaults, stage_time)


# ---------------------------------------------------------------------------
# days that are over
# ---------------------------------------------------------------------------


def open_days(spark: SparkSession, tables: LoadTables) -> list[str]:
    """Days with loads that are not folded yet."""
    base = tables.open("lines")
    if folder_exists(spark, base) is False:
        return []
    done = set(closed_days(spark, tables))
    return sorted(str(r[0]) for r in spark.read.schema(f"id BIGINT, {_PLACE}").parquet(base).select(DAY).distinct().collect() if str(r[0]) not in done)


def day_of_load(spark: SparkSession, tables: LoadTables, load: str) -> str | None:
    """The day that an open load was (or began to be) written for."""
    base = tables.open("lines")
    if folder_exists(spark, base) is False:
        return None
    found = spark.read.schema(f"id BIGINT, {_PLACE}").parquet(base).filter(F.col(LOAD) == load).agg(F.min(DAY)).first()[0]
    return None if found is None else str(found)


def close_days(spark: SparkSession, tables: LoadTables, before: str) -> list[str]:
    """Fold the loads of all open days before ``before`` into day partitions; returns the days."""
    days = [d for d in open_days(spark, tables) if d < before]
    for day in days:
        for table, layout in _CLOSED_LAYOUT.items():
            base = tables.open(table)
            if folder_exists(spark, f"{base}/{DAY}={day}") is False:
                continue
            rows = spark.read.schema(f"{TABLES[table]}, {_PLACE}").option("basePath", base).parquet(f"{base}/{DAY}={day}")
            (rows.hint("rebalance", *layout).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*layout).parquet(tables.closed(table)))
        spark.range(1).select(F.lit(day).cast("date").alias(DAY)).coalesce(1).write.mode("append").parquet(tables.closed_days)
    return days


def sweep(spark: SparkSession, tables: LoadTables) -> list[str]:
    """Remove the open folders of days that are noted as closed."""
    gone = []
    for day in closed_days(spark, tables):
        for table in TABLES:
            path = f"{tables.open(table)}/{DAY}={day}"
            if folder_exists(spark, path):
                delete_folder(spark, path)
                gone.append(path)
    return gone


# ---------------------------------------------------------------------------
# quarantine
# ---------------------------------------------------------------------------


def read_quarantine(spark: SparkSession, tables: LoadTables) -> DataFrame | None:
    """Quarantined lines with ``reasons`` and the place they came from; None if there never was one."""
    if folder_exists(spark, tables.quarantine) is False:
        return None
    rows = spark.read.schema(f"{TABLES['lines']}, reasons ARRAY<STRING>, {_PLACE}").parquet(tables.quarantine)
    replayed = f"{tables.root}/replayed"
    if folder_exists(spark, replayed) is False:
        return rows
    done = spark.read.schema("row STRING").parquet(replayed).select(F.col("row").alias("_done"))
    return rows.join(done, quarantine_row() == F.col("_done"), "left_anti")


def quarantine_row() -> Column:
    """What tells a quarantined line: its place and its content."""
    return F.sha2(F.to_json(F.struct(DAY, LOAD, "id", "request_uuid", "raw_log", "identity_key", CORRUPT_COLUMN)), 256)


def replay(spark: SparkSession, tables: LoadTables, repair: Callable[[DataFrame], DataFrame], load: str, day: str) -> dict:
    """Repair quarantined lines and ingest them as a load of their own.

    ``repair`` gets the quarantined lines and returns bronze lines (rows it can't mend left out or unchanged, with the
    column ``_row`` passed through). Lines that are good now leave the quarantine; the others stay.
    """
    held = read_quarantine(spark, tables)
    if held is None:
        return {"lines": 0, "quarantined": 0}
    names = [part.split()[0] for part in TABLES["lines"].split(",")]
    mended = repair(held.withColumn("_row", quarantine_row())).withColumn("_reasons", F.lit(None))
    mended = mended.withColumn("_reasons", quarantine_reasons(mended)).filter(F.size("_reasons") == 0)
    base = run_dir(spark, "replay")
    mended.select(*names, "_row").write.parquet(base)
    mended = spark.read.parquet(base)
    told = ingest_load(spark, tables, mended.select(*names), load, day)
    mended.select(F.col("_row").alias("row")).write.mode("append").parquet(f"{tables.root}/replayed")
    return told
