"""Queries over several loads: reused ids, late and malformed rows, empty increments, reloads; and meter readings.

Each is registered by ``catalog`` with an oracle in plain SQL over the driver's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltstream import schemas
from voltstream.functions.frames import CREATED_FORMAT
from voltstream.operators import bronze as bronze_ops
from voltstream.operators import silver as silver_ops
from voltstream.operators.incremental import land_increment
from voltstream.plans import fixtures, load_tables, master_reload, medallion, view_tables, views
from voltstream.plans.load_tables import LoadTables
from voltstream.session import ensure_utc, run_dir
from voltstream.sources.csv import CORRUPT_COLUMN, read_ocpp_csv, write_csv, write_snapshot_csv
from voltstream.streaming.ingest import append_stream, stream_master_csv, stream_ocpp_csv

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"
LATE_FROM = "2024-01-10"


def _reader_rows(df: DataFrame, row_id, created, log) -> DataFrame:
    """Reader rows for rendered log lines of events."""
    uid = F.col("user_id")
    station = F.concat(F.lit("CS-"), F.lpad(uid.cast("string"), 6, "0"))
    return df.select(
        row_id.cast("bigint").alias("id"), F.concat(F.lit("R-"), row_id.cast("string")).alias("request_uuid"),
        F.try_to_timestamp(created, F.lit(CREATED_FORMAT)).alias("request_date"), uid.alias("entity_id"), F.lit(1).cast("bigint").alias("service_provider_id"),
        log.alias("raw_log"), F.lit("SN").alias("serial_number"), station.alias("identity_key"), F.lit(None).cast("string").alias(CORRUPT_COLUMN),
        *[c for c in df.columns if c == "load"])


def reused_id_lines(spark, sf_dir) -> DataFrame:
    """A StartTransaction for every event, with one of three message ids a station uses over and over, and
    for most a result up to 60 hours later whose transaction id is its event; rows come in three mixed loads."""
    # dealt out before rendering, as in ocpp_from_events: a table of few row groups would be rendered by as few tasks
    ev = fixtures.table(spark, sf_dir, "events").select("event_id", "user_id", "ts").repartition("event_id", "user_id", "ts")
    eid = F.col("event_id")
    mid = F.concat(F.lit("M"), (eid % 3).cast("string"))
    late = F.col("ts") + F.make_dt_interval(F.lit(0), ((eid % 7) * 10).cast("int"), F.lit(0), F.lit(1).cast("decimal(18,6)"))
    call_time, result_time = F.date_format("ts", CREATED_FORMAT), F.date_format(late, CREATED_FORMAT)
    calls = _reader_rows(ev.withColumn("load", (eid % 3).cast("string")), eid * 2, call_time,
                         F.concat(call_time, F.lit(' [2,"'), mid, F.lit('","StartTransaction",{"idTag":"T"}]@@EOM@@')))
    results = _reader_rows(ev.where("event_id % 5 <> 0").withColumn("load", ((eid * 7 + 1) % 3).cast("string")), eid * 2 + 1, result_time,
                           F.concat(result_time, F.lit(' [3,"'), mid, F.lit('",{"transactionId":"'), eid.cast("string"), F.lit('"}]@@EOM@@')))
    return calls.unionByName(results)


def _as_bronze(lines: DataFrame) -> DataFrame:
    """Bronze rows of lines that name their load."""
    rows = bronze_ops.add_ingest_metadata(lines, source_file=F.lit("events"), ingest_time=medallion.fixed_stamp())
    keyed = bronze_ops.add_frame_keys(rows, load=F.col("load"))
    typed = bronze_ops.conform(keyed.drop("load", "frame_kind", "message_ids"))
    return keyed.select(*typed.columns, "message_ids", *bronze_ops.PARTITIONS)


def q_pair_reused_ids(spark, sf_dir):
    """Ids that repeat, results hours late, loads out of order: gold after three per-load merges."""
    base = run_dir(spark, "reused-ids")
    _as_bronze(reused_id_lines(spark, sf_dir)).write.partitionBy(*bronze_ops.PARTITIONS).parquet(f"{base}/bronze")
    whole, master = spark.read.parquet(f"{base}/bronze"), fixtures.master_from_tables(spark, sf_dir)
    for n in (2, 0, 1):
        seen = whole.filter(F.col("load").isin([str(x) for x in (2, 0, 1)][: (2, 0, 1).index(n) + 1]))
        increment = medallion.silver_increment(seen.withColumn("load", F.col("load").cast("string")), str(n), master, stage_time=medallion.fixed_stamp())
        medallion.merge_into_gold_table(f"{base}/gold", increment, f"{base}/_stage", stamp=medallion.fixed_stamp())
    return spark.read.parquet(f"{base}/gold").select("SOURCE_ID", "TRANSACTION_ID")


def q_pair_reused_ids_batch(spark, sf_dir):
    """The same rows in one batch build."""
    silver = silver_ops.to_silver(_as_bronze(reused_id_lines(spark, sf_dir)), fixtures.master_from_tables(spark, sf_dir), stage_time=medallion.fixed_stamp())
    return silver.select("SOURCE_ID", "TRANSACTION_ID")


def q_pair_reused_ids_tables(spark, sf_dir):
    """The same three loads through the load tables: gold, and by how many loads each request was emitted."""
    ensure_utc(spark)
    base, stamp = run_dir(spark, "reused-tables"), medallion.fixed_stamp()
    tables, master = LoadTables(f"{base}/bronze", buckets=16), fixtures.master_from_tables(spark, sf_dir)
    rows, emitted = _as_bronze(reused_id_lines(spark, sf_dir)), None
    for day, n in enumerate(("2", "0", "1"), 1):
        lines = rows.where(F.col("load") == n).drop("message_ids", *bronze_ops.PARTITIONS)
        load_tables.ingest_load(spark, tables, lines, n, f"2024-02-0{day}")
        silver = load_tables.silver_of_load(spark, tables, n, f"2024-02-0{day}", master, stage_time=stamp)
        silver.write.parquet(f"{base}/silver/{n}")
        silver = spark.read.parquet(f"{base}/silver/{n}")
        medallion.merge_into_gold_table(f"{base}/gold", silver, f"{base}/_stage", stamp=stamp)
        emitted = silver.select("SOURCE_ID") if emitted is None else emitted.unionByName(silver.select("SOURCE_ID"))
        load_tables.close_days(spark, tables, f"2024-02-0{day}")
    times = emitted.groupBy("SOURCE_ID").agg(F.count(F.lit(1)).alias("n_emitted"))
    return spark.read.parquet(f"{base}/gold").select("SOURCE_ID", "TRANSACTION_ID").join(times, "SOURCE_ID")


def _split_lines(spark, sf_dir):
    """Bronze rows of the events' lines in two loads, by day of the log; rendered and written once, read for each use."""
    rows = medallion.stored(fixtures.bronze_from_events(spark, sf_dir, ingest_time=medallion.fixed_stamp()), "lines")
    return rows, F.col("request_date") < F.lit("2024-01-16").cast("timestamp")


def q_silver_from_stored_frames(spark, sf_dir):
    """Two loads ingested as frames, the first one's day closed and swept; silver of all frames."""
    ensure_utc(spark)
    tables = LoadTables(run_dir(spark, "frames"), buckets=8)
    rows, early = _split_lines(spark, sf_dir)
    load_tables.ingest_load(spark, tables, rows.where(early), "a", "2024-02-01")
    load_tables.ingest_load(spark, tables, rows.where(~early), "b", "2024-02-02")
    load_tables.close_days(spark, tables, "2024-02-02")
    load_tables.sweep(spark, tables)
    return load_tables.silver_of_all(spark, tables, fixtures.master_from_tables(spark, sf_dir), stage_time=medallion.fixed_stamp()).select(
        "SOURCE_ID", "OCPP_ACTION", "OCPP_MESSAGE_UNIQUE_ID", "SOURCE_CONNECTOR_ID", "STATUS", "ID_TAG", "ID_TAG_STATUS", "TRANSACTION_ID",
        F.date_format("UNIFIED_TIMESTAMP", TS_TEXT).alias("UNIFIED_TIMESTAMP"))


def q_quarantine_replay(spark, sf_dir):
    """Lines broken in four ways, ingested and merged without them, then repaired and replayed: gold of all lines."""
    ensure_utc(spark)
    base, stamp = run_dir(spark, "replay-gold"), medallion.fixed_stamp()
    tables, master = LoadTables(f"{base}/bronze", buckets=8), fixtures.master_from_tables(spark, sf_dir)
    rows, early = _split_lines(spark, sf_dir)
    how, raw = F.col("id") % 20, F.col("raw_log")
    broken = rows.withColumns({
        "serial_number": F.concat_ws("|", "serial_number", F.col("id").cast("string")),  # what the repair knows the line by
        "raw_log": F.when(how.isin(3, 4), F.regexp_replace(raw, r"@@EOM@@$", "")).when(how.isin(5, 6), F.regexp_replace(raw, r"^\d\d-", "39-")).otherwise(raw),
        CORRUPT_COLUMN: F.when(how.isin(7, 8), F.lit('{"_row":"some text"}')),
        "id": F.when(~how.isin(1, 2), F.col("id"))})

    def merge(load, day):
        silver = load_tables.silver_of_load(spark, tables, load, day, master, stage_time=stamp)
        medallion.merge_into_gold_table(f"{base}/gold", silver, f"{base}/_stage", stamp=stamp)

    for load, day, part in (("a", "2024-02-01", broken.where(early)), ("b", "2024-02-02", broken.where(~early))):
        load_tables.ingest_load(spark, tables, part, load, day)
        merge(load, day)
    good = rows.select(F.col("id").cast("string").alias("_id"), F.col("raw_log").alias("_log"))

    def repair(held):
        by = F.element_at(F.split("serial_number", r"\|"), 2)
        return held.join(good, by == F.col("_id")).withColumns({"id": F.col("_id").cast("bigint"), "raw_log": F.col("_log"), CORRUPT_COLUMN: F.lit(None).cast("string")})

    held = load_tables.read_quarantine(spark, tables)
    why = held.select(F.element_at(F.split("serial_number", r"\|"), 2).alias("_line"), F.array_join("reasons", ",").alias("reason"))
    why.write.parquet(f"{base}/why")
    load_tables.close_days(spark, tables, "2024-02-03")
    load_tables.replay(spark, tables, repair, "replay-1", "2024-02-03")
    merge("replay-1", "2024-02-03")
    left = load_tables.read_quarantine(spark, tables).count()
    why = spark.read.parquet(f"{base}/why")
    gold = spark.read.parquet(f"{base}/gold").select("SOURCE_ID", "OCPP_ACTION", "ID_TAG_STATUS", "TRANSACTION_ID", F.split("SERIAL_NUMBER", r"\|")[0].alias("SERIAL_NUMBER"))
    return gold.join(why, F.col("SOURCE_ID") == F.col("_line"), "left").select(*gold.columns, "reason", F.lit(left).cast("bigint").alias("left_in_quarantine"))


RELOAD_FROM = "2024-01-11"


def _two_masters(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A master load of the stations that 5 does not divide, and a reload from 11 Jan on: all stations, the even ones with new values."""
    first, key = fixtures.master_from_tables(spark, sf_dir), F.substring("OCPP_CHARGE_STATION_ID", 4, 20).cast("int")
    load = lambda t: F.lit(t).cast("timestamp")
    again = first.withColumn("MANUFACTURER", F.when(key % 2 == 0, F.concat(F.lit("new-"), F.col("MANUFACTURER"))).otherwise(F.col("MANUFACTURER")))
    return first.where(key % 5 != 0).withColumn(schemas.MASTER_LOAD, load("2023-12-01")), again.withColumn(schemas.MASTER_LOAD, load(RELOAD_FROM))


def q_master_reload_per_load(spark, sf_dir):
    """Two loads with a master reload in between, whose values hold from a time in the middle of the first load: per-load gold."""
    ensure_utc(spark)
    base, stamp = run_dir(spark, "reload"), medallion.fixed_stamp()
    tables, (first, again) = LoadTables(f"{base}/bronze", buckets=8), _two_masters(spark, sf_dir)
    both, gold = first.unionByName(again), f"{base}/gold"
    rows, early = _split_lines(spark, sf_dir)

    def load(name, day, part, master):
        load_tables.ingest_load(spark, tables, part, name, day)
        medallion.merge_into_gold_table(gold, load_tables.silver_of_load(spark, tables, name, day, master, stage_time=stamp), f"{base}/_stage", stamp=stamp)

    load("a", "2024-02-01", rows.where(early), first)
    master_reload.apply_reload(spark, gold, tables, first, both, f"{base}/_stage", stamp=stamp)
    load("b", "2024-02-02", rows.where(~early), both)
    return spark.read.parquet(gold).select("SOURCE_ID", "CHARGE_STATION_ID", "MANUFACTURER", "COUNTRY_CODE")


def q_master_reload_batch(spark, sf_dir):
    """The same master loads in one batch build."""
    ensure_utc(spark)
    first, again = _two_masters(spark, sf_dir)
    rows = fixtures.bronze_from_events(spark, sf_dir, ingest_time=medallion.fixed_stamp())
    return medallion.stored_silver(rows, first.unionByName(again), stage_time=medallion.fixed_stamp()).select("SOURCE_ID", "CHARGE_STATION_ID", "MANUFACTURER", "COUNTRY_CODE")


def q_gold_merge_empty_load(spark, sf_dir):
    """A load of results alone (no row for silver), a load of unknown stations, then a load with rows."""
    base, stamp = run_dir(spark, "empty-load"), medallion.fixed_stamp()
    silver = medallion.stored(medallion.silver_from_tables(spark, sf_dir, stage_time=stamp), "silver")
    created = F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED")
    early = created < F.lit(LATE_FROM).cast("timestamp")
    for part in (silver.where("1 = 0"), silver.where(early), silver.where("CHARGE_STATION_ID = 'unknown'"), silver.where(~early)):
        medallion.merge_into_gold_table(f"{base}/gold", part, f"{base}/_stage", stamp=stamp)
    return spark.read.parquet(f"{base}/gold").select("SOURCE_ID", "OCPP_ACTION")


def q_land_late_rows(spark, sf_dir):
    """Three landing runs from source CSV files: on time; late rows, ties at the mark and rows without a time; nothing new."""
    base = run_dir(spark, "late-rows")
    lines = fixtures.ocpp_from_events(fixtures.table(spark, sf_dir, "events"))
    late = F.col("id") % 6 == 0
    lines = lines.withColumn("request_date", F.when(F.col("id") % 14 == 0, F.lit(None)).otherwise(F.col("request_date")))
    source = f"{base}/source"
    landing, marks, ids = f"{base}/landing", f"{base}/_marks", f"{base}/_ids"
    write_csv(lines.filter(~late), f"{source}/1")
    land_increment(spark, read_ocpp_csv(spark, f"{source}/1"), landing, marks, load_id="1", landed_ids=ids)
    write_csv(lines.filter(late), f"{source}/2")
    for n in ("2", "3"):  # the source only grows; the third run finds nothing new
        land_increment(spark, read_ocpp_csv(spark, f"{source}/*"), landing, marks, load_id=n, landed_ids=ids)
    landed = read_ocpp_csv(spark, f"{landing}/load=*/dt=*/")
    path = F.col("_metadata.file_path")
    return landed.select("id", F.regexp_extract(path, r"/load=([^/]+)/", 1).cast("int").alias("load"), F.date_format("request_date", TS_TEXT).alias("request_date"))


def q_land_malformed(spark, sf_dir):
    """Source CSV with broken rows (an id that is no number): all land, the broken ones with the field's text."""
    base = run_dir(spark, "malformed")
    lines = fixtures.ocpp_from_events(fixtures.table(spark, sf_dir, "events"))
    broken = F.col("id") % 9 == 0
    text = lines.drop(CORRUPT_COLUMN).withColumn("id", F.when(broken, F.concat(F.lit("x"), F.col("id").cast("string"))).otherwise(F.col("id").cast("string")))
    write_csv(text, f"{base}/source")
    land_increment(spark, read_ocpp_csv(spark, f"{base}/source"), f"{base}/landing", f"{base}/_marks", load_id="1", landed_ids=f"{base}/_ids")
    landed = read_ocpp_csv(spark, f"{base}/landing/load=*/dt=*/")
    text = F.get_json_object(CORRUPT_COLUMN, "$.id")
    return landed.select(F.coalesce(F.col("id").cast("string"), text).alias("id"), (F.col("id").isNotNull() & F.col(CORRUPT_COLUMN).isNull()).alias("clean"))


def _two_frame_lines(spark, sf_dir) -> DataFrame:
    """One line an event: the result of an earlier call and then a Heartbeat call, in one text."""
    ev = fixtures.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    eid, at = F.col("event_id"), F.date_format("ts", CREATED_FORMAT)
    first = F.when(eid % 2 == 0, F.concat(F.lit('[3,"R'), eid.cast("string"), F.lit('",{"status":"Accepted"}]@@EOM@@'))).otherwise(
        F.concat(F.lit('[2,"S'), eid.cast("string"), F.lit('","StatusNotification",{"connectorId":1,\n"status":"Available","info":"a [b]"}]@@EOM@@')))
    return _reader_rows(ev.withColumn("load", F.lit("1")), eid, at, F.concat(at, F.lit(" "), first, F.lit("\n"), at, F.lit(' [2,"H'), eid.cast("string"), F.lit('","Heartbeat",{}]@@EOM@@')))


def q_parse_multi_frame(spark, sf_dir):
    """All frames of a line, over bronze partitioned by load and kind."""
    base = run_dir(spark, "multi-frame")
    _as_bronze(_two_frame_lines(spark, sf_dir)).write.partitionBy(*bronze_ops.PARTITIONS).parquet(f"{base}/bronze")
    silver = silver_ops.to_silver(spark.read.parquet(f"{base}/bronze"), fixtures.master_from_tables(spark, sf_dir))
    return silver.select("SOURCE_ID", "OCPP_ACTION", "OCPP_MESSAGE_UNIQUE_ID", "STATUS")


def q_parse_multi_frame_plain(spark, sf_dir):
    """The same lines without the partition columns."""
    plain = _as_bronze(_two_frame_lines(spark, sf_dir)).drop("message_ids", *bronze_ops.PARTITIONS)
    silver = silver_ops.to_silver(plain, fixtures.master_from_tables(spark, sf_dir))
    return silver.select("SOURCE_ID", "OCPP_ACTION", "OCPP_MESSAGE_UNIQUE_ID", "STATUS")


def q_master_reload(spark, sf_dir):
    """A master snapshot, then a reload with other values for every second station and connectors 10 and 2."""
    base = run_dir(spark, "master-reload")
    first = fixtures.master_from_tables(spark, sf_dir)
    key = F.substring("OCPP_CHARGE_STATION_ID", 4, 20).cast("int")
    again = first.filter(key % 2 == 0).withColumn("CONNECTOR_ID", F.when(F.col("CONNECTOR_ID") == "1", "10").otherwise("2")).withColumn(
        "MANUFACTURER", F.concat(F.lit("new-"), F.col("CONNECTOR_ID")))
    for n, rows in enumerate((first, again)):
        write_snapshot_csv(rows, f"{base}/landing/{n}")
        append_stream(stream_master_csv(spark, f"{base}/landing/*"), f"{base}/master", f"{base}/_ckpt")
    return silver_ops.station_master(spark.read.parquet(f"{base}/master"))


def _reordered(spark, sf_dir, base) -> str:
    """The lines as four groups of CSV files: as usual, swapped and in other case, without some columns, with some more."""
    lines = medallion.stored(fixtures.ocpp_from_events(fixtures.table(spark, sf_dir, "events")), "lines").drop(CORRUPT_COLUMN)
    names = lines.columns
    part = [lines.where(F.col("id") % 4 == n) for n in range(4)]
    write_csv(part[0], f"{base}/source/a")
    write_csv(part[1].select(*[F.col(c).alias(c.upper()) for c in reversed(names)]), f"{base}/source/b")
    write_csv(part[2].drop("serial_number", "service_provider_id").select("raw_log", "id", "identity_key", "request_date", "request_uuid", "entity_id"), f"{base}/source/c")
    more = part[3].withColumns({"firmware": F.concat(F.lit("fw-"), F.col("id").cast("string")),
                                "entity_id": F.when(F.col("id") % 5 == 0, F.lit("n/a")).otherwise(F.col("entity_id").cast("string"))})
    write_csv(more.select("firmware", "request_uuid", "id", "request_date", "serial_number", "raw_log", "entity_id", "service_provider_id", "identity_key"), f"{base}/source/d")
    return f"{base}/source/*/"


def q_csv_headers_reordered(spark, sf_dir):
    """Files with swapped, missing and added columns, read in batch and streamed into bronze: columns go by name."""
    ensure_utc(spark)
    base = run_dir(spark, "headers")
    source = _reordered(spark, sf_dir, base)
    append_stream(stream_ocpp_csv(spark, source, max_files_per_trigger=3, with_keys=False), f"{base}/bronze", f"{base}/_ckpt")
    found = None
    for how, rows in (("batch", read_ocpp_csv(spark, source)), ("stream", spark.read.parquet(f"{base}/bronze"))):
        one = rows.select(F.lit(how).alias("how"), "id", "request_uuid", F.date_format("request_date", TS_TEXT).alias("request_date"), "entity_id", "service_provider_id",
                          F.regexp_extract("raw_log", r'^\S+ \S+ \[[23],"(\d+)"', 1).alias("mid"), "serial_number", "identity_key",
                          F.get_json_object(CORRUPT_COLUMN, "$.firmware").alias("firmware"), F.get_json_object(CORRUPT_COLUMN, "$.entity_id").alias("entity_text"))
        found = one if found is None else found.unionByName(one)
    return found


def q_land_by_default(spark, sf_dir):
    """Three landing runs without any option over rows with ties at the mark, late rows and rows without a time."""
    ensure_utc(spark)
    base = run_dir(spark, "landed")
    lines = fixtures.ocpp_from_events(fixtures.table(spark, sf_dir, "events"))
    day = F.date_trunc("day", "request_date")  # many ties
    lines = lines.withColumn("request_date", F.when(F.col("id") % 14 == 0, F.lit(None)).otherwise(day))
    for n, rows in (("1", lines.where("id % 3 = 0")), ("2", lines.where("id % 3 <> 2")), ("3", lines)):
        land_increment(spark, rows, f"{base}/landing", f"{base}/_marks", load_id=n)
    landed = read_ocpp_csv(spark, f"{base}/landing/load=*/dt=*/")
    path = F.col("_metadata.file_path")
    return landed.select("id", F.regexp_extract(path, r"/load=([^/]+)/", 1).cast("int").alias("load"), F.date_format("request_date", TS_TEXT).alias("request_date"))


def q_meter_readings(spark, sf_dir):
    gold = medallion.gold_from_tables(spark, sf_dir, stamp=medallion.fixed_stamp())
    return views.meter_readings(gold).select("SOURCE_ID", "CHARGE_STATION_ID", "TRANSACTION_ID", "reading_no", "sample_no", "value")


def q_energy_from_readings(spark, sf_dir):
    gold = medallion.gold_from_tables(spark, sf_dir, stamp=medallion.fixed_stamp())
    return views.energy_from_readings(gold)


def q_heartbeats_with_down(spark, sf_dir):
    """VW1 over rows of which some say that the charger is down."""
    gold = medallion.gold_from_tables(spark, sf_dir, stamp=medallion.fixed_stamp())
    down = F.col("SOURCE_ID").cast("bigint") % 3 == 0
    return views.charger_heartbeats(gold.withColumn("STATUS", F.when(down, views.DOWN_STATUS).otherwise("Up")))


def q_views_by_name(spark, sf_dir):
    """Gold as a catalog table made from DDL, the views as catalog views, queried by name."""
    from voltstream.sources.tables import append_table, ensure_table

    base = run_dir(spark, "named")
    tag = base.rsplit("-", 1)[-1]
    gold = f"gold_{tag}"
    ensure_table(spark, gold, schemas.GOLD_DDL, f"{base}/gold")
    append_table(medallion.gold_from_tables(spark, sf_dir, stamp=medallion.fixed_stamp()), f"{base}/gold")
    spark.catalog.refreshTable(gold)
    views.create_views(spark, gold, suffix=f"_{tag}")
    return spark.sql(f"SELECT CHARGE_STATION_ID, date, heartbeat_count, was_down FROM charger_heartbeats_{tag}")


#: keys and values of each view in the long form that one query returns
_LONG = {
    "charger_heartbeats": (["CHARGE_STATION_ID", "date"], ["heartbeat_count", "was_down"]),
    "charging_session_errors": (["MANUFACTURER", "OCPP_ERROR_CODE", "VENDOR_ERROR_CODE"], ["error_count"]),
    "ev_transaction_units": (["ID_TAG", "CHARGE_STATION_ID", "stop_time", "start_time"], ["METER_START", "units_consumed"]),
    "charging_session_duration": (["TRANSACTION_ID", "CHARGE_STATION_ID", "session_start", "session_end"], []),
    "energy_consumption_by_charger": (["CHARGE_STATION_ID"], ["total_energy_consumed"]),
    "daily_energy_consumption": (["CHARGE_STATION_ID", "date"], ["total_energy_consumed"]),
}


def _long(name: str, view: DataFrame) -> DataFrame:
    """A view as rows (view, key as text, v1, v2)."""
    keys, values = _LONG[name]
    text = [F.coalesce(F.date_format(c, TS_TEXT) if view.schema[c].dataType.simpleString() == "timestamp" else F.col(c).cast("string"), F.lit("-")) for c in keys]
    numbers = [F.col(c).cast("double") for c in values] + [F.lit(None).cast("double")] * (2 - len(values))
    return view.select(F.lit(name).alias("view"), F.concat_ws("|", *text).alias("key"), numbers[0].alias("v1"), numbers[1].alias("v2"))


def _all_long(read) -> DataFrame:
    out = None
    for name in _LONG:
        one = read(name)
        if one is not None:
            out = _long(name, one) if out is None else out.unionByName(_long(name, one))
    return out


def q_six_views_by_name(spark, sf_dir):
    """Gold as a catalog table made from DDL, all six views as catalog views, each queried by name."""
    from voltstream.sources.tables import append_table, ensure_table

    ensure_utc(spark)
    base = run_dir(spark, "six")
    tag = base.rsplit("-", 1)[-1]
    gold = f"gold_{tag}"
    ensure_table(spark, gold, schemas.GOLD_DDL, f"{base}/gold")
    append_table(medallion.gold_from_tables(spark, sf_dir, stamp=medallion.fixed_stamp()), f"{base}/gold")
    spark.catalog.refreshTable(gold)
    views.create_views(spark, gold, suffix=f"_{tag}")
    return _all_long(lambda name: spark.sql(f"SELECT * FROM {name}_{tag}"))


def q_views_incremental(spark, sf_dir):
    """View tables after three merges: early rows with other values, rows that correct and add, the rest; touched days only."""
    ensure_utc(spark)
    base, stamp = run_dir(spark, "view-tables"), medallion.fixed_stamp()
    silver = medallion.stored(medallion.silver_from_tables(spark, sf_dir, stage_time=stamp), "silver")
    at = F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED")
    before = lambda d: at < F.lit(d).cast("timestamp")
    other = silver.withColumns({"OCPP_ACTION": F.when(F.col("OCPP_ACTION") == "StatusNotification", "Heartbeat").otherwise(F.col("OCPP_ACTION")),
                                "TRANSACTION_ID": F.lit(7), "METERVALUE_ENERGY_KWH": F.lit(1).cast("float"), "VENDOR_ERROR_CODE": F.lit("?")})
    for part in (other.where(before("2024-01-16")), silver.where(~before("2024-01-10")), silver.where(before("2024-01-10"))):
        told = medallion.merge_into_gold_table(f"{base}/gold", part, f"{base}/_stage", stamp=stamp)
        view_tables.refresh(spark, f"{base}/gold", f"{base}/views", told["touched"])
    return _all_long(lambda name: None if name == "ev_transaction_units" else view_tables.view(spark, f"{base}/views", name))


def _register_lines(spark, sf_dir) -> DataFrame:
    """A StopTransaction for every event with four readings, not in time order: an import register in Wh (which starts
    over in every fourth event), an export register in kWh, one in the protocol's defaults, and a state of charge."""
    ev = fixtures.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    eid, at = F.col("event_id"), F.date_format("ts", CREATED_FORMAT)
    text = lambda c: c.cast("string")

    def reading(r: int):
        value = (eid % 50) * 1000 + (eid % 7) * 100 * r
        if r >= 2:
            value = F.when(eid % 4 == 0, 30 + (eid % 7) * 100 * (r - 2)).otherwise(value)
        time = F.date_format(F.col("ts") + F.expr(f"INTERVAL {r} MINUTES"), fixtures.ISO_MS)
        return F.concat(F.lit('{"timestamp":"'), time, F.lit('","sampledValue":[{"value":"'), text(value), F.lit('","measurand":"Energy.Active.Import.Register","unit":"Wh","context":"Sample.Periodic"},'
                        f'{{"value":"{2 * r}","measurand":"Energy.Active.Export.Register","unit":"kWh"}},{{"value":"'), text(eid % 9 * r), F.lit('"},{"value":"55","measurand":"SoC","unit":"Percent"}]}'))

    body = F.concat(F.lit('{"idTag":"T","transactionId":'), text(eid), F.lit(',"transactionData":['), F.concat_ws(",", *[reading(r) for r in (2, 0, 3, 1)]), F.lit("]}"))
    return _reader_rows(ev.withColumn("load", F.lit("1")), eid * 2, at, F.concat(at, F.lit(' [2,"'), text(eid), F.lit('","StopTransaction",'), body, F.lit("]@@EOM@@")))


def _register_gold(spark, sf_dir) -> DataFrame:
    ensure_utc(spark)
    silver = medallion.stored_silver(_as_bronze(_register_lines(spark, sf_dir)), fixtures.master_from_tables(spark, sf_dir), stage_time=medallion.fixed_stamp())
    return medallion.first_gold(silver, stamp=medallion.fixed_stamp())


def q_energy_by_register(spark, sf_dir):
    r = views.register_energy(_register_gold(spark, sf_dir))
    return r.select("SOURCE_ID", "CHARGE_STATION_ID", "TRANSACTION_ID", "measurand", "unit", "context", F.round("first_kwh", 6).alias("first_kwh"),
                    F.round("last_kwh", 6).alias("last_kwh"), F.round("energy_kwh", 6).alias("energy_kwh"), "n_readings", "n_resets")


def q_energy_by_transaction(spark, sf_dir):
    t = views.energy_by_transaction(_register_gold(spark, sf_dir))
    return t.select("CHARGE_STATION_ID", "TRANSACTION_ID", "stops", F.round("imported_kwh", 6).alias("imported_kwh"), F.round("exported_kwh", 6).alias("exported_kwh"), "n_resets")


def q_heartbeat_body_time(spark, sf_dir):
    """Heartbeats with a time in their body; every third has a result with a time, every third one without."""
    ensure_utc(spark)
    ev = fixtures.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    eid, at = F.col("event_id"), F.date_format("ts", CREATED_FORMAT)
    body = lambda m: F.date_format(F.col("ts") + F.expr(f"INTERVAL {m} MINUTES"), fixtures.ISO_MS)
    ev = ev.withColumn("load", F.lit("1"))
    calls = _reader_rows(ev, eid * 2, at, F.concat(at, F.lit(' [2,"'), eid.cast("string"), F.lit('","Heartbeat",{"timestamp":"'), body(3), F.lit('"}]@@EOM@@')))
    answer = F.when(eid % 3 == 0, F.concat(F.lit('{"currentTime":"'), body(5), F.lit('"}'))).otherwise("{}")
    results = _reader_rows(ev.where("event_id % 3 < 2"), eid * 2 + 1, at, F.concat(at, F.lit(' [3,"'), eid.cast("string"), F.lit('",'), answer, F.lit("]@@EOM@@")))
    silver = silver_ops.to_silver(_as_bronze(calls.unionByName(results)), fixtures.master_from_tables(spark, sf_dir), stage_time=medallion.fixed_stamp())
    return silver.select("SOURCE_ID", F.date_format("PAYLOAD_TIMESTAMP", TS_TEXT).alias("PAYLOAD_TIMESTAMP"), "UNIFIED_TIMESTAMP_SOURCE")


def q_tables_from_ddl(spark, sf_dir):
    """Bronze and master tables made from DDL, filled, read by name."""
    from voltstream.sources.tables import append_table, ensure_table, read_table

    base = run_dir(spark, "ddl")
    tag = base.rsplit("-", 1)[-1]
    counts = None
    for name, ddl, rows in (("bronze", schemas.BRONZE_DDL, fixtures.bronze_from_events(spark, sf_dir, ingest_time=medallion.fixed_stamp())),
                            ("master", schemas.MASTER_DDL, fixtures.master_from_tables(spark, sf_dir))):
        ensure_table(spark, f"{name}_{tag}", ddl, f"{base}/{name}")
        append_table(rows, f"{base}/{name}")
        spark.catalog.refreshTable(f"{name}_{tag}")
        table = read_table(spark, f"{name}_{tag}")
        one = table.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.lit(len(table.columns)).cast("bigint").alias("n_columns"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


QUERIES = {
    "pair_reused_ids": q_pair_reused_ids,
    "pair_reused_ids_batch": q_pair_reused_ids_batch,
    "pair_reused_ids_tables": q_pair_reused_ids_tables,
    "silver_from_stored_frames": q_silver_from_stored_frames,
    "quarantine_replay": q_quarantine_replay,
    "master_reload_per_load": q_master_reload_per_load,
    "master_reload_batch": q_master_reload_batch,
    "gold_merge_empty_load": q_gold_merge_empty_load,
    "land_late_rows": q_land_late_rows,
    "land_malformed": q_land_malformed,
    "land_by_default": q_land_by_default,
    "csv_headers_reordered": q_csv_headers_reordered,
    "parse_multi_frame": q_parse_multi_frame,
    "parse_multi_frame_plain": q_parse_multi_frame_plain,
    "master_reload": q_master_reload,
    "meter_readings": q_meter_readings,
    "energy_from_readings": q_energy_from_readings,
    "heartbeats_with_down": q_heartbeats_with_down,
    "views_by_name": q_views_by_name,
    "six_views_by_name": q_six_views_by_name,
    "views_incremental": q_views_incremental,
    "energy_by_register": q_energy_by_register,
    "energy_by_transaction": q_energy_by_transaction,
    "heartbeat_body_time": q_heartbeat_body_time,
    "tables_from_ddl": q_tables_from_ddl,
}


def oracles(with_events, ts_text) -> dict[str, str]:
    """``with_events``: adds the CTEs ev, st, sv; ``ts_text``: a time as text."""
    o: dict[str, str] = {}
    o["pair_reused_ids"] = """
WITH calls AS (SELECT event_id, user_id, event_id % 3 AS mid, date_trunc('millisecond', ts) AS t FROM events),
results AS (SELECT event_id AS rid, user_id, event_id % 3 AS mid,
                   date_trunc('millisecond', ts) + to_hours(CAST(event_id % 7 * 10 AS BIGINT)) + INTERVAL 1 SECOND AS t
            FROM events WHERE event_id % 5 <> 0),
owned AS (SELECT r.rid, r.t, c.event_id,
                 row_number() OVER (PARTITION BY r.rid ORDER BY c.t DESC, c.event_id DESC) AS back
          FROM results r JOIN calls c ON r.user_id = c.user_id AND r.mid = c.mid AND c.t <= r.t),
best AS (SELECT event_id, rid, row_number() OVER (PARTITION BY event_id ORDER BY t, rid) AS rn FROM owned WHERE back = 1)
SELECT CAST(2 * c.event_id AS VARCHAR) AS SOURCE_ID, CAST(b.rid AS INTEGER) AS TRANSACTION_ID
FROM calls c JOIN customer ON c_custkey = c.user_id JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN best b ON b.event_id = c.event_id AND b.rn = 1"""
    o["pair_reused_ids_batch"] = o["pair_reused_ids"]
    # after each load the answers of the frames seen by then; a request is emitted by its own load and when its answer changes
    o["pair_reused_ids_tables"] = """
WITH calls AS (SELECT event_id, user_id, event_id % 3 AS mid, date_trunc('millisecond', ts) AS t, event_id % 3 AS load FROM events),
results AS (SELECT event_id AS rid, user_id, event_id % 3 AS mid, (event_id * 7 + 1) % 3 AS load,
                   date_trunc('millisecond', ts) + to_hours(CAST(event_id % 7 * 10 AS BIGINT)) + INTERVAL 1 SECOND AS t
            FROM events WHERE event_id % 5 <> 0),
step AS (SELECT * FROM (VALUES (1, 2, 2, 2), (2, 2, 0, 0), (3, 2, 0, 1)) AS s(step, a, b, c)),
owned AS (SELECT s.step, r.rid, r.t, c.event_id,
                 row_number() OVER (PARTITION BY s.step, r.rid ORDER BY c.t DESC, c.event_id DESC) AS back
          FROM step s JOIN results r ON r.load IN (s.a, s.b, s.c) JOIN calls c ON c.load IN (s.a, s.b, s.c) AND r.user_id = c.user_id AND r.mid = c.mid AND c.t <= r.t),
best AS (SELECT step, event_id, rid, row_number() OVER (PARTITION BY step, event_id ORDER BY t, rid) AS rn FROM owned WHERE back = 1),
told AS (SELECT c.event_id, s.step, c.load = s.c AS own, b.rid FROM calls c JOIN step s ON c.load IN (s.a, s.b, s.c) LEFT JOIN best b ON b.step = s.step AND b.event_id = c.event_id AND b.rn = 1),
marked AS (SELECT *, lag(rid) OVER (PARTITION BY event_id ORDER BY step) AS was FROM told)
SELECT CAST(2 * event_id AS VARCHAR) AS SOURCE_ID, CAST(MAX(CASE WHEN step = 3 THEN rid END) AS INTEGER) AS TRANSACTION_ID,
       COUNT(*) FILTER (WHERE own OR rid IS DISTINCT FROM was) AS n_emitted
FROM marked JOIN calls USING (event_id) JOIN customer ON c_custkey = user_id JOIN nation ON c_nationkey = n_nationkey GROUP BY event_id"""
    o["silver_from_stored_frames"] = with_events(f"""
SELECT source_id AS SOURCE_ID, action AS OCPP_ACTION, CAST(eid + 1000000 AS VARCHAR) AS OCPP_MESSAGE_UNIQUE_ID, conn AS SOURCE_CONNECTOR_ID,
       CASE WHEN action = 'StatusNotification' THEN CASE WHEN et = 'error' THEN 'Faulted' ELSE 'Available' END END AS STATUS,
       CASE WHEN action IN ('StartTransaction', 'StopTransaction') THEN tag END AS ID_TAG,
       CASE WHEN action IN ('StartTransaction', 'StopTransaction') AND has_res THEN res_status END AS ID_TAG_STATUS,
       CASE WHEN action = 'StopTransaction' OR (action = 'StartTransaction' AND has_res) THEN txid END AS TRANSACTION_ID,
       {ts_text('unified')} AS UNIFIED_TIMESTAMP FROM sv""")
    o["quarantine_replay"] = with_events("""
SELECT source_id AS SOURCE_ID, action AS OCPP_ACTION,
       CASE WHEN action IN ('StartTransaction', 'StopTransaction') AND has_res THEN res_status END AS ID_TAG_STATUS,
       CASE WHEN action = 'StopTransaction' OR (action = 'StartTransaction' AND has_res) THEN txid END AS TRANSACTION_ID,
       'SN-' || lpad(CAST(uid AS VARCHAR), 6, '0') AS SERIAL_NUMBER,
       CASE WHEN 2 * eid % 20 = 2 THEN 'no id' WHEN 2 * eid % 20 = 4 THEN 'no frame' WHEN 2 * eid % 20 = 6 THEN 'impossible time'
            WHEN 2 * eid % 20 = 8 THEN 'broken row' END AS reason, CAST(0 AS BIGINT) AS left_in_quarantine FROM sv""")
    o["master_reload_per_load"] = with_events(f"""
SELECT source_id AS SOURCE_ID, station AS CHARGE_STATION_ID,
       CASE WHEN uid % 2 = 0 AND (uid % 5 = 0 OR t >= TIMESTAMP '{RELOAD_FROM}') THEN 'new-' ELSE '' END || manufacturer AS MANUFACTURER, country_code AS COUNTRY_CODE
FROM sv""")
    o["master_reload_batch"] = o["master_reload_per_load"]
    o["gold_merge_empty_load"] = with_events("SELECT source_id AS SOURCE_ID, action AS OCPP_ACTION FROM sv")
    o["land_late_rows"] = with_events(f""",
lines AS (SELECT 2 * eid AS id, t AS created FROM ev
          UNION ALL SELECT 2 * eid + 1, t + INTERVAL 1 SECOND FROM ev WHERE has_res)
SELECT id, CASE WHEN id % 6 = 0 THEN 2 ELSE 1 END AS load, CASE WHEN id % 14 <> 0 THEN {ts_text('created')} END AS request_date
FROM lines""")
    o["land_malformed"] = with_events(""",
lines AS (SELECT 2 * eid AS id FROM ev UNION ALL SELECT 2 * eid + 1 FROM ev WHERE has_res)
SELECT CASE WHEN id % 9 = 0 THEN 'x' ELSE '' END || CAST(id AS VARCHAR) AS id, id % 9 <> 0 AS clean FROM lines""")
    o["land_by_default"] = with_events(f""",
lines AS (SELECT 2 * eid AS id, t AS created FROM ev
          UNION ALL SELECT 2 * eid + 1, t + INTERVAL 1 SECOND FROM ev WHERE has_res)
SELECT id, CASE id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS load, CASE WHEN id % 14 <> 0 THEN {ts_text("date_trunc('day', created)")} END AS request_date
FROM lines""")
    o["csv_headers_reordered"] = with_events(f""",
lines AS (SELECT 2 * eid AS id, 'REQ-' || eid AS uuid, t AS created, eid, user_id FROM ev JOIN events ON event_id = eid
          UNION ALL SELECT 2 * eid + 1, 'RES-' || eid, t + INTERVAL 1 SECOND, eid, user_id FROM ev JOIN events ON event_id = eid WHERE has_res)
SELECT how, id, uuid AS request_uuid, {ts_text('created')} AS request_date,
       CASE WHEN id % 4 <> 3 OR id % 5 <> 0 THEN user_id END AS entity_id, CASE WHEN id % 4 <> 2 THEN user_id % 3 + 1 END AS service_provider_id,
       CAST(eid + 1000000 AS VARCHAR) AS mid, CASE WHEN id % 4 <> 2 THEN 'SN-' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS serial_number,
       'CS-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS identity_key,
       CASE WHEN id % 4 = 3 THEN 'fw-' || id END AS firmware, CASE WHEN id % 4 = 3 AND id % 5 = 0 THEN 'n/a' END AS entity_text
FROM lines, (VALUES ('batch'), ('stream')) AS h(how)""")
    o["parse_multi_frame"] = """
WITH e AS (SELECT event_id AS eid FROM events JOIN customer ON c_custkey = user_id JOIN nation ON c_nationkey = n_nationkey)
SELECT CAST(eid AS VARCHAR) || '#1' AS SOURCE_ID, 'Heartbeat' AS OCPP_ACTION, 'H' || CAST(eid AS VARCHAR) AS OCPP_MESSAGE_UNIQUE_ID,
       CAST(NULL AS VARCHAR) AS STATUS FROM e
UNION ALL SELECT CAST(eid AS VARCHAR), 'StatusNotification', 'S' || CAST(eid AS VARCHAR), 'Available' FROM e WHERE eid % 2 = 1"""
    o["parse_multi_frame_plain"] = o["parse_multi_frame"]
    o["master_reload"] = """
SELECT 'CS-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS OCPP_CHARGE_STATION_ID,
       CASE WHEN c_custkey % 2 = 0 THEN 'new-2' ELSE c_mktsegment END AS MANUFACTURER,
       'M' || CAST(c_custkey % 7 AS VARCHAR) AS MODEL, n_name AS COUNTRY_CODE
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
    o["meter_readings"] = with_events("""
SELECT source_id AS SOURCE_ID, station AS CHARGE_STATION_ID, txid AS TRANSACTION_ID, 0 AS reading_no, 0 AS sample_no,
       CAST(100 * (k + eid % 7) AS DOUBLE) AS value
FROM sv WHERE action = 'StopTransaction'""")
    o["energy_from_readings"] = with_events("""
SELECT station AS CHARGE_STATION_ID, CAST(unified AS DATE) AS date, COUNT(DISTINCT source_id) AS transactions, COUNT(*) AS readings,
       MAX(CAST(100 * (k + eid % 7) AS DOUBLE)) AS highest_reading, SUM(CAST(100 * (k + eid % 7) AS DOUBLE)) AS total_reading
FROM sv WHERE action = 'StopTransaction' GROUP BY 1, 2""")
    o["heartbeats_with_down"] = with_events("""
SELECT station AS CHARGE_STATION_ID, CAST(unified AS DATE) AS date, COUNT(*) AS heartbeat_count,
       MAX(CASE WHEN 2 * eid % 3 = 0 THEN 1 ELSE 0 END) AS was_down
FROM sv WHERE action = 'Heartbeat' GROUP BY 1, 2""")
    o["views_by_name"] = with_events("""
SELECT station AS CHARGE_STATION_ID, CAST(unified AS DATE) AS date, COUNT(*) AS heartbeat_count, MAX(0) AS was_down
FROM sv WHERE action = 'Heartbeat' GROUP BY 1, 2""")
    plain = f"""
SELECT 'charger_heartbeats' AS view, station || '|' || CAST(unified AS DATE) AS key, CAST(COUNT(*) AS DOUBLE) AS v1, CAST(MAX(0) AS DOUBLE) AS v2
FROM sv WHERE action = 'Heartbeat' GROUP BY station, CAST(unified AS DATE)
UNION ALL SELECT 'charging_session_errors', manufacturer || '|' || err || '|' || vend, COUNT(*), NULL
FROM sv WHERE action = 'StatusNotification' AND (err = 'Error' OR vend <> '0') GROUP BY manufacturer, err, vend
UNION ALL SELECT 'charging_session_duration', txid || '|' || station || '|' || {ts_text('MIN(unified)')} || '|' || {ts_text('MAX(unified)')}, NULL, NULL
FROM sv WHERE action = 'StopTransaction' OR (action = 'StartTransaction' AND has_res) GROUP BY txid, station
UNION ALL SELECT 'energy_consumption_by_charger', station, 43099.0 * COUNT(*), NULL FROM sv GROUP BY station
UNION ALL SELECT 'daily_energy_consumption', station || '|' || CAST(unified AS DATE), 43099.0 * COUNT(*), NULL FROM sv GROUP BY station, CAST(unified AS DATE)"""
    o["views_incremental"] = with_events(plain)
    o["six_views_by_name"] = with_events(f""",
starts AS (SELECT tag, station, CAST(100 * k AS DOUBLE) AS meter_start, unified AS start_time, source_id FROM sv WHERE action = 'StartTransaction'),
stops AS (SELECT eid, tag, station, CAST(100 * (k + eid % 7) AS DOUBLE) AS meter_stop, unified AS stop_time FROM sv WHERE action = 'StopTransaction'),
units AS (SELECT p.*, s.*, row_number() OVER (PARTITION BY p.eid ORDER BY s.start_time DESC, s.source_id DESC) AS back
          FROM stops p JOIN starts s ON p.tag = s.tag AND p.station = s.station AND s.start_time <= p.stop_time)
{plain}
UNION ALL SELECT 'ev_transaction_units', tag || '|' || station || '|' || {ts_text('stop_time')} || '|' || {ts_text('start_time')}, meter_start, meter_stop - meter_start
FROM units WHERE back = 1""")
    registers = """
WITH e AS (SELECT event_id AS eid, CAST(2 * event_id AS VARCHAR) AS source_id, 'CS-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS station
           FROM events JOIN customer ON c_custkey = user_id JOIN nation ON c_nationkey = n_nationkey),
r AS (SELECT *, range AS r FROM e, range(4)),
v AS (SELECT *, CASE WHEN eid % 4 = 0 AND r >= 2 THEN 30 + eid % 7 * 100 * (r - 2) ELSE eid % 50 * 1000 + eid % 7 * 100 * r END AS wh FROM r),
s AS (SELECT eid, source_id, station, r, 'Energy.Active.Import.Register' AS measurand, 'Wh' AS unit, 'Sample.Periodic' AS context, wh / 1000.0 AS kwh FROM v
      UNION ALL SELECT eid, source_id, station, r, 'Energy.Active.Export.Register', 'kWh', NULL, 2.0 * r FROM v
      UNION ALL SELECT eid, source_id, station, r, 'Energy.Active.Import.Register', 'Wh', NULL, eid % 9 * r / 1000.0 FROM v),
g AS (SELECT *, lag(kwh) OVER (PARTITION BY eid, measurand, unit, context ORDER BY r) AS was FROM s),
t AS (SELECT source_id AS SOURCE_ID, station AS CHARGE_STATION_ID, CAST(eid AS INTEGER) AS TRANSACTION_ID, measurand, unit, context,
             CAST(round(arg_min(kwh, r), 6) AS DOUBLE) AS first_kwh, CAST(round(arg_max(kwh, r), 6) AS DOUBLE) AS last_kwh,
             CAST(round(SUM(CASE WHEN was IS NULL THEN 0 WHEN kwh < was THEN kwh ELSE kwh - was END), 6) AS DOUBLE) AS energy_kwh,
             CAST(COUNT(*) AS INTEGER) AS n_readings, CAST(COUNT(*) FILTER (WHERE kwh < was) AS INTEGER) AS n_resets
      FROM g GROUP BY eid, source_id, station, measurand, unit, context)"""
    o["energy_by_register"] = registers + "\nSELECT * FROM t"
    o["energy_by_transaction"] = registers + """
SELECT CHARGE_STATION_ID, TRANSACTION_ID, COUNT(DISTINCT SOURCE_ID) AS stops,
       CAST(round(SUM(energy_kwh) FILTER (WHERE measurand LIKE '%Import%'), 6) AS DOUBLE) AS imported_kwh,
       CAST(round(SUM(energy_kwh) FILTER (WHERE measurand LIKE '%Export%'), 6) AS DOUBLE) AS exported_kwh, CAST(SUM(n_resets) AS BIGINT) AS n_resets
FROM t GROUP BY 1, 2"""
    o["heartbeat_body_time"] = f"""
SELECT CAST(2 * event_id AS VARCHAR) AS SOURCE_ID, {ts_text("date_trunc('millisecond', ts) + to_minutes(CASE WHEN event_id % 3 = 0 THEN 5 ELSE 3 END)")} AS PAYLOAD_TIMESTAMP,
       'payload' AS UNIFIED_TIMESTAMP_SOURCE
FROM events JOIN customer ON c_custkey = user_id JOIN nation ON c_nationkey = n_nationkey"""
    o["tables_from_ddl"] = with_events("""
SELECT 'bronze' AS name, (SELECT COUNT(*) FROM ev) + (SELECT COUNT(*) FROM ev WHERE has_res) AS n, CAST(11 AS BIGINT) AS n_columns
UNION ALL SELECT 'master', (SELECT 2 * COUNT(*) FROM st), CAST(22 AS BIGINT)""")
    return o
