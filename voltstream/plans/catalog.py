"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver's tables in ``sf_dir`` (OCPP lines are rendered
from ``events``, station master rows from ``customer`` ⋈ ``nation``) and runs
over the whole tables. The oracle recomputes each expected value from the
same tables with plain SQL and never parses the rendered log text, so a
parser bug cannot cancel out. Outputs use portable types: BIGINT / INT /
DOUBLE / STRING / DATE, timestamps as ``yyyy-MM-dd HH:mm:ss.SSS`` text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream import schemas
from voltstream.operators import silver as silver_ops
from voltstream.operators.bronze import PARTITIONS
from voltstream.plans import catalog_loads, fixtures, medallion, views
from voltstream.session import ensure_utc

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"
DUCK_TS = "%Y-%m-%d %H:%M:%S.%g"

QueryFn = Callable[[SparkSession, str], DataFrame]


def _ts(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, TS_TEXT)


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return medallion.gold_from_tables(spark, sf_dir, stamp=medallion.fixed_stamp())


def _silver(spark: SparkSession, sf_dir: str, mode: str = "fixed") -> DataFrame:
    ensure_utc(spark)
    return medallion.silver_from_tables(spark, sf_dir, mode=mode, stage_time=medallion.fixed_stamp())


# ---------------------------------------------------------------------------
# views (VW1-VW6)
# ---------------------------------------------------------------------------


def q_charger_heartbeats(spark, sf_dir):
    return views.charger_heartbeats(_gold(spark, sf_dir))


def q_charging_session_errors(spark, sf_dir):
    return views.charging_session_errors(_gold(spark, sf_dir))


def q_ev_transaction_units(spark, sf_dir):
    v = views.ev_transaction_units(_gold(spark, sf_dir))
    return v.select(
        "ID_TAG", "CHARGE_STATION_ID",
        F.col("METER_START").cast("double").alias("METER_START"),
        F.col("METER_STOP").cast("double").alias("METER_STOP"),
        F.col("units_consumed").cast("double").alias("units_consumed"),
        _ts("start_time").alias("start_time"), _ts("stop_time").alias("stop_time"),
    )


def q_ev_transaction_units_totals(spark, sf_dir):
    return views.ev_transaction_units_totals(_gold(spark, sf_dir))


def q_charging_session_duration(spark, sf_dir):
    v = views.charging_session_duration(_gold(spark, sf_dir))
    return v.select(
        "TRANSACTION_ID", "CHARGE_STATION_ID",
        _ts("session_start").alias("session_start"), _ts("session_end").alias("session_end"),
        (F.unix_millis("session_end") - F.unix_millis("session_start"))
        .cast("bigint").alias("session_duration_ms"),
    )


def q_energy_consumption_by_charger(spark, sf_dir):
    return views.energy_consumption_by_charger(_gold(spark, sf_dir))


def q_daily_energy_consumption(spark, sf_dir):
    return views.daily_energy_consumption(_gold(spark, sf_dir))


# ---------------------------------------------------------------------------
# silver steps
# ---------------------------------------------------------------------------


def q_parse_frame(spark, sf_dir):
    ensure_utc(spark)
    parsed = silver_ops.parse_frames(fixtures.bronze_from_events(spark, sf_dir))
    return parsed.select(
        F.col("id").alias("SOURCE_ID"),
        F.col("_frame_type").alias("frame_type"),
        "OCPP_MESSAGE_UNIQUE_ID", "OCPP_ACTION", "SOURCE_CONNECTOR_ID",
        _ts("SOURCE_MESSAGE_TIMESTAMP_CREATED").alias("created"),
        F.col("OCPP_REQUEST_MESSAGE").isNotNull().alias("is_request"),
        F.col("OCPP_RESPONSE_MESSAGE").isNotNull().alias("is_response"),
    )


def _payload_cols() -> list[Column]:
    return [
        _ts("PAYLOAD_TIMESTAMP").alias("PAYLOAD_TIMESTAMP"),
        _ts("UNIFIED_TIMESTAMP").alias("UNIFIED_TIMESTAMP"),
        "UNIFIED_TIMESTAMP_SOURCE",
    ]


def q_parse_start(spark, sf_dir):
    s = silver_ops.by_action(_silver(spark, sf_dir), silver_ops.START)
    return s.select(
        "SOURCE_ID", "ID_TAG", F.col("METER_START").cast("double").alias("METER_START"), "SOURCE_CONNECTOR_ID",
        *_payload_cols(),
    )


def q_parse_stop(spark, sf_dir):
    s = silver_ops.by_action(_silver(spark, sf_dir), silver_ops.STOP)
    return s.select(
        "SOURCE_ID", "ID_TAG", F.col("METER_STOP").cast("double").alias("METER_STOP"), "TRANSACTION_ID",
        "STOP_REASON", *_payload_cols(),
    )


def q_parse_status(spark, sf_dir):
    s = silver_ops.by_action(_silver(spark, sf_dir), silver_ops.STATUS)
    return s.select(
        "SOURCE_ID", "OCPP_ERROR_CODE", "VENDOR_ERROR_CODE", "STATUS", "STATUS_INFO", "SOURCE_CONNECTOR_ID",
        *_payload_cols(),
    )


def q_parse_heartbeat(spark, sf_dir):
    s = silver_ops.by_action(_silver(spark, sf_dir), silver_ops.HEARTBEAT)
    return s.select("SOURCE_ID", "OCPP_MESSAGE_UNIQUE_ID", *_payload_cols())


def q_pair_responses(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return s.select(
        "SOURCE_ID", "OCPP_ACTION",
        F.col("OCPP_RESPONSE_MESSAGE").isNotNull().alias("has_response"),
        "ID_TAG_STATUS",
        F.when(F.col("OCPP_ACTION") == silver_ops.START, F.col("TRANSACTION_ID")).alias("START_TRANSACTION_ID"),
    )


def q_align_union(spark, sf_dir):
    s = _silver(spark, sf_dir)
    n = lambda c: F.count(F.col(c)).alias(f"n_{c.lower()}")
    return s.groupBy("OCPP_ACTION").agg(
        F.count(F.lit(1)).alias("n_rows"),
        n("PAYLOAD_TIMESTAMP"), n("ID_TAG"), n("ID_TAG_STATUS"), n("TRANSACTION_ID"), n("STOP_REASON"),
        n("METER_START"), n("METER_STOP"), n("OCPP_ERROR_CODE"), n("VENDOR_ERROR_CODE"), n("STATUS"),
        n("STATUS_INFO"), n("OCPP_REQUEST_MESSAGE"), n("OCPP_RESPONSE_MESSAGE"),
    )


def q_enrich_with_master(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return s.select("SOURCE_ID", "CHARGE_STATION_ID", "MANUFACTURER", "MODEL", "COUNTRY_CODE")


def _portable(df):
    """Timestamps as text, floats as doubles."""
    kinds = {"timestamp": lambda c: _ts(c).alias(c), "float": lambda c: F.col(c).cast("double").alias(c)}
    return df.select(*[kinds.get(f.dataType.simpleString(), F.col)(f.name) for f in df.schema.fields])


def q_silver_conform(spark, sf_dir):
    return _portable(_silver(spark, sf_dir))


def q_vendor_errors(spark, sf_dir):
    return silver_ops.vendor_errors(_silver(spark, sf_dir)).select("SOURCE_ID", "CHARGE_STATION_ID", "VENDOR_ERROR_CODE")


# ---------------------------------------------------------------------------
# upserts
# ---------------------------------------------------------------------------

GOLD_SPLIT_TARGET_BEFORE = "2024-01-20"
GOLD_SPLIT_SOURCE_FROM = "2024-01-10"


def q_gold_upsert(spark, sf_dir):
    """First load (gateway time before 20 Jan), then MERGE of the rows from 10 Jan on."""
    s1 = medallion.stored(_silver(spark, sf_dir), "silver")
    created = F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED")
    first = medallion.first_gold(s1.filter(created < F.lit(GOLD_SPLIT_TARGET_BEFORE).cast("timestamp")),
                                 stamp=medallion.fixed_stamp())
    inc_stamp = F.lit("2024-02-02 00:00:00").cast("timestamp")
    inc = s1.filter(created >= F.lit(GOLD_SPLIT_SOURCE_FROM).cast("timestamp")).withColumn("STAGE_LOAD_TIMESTAMP", inc_stamp)
    g = medallion.merge_into_gold(first, inc, stamp=inc_stamp)
    return g.select("SOURCE_ID", "OCPP_ACTION", _ts("STAGE_LOAD_TIMESTAMP").alias("STAGE_LOAD_TIMESTAMP"),
                    _ts("STAGE_PROCESSED_TIMESTAMP").alias("STAGE_PROCESSED_TIMESTAMP"))


ORDERS_TARGET_BEFORE = "1998-01-01"
ORDERS_SOURCE_FROM = "1997-01-01"


def q_upsert_orders(spark, sf_dir):
    """Generic keyed upsert on ``orders``: older orders are the target, newer ones re-priced."""
    from voltstream.operators.merge import upsert

    ensure_utc(spark)
    o = fixtures.table(spark, sf_dir, "orders")
    target = o.filter(F.col("o_orderdate") < F.lit(ORDERS_TARGET_BEFORE).cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.lit(None).cast("string").alias("updated_at"))
    source = o.filter(F.col("o_orderdate") >= F.lit(ORDERS_SOURCE_FROM).cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", F.col("o_custkey").cast("double").alias("o_totalprice"), "o_orderstatus")
    return upsert(target, source, ["o_orderkey"], stamp_column="updated_at", stamp=F.lit("2024-02-02 00:00:00"))


# ---------------------------------------------------------------------------
# landing, streaming, CSV and tables (write to a fresh folder under the
# shared ``spark.checkpoint.dir``; every run takes a new folder)
# ---------------------------------------------------------------------------

LOAD_SPLIT = "2024-01-16"


def _ocpp_lines(spark, sf_dir):
    ensure_utc(spark)
    return fixtures.ocpp_from_events(fixtures.table(spark, sf_dir, "events"))


def q_since_mark(spark, sf_dir):
    """Two landing runs: the source as of 16 Jan (empty mark → full load), then the whole source."""
    from voltstream.operators.incremental import land_increment
    from voltstream.session import run_dir
    from voltstream.sources.csv import read_ocpp_csv

    lines = _ocpp_lines(spark, sf_dir)
    base = run_dir(spark, "landing")
    landing, marks = f"{base}/landing", f"{base}/_marks"
    early = lines.filter(F.col("request_date") < F.lit(LOAD_SPLIT).cast("timestamp"))
    land_increment(spark, early, landing, marks, load_id="1")
    land_increment(spark, lines, landing, marks, load_id="2")
    landed = read_ocpp_csv(spark, f"{landing}/load=*/dt=*/")
    path = F.col("_metadata.file_path")
    return landed.select(
        "id",
        F.regexp_extract(path, r"/load=([^/]+)/", 1).cast("int").alias("load"),
        F.regexp_extract(path, r"/dt=([^/]+)/", 1).alias("dt"),
        _ts("request_date").alias("request_date"),
    )


def q_stream_csv_bronze(spark, sf_dir):
    """Land two loads as CSV, stream each into bronze parquet (availableNow), read back."""
    from voltstream.operators.incremental import land_increment
    from voltstream.session import run_dir
    from voltstream.streaming.ingest import append_stream, stream_ocpp_csv

    lines = _ocpp_lines(spark, sf_dir)
    base = run_dir(spark, "bronze-stream")
    landing, marks = f"{base}/landing", f"{base}/_marks"
    bronze_path, ckpt = f"{base}/bronze", f"{base}/_checkpoints/bronze"
    early = lines.filter(F.col("request_date") < F.lit(LOAD_SPLIT).cast("timestamp"))
    land_increment(spark, early, landing, marks, load_id="1")
    append_stream(stream_ocpp_csv(spark, f"{landing}/load=*/dt=*/"), bronze_path, ckpt, partition_by=PARTITIONS)
    land_increment(spark, lines, landing, marks, load_id="2")
    append_stream(stream_ocpp_csv(spark, f"{landing}/load=*/dt=*/"), bronze_path, ckpt, partition_by=PARTITIONS)
    b = spark.read.parquet(bronze_path)
    parsed = silver_ops.parse_frames(b)
    return parsed.select(
        "id", "request_uuid", _ts("request_date").alias("request_date"), "entity_id", "service_provider_id",
        "serial_number", "identity_key",
        F.col("_frame_type").alias("frame_type"), "OCPP_MESSAGE_UNIQUE_ID", "OCPP_ACTION",
        F.col("load").cast("int").alias("load"),
        F.col("_rescued_data").isNull().alias("clean"),
    )


def q_stream_master_csv(spark, sf_dir):
    """Master snapshot as CSV in the landing zone, streamed into the master table."""
    from voltstream.session import run_dir
    from voltstream.sources.csv import write_snapshot_csv
    from voltstream.streaming.ingest import append_stream, stream_master_csv

    ensure_utc(spark)
    base = run_dir(spark, "master-stream")
    write_snapshot_csv(fixtures.master_from_tables(spark, sf_dir), f"{base}/landing/master_data")
    append_stream(stream_master_csv(spark, f"{base}/landing/master_data"), f"{base}/master", f"{base}/_checkpoints/master")
    return spark.read.parquet(f"{base}/master").select(*[c for c in schemas.MASTER_COLUMNS if c != "_rescued_data"])


def q_csv_multiline(spark, sf_dir):
    """Whole documents (newlines, quotes) through the quoted multi-line CSV writer and reader."""
    from voltstream.session import run_dir
    from voltstream.sources.csv import read_text_csv, write_csv

    base = run_dir(spark, "csv-docs")
    write_csv(fixtures.table(spark, sf_dir, "documents").select("doc_id", "text"), base)
    return read_text_csv(spark, base, "doc_id BIGINT, text STRING")


def q_table_roundtrip(spark, sf_dir):
    """Create a silver table from DDL, append two loads, read it back by name."""
    from voltstream.session import run_dir
    from voltstream.sources.tables import append_table, ensure_table, read_table

    s = medallion.stored(_silver(spark, sf_dir), "silver")
    path = run_dir(spark, "silver-table")
    name = "silver_" + path.rsplit("-", 1)[-1]
    ensure_table(spark, name, schemas.SILVER_DDL, path)
    created = F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED")
    split = F.lit(LOAD_SPLIT).cast("timestamp")
    append_table(s.filter(created < split), path)
    append_table(s.filter(created >= split), path)
    spark.catalog.refreshTable(name)
    t = read_table(spark, name)
    return t.select("SOURCE_ID", "OCPP_ACTION", _ts("UNIFIED_TIMESTAMP").alias("UNIFIED_TIMESTAMP"))


def q_gold_snapshots(spark, sf_dir):
    """Gold kept as two snapshot folders: the first load, then the MERGE of the newer rows into a new folder."""
    from voltstream.session import run_dir

    s1 = medallion.stored(_silver(spark, sf_dir), "silver")
    base = run_dir(spark, "gold")
    created = F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED")
    first = medallion.first_gold(s1.filter(created < F.lit(GOLD_SPLIT_TARGET_BEFORE).cast("timestamp")),
                                 stamp=medallion.fixed_stamp())
    first.write.parquet(f"{base}/1")
    inc_stamp = F.lit("2024-02-02 00:00:00").cast("timestamp")
    inc = s1.filter(created >= F.lit(GOLD_SPLIT_SOURCE_FROM).cast("timestamp")).withColumn("STAGE_LOAD_TIMESTAMP", inc_stamp)
    medallion.merge_into_gold(spark.read.parquet(f"{base}/1"), inc, stamp=inc_stamp).write.parquet(f"{base}/2")
    g = spark.read.parquet(f"{base}/2")
    return g.select("SOURCE_ID", "OCPP_ACTION", _ts("STAGE_LOAD_TIMESTAMP").alias("STAGE_LOAD_TIMESTAMP"),
                    _ts("STAGE_PROCESSED_TIMESTAMP").alias("STAGE_PROCESSED_TIMESTAMP"))


def q_gold_partitioned_upsert(spark, sf_dir):
    """Gold partitioned by day: first load, then MERGE rewriting only the touched days."""
    from voltstream.session import run_dir

    s1 = medallion.stored(_silver(spark, sf_dir), "silver")
    base = run_dir(spark, "gold-parts")
    created = F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED")
    medallion.merge_into_gold_table(f"{base}/gold", s1.filter(created < F.lit(GOLD_SPLIT_TARGET_BEFORE).cast("timestamp")),
                                    f"{base}/_stage1", stamp=medallion.fixed_stamp())
    inc_stamp = F.lit("2024-02-02 00:00:00").cast("timestamp")
    inc = s1.filter(created >= F.lit(GOLD_SPLIT_SOURCE_FROM).cast("timestamp")).withColumn("STAGE_LOAD_TIMESTAMP", inc_stamp)
    medallion.merge_into_gold_table(f"{base}/gold", inc, f"{base}/_stage2", stamp=inc_stamp)
    g = spark.read.parquet(f"{base}/gold")
    return g.select("SOURCE_ID", "OCPP_ACTION", _ts("STAGE_LOAD_TIMESTAMP").alias("STAGE_LOAD_TIMESTAMP"),
                    _ts("STAGE_PROCESSED_TIMESTAMP").alias("STAGE_PROCESSED_TIMESTAMP"))


# ---------------------------------------------------------------------------
# faithful mode: the original results, defects included
# ---------------------------------------------------------------------------


def q_silver_faithful(spark, sf_dir):
    """Per-action profile of faithful silver: unpaired Start/Stop results, text-read Heartbeat times, D19 effects."""
    s = _silver(spark, sf_dir, mode="faithful")
    c = lambda cond, name: F.count(F.when(cond, 1)).alias(name)
    return s.groupBy("OCPP_ACTION").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("SOURCE_ID").alias("n_sources"),
        F.count("UNIFIED_TIMESTAMP").alias("n_unified"),
        c(F.col("UNIFIED_TIMESTAMP_SOURCE") == "payload", "n_payload_source"),
        F.count("ID_TAG_STATUS").alias("n_id_tag_status"),
        F.count("TRANSACTION_ID").alias("n_transaction_id"),
        F.count("OCPP_ERROR_CODE").alias("n_error_code"),
        F.count("OCPP_REQUEST_MESSAGE").alias("n_request_message"),
        F.count("OCPP_RESPONSE_MESSAGE").alias("n_response_message"),
    )


def q_charger_heartbeats_faithful(spark, sf_dir):
    ensure_utc(spark)
    return views.charger_heartbeats(medallion.gold_from_tables(spark, sf_dir, mode="faithful", stamp=medallion.fixed_stamp()))


def q_stream_gold(spark, sf_dir):
    """Two landing runs streamed into bronze and day-partitioned gold (foreachBatch MERGE); what silver_conform checks."""
    from voltstream.operators.incremental import land_increment
    from voltstream.session import run_dir
    from voltstream.streaming.gold_stream import run_gold_stream

    lines = _ocpp_lines(spark, sf_dir)
    master = fixtures.master_from_tables(spark, sf_dir)
    base = run_dir(spark, "gold-stream")
    landing, marks = f"{base}/landing", f"{base}/_marks"
    early = lines.filter(F.col("request_date") < F.lit(LOAD_SPLIT).cast("timestamp"))
    for load, rows in (("1", early), ("2", lines)):
        land_increment(spark, rows, landing, marks, load_id=load)
        run_gold_stream(spark, f"{landing}/load=*/dt=*/", master, f"{base}/bronze", f"{base}/gold", f"{base}/_ckpt", f"{base}/_stage",
                        stamp=medallion.fixed_stamp())
    return _portable(spark.read.parquet(f"{base}/gold").select(*[c for c in schemas.SILVER_COLUMNS if c != "INGEST_LOAD_TIMESTAMP"]))


def q_heartbeats_end_to_end(spark, sf_dir):
    """The deployed path end to end: two landings → partitioned bronze stream → silver →
    day-partitioned gold (first load, then a MERGE of the second landing) → heartbeat view."""
    from voltstream.operators.incremental import land_increment
    from voltstream.session import run_dir
    from voltstream.sources.csv import write_snapshot_csv
    from voltstream.streaming.ingest import append_stream, stream_master_csv, stream_ocpp_csv

    lines = _ocpp_lines(spark, sf_dir)
    base = run_dir(spark, "end-to-end")
    landing, marks, stamp = f"{base}/landing", f"{base}/_marks", medallion.fixed_stamp()
    write_snapshot_csv(fixtures.master_from_tables(spark, sf_dir), f"{landing}/master_data")
    append_stream(stream_master_csv(spark, f"{landing}/master_data"), f"{base}/master", f"{base}/_ckpt/master")
    master = spark.read.parquet(f"{base}/master")
    early = lines.filter(F.col("request_date") < F.lit(LOAD_SPLIT).cast("timestamp"))
    for load, src in (("1", early), ("2", lines)):
        land_increment(spark, src, landing, marks, load_id=load)
        append_stream(stream_ocpp_csv(spark, f"{landing}/load=*/dt=*/"), f"{base}/bronze", f"{base}/_ckpt/bronze",
                      partition_by=PARTITIONS)
        bronze = spark.read.parquet(f"{base}/bronze")
        inc = medallion.silver_increment(bronze.withColumn("load", F.col("load").cast("string")), load, master, stage_time=stamp)
        medallion.merge_into_gold_table(f"{base}/gold", inc, f"{base}/_stage{load}", stamp=stamp)
    return views.charger_heartbeats(spark.read.parquet(f"{base}/gold"))


def q_charging_session_duration_faithful(spark, sf_dir):
    """VW4 on faithful gold: Start rows carry no transaction id (D4), so sessions hold stops only."""
    ensure_utc(spark)
    g = medallion.gold_from_tables(spark, sf_dir, mode="faithful", stamp=medallion.fixed_stamp())
    v = views.charging_session_duration(g)
    return v.select(
        "TRANSACTION_ID", "CHARGE_STATION_ID",
        _ts("session_start").alias("session_start"), _ts("session_end").alias("session_end"),
        (F.unix_millis("session_end") - F.unix_millis("session_start")).cast("bigint").alias("session_duration_ms"),
    )


def queries() -> dict[str, QueryFn]:
    return {
        "charger_heartbeats": q_charger_heartbeats,
        "charging_session_errors": q_charging_session_errors,
        "ev_transaction_units": q_ev_transaction_units,
        "ev_transaction_units_totals": q_ev_transaction_units_totals,
        "charging_session_duration": q_charging_session_duration,
        "energy_consumption_by_charger": q_energy_consumption_by_charger,
        "daily_energy_consumption": q_daily_energy_consumption,
        "parse_frame": q_parse_frame,
        "parse_start": q_parse_start,
        "parse_stop": q_parse_stop,
        "parse_status": q_parse_status,
        "parse_heartbeat": q_parse_heartbeat,
        "pair_responses": q_pair_responses,
        "align_union": q_align_union,
        "enrich_with_master": q_enrich_with_master,
        "silver_conform": q_silver_conform,
        "vendor_errors": q_vendor_errors,
        "gold_upsert": q_gold_upsert,
        "upsert_orders": q_upsert_orders,
        "since_mark": q_since_mark,
        "stream_csv_bronze": q_stream_csv_bronze,
        "stream_master_csv": q_stream_master_csv,
        "csv_multiline": q_csv_multiline,
        "table_roundtrip": q_table_roundtrip,
        "gold_snapshots": q_gold_snapshots,
        "gold_partitioned_upsert": q_gold_partitioned_upsert,
        "silver_faithful": q_silver_faithful,
        "charger_heartbeats_faithful": q_charger_heartbeats_faithful,
        "stream_gold": q_stream_gold,
        "heartbeats_end_to_end": q_heartbeats_end_to_end,
        "charging_session_duration_faithful": q_charging_session_duration_faithful,
        **catalog_loads.QUERIES,
    }


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------

# expected per-event fields, straight from events (no text parsing)
_EV = """
ev AS (
  SELECT event_id AS eid, user_id AS uid, event_type AS et,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         date_trunc('millisecond', ts) AS t,
         'CS-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS station,
         CAST(event_id + 1000000 AS VARCHAR) AS mid,
         CASE event_type WHEN 'view' THEN 'Heartbeat' WHEN 'purchase' THEN 'StartTransaction'
                         WHEN 'signup' THEN 'StopTransaction' ELSE 'StatusNotification' END AS action,
         event_id % 5 <> 0 AS has_res,
         (event_id % 10 <> 0 AND event_id % 97 <> 0) AS body_time_ok
  FROM events WHERE event_type IN ('view', 'purchase', 'signup', 'click', 'error')
),
st AS (
  SELECT 'CS-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS station, c_mktsegment AS manufacturer,
         'M' || CAST(c_custkey % 7 AS VARCHAR) AS model, n_name AS country_code
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
sv0 AS (
  SELECT ev.*, st.manufacturer, st.model, st.country_code,
         CASE WHEN action = 'Heartbeat' THEN has_res AND eid % 97 <> 0 ELSE body_time_ok END AS has_payload
  FROM ev JOIN st USING (station)
),
sv AS (
  SELECT *,
         CASE WHEN has_payload THEN t + INTERVAL 1 SECOND END AS payload_ts,
         CASE WHEN has_payload THEN t + INTERVAL 1 SECOND ELSE t END AS unified,
         CASE WHEN has_payload THEN 'payload' ELSE 'created' END AS unified_source,
         CAST(2 * eid AS VARCHAR) AS source_id,
         'T' || CAST(uid % 20 AS VARCHAR) AS tag,
         CAST(100 * uid + k % 10 AS INTEGER) AS txid,
         CASE WHEN action IN ('StartTransaction', 'StatusNotification') THEN CAST(eid % 2 + 1 AS VARCHAR) ELSE '' END AS conn,
         CASE WHEN et = 'click' THEN 'NoError' WHEN k % 2 = 0 THEN 'Error' ELSE 'OtherError' END AS err,
         CASE WHEN et = 'error' THEN CAST(k AS VARCHAR) ELSE '0' END AS vend,
         CASE WHEN k % 4 = 0 THEN 'Blocked' ELSE 'Accepted' END AS res_status
  FROM sv0
)"""


def _with(body: str) -> str:
    return "WITH" + _EV + "\n" + body


def _t(expr: str) -> str:
    return f"strftime({expr}, '{DUCK_TS}')"


_STARTS = """starts AS (SELECT tag, station, CAST(100 * k AS DOUBLE) AS meter_start, unified AS start_time, source_id
            FROM sv WHERE action = 'StartTransaction'),
stops AS (SELECT eid AS stop_eid, tag, station, CAST(100 * (k + eid % 7) AS DOUBLE) AS meter_stop, unified AS stop_time
          FROM sv WHERE action = 'StopTransaction')"""


_STAMP = "'2024-02-01 00:00:00.000'"
# the message texts, put together from the events' fields
_BODY_TIME = """CASE WHEN eid % 10 = 0 THEN NULL WHEN eid % 97 = 0 THEN strftime(t, '%Y-%m-%dT%H') || ':75:00Z'
                    ELSE strftime(t + INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S.%gZ') END"""
_TIME_FIELD = f"COALESCE(',\"timestamp\":\"' || ({_BODY_TIME}) || '\"', '')"
_REQUEST = f"""CASE action WHEN 'Heartbeat' THEN '{{}}'
    WHEN 'StartTransaction' THEN '{{"connectorId":' || CAST(eid % 2 + 1 AS VARCHAR) || ',"idTag":"' || tag || '","meterStart":'
         || CAST(100 * k AS VARCHAR) || {_TIME_FIELD} || '}}'
    WHEN 'StopTransaction' THEN '{{"idTag":"' || tag || '","meterStop":' || CAST(100 * (k + eid % 7) AS VARCHAR) || {_TIME_FIELD}
         || ',"transactionId":' || CAST(txid AS VARCHAR) || ',"reason":"' || CASE WHEN k % 2 = 0 THEN 'Local' ELSE 'Remote' END
         || '","transactionData":[{{"sampledValue":[{{"value":"' || CAST(100 * (k + eid % 7) AS VARCHAR) || '"}}]}}]}}'
    ELSE '{{"connectorId":' || CAST(eid % 2 + 1 AS VARCHAR) || CASE WHEN eid % 11 = 0 THEN ',' || chr(10) ELSE ',' END || '"errorCode":"' || err
         || '","info":"info-' || CAST(k AS VARCHAR) || '","status":"' || CASE WHEN et = 'error' THEN 'Faulted' ELSE 'Available' END || '"'
         || {_TIME_FIELD} || ',"vendorErrorCode":"' || vend || '","vendorId":"V' || CAST(uid % 3 AS VARCHAR) || '"}}' END"""
_RESULT = f"""CASE action WHEN 'Heartbeat' THEN COALESCE('{{"currentTime":"' || ({_BODY_TIME}) || '"}}', '{{}}')
    WHEN 'StartTransaction' THEN '{{"idTagInfo":{{"status":"' || res_status || '"}},"transactionId":' || CAST(txid AS VARCHAR) || '}}'
    WHEN 'StopTransaction' THEN '{{"idTagInfo":{{"status":"' || res_status || '"}}}}' ELSE '{{}}' END"""


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o |= catalog_loads.oracles(_with, _t)
    o["charger_heartbeats"] = _with("""
SELECT station AS CHARGE_STATION_ID, CAST(unified AS DATE) AS date, COUNT(*) AS heartbeat_count, MAX(0) AS was_down
FROM sv WHERE action = 'Heartbeat' GROUP BY 1, 2""")
    o["charging_session_errors"] = _with("""
SELECT manufacturer AS MANUFACTURER, COUNT(*) AS error_count, err AS OCPP_ERROR_CODE, vend AS VENDOR_ERROR_CODE
FROM sv WHERE action = 'StatusNotification' AND (err = 'Error' OR vend <> '0')
GROUP BY manufacturer, err, vend""")
    o["ev_transaction_units"] = _with(f""",
{_STARTS},
cand AS (
  SELECT p.*, s.meter_start, s.start_time,
         row_number() OVER (PARTITION BY p.stop_eid ORDER BY s.start_time DESC, s.source_id DESC) AS rn
  FROM stops p JOIN starts s ON p.tag = s.tag AND p.station = s.station AND s.start_time <= p.stop_time)
SELECT tag AS ID_TAG, station AS CHARGE_STATION_ID, meter_start AS METER_START, meter_stop AS METER_STOP,
       meter_stop - meter_start AS units_consumed, {_t('start_time')} AS start_time, {_t('stop_time')} AS stop_time
FROM cand WHERE rn = 1""")
    o["ev_transaction_units_totals"] = _with(f""",
{_STARTS}
SELECT s.tag AS ID_TAG, s.station AS CHARGE_STATION_ID, COUNT(*) AS pair_count,
       CAST(SUM(p.meter_stop - s.meter_start) AS DOUBLE) AS total_units_consumed
FROM starts s JOIN stops p ON s.tag = p.tag AND s.station = p.station
GROUP BY s.tag, s.station""")
    o["charging_session_duration"] = _with(f"""
SELECT txid AS TRANSACTION_ID, station AS CHARGE_STATION_ID, {_t('MIN(unified)')} AS session_start,
       {_t('MAX(unified)')} AS session_end, date_diff('millisecond', MIN(unified), MAX(unified)) AS session_duration_ms
FROM sv WHERE action = 'StopTransaction' OR (action = 'StartTransaction' AND has_res)
GROUP BY txid, station""")
    o["energy_consumption_by_charger"] = _with("""
SELECT station AS CHARGE_STATION_ID, CAST(43099 * COUNT(*) AS DOUBLE) AS total_energy_consumed
FROM sv GROUP BY station""")
    o["daily_energy_consumption"] = _with("""
SELECT station AS CHARGE_STATION_ID, CAST(unified AS DATE) AS date, CAST(43099 * COUNT(*) AS DOUBLE) AS total_energy_consumed
FROM sv GROUP BY 1, 2""")
    o["parse_frame"] = _with(f"""
SELECT 2 * eid AS SOURCE_ID, '2' AS frame_type, mid AS OCPP_MESSAGE_UNIQUE_ID, action AS OCPP_ACTION,
       CASE WHEN action IN ('StartTransaction', 'StatusNotification') THEN CAST(eid % 2 + 1 AS VARCHAR) ELSE '' END
         AS SOURCE_CONNECTOR_ID,
       {_t('t')} AS created, TRUE AS is_request, FALSE AS is_response
FROM ev
UNION ALL
SELECT 2 * eid + 1, '3', mid, '', '', {_t("t + INTERVAL 1 SECOND")}, FALSE, TRUE
FROM ev WHERE has_res""")
    payload = f"{_t('payload_ts')} AS PAYLOAD_TIMESTAMP, {_t('unified')} AS UNIFIED_TIMESTAMP, unified_source AS UNIFIED_TIMESTAMP_SOURCE"
    o["parse_start"] = _with(f"""
SELECT source_id AS SOURCE_ID, tag AS ID_TAG, CAST(100 * k AS DOUBLE) AS METER_START, conn AS SOURCE_CONNECTOR_ID, {payload}
FROM sv WHERE action = 'StartTransaction'""")
    o["parse_stop"] = _with(f"""
SELECT source_id AS SOURCE_ID, tag AS ID_TAG, CAST(100 * (k + eid % 7) AS DOUBLE) AS METER_STOP, txid AS TRANSACTION_ID,
       CASE WHEN k % 2 = 0 THEN 'Local' ELSE 'Remote' END AS STOP_REASON, {payload}
FROM sv WHERE action = 'StopTransaction'""")
    o["parse_status"] = _with(f"""
SELECT source_id AS SOURCE_ID, err AS OCPP_ERROR_CODE, vend AS VENDOR_ERROR_CODE,
       CASE WHEN et = 'error' THEN 'Faulted' ELSE 'Available' END AS STATUS, 'info-' || CAST(k AS VARCHAR) AS STATUS_INFO,
       conn AS SOURCE_CONNECTOR_ID, {payload}
FROM sv WHERE action = 'StatusNotification'""")
    o["parse_heartbeat"] = _with(f"""
SELECT source_id AS SOURCE_ID, mid AS OCPP_MESSAGE_UNIQUE_ID, {payload}
FROM sv WHERE action = 'Heartbeat'""")
    o["pair_responses"] = _with("""
SELECT source_id AS SOURCE_ID, action AS OCPP_ACTION, has_res AS has_response,
       CASE WHEN has_res AND action IN ('StartTransaction', 'StopTransaction') THEN res_status END AS ID_TAG_STATUS,
       CASE WHEN has_res AND action = 'StartTransaction' THEN txid END AS START_TRANSACTION_ID
FROM sv""")
    o["align_union"] = _with("""
SELECT action AS OCPP_ACTION, COUNT(*) AS n_rows,
       COUNT(payload_ts) AS n_payload_timestamp,
       COUNT(*) FILTER (WHERE action IN ('StartTransaction', 'StopTransaction')) AS n_id_tag,
       COUNT(*) FILTER (WHERE has_res AND action IN ('StartTransaction', 'StopTransaction')) AS n_id_tag_status,
       COUNT(*) FILTER (WHERE action = 'StopTransaction' OR (action = 'StartTransaction' AND has_res)) AS n_transaction_id,
       COUNT(*) FILTER (WHERE action = 'StopTransaction') AS n_stop_reason,
       COUNT(*) FILTER (WHERE action = 'StartTransaction') AS n_meter_start,
       COUNT(*) FILTER (WHERE action = 'StopTransaction') AS n_meter_stop,
       COUNT(*) FILTER (WHERE action = 'StatusNotification') AS n_ocpp_error_code,
       COUNT(*) FILTER (WHERE action = 'StatusNotification') AS n_vendor_error_code,
       COUNT(*) FILTER (WHERE action = 'StatusNotification') AS n_status,
       COUNT(*) FILTER (WHERE action = 'StatusNotification') AS n_status_info,
       COUNT(*) AS n_ocpp_request_message,
       COUNT(*) FILTER (WHERE has_res) AS n_ocpp_response_message
FROM sv GROUP BY action""")
    o["enrich_with_master"] = _with("""
SELECT source_id AS SOURCE_ID, station AS CHARGE_STATION_ID, manufacturer AS MANUFACTURER, model AS MODEL,
       country_code AS COUNTRY_CODE
FROM sv""")
    o["silver_conform"] = _with(f"""
SELECT 'OCPP_DRIIVZ' AS SOURCE, source_id AS SOURCE_ID,
       CAST(uid AS VARCHAR) || '_REQ-' || CAST(eid AS VARCHAR) AS SOURCE_MESSAGE_ID,
       station AS CHARGE_STATION_ID, manufacturer AS MANUFACTURER, model AS MODEL,
       'SN-' || lpad(CAST(uid AS VARCHAR), 6, '0') AS SERIAL_NUMBER, 'csb.21.1.3' AS FIRMWARE_VERSION,
       country_code AS COUNTRY_CODE,
       {_t('t')} AS SOURCE_MESSAGE_TIMESTAMP_CREATED, {_t('t')} AS SOURCE_MESSAGE_TIMESTAMP_UPDATED,
       station || '_' || conn || '_' || action || '_' || CAST(t AS VARCHAR) || '_' || mid AS CORE_MESSAGE_UNIQUE_ID,
       {_t('unified')} AS UNIFIED_TIMESTAMP, unified_source AS UNIFIED_TIMESTAMP_SOURCE,
       mid AS OCPP_MESSAGE_UNIQUE_ID, action AS OCPP_ACTION, conn AS SOURCE_CONNECTOR_ID,
       CASE WHEN action = 'StatusNotification' THEN err END AS OCPP_ERROR_CODE,
       CASE WHEN action = 'StatusNotification' THEN vend END AS VENDOR_ERROR_CODE,
       CASE WHEN action = 'StatusNotification' THEN CASE WHEN et = 'error' THEN 'Faulted' ELSE 'Available' END END AS STATUS,
       {_t('payload_ts')} AS PAYLOAD_TIMESTAMP,
       CASE WHEN action IN ('StartTransaction', 'StopTransaction') THEN tag END AS ID_TAG,
       CASE WHEN has_res AND action IN ('StartTransaction', 'StopTransaction') THEN res_status END AS ID_TAG_STATUS,
       CASE WHEN action = 'StopTransaction' OR (action = 'StartTransaction' AND has_res) THEN txid END AS TRANSACTION_ID,
       CASE WHEN action = 'StopTransaction' THEN CASE WHEN k % 2 = 0 THEN 'Local' ELSE 'Remote' END END AS STOP_REASON,
       CASE WHEN action = 'StartTransaction' THEN CAST(100 * k AS DOUBLE) END AS METER_START,
       CASE WHEN action = 'StopTransaction' THEN CAST(100 * (k + eid % 7) AS DOUBLE) END AS METER_STOP,
       'Operative' AS CHANGE_AVAILABILITY_TYPE, 'Accepted' AS CHANGE_AVAILABILITY_STATUS, 15 AS HEARBEAT_INTERVAL,
       CAST(CAST(81 AS FLOAT) AS DOUBLE) AS METERVALUE_SOC,
       CAST(CAST(200 AS FLOAT) AS DOUBLE) AS METERVALUE_CURRENT_OFFERED,
       CAST(CAST(29.9 AS FLOAT) AS DOUBLE) AS METERVALUE_CURRENT_IMPORT,
       CAST(CAST(11459.2 AS FLOAT) AS DOUBLE) AS METERVALUE_POWER_KW,
       CAST(CAST(43099 AS FLOAT) AS DOUBLE) AS METERVALUE_ENERGY_KWH,
       CAST(CAST(444 AS FLOAT) AS DOUBLE) AS METERVALUE_VOLTAGE,
       CAST(CAST(300.1 AS FLOAT) AS DOUBLE) AS METERVALUE_TEMP,
       CAST(CAST(1410.8 AS FLOAT) AS DOUBLE) AS METERVALUE_RPM,
       '99920200000000' AS SIM_ICCID,
       CASE WHEN action = 'StatusNotification' THEN 'info-' || CAST(k AS VARCHAR) END AS STATUS_INFO,
       {_STAMP} AS INGEST_LOAD_TIMESTAMP, {_STAMP} AS STAGE_LOAD_TIMESTAMP,
       '2,"' || mid || '","' || action || '",' || {_REQUEST} AS OCPP_REQUEST_MESSAGE,
       CASE WHEN has_res THEN '3,"' || mid || '",' || {_RESULT} END AS OCPP_RESPONSE_MESSAGE
FROM sv""")
    o["stream_gold"] = f"SELECT * EXCLUDE (INGEST_LOAD_TIMESTAMP) FROM ({o['silver_conform']})"
    o["vendor_errors"] = _with("""
SELECT source_id AS SOURCE_ID, station AS CHARGE_STATION_ID, vend AS VENDOR_ERROR_CODE
FROM sv WHERE action = 'StatusNotification' AND vend <> '0'""")
    o["gold_upsert"] = _with(f""",
tgt AS (SELECT source_id, action FROM sv WHERE t < TIMESTAMP '{GOLD_SPLIT_TARGET_BEFORE}'),
src AS (SELECT source_id, action FROM sv WHERE t >= TIMESTAMP '{GOLD_SPLIT_SOURCE_FROM}')
SELECT COALESCE(tgt.source_id, src.source_id) AS SOURCE_ID, COALESCE(src.action, tgt.action) AS OCPP_ACTION,
       CASE WHEN src.source_id IS NOT NULL THEN '2024-02-02 00:00:00.000' ELSE '2024-02-01 00:00:00.000' END
         AS STAGE_LOAD_TIMESTAMP,
       CASE WHEN src.source_id IS NOT NULL THEN '2024-02-02 00:00:00.000' ELSE '2024-02-01 00:00:00.000' END
         AS STAGE_PROCESSED_TIMESTAMP
FROM tgt FULL OUTER JOIN src ON tgt.source_id = src.source_id""")
    o["upsert_orders"] = f"""
WITH tgt AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
             WHERE o_orderdate < TIMESTAMP '{ORDERS_TARGET_BEFORE}'),
src AS (SELECT o_orderkey, o_custkey, CAST(o_custkey AS DOUBLE) AS o_totalprice, o_orderstatus FROM orders
        WHERE o_orderdate >= TIMESTAMP '{ORDERS_SOURCE_FROM}')
SELECT COALESCE(tgt.o_orderkey, src.o_orderkey) AS o_orderkey,
       CASE WHEN src.o_orderkey IS NOT NULL THEN src.o_custkey ELSE tgt.o_custkey END AS o_custkey,
       CASE WHEN src.o_orderkey IS NOT NULL THEN src.o_totalprice ELSE tgt.o_totalprice END AS o_totalprice,
       CASE WHEN src.o_orderkey IS NOT NULL THEN src.o_orderstatus ELSE tgt.o_orderstatus END AS o_orderstatus,
       CASE WHEN src.o_orderkey IS NOT NULL THEN '2024-02-02 00:00:00' END AS updated_at
FROM tgt FULL OUTER JOIN src ON tgt.o_orderkey = src.o_orderkey"""
    o["gold_snapshots"] = o["gold_upsert"]
    o["gold_partitioned_upsert"] = o["gold_upsert"]
    o["heartbeats_end_to_end"] = o["charger_heartbeats"]
    o["charging_session_duration_faithful"] = _with(f"""
SELECT txid AS TRANSACTION_ID, station AS CHARGE_STATION_ID, {_t('MIN(unified)')} AS session_start,
       {_t('MAX(unified)')} AS session_end, date_diff('millisecond', MIN(unified), MAX(unified)) AS session_duration_ms
FROM sv WHERE action = 'StopTransaction'
GROUP BY txid, station""")
    # faithful: Heartbeat result time read as text, so an unparsable time still counts as 'payload' and
    # leaves the unified time NULL; bodies with a newline are not read; Start/Stop results never read
    o["silver_faithful"] = _with("""
SELECT action AS OCPP_ACTION, COUNT(*) AS n_rows, COUNT(*) AS n_sources,
       COUNT(*) FILTER (WHERE NOT (action = 'Heartbeat' AND has_res AND eid % 97 = 0)) AS n_unified,
       COUNT(*) FILTER (WHERE CASE action WHEN 'Heartbeat' THEN has_res
                                          WHEN 'StatusNotification' THEN body_time_ok AND eid % 11 <> 0
                                          ELSE body_time_ok END) AS n_payload_source,
       CAST(0 AS BIGINT) AS n_id_tag_status,
       COUNT(*) FILTER (WHERE action = 'StopTransaction') AS n_transaction_id,
       COUNT(*) FILTER (WHERE action = 'StatusNotification' AND eid % 11 <> 0) AS n_error_code,
       COUNT(*) FILTER (WHERE action = 'Heartbeat') AS n_request_message,
       COUNT(*) FILTER (WHERE action = 'Heartbeat' AND has_res) AS n_response_message
FROM sv GROUP BY action""")
    o["charger_heartbeats_faithful"] = _with("""
SELECT station AS CHARGE_STATION_ID,
       CAST(CASE WHEN has_res AND eid % 97 = 0 THEN NULL WHEN has_res THEN t + INTERVAL 1 SECOND ELSE t END AS DATE) AS date,
       COUNT(*) AS heartbeat_count, MAX(0) AS was_down
FROM sv WHERE action = 'Heartbeat' GROUP BY 1, 2""")
    lines = f"""
lines AS (
  SELECT 2 * eid AS id, 'REQ-' || CAST(eid AS VARCHAR) AS request_uuid, t AS created, '2' AS frame_type, action
  FROM ev
  UNION ALL
  SELECT 2 * eid + 1, 'RES-' || CAST(eid AS VARCHAR), t + INTERVAL 1 SECOND, '3', ''
  FROM ev WHERE has_res)"""
    o["since_mark"] = _with(f""",{lines}
SELECT id, CASE WHEN created < TIMESTAMP '{LOAD_SPLIT}' THEN 1 ELSE 2 END AS load,
       strftime(created, '%Y-%m-%d') AS dt, {_t('created')} AS request_date
FROM lines""")
    o["stream_csv_bronze"] = _with(f""",{lines}
SELECT l.id, l.request_uuid, {_t('l.created')} AS request_date, e.uid AS entity_id, e.uid % 3 + 1 AS service_provider_id,
       'SN-' || lpad(CAST(e.uid AS VARCHAR), 6, '0') AS serial_number, e.station AS identity_key,
       l.frame_type, e.mid AS OCPP_MESSAGE_UNIQUE_ID, l.action AS OCPP_ACTION,
       CASE WHEN l.created < TIMESTAMP '{LOAD_SPLIT}' THEN 1 ELSE 2 END AS load, TRUE AS clean
FROM lines l JOIN ev e ON e.eid = l.id // 2""")
    o["stream_master_csv"] = """
SELECT 'CS-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS OCPP_CHARGE_STATION_ID,
       'CS-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '-' || CAST(conn AS VARCHAR) AS OCPP_CONNECTOR_ID,
       CAST(conn AS VARCHAR) AS CONNECTOR_ID,
       'EVSE-' || CAST(c_custkey AS VARCHAR) || '-' || CAST(conn AS VARCHAR) AS SOURCE_EVSE_ID,
       n_name AS COUNTRY_CODE, 'SITE-' || CAST(c_custkey AS VARCHAR) AS SITE_ID, c_name AS SITE_NAME,
       'PUBLIC' AS LOCATION_TYPE, 'PARKING' AS LOCATION_SUB_TYPE, 'UTC' AS TIMEZONE, 'ACTIVE' AS LOCATION_STATUS,
       'OP-' || CAST(c_nationkey AS VARCHAR) AS OPERATOR, c_mktsegment AS OWNING_COMPANY,
       'OCPI-' || CAST(c_custkey AS VARCHAR) || '-' || CAST(conn AS VARCHAR) AS OCPI_CONNECTOR_ID,
       CASE WHEN conn = 2 THEN 'CCS' ELSE 'TYPE2' END AS CONNECTOR_TYPE,
       CASE WHEN conn = 2 THEN 'DC' ELSE 'AC' END AS POWER_TYPE,
       CASE WHEN conn = 2 THEN '50' ELSE '22' END AS POWER_KW, '400' AS VOLTAGE,
       CASE WHEN conn = 2 THEN '125' ELSE '32' END AS AMPERAGE,
       c_mktsegment AS MANUFACTURER, 'M' || CAST(c_custkey % 7 AS VARCHAR) AS MODEL
FROM customer JOIN nation ON c_nationkey = n_nationkey CROSS JOIN (VALUES (1), (2)) AS c(conn)"""
    o["csv_multiline"] = "SELECT doc_id, text FROM documents"
    o["table_roundtrip"] = _with(f"""
SELECT source_id AS SOURCE_ID, action AS OCPP_ACTION, {_t('unified')} AS UNIFIED_TIMESTAMP FROM sv""")
    return o
