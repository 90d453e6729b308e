"""OCPP log lines and station master rows derived from the driver's tables.

The driver ships TPC-H-like tables, not charger logs. Every OCPP query in
this repo therefore starts from ``events`` (one OCPP request per event, plus
a result frame for most) and ``customer`` ⋈ ``nation`` (station master), so
the work grows with the tables. Rules (the oracle SQL recomputes the
expected fields from ``events`` directly, never from the rendered text):

=====================  ======================================================
station                ``'CS-' || lpad(user_id, 6, '0')``
message id             ``event_id + 1000000``
action                 view→Heartbeat, purchase→StartTransaction,
                       signup→StopTransaction, click/error→StatusNotification
bronze id              request ``2*event_id``, result ``2*event_id + 1``
gateway time           ``ts`` to the millisecond; result one second later
payload time           none if ``event_id % 10 = 0``; minute 75 if
                       ``event_id % 97 = 0``; else ``ts + 1 s`` (ISO, ``Z``)
result frame           only if ``event_id % 5 <> 0``
k                      ``props.k``; connector ``event_id % 2 + 1``;
                       tag ``'T' || user_id % 20``
meters                 start ``100*k``; stop ``100*(k + event_id % 7)``
transaction id         ``100*user_id + k % 10``
stop reason            Local if k even else Remote
status notification    click: NoError / '0' / Available;
                       error: Error (k even) or OtherError / k / Faulted
result status          Blocked if ``k % 4 = 0`` else Accepted
newline in body        StatusNotification bodies with ``event_id % 11 = 0``
master                 customer × connectors {1, 2} ⋈ nation (user 0 is no
                       customer, so the inner join drops that station)
=====================  ======================================================

The modulo rules only shape the derived data (which event has a result
frame, a payload time, a newline).
Every event is rendered and processed; nothing is sampled away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.functions.frames import CREATED_FORMAT

EVENT_TYPES = ("view", "purchase", "signup", "click", "error")
ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _q(c: Column) -> Column:
    """JSON string literal of a column (values here never hold quotes)."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def ocpp_from_events(events: DataFrame) -> DataFrame:
    """Bronze reader rows (request and result lines) rendered from ``events``.

    One scan: each event yields an array of its one or two lines, inlined. An event's lines are many times its size in
    the table, so the narrow rows are dealt out first: a table of few row groups would be rendered and parsed by as few tasks.
    """
    eid = F.col("event_id")
    ev = events.filter(F.col("event_type").isin(*EVENT_TYPES)).select(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
    ).repartition("event_id", "user_id", "ts")
    k, uid, et, ts = F.col("k"), F.col("user_id"), F.col("event_type"), F.col("ts")
    ts_res = ts + F.expr("INTERVAL 1 SECOND")
    station = F.concat(F.lit("CS-"), F.lpad(_s(uid), 6, "0"))
    mid = _s(eid + F.lit(1000000))
    action = (
        F.when(et == "view", "Heartbeat")
        .when(et == "purchase", "StartTransaction")
        .when(et == "signup", "StopTransaction")
        .otherwise("StatusNotification")
    )
    created_req = F.date_format(ts, CREATED_FORMAT)
    created_res = F.date_format(ts_res, CREATED_FORMAT)
    payload_time = (
        F.when(eid % 10 == 0, F.lit(None))
        .when(eid % 97 == 0, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH"), F.lit(":75:00Z")))
        .otherwise(F.date_format(ts_res, ISO_MS))
    )
    time_field = F.coalesce(F.concat(F.lit(',"timestamp":'), _q(payload_time)), F.lit(""))
    conn = _s(eid % 2 + 1)
    tag = F.concat(F.lit("T"), _s(uid % 20))
    txn = _s(uid * 100 + k % 10)
    meter_stop = _s((k + eid % 7) * 100)
    is_error = et == "error"
    error_code = F.when(~is_error, "NoError").when(k % 2 == 0, "Error").otherwise("OtherError")
    vendor_code = F.when(is_error, _s(k)).otherwise(F.lit("0"))
    status = F.when(is_error, "Faulted").otherwise("Available")
    sep = F.when(eid % 11 == 0, F.lit(",\n")).otherwise(F.lit(","))
    res_status = F.when(k % 4 == 0, "Blocked").otherwise("Accepted")

    req_body = (
        F.when(et == "view", F.lit("{}"))
        .when(
            et == "purchase",
            F.concat(
                F.lit('{"connectorId":'), conn, F.lit(',"idTag":'), _q(tag),
                F.lit(',"meterStart":'), _s(k * 100), time_field, F.lit("}"),
            ),
        )
        .when(
            et == "signup",
            F.concat(
                F.lit('{"idTag":'), _q(tag), F.lit(',"meterStop":'), meter_stop, time_field,
                F.lit(',"transactionId":'), txn,
                F.lit(',"reason":'), _q(F.when(k % 2 == 0, "Local").otherwise("Remote")),
                F.lit(',"transactionData":[{"sampledValue":[{"value":'), _q(meter_stop), F.lit("}]}]}"),
            ),
        )
        .otherwise(
            F.concat(
                F.lit('{"connectorId":'), conn, sep, F.lit('"errorCode":'), _q(error_code),
                F.lit(',"info":'), _q(F.concat(F.lit("info-"), _s(k))),
                F.lit(',"status":'), _q(status), time_field,
                F.lit(',"vendorErrorCode":'), _q(vendor_code),
                F.lit(',"vendorId":'), _q(F.concat(F.lit("V"), _s(uid % 3))), F.lit("}"),
            )
        )
    )
    res_body = (
        F.when(et == "view", F.coalesce(F.concat(F.lit('{"currentTime":'), _q(payload_time), F.lit("}")), F.lit("{}")))
        .when(et == "purchase", F.concat(F.lit('{"idTagInfo":{"status":'), _q(res_status), F.lit('},"transactionId":'), txn, F.lit("}")))
        .when(et == "signup", F.concat(F.lit('{"idTagInfo":{"status":'), _q(res_status), F.lit("}}")))
        .otherwise(F.lit("{}"))
    )
    req_log = F.concat(created_req, F.lit(' [2,"'), mid, F.lit('","'), action, F.lit('",'), req_body, F.lit("]@@EOM@@"))
    res_log = F.concat(created_res, F.lit(' [3,"'), mid, F.lit('",'), res_body, F.lit("]@@EOM@@"))

    def line(bid: Column, uuid_prefix: str, created: Column, log: Column) -> Column:
        return F.struct(
            bid.alias("id"),
            F.concat(F.lit(uuid_prefix), _s(eid)).alias("request_uuid"),
            F.try_to_timestamp(created, F.lit(CREATED_FORMAT)).alias("request_date"),
            uid.alias("entity_id"),
            (uid % 3 + 1).alias("service_provider_id"),
            log.alias("raw_log"),
            F.concat(F.lit("SN-"), F.lpad(_s(uid), 6, "0")).alias("serial_number"),
            station.alias("identity_key"),
            F.lit(None).cast("string").alias("_rescued_data"),
        )

    lines = F.array(
        line(eid * 2, "REQ-", created_req, req_log),
        F.when(eid % 5 != 0, line(eid * 2 + 1, "RES-", created_res, res_log)),
    )
    return ev.select(F.inline(lines)).filter(F.col("id").isNotNull())


def master_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Station master rows (22 text columns, one per connector) from customer ⋈ nation."""
    c = customer.select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment", F.explode(F.array(F.lit(1), F.lit(2))).alias("conn")
    )
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = c.join(n, "c_nationkey", "inner")
    key, conn = F.col("c_custkey"), F.col("conn")
    station = F.concat(F.lit("CS-"), F.lpad(_s(key), 6, "0"))
    dc = conn == 2
    return j.select(
        station.alias("OCPP_CHARGE_STATION_ID"),
        F.concat(station, F.lit("-"), _s(conn)).alias("OCPP_CONNECTOR_ID"),
        _s(conn).alias("CONNECTOR_ID"),
        F.concat(F.lit("EVSE-"), _s(key), F.lit("-"), _s(conn)).alias("SOURCE_EVSE_ID"),
        F.col("n_name").alias("COUNTRY_CODE"),
        F.concat(F.lit("SITE-"), _s(key)).alias("SITE_ID"),
        F.col("c_name").alias("SITE_NAME"),
        F.lit("PUBLIC").alias("LOCATION_TYPE"),
        F.lit("PARKING").alias("LOCATION_SUB_TYPE"),
        F.lit("UTC").alias("TIMEZONE"),
        F.lit("ACTIVE").alias("LOCATION_STATUS"),
        F.concat(F.lit("OP-"), _s(F.col("c_nationkey"))).alias("OPERATOR"),
        F.col("c_mktsegment").alias("OWNING_COMPANY"),
        F.concat(F.lit("OCPI-"), _s(key), F.lit("-"), _s(conn)).alias("OCPI_CONNECTOR_ID"),
        F.when(dc, "CCS").otherwise("TYPE2").alias("CONNECTOR_TYPE"),
        F.when(dc, "DC").otherwise("AC").alias("POWER_TYPE"),
        F.when(dc, "50").otherwise("22").alias("POWER_KW"),
        F.lit("400").alias("VOLTAGE"),
        F.when(dc, "125").otherwise("32").alias("AMPERAGE"),
        F.col("c_mktsegment").alias("MANUFACTURER"),
        F.concat(F.lit("M"), _s(key % 7)).alias("MODEL"),
        F.lit(None).cast("string").alias("_rescued_data"),
    )


def bronze_from_events(spark: SparkSession, sf_dir: str, ingest_time: Column | None = None) -> DataFrame:
    """Bronze table rows (11 columns) for the tables in ``sf_dir`` without a file hop."""
    from voltstream.operators import bronze

    lines = ocpp_from_events(table(spark, sf_dir, "events"))
    src = F.lit(f"{sf_dir.rstrip('/')}/events.parquet")
    return bronze.conform(bronze.add_ingest_metadata(lines, source_file=src, ingest_time=ingest_time))


def master_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master_from_customers(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))
