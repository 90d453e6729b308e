"""Silver: bronze log lines → one typed row per OCPP request.

Plan shape (``fixed`` mode, the default)::

    bronze ──parse_frames (one projection)──┬─ requests ──⋈ master (station grain) ────────────┐
                                            └─ results ──as-of the latest call of their         ├─⟕ (id)─ payloads ─ conform
                                               (station, message id), earliest per call ────────┘

* Every regular expression and both ``from_json`` calls run once per row in
  one projection; actions are told apart with ``when`` instead of one scan
  per action.
* A result belongs to the latest call at or before it with the same station
  and message id, and a call takes the earliest of its results. The as-of
  pairing works in (key, time bucket) windows over narrow rows, then every
  call has one result at most, so the left outer join on the row id never
  fans out, also where charge points start their message ids over.
* The master side is reduced to one row per station; Spark's size threshold
  and AQE choose between broadcast and shuffle join.

``faithful`` mode reproduces the original per-row values instead: only
Heartbeat requests are paired, on the message id alone; Start / Stop results
are never read. The original's row multiplication (every matching result,
every connector row) is not reproduced: it would emit all pairs per group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltstream import schemas
from voltstream.functions import frames
from voltstream.operators.asof import asof_pair
from voltstream.operators.dedup import earliest_by_key, latest_by_key
from voltstream.operators.joins import null_key_salt

# ---------------------------------------------------------------------------
# The four actions kept in silver, and the constant
# enrichment columns of the silver layout with their values.
# ---------------------------------------------------------------------------

HEARTBEAT = "Heartbeat"
START = "StartTransaction"
STOP = "StopTransaction"
STATUS = "StatusNotification"
ACTIONS = (HEARTBEAT, START, STOP, STATUS)

DEFAULTS: Mapping[str, object] = {
    "SOURCE": "OCPP_DRIIVZ",
    "FIRMWARE_VERSION": "csb.21.1.3",
    "SIM_ICCID": "99920200000000",
    "CHANGE_AVAILABILITY_TYPE": "Operative",
    "CHANGE_AVAILABILITY_STATUS": "Accepted",
    "HEARBEAT_INTERVAL": 15,
    "METERVALUE_SOC": 81,
    "METERVALUE_CURRENT_OFFERED": 200,
    "METERVALUE_CURRENT_IMPORT": 29.9,
    "METERVALUE_POWER_KW": 11459.2,
    "METERVALUE_ENERGY_KWH": 43099,
    "METERVALUE_VOLTAGE": 444,
    "METERVALUE_TEMP": 300.1,
    "METERVALUE_RPM": 1410.8,
}

PAYLOAD_SOURCE, CREATED_SOURCE = "payload", "created"

#: master columns carried into silver
MASTER_KEEP = ("MANUFACTURER", "MODEL", "COUNTRY_CODE")

_KEY = ["identity_key", "OCPP_MESSAGE_UNIQUE_ID"]


def parse_frames(bronze: DataFrame, mode: str = "fixed", log_tz: str | None = None) -> DataFrame:
    """Add frame fields to bronze rows: one row per frame (fixed) or per line (faithful), no shuffle.

    Adds ``_frame_no`` (0 for a line's first frame), ``OCPP_MESSAGE_UNIQUE_ID``,
    ``OCPP_ACTION``, ``OCPP_REQUEST_MESSAGE``, ``OCPP_RESPONSE_MESSAGE``,
    ``SOURCE_CONNECTOR_ID``, ``SOURCE_MESSAGE_TIMESTAMP_CREATED`` / ``_UPDATED``
    (TIMESTAMP) and the helper columns ``_frame_type``, ``_request_body``,
    ``_response_body``. A line without a frame stays as one row.
    """
    frames.check_mode(mode)
    line = F.col("raw_log")
    if mode == "fixed":
        kept = [c for c in bronze.columns if c != "raw_log"]
        # a frame without a time of its own takes the line's first one; the pattern runs once, before the generator's condition
        bronze = bronze.select(*kept, "raw_log", frames.created_text(line).alias("_line_time"), frames.found_segments(line).alias("_found"))
        bronze = bronze.select(*kept, "_line_time", F.posexplode(frames.frame_segments(line, F.col("_found"))).alias("_frame_no", "raw_log"))
        raw = F.col("raw_log")
        created_text = F.coalesce(F.nullif(frames.created_text(raw), F.lit("")), F.col("_line_time"))
    else:
        bronze, raw = bronze.withColumn("_frame_no", F.lit(0)), line
        created_text = frames.created_text(raw)
    with_frame = bronze.withColumn("_frame", frames.frame_text(raw, mode))
    frame = F.col("_frame")
    ftype = frames.frame_type(frame, mode)
    created = frames.parse_created(created_text, log_tz)
    out = with_frame.withColumns(
        {
            "_frame_type": ftype,
            "OCPP_MESSAGE_UNIQUE_ID": frames.message_id(frame, mode),
            "OCPP_ACTION": frames.action(raw, frame, mode),
            "OCPP_REQUEST_MESSAGE": F.when(ftype == frames.CALL, frame),
            "OCPP_RESPONSE_MESSAGE": F.when(ftype == frames.CALL_RESULT, frame),
            "SOURCE_CONNECTOR_ID": frames.connector_id(raw),
            "SOURCE_MESSAGE_TIMESTAMP_CREATED": created,
            "_request_body": frames.request_body(raw, frame, mode),
            "_response_body": frames.response_body(frame),
        }
    )
    # the gateway writes one time only; updated equals created (computed once)
    out = out.withColumn("SOURCE_MESSAGE_TIMESTAMP_UPDATED", F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED"))
    return out.drop("_frame", "_line_time")


def by_action(parsed: DataFrame, action: str) -> DataFrame:
    """Requests of one action (FL2)."""
    return parsed.filter(F.col("OCPP_ACTION") == F.lit(action))


def _kind_is(df: DataFrame, kind: str) -> Column:
    """Cheap necessary condition for a frame kind: the partition column of stored frames or of bronze
    when present (partition pruning: the branch reads only its part of the table), else a substring test
    that spares the patterns."""
    if "kind" in df.columns:
        return F.col("kind") == kind
    if "frame_kind" in df.columns:
        return F.col("frame_kind").contains(kind)
    if "raw_log" not in df.columns:
        return F.lit(True)
    return F.col("raw_log").contains(f'[{kind},"')


def requests(parsed: DataFrame, actions=ACTIONS) -> DataFrame:
    """Call frames of the silver actions.

    A line's frame kind names the types of all its frames, so every call frame
    (either mode) lies in a kind with a '2'. That cheap test runs first: on a
    bronze table partitioned by kind it prunes the scan.
    """
    return parsed.filter(_kind_is(parsed, "2")).filter(F.col("OCPP_ACTION").isin(list(actions)))


def responses(parsed: DataFrame) -> DataFrame:
    """Call-result frames (FL3): key, frame text and ordering columns.

    Every result frame lies in a frame kind with a '3'; that cheap test runs first.
    """
    return parsed.filter(_kind_is(parsed, "3")).filter(F.col("OCPP_RESPONSE_MESSAGE").isNotNull()).select(
        *_KEY,
        "OCPP_RESPONSE_MESSAGE",
        *([F.col("_body_at").alias("_res_at")] if "_body_at" in parsed.columns else []),
        F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED").alias("_res_created"),
        F.col("id").alias("_res_id"),
        F.col("_frame_no").alias("_res_no"),
    )


def calls(parsed: DataFrame) -> DataFrame:
    """Call frames of any action (also those not kept in silver): what results can belong to."""
    return parsed.filter(_kind_is(parsed, "2")).filter(F.col("_frame_type") == frames.CALL).select(
        *_KEY, F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED").alias("_call_created"), F.struct("id", "_frame_no").alias("_call"))


def parse_request_payload(reqs: DataFrame) -> DataFrame:
    """Request body → typed ``_req`` struct (one merged schema); the body text is dropped.

    Done before the pairing shuffle, so the shuffle carries typed fields
    instead of JSON text.
    """
    if "_body_at" in reqs.columns:  # stored frames know where their body begins
        body = F.substr(F.col("OCPP_REQUEST_MESSAGE"), F.col("_body_at"))
    else:
        body = F.nullif(F.col("_request_body"), F.lit(""))
    return reqs.withColumn("_req", F.from_json(body, schemas.REQUEST_PAYLOAD_DDL)).drop("_request_body", "_body_at")


def pair_responses(reqs: DataFrame, parsed: DataFrame, mode: str = "fixed") -> DataFrame:
    """Attach each request's result frame (JN1) as ``OCPP_RESPONSE_MESSAGE``.

    fixed: a result belongs to the latest call at or before it (gateway time)
    with the same (station, message id); a call takes the earliest of its
    results (by gateway time, then bronze id). Frames without a gateway time
    never pair. faithful: Heartbeat requests only, keyed on the message id
    alone, earliest result, so a result of another station can pair (the
    original mis-pairing); the original's fan-out to *every* matching result
    is not reproduced, as that would emit all pairs per message id.
    """
    frames.check_mode(mode)
    res = responses(parsed)
    reqs = reqs.drop("OCPP_RESPONSE_MESSAGE", "_response_body")
    if mode == "fixed":
        text = [c for c in ("OCPP_RESPONSE_MESSAGE", "_res_at") if c in res.columns]
        best = answers(calls(parsed), res, text)
        return with_answers(reqs, best.select(F.col("_call.id").alias("_c_id"), F.col("_call._frame_no").alias("_c_no"), *text))
    # One result per message id, joined on a derived key (NULL and salted for rows that don't pair): the join gets a
    # shuffle of its own on both sides, so AQE can split an id that many stations use.
    mid = F.concat(F.lit("m"), F.col("OCPP_MESSAGE_UNIQUE_ID"))
    res = earliest_by_key(res, ["OCPP_MESSAGE_UNIQUE_ID"], ["_res_created", "_res_id"], values=["OCPP_RESPONSE_MESSAGE"])
    left = reqs.withColumn("_pk", F.when(F.col("OCPP_ACTION") == HEARTBEAT, mid))
    left = left.withColumn("_nk", null_key_salt(["_pk"], spread_by=F.col("id")))
    right = res.select(mid.alias("_pk"), F.lit(0).cast("bigint").alias("_nk"), "OCPP_RESPONSE_MESSAGE")
    return left.join(right, ["_pk", "_nk"], "left").drop("_pk", "_nk")


def answers(call_rows: DataFrame, result_rows: DataFrame, values: list[str]) -> DataFrame:
    """``_call`` and ``values`` of the result that answers it: see ``pair_responses``."""
    owned = asof_pair(call_rows, result_rows, _KEY, "_call_created", "_res_created", "_call")
    return earliest_by_key(owned, ["_call"], ["_res_created", "_res_id", "_res_no"], values=values)


def with_answers(reqs: DataFrame, best: DataFrame) -> DataFrame:
    """Requests with the columns of ``best(_c_id, _c_no, ...)``, joined by line id and frame number."""
    return reqs.join(best, (F.col("id") == F.col("_c_id")) & (F.col("_frame_no") == F.col("_c_no")), "left").drop("_c_id", "_c_no")


def parse_payloads(paired: DataFrame, mode: str = "fixed") -> DataFrame:
    """Typed per-action payload columns from the parsed request and result bodies."""
    frames.check_mode(mode)
    act = F.col("OCPP_ACTION")
    is_hb, is_start, is_stop, is_status = (act == F.lit(a) for a in ACTIONS)
    df = paired if "_req" in paired.columns else parse_request_payload(paired)
    if "_res_at" in df.columns:
        res_body = F.substr(F.col("OCPP_RESPONSE_MESSAGE"), F.col("_res_at"))
    else:
        res_body = F.nullif(frames.response_body(F.col("OCPP_RESPONSE_MESSAGE")), F.lit(""))
    df = df.withColumn("_res", F.from_json(res_body, schemas.RESPONSE_PAYLOAD_DDL))
    req, res = F.col("_req"), F.col("_res")

    if mode == "fixed":
        hb_time = F.coalesce(res["currentTime"], req["timestamp"])  # a Heartbeat may bring a time of its own
        hb_has_payload = hb_time.isNotNull()
        start_status = res["idTagInfo"]["status"]
        stop_status = res["idTagInfo"]["status"]
        start_txn = res["transactionId"]
        keep_messages = F.lit(True)
    else:
        # the result text is read with a pattern: '' (key absent) still counts
        # as a payload time, and the text is cast afterwards
        hb_text = frames.current_time_text(F.col("OCPP_RESPONSE_MESSAGE"))
        hb_time = hb_text.try_cast("timestamp")
        hb_has_payload = hb_text.isNotNull()
        start_status = stop_status = start_txn = F.lit(None).cast("string")
        keep_messages = is_hb

    body_time = req["timestamp"]
    payload_ts = F.when(is_hb, hb_time).when(is_start | is_stop | is_status, body_time)
    has_payload = F.when(is_hb, hb_has_payload).otherwise(body_time.isNotNull())

    cols: dict[str, Column] = {
        "PAYLOAD_TIMESTAMP": payload_ts,
        "UNIFIED_TIMESTAMP_SOURCE": F.when(has_payload, F.lit(PAYLOAD_SOURCE)).otherwise(F.lit(CREATED_SOURCE)),
        "OCPP_ERROR_CODE": F.when(is_status, req["errorCode"]),
        "VENDOR_ERROR_CODE": F.when(is_status, req["vendorErrorCode"]),
        "STATUS": F.when(is_status, req["status"]),
        "STATUS_INFO": F.when(is_status, req["info"]),
        "ID_TAG": F.when(is_start | is_stop, req["idTag"]),
        "ID_TAG_STATUS": F.when(is_start, start_status).when(is_stop, stop_status),
        "TRANSACTION_ID": F.when(is_stop, req["transactionId"]).when(is_start, start_txn).try_cast("int"),
        "STOP_REASON": F.when(is_stop, req["reason"]),
        "METER_START": F.when(is_start, req["meterStart"]).try_cast("float"),
        "METER_STOP": F.when(is_stop, req["meterStop"]).try_cast("float"),
        "OCPP_REQUEST_MESSAGE": F.when(keep_messages, F.col("OCPP_REQUEST_MESSAGE")),
        "OCPP_RESPONSE_MESSAGE": F.when(keep_messages, F.col("OCPP_RESPONSE_MESSAGE")),
    }
    if mode == "faithful":
        # an unparsable payload time gives NULL here (the original, non-ANSI cast)
        cols["UNIFIED_TIMESTAMP"] = F.when(has_payload, payload_ts).otherwise(F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED"))
    else:
        cols["UNIFIED_TIMESTAMP"] = F.coalesce(payload_ts, F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED"))
    return df.withColumns(cols).drop("_req", "_res")


def station_master(master: DataFrame, mode: str = "fixed") -> DataFrame:
    """Master rows used for enrichment: one per station (newest load, then the lowest connector's row).

    Both modes use station grain. The original joined one row per connector
    (and per master reload), multiplying messages; that fan-out is not
    reproduced in ``faithful`` mode, as it would emit all message × connector
    pairs per station and grow with every reload. Master rows may carry their
    load time in ``MASTER_LOAD_TIME`` (as the master stream stamps it).
    Connectors are ordered by number, those that are no number last, by text.
    """
    frames.check_mode(mode)
    load = F.col(schemas.MASTER_LOAD) if schemas.MASTER_LOAD in master.columns else F.lit(None).cast("timestamp")
    number = -F.coalesce(F.col("CONNECTOR_ID").try_cast("bigint"), F.lit(2**62))
    m = master.select("OCPP_CHARGE_STATION_ID", *MASTER_KEEP, load.alias("_load"), number.alias("_number"),
                      F.col("CONNECTOR_ID").alias("_text"), F.col("OCPP_CONNECTOR_ID").alias("_ocpp"))
    # greatest (load, -number), then least (text, id, kept values): two partial aggregates
    rows = m.groupBy("OCPP_CHARGE_STATION_ID", F.struct("_load", "_number").alias("_rank")).agg(
        F.min(F.struct("_text", "_ocpp", *MASTER_KEEP)).alias("_w"))
    best = rows.groupBy("OCPP_CHARGE_STATION_ID").agg(F.max_by("_w", "_rank").alias("_w"))
    return best.filter(F.col("OCPP_CHARGE_STATION_ID").isNotNull()).select(
        "OCPP_CHARGE_STATION_ID", *[F.col(f"_w.{c}").alias(c) for c in MASTER_KEEP])


def master_versions(master: DataFrame) -> DataFrame:
    """Master rows as versions: one per station and span of time, ``valid_from`` <= t < ``valid_to``.

    A load (``MASTER_LOAD_TIME``) holds from its time until the station's next one that differs; the first known
    version also holds for all time before it (``valid_from`` NULL), the last one has no end (``valid_to`` NULL). Within
    a load the lowest connector's row counts, as in ``station_master``. Rows without a load time are the oldest load.
    A station has one row per load at most in the window, so it is bounded by the number of reloads.
    """
    load = F.col(schemas.MASTER_LOAD) if schemas.MASTER_LOAD in master.columns else F.lit(None).cast("timestamp")
    number = F.coalesce(F.col("CONNECTOR_ID").try_cast("bigint"), F.lit(2**62))
    rows = master.filter(F.col("OCPP_CHARGE_STATION_ID").isNotNull()).groupBy("OCPP_CHARGE_STATION_ID", load.alias("_load")).agg(
        F.min(F.struct(number.alias("_number"), F.col("CONNECTOR_ID").alias("_text"), F.col("OCPP_CONNECTOR_ID").alias("_ocpp"), *MASTER_KEEP)).alias("_w"))
    kept = F.struct(*[F.col(f"_w.{c}").alias(c) for c in MASTER_KEEP])
    by_time = Window.partitionBy("OCPP_CHARGE_STATION_ID").orderBy(F.col("_load").asc_nulls_first())
    told = rows.select("OCPP_CHARGE_STATION_ID", "_load", kept.alias("_v")).withColumns({"_before": F.lag("_v").over(by_time), "_nth": F.row_number().over(by_time)})
    first = F.col("_nth") == 1
    changes = told.filter(first | ~F.col("_v").eqNullSafe(F.col("_before"))).withColumns({
        "valid_from": F.when(~first, F.col("_load")), "valid_to": F.lead("_load").over(by_time)})
    return changes.select("OCPP_CHARGE_STATION_ID", *[F.col(f"_v.{c}").alias(c) for c in MASTER_KEEP], "valid_from", "valid_to")


def message_time() -> Column:
    """When a message was written: its gateway time."""
    return F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED")


def enrich_with_master(df: DataFrame, master: DataFrame, mode: str = "fixed") -> DataFrame:
    """Inner join on station id (JN2), with the master data valid at the message's time.

    Where master rows carry ``MASTER_LOAD_TIME`` (as the master stream stamps it), a message takes the version valid
    at its own time, so the result does not depend on when its load was built; messages without a time take the first. Without load times, and in ``faithful`` mode, there is one version per station.

    The join is on a derived station key, so that in a shuffle join both
    sides get their own shuffle and AQE can split a hot station's partition
    (a join fed straight by the station-grain aggregate could not be split);
    a per-row salt spreads messages without a station. A message meets its station's few versions and matches one.
    """
    key = lambda c: F.concat(F.length(F.col(c)).cast("string"), F.lit(":"), F.col(c))
    left = df.withColumns({"_sk": key("identity_key"), "_nk": null_key_salt(["identity_key"], spread_by=F.col("id"))})
    if mode == "faithful" or schemas.MASTER_LOAD not in master.columns:
        right = station_master(master, mode).select(key("OCPP_CHARGE_STATION_ID").alias("_sk"), F.lit(0).cast("bigint").alias("_nk"), *MASTER_KEEP)
        return left.join(right, ["_sk", "_nk"], "inner").drop("_sk", "_nk")
    right = master_versions(master).select(key("OCPP_CHARGE_STATION_ID").alias("_rk"), F.lit(0).cast("bigint").alias("_rn"), *MASTER_KEEP, "valid_from", "valid_to")
    at = left.withColumn("_at", message_time())
    valid = (F.col("valid_from").isNull() | (F.col("_at") >= F.col("valid_from"))) & (F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to")))
    valid = valid | (F.col("_at").isNull() & F.col("valid_from").isNull())
    return at.join(right, (F.col("_sk") == F.col("_rk")) & (F.col("_nk") == F.col("_rn")) & valid, "inner").drop("_sk", "_nk", "_rk", "_rn", "_at", "valid_from", "valid_to")


def conform(
    df: DataFrame, defaults: Mapping[str, object] | None = None, stage_time: Column | None = None
) -> DataFrame:
    """The 44 silver columns in table order (PJ7, PJ8)."""
    d = dict(DEFAULTS)
    if defaults:
        d.update(defaults)
    if stage_time is None:
        stage_time = F.current_timestamp()
    created = F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED")
    exprs: dict[str, Column] = {
        # further frames of a line get their number into the key
        "SOURCE_ID": F.concat(F.col("id").cast("string"), F.when(F.col("_frame_no") > 0, F.concat(F.lit("#"), F.col("_frame_no").cast("string"))).otherwise(F.lit(""))),
        "SOURCE_MESSAGE_ID": F.concat_ws("_", F.col("entity_id").cast("string"), F.col("request_uuid")),
        "CHARGE_STATION_ID": F.col("identity_key"),
        "SERIAL_NUMBER": F.col("serial_number"),
        "INGEST_LOAD_TIMESTAMP": F.col("ingest_load_timestamp"),
        "STAGE_LOAD_TIMESTAMP": stage_time,
        "CORE_MESSAGE_UNIQUE_ID": F.concat_ws(
            "_",
            F.col("identity_key"),
            F.col("SOURCE_CONNECTOR_ID"),
            F.col("OCPP_ACTION"),
            created.cast("string"),
            F.col("OCPP_MESSAGE_UNIQUE_ID"),
        ),
    }
    types = dict(zip(schemas.SILVER_COLUMNS, _silver_types()))
    out = []
    for name in schemas.SILVER_COLUMNS:
        if name in d:
            e = F.lit(d[name])
        elif name in exprs:
            e = exprs[name]
        elif name in df.columns:
            e = F.col(name)
        else:
            e = F.lit(None)
        out.append(e.cast(types[name]).alias(name))
    return df.select(*out)


def _silver_types() -> list[str]:
    text = schemas.ddl(schemas.SILVER_DDL)
    return [part.strip().split()[1].lower() for part in text.split(",")]


def to_silver(
    bronze: DataFrame,
    master: DataFrame,
    mode: str = "fixed",
    defaults: Mapping[str, object] | None = None,
    stage_time: Column | None = None,
    log_tz: str | None = None,
    wanted: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """bronze + master → silver (44 columns), the whole parse in one plan.

    ``wanted`` picks the request frames that become rows; all frames take part in the pairing.
    """
    return silver_from_frames(parse_frames(bronze, mode, log_tz), master, mode, defaults, stage_time, wanted)


def silver_from_frames(
    parsed: DataFrame,
    master: DataFrame,
    mode: str = "fixed",
    defaults: Mapping[str, object] | None = None,
    stage_time: Column | None = None,
    wanted: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """frames (of ``parse_frames``, or the stored table of ``plans.load_tables``) + master → silver (44 columns)."""
    reqs = requests(parsed) if wanted is None else wanted(requests(parsed))
    reqs = parse_request_payload(enrich_with_master(reqs, master, mode))
    paired = pair_responses(reqs, parsed, mode)
    return conform(parse_payloads(paired, mode), defaults, stage_time)


def silver_of_calls(paired: DataFrame, defaults: Mapping[str, object] | None = None, stage_time: Column | None = None) -> DataFrame:
    """Silver rows of call frames that have their master columns and their result (``OCPP_RESPONSE_MESSAGE``, ``_res_at``)."""
    return conform(parse_payloads(paired), defaults, stage_time)


def to_silver_by_action(
    bronze: DataFrame,
    master: DataFrame,
    defaults: Mapping[str, object] | None = None,
    stage_time: Column | None = None,
) -> DataFrame:
    """Comparison plan only (bench): the same silver rows built one action at a time.

    Each action is its own branch that re-scans and re-parses bronze and pairs
    its own results, and the branches are unioned; this is the branch-per-action
    shape ``to_silver`` replaces with one parse pass.
    """
    parts = []
    for act in ACTIONS:
        parsed = parse_frames(bronze)
        reqs = parse_request_payload(enrich_with_master(by_action(parsed, act), master))
        parts.append(parse_payloads(pair_responses(reqs, parse_frames(bronze))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return conform(out, defaults, stage_time)


def vendor_errors(silver: DataFrame) -> DataFrame:
    """StatusNotification rows whose vendor error code is set and not '0' (FL4)."""
    return silver.filter((F.col("OCPP_ACTION") == STATUS) & (F.col("VENDOR_ERROR_CODE") != "0"))
