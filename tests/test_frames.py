"""Frame parsing expressions, both modes, including the defect cases."""

from pyspark.sql import functions as F

from voltstream.operators import silver

T = "01-Jan-2024 10:00:00.120"


def parse(spark, logs, mode):
    from tests.conftest import bronze_rows

    b = bronze_rows(spark, [(i, "CS1", log) for i, log in enumerate(logs)])
    p = silver.parse_frames(b, mode).orderBy("id")
    return [r.asDict() for r in p.select(
        "id", "_frame_type", "OCPP_MESSAGE_UNIQUE_ID", "OCPP_ACTION", "SOURCE_CONNECTOR_ID",
        "SOURCE_MESSAGE_TIMESTAMP_CREATED", "SOURCE_MESSAGE_TIMESTAMP_UPDATED", "_request_body", "_response_body",
        "OCPP_REQUEST_MESSAGE", "OCPP_RESPONSE_MESSAGE").collect()]


def test_request_and_response(spark):
    rows = parse(spark, [
        f'{T} [2,"42","StartTransaction",{{"connectorId":1,"idTag":"A"}}]@@EOM@@',
        f'{T} [3,"42",{{"transactionId":5}}]@@EOM@@',
    ], "fixed")
    req, res = rows
    assert (req["_frame_type"], req["OCPP_MESSAGE_UNIQUE_ID"], req["OCPP_ACTION"]) == ("2", "42", "StartTransaction")
    assert req["SOURCE_CONNECTOR_ID"] == "1"
    assert req["_request_body"] == '{"connectorId":1,"idTag":"A"}'
    assert req["OCPP_REQUEST_MESSAGE"] == '2,"42","StartTransaction",{"connectorId":1,"idTag":"A"}'
    assert req["OCPP_RESPONSE_MESSAGE"] is None
    assert (res["_frame_type"], res["OCPP_ACTION"], res["_response_body"]) == ("3", "", '{"transactionId":5}')
    assert str(req["SOURCE_MESSAGE_TIMESTAMP_CREATED"]) == "2024-01-01 10:00:00.120000"
    assert req["SOURCE_MESSAGE_TIMESTAMP_UPDATED"] == req["SOURCE_MESSAGE_TIMESTAMP_CREATED"]


def test_bracket_in_prefix_d1(spark):
    log = f'{T} [gw-7] [2,"42","Heartbeat",{{}}]@@EOM@@'
    fixed, = parse(spark, [log], "fixed")
    faithful, = parse(spark, [log], "faithful")
    assert fixed["_frame_type"] == "2" and fixed["OCPP_ACTION"] == "Heartbeat"
    assert faithful["_frame_type"] != "2"  # frame starts at the first '['


def test_non_numeric_id_d2(spark):
    log = f'{T} [2,"ab-12","Heartbeat",{{}}]@@EOM@@'
    fixed, = parse(spark, [log], "fixed")
    faithful, = parse(spark, [log], "faithful")
    assert fixed["OCPP_MESSAGE_UNIQUE_ID"] == "ab-12" and fixed["OCPP_ACTION"] == "Heartbeat"
    assert faithful["OCPP_MESSAGE_UNIQUE_ID"] == "12" and faithful["OCPP_ACTION"] == ""


def test_newline_in_body_d19(spark):
    log = f'{T} [2,"7","StatusNotification",{{"connectorId":2,\n"status":"Faulted"}}]@@EOM@@'
    fixed, = parse(spark, [log], "fixed")
    faithful, = parse(spark, [log], "faithful")
    assert fixed["_request_body"].startswith('{"connectorId":2,\n')
    assert faithful["_request_body"] == ""


def test_error_frame_null_and_garbage(spark):
    rows = parse(spark, [
        f'{T} [4,"9","InternalError","boom",{{}}]@@EOM@@',
        None,
        "no frame here",
        f'31-Feb-2024 99:00:00.000 [2,"1","Heartbeat",{{}}]@@EOM@@',
    ], "fixed")
    err, null, garbage, badtime = rows
    assert err["_frame_type"] == "4" and err["OCPP_ACTION"] == "" and err["OCPP_REQUEST_MESSAGE"] is None
    assert null["OCPP_ACTION"] is None and null["SOURCE_MESSAGE_TIMESTAMP_CREATED"] is None
    assert garbage["_frame_type"] == "" and garbage["SOURCE_MESSAGE_TIMESTAMP_CREATED"] is None
    assert badtime["SOURCE_MESSAGE_TIMESTAMP_CREATED"] is None  # no error under ANSI


def test_lowercase_month_parses(spark):
    row, = parse(spark, ['01-JAN-2024 10:00:00.120 [2,"1","Heartbeat",{}]@@EOM@@'], "fixed")
    assert row["SOURCE_MESSAGE_TIMESTAMP_CREATED"] is not None


def test_modes_validated(spark):
    import pytest

    from tests.conftest import bronze_rows

    with pytest.raises(ValueError):
        silver.parse_frames(bronze_rows(spark, []), "other")
    assert F is not None


def test_log_time_zone_d17(spark):
    import datetime as dt

    from tests.conftest import bronze_rows

    b = bronze_rows(spark, [(1, "CS1", '15-Jan-2024 10:00:00.000 [2,"1","Heartbeat",{}]@@EOM@@')])
    utc = silver.parse_frames(b).first()["SOURCE_MESSAGE_TIMESTAMP_CREATED"]
    lux = silver.parse_frames(b, log_tz="Europe/Luxembourg").first()["SOURCE_MESSAGE_TIMESTAMP_CREATED"]
    assert utc == dt.datetime(2024, 1, 15, 10, 0)
    assert lux == dt.datetime(2024, 1, 15, 9, 0)  # CET is UTC+1 in January
