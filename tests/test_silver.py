"""Pairing, payloads, master enrichment and conformance on hand-made lines."""

import datetime as dt

import pytest

from tests.conftest import bronze_rows, master_rows
from voltstream import schemas
from voltstream.operators import silver
from voltstream.plans.inspect import plan_text

T0 = "01-Jan-2024 10:00:00.000"
T1 = "01-Jan-2024 10:00:01.000"
T2 = "01-Jan-2024 10:00:02.000"


def logs():
    return [
        (1, "CS1", f'{T0} [2,"100","Heartbeat",{{}}]@@EOM@@'),
        (2, "CS1", f'{T1} [3,"100",{{"currentTime":"2024-01-01T10:00:05.000Z"}}]@@EOM@@'),
        (3, "CS1", f'{T2} [3,"100",{{"currentTime":"2024-01-01T10:00:09.000Z"}}]@@EOM@@'),  # later duplicate
        (4, "CS2", f'{T1} [3,"100",{{"currentTime":"2024-01-01T11:00:00.000Z"}}]@@EOM@@'),  # same id, other station
        (5, "CS1", f'{T0} [2,"200","StartTransaction",{{"connectorId":1,"idTag":"A","meterStart":10,"timestamp":"2024-01-01T09:59:59.000Z"}}]@@EOM@@'),
        (6, "CS1", f'{T1} [3,"200",{{"idTagInfo":{{"status":"Accepted"}},"transactionId":77}}]@@EOM@@'),
        (7, "CS1", f'{T0} [2,"300","StopTransaction",{{"idTag":"A","meterStop":50,"transactionId":77,"reason":"Local","timestamp":"2024-01-01T10:30:75Z"}}]@@EOM@@'),
        (8, "CS1", f'{T0} [2,"400","StatusNotification",{{"connectorId":2,"errorCode":"Error","status":"Faulted","vendorErrorCode":"E1","info":"x"}}]@@EOM@@'),
        (9, "CS9", f'{T0} [2,"500","Heartbeat",{{}}]@@EOM@@'),  # station not in master
        (10, "CS1", f'{T0} [2,"600","Heartbeat",{{}}]@@EOM@@'),
        (11, "CS1", f'{T1} [3,"600",{{}}]@@EOM@@'),  # result without currentTime (D5)
    ]


@pytest.fixture()
def master(spark):
    return master_rows(spark, [("CS1", 1, "ACME"), ("CS1", 2, "ACME"), ("CS2", 1, "OTHER")])


def build(spark, master, mode):
    b = bronze_rows(spark, logs())
    s = silver.to_silver(b, master, mode=mode, stage_time=None)
    return {r["SOURCE_ID"]: r.asDict() for r in s.collect()}, s


def test_fixed_mode(spark, master):
    rows, s = build(spark, master, "fixed")
    assert s.columns == schemas.SILVER_COLUMNS
    assert sorted(rows) == ["1", "10", "5", "7", "8"]  # one row per request; CS9 dropped by the inner join
    hb = rows["1"]
    assert hb["PAYLOAD_TIMESTAMP"] == dt.datetime(2024, 1, 1, 10, 0, 5)  # earliest result of the same station
    assert hb["UNIFIED_TIMESTAMP_SOURCE"] == "payload"
    start = rows["5"]
    assert (start["ID_TAG"], start["ID_TAG_STATUS"], start["TRANSACTION_ID"], start["METER_START"]) == ("A", "Accepted", 77, 10.0)
    stop = rows["7"]
    assert stop["PAYLOAD_TIMESTAMP"] is None and stop["UNIFIED_TIMESTAMP_SOURCE"] == "created"  # minute 75
    assert stop["UNIFIED_TIMESTAMP"] == dt.datetime(2024, 1, 1, 10, 0, 0)
    assert (stop["STOP_REASON"], stop["METER_STOP"], stop["TRANSACTION_ID"]) == ("Local", 50.0, 77)
    st = rows["8"]
    assert (st["OCPP_ERROR_CODE"], st["VENDOR_ERROR_CODE"], st["STATUS"], st["STATUS_INFO"]) == ("Error", "E1", "Faulted", "x")
    assert st["SOURCE_CONNECTOR_ID"] == "2"
    d5 = rows["10"]
    assert d5["UNIFIED_TIMESTAMP_SOURCE"] == "created" and d5["UNIFIED_TIMESTAMP"] == dt.datetime(2024, 1, 1, 10)
    assert hb["SOURCE"] == "OCPP_DRIIVZ" and hb["HEARBEAT_INTERVAL"] == 15 and hb["MANUFACTURER"] == "ACME"
    assert hb["CORE_MESSAGE_UNIQUE_ID"] == "CS1__Heartbeat_2024-01-01 10:00:00_100"
    assert hb["SOURCE_MESSAGE_ID"] == "7_u1"


def test_faithful_mode(spark, master):
    rows, s = build(spark, master, "faithful")
    ids = [r["SOURCE_ID"] for r in s.collect()]
    # no row multiplication (results of id 100 from two stations, master with two connectors)
    assert sorted(ids) == sorted(set(ids))
    start = [r for r in s.collect() if r["SOURCE_ID"] == "5"][0]
    assert start["ID_TAG_STATUS"] is None and start["TRANSACTION_ID"] is None  # result never read (D3, D4)
    assert start["OCPP_REQUEST_MESSAGE"] is None  # D18
    d5 = [r for r in s.collect() if r["SOURCE_ID"] == "10"][0]
    assert d5["UNIFIED_TIMESTAMP_SOURCE"] == "payload" and d5["UNIFIED_TIMESTAMP"] is None  # D5
    # keyed on the message id alone: the earliest result of id 100 (bronze id 2, CS1) wins
    hb = [r for r in s.collect() if r["SOURCE_ID"] == "1"][0]
    assert "10:00:05" in hb["OCPP_RESPONSE_MESSAGE"]


def test_vendor_errors(spark, master):
    _, s = build(spark, master, "fixed")
    assert [r["SOURCE_ID"] for r in silver.vendor_errors(s).collect()] == ["8"]


def test_master_join_runs_no_job_while_planning(spark, master):
    """Building the plan is lazy; Spark decides on a broadcast when it runs."""
    b = bronze_rows(spark, logs())
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    plan = silver.enrich_with_master(silver.requests(silver.parse_frames(b)), master)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert plan.count() == 5


def test_latest_call_owns_a_result(spark, master):
    """Ids that start over: a result belongs to the latest call at or before it, a call takes its earliest result."""
    line = lambda t, text: f"{t} {text}@@EOM@@"
    hb = '[2,"9","Heartbeat",{}]'
    res = lambda n: f'[3,"9",{{"currentTime":"2024-03-01T00:00:{n:02d}Z"}}]'
    b = bronze_rows(spark, [
        (1, "CS1", line("15-Jan-2024 10:00:00.000", hb)), (2, "CS1", line("15-Jan-2024 12:00:00.000", res(2))),
        (3, "CS1", line("15-Jan-2024 11:00:00.000", res(3))), (4, "CS1", line("15-Feb-2024 10:00:00.000", hb)),
        (5, "CS1", line("16-Feb-2024 10:00:00.000", res(5))), (6, "CS1", line("14-Jan-2024 10:00:00.000", res(6))),
        (7, "CS1", line("17-Feb-2024 10:00:00.000", '[2,"9","BootNotification",{}]')), (8, "CS1", line("17-Feb-2024 10:00:01.000", res(8))),
        (9, "CS1", line("15-Feb-2024 10:00:00.000", res(9)))])
    got = {r.SOURCE_ID: r.OCPP_RESPONSE_MESSAGE for r in silver.to_silver(b, master).collect()}
    assert set(got) == {"1", "4"} and ":03Z" in got["1"] and ":09Z" in got["4"]


def test_branch_per_action_plan_gives_same_rows(spark, master):
    b = bronze_rows(spark, logs())
    a = silver.to_silver(b, master, stage_time=None).drop("STAGE_LOAD_TIMESTAMP")
    c = silver.to_silver_by_action(b, master, stage_time=None).drop("STAGE_LOAD_TIMESTAMP")
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0
