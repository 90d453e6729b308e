"""A hot key holding a third of all rows: results stay exact and AQE splits the hot partition."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import BRONZE_COLS
from voltstream.operators import silver
from voltstream.plans.inspect import plan_text


def test_hot_key_pairing_is_split_and_exact(spark):
    n = 30000
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        mid = "7" if hot else str(100000 + i)
        st = "HOT" if hot else f"CS{i % 50}"
        t = (base + dt.timedelta(seconds=i)).strftime("%d-%b-%Y %H:%M:%S.000")
        rows.append((2 * i, f"u{i}", None, 1, 1, f'{t} [2,"{mid}","Heartbeat",{{}}]@@EOM@@', "SN", st, "f", None, None))
        if not hot or i < 6:  # the hot key has a few (duplicate) results; the earliest must win
            t2 = (base + dt.timedelta(seconds=i + 1)).strftime("%d-%b-%Y %H:%M:%S.000")
            body = f'{{"currentTime":"2024-02-01T00:00:{i % 60:02d}.000Z"}}'
            rows.append((2 * i + 1, f"r{i}", None, 1, 1, f'{t2} [3,"{mid}",{body}]@@EOM@@', "SN", st, "f", None, None))
    bronze = spark.createDataFrame(rows, BRONZE_COLS)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        parsed = silver.parse_frames(bronze)
        paired = silver.pair_responses(silver.requests(parsed), parsed)
        out = paired.select("id", "identity_key", "OCPP_RESPONSE_MESSAGE")
        got = out.collect()
        final = plan_text(out)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(got) == n  # no fan-out, no loss
    hot = [r for r in got if r.identity_key == "HOT"]
    assert len(hot) == n // 3
    # a result belongs to the latest call before it: the hot key's results (of events 0 and 3) answer those two calls
    assert {r.id: r.OCPP_RESPONSE_MESSAGE for r in hot if r.OCPP_RESPONSE_MESSAGE} == {
        2 * i: f'3,"7",{{"currentTime":"2024-02-01T00:00:{i:02d}.000Z"}}' for i in (0, 3)}
    assert "isFinalPlan=true" in final
    # rows are dealt by station, message id and hour; only the summaries (one row an hour) by station and message id
    assert any("_b#" in line for line in final.splitlines() if "hashpartitioning(identity_key" in line)
    assert F is not None


def test_id_that_all_stations_use_is_split_in_faithful_mode(spark):
    """Per-station counters make ids such as '1' common; faithful mode pairs by the id alone."""
    n = 30000
    rows = []
    for i in range(n):
        mid = "1" if i % 3 == 0 else str(i)
        rows.append((2 * i, f"u{i}", None, 1, 1, f'01-Jan-2024 00:00:00.000 [2,"{mid}","Heartbeat",{{}}]@@EOM@@', "SN", f"CS{i % 50}", "f", None, None))
    rows.append((1, "r", None, 1, 1, '01-Jan-2024 00:00:01.000 [3,"1",{"currentTime":"2024-02-01T00:00:00.000Z"}]@@EOM@@', "SN", "CS1", "f", None, None))
    bronze = spark.createDataFrame(rows, BRONZE_COLS)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        parsed = silver.parse_frames(bronze, "faithful")
        out = silver.pair_responses(silver.requests(parsed), parsed, "faithful").select("id", "OCPP_RESPONSE_MESSAGE")
        got = out.collect()
        final = plan_text(out)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(got) == n and sum(r.OCPP_RESPONSE_MESSAGE is not None for r in got) == n // 3 + 1
    assert "SortMergeJoin(skew=true)" in final


def test_hot_station_master_join_fallback_is_split(spark):
    from tests.conftest import master_rows

    n = 30000
    rows = []
    for i in range(n):
        st = "HOT" if i % 3 == 0 else f"CS{i % 50}"
        rows.append((i, f"u{i}", None, 1, 1, f'01-Jan-2024 00:00:00.000 [2,"{i}","Heartbeat",{{}}]@@EOM@@', "SN", st, "f", None, None))
    bronze = spark.createDataFrame(rows, BRONZE_COLS)
    master = master_rows(spark, [("HOT", 1, "H"), ("HOT", 2, "H")] + [(f"CS{j}", 1, "M") for j in range(50)])
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = silver.enrich_with_master(silver.requests(silver.parse_frames(bronze)), master)
        got = out.groupBy("MANUFACTURER").count().collect()
        out.collect()
        final = plan_text(out)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert {r.MANUFACTURER: r["count"] for r in got} == {"H": n // 3, "M": n - n // 3}
    assert "SortMergeJoin(skew=true)" in final
