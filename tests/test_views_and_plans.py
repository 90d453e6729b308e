"""Views on the sf0.001 pipeline and the shape of their physical plans."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voltstream.plans import medallion, views
from voltstream.plans.inspect import plan_text


def gold_table(spark, base):
    g = medallion.gold_from_tables(spark, SF_SMALL, stamp=medallion.fixed_stamp())
    g.write.parquet(f"{base}/gold")
    return spark.read.parquet(f"{base}/gold")


def test_views_columns(spark, tmp_base):
    gold = gold_table(spark, tmp_base)
    reg = views.register_views(gold)
    assert reg["charger_heartbeats"].columns == ["CHARGE_STATION_ID", "date", "heartbeat_count", "was_down"]
    assert reg["charging_session_errors"].columns == ["MANUFACTURER", "error_count", "OCPP_ERROR_CODE", "VENDOR_ERROR_CODE"]
    assert reg["ev_transaction_units"].columns == [
        "ID_TAG", "CHARGE_STATION_ID", "METER_START", "METER_STOP", "units_consumed", "start_time", "stop_time"]
    assert reg["charging_session_duration"].columns == [
        "TRANSACTION_ID", "CHARGE_STATION_ID", "session_start", "session_end", "session_duration"]
    assert spark.sql("SELECT * FROM energy_consumption_by_charger").count() > 0
    # energy is the constant meter value times the row count (as published)
    e = views.energy_consumption_by_charger(gold).agg(F.sum("total_energy_consumed")).first()[0]
    assert e == 43099.0 * gold.count()


def test_view_plans_prune_and_push_down(spark, tmp_base):
    gold = gold_table(spark, tmp_base)
    p = plan_text(views.charger_heartbeats(gold))
    assert "PushedFilters: [IsNotNull(OCPP_ACTION), EqualTo(OCPP_ACTION,Heartbeat)]" in p
    scan_schema = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "METERVALUE" not in scan_schema and "OCPP_REQUEST_MESSAGE" not in scan_schema
    assert "partial_count" in p


def test_no_pairs_blowup_in_transaction_units(spark, tmp_base):
    gold = gold_table(spark, tmp_base)
    p = plan_text(views.ev_transaction_units(gold))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    stops = gold.filter(F.col("OCPP_ACTION") == "StopTransaction").count()
    assert views.ev_transaction_units(gold).count() <= stops


def test_totals_equal_all_pairs_on_small_data(spark, tmp_base):
    """Brute force (all pairs) on the small fixture equals the linear totals."""
    gold = gold_table(spark, tmp_base)
    s = gold.filter(F.col("OCPP_ACTION") == "StartTransaction").select("ID_TAG", "CHARGE_STATION_ID", "METER_START")
    p = gold.filter(F.col("OCPP_ACTION") == "StopTransaction").select("ID_TAG", "CHARGE_STATION_ID", "METER_STOP")
    brute = s.join(p, ["ID_TAG", "CHARGE_STATION_ID"]).groupBy("ID_TAG", "CHARGE_STATION_ID").agg(
        F.count(F.lit(1)).alias("pair_count"),
        F.sum(F.col("METER_STOP") - F.col("METER_START")).cast("double").alias("total_units_consumed"))
    fast = views.ev_transaction_units_totals(gold)
    assert sorted(brute.collect()) == sorted(fast.collect())


def test_silver_plan_single_scan_per_branch(spark):
    s = medallion.silver_from_tables(spark, SF_SMALL, stage_time=medallion.fixed_stamp())
    p = plan_text(s)
    import re

    scans = re.findall(r"^\(\d+\) Scan parquet", p, flags=re.M)
    # events for requests, and for calls and results (shown twice: the as-of's two branches share one shuffle); customer, nation
    assert len(scans) <= 7
    s.collect()
    assert "ReusedExchange" in plan_text(s) or "ResultQueryStage" not in plan_text(s)
    assert "CartesianProduct" not in p


def test_no_single_partition_exchange_in_main_plans(spark, tmp_base):
    """No step funnels all rows through one task (global sort / single-partition exchange)."""
    gold = gold_table(spark, tmp_base)
    s = medallion.silver_from_tables(spark, SF_SMALL, stage_time=medallion.fixed_stamp())
    plans = [plan_text(s), plan_text(medallion.first_gold(s))] + [plan_text(fn(gold)) for fn in views.VIEWS.values()]
    for p in plans:
        assert "SinglePartition" not in p
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_master_read_csv_batch(spark, tmp_base):
    from voltstream.plans import fixtures
    from voltstream.sources.csv import read_master_csv, write_snapshot_csv

    m = fixtures.master_from_tables(spark, SF_SMALL)
    write_snapshot_csv(m, f"{tmp_base}/master")
    got = read_master_csv(spark, f"{tmp_base}/master")
    assert got.columns == m.columns
    assert got.exceptAll(m).count() == 0 and m.exceptAll(got).count() == 0


def test_gold_merge_idempotent(spark, tmp_base):
    """Merging the same silver increment twice leaves gold unchanged apart from the stamp."""
    s = medallion.silver_from_tables(spark, SF_SMALL, stage_time=medallion.fixed_stamp())
    path = f"{tmp_base}/merged"
    medallion.merge_into_gold_table(path, s, f"{tmp_base}/s0", stamp=medallion.fixed_stamp())
    first = [tuple(r) for r in spark.read.parquet(path).drop("STAGE_PROCESSED_TIMESTAMP").collect()]
    inc = s.filter(F.col("OCPP_ACTION") == "Heartbeat")
    medallion.merge_into_gold_table(path, inc, f"{tmp_base}/s1", stamp=F.lit("2030-01-01").cast("timestamp"))
    medallion.merge_into_gold_table(path, inc, f"{tmp_base}/s2", stamp=F.lit("2030-01-01").cast("timestamp"))
    g = spark.read.parquet(path)
    again = [tuple(r) for r in g.drop("STAGE_PROCESSED_TIMESTAMP").collect()]
    assert sorted(map(str, first)) == sorted(map(str, again))
    n_hb = inc.count()
    assert g.filter(F.col("STAGE_PROCESSED_TIMESTAMP") == F.lit("2030-01-01").cast("timestamp")).count() == n_hb


def test_silver_reads_frames_that_are_parsed_once(spark):
    """Requests, calls and results read stored frames: no branch renders and parses the events again."""
    p = plan_text(medallion.silver_from_tables(spark, SF_SMALL, stage_time=medallion.fixed_stamp()))
    assert "events.parquet" not in p and "get_json_object" not in p
    assert "frames-" in p


def test_events_are_dealt_out_before_rendering(spark):
    from voltstream.plans import fixtures

    p = plan_text(fixtures.ocpp_from_events(fixtures.table(spark, SF_SMALL, "events")))
    assert "REPARTITION_BY_COL" in p
