"""High-water-mark landing and streaming ingest (fresh folders per test)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voltstream.operators.incremental import append_high_water_mark, land_increment, read_high_water_mark, since
from voltstream.plans import fixtures
from voltstream.sources.csv import read_ocpp_csv, write_snapshot_csv
from voltstream.streaming.ingest import append_stream, stream_master_csv, stream_ocpp_csv


def test_mark_roundtrip_and_since(spark, tmp_base):
    marks = f"{tmp_base}/marks"
    assert read_high_water_mark(spark, marks) is None
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], "id int, request_date timestamp")
    assert since(df, None).count() == 2            # fixed: no mark → full load
    assert since(df, None, mode="faithful").count() == 0  # faithful: NULL comparison → nothing
    append_high_water_mark(spark, marks, dt.datetime(2024, 1, 1))
    append_high_water_mark(spark, marks, dt.datetime(2023, 1, 1))
    mark = read_high_water_mark(spark, marks)
    assert mark == dt.datetime(2024, 1, 1)
    assert [r.id for r in since(df, mark).collect()] == [2]  # strict: ties at the mark are not re-loaded
    assert since(df, mark, overlap="1 day").count() == 2


def test_land_increment_twice(spark, tmp_base):
    lines = fixtures.ocpp_from_events(fixtures.table(spark, SF_SMALL, "events"))
    landing, marks = f"{tmp_base}/landing", f"{tmp_base}/marks"
    early = lines.filter(F.col("request_date") < F.lit("2024-01-16").cast("timestamp"))
    r1 = land_increment(spark, early, landing, marks, load_id="1")
    r2 = land_increment(spark, lines, landing, marks, load_id="2")
    r3 = land_increment(spark, lines, landing, marks, load_id="3")
    total = lines.count()
    assert r1["rows"] + r2["rows"] == total and r3["rows"] == 0
    landed = read_ocpp_csv(spark, f"{landing}/load=*/dt=*/")
    assert landed.count() == total
    assert landed.filter(F.col("_rescued_data").isNotNull() | F.col("id").isNull()).select("id", "_rescued_data").count() == 0
    # raw logs survive the CSV round trip byte for byte (quotes, newlines)
    a = lines.select("id", "raw_log").exceptAll(landed.select("id", "raw_log"))
    assert a.count() == 0


def test_stream_bronze_only_new_files(spark, tmp_base):
    lines = fixtures.ocpp_from_events(fixtures.table(spark, SF_SMALL, "events"))
    landing, marks = f"{tmp_base}/landing", f"{tmp_base}/marks"
    bronze, ckpt = f"{tmp_base}/bronze", f"{tmp_base}/ckpt"
    early = lines.filter(F.col("request_date") < F.lit("2024-01-16").cast("timestamp"))
    land_increment(spark, early, landing, marks, load_id="1")
    # a master file in the landing zone must not enter bronze
    write_snapshot_csv(fixtures.master_from_tables(spark, SF_SMALL), f"{landing}/master_data")
    src = f"{landing}/load=*/dt=*/"
    append_stream(stream_ocpp_csv(spark, src), bronze, ckpt)
    n1 = spark.read.parquet(bronze).count()
    assert n1 == early.count()
    append_stream(stream_ocpp_csv(spark, src), bronze, ckpt)  # nothing new
    assert spark.read.parquet(bronze).count() == n1
    land_increment(spark, lines, landing, marks, load_id="2")
    append_stream(stream_ocpp_csv(spark, src), bronze, ckpt)
    b = spark.read.parquet(bronze)
    assert b.count() == lines.count()
    assert b.select("id").distinct().count() == lines.count()
    assert b.filter(F.col("source_file").contains("load=2")).count() == lines.count() - n1
    assert b.filter(F.col("ingest_load_timestamp").isNull()).count() == 0


def test_stream_master(spark, tmp_base):
    m = fixtures.master_from_tables(spark, SF_SMALL)
    write_snapshot_csv(m, f"{tmp_base}/landing/master_data")
    append_stream(stream_master_csv(spark, f"{tmp_base}/landing/master_data"), f"{tmp_base}/master", f"{tmp_base}/ckpt")
    got = spark.read.parquet(f"{tmp_base}/master")
    assert got.columns == [*m.columns, "MASTER_LOAD_TIME", "ingest_batch"] and got.filter("MASTER_LOAD_TIME is null").count() == 0
    got = got.drop("MASTER_LOAD_TIME", "ingest_batch")
    assert got.exceptAll(m).count() == 0 and m.exceptAll(got).count() == 0


def test_malformed_rows_are_rescued(spark, tmp_base):
    """Bad fields keep their text in ``_rescued_data``, rows that can't be split their whole text; nothing raises."""
    from voltstream.operators import bronze

    path = f"{tmp_base}/bad"
    text = (
        "id,request_uuid,request_date,entity_id,service_provider_id,raw_log,serial_number,identity_key\n"
        '1,u1,2024-01-01T00:00:07.179Z,7,1,"01-Jan-2024 00:00:07.179 [2,""1"",""Heartbeat"",{}]@@EOM@@",SN,CS1\n'
        'x9,u2,not-a-date,7,1,"line with\nnewline",SN,CS1\n'
        "3,u3,2024-01-01T00:00:08.000Z,7,1,short\n"
    )
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    got = read_ocpp_csv(spark, path).cache()
    rows = {r.request_uuid: r for r in got.collect()}
    assert rows["u1"]._rescued_data is None and rows["u1"].raw_log.endswith("@@EOM@@") and '"1"' in rows["u1"].raw_log
    assert json.loads(rows["u2"]._rescued_data) == {"id": "x9", "request_date": "not-a-date"} and rows["u2"].id is None
    assert rows["u2"].raw_log == "line with\nnewline" and rows["u2"].identity_key == "CS1"
    assert json.loads(rows["u3"]._rescued_data) == {"_row": "3,u3,2024-01-01T00:00:08.000Z,7,1,short"} and rows["u3"].id == 3  # too few fields
    conformed = bronze.conform(bronze.add_ingest_metadata(got, source_file=F.lit("f"))).collect()
    assert len(conformed) == 3


def test_silver_branches_prune_bronze_by_frame_kind(spark, tmp_base):
    """On bronze partitioned by frame kind, the request and result branches read disjoint parts."""
    from voltstream.operators.silver import to_silver
    from voltstream.plans.inspect import plan_text

    lines = fixtures.ocpp_from_events(fixtures.table(spark, SF_SMALL, "events"))
    land_increment(spark, lines, f"{tmp_base}/landing", f"{tmp_base}/marks", load_id="1")
    append_stream(stream_ocpp_csv(spark, f"{tmp_base}/landing/load=*/dt=*/"), f"{tmp_base}/bronze", f"{tmp_base}/ckpt",
                  partition_by=["load", "frame_kind"])
    b = spark.read.parquet(f"{tmp_base}/bronze")
    s = to_silver(b, fixtures.master_from_tables(spark, SF_SMALL))
    filters = [line for line in plan_text(s).splitlines() if line.startswith("PartitionFilters")]
    assert any("frame_kind" in f and "Contains(" in f and ", 2)" in f for f in filters)
    assert any("frame_kind" in f and "Contains(" in f and ", 3)" in f for f in filters)
    unpartitioned = to_silver(b.drop("frame_kind"), fixtures.master_from_tables(spark, SF_SMALL))
    a, c = s.drop("STAGE_LOAD_TIMESTAMP"), unpartitioned.drop("STAGE_LOAD_TIMESTAMP")
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0
