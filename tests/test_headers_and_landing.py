"""CSV by header, and landing by ids."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voltstream import schemas
from voltstream.operators.incremental import land_increment, not_landed
from voltstream.plans import fixtures
from voltstream.plans.inspect import plan_text
from voltstream.sources.csv import file_headers, read_master_csv, read_ocpp_csv
from voltstream.streaming.ingest import append_stream, stream_master_csv, stream_ocpp_csv


def put(spark, path, text):
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w", encoding="utf-8") as f:
        f.write(text)


def test_swapped_master_columns(spark, tmp_base):
    put(spark, f"{tmp_base}/m/1", "CONNECTOR_ID,OCPP_CHARGE_STATION_ID\n7,CS-1\n")
    put(spark, f"{tmp_base}/m/2", "﻿ ocpp_charge_station_id , COLOUR,CONNECTOR_ID,COLOUR\nCS-2,red,8,blue\nCS-3,,9,\n")
    want = {"CS-1": ("7", None), "CS-2": ("8", {"COLOUR": "red", "COLOUR#2": "blue"}), "CS-3": ("9", None)}
    batch = read_master_csv(spark, f"{tmp_base}/m/*/")
    append_stream(stream_master_csv(spark, f"{tmp_base}/m/*/"), f"{tmp_base}/master", f"{tmp_base}/ckpt")
    for rows in (batch, spark.read.parquet(f"{tmp_base}/master")):
        got = {r.OCPP_CHARGE_STATION_ID: (r.CONNECTOR_ID, r._rescued_data and json.loads(r._rescued_data)) for r in rows.collect()}
        assert got == want
    assert batch.columns == schemas.MASTER_COLUMNS and batch.filter("MODEL is not null").count() == 0


def test_quoted_names_odd_file_names_and_empty_files(spark, tmp_base):
    put(spark, f"{tmp_base}/s/a b[1]{{x}}", '"id","raw_log","a ""b"""\n1,"x ""y"",\nz",q\nno,w,\n')
    put(spark, f"{tmp_base}/s/c", "")
    put(spark, f"{tmp_base}/s/d", "raw_log,id\n")
    put(spark, f"{tmp_base}/s/e", "raw_log,id\nv,5\ntoo,many,fields\n")
    assert sorted(map(sorted, file_headers(spark, f"{tmp_base}/s/*/"))) == [['a "b"', "id", "raw_log"], ["id", "raw_log"]]
    got = sorted(((r.id, r.raw_log, r._rescued_data and json.loads(r._rescued_data)) for r in read_ocpp_csv(spark, f"{tmp_base}/s/*/", with_file=True).collect()), key=str)
    assert got == [(1, 'x "y",\nz', {'a "b"': "q"}), (5, "v", None), (None, "too", {"id": "many", "_row": "too,many,fields"}), (None, "w", {"id": "no"})]
    assert read_ocpp_csv(spark, f"{tmp_base}/s/c").collect() == []


def test_files_of_any_header_arrive_in_one_stream(spark, tmp_base):
    base = "id,request_uuid,request_date,entity_id,service_provider_id,raw_log,serial_number,identity_key\n"
    put(spark, f"{tmp_base}/in/load=1/dt=x", base + "1,u,2024-01-01T00:00:07.179Z,7,1,log,SN,CS1\n")
    run = lambda: append_stream(stream_ocpp_csv(spark, f"{tmp_base}/in/load=*/dt=*/"), f"{tmp_base}/bronze", f"{tmp_base}/ckpt", partition_by=["load", "frame_kind"])
    run()
    put(spark, f"{tmp_base}/in/load=2/dt=x", "identity_key,id,extra\nCS2,2,e\n")
    run()
    run()
    got = sorted((r.id, r.identity_key, r.entity_id, r.load, r._rescued_data) for r in spark.read.parquet(f"{tmp_base}/bronze").collect())
    assert got == [(1, "CS1", 7, 1, None), (2, "CS2", None, 2, '{"extra":"e"}')]


def source(spark, rows):
    return spark.createDataFrame([(i, t and dt.datetime.fromisoformat(t), x) for i, t, x in rows], "id long, request_date timestamp, raw_log string")


def landed(spark, base):
    rows = read_ocpp_csv(spark, f"{base}/landing/load=*/dt=*/").select("id", "raw_log", F.regexp_extract(F.col("_metadata.file_path"), r"/load=([^/]+)/", 1).alias("load"))
    return sorted(((r.load, r.id, r.raw_log) for r in rows.collect()), key=str)


def test_ties_late_rows_and_rows_without_time_land_once(spark, tmp_base):
    args = (f"{tmp_base}/landing", f"{tmp_base}/marks")
    rows = [(1, "2024-01-10T10:00:00", "a"), (2, "2024-01-11T10:00:00", "b"), (None, "2024-01-11T10:00:00", "no id")]
    assert land_increment(spark, source(spark, rows), *args, load_id="1")["rows"] == 3
    rows += [(3, "2024-01-11T10:00:00", "tie"), (4, "2023-05-01T00:00:00", "late"), (5, None, "no time"), (None, None, "nothing")]
    got = land_increment(spark, source(spark, rows), *args, load_id="2", overlap=None)
    assert (got["rows"], got["mark"]) == (4, dt.datetime(2024, 1, 11, 10))
    assert land_increment(spark, source(spark, rows), *args, load_id="3") == {"load_id": "3", "rows": 0, "rescued": 0, "mark": None}
    assert landed(spark, tmp_base) == [("1", 1, "a"), ("1", 2, "b"), ("1", None, "no id"), ("2", 3, "tie"), ("2", 4, "late"), ("2", 5, "no time"), ("2", None, "nothing")]


def test_overlap_bounds_the_age_and_the_days_read(spark, tmp_base):
    args = (f"{tmp_base}/landing", f"{tmp_base}/marks")
    rows = [(d, f"2024-01-{d:02d}T10:00:00", "x") for d in range(1, 21)]
    land_increment(spark, source(spark, rows), *args, load_id="1")
    rows += [(100, "2024-01-18T00:00:00", "late"), (101, "2024-01-02T00:00:00", "too late"), (102, "2024-01-20T10:00:00", "tie"), (103, None, "no time")]
    known = spark.read.parquet(f"{tmp_base}/marks__ids")
    plan = plan_text(not_landed(source(spark, rows), known, dt.datetime(2024, 1, 20, 10), overlap="3 days"))
    assert any("dt" in line and "2024-01-17" in line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert land_increment(spark, source(spark, rows), *args, load_id="2", overlap="3 days")["rows"] == 3
    assert sorted(x[1] for x in landed(spark, tmp_base) if x[0] == "2") == [100, 102, 103]


def test_faithful_landing_keeps_the_strict_mark(spark, tmp_base):
    args = (f"{tmp_base}/landing", f"{tmp_base}/marks")
    rows = [(1, "2024-01-10T10:00:00", "a")]
    assert land_increment(spark, source(spark, rows), *args, load_id="1", mode="faithful")["rows"] == 0  # no mark: NULL comparison
    land_increment(spark, source(spark, rows), *args, load_id="2")
    rows += [(2, "2024-01-10T10:00:00", "tie"), (3, "2024-01-10T10:00:01", "new")]
    assert land_increment(spark, source(spark, rows), *args, load_id="3", mode="faithful")["rows"] == 1


@pytest.mark.parametrize("broken", [True, False])
def test_rescued_text_goes_along_to_bronze(spark, tmp_base, broken):
    lines = fixtures.ocpp_from_events(fixtures.table(spark, SF_SMALL, "events")).limit(40)
    text = lines.drop("_rescued_data").withColumn("entity_id", F.concat(F.lit("#" if broken else ""), F.col("entity_id").cast("string")))
    text.write.option("header", True).option("escape", '"').option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").csv(f"{tmp_base}/source")
    told = land_increment(spark, read_ocpp_csv(spark, f"{tmp_base}/source"), f"{tmp_base}/landing", f"{tmp_base}/marks", load_id="1")
    assert (told["rows"], told["rescued"]) == (40, 40 if broken else 0)
    append_stream(stream_ocpp_csv(spark, f"{tmp_base}/landing/load=*/dt=*/"), f"{tmp_base}/bronze", f"{tmp_base}/ckpt")
    rows = spark.read.parquet(f"{tmp_base}/bronze").collect()
    assert len(rows) == 40 and all((r.entity_id is None) == broken and (json.loads(r._rescued_data)["entity_id"].startswith("#") if broken else r._rescued_data is None) for r in rows)


def test_a_text_is_converted_once(spark, tmp_base):
    """A value, whether it has to be rescued, and the rescued text share one conversion."""
    from voltstream.sources.csv import read_ocpp_csv, write_csv

    write_csv(spark.createDataFrame([("1", "nonsense"), ("x", "2024-01-01T00:00:00.000Z")], "id string, request_date string"), f"{tmp_base}/c")
    rows = read_ocpp_csv(spark, f"{tmp_base}/c")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") + plan.count("try_to_timestamp(") == 1
    assert sorted((r.id or 0, r.request_date is None, r._rescued_data) for r in rows.collect()) == [(0, False, '{"id":"x"}'), (1, True, '{"request_date":"nonsense"}')]


def test_landing_keeps_no_second_copy_of_the_rows(spark, tmp_base):
    """Staged rows go once they are landed, as gzip files; known days are searched by id, others not, rows without a day too."""
    from voltstream.session import FRUGAL
    from voltstream.sources.tables import folder_exists

    args = (f"{tmp_base}/landing", f"{tmp_base}/marks")
    before = {k: spark.conf.get(k, None) for k in FRUGAL}
    rows = [(1, None, "no time"), (2, None, "no time")]
    assert land_increment(spark, source(spark, rows), *args, load_id="1")["rows"] == 2
    rows += [(3, "2024-01-10T10:00:00", "a"), (4, None, "late")]
    assert land_increment(spark, source(spark, rows), *args, load_id="2")["rows"] == 2
    rows += [(5, "2024-01-10T11:00:00", "known day"), (6, "2024-01-11T10:00:00", "new day"), (6, "2024-01-11T10:00:00", "twice")]
    assert land_increment(spark, source(spark, rows), *args, load_id="3")["rows"] == 3
    assert land_increment(spark, source(spark, rows), *args, load_id="4")["rows"] == 0
    assert landed(spark, tmp_base) == sorted([("1", 1, "no time"), ("1", 2, "no time"), ("2", 3, "a"), ("2", 4, "late"), ("3", 5, "known day"), ("3", 6, "new day"), ("3", 6, "twice")], key=str)
    assert all(f.endswith(".csv.gz") for f in spark.read.text(f"{tmp_base}/landing/load=*/dt=*/").inputFiles())
    for n in "1234":
        assert not [x for x in os.listdir(f"{tmp_base}/marks__increment".removeprefix("file://").removeprefix("file:")) if x.startswith(f"{n}-")]
    assert folder_exists(spark, f"{tmp_base}/marks__ids") and {k: spark.conf.get(k, None) for k in FRUGAL} == before
