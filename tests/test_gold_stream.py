"""Per-load and streamed gold against the batch plan."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, bronze_rows, master_rows
from voltstream import schemas
from voltstream.operators import bronze as bronze_ops
from voltstream.operators.incremental import land_increment
from voltstream.operators.silver import to_silver
from voltstream.plans import catalog_loads, fixtures, medallion
from voltstream.plans.inspect import plan_text
from voltstream.streaming.gold_stream import run_gold_stream

SAME = [c for c in schemas.SILVER_COLUMNS if c not in ("INGEST_LOAD_TIMESTAMP", "STAGE_LOAD_TIMESTAMP")]


def equal(a, b):
    a, b = a.select(*SAME), b.select(*SAME)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def keyed(df, load):
    return bronze_ops.add_frame_keys(df, load=load)


def test_stream_equals_batch_after_every_run(spark, tmp_base):
    stamp = medallion.fixed_stamp()
    lines = fixtures.ocpp_from_events(fixtures.table(spark, SF_SMALL, "events"))
    master = fixtures.master_from_tables(spark, SF_SMALL)
    landing, marks = f"{tmp_base}/landing", f"{tmp_base}/marks"
    early = lines.filter(F.col("request_date") < F.lit("2024-01-16").cast("timestamp"))
    for load, rows in (("1", early), ("2", lines)):
        land_increment(spark, rows, landing, marks, load_id=load)
        run_gold_stream(spark, f"{landing}/load=*/dt=*/", master, f"{tmp_base}/bronze", f"{tmp_base}/gold", f"{tmp_base}/ckpt", f"{tmp_base}/stage", stamp=stamp)
        bronze = bronze_ops.conform(bronze_ops.add_ingest_metadata(rows, source_file=F.lit("f")))
        assert equal(spark.read.parquet(f"{tmp_base}/gold"), to_silver(bronze, master, stage_time=stamp))


def test_late_offline_upload_and_late_results(spark, tmp_base):
    """Request hours late with its result in the same file; a result in a load of its own, much later; a late request."""
    master = master_rows(spark, [("CS1", 1, "ACME")])
    loads = {
        "1": [(1, "CS1", '15-Jan-2024 10:00:00.000 [2,"9","StartTransaction",{"idTag":"T"}]@@EOM@@'),
              (2, "CS1", '15-Jan-2024 10:00:00.000 [2,"1","Heartbeat",{}]@@EOM@@')],
        "2": [(3, "CS1", '15-Jan-2024 07:00:00.000 [2,"5","Heartbeat",{}]@@EOM@@'),
              (4, "CS1", '15-Jan-2024 07:00:01.000 [3,"5",{"currentTime":"2024-01-15T07:00:01Z"}]@@EOM@@')],
        "3": [(5, "CS1", '15-Jan-2024 10:20:00.000 [3,"9",{"transactionId":"5"}]@@EOM@@')],
        "4": [(6, "CS1", '15-Jan-2024 10:10:00.000 [2,"9","StartTransaction",{"idTag":"U"}]@@EOM@@')],
    }
    bronze, gold = None, f"{tmp_base}/gold"
    for load, rows in loads.items():
        part = keyed(bronze_rows(spark, rows), F.lit(load))
        bronze = part if bronze is None else bronze.unionByName(part)
        medallion.merge_into_gold_table(gold, medallion.silver_increment(bronze, load, master), f"{tmp_base}/stage")
        assert equal(spark.read.parquet(gold), to_silver(bronze, master)), load
    by = {r.SOURCE_ID: r for r in spark.read.parquet(gold).collect()}
    assert by["6"].TRANSACTION_ID == 5 and by["1"].TRANSACTION_ID is None and by["3"].UNIFIED_TIMESTAMP_SOURCE == "payload"


def test_frames_that_share_a_line_with_a_partner_stay_paired(spark, tmp_base):
    """A line with two calls, the result of the second, then the result of the first; results without a bronze id."""
    master = master_rows(spark, [("CS1", 1, "ACME")])
    loads = {
        "1": [(1, "CS1", '15-Jan-2024 10:00:00.000 [2,"A","StartTransaction",{"idTag":"T"}]@@EOM@@[2,"B","StartTransaction",{"idTag":"U"}]@@EOM@@')],
        "2": [(2, "CS1", '15-Jan-2024 10:00:01.000 [3,"B",{"transactionId":"7"}]@@EOM@@')],
        "3": [(3, "CS1", '15-Jan-2024 10:00:02.000 [3,"A",{"transactionId":"8"}]@@EOM@@')],
        "4": [(None, "CS1", '15-Jan-2024 11:00:01.000 [3,"C",{"transactionId":"9"}]@@EOM@@')],
        "5": [(5, "CS1", '15-Jan-2024 11:00:00.000 [2,"C","StartTransaction",{"idTag":"V"}]@@EOM@@')],
    }
    bronze, gold = None, f"{tmp_base}/gold"
    for load, rows in loads.items():
        part = keyed(bronze_rows(spark, rows), F.lit(load))
        bronze = part if bronze is None else bronze.unionByName(part)
        medallion.merge_into_gold_table(gold, medallion.silver_increment(bronze, load, master), f"{tmp_base}/stage")
        assert equal(spark.read.parquet(gold), to_silver(bronze, master)), load
    assert {r.SOURCE_ID: r.TRANSACTION_ID for r in spark.read.parquet(gold).collect()} == {"1": 8, "1#1": 7, "5": 9}


def test_whole_rows_are_read_only_from_loads_with_partners(spark, tmp_base):
    catalog_loads._as_bronze(catalog_loads.reused_id_lines(spark, SF_SMALL)).withColumn(
        "identity_key", F.when(F.col("load") == "0", F.concat(F.lit("other-"), F.col("identity_key"))).otherwise(F.col("identity_key"))
    ).write.partitionBy(*bronze_ops.PARTITIONS).parquet(f"{tmp_base}/bronze")
    bronze = spark.read.schema(spark.read.parquet(f"{tmp_base}/bronze").schema).parquet(f"{tmp_base}/bronze")
    plan = plan_text(medallion.silver_increment(bronze.withColumn("load", F.col("load").cast("string")), "1", fixtures.master_from_tables(spark, SF_SMALL)))
    scans = [s for s in plan.split("Scan parquet")[1:] if "raw_log" in s.split("ReadSchema")[-1].splitlines()[0]]
    assert scans and all("load" in line for s in scans for line in s.splitlines() if line.startswith("PartitionFilters"))


def test_a_stream_leaves_no_scratch_files(spark, tmp_base):
    """What a batch stages, and what its silver is read from, is gone once gold has it."""
    from voltstream.sources.tables import folder_exists

    lines = fixtures.ocpp_from_events(fixtures.table(spark, SF_SMALL, "events").limit(50))
    land_increment(spark, lines, f"{tmp_base}/landing", f"{tmp_base}/marks", load_id="1")
    run_gold_stream(spark, f"{tmp_base}/landing/load=*/dt=*/", fixtures.master_from_tables(spark, SF_SMALL), f"{tmp_base}/bronze", f"{tmp_base}/gold",
                    f"{tmp_base}/ckpt", f"{tmp_base}/stage", stamp=medallion.fixed_stamp())
    assert folder_exists(spark, f"{tmp_base}/gold")
    assert spark._jvm.org.apache.hadoop.fs.Path(f"{tmp_base}/stage").getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(
        spark._jvm.org.apache.hadoop.fs.Path(f"{tmp_base}/stage")).getFileCount() == 0
