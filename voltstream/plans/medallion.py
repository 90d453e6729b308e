"""End-to-end plans: bronze → silver → gold, on the driver's tables.

``silver_from_tables`` writes the parsed frames once (three branches of its plan read them), the rest of the
``*_from_tables`` plans stays lazy. ``gold_from_tables`` is what a first
MERGE into an empty gold table yields: the latest silver row per (SOURCE,
SOURCE_ID), stamped. The per-load steps write: a merge stages and swaps, and
``silver_increment`` collects the loads that hold partners of the new rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream import schemas
from voltstream.operators import merge, silver
from voltstream.operators.dedup import latest_by_key
from voltstream.plans import fixtures, load_tables
from voltstream.session import run_dir, settings

#: which silver row survives per key: the latest load, then the latest gateway time
SILVER_ORDER = ("STAGE_LOAD_TIMESTAMP", "INGEST_LOAD_TIMESTAMP", "SOURCE_MESSAGE_TIMESTAMP_CREATED", "CORE_MESSAGE_UNIQUE_ID")



def fixed_stamp() -> Column:
    """A constant load stamp for reproducible test and oracle runs."""
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def silver_from_tables(
    spark: SparkSession, sf_dir: str, mode: str = "fixed", stage_time: Column | None = None
) -> DataFrame:
    bronze = fixtures.bronze_from_events(spark, sf_dir, ingest_time=stage_time)
    master = fixtures.master_from_tables(spark, sf_dir)
    return stored_silver(bronze, master, mode=mode, stage_time=stage_time)


def stored_silver(
    bronze: DataFrame,
    master: DataFrame,
    mode: str = "fixed",
    stage_time: Column | None = None,
    wanted: Callable[[DataFrame], DataFrame] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``silver.to_silver`` over stored frames: parsed and written once by kind, then requests, calls and results each
    read their part. ``keep`` names bronze columns that ``wanted`` needs. ``faithful`` parses lines, not frames."""
    if mode != "fixed":
        return silver.to_silver(bronze, master, mode=mode, stage_time=stage_time, wanted=wanted)
    path, spark = run_dir(bronze.sparkSession, "frames"), bronze.sparkSession
    rows = load_tables.frame_rows(bronze, keep=keep)
    with settings(spark, load_tables.CONCURRENT_KINDS):
        rows.write.partitionBy(load_tables.KIND).parquet(path)
    return silver.silver_from_frames(spark.read.schema(rows.schema).parquet(path), master, mode, stage_time=stage_time, wanted=wanted)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, for plans that read it several times."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_gold(silver_df: DataFrame, stamp: Column | None = None, dedup: bool = True) -> DataFrame:
    """Gold contents after merging ``silver_df`` into an empty gold table."""
    if stamp is None:
        stamp = F.current_timestamp()
    rows = latest_by_key(silver_df, schemas.GOLD_KEY, SILVER_ORDER) if dedup else silver_df
    return rows.withColumn("STAGE_PROCESSED_TIMESTAMP", stamp).select(*schemas.GOLD_COLUMNS)


def gold_from_tables(spark: SparkSession, sf_dir: str, mode: str = "fixed", stamp: Column | None = None) -> DataFrame:
    s = silver_from_tables(spark, sf_dir, mode=mode, stage_time=stamp)
    # a faithful MERGE into an empty table inserts duplicate source keys as they come
    return first_gold(s, stamp=stamp, dedup=(mode == "fixed"))


def merge_into_gold(gold: DataFrame, silver_df: DataFrame, stamp: Column | None = None, mode: str = "fixed") -> DataFrame:
    """Gold after MERGE of a silver increment (SK9)."""
    return merge.upsert(
        gold, silver_df, schemas.GOLD_KEY, stamp_column="STAGE_PROCESSED_TIMESTAMP", stamp=stamp,
        order=SILVER_ORDER, mode=mode,
    )


#: gold partition column: the gateway day of the message (immutable per key)
GOLD_PARTITION = "dt"


def gold_partition_value() -> Column:
    return F.to_date(F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED"))


def merge_into_gold_table(
    gold_path: str, silver_df: DataFrame, stage_path: str, stamp: Column | None = None, locate: str = "same_partition",
    arranged: bool = False,
) -> dict:
    """MERGE a silver increment into the day-partitioned gold table, rewriting touched days only.

    A gold row's day is the day of its gateway time, which is part of the
    immutable log line behind its key, so by default only the increment's
    days are read and rewritten (no table-wide key scan). Rows without a key
    go to ``<gold_path>__quarantine``. ``arranged``: ``silver_df`` is arranged by
    ``gold_partition_value`` (see ``merge_partitions``).
    """
    from voltstream.operators.merge import merge_partitions

    return merge_partitions(
        gold_path, silver_df, schemas.GOLD_KEY, GOLD_PARTITION, gold_partition_value(), stage_path,
        stamp_column="STAGE_PROCESSED_TIMESTAMP", stamp=stamp, order=SILVER_ORDER, locate=locate,
        quarantine_path=f"{gold_path.rstrip('/')}__quarantine", arranged=arranged,
    )


def silver_increment(
    bronze: DataFrame,
    load: str,
    master: DataFrame,
    stage_time: Column | None = None,
    mode: str = "fixed",
) -> DataFrame:
    """Silver rows that a new bronze load adds or changes, paired as in a full build.

    A new line can change any request of its (station, message id): a late
    result fills one in, a late request takes a result from another. So the
    increment is the new load's requests and all earlier requests with the same
    (station, message id), whenever they came; re-merging those into gold is
    idempotent. There is no time window: a result landed months later pairs.
    An earlier line is read whole, but its requests with other message ids
    are left out: their results are not among the lines read, and gold has
    them paired already.

    ``bronze`` has the columns of ``bronze.add_frame_keys`` and is partitioned
    by load and kind. Partners are looked up in the narrow key columns
    (``identity_key``, ``message_ids``, ``id``, the partition columns); whole
    rows are read only from the loads that hold some (a list of loads is
    collected), so for the usual load that is the load itself and the one before.

    This works on any bronze DataFrame. ``plans.load_tables`` keeps frames and keys as tables, reads the touched key
    buckets only and emits only the earlier requests whose answer changes.
    """
    key = ["identity_key", "_mid"]
    narrow = bronze.select("load", "id", "identity_key", F.explode("message_ids").alias("_mid")).filter(F.col("identity_key").isNotNull())
    spark, base = bronze.sparkSession, run_dir(bronze.sparkSession, "increment")

    def once(df: DataFrame, name: str) -> DataFrame:
        """Written, as several branches of the plan read it."""
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    keys = once(narrow.filter(F.col("load") == load).select(*key).distinct(), "keys")
    partners = once(narrow.filter(F.col("load") != load).join(keys, key, "left_semi").select(
        F.col("load").alias("_load"), F.col("id").alias("_id"), F.col("identity_key").alias("_station")).distinct(), "partners")
    loads = [r[0] for r in partners.select("_load").distinct().collect()]
    rows = bronze.filter(F.col("load") == load)
    if not loads:
        return silver.to_silver(rows, master, mode=mode, stage_time=stage_time)
    # a line without an id stands for all such lines of its load and station
    rows = rows.unionByName(bronze.filter(F.col("load").isin(loads)).join(
        partners, (F.col("load") == F.col("_load")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("identity_key") == F.col("_station")), "left_semi"))

    def wanted(reqs: DataFrame) -> DataFrame:
        known = keys.select(F.col("identity_key").alias("_station"), "_mid", F.lit(True).alias("_known"))
        reqs = reqs.join(known, (F.col("identity_key") == F.col("_station")) & (F.col("OCPP_MESSAGE_UNIQUE_ID") == F.col("_mid")), "left")
        return reqs.filter((F.col("load") == load) | F.col("_known")).drop("_station", "_mid", "_known")

    return silver.to_silver(rows, master, mode=mode, stage_time=stage_time, wanted=wanted)
