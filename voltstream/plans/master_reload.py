"""What a master reload changes in gold.

A message takes the master data valid at its own time (``silver.master_versions``). A reload can bring values for
times that loads already built have covered, and stations that had none (their messages were dropped by the inner
join). ``apply_reload`` corrects both, so that per-load gold equals a batch build over all master loads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream import schemas
from voltstream.operators import silver
from voltstream.plans import load_tables
from voltstream.plans.medallion import GOLD_PARTITION, merge_into_gold_table
from voltstream.session import run_dir
from voltstream.sources.tables import read_parquet_if_exists

_SPAN = ["OCPP_CHARGE_STATION_ID", *silver.MASTER_KEEP, "valid_from", "valid_to"]


def changed_stations(before: DataFrame, after: DataFrame) -> DataFrame:
    """Stations whose versions differ: station, ``since`` (first time that may differ, NULL: all time), ``is_new``."""
    old, new = silver.master_versions(before), silver.master_versions(after)
    spans = old.select(*_SPAN, F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionByName(new.select(*_SPAN, F.lit(0).alias("_old"), F.lit(1).alias("_new")))
    differ = spans.groupBy(*_SPAN).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new")).filter(F.col("_old") != F.col("_new"))
    # a span that only got an end differs from that end on
    told = differ.groupBy("OCPP_CHARGE_STATION_ID", *silver.MASTER_KEEP, "valid_from").agg(
        F.sum("_old").alias("_old"), F.sum("_new").alias("_new"), F.min("valid_to").alias("_end"))
    cut = (F.col("_old") > 0) & (F.col("_new") > 0)
    told = told.withColumn("_since", F.when(cut, F.col("_end")).otherwise(F.col("valid_from"))).withColumn("_always", ~cut & F.col("valid_from").isNull())
    stations = told.groupBy("OCPP_CHARGE_STATION_ID").agg(F.min("_since").alias("_since"), F.max("_always").alias("_always"))
    known = old.select(F.col("OCPP_CHARGE_STATION_ID").alias("_known")).distinct()
    stations = stations.join(known, F.col("OCPP_CHARGE_STATION_ID") == F.col("_known"), "left")
    return stations.select(F.col("OCPP_CHARGE_STATION_ID").alias("station"), F.when(~F.col("_always"), F.col("_since")).alias("since"), F.col("_known").isNull().alias("is_new"))


def apply_reload(spark: SparkSession, gold_path: str, tables: load_tables.LoadTables, before: DataFrame, after: DataFrame, stage_path: str,
                 stamp: Column | None = None) -> dict:
    """Bring gold, built with ``before``, to what it is with ``after`` (all master loads known now).

    Rows of stations known before get the new values from the gold days on that can differ (other days are not read);
    messages of new stations are built from their stored frames. Both go through the usual merge of touched days.
    """
    base = run_dir(spark, "reload")
    changed_stations(before, after).write.parquet(f"{base}/changed")
    changed = spark.read.parquet(f"{base}/changed")
    told = changed.agg(F.count(F.lit(1)).alias("n"), F.max(F.col("since").isNull() & ~F.col("is_new")).alias("always"),
                       F.min(F.when(~F.col("is_new"), F.col("since"))).alias("since"), F.max("is_new").alias("new")).first()
    done = {"stations": told["n"], "touched": []}
    gold = read_parquet_if_exists(spark, gold_path)
    if gold is not None and (told["always"] or told["since"] is not None):
        rows = gold if told["always"] else gold.filter(F.col(GOLD_PARTITION) >= F.to_date(F.lit(told["since"])))
        at = F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED")
        rows = rows.join(changed.filter("not is_new"), (F.col("CHARGE_STATION_ID") == F.col("station")) & (F.col("since").isNull() | (at >= F.col("since"))))
        versions = silver.master_versions(after).select(F.col("OCPP_CHARGE_STATION_ID").alias("_station"), *[F.col(c).alias(f"_{c}") for c in silver.MASTER_KEEP], "valid_from", "valid_to")
        valid = (F.col("valid_from").isNull() | (at >= F.col("valid_from"))) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
        rows = rows.join(versions, (F.col("CHARGE_STATION_ID") == F.col("_station")) & (valid | (at.isNull() & F.col("valid_from").isNull())))
        differs = F.lit(False)
        for c in silver.MASTER_KEEP:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
        rows = rows.filter(differs).select(*[F.col(f"_{c}").alias(c) if c in silver.MASTER_KEEP else F.col(c) for c in schemas.SILVER_COLUMNS])
        done["touched"] += merge_into_gold_table(gold_path, rows, stage_path, stamp=stamp)["touched"] or []
    if told["new"]:
        frames = load_tables.read(spark, tables, "frames")
        mine = frames.join(changed.filter("is_new").select("station"), F.col("identity_key") == F.col("station"), "left_semi")
        rows = silver.silver_from_frames(mine, after, stage_time=stamp)
        done["touched"] += merge_into_gold_table(gold_path, rows, stage_path, stamp=stamp)["touched"] or []
    return done
