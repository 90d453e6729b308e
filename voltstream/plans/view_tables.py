"""The views as tables kept up to date: partial aggregates per gold day, put together on read.

A merge rewrites the gold days that it touches, so only those days' partials are computed again (``refresh`` with the
days that ``merge_into_gold_table`` reports); reading a view adds up one row per key and day instead of scanning gold.
A day's partials replace the ones before, so a repeated refresh changes nothing, and ``refresh`` without days builds
everything anew.

Kept this way: the five views that are aggregates. ``ev_transaction_units`` pairs single rows and is read from gold.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.plans.medallion import GOLD_PARTITION
from voltstream.plans.views import DOWN_STATUS, ERROR_CODES, NO_VENDOR_ERROR
from voltstream.sources.tables import delete_folder, folder_exists


def _definitions() -> dict[str, tuple[Column | None, list, dict[str, Column], dict[str, Column]]]:
    """Per partial table: filter, keys, partial aggregates, and how partials are put together."""
    date = F.to_date("UNIFIED_TIMESTAMP").alias("date")
    error = (F.col("OCPP_ACTION") == "StatusNotification") & (F.col("OCPP_ERROR_CODE").isin(list(ERROR_CODES)) | (F.col("VENDOR_ERROR_CODE") != NO_VENDOR_ERROR))
    return {
        "charger_heartbeats": (F.col("OCPP_ACTION") == "Heartbeat", ["CHARGE_STATION_ID", date],
                               {"heartbeat_count": F.count(F.lit(1)), "was_down": F.max(F.when(F.col("STATUS") == DOWN_STATUS, 1).otherwise(0))},
                               {"heartbeat_count": F.sum("heartbeat_count"), "was_down": F.max("was_down")}),
        "charging_session_errors": (error, ["MANUFACTURER", "OCPP_ERROR_CODE", "VENDOR_ERROR_CODE"],
                                    {"error_count": F.count(F.lit(1))}, {"error_count": F.sum("error_count")}),
        "charging_session_duration": (F.col("TRANSACTION_ID").isNotNull(), ["TRANSACTION_ID", "CHARGE_STATION_ID"],
                                      {"session_start": F.min("UNIFIED_TIMESTAMP"), "session_end": F.max("UNIFIED_TIMESTAMP")},
                                      {"session_start": F.min("session_start"), "session_end": F.max("session_end")}),
        "daily_energy_consumption": (None, ["CHARGE_STATION_ID", date],
                                     {"total_energy_consumed": F.sum("METERVALUE_ENERGY_KWH")}, {"total_energy_consumed": F.sum("total_energy_consumed")}),
    }


def _name(key: Column | str) -> str:
    return key if isinstance(key, str) else "date"


def refresh(spark: SparkSession, gold_path: str, root: str, days: Sequence[_dt.date | None] | None = None) -> None:
    """Compute the partials of the named gold days (None among them: rows without a day), or of all days."""
    gold = spark.read.parquet(gold_path)
    if days is not None:
        if not days:
            return
        named = [d for d in days if d is not None]
        gold = gold.filter(F.col(GOLD_PARTITION).isin(named) | (F.lit(None in days) & F.col(GOLD_PARTITION).isNull()))
    for name, (where, keys, partial, _) in _definitions().items():
        rows = gold if where is None else gold.filter(where)
        found = rows.groupBy(GOLD_PARTITION, *keys).agg(*[e.alias(c) for c, e in partial.items()])
        path = f"{root}/{name}"
        if days is None:
            found.hint("rebalance", GOLD_PARTITION).write.mode("overwrite").partitionBy(GOLD_PARTITION).parquet(path)
            continue
        # a day whose last row for this view is gone must not keep its partials
        there = {r[0] for r in rows.select(GOLD_PARTITION).distinct().collect()}
        for day in set(days) - there:
            old = f"{path}/{GOLD_PARTITION}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"
            if folder_exists(spark, old):
                delete_folder(spark, old)
        found.hint("rebalance", GOLD_PARTITION).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(GOLD_PARTITION).parquet(path)


def view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A view, put together from the partials of all days: one of ``VIEW_NAMES`` but ``ev_transaction_units``."""
    if name == "energy_consumption_by_charger":
        return view(spark, root, "daily_energy_consumption").groupBy("CHARGE_STATION_ID").agg(F.sum("total_energy_consumed").alias("total_energy_consumed"))
    _, keys, _, whole = _definitions()[name]
    out = spark.read.parquet(f"{root}/{name}").groupBy(*map(_name, keys)).agg(*[e.alias(c) for c, e in whole.items()])
    if name == "charging_session_duration":
        out = out.withColumn("session_duration", F.col("session_end") - F.col("session_start"))
    if name == "charging_session_errors":
        out = out.select("MANUFACTURER", "error_count", "OCPP_ERROR_CODE", "VENDOR_ERROR_CODE")
    return out
