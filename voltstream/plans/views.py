"""The six analytics views over the gold table.

Each view is a function ``gold DataFrame → DataFrame``; ``register_views``
publishes them as temporary views under their names. Aggregations are
partial + final hash aggregates (map-side combine), so a hot station or day
is reduced before the shuffle. Filters and the few needed columns are pushed
into the gold scan by Catalyst.

``ev_transaction_units`` is re-aimed: the original view pairs *every* start
with *every* stop of the same tag and station, i.e. n × m rows per group.
Here each stop is paired with the latest start at or before it (an as-of
pairing, linear in the input). ``ev_transaction_units_totals`` gives the
exact totals of the original all-pairs view per (tag, station) without
emitting the pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream import schemas
from voltstream.functions import frames
from voltstream.operators.asof import asof_pair

# ---------------------------------------------------------------------------
# View names, the status that marks a charger as down and the
# error code the error view selects.
# ---------------------------------------------------------------------------

VIEW_NAMES = (
    "charger_heartbeats",
    "charging_session_errors",
    "ev_transaction_units",
    "charging_session_duration",
    "energy_consumption_by_charger",
    "daily_energy_consumption",
)
DOWN_STATUS = "Down"
ERROR_CODES = ("Error",)
NO_VENDOR_ERROR = "0"


def charger_heartbeats(gold: DataFrame) -> DataFrame:
    """Heartbeat count per station and day; ``was_down`` 1 if any row had status Down."""
    return (
        gold.filter(F.col("OCPP_ACTION") == "Heartbeat")
        .groupBy("CHARGE_STATION_ID", F.to_date("UNIFIED_TIMESTAMP").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("heartbeat_count"),
            F.max(F.when(F.col("STATUS") == DOWN_STATUS, 1).otherwise(0)).alias("was_down"),
        )
    )


def charging_session_errors(gold: DataFrame, error_codes: Sequence[str] = ERROR_CODES) -> DataFrame:
    """StatusNotification errors per manufacturer, error code and vendor code."""
    cond = (F.col("OCPP_ACTION") == "StatusNotification") & (
        F.col("OCPP_ERROR_CODE").isin(list(error_codes)) | (F.col("VENDOR_ERROR_CODE") != NO_VENDOR_ERROR)
    )
    return (
        gold.filter(cond)
        .groupBy("MANUFACTURER", "OCPP_ERROR_CODE", "VENDOR_ERROR_CODE")
        .agg(F.count(F.lit(1)).alias("error_count"))
        .select("MANUFACTURER", "error_count", "OCPP_ERROR_CODE", "VENDOR_ERROR_CODE")
    )


def _starts(gold: DataFrame) -> DataFrame:
    return gold.filter(F.col("OCPP_ACTION") == "StartTransaction").select(
        "ID_TAG", "CHARGE_STATION_ID", "METER_START", F.col("UNIFIED_TIMESTAMP").alias("start_time"),
        F.col("SOURCE_ID").alias("_start_id"),
    )


def _stops(gold: DataFrame) -> DataFrame:
    return gold.filter(F.col("OCPP_ACTION") == "StopTransaction").select(
        "ID_TAG", "CHARGE_STATION_ID", "METER_STOP", F.col("UNIFIED_TIMESTAMP").alias("stop_time"),
    )


def ev_transaction_units(gold: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """Each stop with the latest start of the same tag and station at or before it."""
    paired = asof_pair(
        _starts(gold), _stops(gold), ["ID_TAG", "CHARGE_STATION_ID"], "start_time", "stop_time", "_start_id",
        bucket_seconds=bucket_seconds,
    )
    return paired.select(
        "ID_TAG",
        "CHARGE_STATION_ID",
        "METER_START",
        "METER_STOP",
        (F.col("METER_STOP") - F.col("METER_START")).alias("units_consumed"),
        "start_time",
        "stop_time",
    )


def ev_transaction_units_totals(gold: DataFrame) -> DataFrame:
    """Totals of the all-pairs start × stop view per (tag, station), computed linearly.

    pairs = n_start · n_stop; Σ(stop − start) over pairs = n_start · Σstop − n_stop · Σstart.
    Only non-NULL tags and stations pair (equi-join semantics).
    """
    keys = ["ID_TAG", "CHARGE_STATION_ID"]
    a = (
        _starts(gold).filter(F.col("ID_TAG").isNotNull() & F.col("CHARGE_STATION_ID").isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_start"), F.sum("METER_START").alias("sum_start"),
             F.count("METER_START").alias("n_start_value"))
    )
    b = (
        _stops(gold).filter(F.col("ID_TAG").isNotNull() & F.col("CHARGE_STATION_ID").isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_stop"), F.sum("METER_STOP").alias("sum_stop"),
             F.count("METER_STOP").alias("n_stop_value"))
    )
    j = a.join(b, keys, "inner")
    # units are NULL for a pair with a NULL meter; sums skip them like SUM does
    units = F.when(
        (F.col("n_start_value") > 0) & (F.col("n_stop_value") > 0),
        F.col("n_start_value") * F.col("sum_stop") - F.col("n_stop_value") * F.col("sum_start"),
    )
    return j.select(
        *keys,
        (F.col("n_start") * F.col("n_stop")).alias("pair_count"),
        units.alias("total_units_consumed"),
    )


def charging_session_duration(gold: DataFrame) -> DataFrame:
    """First and last time per (transaction, station) and their difference (an interval)."""
    return (
        gold.filter(F.col("TRANSACTION_ID").isNotNull())
        .groupBy("TRANSACTION_ID", "CHARGE_STATION_ID")
        .agg(F.min("UNIFIED_TIMESTAMP").alias("session_start"), F.max("UNIFIED_TIMESTAMP").alias("session_end"))
        .withColumn("session_duration", F.col("session_end") - F.col("session_start"))
    )


def energy_consumption_by_charger(gold: DataFrame) -> DataFrame:
    """Sum of the energy meter value per station (FLOAT summed as DOUBLE)."""
    return gold.groupBy("CHARGE_STATION_ID").agg(F.sum("METERVALUE_ENERGY_KWH").alias("total_energy_consumed"))


def daily_energy_consumption(gold: DataFrame) -> DataFrame:
    """Sum of the energy meter value per station and day."""
    return gold.groupBy("CHARGE_STATION_ID", F.to_date("UNIFIED_TIMESTAMP").alias("date")).agg(
        F.sum("METERVALUE_ENERGY_KWH").alias("total_energy_consumed")
    )


VIEWS = {
    "charger_heartbeats": charger_heartbeats,
    "charging_session_errors": charging_session_errors,
    "ev_transaction_units": ev_transaction_units,
    "charging_session_duration": charging_session_duration,
    "energy_consumption_by_charger": energy_consumption_by_charger,
    "daily_energy_consumption": daily_energy_consumption,
}


def meter_readings(gold: DataFrame) -> DataFrame:
    """One row per sampled meter value of a stop's ``transactionData`` (FN20).

    Read from the request text that gold keeps; SOURCE_ID, station, transaction
    and tag with the reading's and sample's place, time, value (NULL if it is
    no number), measurand, unit and context.
    """
    stops = gold.filter(F.col("OCPP_ACTION") == "StopTransaction")
    body = F.from_json(frames.request_body(F.col("OCPP_REQUEST_MESSAGE"), F.col("OCPP_REQUEST_MESSAGE")),
                       f"transactionData ARRAY<STRUCT<{schemas.ddl(schemas.TRANSACTION_DATA_FIELDS)}>>")
    kept = ["SOURCE_ID", "CHARGE_STATION_ID", "TRANSACTION_ID", "ID_TAG", "UNIFIED_TIMESTAMP"]
    readings = stops.select(*kept, F.posexplode(body["transactionData"]).alias("reading_no", "_reading"))
    samples = readings.select(*kept, "reading_no", F.col("_reading.timestamp").alias("reading_time"), F.posexplode("_reading.sampledValue").alias("sample_no", "_sample"))
    return samples.select(*kept, "reading_no", "reading_time", "sample_no", F.col("_sample.value").try_cast("double").alias("value"),
                          *[F.col(f"_sample.{c}").alias(c) for c in ("measurand", "unit", "context")])


def energy_from_readings(gold: DataFrame) -> DataFrame:
    """Transactions, readings and meter values per station and day, from real readings (beside VW5 / VW6, whose
    meter column is constant)."""
    return meter_readings(gold).groupBy("CHARGE_STATION_ID", F.to_date("UNIFIED_TIMESTAMP").alias("date")).agg(
        F.count_distinct("SOURCE_ID").alias("transactions"), F.count("value").alias("readings"),
        F.max("value").alias("highest_reading"), F.sum("value").alias("total_reading"))


#: an energy register's default measurand and unit where a sample names none, and the units that are energy (in kWh)
ENERGY_MEASURAND, ENERGY_UNIT = "Energy.Active.Import.Register", "Wh"
UNIT_KWH = {"Wh": 0.001, "kWh": 1.0}


def register_energy(gold: DataFrame) -> DataFrame:
    """Energy by meter register and transaction: what a register gained over a stop's readings, in kWh.

    One row per stop (SOURCE_ID), measurand, unit and context, over its readings in time order: ``first_kwh``,
    ``last_kwh``, ``energy_kwh`` (the sum of gains; a value below the one before is a register that started over, and
    counts from zero), ``n_readings``, ``n_resets``. Only energy registers (units Wh and kWh, the protocol's defaults
    where a sample names none). A group is the readings of one message.
    """
    samples = meter_readings(gold).select(
        "SOURCE_ID", "CHARGE_STATION_ID", "TRANSACTION_ID", F.coalesce("measurand", F.lit(ENERGY_MEASURAND)).alias("measurand"),
        F.coalesce("unit", F.when(F.coalesce("measurand", F.lit(ENERGY_MEASURAND)).startswith("Energy."), ENERGY_UNIT)).alias("unit"), "context",
        "reading_time", "reading_no", "sample_no", "value")
    factor = F.lit(None).cast("double")
    for unit, kwh in UNIT_KWH.items():
        factor = F.when(F.col("unit") == unit, kwh).otherwise(factor)
    energy = samples.withColumn("kwh", F.col("value") * factor).filter(F.col("kwh").isNotNull() & F.col("measurand").endswith(".Register"))
    by = ["SOURCE_ID", "CHARGE_STATION_ID", "TRANSACTION_ID", "measurand", "unit", "context"]
    rows = energy.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("reading_time", "reading_no", "sample_no", "kwh"))).alias("r"))
    values = F.transform("r", lambda x: x["kwh"])
    before = F.concat(F.array(values[0]), F.slice(values, 1, F.size(values) - 1))
    gains = F.zip_with(values, before, lambda v, b: F.when(v >= b, v - b).otherwise(v))
    resets = F.size(F.filter(F.zip_with(values, before, lambda v, b: v < b), lambda x: x))
    return rows.select(*by, values[0].alias("first_kwh"), F.element_at(values, -1).alias("last_kwh"),
                       F.aggregate(gains, F.lit(0.0), lambda a, x: a + x).alias("energy_kwh"), F.size(values).alias("n_readings"), resets.alias("n_resets"))


def energy_by_transaction(gold: DataFrame) -> DataFrame:
    """kWh imported and exported per transaction, from its active energy registers (contexts and units put together)."""
    direction = lambda d: F.sum(F.when(F.col("measurand") == f"Energy.Active.{d}.Register", F.col("energy_kwh")))
    return register_energy(gold).filter(F.col("TRANSACTION_ID").isNotNull()).groupBy("CHARGE_STATION_ID", "TRANSACTION_ID").agg(
        F.count_distinct("SOURCE_ID").alias("stops"), direction("Import").alias("imported_kwh"), direction("Export").alias("exported_kwh"), F.sum("n_resets").alias("n_resets"))


#: the six views as SQL over a gold table; ``ev_transaction_units`` is the as-of pairing of ``operators.asof`` in SQL
VIEW_SQL = {
    "ev_transaction_units": """
WITH parts AS (
  SELECT ID_TAG, CHARGE_STATION_ID, UNIFIED_TIMESTAMP AS t, OCPP_ACTION = 'StopTransaction' AS is_stop, METER_STOP,
         CASE WHEN OCPP_ACTION = 'StartTransaction' THEN STRUCT(METER_START, UNIFIED_TIMESTAMP AS start_time) END AS start,
         CASE WHEN OCPP_ACTION = 'StartTransaction' THEN SOURCE_ID END AS start_id, FLOOR(UNIX_MICROS(UNIFIED_TIMESTAMP) / 3600000000) AS hour
  FROM {gold}
  WHERE OCPP_ACTION IN ('StartTransaction', 'StopTransaction') AND ID_TAG IS NOT NULL AND CHARGE_STATION_ID IS NOT NULL AND UNIFIED_TIMESTAMP IS NOT NULL
),
scanned AS (
  SELECT *, LAST(start, TRUE) OVER (PARTITION BY ID_TAG, CHARGE_STATION_ID, hour ORDER BY t, is_stop, start_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS within,
         LAST(start, TRUE) OVER (PARTITION BY ID_TAG, CHARGE_STATION_ID, hour ORDER BY t, is_stop, start_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_of_hour
  FROM parts
),
hours AS (
  SELECT ID_TAG, CHARGE_STATION_ID, hour, FIRST(last_of_hour, TRUE) AS last_of_hour, BOOL_OR(is_stop) AS has_stop
  FROM scanned GROUP BY ID_TAG, CHARGE_STATION_ID, hour
),
carried AS (
  SELECT ID_TAG, CHARGE_STATION_ID, hour, has_stop,
         LAST(last_of_hour, TRUE) OVER (PARTITION BY ID_TAG, CHARGE_STATION_ID ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carry
  FROM hours
),
paired AS (
  SELECT s.ID_TAG, s.CHARGE_STATION_ID, s.METER_STOP, s.t, COALESCE(s.within, c.carry) AS start
  FROM scanned s JOIN carried c ON s.ID_TAG = c.ID_TAG AND s.CHARGE_STATION_ID = c.CHARGE_STATION_ID AND s.hour = c.hour
  WHERE s.is_stop AND c.has_stop
)
SELECT ID_TAG, CHARGE_STATION_ID, start.METER_START AS METER_START, METER_STOP, METER_STOP - start.METER_START AS units_consumed,
       start.start_time AS start_time, t AS stop_time
FROM paired WHERE start IS NOT NULL""",
    "charger_heartbeats": f"""
SELECT CHARGE_STATION_ID, DATE(UNIFIED_TIMESTAMP) AS date, COUNT(*) AS heartbeat_count,
       MAX(CASE WHEN STATUS = '{DOWN_STATUS}' THEN 1 ELSE 0 END) AS was_down
FROM {{gold}} WHERE OCPP_ACTION = 'Heartbeat' GROUP BY CHARGE_STATION_ID, DATE(UNIFIED_TIMESTAMP)""",
    "charging_session_errors": f"""
SELECT MANUFACTURER, COUNT(*) AS error_count, OCPP_ERROR_CODE, VENDOR_ERROR_CODE
FROM {{gold}} WHERE OCPP_ACTION = 'StatusNotification' AND (OCPP_ERROR_CODE = '{ERROR_CODES[0]}' OR VENDOR_ERROR_CODE <> '{NO_VENDOR_ERROR}')
GROUP BY MANUFACTURER, OCPP_ERROR_CODE, VENDOR_ERROR_CODE""",
    "charging_session_duration": """
SELECT TRANSACTION_ID, CHARGE_STATION_ID, MIN(UNIFIED_TIMESTAMP) AS session_start, MAX(UNIFIED_TIMESTAMP) AS session_end,
       MAX(UNIFIED_TIMESTAMP) - MIN(UNIFIED_TIMESTAMP) AS session_duration
FROM {gold} WHERE TRANSACTION_ID IS NOT NULL GROUP BY TRANSACTION_ID, CHARGE_STATION_ID""",
    "energy_consumption_by_charger": """
SELECT CHARGE_STATION_ID, SUM(METERVALUE_ENERGY_KWH) AS total_energy_consumed FROM {gold} GROUP BY CHARGE_STATION_ID""",
    "daily_energy_consumption": """
SELECT CHARGE_STATION_ID, DATE(UNIFIED_TIMESTAMP) AS date, SUM(METERVALUE_ENERGY_KWH) AS total_energy_consumed
FROM {gold} GROUP BY CHARGE_STATION_ID, DATE(UNIFIED_TIMESTAMP)""",
}


def create_views(spark: SparkSession, gold_table: str, suffix: str = "") -> list[str]:
    """``CREATE OR REPLACE VIEW`` for the six views over a catalog table; they outlive the DataFrames (and, with a
    persistent catalog, the session) and are queried by name."""
    for name, sql in VIEW_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name}{suffix} AS {sql.format(gold=gold_table)}")
    return [f"{name}{suffix}" for name in VIEW_SQL]


def register_views(gold: DataFrame) -> dict[str, DataFrame]:
    """Publish the six views as temporary views named as in ``VIEW_NAMES``."""
    out = {}
    for name, fn in VIEWS.items():
        df = fn(gold)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out
