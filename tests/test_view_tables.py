"""Incremental view tables, the as-of view in SQL, and energy by register."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, bronze_rows, master_rows
from voltstream import schemas
from voltstream.operators.silver import to_silver
from voltstream.plans import medallion, view_tables, views
from voltstream.plans.inspect import plan_text

NAMES = [n for n in views.VIEW_NAMES if n != "ev_transaction_units"]


def same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_refresh_of_touched_days(spark, tmp_base):
    """Merges that change, add and empty days; a day that is NULL; repeated refreshes."""
    gold, root, stamp = f"{tmp_base}/gold", f"{tmp_base}/views", medallion.fixed_stamp()
    silver = medallion.silver_from_tables(spark, SF_SMALL, stage_time=stamp).withColumn(
        "SOURCE_MESSAGE_TIMESTAMP_CREATED", F.when(F.col("SOURCE_ID").cast("bigint") % 50 != 0, F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED")))
    silver.write.parquet(f"{tmp_base}/silver")
    silver = spark.read.parquet(f"{tmp_base}/silver")
    day = F.to_date("SOURCE_MESSAGE_TIMESTAMP_CREATED")
    some = F.coalesce(F.dayofmonth(day) < 5, F.lit(True))
    parts = [silver, silver.where(some).withColumn("OCPP_ACTION", F.lit("Heartbeat")), silver.where(day == "2024-01-20").withColumn("STATUS", F.lit("Down"))]
    for n, part in enumerate(parts):
        told = medallion.merge_into_gold_table(gold, part, f"{tmp_base}/stage", stamp=stamp)
        if n == 1:
            assert None in told["touched"]
        for _ in range(2):
            view_tables.refresh(spark, gold, root, told["touched"])
        table = spark.read.parquet(gold)
        for name in NAMES:
            assert same(view_tables.view(spark, root, name), views.VIEWS[name](table)), (n, name)
    assert view_tables.refresh(spark, gold, root, []) is None
    view_tables.refresh(spark, gold, f"{tmp_base}/anew")
    assert all(same(view_tables.view(spark, f"{tmp_base}/anew", n), view_tables.view(spark, root, n)) for n in NAMES)


def test_reading_a_view_table_does_not_read_gold(spark, tmp_base):
    gold, root, stamp = f"{tmp_base}/gold", f"{tmp_base}/views", medallion.fixed_stamp()
    medallion.merge_into_gold_table(gold, medallion.silver_from_tables(spark, SF_SMALL, stage_time=stamp), f"{tmp_base}/stage", stamp=stamp)
    view_tables.refresh(spark, gold, root)
    assert all("/views/" in f for name in NAMES for f in view_tables.view(spark, root, name).inputFiles())


@pytest.mark.parametrize("seed", [1, 2])
def test_transaction_units_in_sql_and_as_a_plan(spark, seed):
    rnd, rows = random.Random(seed), []
    for i in range(150):
        t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.choice([0, 30, 59, 60, 61, 300, 1440]) * rnd.randint(0, 3))
        rows.append((str(i), rnd.choice(["StartTransaction", "StopTransaction", "Heartbeat"]), rnd.choice(["A", "B", None]), rnd.choice(["CS1", None]), t if rnd.random() < 0.9 else None,
                     float(i), float(1000 + i)))
    gold = spark.createDataFrame(rows, "SOURCE_ID string, OCPP_ACTION string, ID_TAG string, CHARGE_STATION_ID string, UNIFIED_TIMESTAMP timestamp, METER_START float, METER_STOP float")
    name = f"gold_{uuid.uuid4().hex[:8]}"
    gold.createOrReplaceTempView(name)
    found = spark.sql(views.VIEW_SQL["ev_transaction_units"].format(gold=name))
    want = views.ev_transaction_units(gold)
    assert found.columns == want.columns and want.count() > 10 and same(found, want)
    assert "CartesianProduct" not in plan_text(found) and "NestedLoop" not in plan_text(found)


def stop(i, station, txn, readings):
    return (i, station, f'15-Jan-2024 10:00:00.000 [2,"{i}","StopTransaction",{{"idTag":"T","transactionId":{txn},"transactionData":[{",".join(readings)}]}}]@@EOM@@')


def reading(t, *samples):
    stamp = f'"timestamp":"2024-01-15T{t}Z",' if t else ""
    return f'{{{stamp}"sampledValue":[{",".join(samples)}]}}'


def test_registers_resets_units_and_defaults(spark):
    wh = lambda v, **more: "{" + f'"value":"{v}"' + "".join(f',"{k}":"{x}"' for k, x in more.items()) + "}"
    rows = [
        stop(1, "CS1", 10, [reading("10:02:00", wh(1500)), reading("10:00:00", wh(1000)), reading("10:01:00", wh(1200), wh(3, unit="kWh", measurand="Energy.Active.Import.Register"))]),
        stop(2, "CS1", 11, [reading("10:00:00", wh(900)), reading("10:01:00", wh(950)), reading("10:02:00", wh(20)), reading("10:03:00", wh(70))]),  # starts over
        stop(3, "CS1", 10, [reading(None, wh(5)), reading(None, wh("x")), reading(None, wh(8), wh(1, measurand="Power.Active.Import", unit="kW"), wh(2, measurand="Energy.Active.Import.Interval"))]),
        stop(4, "CS1", 12, []),
        stop(5, "CS1", 13, [reading("10:00:00", wh(1, unit="varh", measurand="Energy.Reactive.Import.Register"), wh(7, measurand="Energy.Active.Export.Register", context="Transaction.Begin"))]),
    ]
    gold = medallion.first_gold(to_silver(bronze_rows(spark, rows), master_rows(spark, [("CS1", 1, "ACME")])), stamp=medallion.fixed_stamp())
    got = {(r.SOURCE_ID, r.unit, r.context): (round(r.first_kwh, 6), round(r.last_kwh, 6), round(r.energy_kwh, 6), r.n_readings, r.n_resets) for r in views.register_energy(gold).collect()}
    assert got == {("1", "Wh", None): (1.0, 1.5, 0.5, 3, 0), ("1", "kWh", None): (3.0, 3.0, 0.0, 1, 0), ("2", "Wh", None): (0.9, 0.07, 0.12, 4, 1), ("3", "Wh", None): (0.005, 0.008, 0.003, 2, 0),
                   ("5", "Wh", "Transaction.Begin"): (0.007, 0.007, 0.0, 1, 0)}
    total = {r.TRANSACTION_ID: (r.stops, r.imported_kwh and round(r.imported_kwh, 6), r.exported_kwh, r.n_resets) for r in views.energy_by_transaction(gold).collect()}
    assert total == {10: (2, 0.503, None, 0), 11: (1, 0.12, None, 1), 13: (1, None, 0.0, 0)}
    assert schemas.GOLD_COLUMNS == gold.columns
