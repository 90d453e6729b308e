"""Benchmark the charger-log pipeline on the driver's tables.

Runs the pipeline the way it is deployed — each layer materialized once,
later steps reading the written table — and times each step:

  landing           two high-water-mark landing runs of the OCPP lines rendered
                    from ``events`` (CSV, partitioned by day) + master CSV
  stream_bronze     availableNow streaming ingest of the landed CSV → bronze
                    and master parquet tables
  silver_build      bronze table → parse, pair, enrich, conform → parquet
  gold_first_load   silver → latest row per key + stamp → day-partitioned gold
  view_*            the six views (+ all-pairs totals) over the written gold
  gold_upsert       MERGE of a one-week silver increment; only touched days rewritten
  compare_silver_*  silver to a noop sink: single pass vs one branch per action
                    (reference points; not in the total)
  compare_gold_upsert_full_rewrite  the same MERGE as a whole-table
                    rewrite (reference point; not in the total)

Every step is run five times after a warm-up (reference points three times); the median counts.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8). Prints one JSON line. Small scale factors measure per-job
overhead as much as throughput.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from voltstream.operators.incremental import land_increment  # noqa: E402
from voltstream.plans import fixtures, medallion, views  # noqa: E402
from voltstream.session import ensure_utc, local_session, run_dir  # noqa: E402
from voltstream.operators.silver import to_silver, to_silver_by_action  # noqa: E402
from voltstream.sources.csv import write_snapshot_csv  # noqa: E402
from voltstream.streaming.ingest import append_stream, stream_master_csv  # noqa: E402
from voltstream.streaming.gold_stream import run_load_stream  # noqa: E402
from voltstream.plans.load_tables import LoadTables, read, silver_of_all  # noqa: E402


RUNS = 5


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return time.perf_counter() - t0, out


def _sf_number(sf_dir: str):
    text = os.path.basename(sf_dir).replace("sf", "")
    try:
        return float(text)
    except ValueError:
        return text


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="voltstream-bench")
    ensure_utc(spark)
    base = run_dir(spark, "bench")
    stamp = medallion.fixed_stamp()

    # warm-up on the smallest tables (JIT, class loading)
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm):
        noop(views.charger_heartbeats(medallion.gold_from_tables(spark, warm, stamp=stamp)))

    q: dict[str, float] = {}

    def median(name, fn, times=RUNS):
        took = []
        for n in range(times):
            seconds, out = timed(lambda n=n: fn(n))
            took.append(seconds)
        q[name] = statistics.median(took)
        return out

    # 1. landing: two high-water-mark runs over the OCPP lines rendered from events
    lines = fixtures.ocpp_from_events(fixtures.table(spark, sf_dir, "events"))
    early = lines.filter(F.col("request_date") < F.lit("2024-01-16").cast("timestamp"))

    def land(n):
        landing, marks = f"{base}/{n}/landing", f"{base}/{n}/_marks"
        land_increment(spark, early, landing, marks, load_id="1")
        land_increment(spark, lines, landing, marks, load_id="2")
        write_snapshot_csv(fixtures.master_from_tables(spark, sf_dir), f"{landing}/master_data")

    median("landing", land)

    # 2. streaming ingest (availableNow) into the load tables (lines, frames parsed once, keys) and the master table
    def ingest(n):
        run_load_stream(spark, f"{base}/0/landing/load=*/dt=*/", f"{base}/{n}/bronze", f"{base}/{n}/_ckpt/bronze", key_buckets=8)
        append_stream(stream_master_csv(spark, f"{base}/0/landing/master_data"), f"{base}/{n}/master", f"{base}/{n}/_ckpt/master")

    median("stream_bronze", ingest)
    tables, master = LoadTables(f"{base}/0/bronze", buckets=8), spark.read.parquet(f"{base}/0/master")
    bronze = read(spark, tables, "lines")

    # 3. silver from the stored frames
    silver_df = silver_of_all(spark, tables, master, stage_time=stamp)
    median("silver_build", lambda n: silver_df.write.parquet(f"{base}/{n}/silver"))
    silver = spark.read.parquet(f"{base}/0/silver")
    n_silver = silver.count()
    # reference points: the same rows from the log lines, in one pass and one action branch at a time
    median("compare_silver_from_lines_noop", lambda n: noop(to_silver(bronze, master, stage_time=stamp)), 3)
    median("compare_silver_branch_per_action", lambda n: noop(to_silver_by_action(bronze, master, stage_time=stamp)), 3)
    median("compare_silver_single_pass_noop", lambda n: noop(silver_df), 3)

    # 4. gold (partitioned by day): first load, views, then MERGE of an increment
    created = F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED")
    median("gold_first_load", lambda n: medallion.merge_into_gold_table(f"{base}/{n}/gold", silver, f"{base}/{n}/_stage", stamp=stamp))
    gold = spark.read.parquet(f"{base}/0/gold")

    view_fns = dict(views.VIEWS)
    view_fns["ev_transaction_units_totals"] = views.ev_transaction_units_totals
    for name, fn in view_fns.items():
        median(f"view_{name}", lambda n, fn=fn: noop(fn(gold)))

    # an increment of the last week: re-delivered rows (updates) of 25-30 Jan
    inc_stamp = F.lit("2024-02-02 00:00:00").cast("timestamp")
    inc = silver.filter(created >= F.lit("2024-01-25").cast("timestamp")).withColumn("STAGE_LOAD_TIMESTAMP", inc_stamp)
    median("gold_upsert", lambda n: medallion.merge_into_gold_table(f"{base}/{n}/gold", inc, f"{base}/{n}/_stage", stamp=inc_stamp))
    # the same MERGE as a whole-table rewrite (for comparison)
    median("compare_gold_upsert_full_rewrite",
           lambda n: medallion.merge_into_gold(spark.read.parquet(f"{base}/{n}/gold").drop("dt"), inc, stamp=inc_stamp).write.parquet(f"{base}/{n}/rewritten"), 3)

    total = sum(v for k, v in q.items() if not k.startswith("compare_"))
    print(json.dumps({
        "metric": "pipeline_total_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "sf": _sf_number(sf_dir),
        "silver_rows": n_silver,
        "silver_rows_per_sec": round(n_silver / q["silver_build"], 1) if q["silver_build"] else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
