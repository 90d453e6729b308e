"""Write PLANS.md: the physical plan trees of the main operators (explain "formatted", tree part only).

Usage: python scripts/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)
Plans are taken after execution, so they show AQE's final choices.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from voltstream.operators.silver import to_silver  # noqa: E402
from voltstream.plans import fixtures, load_tables, medallion, views  # noqa: E402
from voltstream.plans.inspect import plan_text  # noqa: E402
from voltstream.session import local_session, run_dir  # noqa: E402


def tree(df) -> str:
    df.collect()  # run this DataFrame itself, so explain shows AQE's final plan
    lines = plan_text(df).splitlines()
    block = []
    for ln in lines[1:]:
        if not ln.strip():
            break
        block.append(ln)
    text = "\n".join(block)
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
        text = "\n".join(ln for ln in text.splitlines() if ln.strip() and ln.strip() != "+-")
    scans = [ln for ln in lines if ln.startswith(("PushedFilters", "PartitionFilters", "ReadSchema"))]
    return text + "\n\n" + "\n".join(s[:160] for s in scans[:8])


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    # broadcasts off: the joins that run when neither side is small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    base = run_dir(spark, "plans")
    stamp = medallion.fixed_stamp()
    tables = load_tables.LoadTables(f"{base}/bronze", buckets=8)
    load_tables.ingest_load(spark, tables, fixtures.bronze_from_events(spark, sf, ingest_time=stamp).where("id % 4 < 3"), "1", "2024-02-01")
    load_tables.ingest_load(spark, tables, fixtures.bronze_from_events(spark, sf, ingest_time=stamp).where("id % 4 = 3"), "2", "2024-02-02")
    bronze = load_tables.read(spark, tables, "lines")
    fixtures.master_from_tables(spark, sf).write.parquet(f"{base}/master")
    master = spark.read.parquet(f"{base}/master")
    silver = load_tables.silver_of_all(spark, tables, master, stage_time=stamp)
    silver.write.parquet(f"{base}/silver")
    s = spark.read.parquet(f"{base}/silver")
    medallion.merge_into_gold_table(f"{base}/gold", s, f"{base}/stage0", stamp=stamp)
    gold = spark.read.parquet(f"{base}/gold")
    inc = s.filter(F.col("SOURCE_MESSAGE_TIMESTAMP_CREATED") >= F.lit("2024-01-25").cast("timestamp"))

    sections = [("silver of all loads: stored frames → silver", silver),
                ("silver of one load: changed calls and their results → silver", load_tables.silver_of_load(spark, tables, "2", "2024-02-02", master, stage_time=stamp)),
                ("silver from log lines (frames parsed in the query)", to_silver(bronze, master, stage_time=stamp)),
                ("gold first load: latest row per key", medallion.first_gold(s, stamp=stamp)),
                ("gold MERGE: target left-anti source keys, union source",
                 medallion.merge_into_gold(gold.drop("dt"), inc, stamp=stamp))]
    sections += [(f"view {name}", fn(gold)) for name, fn in views.VIEWS.items()]
    sections.append(("view ev_transaction_units_totals", views.ev_transaction_units_totals(gold)))

    out = ["# Physical plans (generated by `scripts/plan_report.py`, sf0.01, local[8], AQE final plans)", "",
           "Taken with broadcasts off, so these are the joins that run at scale (with them on, AQE broadcasts sides",
           "below Spark's byte threshold). `*` marks whole-stage codegen.",
           ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", tree(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
