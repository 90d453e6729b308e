"""Load tables: per-load gold against the batch build, what is listed and read, folding, quarantine and reloads."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import BRONZE_COLS, SF_SMALL, bronze_rows, master_rows
from voltstream import schemas
from voltstream.operators.silver import enrich_with_master, master_versions, silver_from_frames, to_silver
from voltstream.plans import fixtures, load_tables, master_reload, medallion
from voltstream.plans.inspect import plan_text
from voltstream.plans.load_tables import LoadTables

SAME = [c for c in schemas.SILVER_COLUMNS if c not in ("INGEST_LOAD_TIMESTAMP", "STAGE_LOAD_TIMESTAMP")]


def equal(a, b):
    a, b = a.select(*SAME), b.select(*SAME)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def random_loads(seed, loads=4, lines=25):
    """Two stations that use two message ids over and over, within few seconds: ties, late calls and results, several
    frames a line, lines that are landed again."""
    rnd, out, n = random.Random(seed), [], 0
    for _ in range(loads):
        rows = []
        for _ in range(lines):
            n += 1
            frames = []
            for _ in range(rnd.choice([1, 1, 1, 2])):
                at, mid = f"15-Jan-2024 10:{rnd.randint(0, 3):02d}:{rnd.randint(0, 40):02d}.000", rnd.choice("AB")
                frames.append(f'{at} [2,"{mid}","{rnd.choice(["StartTransaction", "Heartbeat", "BootNotification"])}",{{"idTag":"T"}}]@@EOM@@' if rnd.random() < 0.5
                              else f'{at} [3,"{mid}",{{"transactionId":"{n}","currentTime":"2024-01-15T10:00:{n % 60:02d}Z"}}]@@EOM@@')
            rows.append((n, rnd.choice(["CS1", "CS2"]), " ".join(frames)))
        if out and rnd.random() < 0.7:
            rows.append(rnd.choice(rnd.choice(out)))
        out.append(rows)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_per_load_gold_equals_batch_after_every_load(spark, tmp_base, seed):
    master = master_rows(spark, [("CS1", 1, "ACME"), ("CS2", 1, "OTHER")])
    tables, gold, seen = LoadTables(f"{tmp_base}/bronze", buckets=3), f"{tmp_base}/gold", {}
    for n, rows in enumerate(random_loads(seed), 1):
        day = f"2024-02-{(n + 1) // 2:02d}"
        load_tables.ingest_load(spark, tables, bronze_rows(spark, rows), f"l{n}", day)
        load_tables.ingest_load(spark, tables, bronze_rows(spark, rows), f"l{n}", day)  # repeated: replaces itself
        medallion.merge_into_gold_table(gold, load_tables.silver_of_load(spark, tables, f"l{n}", day, master), f"{tmp_base}/stage")
        seen |= {r[0]: r for r in rows}
        assert equal(spark.read.parquet(gold), to_silver(bronze_rows(spark, list(seen.values())), master)), n
        if n == 2:
            load_tables.close_days(spark, tables, "2024-02-02")
        if n == 3:
            load_tables.sweep(spark, tables)
    assert load_tables.read(spark, tables, "frames").count() >= len(seen)


def test_only_requests_whose_answer_changes_are_emitted(spark, tmp_base):
    master, tables = master_rows(spark, [("CS1", 1, "ACME")]), LoadTables(f"{tmp_base}/bronze", buckets=4)
    call = lambda i, t, mid: (i, "CS1", f'15-Jan-2024 10:00:{t:02d}.000 [2,"{mid}","StartTransaction",{{}}]@@EOM@@')
    res = lambda i, t, mid: (i, "CS1", f'15-Jan-2024 10:00:{t:02d}.000 [3,"{mid}",{{"transactionId":"{i}"}}]@@EOM@@')
    loads = {"1": [call(1, 0, "A"), res(2, 1, "A"), call(3, 10, "A"), res(4, 12, "A"), call(5, 20, "A"), call(6, 0, "B")],
             "2": [res(7, 30, "A")],    # answers 5
             "3": [res(8, 14, "A")],    # later than the answer of 3: changes nothing
             "4": [res(9, 11, "A")],    # earlier than the answer of 3
             "5": [call(10, 29, "A")],  # takes the answer of 5
             "6": [res(7, 30, "A")]}    # landed again
    emitted = {}
    for load, rows in loads.items():
        load_tables.ingest_load(spark, tables, bronze_rows(spark, rows), load, "2024-02-01")
        emitted[load] = sorted((r.SOURCE_ID, r.TRANSACTION_ID) for r in load_tables.silver_of_load(spark, tables, load, "2024-02-01", master).collect())
    assert emitted == {"1": [("1", 2), ("3", 4), ("5", None), ("6", None)], "2": [("5", 7)], "3": [], "4": [("3", 9)], "5": [("10", 7), ("5", None)], "6": []}


def test_silver_runs_no_pattern_over_log_text(spark, tmp_base):
    tables = LoadTables(f"{tmp_base}/bronze", buckets=2)
    bronze = fixtures.bronze_from_events(spark, SF_SMALL)
    load_tables.ingest_load(spark, tables, bronze, "1", "2024-02-01")
    fixtures.master_from_tables(spark, SF_SMALL).write.parquet(f"{tmp_base}/master")
    master = spark.read.parquet(f"{tmp_base}/master")
    silver = load_tables.silver_of_all(spark, tables, master)
    plan = plan_text(silver)
    assert "Generate" not in plan and "regexp" not in plan and "raw_log" not in plan
    assert any("IsNotNull(OCPP_ACTION)" in line or "In(OCPP_ACTION" in line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert all("kind" in line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert equal(silver, to_silver(bronze, master))
    assert "regexp" not in plan_text(load_tables.silver_of_load(spark, tables, "1", "2024-02-01", master))


def test_a_load_reads_its_buckets_and_the_loads_with_changed_calls(spark, tmp_base):
    tables = LoadTables(f"{tmp_base}/bronze", buckets=16)
    call = lambda i, mid: (i, "CS1", f'15-Jan-2024 10:00:00.000 [2,"{mid}","Heartbeat",{{}}]@@EOM@@')
    for n in range(6):
        load_tables.ingest_load(spark, tables, bronze_rows(spark, [call(100 * n + k, f"m{n}-{k}") for k in range(40)]), f"l{n}", f"2024-02-0{n + 1}")
    late = [(900, "CS1", '15-Jan-2024 10:00:05.000 [3,"m2-7",{}]@@EOM@@')]
    load_tables.ingest_load(spark, tables, bronze_rows(spark, late), "late", "2024-02-07")
    found = load_tables.silver_of_load(spark, tables, "late", "2024-02-07", master_rows(spark, [("CS1", 1, "ACME")]))
    assert [r.SOURCE_ID for r in found.collect()] == ["207"]
    frames = [f for f in found.inputFiles() if "/frames/" in f]
    assert frames and all("load=l2" in f or "load=late" in f for f in frames)
    touched = {r[0] for r in load_tables.read(spark, tables, "keys", loads=[("2024-02-07", "late")]).select("bucket").collect()}
    keys = load_tables.read(spark, tables, "keys", buckets=sorted(touched))
    assert len(touched) == 1 and {r[0] for r in keys.select("bucket").distinct().collect()} == touched
    assert any("bucket" in line for line in plan_text(keys).splitlines() if line.startswith("PartitionFilters"))
    load_tables.close_days(spark, tables, "2024-02-07")
    load_tables.sweep(spark, tables)
    keys = load_tables.read(spark, tables, "keys", buckets=sorted(touched))
    assert {f.split("/bucket=")[1].split("/")[0] for f in keys.inputFiles()} == {str(b) for b in touched}


def test_files_a_load_lists_do_not_grow_with_earlier_loads(spark, tmp_base):
    master, listed = master_rows(spark, [("CS1", 1, "ACME")]), {}
    for before in (2, 6):
        tables = LoadTables(f"{tmp_base}/{before}", buckets=2)
        for n in range(before):
            rows = [(10 * n + k, "CS1", f'15-Jan-2024 10:{n:02d}:0{k}.000 [{2 + k % 2},"A",{"{}" if k % 2 else chr(34) + "Heartbeat" + chr(34) + ",{}"}]@@EOM@@') for k in range(4)]
            load_tables.ingest_load(spark, tables, bronze_rows(spark, rows), f"l{n}", "2024-02-01")
        load_tables.close_days(spark, tables, "2024-02-02")
        load_tables.sweep(spark, tables)
        load_tables.ingest_load(spark, tables, bronze_rows(spark, [(900, "CS1", '15-Jan-2024 11:00:00.000 [2,"A","Heartbeat",{}]@@EOM@@')]), "new", "2024-02-02")
        assert load_tables.silver_of_load(spark, tables, "new", "2024-02-02", master).count() == 1
        listed[before] = [len(load_tables.read(spark, tables, t).inputFiles()) for t in ("lines", "frames", "keys")]
    assert listed[2] == listed[6]


def test_a_fold_that_died_is_not_seen(spark, tmp_base):
    """The closed copy of a day counts from its note on, the open one until then; the next run writes it again."""
    tables = LoadTables(f"{tmp_base}/bronze", buckets=2)
    for n in (1, 2):
        rows = [(10 * n + k, "CS1", f'15-Jan-2024 10:00:0{k}.000 [2,"{n}{k}","Heartbeat",{{}}]@@EOM@@') for k in range(5)]
        load_tables.ingest_load(spark, tables, bronze_rows(spark, rows), f"l{n}", f"2024-02-0{n}")
    load_tables.close_days(spark, tables, "2024-02-03")
    notes = spark.read.parquet(tables.closed_days).collect()
    assert len(notes) == 2
    counts = lambda: [load_tables.read(spark, tables, t).count() for t in ("lines", "frames", "keys")]
    assert counts() == [10, 10, 10]  # noted, not swept yet: each day once
    died = LoadTables(f"{tmp_base}/died", buckets=2)
    for n in (1, 2):
        rows = [(10 * n + k, "CS1", f'15-Jan-2024 10:00:0{k}.000 [2,"{n}{k}","Heartbeat",{{}}]@@EOM@@') for k in range(5)]
        load_tables.ingest_load(spark, died, bronze_rows(spark, rows), f"l{n}", "2024-02-01")
    open_lines = spark.read.schema(f"{load_tables.TABLES['lines']}, dt DATE, load STRING").parquet(died.open("lines"))
    open_lines.limit(3).write.partitionBy("dt").parquet(died.closed("lines"))  # a fold that wrote some rows and no note
    assert load_tables.read(spark, died, "lines").count() == 10
    assert load_tables.close_days(spark, died, "2024-02-02") == ["2024-02-01"]
    load_tables.sweep(spark, died)
    assert [load_tables.read(spark, died, t).count() for t in ("lines", "frames", "keys")] == [10, 10, 10]
    assert load_tables.close_days(spark, died, "2024-02-02") == []
    with pytest.raises(ValueError, match="closed"):
        load_tables.ingest_load(spark, died, bronze_rows(spark, []), "late", "2024-02-01")


def test_reasons_and_replay(spark, tmp_base):
    good = '15-Jan-2024 10:00:00.000 [2,"1","Heartbeat",{}]@@EOM@@'
    lines = [(1, good, None), (None, good, None), (3, "no frame here", None), (4, None, None), (5, good.replace("15-Jan", "31-Feb"), None),
             (6, good + " " + good.replace("10:00", "25:00"), None), (None, "nothing", '{"_row":"x"}'), (8, good.replace("15-Jan-2024 10:00:00.000 ", ""), None),
             (9, good, '{"serial_number":"?"}')]
    rows = spark.createDataFrame([(i, f"u{k}", dt.datetime(2024, 1, 1), 7, 1, log, "SN", "CS1", "f", dt.datetime(2024, 2, 1), bad) for k, (i, log, bad) in enumerate(lines)], BRONZE_COLS)
    tables = LoadTables(f"{tmp_base}/bronze", buckets=2)
    assert load_tables.read_quarantine(spark, tables) is None
    assert load_tables.ingest_load(spark, tables, rows, "1", "2024-02-01") == {"lines": 9, "quarantined": 6}
    held = {r.request_uuid: r.reasons for r in load_tables.read_quarantine(spark, tables).collect()}
    assert held == {"u1": ["no id"], "u2": ["no frame"], "u3": ["no frame"], "u4": ["impossible time"], "u5": ["impossible time"], "u6": ["no id", "no frame", "broken row"]}
    assert load_tables.read(spark, tables, "lines").count() == 9 and load_tables.read(spark, tables, "frames").count() == 3

    def repair(rows):
        rows = rows.withColumn("id", F.coalesce("id", F.when(F.col("request_uuid") == "u1", 2)))
        return rows.withColumn("raw_log", F.regexp_replace("raw_log", "31-Feb", "15-Jan"))

    assert load_tables.replay(spark, tables, repair, "replay", "2024-02-02") == {"lines": 2, "quarantined": 0}
    assert {r.request_uuid for r in load_tables.read_quarantine(spark, tables).collect()} == {"u2", "u3", "u5", "u6"}
    silver = load_tables.silver_of_all(spark, tables, master_rows(spark, [("CS1", 1, "ACME")]))
    assert sorted(r.SOURCE_ID for r in silver.collect()) == ["1", "2", "5", "8", "9"]


def test_master_versions_and_messages_at_their_bounds(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    base = master_rows(spark, [("CS1", 1, "A"), ("CS1", 2, "Z"), ("CS2", 1, "B")])
    rows = base.withColumn("MASTER_LOAD_TIME", F.lit(t(5)))
    rows = rows.unionByName(base.withColumn("MASTER_LOAD_TIME", F.lit(t(7))))  # a reload that changes nothing
    rows = rows.unionByName(master_rows(spark, [("CS1", 1, "C"), ("CS3", 1, "D")]).withColumn("MASTER_LOAD_TIME", F.lit(t(9))))
    rows = rows.unionByName(master_rows(spark, [("CS1", 1, "A")]).withColumn("MASTER_LOAD_TIME", F.lit(t(12))))
    got = sorted((r.OCPP_CHARGE_STATION_ID, str(r.valid_from), str(r.valid_to), r.MANUFACTURER) for r in master_versions(rows).collect())
    assert got == [("CS1", "2024-01-09 00:00:00", "2024-01-12 00:00:00", "C"), ("CS1", "2024-01-12 00:00:00", "None", "A"), ("CS1", "None", "2024-01-09 00:00:00", "A"),
                   ("CS2", "None", "None", "B"), ("CS3", "None", "None", "D")]
    msgs = spark.createDataFrame([(1, "CS1", t(1)), (2, "CS1", t(9)), (3, "CS1", dt.datetime(2024, 1, 11, 23, 59, 59)), (4, "CS1", t(12)), (5, "CS3", t(1)), (6, "CS1", None), (7, None, t(1)), (8, "CS9", t(1))],
                                 "id long, identity_key string, SOURCE_MESSAGE_TIMESTAMP_CREATED timestamp")
    assert {r.id: r.MANUFACTURER for r in enrich_with_master(msgs, rows).collect()} == {1: "A", 2: "C", 3: "C", 4: "A", 5: "D", 6: "A"}


def test_changed_stations(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    at = lambda rows, d: master_rows(spark, rows).withColumn("MASTER_LOAD_TIME", F.lit(t(d)))
    before = at([("CS1", 1, "A"), ("CS2", 1, "B"), ("CS3", 1, "C")], 5)
    after = before.unionByName(at([("CS1", 1, "X"), ("CS2", 1, "B"), ("CS4", 1, "D")], 9)).unionByName(at([("CS3", 1, "Y")], 3))
    got = {r.station: (r.since, r.is_new) for r in master_reload.changed_stations(before, after).collect()}
    assert got == {"CS1": (t(9), False), "CS3": (None, False), "CS4": (None, True)}


def test_stored_frames_give_the_same_silver_as_lines(spark, tmp_base):
    rows = [r for load in random_loads(9, loads=1, lines=40) for r in load]
    bronze, master = bronze_rows(spark, rows), master_rows(spark, [("CS1", 1, "ACME"), ("CS2", 1, "OTHER")])
    assert equal(silver_from_frames(load_tables.frame_rows(bronze), master), to_silver(bronze, master))


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_base):
    from voltstream.session import settings

    tables = LoadTables(f"{tmp_base}/bronze", buckets=1)
    rows = bronze_rows(spark, [(i, "CS1", f'15-Jan-2024 10:00:00.000 [2,"m{i * 7919 % 100003}","Heartbeat",{{}}]@@EOM@@') for i in range(4000)]).repartition(8)
    limit = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(limit, None)
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}):
        load_tables.ingest_load(spark, tables, rows, "1", "2024-02-01")
    keys = load_tables.read(spark, tables, "keys")
    assert len(keys.inputFiles()) > 1 and keys.count() == 4000 and keys.select("id").distinct().count() == 4000
    assert spark.conf.get(limit, None) == before


def test_lines_of_two_loads_are_rendered_once(spark):
    from voltstream.plans import catalog_loads

    rows, early = catalog_loads._split_lines(spark, SF_SMALL)
    assert "Generate" not in plan_text(rows.where(early)) and rows.count() == fixtures.bronze_from_events(spark, SF_SMALL).count()
    assert "hashpartitioning(event_id" in plan_text(catalog_loads.reused_id_lines(spark, SF_SMALL))


def test_the_pattern_that_cuts_a_line_runs_once(spark):
    from voltstream.functions.frames import SEGMENT_PATTERN
    from voltstream.operators.silver import parse_frames

    plan = parse_frames(bronze_rows(spark, [(1, "CS1", "x")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(SEGMENT_PATTERN[:12]) == 1


def test_only_reused_message_ids_are_searched(spark, tmp_base, monkeypatch):
    """A message id with one call and one result of the load is answered without its history; others take the search."""
    master, tables, searched = master_rows(spark, [("CS1", 1, "ACME")]), LoadTables(f"{tmp_base}/bronze", buckets=2), []
    real = load_tables.changed_answers
    monkeypatch.setattr(load_tables, "changed_answers", lambda rows, *a: (searched.extend(sorted({r.OCPP_MESSAGE_UNIQUE_ID for r in rows.collect()})), real(rows, *a))[1])
    call = lambda i, t, mid: (i, "CS1", f'{t} [2,"{mid}","StartTransaction",{{}}]@@EOM@@')
    res = lambda i, t, mid: (i, "CS1", f'{t} [3,"{mid}",{{"transactionId":"{i}"}}]@@EOM@@')
    at = lambda s: f"15-Jan-2024 10:00:{s:02d}.000"
    loads = [([call(1, at(0), "A"), res(2, at(0), "A"), call(3, at(5), "B"), res(4, at(4), "B"), call(5, "", "C"), res(6, at(1), "C"),
               call(7, at(1), "D"), res(8, "", "D"), call(9, at(1), "E"), res(10, at(1), "F")], [], [("1", 2), ("3", None), ("5", None), ("7", None), ("9", None)]),
             ([res(11, at(2), "E"), call(12, at(0), "F"), call(13, at(6), "G")], ["E", "F"], [("12", 10), ("13", None), ("9", 11)]),
             # a bronze id that two message ids share: each call has its own result
             ([call(14, at(7), "H"), res(15, at(8), "H"), call(14, at(7), "I"), res(16, at(9), "I")], [], [("14", 15), ("14", 16)])]
    for n, (rows, hard, want) in enumerate(loads):
        load_tables.ingest_load(spark, tables, bronze_rows(spark, rows), f"l{n}", "2024-02-01")
        got = load_tables.silver_of_load(spark, tables, f"l{n}", "2024-02-01", master, arrange=medallion.gold_partition_value(), work=f"{tmp_base}/work{n}")
        assert sorted(((r.SOURCE_ID, r.TRANSACTION_ID) for r in got.collect()), key=str) == want
        assert searched == hard
        searched.clear()
