"""Upsert (MERGE semantics) edge cases and latest-wins de-duplication."""

import pytest
from pyspark.sql import functions as F

from voltstream.operators.dedup import latest_by_key
from voltstream.operators.merge import AmbiguousMergeError, upsert

SCHEMA = "k string, v int, stamp string"
SRC = "k string, v int, seq int"


def run(spark, target, source, mode="fixed", order=("seq",)):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SRC)
    out = upsert(t, s, ["k"], stamp_column="stamp", stamp=F.lit("new"), order=list(order), mode=mode)
    return sorted(((r.k, r.v, r.stamp) for r in out.collect()), key=lambda r: (r[0] or "", r[1]))


def test_empty_target(spark):
    assert run(spark, [], [("a", 1, 1)]) == [("a", 1, "new")]


def test_all_matched_and_mixed(spark):
    target = [("a", 1, "old"), ("b", 2, "old"), ("c", 3, "old")]
    assert run(spark, target, [("a", 10, 1), ("d", 40, 1)]) == [
        ("a", 10, "new"), ("b", 2, "old"), ("c", 3, "old"), ("d", 40, "new")]


def test_null_keys_never_match(spark):
    target = [(None, 1, "old"), ("a", 2, "old")]
    out = run(spark, target, [(None, 5, 1), ("a", 3, 1)])
    assert out == sorted([(None, 1, "old"), (None, 5, "new"), ("a", 3, "new")], key=lambda r: (r[0] or "", r[1]))


def test_duplicate_source_keys_fixed_latest_wins(spark):
    out = run(spark, [("a", 1, "old")], [("a", 10, 1), ("a", 20, 2), ("b", 1, 1), ("b", 2, 5)])
    assert out == [("a", 20, "new"), ("b", 2, "new")]


def test_duplicate_source_keys_faithful(spark):
    with pytest.raises(AmbiguousMergeError):
        run(spark, [("a", 1, "old")], [("a", 10, 1), ("a", 20, 2)], mode="faithful")
    # duplicates of an unmatched key are inserted as they come
    assert run(spark, [("x", 1, "old")], [("a", 10, 1), ("a", 20, 2)], mode="faithful") == [
        ("a", 10, "new"), ("a", 20, "new"), ("x", 1, "old")]


def test_idempotent(spark):
    t = spark.createDataFrame([("a", 1, "old")], SCHEMA)
    s = spark.createDataFrame([("a", 2, 1), ("b", 3, 1)], SRC)
    once = upsert(t, s, ["k"], stamp_column="stamp", stamp=F.lit("n"), order=["seq"])
    twice = upsert(once, s, ["k"], stamp_column="stamp", stamp=F.lit("n"), order=["seq"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_latest_by_key_hot_key(spark):
    """One key holding most rows is reduced map-side; NULL keys pass through unmerged."""
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(
            (F.col("id") % 50).cast("string")).alias("k"),
        F.col("id").alias("seq"))
    out = latest_by_key(df, ["k"], ["seq"])
    rows = {r.k: r.seq for r in out.filter(F.col("k").isNotNull()).collect()}
    assert rows["hot"] == 19998
    assert out.filter(F.col("k").isNull()).count() == df.filter(F.col("k").isNull()).count()


def test_merge_partitions_rewrites_touched_days_only(spark, tmp_base):
    import datetime as dt

    from voltstream.operators.merge import merge_partitions

    path = f"{tmp_base}/t"
    rows = [(f"k{i}", i, dt.datetime(2024, 1, 1 + i % 5), i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, v int, ts timestamp, seq int")
    part = F.to_date("ts")
    merge_partitions(path, df, ["k"], "dt", part, f"{tmp_base}/s1", stamp_column=None, order=["seq"])

    def files(day):
        t = spark.read.parquet(path).filter(F.col("dt") == F.lit(day).cast("date"))
        return sorted(r[0] for r in t.select(F.col("_metadata.file_path")).distinct().collect())

    before = files("2024-01-02")
    # update k0 (day 1) with a different day in the source: the row keeps its partition; add k99 on day 5
    inc = spark.createDataFrame([("k0", 1000, dt.datetime(2024, 1, 3), 1), ("k99", 99, dt.datetime(2024, 1, 5), 1)],
                                "k string, v int, ts timestamp, seq int")
    info = merge_partitions(path, inc, ["k"], "dt", part, f"{tmp_base}/s2", order=["seq"])
    assert sorted(str(d) for d in info["touched"]) == ["2024-01-01", "2024-01-03", "2024-01-05"]
    assert files("2024-01-02") == before  # untouched day: same files
    t = spark.read.parquet(path)
    assert t.count() == 51
    k0 = t.filter("k = 'k0'").first()
    assert (k0.v, str(k0.dt)) == (1000, "2024-01-01")


ROWS = "k string, v int, day string, seq int"


def merge(spark, base, rows, **options):
    from voltstream.operators.merge import merge_partitions

    return merge_partitions(f"{base}/t", spark.createDataFrame(rows, ROWS), ["k"], "dt", F.col("day"), f"{base}/s", order=["seq"], **options)


def contents(spark, base):
    return sorted((r.k or "", r.v, r.dt) for r in spark.read.parquet(f"{base}/t").collect())


def test_merge_of_an_empty_increment(spark, tmp_base):
    assert merge(spark, tmp_base, []) == {"touched": [], "first_load": True, "quarantined": 0}
    merge(spark, tmp_base, [("a", 1, "d1", 1)])
    assert merge(spark, tmp_base, [])["touched"] == []
    assert contents(spark, tmp_base) == [("a", 1, "d1")]


def test_half_done_swap_is_finished_before_the_next_read(spark, tmp_base, monkeypatch):
    from voltstream.operators import merge as m

    merge(spark, tmp_base, [("a", 1, "d1", 1), ("b", 2, "d2", 1)])
    monkeypatch.setattr(m, "_swap_in", lambda *a: (_ for _ in ()).throw(RuntimeError("died between stage and swap")))
    with pytest.raises(RuntimeError):
        merge(spark, tmp_base, [("a", 10, "d1", 2)])
    monkeypatch.undo()
    spark.createDataFrame([], "k string, v int, day string, seq int, dt string").write.mode("overwrite").parquet(f"{tmp_base}/t/dt=d1")  # the day that the swap had begun to delete
    merge(spark, tmp_base, [("c", 3, "d2", 1)])
    assert contents(spark, tmp_base) == [("a", 10, "d1"), ("b", 2, "d2"), ("c", 3, "d2")]
    assert m.recover(spark, f"{tmp_base}/t") == 0


def test_died_first_load_does_not_wedge_the_table(spark, tmp_base, monkeypatch):
    from voltstream.operators import merge as m

    monkeypatch.setattr(m, "_swap_in", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        merge(spark, tmp_base, [("a", 1, "d1", 1)])
    monkeypatch.undo()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{tmp_base}/t/_temporary/0")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    merge(spark, tmp_base, [("b", 2, "d1", 1)])
    assert contents(spark, tmp_base) == [("a", 1, "d1"), ("b", 2, "d1")]


def test_rows_without_a_key_go_to_quarantine_once_each_merge(spark, tmp_base):
    rows = [("a", 1, "d1", 1), (None, 7, "d1", 1)]
    for _ in range(2):
        info = merge(spark, tmp_base, rows, quarantine_path=f"{tmp_base}/q")
        assert info["quarantined"] == 1
    assert contents(spark, tmp_base) == [("a", 1, "d1")] and spark.read.parquet(f"{tmp_base}/q").count() == 2


def test_small_increment_does_not_shuffle_the_target(spark, tmp_base):
    from voltstream.plans.inspect import plan_text

    t = spark.range(100000).select(F.col("id").cast("string").alias("k"), F.col("id").cast("int").alias("v"), F.lit("old").alias("stamp"))
    spark.createDataFrame([("5", 1, 1)], SRC).write.parquet(f"{tmp_base}/s")
    s = spark.read.parquet(f"{tmp_base}/s")
    plan = plan_text(upsert(t, s, ["k"], stamp_column="stamp", stamp=F.lit("n"), order=["seq"]))
    assert "LeftAnti" in plan and "FullOuter" not in plan and "BroadcastHashJoin" in plan


def test_unreadable_table_is_no_empty_table(spark, tmp_base):
    from voltstream.sources.tables import read_parquet_if_exists

    assert read_parquet_if_exists(spark, f"{tmp_base}/none") is None
    spark.createDataFrame([("no parquet",)], "value string").write.text(f"{tmp_base}/bad")
    with pytest.raises(Exception, match="not a Parquet file"):
        read_parquet_if_exists(spark, f"{tmp_base}/bad").count()


def test_composite_key_with_one_null_part(spark):
    """(a, NULL) never matches (a, NULL): kept on the target side, inserted from the source."""
    t = spark.createDataFrame([("a", None, 1, "old"), ("a", "x", 2, "old")], "k1 string, k2 string, v int, stamp string")
    s = spark.createDataFrame([("a", None, 10, 1), ("a", "x", 20, 1)], "k1 string, k2 string, v int, seq int")
    out = upsert(t, s, ["k1", "k2"], stamp_column="stamp", stamp=F.lit("new"), order=["seq"])
    rows = sorted(((r.k1, r.k2 or "", r.v, r.stamp) for r in out.collect()))
    assert rows == [("a", "", 1, "old"), ("a", "", 10, "new"), ("a", "x", 20, "new")]


def test_whole_rows_are_moved_for_keys_that_come_twice_or_are_there_only(spark, tmp_base, monkeypatch):
    """Rows of other keys pass without a search for the latest; what is searched are the rows of the repeated keys."""
    from voltstream.operators import merge as m

    searched = []
    monkeypatch.setattr(m, "latest_by_key", lambda rows, *a: (searched.append(rows.count()), latest_by_key(rows, *a))[1])
    merge(spark, tmp_base, [("a", 1, "d1", 1), ("b", 2, "d1", 1), (None, 3, "d1", 1), (None, 4, "d1", 1)])
    assert searched == []
    merge(spark, tmp_base, [("a", 10, "d1", 2), ("a", 11, "d1", 3), ("c", 5, "d1", 1), ("d", 6, "d1", 2), ("d", 7, "d1", 1), (None, 8, "d1", 1)])
    assert searched == [4]
    assert contents(spark, tmp_base) == sorted([("", 3, "d1"), ("", 4, "d1"), ("", 8, "d1"), ("a", 11, "d1"), ("b", 2, "d1"), ("c", 5, "d1"), ("d", 6, "d1")])


def test_new_partitions_are_staged_once_and_nothing_staged_stays(spark, tmp_base, monkeypatch):
    """An arranged increment is written again for the partitions that the table has only; a died swap of both parts is finished."""
    from voltstream.operators import merge as m

    def files():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{tmp_base}/s")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getFileCount()

    merged = []
    monkeypatch.setattr(m, "upsert", lambda t, s, *a, **o: (merged.append(s.count()), upsert(t, s, *a, **o))[1])
    merge(spark, tmp_base, [("a", 1, "d1", 1), ("b", 2, "d2", 1), (None, 9, "d2", 1)], quarantine_path=f"{tmp_base}/q")
    merge(spark, tmp_base, [("a", 10, "d1", 2), ("c", 3, "d3", 1), ("d", 4, None, 1)], locate="same_partition", arranged=True)
    assert merged == [1] and files() == 0
    assert sorted(contents(spark, tmp_base), key=str) == [("a", 10, "d1"), ("b", 2, "d2"), ("c", 3, "d3"), ("d", 4, None)]
    merge(spark, tmp_base, [("e", 5, "d4", 1), ("e", 6, "d4", 2), ("d", 7, None, 2)], locate="same_partition", arranged=True)  # a key that comes twice
    assert merged == [1, 2]
    swap = m._swap_in
    monkeypatch.setattr(m, "_swap_in", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        merge(spark, tmp_base, [("b", 20, "d2", 2), ("f", 8, "d5", 1)], locate="same_partition", arranged=True)
    monkeypatch.setattr(m, "_swap_in", swap)
    assert m.recover(spark, f"{tmp_base}/t") == 2
    assert sorted(contents(spark, tmp_base), key=str) == [
        ("a", 10, "d1"), ("b", 20, "d2"), ("c", 3, "d3"), ("d", 7, None), ("e", 6, "d4"), ("f", 8, "d5")]
