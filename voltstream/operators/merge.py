"""Keyed upsert (MERGE semantics) as a DataFrame operator, no table format needed.

``upsert(target, source, keys)`` returns the new table contents:

* matched keys      → the source row's values, stamp = ``stamp``
* source-only keys  → inserted, stamp = ``stamp``
* target-only keys  → kept unchanged
* no delete clause, as in the original MERGE

Plan: the source is reduced to the latest row per key first (``fixed``), with
a partial aggregate. Where it brings every column of the target, the result is
``target left-anti source keys`` ∪ ``source``: only the source's narrow keys
move, Spark may broadcast them or split a skewed side, and with a small
increment the target isn't shuffled. Otherwise (columns to keep from the
target) it is one full outer equi-join with presence flags. Rows with a NULL
key part can never match: target ones are kept, source ones inserted.

``faithful`` reproduces MERGE behaviour without de-duplication: it raises
when several source rows match one target row, and inserts duplicate
unmatched source keys as separate rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.functions.frames import check_mode
from voltstream.operators.dedup import latest_by_key
from voltstream.operators.joins import all_not_null, any_null, null_key_salt
from voltstream.session import settings


class AmbiguousMergeError(ValueError):
    """Several source rows match the same target row."""


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    stamp_column: str | None = None,
    stamp: Column | None = None,
    order: Sequence[str] | None = None,
    mode: str = "fixed",
    sticky: Sequence[str] = (),
    single: bool = False,
    hits: DataFrame | None = None,
) -> DataFrame:
    """New contents of ``target`` after merging ``source`` into it by ``keys``.

    ``target`` defines the output columns. Columns missing from ``source`` are
    NULL on insert and kept on update; ``stamp_column`` (if given) is set to
    ``stamp`` (default ``current_timestamp()``) on every updated or inserted row.
    ``order`` picks the surviving source row per key in ``fixed`` mode
    (greatest wins; default: all source columns, i.e. an arbitrary but
    deterministic choice). ``sticky`` columns keep the target's value on a
    match (e.g. the partition column, so a row never moves partition).
    ``single``: the source has one row per key already. ``hits``: the keys that both have, where they are known.
    """
    check_mode(mode)
    keys = list(keys)
    cols = target.columns
    if stamp_column is not None and stamp is None:
        stamp = F.current_timestamp()

    order = list(order) if order else [c for c in source.columns if c in cols and c not in keys]
    keep = [c for c in source.columns if c in cols or c in order]
    src = source.select(*keep)
    if mode == "fixed" and not single:
        src = latest_by_key(src, keys, order)
    src = src.select(*[c for c in src.columns if c in cols])
    if mode == "faithful":
        _check_unambiguous(target, src, keys)

    if all(c in src.columns or c == stamp_column or c in keys for c in cols) and not sticky:
        types = {f.name: f.dataType for f in target.schema}
        new = src.select(*[(stamp if c == stamp_column else F.col(c)).cast(types[c]).alias(c) for c in cols])
        return _matching(target, src if hits is None else hits, keys, "left_anti").select(*cols).union(new)

    def value_for_insert(c: str) -> Column:
        if c == stamp_column:
            return stamp.cast(target.schema[c].dataType)
        if c in src.columns:
            return F.col(f"s.{c}").cast(target.schema[c].dataType)
        return F.lit(None).cast(target.schema[c].dataType)

    t = target.withColumns({"_t_present": F.lit(True), "_nk": null_key_salt(keys)}).alias("t")
    s = src.withColumns({"_s_present": F.lit(True), "_nk": null_key_salt(keys, negative=True)}).alias("s")
    cond = F.col("t._nk") == F.col("s._nk")
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    joined = t.join(s, cond, "full_outer")
    from_source = F.col("s._s_present").isNotNull()

    out = []
    for c in cols:
        if c in keys:
            e = F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        elif c in sticky and c != stamp_column:
            e = F.when(F.col("t._t_present").isNotNull(), F.col(f"t.{c}")).otherwise(value_for_insert(c))
        elif c == stamp_column or c in src.columns:
            e = F.when(from_source, value_for_insert(c)).otherwise(F.col(f"t.{c}"))
        else:
            e = F.col(f"t.{c}")
        out.append(e.alias(c))
    return joined.select(*out)


def _matching(rows: DataFrame, found: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows whose key is in ``found`` (``left_semi``) or isn't (``left_anti``)."""
    found = found.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & (rows[k] == F.col(f"_k{i}"))
    return rows.join(found, cond, how)


def _single(stored: DataFrame, keys: Sequence[str], order: Sequence[str], path: str) -> DataFrame:
    """``latest_by_key`` of stored rows. Keys that come more than once are looked for in the key columns and written to
    ``path``, so that only their rows are moved whole."""
    twice = stored.filter(all_not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys)
    twice.write.parquet(path)
    twice = stored.sparkSession.read.schema(twice.schema).parquet(path)
    if twice.isEmpty():
        return stored
    rest = _matching(stored, twice, keys, "left_anti")
    return rest.unionByName(latest_by_key(_matching(stored, twice, keys, "left_semi"), keys, order))


def _check_unambiguous(target: DataFrame, src: DataFrame, keys: list[str]) -> None:
    """Raise when one target row would be matched by several source rows."""
    dup = src.filter(all_not_null(keys)).groupBy(*keys).count().filter(F.col("count") > 1).select(*keys)
    hit = dup.join(target.select(*keys).filter(all_not_null(keys)), keys, "left_semi")
    if not hit.isEmpty():
        raise AmbiguousMergeError("several source rows match the same target row")


#: where a stored increment's rows belong: the first partition column of its folder
_PLACE, _NO_KEY, _ALONE, _THERE = "merge_place", "no_key", "alone", "there"


def _partitions(spark: SparkSession, table: DataFrame, partition_col: str) -> list:
    """The table's partition values, from the listing of its files."""
    with settings(spark, {"spark.sql.optimizer.metadataOnly": "true"}):
        return [r[0] for r in table.select(partition_col).distinct().collect()]


def _is_in(partition_col: str, values: Sequence, kind=None) -> Column:
    """If a partition value (as ``kind``, where given) is one of ``values``, NULL being a value too."""
    value = F.col(partition_col)
    found = (value if kind is None else value.try_cast(kind)).isin([v for v in values if v is not None])
    return F.when(value.isNull(), F.lit(None in values)).otherwise(F.coalesce(found, F.lit(False)))


def _types(df: DataFrame, partition_col: str) -> dict:
    return {f.name: f.dataType for f in df.schema if f.name != partition_col}


def _log(table_path: str) -> str:
    return f"{table_path.rstrip('/')}__swaps"


def _note(spark: SparkSession, table_path: str, staged: Sequence[str], partition_col: str, done: bool) -> None:
    """One file for all staged folders of a merge, so that they are noted together."""
    folders = F.explode(F.array(*[F.lit(s) for s in staged]))
    rows = spark.range(1).select(folders.alias("staged"), F.lit(partition_col).alias("partition_col"), F.lit(done).alias("done"),
                                 F.current_timestamp().alias("at"))
    rows.coalesce(1).write.mode("append").parquet(_log(table_path))


def _swap_in(spark: SparkSession, table_path: str, staged: Sequence[str], partition_col: str) -> None:
    """Replace the partitions that the ``staged`` folders have (each has others); the rest is not touched."""
    for folder in staged:
        (spark.read.parquet(folder).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_col).parquet(table_path))
    _note(spark, table_path, staged, partition_col, True)


def recover(spark: SparkSession, table_path: str) -> int:
    """Finish swaps that died half-way, before anything reads the table. Returns how many folders were swapped in."""
    from voltstream.sources.tables import discard, read_parquet_if_exists

    notes = read_parquet_if_exists(spark, _log(table_path))
    if notes is None:
        return 0
    # a row per staged folder, two at most of a merge, a handful open at most
    open_ = notes.groupBy("staged", "partition_col").agg(F.max("done").alias("done"), F.min("at").alias("at")).where("not done").orderBy("at").collect()
    for r in open_:
        _swap_in(spark, table_path, [r["staged"]], r["partition_col"])
        discard(spark, r["staged"])
    return len(open_)


def merge_partitions(
    table_path: str,
    increment: DataFrame,
    keys: Sequence[str],
    partition_col: str,
    partition_value: Column,
    stage_path: str,
    stamp_column: str | None = None,
    stamp: Column | None = None,
    order: Sequence[str] | None = None,
    locate: str = "scan",
    quarantine_path: str | None = None,
    arranged: bool = False,
) -> dict:
    """Upsert ``increment`` into a partitioned parquet table, rewriting only touched partitions.

    0. A swap that died half-way is finished first (``recover``).
    1. The increment is written once under ``stage_path``; rows with a NULL key
       part go to ``quarantine_path`` if given (they match nothing, so each
       repeated merge would insert them again). ``arranged``: its tasks hold
       few partitions each, so its files are right-sized as they are written.
    2. A row that already exists keeps its partition. ``locate="scan"`` finds
       it with a join on the key columns of the table only. With
       ``locate="same_partition"`` the partition value must be a fixed
       function of the key's row (e.g. the day of an immutable event time);
       then only the increment's partitions are read and written.
    3. ``upsert`` over the pruned target is staged in a fresh folder, noted as
       staged, then swapped in with a dynamic partition overwrite and noted as
       done. If the job dies in between, the staged copy is complete and the
       next merge (or ``recover``) swaps it in again; nothing overwrites it.
       In partitions that the table hasn't got yet (all, at the first load) the
       written increment is the new contents, if it is arranged and each key
       comes once: it is staged as it is, not written again.

    What was staged is removed after the swap.

    An empty increment changes nothing. Returns the touched partitions, if
    this was the first load, and how many rows were quarantined.
    """
    from voltstream.sources.tables import discard, read_parquet_if_exists

    if locate not in ("scan", "same_partition"):
        raise ValueError("locate must be 'scan' or 'same_partition'")
    keys = list(keys)
    spark = increment.sparkSession
    recover(spark, table_path)
    attempt = f"{stage_path.rstrip('/')}/{uuid.uuid4().hex[:12]}"
    table = read_parquet_if_exists(spark, table_path)
    first_load = table is None
    if stamp_column is not None and stamp is None:
        stamp = F.current_timestamp()
    rows = increment.withColumn(partition_col, partition_value)
    order = list(order) if order else [c for c in rows.columns if c not in keys]
    stamped = stamp_column is not None and stamp_column not in rows.columns
    whole = rows.withColumn(stamp_column, stamp) if stamped else rows
    # partitions that the increment alone makes up, unless a key comes twice
    alone = None
    if first_load:
        if stamped or stamp_column is None:
            alone, whole = F.lit(True), whole if arranged else whole.hint("rebalance", partition_col)
    elif arranged and locate == "same_partition" and _types(whole, partition_col) == _types(table, partition_col):
        alone = ~_is_in(partition_col, _partitions(spark, table, partition_col), table.schema[partition_col].dataType)
    place = F.lit(_THERE) if alone is None else F.when(alone, _ALONE).otherwise(_THERE)
    if quarantine_path is not None:
        place = F.when(any_null(keys), _NO_KEY).otherwise(place)
    whole = whole.withColumn(_PLACE, place)
    writer = whole.write if alone is None else whole.write.partitionBy(_PLACE, partition_col)
    writer.parquet(f"{attempt}/increment")
    stored = spark.read.schema(whole.schema).parquet(f"{attempt}/increment")
    quarantined = 0
    if quarantine_path is not None:
        bad = stored.filter(F.col(_PLACE) == _NO_KEY).select(*rows.columns)
        quarantined = bad.count()
        if quarantined:
            bad.write.mode("append").parquet(quarantine_path)
        stored = stored.filter(F.col(_PLACE) != _NO_KEY)

    inc = stored
    inc_parts = inc.select(partition_col)
    if table is not None and locate == "scan":
        old = table.select(*keys, F.col(partition_col).alias("_old_part"))
        located = inc.join(old, keys, "left")
        inc_parts = inc_parts.union(located.filter(F.col("_old_part").isNotNull()).select("_old_part"))
        inc = located.withColumn(partition_col, F.coalesce("_old_part", partition_col)).drop("_old_part")
    # one value per touched partition (days), bounded by the time span, not by rows
    touched = [r[0] for r in inc_parts.distinct().collect()]
    if not touched:
        discard(spark, attempt)
        return {"touched": [], "first_load": first_load, "quarantined": quarantined}
    staged = []
    # whole rows are moved for keys that come twice, or that the table has, only
    single = _single(inc, keys, order, f"{attempt}/twice")
    if alone is not None and single is inc and not inc.filter(F.col(_PLACE) == _ALONE).isEmpty():
        staged.append(f"{attempt}/increment/{_PLACE}={_ALONE}")
        inc = inc.filter(F.col(_PLACE) == _THERE)
        rest = [r[0] for r in inc.select(partition_col).distinct().collect()]
    else:
        inc, rest = single, touched
    inc = inc.select(*rows.columns)
    if rest:
        if table is None:
            merged = inc
            if stamp_column is not None:
                merged = merged.withColumn(stamp_column, stamp)
        else:
            target = table.filter(_is_in(partition_col, rest))
            hits = target.select(*keys).join(inc.select(*keys).filter(all_not_null(keys)), keys, "left_semi").distinct()
            hits.write.parquet(f"{attempt}/hits")
            merged = upsert(target, inc.select(*[c for c in inc.columns if c in table.columns or c in order]),
                            keys, stamp_column=stamp_column, stamp=stamp, order=order, single=True,
                            hits=spark.read.schema(hits.schema).parquet(f"{attempt}/hits"))
        # rebalance by partition value: few, right-sized files per day; AQE splits a hot day
        merged.hint("rebalance", partition_col).write.partitionBy(partition_col).parquet(f"{attempt}/merged")
        staged.append(f"{attempt}/merged")
    _note(spark, table_path, staged, partition_col, False)
    if staged == [f"{attempt}/merged"]:
        discard(spark, f"{attempt}/increment")
    _swap_in(spark, table_path, staged, partition_col)
    discard(spark, attempt)
    return {"touched": None if first_load else touched, "first_load": first_load, "quarantined": quarantined}
