"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a seeded random order, form blocks of ``block`` documents; one block takes one
slot of the mix. With target weight w the source's j-th block (j = 1, 2, ...) is released at slot
floor((j - 1) / w) and due by slot ceil(j / w); in each slot the released block with the earliest deadline
goes (ties: the source's name). As the weights sum to one, every deadline holds, so after any number t of
slots a source has had more than w t - 1 and fewer than w t + 1 blocks.

Weights are taken as exact fractions, so that holds against the weights as they are, however long the mix and
however small a source. The schedule is one sequential pass over the slots of the whole mix, in a task of its own that
holds one block of each source at a time and writes a row per block; it is joined with the
documents on (source, block). A caller's ``period`` rounds weights to p / period (largest remainder, at least
1 / period) instead. Document ranks come from one range partitioning by (source, order) and prefix sums over its
partitions, so a hot source spreads over many.

The mix ends with the slot in which the last source has been through all its documents. Until then a source
that has run out starts over (its next epoch): no document is lost, weights hold to the end. Default targets
are the sources' shares in blocks to the power ``temper``, which bounds a source's epochs by
(largest share / its share) ** (1 - temper), and the block that a slot more or less makes; given weights bound them by their own choice.

Cases: NULL is a source of its own; NULL and empty texts and NULL ids are documents like others; repeated
rows are scheduled each; an empty table gives an empty mix; a source without a given weight, or with
weight 0, is left out of the mix by that choice; extra columns pass through ``mixed_documents``.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltstream.llm.common import stage

#: Blocks of the schedule that are written at a time.
BATCH = 1 << 16


def shares_to_counts(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole blocks per period, at least 1 each, that sum to ``period`` (largest remainder)."""
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    counts = {s: max(1, math.floor(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (counts[s] - exact[s], s))
    spare = period - sum(counts.values())
    while spare > 0:
        for s in order[:spare]:
            counts[s] += 1
        spare = period - sum(counts.values())
    while spare < 0:
        rich = max(counts, key=lambda s: (counts[s] - exact[s], counts[s], s) if counts[s] > 1 else (-math.inf, 0, s))
        counts[rich] -= 1
        spare += 1
    return counts


def pfair_period(counts: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source's blocks in one period: earliest deadline first among released blocks."""
    period = sum(counts.values())
    release = {s: [j * period // p for j in range(p)] for s, p in counts.items()}
    due = {s: [-(-(j + 1) * period // p) for j in range(p)] for s, p in counts.items()}
    waiting = [(release[s][0], s, 0) for s in sorted(counts)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {s: [] for s in counts}
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due[s][j], s, j))
        deadline, s, j = heapq.heappop(ready)
        assert slot < deadline, "a deadline was missed"
        slots[s].append(slot)
        if j + 1 < counts[s]:
            heapq.heappush(waiting, (release[s][j + 1], s, j + 1))
    return slots


def exact_counts(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportion of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    denominator = math.lcm(*[x.denominator for x in exact.values()])
    return {s: int(x * denominator) for s, x in exact.items()}


def pfair_mix(counts: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int]]:
    """(source, its block's number from 0) slot by slot, earliest deadline first among released blocks, until every
    source has had ``blocks``; a source's share is its count of the sum of ``counts``."""
    total, left = sum(counts.values()), len(counts)
    waiting = [(0, s, 0) for s in sorted(counts)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slot = 0
    while left:
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // counts[s]), s, j))
        deadline, s, j = heapq.heappop(ready)
        assert slot < deadline, "a deadline was missed"
        yield s, j
        left -= j + 1 == blocks[s]
        heapq.heappush(waiting, ((j + 1) * total // counts[s], s, j + 1))
        slot += 1


def _schedule(spark: SparkSession, counts: dict[str, int], blocks: dict[str, int]) -> DataFrame:
    """A row per slot of the mix: _s, _at (block of the source), epoch, slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not sum(batch.num_rows for batch in batches):
            return
        found, slot = [], 0

        def batch() -> pa.RecordBatch:
            columns = [s for s, _ in found], [j % blocks[s] for s, j in found], [j // blocks[s] for s, j in found], range(slot - len(found), slot)
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], ["_s", "_at", "epoch", "slot"])

        for pair in pfair_mix(counts, blocks):
            found.append(pair)
            slot += 1
            if len(found) == BATCH:
                yield batch()
                found = []
        if found:
            yield batch()

    return stage(spark, spark.range(0, 1, 1, 1).mapInArrow(run, "_s string, _at long, epoch long, slot long"), "schedule")


def _source_key(col: Column) -> Column:
    return F.when(col.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), col.cast("string")))


def _ranked(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` (with ``_source`` and ``_order``), each with its 0-based ``_rank`` in the source."""
    ordered = rows.repartitionByRange("_source", "_order").sortWithinPartitions("_source", "_order")
    ordered = stage(spark, ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn("_part", F.shiftright("_at", 33))
    runs = ordered.groupBy("_source", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(spark, runs.select(F.col("_source").alias("_s"), F.col("_part").alias("_p"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "runs")
    joined = ordered.join(runs, (ordered._source == runs._s) & (ordered._part == runs._p))
    return joined.withColumn("_rank", F.col("_at") - F.col("_first") + F.col("_before")).drop("_s", "_p", "_first", "_before", "_at", "_part", "_order")


def mix(spark: SparkSession, rows: DataFrame, source_col: str = "source", order_cols: tuple = ("doc_id",), weights: dict | None = None,
        block: int = 8, temper: float = 0.9, seed: int = 42, period: int | None = None) -> DataFrame:
    """``rows``, one per occurrence in the mix, with ``slot``, ``place`` (in the block) and ``epoch``.

    ``weights``: target weight by source; else tempered shares. ``period``: weights are rounded to multiples
    of 1 / period (with more sources, 1 / four times their number), else exact. Random order within a source is
    xxhash64 of ``order_cols`` and ``seed``, then ``order_cols``.
    """
    order = F.struct(F.xxhash64(F.lit(seed), *[F.col(c) for c in order_cols]).alias("h"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)])
    ranked = _ranked(spark, rows.withColumn("_source", _source_key(F.col(source_col))).withColumn("_order", order))
    # one row per source
    size = {r["_source"]: r["n"] for r in ranked.groupBy("_source").agg(F.count("*").alias("n")).collect()}
    blocks = {s: -(-n // block) for s, n in size.items()}
    if weights is None:
        target = {s: b ** temper for s, b in blocks.items()}
    else:
        named = {("n" if s is None else f"s{s}"): w for s, w in weights.items()}
        target = {s: named[s] for s in blocks if named.get(s, 0) > 0}
    if not target:
        none = rows.where(F.lit(False))
        return none.withColumns({"slot": F.lit(0).cast("long"), "place": F.lit(0).cast("long"), "epoch": F.lit(0).cast("long")})
    counts = exact_counts(target) if period is None else shares_to_counts(target, max(period, 4 * len(target)))
    schedule = _schedule(spark, counts, {s: blocks[s] for s in counts})
    known = ranked.withColumn("_b", F.floor(F.col("_rank") / block).cast("long"))
    placed = known.join(schedule.select("_s", "_at", F.col("epoch").alias("_epoch"), F.col("slot").alias("_slot")), (F.col("_source") == F.col("_s")) & (F.col("_b") == F.col("_at")))
    return placed.select(
        *[ranked[c] for c in rows.columns], F.col("_slot").alias("slot"), (F.col("_rank") % block).cast("long").alias("place"), F.col("_epoch").alias("epoch"))


def mixed_documents(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` in mix order: rows sorted by slot and place over all partitions, a row for each epoch of a document."""
    name = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # names that can't clash
    inner = docs.toDF(*name.values()).withColumn("h", F.xxhash64(name[text_col]))
    mixed = mix(spark, inner, source_col=name[source_col], order_cols=(name[id_col], "h"), **options)
    mixed = mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return mixed.select(*[F.col(c).alias(n) for n, c in name.items()])


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    return mix(spark, docs)
