"""SimHash near-duplicates: sharded vantage-point trees over 64-bit fingerprints, exact within the distance.

1. Fingerprint each whole text inside its scan task: A-Z lower-cased, words are runs without ASCII white
   space, ``shingle`` words joined by spaces and hashed with XXH64 (seed 42); a bit is set if it is set
   in over half the hashes. Fewer words than a shingle hash as one sequence; no words give 0.
2. Only distinct fingerprints go on (a partial aggregate), so copies never meet in a task.
3. A vantage-point tree, fitted on a bounded sample of fingerprints, deals them into shards: at a node with
   vantage v and radius m, those with d(v, x) <= m + distance go inside and those with d(v, x) > m outside.
   By the triangle inequality two fingerprints within ``distance`` that part at a node differ by at most
   ``distance`` in d(v, .), so both are inside: every close pair meets in at least one shard, whatever the
   sample was. The sample only decides how even the shards are.
4. Each shard is searched with a local tree of the same kind and gives a spanning forest of its links.
5. Links are joined up (``common.components``); each document gets the smallest id of its component.

Cases: very long texts are read whole, one slice of a task each; NULL and empty texts have fingerprint 0 and link with each other; NULL ids never become a
component id unless all ids of a component are NULL; repeated rows stay, one result row each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.llm.common import components, filled, free_name, local_roots, row_key, segment_sums, stage, text_slices, u64

#: Fingerprints the shard tree is fitted on; more only make shards more even.
SAMPLE = 16_384
#: Fingerprints wanted in a shard before overlap.
SHARD = 512


def shingle_hashes(text: str, shingle: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every ``shingle``-word sequence of the text, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII rules only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(joined, seed)], np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    begin = (end - length)[: len(words) - shingle + 1].tolist()
    return np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(begin, end[shingle - 1:].tolist())), np.uint64, len(begin))


def fingerprint(hashes: list[np.ndarray]) -> np.ndarray:
    """The majority bits of each text's hashes, as uint64."""
    start = np.concatenate([[0], np.cumsum([len(h) for h in hashes], dtype=np.int64)])
    joined = np.concatenate([*hashes, np.empty(0, np.uint64)])
    bits = np.unpackbits(joined.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = segment_sums(bits.astype(np.int32), start)
    packed = np.packbits(2 * ones > np.diff(start)[:, None], axis=1, bitorder="little")
    return packed.view("<u8").reshape(-1).astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", 1 << 20):
            fp = fingerprint([shingle_hashes(t, shingle) for t in filled(part, "text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(u64(fp))], ["doc_id", "text_hash", "fp"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


class VantageTree:
    """Nodes as arrays; a node with ``inside`` < 0 is shard ``-inside - 1``."""

    def __init__(self, sample: np.ndarray, rows: int, shard: int):
        self.vantage, self.radius, self.inside, self.outside, self.shards = [], [], [], [], 0
        self._grow(sample, rows, shard)

    def _leaf(self) -> int:
        self.shards += 1
        return -self.shards

    def _grow(self, sample: np.ndarray, rows: float, shard: int) -> int:
        if rows <= shard or len(sample) < 4:
            return self._leaf()
        d = np.bitwise_count(sample ^ sample[0])
        radius = int(np.median(d))
        if (d <= radius).all():
            radius = int(d.max()) - 1
        if radius < 0:
            return self._leaf()
        near, node = d <= radius, len(self.vantage)
        for x, v in ((self.vantage, int(sample[0])), (self.radius, radius), (self.inside, 0), (self.outside, 0)):
            x.append(v)
        share = near.mean()
        self.inside[node] = self._grow(sample[near], rows * share, shard)
        self.outside[node] = self._grow(sample[~near], rows * (1 - share), shard)
        return node

    def shards_of(self, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, shard) for every shard that each fingerprint belongs to."""
        rows, shards, todo = [], [], [(0 if self.vantage else -1, np.arange(len(fps)))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                rows.append(at)
                shards.append(np.full(len(at), -node - 1))
            elif len(at):
                d = np.bitwise_count(fps[at] ^ np.uint64(self.vantage[node]))
                todo.append((self.inside[node], at[d <= self.radius[node] + distance]))
                todo.append((self.outside[node], at[d > self.radius[node]]))
        return np.concatenate(rows), np.concatenate(shards)


def close_pairs(fps: np.ndarray, distance: int, leaf: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of distinct fingerprints at most ``distance`` bits apart (a pair may come twice)."""
    left, right, todo = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        if len(at) > leaf:
            d = np.bitwise_count(fps[at] ^ fps[at[len(at) // 2]])
            radius = np.median(d)
            inside, outside = at[d <= radius + distance], at[d > radius]
            if len(inside) < 0.9 * len(at):
                todo += [inside, outside]
                continue
        for k in range(0, len(at), 256):  # blocks: 256 rows against those from them on
            rows, rest = at[k:k + 256], at[k:]
            i, j = np.nonzero(np.bitwise_count(fps[rows][:, None] ^ fps[rest][None, :]) <= distance)
            keep = i < j
            left.append(rows[i[keep]])
            right.append(rest[j[keep]])
    return np.concatenate(left), np.concatenate(right)


def fingerprint_links(spark: SparkSession, fps: DataFrame, distance: int = 2, shard: int = SHARD) -> DataFrame:
    """Links (a, b) between distinct values of ``fps.fp`` whose components are those of all close pairs."""
    n = fps.count()
    sample = fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    tree = VantageTree(np.array([r.fp for r in sample], np.int64).view(np.uint64), n, shard)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy()
            row, to = tree.shards_of(values.view(np.uint64), distance)
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(values[row])], ["shard", "fp"])

    def link(part: pa.Table) -> pa.Table:
        values = part.column("fp").to_numpy()
        a, b = close_pairs(values.view(np.uint64), distance)
        root = local_roots(len(values), a, b)
        tied = np.flatnonzero(root != np.arange(len(values)))
        return pa.table({"a": values[tied], "b": values[root[tied]]})

    return fps.mapInArrow(deal, "shard long, fp long").groupBy("shard").applyInArrow(link, "a long, b long")


def simhash_classes(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 2, shard: int = SHARD) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, root (smallest fp of the component), component_id (smallest id in it)."""
    marked = stage(spark, fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stage(spark, marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(spark, fingerprint_links(spark, distinct.select("fp"), distance, shard))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = stage(spark, rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    # tables of their own on both sides: a hot class can be split in either join
    classes = stage(spark, rooted.join(least, "root").select("fp", "root", "component_id"), "classes")
    return marked.join(classes, "fp")


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id (NULL last), then the smallest xxhash64(text).

    Of rows that repeat this id and text, the one of smallest hash over all columns stays.
    """
    found = stage(spark, simhash_classes(spark, docs, id_col, text_col, **options).select("doc_id", "text_hash", "root"), "classes")
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("n")), F.lit(":"), F.hex("text_hash"))  # as row_key
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("best")).select("best.*")
    name = free_name(docs, "_key")
    kept = stage(spark, best.select(key.alias(name)), "kept")
    again = stage(spark, found.groupBy("doc_id", "text_hash").count().where("count > 1").select(key.alias(name)), "again")
    rows = docs.join(kept, row_key(id_col, text_col) == F.col(name), "left_semi")
    if again.isEmpty():
        return rows
    once = rows.join(again, row_key(id_col, text_col) == F.col(name), "left_anti")
    more = rows.join(again, row_key(id_col, text_col) == F.col(name), "left_semi")
    whole = F.struct(*[F.col(c) for c in docs.columns])
    first = more.groupBy(row_key(id_col, text_col)).agg(F.min_by(whole, F.struct(F.xxhash64(whole), F.hash(whole))).alias("row"))
    return once.union(first.select("row.*"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_classes(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
