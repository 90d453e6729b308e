"""Embedding near-duplicates: a forest of random-projection trees with spill, exact cosine checks in the leaves.

Equal vectors collapse first (a partial aggregate), so copies never meet in a task; what follows works on distinct
vectors with their number of copies. Every tree splits recursively at the median projection on a random direction;
vectors within ``spill`` of the cut go to both sides. Trees are fitted on a bounded sample (``SAMPLE`` vectors), every
vector is dealt. In each leaf all pairs are compared by cosine, in single precision first, near the threshold and above it in double
precision. A vector carries its leaves, and
a pair counts only in the smallest leaf that both are in, so links need not be listed or made distinct: a leaf
gives link counts and a spanning forest of its links, which ``common.components`` joins up.

``spill`` is half the spread that the projections of a pair at the threshold differ by (sqrt(2 - 2 threshold) /
sqrt(dimensions)); a tree then parts such a pair with a probability of about 0.02 a level, and it is lost only if all
trees part it. Depth and density raise that, so the forest is not of a fixed size: to each sampled vector a partner at
the threshold is made up, and beyond the first ``trees`` trees more are grown until at most ``MISSED`` of these pairs
are parted by all. The tests measure recall against brute force, in a dense topic too.

A leaf beyond ``LARGE`` (vectors that no cut parts, or more data than the sample's leaves can hold) is dealt into
chunks, and its pairs of chunks are compared as leaves of their own: bounded tasks, no pair left out.

Cases: NULL, empty and zero vectors and those with NULL or non-finite components link with nothing; vectors of
different lengths never link; repeated ids are rows of their own, NULL ids never become a component id unless all
of a component's are; an empty table gives an empty result; other columns (labels too) are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.llm.common import components, local_roots, stage

#: Vectors that trees are fitted on; distinct vectors wanted in a leaf; leaf size from which on leaves are cut into chunks.
SAMPLE, LEAF, LARGE = 16_384, 256, 4096
#: Share of pairs at the threshold that the forest may part, estimated on the sample.
MISSED = 0.0005


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Tree:
    """Random splits; ``leaves_of`` gives the leaves of vectors, numbered from 0."""

    def __init__(self, sample: np.ndarray, rows: int, spill: float, leaf: int, rng: np.random.Generator):
        self.spill, self.leaves = spill, 0
        self.direction, self.cut, self.low, self.high = [], [], [], []
        self.root = self._grow(sample, rows, leaf, rng)

    def _grow(self, sample: np.ndarray, rows: float, leaf: int, rng: np.random.Generator) -> int:
        if rows > leaf and len(sample) >= 8:
            direction = rng.standard_normal(sample.shape[1])
            direction /= np.sqrt((direction * direction).sum())
            along = sample @ direction
            cut = float(np.median(along))
            low, high = along <= cut + self.spill, along >= cut - self.spill
            if max(low.mean(), high.mean()) < 0.9:  # else the cut doesn't part them
                node = len(self.cut)
                self.direction.append(direction)
                self.cut.append(cut)
                self.low.append(0)
                self.high.append(0)
                self.low[node] = self._grow(sample[low], rows * low.mean(), leaf, rng)
                self.high[node] = self._grow(sample[high], rows * high.mean(), leaf, rng)
                return node
        self.leaves += 1
        return -self.leaves

    def leaves_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, leaves, todo = [], [], [(self.root, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                rows.append(at)
                leaves.append(np.full(len(at), -node - 1))
            elif len(at):
                along = x[at] @ self.direction[node]
                todo.append((self.low[node], at[along <= self.cut[node] + self.spill]))
                todo.append((self.high[node], at[along >= self.cut[node] - self.spill]))
        return np.concatenate(rows), np.concatenate(leaves)

    def parted(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether row i of ``x`` and row i of ``y`` share no leaf."""
        one, two = (row * self.leaves + leaf for row, leaf in (self.leaves_of(x), self.leaves_of(y)))
        apart = np.ones(len(x), bool)
        apart[np.intersect1d(one, two, assume_unique=True) // self.leaves] = False
        return apart


def _partners(x: np.ndarray, threshold: float, rng: np.random.Generator) -> np.ndarray:
    """For each unit vector one of cosine ``threshold`` with it (one dimension: itself)."""
    away = rng.standard_normal(x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.maximum(np.sqrt((away * away).sum(axis=1, keepdims=True)), 1e-9)
    return unit(threshold * x + np.sqrt(max(0.0, 1 - threshold * threshold)) * away) if x.shape[1] > 1 else x


def forest(x: np.ndarray, rows: int, threshold: float, trees: int, leaf: int, spill: float, seed: int) -> list[Tree]:
    """Trees for ``rows`` unit vectors, fitted on the sample ``x``: ``trees`` at least, more while they miss too much."""
    dimensions = x.shape[1]
    margin = spill * np.sqrt(max(0.0, 2 - 2 * threshold) / dimensions)
    y = _partners(x, threshold, np.random.default_rng([seed, dimensions]))
    apart = np.arange(len(x))  # the made-up pairs that no tree so far keeps together
    grown: list[Tree] = []
    while len(grown) < trees or len(apart) > MISSED * len(x):
        grown.append(Tree(x, rows, margin, leaf, np.random.default_rng([seed, dimensions, len(grown)])))
        if grown[-1].leaves == 1:  # all pairs meet in one leaf
            break
        if len(apart):
            apart = apart[grown[-1].parted(x[apart], y[apart])]
    return grown


def _matrix(column) -> np.ndarray:
    """A list column of equal lengths as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _compare(table: pa.Table, threshold: float) -> pa.Table:
    """Of one leaf (or pair of chunks): rows (a, weight, NULL) that add to a's links, and spanning links (a, NULL, b)."""
    rep, copies, chunk = (table.column(c).to_numpy() for c in ("rep", "copies", "chunk"))
    own, cross = table.column("leaf")[0].as_py(), table.column("other")[0].as_py() != table.column("part")[0].as_py()
    x = unit(_matrix(table.column("v")))
    rough = x.astype(np.float32)
    lists = table.column("leaves").combine_chunks()
    of, leaf = np.repeat(np.arange(len(x)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
    of, leaf = of[leaf < own], leaf[leaf < own]
    known, number = np.unique(leaf, return_inverse=True)
    earlier = np.zeros((len(x), len(known) + 1), bool)  # the leaves before this one that each vector is in
    earlier[of, number] = True
    weight, left, right = np.zeros(len(x), np.int64), [], []
    for k in range(0, len(x), 256):
        i, j = np.nonzero(rough[k:k + 256] @ rough[k:].T >= threshold - 1e-4)
        i, j = i + k, j + k
        keep = (i < j) & ((chunk[i] != chunk[j]) | (not cross))
        i, j = i[keep], j[keep]
        exact = np.concatenate([np.einsum("ij,ij->i", x[i[s:s + 8192]], x[j[s:s + 8192]]) for s in range(0, len(i), 8192)] or [np.empty(0)])
        i, j = i[exact >= threshold], j[exact >= threshold]
        for s in range(0, len(i), 1 << 14):
            a, b = i[s:s + (1 << 14)], j[s:s + (1 << 14)]
            here = ~(earlier[a] & earlier[b]).any(axis=1)
            a, b = a[here], b[here]
            np.add.at(weight, a, copies[b])
            np.add.at(weight, b, copies[a])
            left.append(a)
            right.append(b)
    left, right = np.concatenate([*left, np.empty(0, np.int64)]), np.concatenate([*right, np.empty(0, np.int64)])
    root = local_roots(len(x), left, right)
    tied, linked = np.flatnonzero(root != np.arange(len(x))), np.flatnonzero(weight)
    nothing = lambda n: pa.nulls(n, pa.int64())
    return pa.table({"a": pa.concat_arrays([pa.array(rep[linked]), pa.array(rep[tied])]),
                     "weight": pa.concat_arrays([pa.array(weight[linked]), nothing(len(tied))]),
                     "b": pa.concat_arrays([nothing(len(linked)), pa.array(rep[root[tied]])])})


def near_vectors(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
                 trees: int = 8, leaf: int = LEAF, large: int = LARGE, sample: int = SAMPLE, spill: float = 0.5, seed: int = 11) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    v = F.col("v")
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x).cast("double") != float("inf")))
    rows = rows.withColumn("good", F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False)))
    good = rows.where("good").select("vec_id", v)
    reps = good.groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies")).withColumn("rep", F.monotonically_increasing_id())
    reps = stage(spark, reps, "vectors")

    trees_of: dict[int, list[Tree]] = {}
    first = 0
    for r in sorted(reps.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()):  # one row per vector length
        some = reps.where(F.size("v") == r.d).orderBy(F.xxhash64("v"), "rep").limit(sample).select("v").toArrow()
        x = unit(_matrix(some.column("v")))
        trees_of[r.d] = forest(x, r.n, threshold, trees, leaf, spill, seed)
        for tree in trees_of[r.d]:
            tree.first, first = first, first + tree.leaves

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("v").value_lengths().to_numpy()
            for d in np.unique(size):
                part = batch.filter(pa.array(size == d))
                x = unit(_matrix(part.column("v")))
                found = [(row, leaf + tree.first) for tree in trees_of[int(d)] for row, leaf in [tree.leaves_of(x)]]
                row, leaf = (np.concatenate(f) for f in zip(*found))
                order = np.lexsort((leaf, row))
                row, leaf = row[order], leaf[order]
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(x) + 1)).astype(np.int32)), pa.array(leaf.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("rep"), part.column("copies"), part.column("v"), lists], ["rep", "copies", "v", "leaves"])

    dealt = stage(spark, reps.select("rep", "copies", "v").mapInArrow(deal, f"rep long, copies long, v {kind}, leaves array<int>"), "dealt")
    sizes = dealt.select(F.explode("leaves").alias("_leaf")).groupBy("_leaf").agg(F.count("*").alias("n"))
    # leaves beyond ``large`` are few and huge; they are looked up, not joined on by all rows
    huge = {r["_leaf"]: -(-r.n // (large // 2)) for r in sizes.where(F.col("n") > large).collect()}
    placed = dealt.withColumn("leaf", F.explode("leaves"))
    if huge:
        chunks = F.coalesce(F.create_map(*[F.lit(x) for pair in huge.items() for x in pair])[F.col("leaf")], F.lit(1))
    else:
        chunks = F.lit(1)
    placed = placed.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks").cast("long")).cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    placed = placed.withColumn("part", F.least("chunk", "with")).withColumn("other", F.greatest("chunk", "with"))

    def compare(table: pa.Table) -> pa.Table:
        return _compare(table, threshold)

    cells = placed.select("leaf", "part", "other", "chunk", "rep", "copies", "v", "leaves").groupBy("leaf", "part", "other")
    found = stage(spark, cells.applyInArrow(compare, "a long, weight long, b long"), "found")
    weights = found.where("weight is not null").groupBy(F.col("a").alias("_a")).agg(F.sum("weight").alias("more"))
    roots = components(spark, found.where("b is not null").select("a", "b")).withColumnRenamed("root", "_root")
    classes = reps.select("v", "rep", "least", "copies").join(weights, F.col("rep") == F.col("_a"), "left").join(roots, F.col("rep") == F.col("node"), "left")
    classes = stage(spark, classes.select("v", "least", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("_root", "rep").alias("root")), "classes")
    least = stage(spark, classes.groupBy(F.col("root").alias("_r")).agg(F.min("least").alias("component_id")), "least")
    classes = stage(spark, classes.join(least, F.col("root") == F.col("_r")).select(F.col("v").alias("_v"), "n_links", "component_id"), "components")
    done = good.join(classes, F.col("v") == F.col("_v")).select("vec_id", "n_links", "component_id")
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
