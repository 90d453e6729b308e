"""Shared helpers: whole-text word batches, staged tables, connected components."""

from __future__ import annotations

import contextlib
import functools
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.session import run_dir

#: Text bytes handled at once inside a task; longer single texts form a slice of their own.
SLICE_BYTES = 4 << 20


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While jobs run in the block, rows go to Python in smaller Arrow batches (less memory beside the heap)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back (cuts lineage, survives lost executors)."""
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_memo(name: str) -> dict:
    """A dict that lives as long as the Python worker process, shared by its tasks."""
    home = sys.modules.setdefault("_voltstream_worker_memo", types.ModuleType("_voltstream_worker_memo"))
    return home.__dict__.setdefault(name, {})


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until ``df`` has no such column (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(id_col: str, text_col: str) -> Column:
    """``<id>:<hash of the text>``, 'n' for a NULL id: tells rows apart by content where ids repeat or are missing."""
    return F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("n")), F.lit(":"), F.hex(F.xxhash64(F.col(text_col).cast("string"))))


def filled(batch: pa.RecordBatch, text: str | int) -> pa.Array:
    """The text column with NULL as empty."""
    return pc.fill_null(batch.column(text), "")


def text_slices(batches: Iterator[pa.RecordBatch], text: str | int, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``max_bytes`` of text; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.binary_length(filled(batch, text)).to_numpy(zero_copy_only=False).astype(np.int64))
        part = np.maximum(size - 1, 0) // max_bytes
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


class Words:
    """The words of some texts: ``code[k]`` indexes ``unique``; text i owns ``start[i]:start[i + 1]``."""

    def __init__(self, texts: pa.Array, lower_ascii: bool = False):
        """Words are maximal runs without ASCII white space (space, tab, newline, VT, FF, CR)."""
        texts = pc.cast(texts, pa.large_string())
        if lower_ascii:
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        self.dictionary: pa.Array = coded.dictionary
        self.code = coded.indices.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        empty = pc.index(self.dictionary, pa.scalar("", self.dictionary.type)).as_py()
        if empty >= 0:  # leading or trailing white space
            keep = self.code != empty
            self.code, owner = self.code[keep], owner[keep]
        self.start = np.zeros(len(lengths) + 1, dtype=np.int64)
        np.cumsum(np.bincount(owner, minlength=len(lengths)), out=self.start[1:])

    @functools.cached_property
    def unique(self) -> list[str]:
        return self.dictionary.to_pylist()


def strings(values: pa.Array) -> list[str]:
    """Strings without NULLs as a list (much faster than to_pylist, which makes a scalar of each first)."""
    return values.to_numpy(zero_copy_only=False).tolist()


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indexes start[k] .. start[k] + length[k] - 1 of all k, one after the other."""
    total = int(length.sum())
    return np.arange(total, dtype=np.int64) + np.repeat(start - (np.cumsum(length) - length), length)


def segment_sums(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over start[i]:start[i + 1] along the first axis (0 for empty ones)."""
    out = np.zeros((len(start) - 1, *values.shape[1:]), dtype=values.dtype)
    full = np.flatnonzero(np.diff(start))
    if len(full):
        out[full] = np.add.reduceat(values, start[full], axis=0)
    return out


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component, for nodes 0 .. n - 1 and links a[k] - b[k]."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        apart = low != high
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
    return root


def components(spark: SparkSession, links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: root is the smallest node of its component.

    Min-label propagation with pointer jumping. Labels are one row per node, so
    each join has a unique side (a hub's rows on the other side can be split),
    and the minimum over neighbours is a partial aggregate. Each round is
    written to the shared folder; the rounds grow with the logarithm of a
    component's diameter. Self-links are allowed, NULL ends are dropped.
    """
    links = links.select("a", "b").where("a is not null and b is not null")
    both = stage(spark, links.union(links.select("b", "a")).distinct(), "links")
    labels = stage(spark, both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("root")), "labels")
    for _ in range(max_rounds):
        # a copied key keeps the join's exchanges its own, so that a hub's partition can be split
        seen = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("n")).agg(F.min("root").alias("near"))
        lower = labels.join(seen, labels.node == seen.n).select("node", F.least("root", "near").alias("root"), F.col("root").alias("old"))
        up = lower.select(F.col("node").alias("u"), F.col("root").alias("up"))
        jumped = stage(spark, lower.join(up, lower.root == up.u).select("node", "up", "old"), "labels")
        moved = jumped.where("up <> old").limit(1).count()
        labels = jumped.select("node", F.col("up").alias("root"))
        if not moved:
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def u64(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as signed integers (Spark has no unsigned type)."""
    return np.ascontiguousarray(values).view(np.int64)
