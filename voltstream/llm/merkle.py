"""Merkle manifest of a dataset: a SHA-256 tree per group (``lang``) and one over the groups' roots.

A leaf is the hash of a row's fields, each as ``-`` (NULL) or byte count, colon, value. A group's leaves ascend by id;
while several nodes remain, every ``ARITY`` consecutive ones (the last run may be shorter) become the hash of their
hex digests. Group roots, in order of the group (NULL first, bytewise), become the root in the same way.

A parent hashes its children one after the other and keeps a copy of the hash state before each child slot (the
midstate). Folding a replaced child resumes that copy with the replacement and the siblings to its right; what lies to
its left is never hashed again. Leaves do the same with fields: a changed field resumes the state before it.

On Spark:

1. Leaves are hashed in scan tasks, staged (digests, no texts), range-partitioned by (group, id) and numbered with
   prefix counts, one row per partition and group.
2. ``SPAN`` consecutive nodes of a group make one subtree, built whole in a task; its root is a node of the next
   table, ``SPAN`` times smaller, until a group has one node.
3. Going down, each subtree gets the siblings above its root (a few dozen digests); midstates of that path are
   resumed for every leaf below. A task holds ``SPAN`` nodes and one path, whatever the number of rows.

Cases: NULLs in any field hash as ``-``; NULL ids come first and repeated ids are ordered by their leaf, so equal rows
are neighbours; very long texts are hashed whole; an empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltstream.llm.common import filled, stage, text_slices

ARITY = 2
#: Nodes of a subtree that a task builds (a power of ARITY).
SPAN = 256
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: bytes | None) -> bytes:
    return b"-" if value is None else b"%d:%b" % (len(value), value)


def _text(value) -> bytes | None:
    return None if value is None else str(value).encode("utf-8", "surrogatepass")


class Subtree:
    """A tree over nodes (hex digests); ``height``: levels to build, by default until one node remains."""

    def __init__(self, nodes: list[str], arity: int = ARITY, height: int | None = None):
        self.arity, self.levels, self.states = arity, [nodes], []
        while len(self.levels[-1]) > 1 if height is None else len(self.states) < height:
            states, parents, below = [], [], self.levels[-1]
            for at in range(0, len(below), arity):
                h = hashlib.sha256()
                for child in below[at:at + arity]:
                    states.append(h.copy())
                    h.update(child.encode())
                parents.append(h.hexdigest())
            self.states.append(states)
            self.levels.append(parents)

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, pos: int) -> list[tuple[str, str]]:
        """By level, the digests left and right of the node's ancestor in its run."""
        found = []
        for nodes in self.levels[:-1]:
            begin = pos - pos % self.arity
            found.append(("".join(nodes[begin:pos]), "".join(nodes[pos + 1:begin + self.arity])))
            pos //= self.arity
        return found

    def fold(self, pos: int, node: str) -> str:
        """The root if ``node`` stood at ``pos``: states before its slots resumed with it and what is to its right."""
        for nodes, states in zip(self.levels, self.states):
            h = states[pos].copy()
            h.update(node.encode())
            for right in nodes[pos + 1:pos - pos % self.arity + self.arity]:
                h.update(right.encode())
            node, pos = h.hexdigest(), pos // self.arity
        return node


class Path:
    """The way up from a subtree's root: per level the state before its slot, and the right siblings."""

    def __init__(self, left: list[str], right: list[str]):
        self.proof = "".join(x + y for x, y in zip(left, right))
        self.steps = [(hashlib.sha256(x.encode()), y.encode()) for x, y in zip(left, right)]

    def fold(self, node: str) -> str:
        for state, right in self.steps:
            h = state.copy()
            h.update(node.encode())
            h.update(right)
            node = h.hexdigest()
        return node


def leaves(docs: DataFrame, tampered: Column | None = None, fields: tuple = FIELDS, changed: str = "n_chars") -> DataFrame:
    """grp (sortable key of lang), doc_id, leaf, replaced: the leaf with 1 added to ``changed`` where ``tampered``, else NULL."""
    text = fields[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text):
            short = [part.column(f).to_pylist() for f in fields[:-1]]
            body = filled(part, text).cast(pa.large_binary())
            at = np.frombuffer(body.buffers()[1], np.int64)[body.offset:body.offset + len(body) + 1].tolist()
            data, given = memoryview(body.buffers()[2] or b""), part.column(text).is_valid().to_pylist()
            marks, leaf, replaced = part.column("tampered").to_pylist(), [], []
            for row, a, b, has, mark in zip(zip(*short), at[:-1], at[1:], given, marks):
                h, before = hashlib.sha256(), None
                for name, value in zip(fields, row):
                    if mark and name == changed and value is not None:
                        before = h.copy(), value
                    h.update(encoded(_text(value)))
                    if before and name != changed:
                        before[0].update(encoded(_text(value)))
                    elif before:
                        before[0].update(encoded(_text(value + 1)))
                for state in (h, before[0]) if before else (h,):
                    state.update(b"%d:" % (b - a) if has else b"-")
                    state.update(data[a:b])
                leaf.append(h.digest())
                replaced.append(before[0].digest() if before else None)
            yield pa.RecordBatch.from_arrays([part.column("grp"), part.column("id"), pa.array(leaf, pa.binary()), pa.array(replaced, pa.binary())], ["grp", "doc_id", "leaf", "replaced"])

    # '' sorts before '+...', bytewise as the group itself
    group = F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit(""))
    mark = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    kinds = {"doc_id": "long", "n_chars": "long"}
    rows = docs.select(*[F.col(f).cast(kinds.get(f, "string")).alias(f) for f in fields], group.alias("grp"), F.col("doc_id").cast("long").alias("id"), mark.alias("tampered"))
    return rows.mapInArrow(run, "grp string, doc_id long, leaf binary, replaced binary")


def numbered(spark: SparkSession, rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``pos``, the rank within ``grp`` by ``order``, and ``size``, the group's rows."""
    dealt = rows.repartitionByRange(F.col("grp"), *order).sortWithinPartitions(F.col("grp"), *order)
    dealt = stage(spark, dealt.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()), "numbered")
    parts = dealt.groupBy("grp", "part").agg(F.count("*").alias("n"), F.min("nth").alias("first"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = parts.select(F.col("grp").alias("_grp"), F.col("part").alias("_part"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("n").over(Window.partitionBy("grp")).alias("size"))
    joined = dealt.join(parts, (F.col("grp") == F.col("_grp")) & (F.col("part") == F.col("_part")))
    return joined.select(*rows.columns, (F.col("nth") + F.col("shift")).alias("pos"), "size")


def _height(size: int, span: int, arity: int) -> int | None:
    """Levels of a subtree: all that its group needs, or those of a full span."""
    if size <= span:
        return None
    height, full = 0, 1
    while full < span:
        height, full = height + 1, full * arity
    return height


def _by_pos(table: pa.Table, span: int, arity: int, node: str) -> tuple[pa.Table, Subtree]:
    table = table.sort_by("pos")
    nodes = table.column(node).to_pylist()
    nodes = [n.hex() for n in nodes] if nodes and isinstance(nodes[0], bytes) else nodes
    return table, Subtree(nodes, arity, _height(table.column("size")[0].as_py(), span, arity))


def _roots(nodes: DataFrame, node: str, span: int, arity: int) -> DataFrame:
    """The roots of all subtrees: grp, pos (the subtree's number), size (subtrees of the group), node."""

    def run(table: pa.Table) -> pa.Table:
        table, tree = _by_pos(table, span, arity, node)
        size = -(-table.column("size")[0].as_py() // span)
        return pa.table({"grp": table.column("grp")[:1], "pos": pa.array([table.column("span")[0].as_py()], pa.int64()), "size": pa.array([size], pa.int64()), "node": [tree.root]})

    return _spans(nodes, span).select("grp", "span", "pos", "size", node).groupBy("grp", "span").applyInArrow(run, "grp string, pos long, size long, node string")


def _spans(nodes: DataFrame, span: int) -> DataFrame:
    return nodes.withColumn("span", F.floor(F.col("pos") / span).cast("long"))


_PATH = "grp string, pos long, l array<string>, r array<string>, root string"


def paths(spark: SparkSession, nodes: DataFrame, span: int = SPAN, arity: int = ARITY) -> DataFrame:
    """For nodes(grp, pos, size, node): the digests left (l) and right (r) on the way up, by level, and the group's root."""
    nodes = stage(spark, nodes.select("grp", "pos", "size", "node"), "nodes")
    most = nodes.agg(F.max("size")).first()[0] or 0
    if most <= 1:
        none = F.array().cast("array<string>")
        return nodes.select("grp", "pos", none.alias("l"), none.alias("r"), F.col("node").alias("root"))
    above = paths(spark, _roots(nodes, "node", span, arity), span, arity)

    def run(table: pa.Table, top: pa.Table) -> pa.Table:
        table, tree = _by_pos(table, span, arity, "node")
        up = top.to_pylist()[0]
        own = [tree.siblings(i) for i in range(table.num_rows)]
        n = table.num_rows
        return pa.table({"grp": table.column("grp"), "pos": table.column("pos"), "l": pa.array([[x for x, _ in s] + up["l"] for s in own], pa.list_(pa.string())),
                         "r": pa.array([[y for _, y in s] + up["r"] for s in own], pa.list_(pa.string())), "root": pa.array([up["root"]] * n, pa.string())})

    both = _spans(nodes, span).groupBy("grp", "span").cogroup(above.withColumnRenamed("pos", "span").groupBy("grp", "span"))
    return both.applyInArrow(run, _PATH)


def manifest(spark: SparkSession, docs: DataFrame, tampered: Column | None = None, span: int = SPAN, arity: int = ARITY) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root; the leaf folded is the one with 1 more character where ``tampered``."""
    rows = stage(spark, leaves(docs, tampered), "leaves")
    rows = stage(spark, numbered(spark, rows, [F.col("doc_id").asc_nulls_first(), F.col("leaf")]), "positions")
    inner = stage(spark, paths(spark, _roots(rows, "leaf", span, arity), span, arity), "subtrees")
    groups = numbered(spark, inner.where("pos = 0").select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("node")), [F.col("name")])
    groups = stage(spark, groups, "groups")
    outer = groups.select("name", F.col("pos").alias("_pos")).join(paths(spark, groups, span, arity).select("pos", "l", "r", F.col("root").alias("top")), F.col("_pos") == F.col("pos"))
    above = inner.join(outer.select("name", F.col("l").alias("_l"), F.col("r").alias("_r"), "top"), F.col("grp") == F.col("name"))
    above = above.select("grp", F.col("pos").alias("span"), F.concat("l", "_l").alias("l"), F.concat("r", "_r").alias("r"), F.col("root").alias("subroot"), F.col("top").alias("root"))

    def run(table: pa.Table, top: pa.Table) -> pa.Table:
        table, tree = _by_pos(table, span, arity, "leaf")
        info = top.to_pylist()[0]
        path, proofs, folded = Path(info["l"], info["r"]), [], []
        for i, replaced in enumerate(table.column("replaced").to_pylist()):
            proof = hashlib.sha256("".join(x + y for x, y in tree.siblings(i)).encode())
            proof.update(path.proof.encode())
            proofs.append(proof.hexdigest())
            folded.append(path.fold(tree.fold(i, tree.levels[0][i] if replaced is None else replaced.hex())))
        n = table.num_rows
        return pa.table({"doc_id": table.column("doc_id"), "leaf": tree.levels[0], "subroot": [info["subroot"]] * n, "root": [info["root"]] * n, "proof_sha256": proofs, "folded_root": folded})

    both = _spans(rows, span).groupBy("grp", "span").cogroup(above.groupBy("grp", "span"))
    return both.applyInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def tampered_sevenths() -> Column:
    """Rows whose decimal id has an unsigned CRC-32 that 7 divides."""
    return F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 0


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), tampered_sevenths())
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
