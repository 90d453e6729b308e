"""Quality by hierarchical empirical Bayes: document evidence with host and path posteriors.

* Evidence: a logistic model on a text's byte classes (shares of letters, digits, signs ..., repeats of signs, length)
  gives each document a probability of being good, fitted by Newton's method on a bounded sample of labelled rows
  (``train_docs`` of smallest xxhash64(doc_id)); byte classes are taken over whole texts.
* Hosts: a host's documents (their evidence as fractional successes) update a Beta prior with the global rate as mean
  and a strength estimated by the method of moments over hosts: the less hosts differ beyond chance, the stronger.
* Paths: the same within hosts, with the host's posterior as prior mean and a strength estimated over paths.
* Score: the document's log-odds plus the log-odds of its path's posterior over the global rate, the posterior
  taken without the document itself. A path without other documents falls back on its host, that on the world.

Scale: one map over the documents; sums of evidence by path, then by host from those (partial aggregates, so a hot
host is summed up in its tasks); two moment sums; joins of documents with one row per path.

Cases: very long texts are read whole; NULL hosts and paths are groups of their own; NULL and empty texts have the evidence of an empty text; without
labels of both classes evidence is the labelled share (0.5 without labels); NULL labels and ids are not learned from;
repeated rows count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.llm.common import filled, segment_sums, stage, text_slices
from voltstream.llm.suffix_dedup import _bytes_of

_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\t\n\r\x0b\x0c", ".,;:!?'\"-()", "|", "#$%&*+<=>@[]\\^_`{}~/"]


def byte_classes() -> np.ndarray:
    """The class of each byte; those outside ASCII are the last but one, controls the last."""
    out = np.full(256, len(_CLASSES) + 1, np.int64)
    out[128:] = len(_CLASSES)
    for i, chars in enumerate(_CLASSES):
        out[[ord(c) for c in chars]] = i
    return out


def features(texts: pa.Array) -> np.ndarray:
    """Of each text: 1, log length, share of each byte class, share of bytes that repeat the one before, words by length."""
    data, at = _bytes_of(texts)
    kind = byte_classes()[data]
    size = np.diff(at)
    n = np.maximum(size, 1)[:, None]
    same = np.zeros(len(data), np.float64)
    same[1:] = data[1:] == data[:-1]
    same[at[:-1][size > 0]] = 0
    shares = [segment_sums((kind == k).astype(np.float64), at)[:, None] / n for k in range(len(_CLASSES) + 2)]
    space = shares[3] + shares[4]
    return np.concatenate([np.ones((len(size), 1)), np.log1p(size)[:, None], *shares, segment_sums(same, at)[:, None] / n, 1 / (space + 0.05)], axis=1)


class Evidence:
    """A logistic model on ``features``."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        share = float(y.mean()) if len(y) else 0.5
        self.mean, self.scale = np.zeros(x.shape[1]), np.ones(x.shape[1])
        self.weight = np.zeros(x.shape[1])
        self.weight[0] = np.log(share / (1 - share)) if 0 < share < 1 else 0.0
        self.constant = None if len(y) and 0 < share < 1 else share
        if self.constant is None:
            self.mean[1:], self.scale[1:] = x[:, 1:].mean(axis=0), x[:, 1:].std(axis=0) + 1e-6
            z = (x - self.mean) / self.scale
            penalty = np.r_[1e-6, np.full(x.shape[1] - 1, ridge)]
            for _ in range(30):
                p = 1 / (1 + np.exp(-np.clip(z @ self.weight, -30, 30)))
                step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * self.weight)
                self.weight -= step * min(1, 3 / max(np.abs(step).max(), 1e-9))

    def of(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        z = (features(texts) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(z @ self.weight, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        train_docs: int = 4000, train_chars: int = 100_000) -> Evidence:
    marked = labels.select(F.col(id_col).cast("long").alias("i"), F.col(label_col).cast("double").alias("y")).dropna().groupBy("i").agg(F.max("y").alias("y"))
    picked = F.broadcast(marked.orderBy(F.xxhash64("i"), "i").limit(train_docs))  # at most train_docs rows
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where(F.length("t") <= train_chars)
    rows = sorted(rows.join(picked, "i").select("i", "t", "y").collect())
    return Evidence(features(pa.array([r.t for r in rows], pa.string())), np.array([float(r.y > 0) for r in rows]))


def evidence(docs: DataFrame, model: Evidence, id_col: str, text_col: str, host_col: str, path_cols: tuple) -> DataFrame:
    """(doc_id, host, path, p); NULL is a value of its own in host and path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("host"), part.column("path"), pa.array(model.of(filled(part, "text")))], ["doc_id", "host", "path", "p"])

    group = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), group(host_col).alias("host"),
                       F.to_json(F.array(*[group(c) for c in path_cols])).alias("path"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, host string, path string, p double")


def strength(n_groups: float, rows: float, squares: float, within: float, between: float) -> float:
    """Prior strength (in documents) by the method of moments.

    ``rows``, ``squares``: sums of group sizes and of their squares; ``within``: mean of m (1 - m) over rows for the prior
    mean m; ``between``: sum over groups of size * (rate - m) ** 2. Beta-binomial groups have
    E[between] = n_groups * within * (1 - r) + rows * within * r with r = 1 / (strength + 1).
    """
    if n_groups < 2 or within <= 0 or rows <= n_groups:
        return 1e6
    r = (between / within - n_groups) / (rows - n_groups)
    return float(np.clip(1 / np.clip(r, 1e-6, 0.99) - 1, 0.01, 1e6))


def site_scores(spark: SparkSession, docs: DataFrame, model: Evidence, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                path_cols: tuple = ("source", "lang"), threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, evidence, host_rate, path_rate (posteriors without the document), score, keep."""
    rows = stage(spark, evidence(docs, model, id_col, text_col, host_col, path_cols), "evidence")
    paths = stage(spark, rows.groupBy("host", "path").agg(F.sum("p").alias("s"), F.count("*").alias("n")), "paths")
    hosts = stage(spark, paths.groupBy(F.col("host").alias("h")).agg(F.sum("s").alias("hs"), F.sum("n").alias("hn")), "hosts")
    world = hosts.agg(F.sum("hs").alias("s"), F.sum("hn").alias("n")).first()
    rate = min(max((world.s or 0.0) / max(world.n or 0, 1), 1e-6), 1 - 1e-6)

    def moments(groups: DataFrame, n: str, s: str, mean) -> float:
        m = groups.agg(F.count("*").alias("g"), F.sum(n).alias("r"), F.sum(F.col(n) * F.col(n)).alias("q"), F.sum(mean * (1 - mean) * F.col(n)).alias("w"),
                       F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - mean, 2)).alias("b")).first()
        return strength(m.g, m.r or 0, m.q or 0, (m.w or 0) / max(m.r or 0, 1), m.b or 0)

    host_strength = moments(hosts, "hn", "hs", F.lit(rate))
    hosts = hosts.withColumn("host_mean", (F.col("hs") + host_strength * rate) / (F.col("hn") + host_strength))
    both = stage(spark, paths.join(hosts, F.col("host") == F.col("h")).select(F.col("host").alias("_h"), F.col("path").alias("_p"), "s", "n", "hs", "hn", "host_mean"), "sites")
    path_strength = moments(both, "n", "s", F.col("host_mean"))

    found = rows.join(both, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")))
    p = F.col("p")
    host_rate = (F.col("hs") - p + host_strength * rate) / (F.col("hn") - 1 + host_strength)
    found = found.withColumn("host_rate", host_rate).withColumn("path_rate", (F.col("s") - p + path_strength * F.col("host_rate")) / (F.col("n") - 1 + path_strength))
    odds = lambda c: F.log(F.greatest(c, F.lit(1e-9)) / F.greatest(1 - c, F.lit(1e-9)))
    logit = odds(p) + odds(F.col("path_rate")) - odds(F.lit(rate))
    found = found.withColumn("score", 1 / (1 + F.exp(-logit)))
    return found.select("doc_id", p.alias("evidence"), "host_rate", "path_rate", "score", (F.col("score") >= threshold).alias("keep"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return site_scores(spark, docs, fit(docs, labels))
