import inspect

import numpy as np
import pytest

from voltstream.llm.projection_forest import forest, near_vectors, op4_embedding_neighbours, unit

SF = "/root/testdata/sf0.01"


def brute(ids, x, threshold=0.95):
    """vec_id → (n_links, component_id) over finite nonzero vectors."""
    x = unit(np.array(x))
    link = x @ x.T >= threshold
    np.fill_diagonal(link, False)
    component = list(range(len(ids)))
    for i in range(len(ids)):
        stack, seen = [i], {i}
        while stack:
            for j in np.flatnonzero(link[stack.pop()]):
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        component[i] = min(ids[j] for j in seen)
    return {i: (int(n), c) for i, n, c in zip(ids, link.sum(axis=1), component)}


def as_dict(found):
    return {r.vec_id: (r.n_links, r.component_id) for r in found.collect()}


def test_query_finds_every_link(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    want = brute([r.vec_id for r in rows], [r.embedding for r in rows])
    found = op4_embedding_neighbours(spark, SF).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


@pytest.mark.parametrize("large", [4096, 40])
def test_recall_with_small_leaves(spark, large):
    """Pairs right above the threshold, many splits, leaves cut into chunks: nearly all links, none too many."""
    rng = np.random.default_rng(3)
    base = unit(rng.standard_normal((300, 32)))
    near = unit(base + 0.27 * unit(rng.standard_normal((300, 32))))  # cosine about 0.965
    dense = unit(rng.standard_normal((1, 32)) + 0.05 * rng.standard_normal((100, 32)))
    x = np.concatenate([base, near, dense])
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got, want = as_dict(near_vectors(spark, docs, leaf=24, large=large)), brute(list(range(len(x))), x)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][0] for i in want) >= 0.99 * sum(n for n, _ in want.values())


def test_recall_in_a_dense_topic():
    """A third of the vectors in one topic (mutual cosine about 0.9), pairs right above the threshold: few are parted by all trees."""
    rng = np.random.default_rng(5)
    topic = unit(unit(rng.standard_normal((1, 64))) + 0.042 * rng.standard_normal((10_000, 64)))
    x = np.concatenate([topic, unit(rng.standard_normal((20_000, 64)))])
    away = rng.standard_normal(x.shape)
    away = unit(away - (away * x).sum(axis=1, keepdims=True) * x)
    y = 0.951 * x + np.sqrt(1 - 0.951 ** 2) * away
    trees = inspect.signature(near_vectors).parameters["trees"].default
    apart = np.arange(len(x))
    for tree in forest(rng.permutation(np.concatenate([x, y]))[:8192], 2 * len(x), 0.95, trees, 64, 0.5, 11):
        apart = apart[tree.parted(x[apart], y[apart])] if len(apart) else apart
    assert len(apart) <= 0.001 * len(x)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0]), (3, [2.0, 0.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (None, [1.0, 0.01]), (1, None), (2, []), (4, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [1.0, None]), (10, [1.0, 0.0, 0.0]), (11, [0.0, 1e300]), (12, [0.0, 1e-300]), (13, [-1.0, 0.0])]
    docs = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rep string")
    found = near_vectors(spark, docs).collect()
    got = sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in found)
    assert got == [(False, 1, 0, 1, True), (False, 2, 0, 2, True), (False, 3, 4, 3, True), (False, 4, 0, 4, True), (False, 5, 4, 3, False),
                   (False, 6, 0, 6, True), (False, 7, 0, 7, True), (False, 8, 0, 8, True), (False, 9, 4, 3, False), (False, 9, 4, 3, False),
                   (False, 10, 0, 10, True), (False, 11, 1, 11, True), (False, 12, 1, 11, False), (False, 13, 0, 13, True), (True, 0, 4, 3, False)]
    assert near_vectors(spark, docs.where("vec_id > 99")).collect() == []
