import numpy as np
import pytest
import xxhash

from voltstream.llm.simhash import VantageTree, close_pairs, fingerprint_links, keep_one, op9_simhash, simhash_classes

SF = "/root/testdata/sf0.001"


def brute_fp(text):
    table = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    words, word = [], ""
    for c in (text or "").translate(table) + " ":
        if c in " \t\n\r\x0b\x0c":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, distance=2):
    root = {}
    for i in ids:
        seen, stack = {i}, [i]
        while stack:
            a = stack.pop()
            for b in ids:
                if b not in seen and (fps[a] ^ fps[b]).bit_count() <= distance:
                    seen.add(b)
                    stack.append(b)
        root[i] = min(seen)
    return root


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: brute_fp(r.text) for r in rows}
    roots = brute_components(list(fps), fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op9_simhash(spark, SF).collect()}
    assert got == {i: (f"{fps[i]:016x}", roots[i]) for i in fps}
    assert len(set(roots.values())) < len(roots)


def clustered(n, seed):
    """Fingerprints in dense clusters: copies of a few centres with some bits flipped."""
    rng = np.random.default_rng(seed)
    out = rng.integers(0, 1 << 63, n // 20, dtype=np.uint64)[rng.integers(0, n // 20, n)]
    for _ in range(6):
        flip = rng.random(n) < 0.4
        out[flip] ^= np.uint64(1) << rng.integers(0, 64, flip.sum()).astype(np.uint64)
    return np.unique(out)


def test_shards_and_local_trees_lose_no_pair():
    fps = clustered(3000, 1)
    i, j = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2, 1))
    want = set(zip(i.tolist(), j.tolist()))
    assert set(zip(*(x.tolist() for x in close_pairs(fps, 2, leaf=32)))) == want
    tree = VantageTree(np.random.default_rng(2).permutation(fps)[:500], len(fps), 64)
    assert tree.shards > 10
    row, shard = tree.shards_of(fps, 2)
    of = [set() for _ in fps]
    for r, s in zip(row.tolist(), shard.tolist()):
        of[r].add(s)
    assert all(of[a] & of[b] for a, b in want)


def test_links_have_the_components_of_all_pairs(spark):
    fps = clustered(800, 3)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = fingerprint_links(spark, df, shard=32).collect()
    root = {int(x): int(x) for x in fps.view(np.int64)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        assert (r.a ^ r.b).bit_count() and find(r.a) is not None
        root[max(find(r.a), find(r.b))] = min(find(r.a), find(r.b))
    by = dict(enumerate(int(x) for x in fps.view(np.int64)))
    bits = dict(enumerate(int(x) for x in fps))
    want = brute_components(list(by), bits)
    groups = lambda f: {frozenset(i for i in by if f(i) == k) for k in {f(i) for i in by}}
    assert groups(lambda i: find(by[i])) == groups(lambda i: want[i])


def test_very_long_texts_and_clashing_names(spark):
    long = " ".join(f"w{i % 977} x{i % 1009}" for i in range(200_000))
    docs = spark.createDataFrame([(1, long, "a"), (2, long + " end", "b"), (3, "w1 x1 w2", "c"), (0, long, "d")], "doc_id long, text string, _key string")
    assert {r.doc_id: r.component_id for r in simhash_classes(spark, docs).collect()} == {0: 0, 1: 0, 2: 0, 3: 3}
    assert sorted(r._key for r in keep_one(spark, docs).collect()) == ["c", "d"]


def test_nulls_ties_and_empty(spark):
    rows = [(4, None, "a"), (2, "", "b"), (None, " \t", "c"), (7, "one two three four", "d"), (6, "ONE  two\nthree four", "e"), (7, "one two three four", "d"),
            (None, "only null ids here", "f"), (None, "only null ids here", "g"), (9, "two words", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.component_id) for r in simhash_classes(spark, docs).collect()), key=repr)
    assert got == sorted([(False, 4, 2), (False, 2, 2), (True, 0, 2), (False, 7, 6), (False, 7, 6), (False, 6, 6), (True, 0, None), (True, 0, None), (False, 9, 9)], key=repr)
    kept = keep_one(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(2, ""), (6, "ONE  two\nthree four"), (None, "only null ids here"), (9, "two words")], key=repr)
    again = spark.createDataFrame([(1, "x y z", "p"), (1, "x y z", "q"), (1, "x y z", "p")], "doc_id long, text string, fp string")
    assert keep_one(spark, again).count() == 1
    assert simhash_classes(spark, docs.where("doc_id > 99")).collect() == [] and keep_one(spark, docs.where("doc_id > 99")).collect() == []
