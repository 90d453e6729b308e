import hashlib
import zlib

import pytest

from voltstream.llm.merkle import Subtree, manifest, op13_merkle_manifest, tampered_sevenths

SF = "/root/testdata/sf0.001"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def brute(rows, arity=2):
    """rows (doc_id, source, lang, n_chars, text) → (doc_id, leaf, subroot, root, proof, folded)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(H(*map(field, r)))))
        trees[g] = levels([H(*map(field, r)) for r in groups[g]], arity)
    top, out = levels([trees[g][-1][0] for g in order], arity), []
    for g in order:
        for pos, r in enumerate(groups[g]):
            changed = r[3] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node, proof = H(*map(field, (*r[:3], r[3] + 1, r[4]) if changed else r)), ""
            for tree, at in ((trees[g], pos), (top, order.index(g))):
                for level in tree[:-1]:
                    begin = at - at % arity
                    run = level[begin:begin + arity]
                    proof += "".join(run[:at - begin] + run[at - begin + 1:])
                    run[at - begin] = node
                    node, at = H(*run), at // arity
            out.append((r[0], trees[g][0][pos], trees[g][-1][0], top[-1][0], H(proof), node))
    return sorted(out, key=str)


def ran(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root").collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = op13_merkle_manifest(spark, SF)
    assert ran(found) == brute(rows)
    told = {r.doc_id: r.verified for r in found.collect()}
    assert told == {r[0]: r[3] is None or zlib.crc32(str(r[0]).encode()) % 7 != 0 for r in rows} and not all(told.values())


@pytest.mark.parametrize("span,arity", [(4, 2), (256, 2), (9, 3)])
def test_spans_arities_nulls_and_repeated_rows(spark, span, arity):
    rows = [(i, "s" if i % 3 else None, ["de", "en", None, "", "zu"][min(i % 11, 4) if i % 2 else 1], None if i % 5 == 0 else i, None if i % 8 == 0 else "ü" * (i % 60)) for i in range(150)]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (3, "a", "de", 4, "again"), (3, "a", "de", 4, "again"), (3, "a", "de", 5, "other"), (700, "s", "one", 9, "x" * 300_000)]
    docs = spark.createDataFrame([(t, i, s, g, n, "z") for i, s, g, n, t in rows], "text string, doc_id long, source string, lang string, n_chars long, grp string").repartition(6)
    assert ran(manifest(spark, docs, tampered_sevenths(), span=span, arity=arity)) == brute(rows, arity)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_very_small_tables(spark, n):
    rows = [(i, "s", "en", 3, "abc") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert ran(manifest(spark, docs, tampered_sevenths())) == brute(rows) if rows else ran(manifest(spark, docs)) == []


def test_folding_resumes_the_state_before_the_slot(monkeypatch):
    nodes = [H(str(i)) for i in range(13)]
    tree = Subtree(nodes, arity=3)
    for i in range(13):
        other = [*nodes[:i], H("new"), *nodes[i + 1:]]
        assert tree.fold(i, H("new")) == levels(other, 3)[-1][0]
    fed = []

    class Counting:
        def __init__(self, state):
            self.state = state

        def copy(self):
            return Counting(self.state.copy())

        def update(self, data):
            fed.append(data)
            self.state.update(data)

        def hexdigest(self):
            return self.state.hexdigest()

    tree.states = [[Counting(s) for s in level] for level in tree.states]
    assert tree.fold(2, nodes[2]) == tree.root
    assert len(fed) == 1 + 1 + 2 + 1 + 1  # the node and what is right of it: none of 3, 2 of 3, 1 of 2
    tall = Subtree(nodes[:1], arity=2, height=3)
    assert tall.root == H(H(H(nodes[0]))) and tall.siblings(0) == [("", "")] * 3
