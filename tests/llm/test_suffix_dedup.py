import hashlib
import random

import pytest

from voltstream.llm.suffix_dedup import LENGTH, op10_suffix_dedup, without_repeats

SF = "/root/testdata/sf0.001"


def brute(rows):
    """rows: (doc_id, text) in order → (doc_id, n_bytes, n_removed, n_spans, sha256)."""
    seen, out = set(), []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - LENGTH + 1):
            piece = hash(raw[i:i + LENGTH])
            if piece in seen:
                gone[i:i + LENGTH] = b"\1" * LENGTH
            seen.add(piece)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def ran(found):
    return [(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found.collect()]


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in op10_suffix_dedup(spark, SF).collect())
    assert got == brute([tuple(r) for r in rows])
    assert sum(r[2] for r in got) > 0


def texts(seed):
    """Passages in many contexts, overlaps, periodic runs, exact and edited copies."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(rnd.randint(18, 80)) for _ in range(6)]
    out = ["", None, "short", "x" * 99, "x" * 100, "x" * 101, "ab" * 300, "y" + "ab" * 200, "z" * 500]
    for _ in range(60):
        out.append(" ".join(rnd.choice([rnd.choice(shared), prose(rnd.randint(1, 30)), rnd.choice(shared)[rnd.randint(0, 60):]]) for _ in range(rnd.randint(1, 5))))
    out += [rnd.choice(out[9:]) for _ in range(10)]
    for _ in range(20):
        t = list(rnd.choice(out[9:]))
        for _ in range(rnd.randint(1, 3)):
            t[rnd.randrange(len(t))] = "#"
        out.append("".join(t))
    return out


@pytest.mark.parametrize("among,group", [(1 << 20, 256), (0, 40), (1 << 20, 3)])
def test_small_cases_on_every_path(spark, among, group):
    rows = list(enumerate(texts(5)))
    docs = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, spans string").repartition(5)
    assert sorted(ran(without_repeats(spark, docs, among=among, group=group))) == brute(rows)


def test_pieces_of_long_texts(spark, monkeypatch):
    from voltstream.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    rows = [(i, t) for i, t in enumerate(texts(6)) if t]
    rows.append((1000, " ".join(t for _, t in rows[::-1])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(ran(without_repeats(spark, docs))) == brute(rows)


def test_repeated_and_null_ids_and_empty(spark):
    a, b = "alpha " * 40, "beta " + "alpha " * 40
    docs = spark.createDataFrame([(1, a), (1, a), (None, a), (0, None)], "doc_id long, text string")
    got = ran(without_repeats(spark, docs))
    assert sorted((g[0] is None, g[0] or 0, g[2]) for g in got) == [(False, 0, 0), (False, 1, brute([(1, a)])[0][2]), (False, 1, 240), (True, 0, 240)]
    assert b and without_repeats(spark, docs.where("doc_id > 5")).collect() == []


def test_rows_of_one_id_and_text_are_no_earlier_than_each_other(spark, tmp_path):
    """By the query's contract a string goes if it starts earlier: in a smaller doc_id, or at an earlier start of its own."""
    a, b = "alpha " * 40, "".join(f"{i} beta " for i in range(40))
    rows = [(1, a), (1, a), (2, b), (2, b), (2, b), (3, None), (3, None), (4, b + "x"), (5, a[:120])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    alone = {r[0]: r for r in brute([rows[0], rows[2], rows[5], rows[7], rows[8]])}
    got = sorted(tuple(r) for r in op10_suffix_dedup(spark, str(tmp_path)).collect())
    assert got == [alone[i] for i, _ in rows]
    assert [r[2] for r in got] == [234, 234, 0, 0, 0, 0, 0, len(b), 120]


def test_ranges_are_merged():
    from voltstream.llm.suffix_dedup import _merged_ranges

    merged = lambda *r: list(zip(*(x.tolist() for x in _merged_ranges(*map(list, zip(*r))))))
    assert merged((1, 5, 9), (0, 0, 50), (0, 10, 20), (1, 9, 12), (1, 14, 15), (0, 50, 51)) == [(0, 0, 51), (1, 5, 12), (1, 14, 15)]
    assert [len(x) for x in _merged_ranges([], [], [])] == [0, 0, 0]


def test_collisions_are_found_out(spark, monkeypatch):
    """With hashes that say that everything is equal, bytes decide."""
    import numpy as np

    from voltstream.llm import suffix_dedup

    body = [b"a" * 40 + b"G" * 32 + b"b" * 68, b"a" * 40 + b"G" * 32 + b"c" * 68, b"a" * 40 + b"G" * 32 + b"b" * 68]
    args = np.zeros(3, np.int64), np.array([5, 6, 7]), np.array([40, 40, 40]), np.array([40] * 3), np.array([40] * 3), body
    want = [x.tolist() for x in suffix_dedup.shared_strings(*args)]
    assert want == [[2], [40], [40]]
    monkeypatch.setattr(suffix_dedup.PrefixHashes, "of", lambda self, start, length: np.zeros(len(start), np.uint64))
    assert [x.tolist() for x in suffix_dedup.shared_strings(*args)] == want
