import heapq
import random
from fractions import Fraction

import pytest

from voltstream.llm.mix import mix, mixed_documents, op6_mix_sources, pfair_period, shares_to_counts


def edf(counts, slots):
    """Earliest deadline first over released blocks, slot by slot, without the period."""
    period, done, out = sum(counts.values()), dict.fromkeys(counts, 0), []
    for slot in range(slots):
        ready = [(-(-(done[s] + 1) * period // p), s) for s, p in counts.items() if done[s] * period // p <= slot]
        _, s = heapq.nsmallest(1, ready)[0]
        done[s] += 1
        out.append(s)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_schedule_is_pfair(seed):
    rnd = random.Random(seed)
    counts = shares_to_counts({f"s{i}": rnd.random() ** 3 for i in range(rnd.randint(1, 30))}, 256)
    assert sum(counts.values()) == 256 and min(counts.values()) >= 1
    slots = pfair_period(counts)
    order = sorted((x + r * 256, s) for s, found in slots.items() for x in found for r in range(3))
    assert [s for _, s in order] == edf(counts, 3 * 256)
    had = dict.fromkeys(counts, 0)
    for t, (_, s) in enumerate(order, 1):
        had[s] += 1
        assert all(abs(Fraction(counts[x] * t, 256) - had[x]) < 1 for x in counts)


def check(rows, found, block, counts, weights=None):
    """The mix is the schedule's blocks, each source's documents in one order, over and over."""
    by_slot = {}
    for r in sorted(found, key=lambda r: (r.slot, r.place)):
        by_slot.setdefault(r.slot, []).append(r)
    assert sorted(by_slot) == list(range(len(by_slot)))
    wanted = edf(counts, len(by_slot))
    name = lambda s: "n" if s is None else f"s{s}"
    assert [name(b[0].source) for b in by_slot.values()] == wanted
    order = {}
    for b in by_slot.values():
        assert len({r.source for r in b}) == 1 and [r.place for r in b] == list(range(len(b)))
        order.setdefault(b[0].source, []).extend((r.epoch, r.doc_id) for r in b)
    for s, got in order.items():
        own = sorted(i for i, x in rows if x == s)
        first = [d for e, d in got if e == 0]
        assert sorted(first) == own
        assert [d for _, d in got] == (first * len(got))[:len(got)]
        assert [e for e, _ in got] == sorted(e for e, _ in got)


def test_against_slot_by_slot_scheduling(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["a"] * 12 + ["b", "c", "d", None])) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string").repartition(7)
    for weights in (None, {"a": 1, "b": 1, None: 2, "c": 0.5, "d": 0.25}):
        found = mix(spark, docs, weights=weights, block=4, period=64).collect()
        size = {s: -(-sum(x == s for _, x in rows) // 4) for s in "abcd"} | {None: -(-sum(x is None for _, x in rows) // 4)}
        name = lambda s: "n" if s is None else f"s{s}"
        target = {name(s): (n ** 0.9 if weights is None else weights[s]) for s, n in size.items()}
        check(rows, found, 4, shares_to_counts(target, 64))


def test_long_tail_against_target_weights(spark):
    """A hot source and 200 of 3 documents: every source stays within a block of its target weight over the whole mix."""
    size = {"hot": 40_000} | {f"t{i}": 3 for i in range(200)}
    weights = {"hot": 5000 ** 0.9} | {f"t{i}": 1.0 for i in range(200)}
    docs = spark.createDataFrame([(i, s) for s, n in size.items() for i in range(n)], "doc_id long, source string")
    total = sum(map(Fraction, weights.values()))
    for given in (None, weights):
        found = mix(spark, docs, weights=given).select("slot", "source", "doc_id", "epoch").where("place = 0").orderBy("slot").collect()
        assert [r.slot for r in found] == list(range(len(found)))
        had = dict.fromkeys(size, 0)
        for t, r in enumerate(found, 1):
            had[r.source] += 1
            assert t % 97 and t != len(found) or all(abs(n - Fraction(weights[s]) / total * t) < 1 for s, n in had.items())
        assert had["hot"] >= 5000 and max(had[s] for s in size if s != "hot") <= 5000 ** 0.1 + 1


def test_query_keeps_every_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source").collect()]
    found = op6_mix_sources(spark, "/root/testdata/sf0.001").collect()
    size = {f"s{s}": -(-sum(x == s for _, x in rows) // 8) for s in {x for _, x in rows}}
    check(rows, found, 8, shares_to_counts({s: n ** 0.9 for s, n in size.items()}, 1024))


def test_columns_nulls_and_empty(spark):
    docs = spark.createDataFrame([(1, "t", "a", 5), (1, "t", "a", 5), (None, None, None, 6), (2, "", "b", None)], "doc_id long, text string, source string, slot long")
    mixed = mixed_documents(spark, docs)
    assert mixed.columns == docs.columns and mixed.count() >= 4
    assert {tuple(r) for r in mixed.collect()} == {tuple(r) for r in docs.collect()}
    assert mixed_documents(spark, docs.where("doc_id > 9")).collect() == [] and mix(spark, docs.where("doc_id > 9").select("doc_id", "source")).collect() == []
    assert {r.source for r in mix(spark, docs.select("doc_id", "source"), weights={"a": 1.0}).collect()} == {"a"}
