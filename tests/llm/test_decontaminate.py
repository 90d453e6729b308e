import random

import pytest

from voltstream.llm import decontaminate
from voltstream.llm.decontaminate import leaks, op7_decontaminate, without_leaks

SF = "/root/testdata/sf0.001"
ITEM = "Tom has 12 apples and buys 3 kg of pears. How many days can Tom feed Anna if Tom and Anna eat 5 apples every day of the week?"


def run(spark, texts, items=(ITEM,), **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.coverage for r in leaks(spark, docs, bench, **options).collect()}


def test_reparameterised_and_plain_copies(spark):
    other = ITEM.replace("Tom", "Bob").replace("Anna", "Eve").replace("12", "45").replace(" 3 kg", " 7 lb").replace(" 5 ", " 6 ")
    mixed_up = ITEM.replace("How many days can Tom", "How many days can Bob")  # 20 of 25 windows are the item's word for word
    muddled = other.replace("How many days can Bob", "How many days can Jim").replace("if Bob", "if Sam")  # Tom is Bob, Jim and Sam
    noise = "completely different words about nothing in particular, going on and on without any end in sight"
    texts = [ITEM, f"{noise} {ITEM} {noise}", f"{noise} {other} {noise}", mixed_up, ITEM.lower(), noise, "", None, " ".join(ITEM.split()[:12]), f"Indeed {ITEM}", muddled]
    found = run(spark, texts)
    assert set(found) == {(0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (9, 0)} and found[3, 0] == 0.8
    assert run(spark, [mixed_up.replace("apples", "plums", 1)]) == {}  # 16 of 25


def test_equal_numbers_may_be_independent(spark):
    item = "A basket holds 2 apples and 2 pears while the other one holds 5 kg of plums and 5 kg of old bread for Tom"
    texts = [item.replace("2 apples", "4 apples").replace("2 pears", "7 pears"), item.replace("5 kg of old", "6 lb of old"), item.replace("holds", "lacks")]
    assert run(spark, texts, [item]) == {(0, 0): 1.0, (1, 0): 1.0}


def test_numbers_units_and_short_items(spark):
    items = ["12 km", "", "x y z w", ITEM]
    texts = ["12 km", "it is 12 km from here to there", "99 km", "x y z w", "X y z w.", "x y z w v", ITEM, "it is 99 km from here to there", "w z y x and x y z", "so x, y z w!"]
    assert set(run(spark, texts, items)) == {(0, 0), (1, 0), (2, 0), (3, 2), (4, 2), (5, 2), (6, 3), (9, 2)}


def test_lists_of_numbers_match_by_value(spark):
    """Very long texts of numbers alone against items of numbers: held only where the numbers are, and nothing grows with the square."""
    rnd = random.Random(4)
    numbers = [str(rnd.randint(0, 10 ** 6)) for _ in range(10_000)]
    items = [" ".join(numbers[500:530]), " ".join(str(i) for i in range(40)), "7 " * 12]
    texts = [" ".join(numbers), " ".join(numbers[:510] + numbers[520:]), " ".join(reversed(numbers)), "7 " * 3000, " ".join(map(str, range(1000, 3000)))]
    windows = lambda t: [tuple(w) for w in zip(*(t.split()[k:] for k in range(5)))]
    own = [set(windows(t)) for t in texts]
    want = {(d, i) for d in range(len(texts)) for i, x in enumerate(items) if sum(w in own[d] for w in windows(x)) >= 0.8 * len(windows(x))}
    assert set(run(spark, texts, items)) == want == {(0, 0), (3, 2)}


def brute(docs, items):
    """Plain word windows: every item of the tables is pasted as it is."""
    import regex

    words = lambda t: [w.lower() for w in regex.findall(r"\d+(?:[.,]\d+)*|\p{L}+", t)]
    windows = lambda w: [tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))]
    found = set()
    for d, t in docs:
        own = set(windows(words(t)))
        for i, x in items:
            w = windows(words(x))
            if sum(k in own for k in w) >= 0.8 * len(w):
                found.add((d, i))
    return found


@pytest.mark.parametrize("hashes", [1 << 20, 10])
def test_query_finds_the_pasted_items(spark, monkeypatch, hashes):
    monkeypatch.setattr(decontaminate, "FILTER_HASHES", hashes)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in op7_decontaminate(spark, SF).collect()}
    assert got == brute(docs, items) and got


def test_stage_keeps_clean_rows(spark):
    rows = [(1, "clean text of some words", "a"), (None, ITEM, "b"), (None, "clean too", "c"), (2, ITEM, "d"), (1, "clean text of some words", "a"), (3, None, "e"), (1, ITEM, "f")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, template string, _leak string")
    bench = spark.createDataFrame([(0, ITEM), (None, "clean text of some words"), (1, None)], "item_id long, text string")
    kept = without_leaks(spark, docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.template for r in kept.collect())) == ["a", "a", "c", "e"]
    assert without_leaks(spark, docs, bench.where("item_id > 9")).count() == 7 and without_leaks(spark, docs.where("doc_id > 9"), bench).count() == 0
