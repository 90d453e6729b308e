import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from voltstream.llm import language, quality, token_counts
from voltstream.llm.encode import default_path

SF = "/root/testdata/sf0.001"


def test_token_counts_against_the_library(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 64)
    lib = Tokenizer.from_file(default_path())
    n = [len(lib.encode(r.text or "", add_special_tokens=False).ids) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    sums = token_counts.op1_token_counts(spark, SF)
    got = {r.length: tuple(r) for r in sums.collect()}
    assert set(got) == set(n)
    for x in got:
        long = [k for k in n if k >= x]
        assert got[x][:5] == (x, n.count(x), len(long), sum(long), sum(min(k, x) for k in n)) and math.isclose(got[x][5], 1 - len(long) / len(n))
    limits = [0, 1, 7, 500, 10**6]
    assert {r.context: (r.docs_over, r.cut_tokens) for r in token_counts.totals_at(sums, limits).collect()} == {x: (sum(k > x for k in n), sum(min(k, x) for k in n)) for x in limits}
    assert {r.share: r.length for r in token_counts.quantiles(sums, [0.01, 0.5, 1.0]).collect()} == {q: sorted(n)[math.ceil(q * len(n)) - 1] for q in (0.01, 0.5, 1.0)}


def test_token_counts_of_odd_tables(spark):
    docs = spark.createDataFrame([(None, 1), ("", 2), ("a b", 3), ("a b", 3)], "text string, length long")
    sums = token_counts.suffix_sums(spark, token_counts.length_histogram(docs))
    assert sorted(tuple(r) for r in sums.collect()) == [(0, 2, 4, 4, 0, 0.0), (2, 2, 2, 4, 4, 0.5)]
    none = token_counts.suffix_sums(spark, token_counts.length_histogram(docs.where("length > 9")))
    assert none.collect() == [] and [tuple(r) for r in token_counts.totals_at(none, [5]).collect()] == [(5, 0, 0)] and token_counts.quantiles(none, [0.5]).collect() == []


def test_token_counts_of_a_very_long_text(spark):
    text = "It's 12 km, isn't it? " * 60_000
    n = len(Tokenizer.from_file(default_path()).encode(text, add_special_tokens=False).ids)
    hist = token_counts.length_histogram(spark.createDataFrame([(text,), ("a",)], "text string"))
    assert sorted(r.length for r in hist.collect()) == sorted([1, n])


def brute_forward(run, table, k):
    text = language.MARK + run
    a = [1.0] + [0.0] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(j):
            p = table.get(text[i:j])
            a[j] += a[i] * (p[k] if p is not None else language.UNKNOWN if j - i == 1 else 0.0)
    return math.log(a[-1])


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(0)
    pieces = sorted({"▁", "▁a", "▁ab", "a", "b", "ab", "ba", "abc", "c", "aba", "é", "▁é"})
    p = rng.random((len(pieces), 3)) / 10
    runs = ["a", "ab", "abab", "zab", "é", "abcabca" * 3, "b" * 40, "xyz"]
    got = language.Forward(pieces, p).log_probabilities(runs)
    table = dict(zip(pieces, p))
    want = [[brute_forward(r, table, k) for k in range(3)] for r in runs]
    assert np.allclose(got, want)
    long = language.Forward(pieces, p).log_probabilities(["ab" * 3000])
    assert np.isfinite(long).all()


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = language.op5_language(spark, sf)
    lang = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("i"), "lang")
    rows = got.join(lang, F.col("doc_id") == F.col("i")).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_language_of_odd_inputs(spark):
    docs = spark.createDataFrame([(i, t, g, "x") for i, (t, g) in enumerate([("der die das und", "de"), ("the and of to", "en")] * 10)] +
                                 [(50, None, "en", "x"), (51, "12 ½ _!", "de", "x"), (52, "the", None, "x"), (None, "die und", "de", "x"), (53, "und" * 3000, None, "x")], "doc_id long, text string, lang string, score string")
    model = language.learn(docs.where(language.training_rows("doc_id")))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    assert got[0][0] == "de" and got[1][0] == "en" and got[52][0] == "en" and got[None][0] == "de" and got[53][0] == "de"
    assert got[50] == got[51] == ("und", 0.0) and all(0 <= s <= 1 for _, s in got.values())
    nothing = language.learn(docs.where("doc_id > 999"))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()} == {("und", 0.0)}
    assert language.identify(docs.where("doc_id > 999"), model).collect() == []


def test_quality_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = sorted(docs.select("doc_id", "text", "source", "lang").collect())
    model = quality.fit(docs, labels)
    p = model.of(pa.array([r.text for r in rows]))
    rate = p.mean()

    def prior(groups, means):
        n = np.array([len(g) for g in groups])
        between = sum(len(g) * (p[g].mean() - m) ** 2 for g, m in zip(groups, means))
        within = sum(len(g) * m * (1 - m) for g, m in zip(groups, means)) / n.sum()
        return quality.strength(len(n), n.sum(), (n * n).sum(), within, between)

    def grouped(key):
        out = {}
        for i, r in enumerate(rows):
            out.setdefault(key(r), []).append(i)
        return out

    hosts, paths = grouped(lambda r: r.source), grouped(lambda r: (r.source, r.lang))
    k = prior(list(hosts.values()), [rate] * len(hosts))
    mean = {h: (p[g].sum() + k * rate) / (len(g) + k) for h, g in hosts.items()}
    k2 = prior(list(paths.values()), [mean[h] for h, _ in paths])
    odds = lambda x: math.log(x / (1 - x))
    got = {r.doc_id: r for r in quality.op2_quality(spark, sf).collect()}
    for i, r in enumerate(rows):
        h, q = hosts[r.source], paths[r.source, r.lang]
        host = (p[h].sum() - p[i] + k * rate) / (len(h) - 1 + k)
        path = (p[q].sum() - p[i] + k2 * host) / (len(q) - 1 + k2)
        want = 1 / (1 + math.exp(-(odds(p[i]) + odds(path) - odds(rate))))
        assert math.isclose(got[r.doc_id].path_rate, path, rel_tol=1e-6) and math.isclose(got[r.doc_id].score, want, rel_tol=1e-5)
    marked = {r.doc_id: r.quality for r in labels.collect()}
    assert sum(got[i].keep == (marked[i] == 1) for i in got if i in marked) >= 0.95 * len(marked)


def test_sparse_sites_shrink_to_their_priors(spark):
    """A site's own rate counts the more, the more documents it has."""
    model = quality.Evidence(np.empty((0, 12)), np.empty(0))
    assert model.of(pa.array(["a", ""])).tolist() == [0.5, 0.5]
    assert quality.strength(10, 1000, 1e5, 0.2, 10 * 0.2) > 1e3 > 10 > quality.strength(10, 1000, 1e5, 0.2, 500 * 0.2)


def test_quality_of_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None, None, None, 0.5), (1, None, None, None, 0.5), (None, "", "a", "b", 0.1), (2, "words " * 9, "a", None, 0.2), (3, "#" * 5000, "a", "b", 0.3)],
                                 "doc_id long, text string, source string, lang string, score double")
    labels = spark.createDataFrame([(2, 1), (3, 0), (None, 1), (1, None)], "doc_id long, quality int")
    rows = quality.site_scores(spark, docs, quality.fit(docs, labels)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and 0 <= r.path_rate <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[2].score > by[3].score
    assert quality.site_scores(spark, docs.where("doc_id > 9"), quality.fit(docs, labels)).collect() == []
