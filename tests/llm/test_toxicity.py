import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from voltstream.llm import toxicity as T


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    texts = T.Texts(pa.array(["one two three four", "five two six " * 12, "seven"]), {"one": 1, "two": 2})
    known = np.arange(T.CHAR_ROWS) % 50
    texts.pieces = [(known[r], at) for r, at in texts.pieces]
    net = T.Network({"one": 1, "two": 2}, known)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    at = np.arange(len(texts.doc))
    label = np.array([1.0, 0.0, 1.0, 0.0, 1.0])[:len(at)]
    args = texts.word, texts.pieces, texts.codes(at), texts.length[at], label
    grad, _ = net.gradients(*args)
    for name, p in net.p.items():
        flat = p.reshape(-1)
        for k in rng.choice(len(flat), min(6, len(flat)), replace=False):
            old, losses = flat[k], []
            for step in (1e-4, -1e-4):
                flat[k] = old + step
                losses.append(net.gradients(*args)[1])
            flat[k] = old
            assert abs((losses[0] - losses[1]) / 2e-4 - grad[name].reshape(-1)[k]) < 1e-4, name


def test_windows_cover_every_word():
    for n in (1, 31, 32, 33, 55, 56, 57, 200):
        texts = T.Texts(pa.array(["w " * n, "", "v " * n]), {})
        spans = [(b, b + k) for b, k in zip(texts.begin.tolist(), texts.length.tolist())]
        assert {i for a, b in spans for i in range(a, b)} == set(range(2 * n))
        assert all(a < n and b <= n or a >= n for a, b in spans)


def test_scoring_in_batches_is_the_same():
    rng = np.random.default_rng(1)
    text = [" ".join(rng.choice(["bad", "good", "fine", "words", "here"], rng.integers(1, 90))) for _ in range(60)]
    net = T.train(text, [int("bad" in t) for t in text], steps=5)
    texts = T.Texts(pa.array(text), net.vocabulary, net.known)
    assert np.allclose(net.window_scores(texts, 7), net.window_scores(texts), atol=1e-6)
    assert np.allclose(net.scores(pa.array(text)), np.concatenate([net.scores(pa.array([t])) for t in text]), atol=1e-6)


def test_every_window_counts():
    """A document's evidence is the highest over the windows from every word on, scored one by one."""
    rng = np.random.default_rng(2)
    text = [" ".join(rng.choice(["bad", "good", "fine", "words", "here", "so"], n)) for n in [1, 31, 32, 33, 0, 56, 57, 90, 32, 5, 70, 64]]
    net = T.train([f"{t} {'bad bad' * (i % 2)}" for i, t in enumerate(text * 4)], [i % 2 for i in range(4 * len(text))], steps=5)
    full, found = net.evidence(T.Texts(pa.array(text), net.vocabulary, net.known))
    assert full.tolist() == [i for i, t in enumerate(text) if t]
    for i, (logit, log_n, _) in zip(full, found):
        words = text[i].split()
        windows = T.Texts(pa.array([" ".join(words[k:k + T.WIDTH]) for k in range(max(1, len(words) - T.WIDTH + 1))]), net.vocabulary, net.known)
        best = float(net.window_scores(windows).max())
        assert abs(logit - np.log(best / (1 - best))) < 1e-3 and np.isclose(log_n, np.log(len(windows.doc)))


def test_window_scores_of_large_weights_and_many_batches():
    """Where gates are far beyond the range of exp, and where windows fall into several batches."""
    rng = np.random.default_rng(3)
    text = [" ".join(rng.choice(["bad", "good", "fine", "words", "here", "so"], n)) for n in (16, 40, 3, 90)]
    net = T.train([f"{t} {'bad bad' * (i % 2)}" for i, t in enumerate(text * 8)], [i % 2 for i in range(32)], steps=5)
    for times in (1, 300):
        for k in ("wf", "wb", "uf", "ub", "a"):
            net.p[k] = net.p[k] * np.float32(times)
        texts = T.Texts(pa.array(text), net.vocabulary, net.known)
        words = " ".join(text).split()
        windows = T.Texts(pa.array([" ".join(words[k:k + T.WIDTH]) for k in range(len(words) - T.WIDTH + 1)]), net.vocabulary, net.known)
        want = net.window_scores(windows)
        for batch in (7, 1920):
            got = net.start_scores(texts, batch)
            assert np.isfinite(got).all() and np.allclose(got, want, atol=1e-5 if times == 1 else 1e-3)


def test_first_steps_are_taken_once_per_distinct_word(monkeypatch):
    """A window needs WIDTH - 1 steps of its own, and exp, which costs half of tanh."""
    net = T.train([f"some plain text {i} {'bad ' * (i % 2)}" * 9 for i in range(60)], [i % 2 for i in range(60)], steps=2)
    texts, done = T.Texts(pa.array(["some plain text 1 bad " * 400]), net.vocabulary, net.known), {"exp": 0, "tanh": 0}
    for name in done:
        plain = getattr(np, name)

        def counted(x, *args, _plain=plain, _name=name, **kw):
            done[_name] += np.size(x)
            return _plain(x, *args, **kw)

        monkeypatch.setattr(T.np, name, counted)
    n = len(net.start_scores(texts))
    a_window = (T.WIDTH - 1) * 6 * T.HIDDEN + T.WIDTH * (T.ATTENTION + 1) + 1  # the last: the score's own
    assert n > 1900 and done["tanh"] == 0 and done["exp"] <= a_window * n + 4 * T.HIDDEN * len(texts.words)


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = T.op8_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").alias("i"), "toxic")
    rows = got.join(labels, F.col("doc_id") == F.col("i")).where("held_out").collect()
    hit = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in hit) >= 0.85 * len(hit)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_odd_inputs(spark):
    docs = spark.createDataFrame([(i, f"plain text number {i} " * 5 + ("awful slur" if i % 2 else ""), "x") for i in range(60)] +
                                 [(100, None, "y"), (101, " ", "y"), (None, "null id awful slur", "y"), (102, "a" * 100_000, "y"), (0, "again", "y")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    net = T.fit(spark, docs, labels)
    rows = {(r.doc_id): r.score for r in T.score(docs, net).collect()}
    assert len(rows) == 64 and rows[100] == rows[101] == net.prior and all(0 <= s <= 1 for s in rows.values())
    kept = T.without_toxic(docs, net)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i in range(0, 60, 2)} and not {r.doc_id for r in kept.collect()} & {i for i in range(1, 60, 2)}
    none = T.fit(spark, docs, labels.where("toxic = 0"))
    assert {r.score for r in T.score(docs, none).collect()} == {0.0}
    assert {r.score for r in T.score(docs, T.fit(spark, docs, labels.where("doc_id > 999"))).collect()} == {0.0}
    assert T.score(docs.where("doc_id > 999"), net).collect() == []
