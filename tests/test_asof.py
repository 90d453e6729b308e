"""As-of pairing against a brute-force reference on random inputs."""

import datetime as dt
import random

from voltstream.operators.asof import asof_pair


def brute(starts, stops):
    out = []
    for key, t_stop, v_stop in stops:
        cands = [(t, o, v) for k, t, o, v in starts if k == key and t <= t_stop]
        if cands:
            t, o, v = max(cands)
            out.append((key, v, t, v_stop, t_stop))
    return sorted(out)


def test_asof_matches_brute_force(spark):
    rng = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    starts = [(rng.choice(keys), base + dt.timedelta(minutes=rng.randrange(0, 3000)), i, i * 10) for i in range(400)]
    stops = [(rng.choice(keys), base + dt.timedelta(minutes=rng.randrange(0, 3000)), -i) for i in range(300)]
    # ties: a stop at exactly a start time, and two starts at one time
    starts.append(("hot", base + dt.timedelta(minutes=5), 9999, 1))
    starts.append(("hot", base + dt.timedelta(minutes=5), 10000, 2))
    stops.append(("hot", base + dt.timedelta(minutes=5), -9999))
    left = spark.createDataFrame(starts, "k string, ts timestamp, o int, v int")
    right = spark.createDataFrame(stops, "k string, te timestamp, w int")
    got = asof_pair(left, right, ["k"], "ts", "te", "o", bucket_seconds=3600)
    rows = sorted((r.k, r.v, r.ts, r.w, r.te) for r in got.collect())
    exp = brute([s for s in starts if s[0] is not None], [s for s in stops if s[0] is not None])
    assert rows == exp


def test_asof_small_buckets(spark):
    base = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([("x", base, 1, 5)], "k string, ts timestamp, o int, v int")
    right = spark.createDataFrame([("x", base + dt.timedelta(days=40), 7)], "k string, te timestamp, w int")
    # the only start lies 40 days (960 one-hour buckets) before the stop: carried across buckets
    got = asof_pair(left, right, ["k"], "ts", "te", "o", bucket_seconds=3600).collect()
    assert [(r.v, r.w) for r in got] == [(5, 7)]
