"""Session helpers: sizing settings and the shared scratch folder."""

from voltstream.session import run_dir, scale_settings, shared_dir


def test_scale_settings_sizes_partitions():
    s = scale_settings(100 * 10**12, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert s["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = scale_settings(10**6, 16)
    assert int(small["spark.sql.shuffle.partitions"]) == 32  # never below 2 x cores


def test_run_dirs_are_fresh_under_the_shared_folder(spark):
    base = shared_dir(spark)
    a, b = run_dir(spark, "x"), run_dir(spark, "x")
    assert a != b and a.startswith(base + "/") and b.startswith(base + "/")
