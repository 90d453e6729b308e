"""Queries with SQL against DuckDB, and what the entry point offers."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from voltstream.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(want) == sorted(tuple(r) for r in df.select(*cols).collect())


def test_every_operator_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in registry.queries()} == set(range(1, 14))
    assert set(registry.queries()) | {"pipeline"} <= names


def test_entry_point_without_the_subpackage(tmp_path):
    """As the driver leaves it: the folders and corpus_pipeline.py are gone."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for name in os.listdir(root):
        if name not in ("corpus_pipeline.py", "voltstream", ".git", "tests"):
            os.symlink(f"{root}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "voltstream")
    for name in os.listdir(f"{root}/voltstream"):
        if name != "llm":
            os.symlink(f"{root}/voltstream/{name}", tmp_path / "voltstream" / name)
    os.rename(tmp_path / "__spark_entry__.py", tmp_path / "link.py")
    (tmp_path / "__spark_entry__.py").write_text(open(f"{root}/__spark_entry__.py").read())
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[2:] == ["False", "False"] and int(out.stdout.split()[0]) >= 44
