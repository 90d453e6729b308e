import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from voltstream.llm.common import components, stage
from voltstream.llm.encode import default_path

SF = "/root/testdata/sf0.01"


def test_components_against_union_find(spark):
    rng = np.random.default_rng(0)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2300)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components(spark, spark.createDataFrame(links + [(None, 5)], "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == {x: find(x) for x in list(root)}
    assert components(spark, spark.createDataFrame([], "a long, b long")).collect() == []


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, function(spark, docs, SF), name)
        assert docs.columns == columns
        after = docs.collect()
        kept = {r.doc_id: r.text for r in after}
        assert kept and all(before[i] == t for i, t in kept.items())
        if name == "mix":
            assert set(kept) == set(before)  # nothing is lost
        else:
            assert len(after) == len(kept) and len(kept) > 0.75 * len(before)
        before = kept
    placed = docs.select("doc_id", "text", "_metadata.file_name", "_metadata.row_index").collect()
    lib, start, want = Tokenizer.from_file(default_path()), 0, []
    for r in sorted(placed, key=lambda r: (r.file_name, r.row_index)):
        ids = lib.encode(r.text, add_special_tokens=False).ids + [2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == want


@pytest.mark.parametrize("name,function", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, name, function):
    rows = [(1, None, None, None, None, "x"), (None, "", "en", "a", 0, "y"), (2, "w " * 30_000, "en", "a", 1, "y"), (2, "w " * 30_000, "en", "a", 1, "y"), (3, "some words", None, "b", 2, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, slot string")
    out = function(spark, docs, "/root/testdata/sf0.001")
    assert out.count() >= 3 and (name == "token_files" or out.columns == docs.columns)
    assert function(spark, docs.where(F.lit(False)), "/root/testdata/sf0.001").count() == 0
