import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from voltstream.llm import encode as E
from voltstream.llm.encode import WordEncoder, default_path
from voltstream.llm.token_files import op3_token_files, read_token_files, write_token_files
from voltstream.session import run_dir

SF = "/root/testdata/sf0.001"

ODD = ["", " ", "it's DON'T 'tis they'll", "a b c\x1cd\x85e", "<|endoftext|> x<|startoftext|>y <|", "ΑΣ ΟΔΟΣ. İstanbul ŒUVRE",
       "é café ́x a ́", "３ ½ ²³ 12345 1,234.5", "日本語テキスト 한국어 😀😀🏽", "ß ẞ STRASSE Öl ÿ Ÿ × ÷", "foo_bar--baz!!! (x)[y]{z}~`^|", "µm ªº \x00\x01 \t\r\n\x0b\x0c", "ﬁ ﬂ ﻿bom", "K Å ẞ", "x" * 5000]


def brute(rows):
    lib = Tokenizer.from_file(default_path())
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = lib.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_words_encode_as_whole_texts():
    lib = Tokenizer.from_file(default_path())
    ids, counts = WordEncoder(default_path()).ids(pa.array(ODD))
    want = [lib.encode(t, add_special_tokens=False).ids for t in ODD]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == sum(want, [])
    assert WordEncoder(default_path()).lengths(pa.array(ODD)).tolist() == counts.tolist()


def test_runs_are_cut_from_bytes(monkeypatch):
    """Odd words and the runs of the others, against regular expressions, which words() doesn't need."""
    rng, signs = random.Random(5), "abzAZ09!&'(-<|~ÀÖ×ØÞßàö÷øÿ\x7f\x80Āµ日😀"
    words = ["", *signs, "<|x", "a<", "|b", "é" * 300, *("".join(rng.choices(signs[rng.choice([0, 0, 9]):rng.choice([11, 13, 25, 34])], k=rng.randrange(1, 9))) for _ in range(3000)), ""]
    odd = re.compile(r"[^!-&(-~À-ÖØ-öø-ÿ]|<\|")
    run = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
    for given in (words, words[::-1], [], [""]):
        for array in (pa.array(given, pa.large_string()), pa.array(["日x", *given, "y"], pa.large_string()).slice(1, len(given))):
            is_odd = E._odd_words(array)
            for i, (w, got) in enumerate(zip(given, is_odd)):
                assert got == bool(odd.search(w)) or got and w[:1] == "|" and given[i - 1][-1:] == "<"
            plain = [w.lower() for w in given if not odd.search(w)]
            runs, at = E._simple_runs(pa.array(plain, pa.large_string()))
            runs = runs.to_pylist()
            assert [runs[a:b] for a, b in zip(at[:-1], at[1:])] == [run.findall(w) for w in plain]
    for name in ("match_substring_regex", "replace_substring_regex", "split_pattern"):
        monkeypatch.delattr(E.pc, name)
    lib = Tokenizer.from_file(default_path())
    ids, counts = WordEncoder(default_path()).ids(pa.array(words))
    want = [lib.encode(w, add_special_tokens=False).ids for w in words]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_query_against_the_library(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in op3_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == brute(rows)


def test_nulls_ties_and_empty(spark):
    folder = run_dir(spark, "t")
    docs = spark.createDataFrame([(3, None, "a"), (1, "b c", "b"), (1, "b c", "b"), (2, "", None), (None, "null id", "x")], "doc_id long, text string, start string")
    got = [tuple(r) for r in read_token_files(write_token_files(spark, docs, folder), folder).orderBy("start").collect()]
    assert [g[0] for g in got] == [None, 1, 1, 2, 3]
    assert [g[1] for g in got] == np.concatenate([[0], np.cumsum([g[2] for g in got])[:-1]]).tolist()
    assert got[1][2:] == got[2][2:] and got[3][2:] == got[4][2:] == (1, zlib.crc32(b"\x02\0\0\0"))
    folder = run_dir(spark, "t")
    assert read_token_files(write_token_files(spark, docs.where(F.lit(False)), folder), folder).collect() == []
