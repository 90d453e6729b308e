"""Language identification with segmentation-marginalised unigrams.

The pieces are the lower-case letter pieces of a fixed public vocabulary (nothing is trained but their
probabilities). A text is its letter runs, lower-cased, each with the word-begin mark; the probability of a run in a
language is the sum over all its segmentations into pieces of the product of the pieces' probabilities, by the
forward algorithm. Piece probabilities come from counting pieces (the vocabulary's own segmentation) in all training
texts of the language, with additive smoothing; a letter outside the vocabulary has one small probability everywhere.
The language of highest posterior (with the languages' shares as prior) is predicted, the posterior is the score.

Scale: two maps over the documents. Counts leave tasks as sums by (language, piece), at most vocabulary size times
languages rows a task; the model is that table. Runs are scored once per distinct run of a slice and kept in a
bounded memo of the worker.

Cases: very long texts are read whole; NULL texts and texts without a letter are ``und`` with score 0, and so is everything if nothing was learned; NULL
languages and ids are never learned from; repeated rows count and are predicted each; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.llm.common import Words, filled, ranges, segment_sums, text_slices, worker_memo

MARK, UNKNOWN, SMOOTHING = "▁", 1e-8, 0.1
#: Runs whose log-probabilities (or pieces) a worker keeps.
MEMO_ENTRIES = 300_000
_BASE = 0x5DEECE66D2B79F91


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pieces_of(path: str) -> list[str]:
    """The vocabulary's pieces of lower-case letters, with or without the mark in front."""
    import regex
    from sentencepiece import SentencePieceProcessor

    lib = SentencePieceProcessor(model_file=path)
    word = regex.compile(rf"{MARK}?\p{{L}}*")
    return sorted({p for p in (lib.id_to_piece(i) for i in range(lib.get_piece_size())) if p and word.fullmatch(p) and p == p.lower()})


class Runs:
    """Distinct letter runs of some texts, and for each text how often it has which."""

    def __init__(self, texts: pa.Array):
        import regex

        letters = regex.compile(r"\p{L}+")
        words = Words(texts)
        number: dict[str, int] = {}
        of_word, size = [], []
        for word in words.unique:
            found = letters.findall(word.lower())
            size.append(len(found))
            for run in found:
                of_word.append(number.setdefault(run, len(number)))
        size = np.array(size, np.int64)
        self.runs = list(number)
        self.code = np.array(of_word, np.int64)[ranges((np.cumsum(size) - size)[words.code], size[words.code])]
        self.start = np.concatenate([[0], np.cumsum(size[words.code])])[words.start]


class Forward:
    """Log-probabilities of runs under several unigram distributions over the same pieces."""

    def __init__(self, pieces: list[str], probability: np.ndarray):
        """``probability``: a row for each piece, a column for each language."""
        self.longest = max(map(len, pieces), default=1)
        self.languages = probability.shape[1]
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_length.setdefault(len(p), []).append(i)
        self.tables = {}
        for n, at in by_length.items():
            h = self._hash([pieces[i] for i in at])
            order = np.argsort(h)
            self.tables[n] = h[order], probability[np.array(at)[order]]

    @staticmethod
    def _hash(strings: list[str]) -> np.ndarray:
        """Polynomial hashes of strings of equal length."""
        codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(strings), -1).astype(np.uint64)
        h = np.zeros(len(strings), np.uint64)
        for k in range(codes.shape[1]):
            h = h * np.uint64(_BASE) + codes[:, k]
        return h

    def log_probabilities(self, runs: list[str]) -> np.ndarray:
        out = np.zeros((len(runs), self.languages))
        if not runs:
            return out
        size = np.fromiter((len(r) + 1 for r in runs), np.int64, len(runs))
        order = np.argsort(-size, kind="stable")
        codes = np.frombuffer("".join(MARK + runs[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        size = size[order]
        begin = np.cumsum(size) - size
        forward = {0: np.ones((len(runs), self.languages))}  # scaled by 1 / exp(total)
        total = np.zeros((len(runs), self.languages))
        for end in range(1, int(size[0]) + 1):
            n = int(np.searchsorted(-size, -end, side="right"))  # runs at least this long come first
            here, h, power = np.zeros((n, self.languages)), np.zeros(n, np.uint64), 1
            for length in range(1, min(self.longest, end) + 1):
                h = h + codes[begin[:n] + end - length] * np.uint64(power)  # the hash of the last ``length`` letters
                power = power * _BASE % (1 << 64)
                known = np.zeros(n, bool)
                if length in self.tables:
                    table, probability = self.tables[length]
                    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
                    known = table[at] == h
                    rows = np.flatnonzero(known)
                    here[rows] += forward[end - length][rows] * probability[at[rows]]
                if length == 1:
                    here[~known] += forward[end - 1][:n][~known] * UNKNOWN
            np.maximum(here, 1e-300, out=here)
            total[:n] += np.log(here)
            for k in range(max(0, end - self.longest + 1), end):
                forward[k] = forward[k][:n] / here
            forward.pop(end - self.longest, None)
            forward[end] = np.ones((n, self.languages))
        out[order] = total
        return out


def training_rows(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 != 0


def piece_counts(docs: DataFrame, lang_col: str, text_col: str, path: str) -> DataFrame:
    """(lang, piece, n) over all texts of ``docs``; a NULL piece counts the language's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        lib = SentencePieceProcessor(model_file=path)
        pieces = pieces_of(path)
        number = {p: i for i, p in enumerate(pieces)}
        memo = worker_memo(f"pieces {path}")
        counts: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}

        def cut(run: str) -> list[int]:
            found = memo.get(run)
            if found is None:
                found = [number[p] for p in lib.encode(run, out_type=str) if p in number]
                if len(memo) < MEMO_ENTRIES:
                    memo[run] = found
            return found

        for part in text_slices(batches, "text"):
            texts = Runs(filled(part, "text"))
            lang = np.array(part.column("lang").to_pylist(), object)
            found = [cut(r) for r in texts.runs]
            size = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for f in found for i in f), np.int64, int(size.sum()))
            for name in sorted(set(lang)):
                own = np.flatnonzero(lang == name)
                code = texts.code[ranges(texts.start[own], np.diff(texts.start)[own])]
                often = np.bincount(code, minlength=len(size))
                add = np.bincount(flat, weights=np.repeat(often, size), minlength=len(pieces)).astype(np.int64)
                counts[name] = counts.get(name, 0) + add
                seen[name] = seen.get(name, 0) + len(own)
        for name, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(at) + 1), pa.string()), pa.array([pieces[i] for i in at] + [None], pa.string()), pa.array([*n[at].tolist(), seen[name]], pa.int64())],
                ["lang", "piece", "n"])

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null")
    return rows.mapInArrow(run, "lang string, piece string, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))


class Identifier:
    def __init__(self, counts: list[tuple], path: str):
        """``counts``: (lang, piece or None, n)."""
        self.languages = sorted({c[0] for c in counts})
        pieces = pieces_of(path)
        row, column = {p: i for i, p in enumerate(pieces)}, {x: i for i, x in enumerate(self.languages)}
        n, docs = np.full((len(pieces), len(self.languages)), SMOOTHING), np.zeros(len(self.languages))
        for lang, piece, count in counts:
            if piece is None:
                docs[column[lang]] += count
            else:
                n[row[piece], column[lang]] += count
        self.prior = np.log(docs / docs.sum()) if len(docs) else docs
        self.forward = Forward(pieces, n / n.sum(axis=0) if len(docs) else n)
        self.name = hashlib.blake2b(repr(sorted(counts, key=repr)).encode(), digest_size=16).hexdigest()

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        found = Runs(texts)
        lettered = np.diff(found.start) > 0
        if not self.languages:
            return ["und"] * len(lettered), np.zeros(len(lettered))
        models = worker_memo("language models")
        if self.name not in models:  # runs are kept for the latest model only
            models.clear()
            models[self.name] = {}
        memo = models[self.name]
        new = [r for r in found.runs if r not in memo]
        fresh = dict(zip(new, self.forward.log_probabilities(new)))
        each = np.array([fresh[r] if r in fresh else np.frombuffer(memo[r]) for r in found.runs]).reshape(-1, len(self.languages))
        for r in new[:max(0, MEMO_ENTRIES - len(memo))]:
            memo[r] = fresh[r].tobytes()
        post = segment_sums(each[found.code], found.start) + self.prior
        post = np.exp(post - post.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        best = post.argmax(axis=1)
        return [self.languages[b] if x else "und" for b, x in zip(best, lettered)], np.where(lettered, post.max(axis=1), 0.0)


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", path: str | None = None) -> Identifier:
    """Learn from all rows of ``docs`` with a language."""
    path = path or default_path()
    # vocabulary size times languages at most
    return Identifier([tuple(r) for r in piece_counts(docs, lang_col, text_col, path).collect()], path)


def identify(docs: DataFrame, model: Identifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            lang, score = model.predict(filled(part, "text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, learn(docs.where(training_rows("doc_id"))))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
