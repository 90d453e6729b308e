"""Whole-text encoding with a public tokenizer of the ``tokenizers`` library, memoised by word."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from voltstream.llm.common import Words, ranges, strings, worker_memo

#: Entries of a generation of a worker's memo (about 200 bytes each); it holds two.
GENERATION = 250_000

# A word of ASCII signs and Latin-1 letters without the apostrophe normalises to lower case, and the file's split
# pattern cuts it into runs: letters, single digits, other signs. Kinds of the bytes of such words in UTF-8 (letters
# beyond ASCII are two bytes, the first 0xC3):
_LETTER, _DIGIT, _SIGN, _ODD = range(4)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[ord("'")] = _ODD
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:0xC0] = _KIND[0xC3] = _LETTER
#: Runs encoded in one call.
_JOINED = 512
#: Mark of word-end tokens in the file.
_END = "</w>"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of large strings in a row, where each begins and the last one ends)."""
    if not len(words):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8))[at[0]:at[-1]], at - at[0]


def _odd_words(words: pa.Array) -> np.ndarray:
    """Which words have other characters than those of simple runs, or ``<|``, with which special tokens begin."""
    raw, at = _bytes_of(words)
    bad = _KIND[raw] == _ODD
    two = raw[:-1]
    bad[1:] |= (two == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))  # × and ÷ are no letters
    bad[1:] |= (two == ord("<")) & (raw[1:] == ord("|"))  # in two words: the later one counts as odd, with the same ids
    odd = np.zeros(len(words), bool)
    odd[np.searchsorted(at, np.flatnonzero(bad), side="right") - 1] = True
    return odd


def _simple_runs(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the runs of lower-case words that aren't odd, one after the other; where each word's begin and the last one's end)."""
    raw, at = _bytes_of(words)
    kind = _KIND[raw]
    first = kind == _DIGIT
    first[1:] |= kind[1:] != kind[:-1]
    first[at[at < len(raw)]] = True
    begin = np.flatnonzero(first)
    runs = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(np.append(begin, len(raw))), pa.py_buffer(np.ascontiguousarray(raw)))
    return runs, np.searchsorted(begin, at)


class WordEncoder:
    """Ids of texts under a word-end BPE file that drops white space.

    The file's normaliser and split pattern never join text across white
    space, so a text's ids are its words' ids in a row. Words of simple runs
    are put together from the runs' ids; any other word (and any with the
    file's special tokens) goes to the library as it is. Runs and such words are memoised in two generations.
    """

    def __init__(self, path: str):
        self.memo = worker_memo(f"ids {path}")
        if "lib" not in self.memo:  # once per worker process, not per task
            self.memo |= {"lib": self._load(path), "new": {}, "old": {}}
        #: The tokenizer, the numbers of its ids (16 bits where the vocabulary fits), and which ids end a word.
        self.lib, self.dtype, self.ends = self.memo["lib"]
        self.size = len(self.ends)

    @staticmethod
    def _load(path: str) -> tuple:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        lib = Tokenizer.from_file(path)
        vocabulary = lib.get_vocab(with_added_tokens=True)
        ends = np.zeros(lib.get_vocab_size(with_added_tokens=True), bool)
        ends[[i for token, i in vocabulary.items() if token.endswith(_END)]] = True
        return lib, np.dtype("<u2" if len(ends) <= 1 << 16 else "<u4"), ends

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def _runs(self, runs: list[str]) -> list[bytes]:
        """The ids of simple runs, which are words of the split pattern each: encoded in a row, cut after word-end ids."""
        out, size = [], self.dtype.itemsize
        for k in range(0, len(runs), _JOINED):
            part = runs[k:k + _JOINED]
            ids = np.array(self.lib.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.dtype)
            end = (size * (1 + np.flatnonzero(self.ends[ids]))).tolist()
            if len(end) == len(part):
                flat = ids.tobytes()
                out += [flat[a:b] for a, b in zip([0, *end[:-1]], end)]
            else:
                out += [self._bytes(x.ids) for x in self.lib.encode_batch_fast(part, add_special_tokens=False)]
        return out

    def _pieces(self, runs: list[str], odd: list[str]) -> list[bytes]:
        """The ids of runs and odd words, from the memo where it has them."""
        new, old = self.memo["new"], self.memo["old"]
        pieces = runs + odd
        found = list(map(new.get, pieces))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        if old:
            for i in unknown:
                ids = old.get(pieces[i])
                if ids is not None:
                    found[i] = new[pieces[i]] = ids
            unknown = [i for i in unknown if found[i] is None]
        first = [i for i in unknown if i < len(runs)]
        rest = [pieces[i] for i in unknown[len(first):]]
        made = self._runs([pieces[i] for i in first])
        made += [self._bytes(e.ids) for e in self.lib.encode_batch_fast(rest, add_special_tokens=False)] if rest else []
        for i, ids in zip(unknown, made):
            found[i] = new[pieces[i]] = ids
        if len(new) > GENERATION:  # what comes up again is taken over from the old generation
            self.memo["new"], self.memo["old"] = {}, new
        return found

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each word's begin, how many it has)."""
        words = pc.cast(words, pa.large_string())
        odd = _odd_words(words)
        runs, at = _simple_runs(pc.utf8_lower(words.filter(pa.array(~odd))))
        coded = runs.dictionary_encode()
        runs, code = strings(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
        found = self._pieces(runs, words.filter(pa.array(odd)).to_pylist())
        each = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        begin = np.cumsum(each) - each
        pieces = np.frombuffer(b"".join(found), self.dtype)
        # plain words' ids are put together from their runs'
        n = each[code]
        flat = pieces[ranges(begin[code], n)]
        total = np.concatenate([[0], np.cumsum(n)])
        start, count = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        start[~odd], count[~odd] = total[at[:-1]], total[at[1:]] - total[at[:-1]]
        start[odd], count[odd] = len(flat) + begin[len(runs):] - (begin[len(runs)] if odd.any() else 0), each[len(runs):]
        return np.concatenate([flat, pieces[begin[len(runs)]:] if odd.any() else pieces[:0]]), start, count

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        words = Words(texts)
        total = np.concatenate([[0], np.cumsum(self.words(words.dictionary)[2][words.code])])
        return total[words.start[1:]] - total[words.start[:-1]]

    def ids(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(all ids as ``dtype``, number of ids of each text); ``end_id`` closes each text."""
        words = Words(texts)
        flat, start, each = self.words(words.dictionary)
        n = each[words.code]
        total = np.concatenate([[0], np.cumsum(n)])
        counts = total[words.start[1:]] - total[words.start[:-1]]
        ids = flat[ranges(start[words.code], n)]
        if end_id is None:
            return ids, counts
        if end_id > np.iinfo(self.dtype).max:
            ids = ids.astype("<u4")
        counts = counts + 1
        end = np.cumsum(counts) - 1
        own = np.ones(len(ids) + len(counts), bool)
        own[end] = False
        out = np.empty(len(own), ids.dtype)
        out[own], out[end] = ids, end_id
        return out, counts
