"""Benchmark decontamination by template canonicalisation.

Texts become token sequences in which numbers, names and units are typed placeholders:

* number: digits with inner ``.`` or ``,``                        -> ``<num>``, value: the digits
* unit:   a word of ``UNITS`` right after a number                -> ``<unit>``, value: the word
* name:   a Title-case word that doesn't open a sentence          -> ``<name>``, value: the word
* any other run of letters, lower-cased, stands for itself; other signs only end sentences (. ! ? :)

A *template window* is ``window`` tokens in a row (a shorter text: all of it). Windows are hash-joined on the
template; matches of a document and an item are grouped by diagonal (document position minus item position). On a
diagonal each item name stands for the document name that most of its windows say; a window that says otherwise
doesn't count, unless it is the item's word for word. Equal numbers or units of an item may be independent, so each of
their slots stands for itself.
The coverage of an item in a document is the share of its windows matched on some diagonal; from ``coverage`` on the
document counts as holding the item, re-parameterised or not.

A window of placeholders alone says nothing but its values, so it is matched by them (a list of numbers is only the
item's if the numbers are). An item of fewer than ``window`` tokens is held by a document that is its template as a
whole, and by any text that has it word for word.

An item's first word may be a name or not depending on where it was pasted, and a pasted text may be
lower-cased, so items are also windowed with the first word as a name and without names.

Scale: documents are tokenised in their scan tasks; windows whose hash is not among the benchmark's are
dropped there (``FILTER_HASHES`` bounds the hashes that tasks get; a larger benchmark skips this and
joins all windows, with the same result). The rest is an equi-join on the template, then partial aggregates and joins
by diagonal; very long texts are windowed whole.

Cases: NULL and empty texts hold and match nothing; NULL document ids are matched by content; repeated
rows all count; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.llm.common import Words, filled, free_name, ranges, row_key, stage, text_slices

#: Window hashes of the benchmark that are sent to every task (8 bytes each).
FILTER_HASHES = 1 << 20

UNITS = frozenset(
    "mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t gram grams kilogram kilograms "
    "ton tons tonne tonnes oz ounce ounces lb lbs pound pounds ml cl dl l liter liters litre litres gallon gallons pint "
    "pints cup cups ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year "
    "years hz khz mhz ghz w kw mw kwh j kj cal kcal v kv a ma ohm ohms n pa kpa bar psi k c f degree degrees percent "
    "cent cents dollar dollars usd eur euro euros gbp yen rupee rupees b kb mb gb tb bit bits byte bytes mph kmh kph".split()
)

_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+")
_ENDS = re.compile(r"[.!?:][^\w\s]*$")
_LIT, _NUM, _TITLE, _UNIT = 0, 1, 2, 3
_SLOT = {_NUM: "<num>", _TITLE: "<name>", _UNIT: "<unit>"}
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Templates:
    """The tokens of some texts with their slots; ``start`` gives each text's tokens."""

    def __init__(self, texts: pa.Array, names: bool = True, open_name: bool = False):
        """``names``: make name slots; ``open_name``: a text's first word counts as inside a sentence."""
        from xxhash import xxh64_intdigest

        words = Words(texts)
        known: dict[str, int] = {}
        self.value: list[str] = []
        kind, of_word, size, ends = [], [], [], []
        for word in words.unique:
            found = _TOKEN.findall(word)
            size.append(len(found))
            ends += [False] * (len(found) - 1) + [_ENDS.search(word) is not None] if found else []
            for token in found:
                at = known.get(token)
                if at is None:
                    at = known[token] = len(self.value)
                    self.value.append(token)
                    kind.append(_NUM if token[0].isdigit() else _UNIT if token.lower() in UNITS else
                                _TITLE if len(token) > 1 and token[0].isupper() and token[1:].islower() else _LIT)
                of_word.append(at)
        hashes = np.fromiter((xxh64_intdigest(v.lower().encode("utf-8", "surrogatepass")) for v in self.value), np.uint64, len(self.value))
        kind, of_word, ends, size = np.array(kind, np.int8), np.array(of_word, np.int64), np.array(ends, bool), np.array(size, np.int64)
        at = ranges((np.cumsum(size) - size)[words.code], size[words.code])
        total = np.concatenate([[0], np.cumsum(size[words.code])])
        self.start = total[words.start]
        self.token = of_word[at]
        self.kind = kind[self.token]
        n = len(self.token)
        opens = np.zeros(n, bool)
        opens[1:] = ends[at][:-1]
        first = self.start[:-1][np.diff(self.start) > 0]
        opens[first] = not open_name
        after_number = np.zeros(n, bool)
        after_number[1:] = self.kind[:-1] == _NUM
        after_number[first] = False
        self.kind[(self.kind == _UNIT) & ~after_number] = _LIT
        self.kind[(self.kind == _TITLE) & (opens | (not names))] = _LIT
        self.plain = hashes[self.token]
        self.hash = self.plain.copy()
        for k, mark in _SLOT.items():
            self.hash[self.kind == k] = np.uint64(xxh64_intdigest(mark))

    def _hashes(self, at: np.ndarray, size: np.ndarray, values: np.ndarray) -> np.ndarray:
        """A hash of the ``size`` values from each place on."""
        h = size.astype(np.uint64)
        for k in range(int(size.max(initial=0))):
            inside = k < size
            h[inside] = (h[inside] ^ values[at[inside] + k]) * _MULTIPLIER
            h ^= h >> np.uint64(29)
        return h

    def windows(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, position in the text, tokens, hash, by value) of every window; a shorter text is one window.

        Full windows of placeholders alone go by their values.
        """
        count = np.diff(self.start)
        n = np.where(count >= window, count - window + 1, np.minimum(count, 1))
        text = np.repeat(np.arange(len(count)), n)
        at = ranges(self.start[:-1], n)
        size = np.minimum(count, window)[text]
        words = np.concatenate([[0], np.cumsum(self.kind == _LIT)])
        by_value = (size == window) & (words[at + size] == words[at])
        h = self._hashes(at, size, self.hash)
        h[by_value] = ~self._hashes(at[by_value], size[by_value], self.plain)
        return text, at - self.start[text], size, h, by_value

    def short_windows(self, sizes: list[int], whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``windows``, by value: every window of each of the sizes (``whole``: those that are a whole text)."""
        out = []
        for tokens in sizes:
            count = np.diff(self.start)
            n = np.where(count == tokens, 1, 0) if whole else np.maximum(count - tokens + 1, 0)
            text, at = np.repeat(np.arange(len(count)), n), ranges(self.start[:-1], n)
            size = np.full(len(at), tokens)
            out.append((text, at - self.start[text], size, ~self._hashes(at, size, self.plain), np.ones(len(at), bool)))
        return tuple(np.concatenate(x) for x in zip(*out))

    def template(self, text: int, position: int, size: int, by_value: bool) -> tuple[str, list[str]]:
        """The window's template (its words, if it goes by value), and its slot values."""
        parts, slots = [], []
        for i in range(self.start[text] + position, self.start[text] + position + size):
            k, value = int(self.kind[i]), self.value[self.token[i]].lower()
            parts.append(value if by_value else _SLOT.get(k, value))
            if k in _SLOT and not by_value:
                slots.append(f"{_SLOT[k]} {value}")
        return ("= " if by_value else "") + " ".join(parts), slots


_ROW = "key string, position long, size int, n_windows long, h long, template string, slots array<string>"


def _windows(rows: DataFrame, window: int, variants: list[dict], among: np.ndarray | None = None, short: list[int] = (), whole: bool = False) -> DataFrame:
    """The template windows of ``rows(key, text)``, and by value those of ``short`` tokens; those with a hash in ``among`` (sorted) if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            keys = part.column("key")
            for nth, variant in enumerate(variants):
                found = Templates(filled(part, "text"), **variant)
                windows = found.windows(window)
                total = np.bincount(windows[0], minlength=len(keys))
                for text, position, size, h, by_value in [windows, *([found.short_windows(short, whole)] if short and not nth else [])]:
                    if among is not None:
                        hit = np.flatnonzero(among[np.minimum(np.searchsorted(among, h), len(among) - 1)] == h) if len(among) else []
                        text, position, size, h, by_value = text[hit], position[hit], size[hit], h[hit], by_value[hit]
                    made = [found.template(*x) for x in zip(text.tolist(), position.tolist(), size.tolist(), by_value.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(text)), pa.array(position), pa.array(size, pa.int32()), pa.array(total[text]), pa.array(h.view(np.int64)),
                         pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.list_(pa.string()))],
                        ["key", "position", "size", "n_windows", "h", "template", "slots"])

    return rows.select("key", "text").mapInArrow(run, _ROW)


def _consistent(matches: DataFrame) -> DataFrame:
    """Matches that are verbatim or say of each item name what most matches of their diagonal say."""
    diagonal = ["doc", "item", "diagonal"]
    told = matches.select(*diagonal, "position", "item_slots", F.explode("pairs").alias("p"))
    told = told.select(*diagonal, "position", "item_slots", F.col("p.item_slots").alias("name"), F.col("p.doc_slots").alias("says"))
    votes = told.groupBy(*diagonal, "name", "says").agg(F.count("*").alias("n"))
    most = votes.groupBy(*diagonal, "name").agg(F.max_by("says", F.struct("n", "says")).alias("most"))
    wrong = told.join(most, [*diagonal, "name"]).where("says <> most").select(*diagonal, "position", "item_slots").distinct()
    return matches.where("same").unionByName(matches.where("not same").join(wrong, [*diagonal, "position", "item_slots"], "left_anti").select(*matches.columns))


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", window: int = 5, coverage: float = 0.8) -> DataFrame:
    """One row per document and item that it holds: key, doc_id, item_id, n_windows, n_matched, coverage.

    ``key`` is ``common.row_key`` of the document's row.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("key"), F.col(item_text).cast("string").alias("text")).where("key is not null")
    variants = [{}, {"open_name": True}, {"names": False}]
    made = _windows(items, window, variants, short=list(range(1, window)), whole=True)
    item_windows = stage(spark, made.dropDuplicates(["key", "position", "template", "slots"]), "item-windows")
    hashes = item_windows.select("h").distinct().limit(FILTER_HASHES + 1).collect()
    among = np.sort(np.array([r.h for r in hashes], np.int64).view(np.uint64)) if len(hashes) <= FILTER_HASHES else None
    short = sorted(r.size for r in item_windows.where(F.col("size") < window).select("size").distinct().collect())  # window - 1 at most
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    doc_windows = stage(spark, _windows(keyed, window, [{}], among, short), "doc-windows")

    left = doc_windows.select(F.col("template").alias("t"), F.col("key").alias("doc"), F.col("position").alias("at"), F.col("slots").alias("doc_slots"))
    right = item_windows.select("template", F.col("key").alias("item"), "position", "n_windows", F.col("slots").alias("item_slots"))
    pairs = F.filter(F.arrays_zip("item_slots", "doc_slots"), lambda p: p["item_slots"].startswith(_SLOT[_TITLE]))
    matches = stage(spark, left.join(right, left.t == right.template).select(
        "doc", "item", "n_windows", (F.col("at") - F.col("position")).alias("diagonal"), "position", "item_slots",
        (F.col("item_slots") == F.col("doc_slots")).alias("same"), pairs.alias("pairs")), "matches")
    matched = (
        _consistent(matches).select("doc", "item", "n_windows", "position").distinct()
        .groupBy("doc", "item", "n_windows").agg(F.count("*").alias("n_matched"))
        .where(F.col("n_matched") >= coverage * F.col("n_windows"))
    )
    return matched.select(
        F.col("doc").alias("key"), F.expr("try_cast(split_part(doc, ':', 1) as bigint)").alias("doc_id"), F.col("item").cast("long").alias("item_id"),
        "n_windows", "n_matched", (F.col("n_matched") / F.col("n_windows")).alias("coverage"))


def without_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    leak = free_name(docs, "_leak")
    found = stage(spark, leaks(spark, docs, benchmark, id_col, text_col, **options).select(F.col("key").alias(leak)).distinct(), "leaks")
    return docs.join(found, row_key(id_col, text_col) == F.col(leak), "left_anti")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("key")
