"""Exact substring removal: every byte covered by a ``LENGTH``-byte string that also starts earlier in the corpus.

A suffix array over the corpus would hold a row for each byte. Here only *anchors* are sorted:

1. The anchor of a ``LENGTH``-byte string is its ``GRAM``-byte piece of smallest polynomial hash (leftmost of equal
   ones). It depends on the string alone, so equal strings have equal anchors at equal offsets, and consecutive
   strings share anchors: there is about one for every 35 bytes. The strings of one anchor occurrence form a
   stretch: offsets lo .. hi from string start to anchor, bytes anchor - hi .. anchor - lo + LENGTH.
2. Anchors seen once are done (counted with map-side sums); only stretches with a repeated anchor go on.
3. Tasks collapse their own equal stretches (128-bit digests of their bytes): all but the first are removed whole. The
   rest meets by anchor without its bytes: in order of digest and place the first of each digest stays, the others
   are removed whole, over all tasks. Anchors with one digest left are done.
4. Only the first stretches of anchors that have several go on with their bytes. Anchors with up to ``GROUP`` of them
   go to hash-compared suffix sorting: prefix polynomial hashes give a
   substring's hash in O(1), binary search on them the common extension of two suffixes, so a comparison takes
   O(log LENGTH) in a mergesort of the anchored suffixes. The LCP array gives the right extension of any two of a
   group, a hash search the left one, both the strings that they share; the later one's go. Matches are verified on
   the bytes; after a collision the extensions are measured on the bytes.
5. Anchors with more different stretches (a passage pasted in very many contexts) are dealt anew by content: offsets are
   cut into quarters, and a stretch's quarter is keyed by the bytes that all strings of that quarter contain. Quarters
   take steps 3 and 4 again, 4 times at most; a single offset's key is the string itself.
6. Removed ranges are joined to the documents by document.

Up to ``AMONG`` repeated anchors (4 bytes of each) are sent to the tasks that cut out stretches; with more of them
the anchors' positions are joined to the anchors, then to the documents, with the same result.

Order is (doc_id, hash of the text); NULL ids come last, and of fully repeated rows one counts as earlier, unless
``copies_alike``: then rows of the same id and text are one document (no string starts earlier in one than in the
other), worked out once and returned as often as it came. Cases: NULL texts are empty; texts under LENGTH bytes lose
nothing; matches never cross documents; empty tables give empty results; other columns are ignored; very long texts
are hashed in pieces of ``PIECE`` bytes with overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.llm.common import filled, ranges, small_batches, stage, text_slices, worker_memo

LENGTH, GRAM = 100, 32
#: Bytes hashed at once.
PIECE = 1 << 18
#: Stretches sorted at once.
CHUNK = 1 << 14
#: Repeated anchors that are sent to every task (4 bytes of each; another anchor with these 4 bytes does no harm).
AMONG = 4 << 20
#: Different stretches of an anchor that are compared within a task.
GROUP = 256
#: Digests that a task remembers for collapsing.
SEEN = 1 << 16

_BASE = 0x5DEECE66D2B79F91
_INVERSE = pow(_BASE, -1, 1 << 64)
_CELLS = LENGTH - GRAM + 1
_STRETCH = "key long, digest binary, ord long, p long, lo int, hi int, body binary"
_REMOVED = "ord long, begin long, end long"


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept by the worker."""
    memo = worker_memo("powers")
    if len(memo.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            powers = np.full(n, base, np.uint64)
            powers[0] = 1
            memo[name] = np.multiply.accumulate(powers)
    return memo["up"][:n], memo["down"][:n]


class PrefixHashes:
    """Polynomial hashes (mod 2**64) of any piece of a byte buffer."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * up[:-1], dtype=np.uint64, out=self.prefix[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.down[start]

    def extension(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
        """Common bytes from x and y on (``back``: before them), at most ``limit``: binary search on hashes."""
        found = np.zeros(len(x), np.int64)
        step = 1 << max(int(limit.max(initial=0)).bit_length() - 1, 0)
        while step:
            at = np.flatnonzero(found + step <= limit)
            a, b = (x[at] - found[at] - step, y[at] - found[at] - step) if back else (x[at] + found[at], y[at] + found[at])
            found[at] += step * (self.of(a, step) == self.of(b, step))
            step >>= 1
        return found


def stretches(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(piece, key, anchor, lo, hi) of every stretch in the pieces start[i] .. end[i] of a buffer."""
    count = np.maximum(end - start - LENGTH + 1, 0)
    if not count.sum():
        none = np.empty(0, np.int64)
        return none, none.view(np.uint64), none, none, none
    h = PrefixHashes(data).of(np.arange(len(data) - GRAM + 1), GRAM)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while 2 * size <= _CELLS:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = _CELLS - size
    least = np.minimum(least[:-rest], least[rest:]) if rest else least
    string = ranges(start, count)
    piece = np.repeat(np.arange(len(start)), count)
    anchor = (least[string] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(piece) != 0)]))
    last = np.concatenate([first[1:], [len(string)]]) - 1
    p = anchor[first]
    return piece[first], h[p], p, p - string[last], p - string[first]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string array's bytes and where its texts begin (one more than texts)."""
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def _blocks(at: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Pieces (text, begin, end), about ``PIECE`` bytes at a time; pieces of a long text overlap by LENGTH - 1."""
    block, size = [], 0
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        for x in range(a, max(b - LENGTH + 1, a + 1), PIECE):
            y = min(b, x + PIECE + LENGTH - 1)
            if y - x >= LENGTH:
                block.append((i, x, y))
                size += y - x
            if size >= PIECE:
                yield block
                block, size = [], 0
    if block:
        yield block


def _found(texts: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, key, anchor position in the text, lo, hi, first byte of the stretch in ``data``, data) by block."""
    data, at = _bytes_of(texts)
    for block in _blocks(at):
        text, begin, end = (np.array(x, np.int64) for x in zip(*block))
        size = end - begin
        base = np.cumsum(size) - size
        piece, key, p, lo, hi = stretches(np.concatenate([data[a:b] for a, b in zip(begin, end)]), base, base + size)
        shift = (begin - base)[piece]
        yield text[piece], key, p + shift - at[text[piece]], lo, hi, p + shift - hi, data


def _anchor_counts(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            found = [f[1] for f in _found(filled(part, "text"))]
            key, n = np.unique(np.concatenate([*found, np.empty(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _digest(body: bytes, lo: int, hi: int) -> bytes:
    return hashlib.blake2b(body, digest_size=16, salt=bytes((lo, hi))).digest()


def _merged_ranges(ord_: list[int], begin: list[int], end: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of a document that touch or overlap, as one."""
    o, b, e = (np.array(x, np.int64) for x in (ord_, begin, end))
    if not len(o):
        return o, b, e
    order = np.lexsort((b, o))
    o, b, e = o[order], b[order], e[order]
    first = np.concatenate([[True], np.diff(o) != 0])
    number = np.cumsum(first) - 1
    wide = int(e.max(initial=0)) + 1
    reach = np.maximum.accumulate(e + number * wide) - number * wide  # the furthest end so far in the document
    new = np.flatnonzero(first | (b > np.concatenate([[0], reach[:-1]])))
    last = np.concatenate([new[1:], [len(o)]]) - 1
    return o[new], b[new], reach[last]


def _collapsed(rows: list[tuple], seen: dict[bytes, tuple]) -> Iterator[pa.RecordBatch]:
    """Stretches (key, ord, p, lo, hi, body); of equal ones the first, the others' ranges as rows with a NULL key.

    ``seen``: where the task had a digest first, kept from call to call.
    """
    best: dict[bytes, int] = {}
    digests, gone = [], []
    for i, (_, ord_, p, lo, hi, body) in enumerate(rows):
        d = _digest(body, lo, hi)
        digests.append(d)
        if d in seen and seen[d] < (ord_, p):
            gone.append(i)
            continue
        j = best.setdefault(d, i)
        if j != i:
            if (ord_, p) < rows[j][1:3]:
                best[d], j = i, j
                gone.append(j)
            else:
                gone.append(i)
    if len(seen) + len(best) > SEEN:
        seen.clear()
    for d, i in best.items():
        seen[d] = rows[i][1:3]
    at = sorted(best.values())
    if at:
        column = lambda k, kind: pa.array([rows[i][k] for i in at], kind)
        yield pa.RecordBatch.from_arrays(
            [column(0, pa.int64()), pa.array([digests[i] for i in at], pa.binary()), *[column(k, t) for k, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.int32()), (4, pa.int32()), (5, pa.binary()))]],
            ["key", "digest", "ord", "p", "lo", "hi", "body"])
    if gone:
        r = [rows[i] for i in gone]
        o, b, e = _merged_ranges([x[1] for x in r], [x[2] - x[4] for x in r], [x[2] - x[3] + LENGTH for x in r])
        n = len(o)  # p - hi is the begin, p - lo + LENGTH the end
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(o), pa.array(b), pa.array((LENGTH - (e - b)).astype(np.int32)), pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.binary())],
            ["key", "digest", "ord", "p", "lo", "hi", "body"])


def _cut(docs: DataFrame, among: np.ndarray) -> DataFrame:
    """The stretches with an anchor whose upper 4 bytes are in ``among`` (sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        for part in text_slices(batches, "text", 2 << 20):
            ords, rows = part.column("ord").to_numpy(), []
            for text, key, p, lo, hi, first, data in _found(filled(part, "text")) if len(among) else ():
                upper = (key >> np.uint64(32)).astype(np.uint32)
                hit = np.flatnonzero(among[np.minimum(np.searchsorted(among, upper), len(among) - 1)] == upper)
                last = first + hi - lo + LENGTH
                for k, o, x, a, b, f, e in zip(*(v[hit].tolist() for v in (key.view(np.int64), ords[text], p, lo, hi, first, last))):
                    rows.append((k, o, x, a, b, data[f:e].tobytes()))
            yield from _collapsed(rows, seen)

    return docs.select("ord", "text").mapInArrow(run, _STRETCH)


def _cut_joined(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """As ``_cut``, for any number of repeated anchors: positions joined to anchors, then to documents."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            ords = part.column("ord").to_numpy()
            for text, key, p, lo, hi, _, _ in _found(filled(part, "text")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(ords[text]), pa.array(p), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                    ["key", "ord", "p", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        for part in text_slices(batches, "text"):
            rows = []
            for o, text, places in zip(*(part.column(c).to_pylist() for c in ("ord", "text", "places"))):
                data = (text or "").encode("utf-8", "surrogatepass")
                rows += [(x["key"], o, x["p"], x["lo"], x["hi"], data[x["p"] - x["hi"]:x["p"] - x["lo"] + LENGTH]) for x in places]
            yield from _collapsed(rows, seen)

    every = docs.select("ord", "text").mapInArrow(places, "key long, ord long, p long, lo int, hi int")
    wanted = every.join(repeated.select(F.col("key").alias("_key")), F.col("key") == F.col("_key"), "left_semi")
    by_doc = wanted.groupBy(F.col("ord").alias("_ord")).agg(F.collect_list(F.struct("key", "p", "lo", "hi")).alias("places"))
    return docs.join(by_doc, F.col("ord") == F.col("_ord")).select("ord", "text", "places").mapInArrow(run, _STRETCH)


def _sort_groups(hashes: PrefixHashes, data: np.ndarray, at: np.ndarray, limit: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes data[at[i]:at[i] + limit[i]] within runs of equal ``group``: bottom-up mergesort, all runs at once."""
    n = len(at)
    order = np.arange(n)
    start = np.searchsorted(group, group, side="left")
    size = np.searchsorted(group, group, side="right") - start
    place = order - start
    width = 1
    while width < size.max(initial=0):
        who = np.flatnonzero(size > width)  # slots whose groups still merge
        i, run = order[who], place[who] // width
        begin = start[who] + (run ^ 1) * width
        end = np.minimum(begin + width, start[who] + size[who])
        low, high = np.minimum(begin, end), end.copy()
        left = run % 2 == 0
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) // 2
            x, y = i[open_], order[mid]
            both = np.minimum(limit[x], limit[y])
            same = hashes.extension(at[x], at[y], both)
            ended = same == both
            bx = np.where(ended & (limit[x] == both), -1, data[np.minimum(at[x] + same, len(data) - 1)].astype(np.int64))
            by = np.where(ended & (limit[y] == both), -1, data[np.minimum(at[y] + same, len(data) - 1)].astype(np.int64))
            after = (by < bx) | ((by == bx) & ~left[open_])  # equal ones of the left run stay first
            low[open_[after]] = mid[after] + 1
            high[open_[~after]] = mid[~after]
        rank = low - np.minimum(begin, end)
        to = start[who] + (run & ~1) * width + (place[who] - run * width) + rank
        merged = order.copy()
        merged[to] = i
        order = merged
        width *= 2
    return order


def shared_strings(key: np.ndarray, ord_: np.ndarray, p: np.ndarray, lo: np.ndarray, hi: np.ndarray, body: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, first offset, last offset) of strings that an earlier stretch of the same key has too; ``key`` is sorted."""
    data = np.frombuffer(b"".join(body), np.uint8)
    size = np.fromiter(map(len, body), np.int64, len(body))
    base = np.cumsum(size) - size
    at = base + hi
    limit = LENGTH - lo
    hashes = PrefixHashes(data)
    order = _sort_groups(hashes, data, at, limit, key)
    x, y = order[:-1], order[1:]
    joined = key[x] == key[y]
    lcp = np.where(joined, hashes.extension(at[x], at[y], np.where(joined, np.minimum(limit[x], limit[y]), 0)), 0)
    # strings of one offset run from anchor - offset; marks are differences along the offsets
    marks = np.zeros((len(key), _CELLS + 1), np.int32)
    left, right, d = np.arange(len(lcp)), lcp.copy(), 1
    while True:
        keep = np.flatnonzero(joined[left] & (right > 0))
        left, right = left[keep], right[keep]
        if not len(left):
            break
        a, b = order[left], order[left + d]
        back = hashes.extension(at[a], at[b], np.minimum(hi[a], hi[b]), back=True)
        first = np.maximum(np.maximum(lo[a], lo[b]), LENGTH - right)
        last = np.minimum(np.minimum(hi[a], hi[b]), back)
        for k in np.flatnonzero(first <= last).tolist():
            i, j, f, e = int(a[k]), int(b[k]), int(first[k]), int(last[k])
            if body[i][hi[i] - e:hi[i] - f + LENGTH] != body[j][hi[j] - e:hi[j] - f + LENGTH]:  # a collision
                f, e = _measured(body[i], int(hi[i]), int(lo[i]), body[j], int(hi[j]), int(lo[j]))
                if f > e:
                    continue
            later = i if (ord_[i], p[i]) > (ord_[j], p[j]) else j
            marks[later, f] += 1
            marks[later, e + 1] -= 1
        # the right extension of neighbours d + 1 apart is the least LCP between them
        more = left + d + 1 < len(order)
        left, right = left[more], right[more]
        same = key[order[left]] == key[order[left + d + 1]]
        left, right = left[same], np.minimum(right[same], lcp[left[same] + d])
        d += 1
    covered = np.cumsum(marks, axis=1) > 0
    edge = np.diff(covered.astype(np.int8), axis=1, prepend=0)
    row, first = np.nonzero(edge == 1)
    _, after = np.nonzero(edge == -1)
    return row, first, after - 1


def _measured(x: bytes, hx: int, lx: int, y: bytes, hy: int, ly: int) -> tuple[int, int]:
    """Shared offsets (first, last) of two stretches by comparing bytes."""
    right = next((k for k in range(min(LENGTH - lx, LENGTH - ly)) if x[hx + k] != y[hy + k]), min(LENGTH - lx, LENGTH - ly))
    back = next((k for k in range(min(hx, hy)) if x[hx - k - 1] != y[hy - k - 1]), min(hx, hy))
    return max(lx, ly, LENGTH - right), min(hx, hy, back)


def _compared(groups: DataFrame) -> DataFrame:
    """Removed ranges of groups (rows of a key, each small) by suffix sorting, about 64k stretches at a time."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        key, ord_, p, lo, hi = (table.column(c).to_numpy().astype(np.int64) for c in ("key", "ord", "p", "lo", "hi"))
        # equal stretches: all but the first go whole
        _, same = np.unique(table.column("digest").combine_chunks().cast(pa.binary(16)).to_numpy(zero_copy_only=False).astype("S16"), return_inverse=True)
        order = np.lexsort((p, ord_, same))
        again = np.zeros(len(key), bool)
        again[order[1:]] = same[order[1:]] == same[order[:-1]]
        left = np.flatnonzero(~again)
        left = left[np.isin(key[left], key[left][1:][np.diff(key[left]) == 0])]  # anchors with different stretches
        row, first, last = shared_strings(key[left], ord_[left], p[left], lo[left], hi[left], table.column("body").take(pa.array(left)).to_pylist())
        gone, row = np.flatnonzero(again), left[row]
        o, b, e = _merged_ranges(np.concatenate([ord_[gone], ord_[row]]), np.concatenate([p[gone] - hi[gone], p[row] - last]), np.concatenate([p[gone] - lo[gone], p[row] - first]) + LENGTH)
        return pa.RecordBatch.from_arrays([pa.array(o), pa.array(b), pa.array(e)], ["ord", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= CHUNK:
                table = pa.Table.from_batches(held)
                key = table.column("key").to_numpy()
                whole = int(np.searchsorted(key, key[-1]))  # the last key's group may go on
                if whole:
                    yield solve(table.slice(0, whole))
                held = table.slice(whole).to_batches()
                size -= whole
        if size:
            yield solve(pa.Table.from_batches(held))

    rows = groups.select("key", "digest", "ord", "p", "lo", "hi", "body").repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(run, _REMOVED)


def _quarters(groups: DataFrame, cell: int) -> DataFrame:
    """Stretches within cells of ``cell`` offsets, keyed by the bytes that all strings of a cell contain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        for batch in batches:
            rows = []
            for o, p, lo, hi, body in zip(*(batch.column(c).to_pylist() for c in ("ord", "p", "lo", "hi", "body"))):
                for c in range(lo // cell, hi // cell + 1):
                    a, b = max(lo, c * cell), min(hi, (c + 1) * cell - 1)
                    core = body[hi - c * cell:hi - ((c + 1) * cell - 1) + LENGTH]
                    key = int.from_bytes(hashlib.blake2b(core, digest_size=8, salt=bytes((c, cell))).digest(), "little", signed=True)
                    rows.append((key, o, p, a, b, body[hi - b:hi - a + LENGTH]))
            yield from _collapsed(rows, seen)

    return groups.select("ord", "p", "lo", "hi", "body").mapInArrow(run, _STRETCH)


def _firsts(rows: DataFrame) -> DataFrame:
    """Stretches (without bytes) with ``first``: if it is the first of its key and digest, over all tasks. Copies lose their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            digest = batch.column("digest").cast(pa.binary(16))
            told = np.empty((batch.num_rows, 3), np.uint64)
            told[:, 0] = batch.column("key").to_numpy().view(np.uint64)
            told[:, 1:] = np.frombuffer(digest.buffers()[1], np.uint64)[2 * digest.offset:2 * (digest.offset + len(digest))].reshape(-1, 2)
            new = np.ones(len(told), bool)
            new[1:] = (told[1:] != told[:-1]).any(axis=1)
            new[0] = last is None or (told[0] != last).any()
            last = told[-1].copy()
            yield pa.RecordBatch.from_arrays([pa.array(told[:, 0].view(np.int64), mask=~new), *[batch.column(c) for c in ("ord", "p", "lo", "hi")], pa.array(new)],
                                             ["key", "ord", "p", "lo", "hi", "first"])

    dealt = rows.select("key", "digest", "ord", "p", "lo", "hi").repartition("key").sortWithinPartitions("key", "digest", "ord", "p")
    return dealt.mapInArrow(run, "key long, ord long, p long, lo int, hi int, first boolean")


def _upper(keys: DataFrame) -> np.ndarray:
    """The upper 4 bytes of keys, sorted: for filters in tasks (another key with these bytes does no harm)."""
    upper = keys.select(F.shiftrightunsigned("key", 32).alias("u")).distinct().toArrow().column("u").to_numpy()
    return np.sort(upper.astype(np.uint32))


def _of_keys(rows: DataFrame, keys: DataFrame, n: int, among: int) -> DataFrame:
    """Rows with a key in ``keys(key)``, which has n: filtered in their tasks, or joined where the keys are too many."""
    if n > among:
        return rows.join(keys.select(F.col("key").alias("_key")), F.col("key") == F.col("_key"), "left_semi")
    upper = _upper(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = (batch.column("key").to_numpy().view(np.uint64) >> np.uint64(32)).astype(np.uint32)
            yield batch.filter(pa.array(upper[np.minimum(np.searchsorted(upper, own), len(upper) - 1)] == own))

    return rows.mapInArrow(run, rows.schema)


def _resolve(spark: SparkSession, cut: DataFrame, cell: int, group: int, among: int) -> list[DataFrame]:
    """Removed ranges of stretches whose strings meet only under equal keys."""
    cut = stage(spark, cut, "stretches")
    whole = [F.col("ord"), (F.col("p") - F.col("hi")).alias("begin"), (F.col("p") - F.col("lo") + LENGTH).alias("end")]
    rows = cut.where("key is not null")
    parted = stage(spark, _firsts(rows), "firsts")
    removed = [cut.where("key is null").select(*whole), parted.where("not first").select(*whole)]
    firsts = parted.where("first").select(F.col("key").alias("_key"), F.col("ord").alias("_ord"), F.col("p").alias("_p"), F.col("lo").alias("_lo"))
    several = stage(spark, firsts.groupBy(F.col("_key").alias("key")).agg(F.count("*").alias("n")).where("n > 1"), "several")
    n = several.count()
    if not n:
        return removed
    same = (F.col("key") == F.col("_key")) & (F.col("ord") == F.col("_ord")) & (F.col("p") == F.col("_p")) & (F.col("lo") == F.col("_lo"))
    different = _of_keys(rows, several, n, among).join(firsts, same, "left_semi")
    large = several.where(F.col("n") > group).select(F.col("key").alias("_large"))
    if cell == 1 or large.isEmpty():
        return [*removed, _compared(different)]
    different = stage(spark, different, "different")
    of_large = F.col("key") == F.col("_large")
    removed.append(_compared(different.join(large, of_large, "left_anti")))
    smaller = -(-cell // 4)
    return removed + _resolve(spark, _quarters(different.join(large, of_large, "left_semi"), smaller), smaller, group, among)


def repeated_ranges(spark: SparkSession, docs: DataFrame, among: int = AMONG, group: int = GROUP) -> DataFrame:
    """(ord, begin, end) of byte ranges to remove from ``docs(ord, text)``; ``ord`` is unique and orders documents."""
    repeated = stage(spark, _anchor_counts(docs).where("n > 1").select("key"), "repeated")
    cut = _cut(docs, _upper(repeated)) if repeated.count() <= among else _cut_joined(docs, repeated)
    out, *more = _resolve(spark, cut, _CELLS, group, among)
    for part in more:
        out = out.unionByName(part)
    return out


def ordered_documents(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, copies_alike: bool = False) -> DataFrame:
    """(ord, doc_id, text): ``ord`` is the id itself where ids are unique and not NULL, else a rank by (id, text hash).

    ``copies_alike``: rows of the same id and text become one row, with their number in the further column ``copies``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    odd = rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        return rows.select(F.col("doc_id").alias("ord"), "doc_id", "text")
    if copies_alike:
        rows = rows.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    by = F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("text")
    ranked = rows.repartitionByRange(*by[:2]).sortWithinPartitions(*by).withColumn("ord", F.monotonically_increasing_id())
    return stage(spark, ranked.select("ord", *rows.columns), "ordered")


def without_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", among: int = AMONG, group: int = GROUP,
                    copies_alike: bool = False) -> DataFrame:
    """One row per document: doc_id, kept (the remaining bytes), spans (array of removed begin / end), n_bytes."""
    rows = ordered_documents(spark, docs, id_col, text_col, copies_alike)
    extra = [c for c in rows.columns if c == "copies"]
    with small_batches(spark):
        spans = repeated_ranges(spark, rows.select("ord", "text"), among, group)
        # the ranges of a document are bounded by its length
        by_doc = spans.groupBy(F.col("ord").alias("_ord")).agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))
        by_doc = stage(spark, by_doc, "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            data, at = _bytes_of(filled(part, "text"))
            kept, merged = [], []
            for i, found in enumerate(part.column("spans").to_pylist()):
                raw, runs = data[at[i]:at[i + 1]].tobytes(), []
                for s in found or ():
                    if runs and s["begin"] <= runs[-1]["end"]:
                        runs[-1]["end"] = max(runs[-1]["end"], s["end"])
                    else:
                        runs.append({"begin": s["begin"], "end": s["end"]})
                edges = [0, *(e for s in runs for e in (s["begin"], s["end"])), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                merged.append(runs)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(kept, pa.binary()), pa.array(merged, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), pa.array(np.diff(at)),
                 *[part.column(c) for c in extra]],
                ["doc_id", "kept", "spans", "n_bytes", *extra])

    joined = rows.join(by_doc, F.col("ord") == F.col("_ord"), "left").select("doc_id", "text", "spans", *extra)
    told = joined.mapInArrow(run, "doc_id long, kept binary, spans array<struct<begin: long, end: long>>, n_bytes long" + "".join(f", {c} long" for c in extra))
    return told.select("*", F.explode(F.sequence(F.lit(1), "copies"))).select("doc_id", "kept", "spans", "n_bytes") if extra else told


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # by the contract a string starts earlier in a smaller doc_id or at an earlier start: not in another row of the same id and text
    found = without_repeats(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), copies_alike=True)
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
