"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared by letters and digits, lower-cased, with every run of other
characters as one blank.  Stretches of ``FRAGMENT`` characters of a benchmark item,
with step 1 wherever they start, are its fragments.  A fragment of ``w`` characters that occurs in a
document with at most ``e`` edits shares ``w - q + 1 - q * e`` of its q-grams with the
document, all of them within ``e`` diagonals of each other.  Shared q-grams are
counted in diagonal bands that overlap by half, so that one band holds them all; in
each band a window slides over the item, and the fragments that reach the bound are
verified by an alignment inside the band, all of a batch at a time.

Items of fewer than ``LEAST`` characters have no edit budget: they are found where they
stand whole and unchanged between other words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import text_slices

Q = 9
FRAGMENT = 60
#: Edits allowed in a fragment, as a share of its characters.
EDITS = 0.085
#: Items of fewer characters are found only as they are.
LEAST = 25
#: Characters of the benchmark in one block; each block is one pass over the documents.
BLOCK_CHARS = 4 << 20
#: Shared q-grams looked at together; a text that repeats an item's q-grams is taken in stretches.
PAIRS = 1 << 21
#: Fragments aligned together.
ALIGNED = 4096
BLANK, BORDER = 32, 1
TABLE_BITS = 22
_STEP = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """Letters and digits of the basic plane in lower case, all else blank."""
    out = np.full(1 << 16, BLANK, np.uint16)
    for code in range(1 << 16):
        char = chr(code)
        if char.isalnum():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def normalized(texts: list[str], border: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts end to end with ``border`` marks after each; where each kept character
    was; and where each text begins.  Characters beyond the basic plane are letters
    that keep their low 16 bits."""
    joined = "".join([t + "\x00" * border for t in texts]).encode("utf-32-le", "surrogatepass")
    code = np.frombuffer(joined, "<u4")
    folded = _fold()[np.minimum(code, 0xFFFF)]
    high = np.flatnonzero(code > 0xFFFF)
    folded[high] = np.maximum(code[high] & 0xFFFF, BLANK + 1)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate(([0], np.cumsum(size + border)[:-1])) if texts else size
    for k in range(border):
        folded[begin + size + k] = BORDER
    blank = folded == BLANK
    keep = ~blank
    keep[1:] |= blank[1:] & (folded[:-1] > BLANK)  # the first blank after a letter
    at = np.flatnonzero(keep)
    return folded[at], at, np.searchsorted(at, begin)


def grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``Q`` characters in a row, from hashes of powers of two."""
    part, width, done, out, left = codes.astype(np.uint64), 1, 0, None, Q
    if len(part) < Q:
        return part[:0]
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                out = part if out is None else part[:len(out) - width] * _STEP ** np.uint64(done) + out[width:]
                done += width
            left >>= 1
            if left:
                part = part[:-width] * _STEP ** np.uint64(width) + part[width:]
                width *= 2
        return out[:len(codes) - Q + 1] * np.uint64(0xBF58476D1CE4E5B9)


class Fragments:
    """The q-grams of a block of benchmark items; a fragment starts at every ``step``-th
    character and at the last place."""

    def __init__(self, items: list[Row], step: int = 1):
        self.step, self.item, codes = step, [], []
        self.short: dict[int, list[tuple[int, np.ndarray]]] = {}
        for row in items:
            own = normalized([row.text or ""], 0)[0]
            while len(own) and own[-1] == BLANK:
                own = own[:-1]
            while len(own) and own[0] == BLANK:
                own = own[1:]
            if len(own) >= LEAST:
                self.item.append(row.item_id)
                codes.append(own)
            elif len(own):
                self.short.setdefault(min(len(own), Q), []).append((row.item_id, own))
        self.long = np.array([len(c) for c in codes], np.int64)
        self.first = np.cumsum(self.long) - self.long
        self.flat = np.concatenate(codes) if codes else np.empty(0, np.uint16)
        self.size = np.minimum(self.long, FRAGMENT)
        # the lemma's bound has to be 1 at least, so 25 and 26 characters have one edit, not two
        self.edits = np.minimum(np.floor(self.size * EDITS).astype(np.int64), (self.size - Q) // Q)
        self.bound = self.size - Q + 1 - Q * self.edits
        every = [grams(c) for c in codes]
        keys = np.concatenate(every) if every else np.empty(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.key, start = np.unique(keys[order], return_index=True)
        self.begin = np.append(start, len(keys))
        self.owner = np.repeat(np.arange(len(every)), [len(e) for e in every])[order]
        self.place = np.concatenate([np.arange(len(e)) for e in every])[order] if every else order
        self.seen = np.zeros(1 << TABLE_BITS, bool)
        self.seen[(self.key >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def shared(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the text has a q-gram of an item, and which of them."""
        g = grams(codes)
        at = np.flatnonzero(self.seen[(g >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        if not len(at) or not len(self.key):
            return at[:0], at[:0]
        known = np.searchsorted(self.key, g[at])
        known[known == len(self.key)] = 0
        hit = self.key[known] == g[at]
        return at[hit], known[hit]

    def bands(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item and start of each fragment that reaches its bound in a band, and the band's
        lowest diagonal.  A text with more shared q-grams than ``PAIRS`` is looked at in
        stretches that overlap by the longest passage a fragment can match."""
        at, known = self.shared(codes)
        times = self.begin[known + 1] - self.begin[known]
        upto = np.cumsum(times)
        if not len(at):
            return at, at, at
        reach, parts, a = FRAGMENT + 2 * int(self.edits.max()) + 2, [], 0
        while a < len(at):
            b = max(int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, side="right")), a + 1)
            # a stretch has to hold more than the overlap, or the next would not move on
            b = max(b, int(np.searchsorted(at, at[a] + 2 * reach, side="right")))
            parts.append(self._bands(len(codes), at[a:b], known[a:b], times[a:b]))
            if b >= len(at):
                break
            a = int(np.searchsorted(at, at[b] - reach))
        if len(parts) == 1:
            return parts[0]
        item, start, low = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((low, start, item))
        item, start, low = item[order], start[order], low[order]
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (start[1:] != start[:-1]) | (low[1:] != low[:-1])
        return item[new], start[new], low[new]

    def _bands(self, size: int, at: np.ndarray, known: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.repeat(self.begin[known] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        item, place = self.owner[rows], self.place[rows]
        reach = int(self.long.max()) + 1
        count = size + reach + 2
        band = (np.repeat(at, times) - place) // (self.edits[item] + 1)
        key = item * count + band + reach
        # A shared q-gram of a document counts once for each place in the item.
        key, place = np.concatenate([key, key - 1]), np.concatenate([place, place])
        distinct, which, number = np.unique(key, return_inverse=True, return_counts=True)
        enough = (number >= self.bound[distinct // count])[which]
        key, place = key[enough], place[enough]
        order = np.lexsort((place, key))
        key, place = key[order], place[order]
        item = key // count
        last = np.arange(len(key)) + self.bound[item] - 1
        inside = last < len(key)
        last[~inside] = 0
        span = self.size[item] - Q
        inside &= (key[last] == key) & (place[last] - place <= span)
        key, item, low, high = (x[inside] for x in (key, item, place[last] - span, place))
        low, high = np.maximum(low, 0), np.minimum(high, (self.long - self.size)[item])
        again = np.flatnonzero(key[1:] == key[:-1]) + 1
        low[again] = np.maximum(low[again], high[again - 1] + 1)  # both ascend within a band
        times = np.maximum(high - low + 1, 0)
        start = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
        key, item = np.repeat(key, times), np.repeat(item, times)
        good = (start % self.step == 0) | (start == (self.long - self.size)[item])
        key, item, start = key[good], item[good], start[good]
        return item, start, (key % count - reach) * (self.edits[item] + 1)

    def verified(self, codes: np.ndarray, item: np.ndarray, start: np.ndarray,
                 low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits of each fragment against any stretch inside its band, and where
        the stretch ends; all bands advance together, a fragment character at a time.  A row
        of the arrays is a diagonal, so every step is a few sweeps over small numbers."""
        edits, end = np.empty(len(item), np.int64), np.empty(len(item), np.int64)
        for size in np.unique(self.size[item]):
            same = np.flatnonzero(self.size[item] == size)
            for some in np.array_split(same, -(-len(same) // ALIGNED)):
                e = int(self.edits[item[some[0]]])
                width = 2 * (e + 1) + 2 * e
                pattern = self.flat[(self.first[item[some]] + start[some])[None, :] + np.arange(size)[:, None]]
                first = low[some] + start[some] - e
                place = first[None, :] + np.arange(size + width)[:, None]
                text = codes[np.clip(place, 0, len(codes) - 1)]
                text[(place < 0) | (place >= len(codes))] = BORDER
                cost = np.zeros((width, len(some)), np.int8)
                for i in range(size):
                    turn = cost + (text[i:i + width] != pattern[i])
                    np.minimum(turn[:-1], cost[1:] + np.int8(1), out=turn[:-1])
                    far = 1
                    while far < width:  # characters of the text left out, 1, 2, 4, ... at a time
                        np.minimum(turn[far:], turn[:-far] + np.int8(far), out=turn[far:])
                        far *= 2
                    cost = turn
                best = np.argmin(cost, axis=0)
                edits[some] = cost[best, np.arange(len(some))]
                end[some] = first + best + size
        return edits, end

    def whole(self, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Item, start and end of each short item that stands in the texts as it is."""
        border = codes <= BLANK
        for width, items in self.short.items():
            if len(codes) < width:
                continue
            head = np.lib.stride_tricks.sliding_window_view(codes, width)
            # items that begin alike are looked for together
            by_head: dict[bytes, list] = {}
            for item_id, own in items:
                by_head.setdefault(own[:width].tobytes(), []).append((item_id, own))
            for first in {own[0] for _, own in items}:
                at = np.flatnonzero((codes[:len(head)] == first) & np.append(True, border[:-1])[:len(head)])
                for p in at.tolist():
                    for item_id, own in by_head.get(head[p].tobytes(), ()):
                        stop = p + len(own)
                        if stop <= len(codes) and (codes[p:stop] == own).all() and (stop == len(codes) or border[stop]):
                            yield item_id, p, stop

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int, int, int, int]]:
        """``text, item number, fragments, edits, start, end`` of each text and item with a
        fragment inside its edit budget; start and end are offsets in the text, the start
        right up to the edits."""
        if not self.item and not self.short:
            return []
        border = int(self.edits.max(initial=0)) + 1
        codes, at, begin = normalized(texts, border)
        found: dict[tuple, dict[tuple, tuple[int, int, int]]] = {}
        item, first, low = self.bands(codes)
        if len(item):
            edits, end = self.verified(codes, item, first, low)
            good = edits <= self.edits[item]
            item, first, edits, end = item[good], first[good], edits[good], end[good]
            text = np.searchsorted(begin, end - 1, side="right") - 1
            for t, k, a, cost, stop in zip(text.tolist(), item.tolist(), first.tolist(), edits.tolist(), end.tolist()):
                start = max(stop - int(self.size[k]), int(begin[t]))
                place = found.setdefault((t, self.item[k]), {})
                place[k, a] = min(place.get((k, a), (cost, start, stop)), (cost, start, stop))
        for item_id, start, stop in self.whole(codes):
            t = int(np.searchsorted(begin, start, side="right")) - 1
            found.setdefault((t, item_id), {})[-1, start] = (0, start, stop)
        out = []
        size = np.array([len(t) + border for t in texts], np.int64)
        offset = np.cumsum(size) - size
        for (text, item_id), place in found.items():
            a, b = min(p[1] for p in place.values()), max(p[2] for p in place.values())
            out.append((text, item_id, len(place), min(p[0] for p in place.values()),
                        int(at[a] - offset[text]), int(at[b - 1] - offset[text]) + 1))
        return out


def benchmark_blocks(benchmark: DataFrame) -> Iterator[list[Row]]:
    """The items in blocks of about ``BLOCK_CHARS`` characters."""
    rows = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS)
    for k in range(blocks):
        yield rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()


LEAK_SCHEMA = "doc_id long, item_id long, fragments int, edits int, start long, end long"


def find_leaks(documents: DataFrame, benchmark: DataFrame, step: int = FRAGMENT // 2) -> DataFrame:
    """A row for each row of ``documents`` and benchmark item of which a fragment occurs in
    it within the edit budget: ``doc_id, item_id, fragments`` (how many), ``edits`` (the
    fewest) and the hull ``start, end`` of the matches in the text.

    Fragments start at every ``step``-th character of an item.  With 1, as the query and
    the pipeline search, each passage of ``FRAGMENT`` characters within ``EDITS`` is found
    wherever it starts; with more, one of ``FRAGMENT + step - 1`` characters is sure.
    Shorter passages of a longer item are not looked for; items shorter than that are one
    fragment, and those under ``LEAST`` characters are found unchanged between other words
    (each place counts as a fragment).
    Whole texts are searched where they lie, without a shuffle.  Null and empty texts
    and items hold nothing; repeated rows and items repeat; null ids stay null; an
    empty table on either side gives no rows; other columns are not read.
    """
    spark = documents.sparkSession
    out = spark.createDataFrame([], LEAK_SCHEMA)
    for items in benchmark_blocks(benchmark):
        shared = spark.sparkContext.broadcast(Fragments(items, step))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, 4 << 20):
                ids = batch.column("doc_id").to_pylist()
                found = shared.value.leaks([t or "" for t in batch.column("text").to_pylist()])
                rows = [(ids[f[0]], *f[1:]) for f in found]
                columns = list(zip(*rows)) if rows else [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["doc_id", "item_id", "fragments", "edits", "start", "end"])

        out = out.unionByName(documents.select("doc_id", "text").mapInArrow(run, LEAK_SCHEMA))
    return out


def without_leaks(documents: DataFrame, benchmark: DataFrame, step: int = FRAGMENT // 2) -> DataFrame:
    """The rows of ``documents`` that hold no fragment of any item, with all columns;
    ``step`` as in ``find_leaks``."""
    spark = documents.sparkSession
    for items in benchmark_blocks(benchmark):
        shared = spark.sparkContext.broadcast(Fragments(items, step))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, 4 << 20):
                clean = np.ones(batch.num_rows, bool)
                clean[[f[0] for f in shared.value.leaks([t or "" for t in batch.column("text").to_pylist()])]] = False
                yield batch.filter(pa.array(clean))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
