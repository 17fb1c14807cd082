"""Document fingerprints: one-permutation MinHash with optimal densification,
packed to the low-order bits of each bin's minimum.

Every shingle is hashed once; the high bits choose its bin and the low bits
compete in it.  An empty bin takes the value of the first non-empty bin in a
fixed random sequence of its own, so equal bins stay as likely as the sets'
Jaccard similarity.  The likeness of two fingerprints corrects the share of equal
low-order bits for chance agreement.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, ordered_shards, scan_tasks, split_points, text_slices
from .words import mixed, shingle_sets

BINS, BITS = 512, 4
#: Random probes of an empty bin before its fixed full order of bins is used.
PROBES = 24


class Fingerprinter:
    """``bins`` is a power of two and ``bits`` divides 8."""

    def __init__(self, bins: int = BINS, bits: int = BITS, seed: int = 5):
        self.bins, self.bits = bins, bits
        self.salt = mixed(np.array([seed], np.uint64) + np.uint64(1))[0]
        self.bin_salt = mixed(np.arange(bins, dtype=np.uint64) ^ self.salt)
        self.shift = np.uint64(64 - (bins.bit_length() - 1))
        grid = (np.arange(bins, dtype=np.uint64)[None, :] << np.uint64(32)) + np.arange(PROBES, dtype=np.uint64)[:, None]
        self.probe = (mixed(grid ^ self.salt) >> self.shift).astype(np.int64)

    def values(self, shingles: np.ndarray) -> np.ndarray | None:
        """The low-order bits of each bin, or None for an empty set."""
        if not len(shingles):
            return None
        h = np.sort(mixed(shingles ^ self.salt))
        place = (h >> self.shift).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        least = np.zeros(self.bins, np.uint64)
        full = np.zeros(self.bins, bool)
        least[place[first]] = h[first]
        full[place[first]] = True
        source = np.arange(self.bins)
        empty = np.flatnonzero(~full)
        for row in self.probe:
            if not len(empty):
                break
            at = row[empty]
            hit = full[at]
            source[empty[hit]] = at[hit]
            empty = empty[~hit]
        if len(empty):
            have = np.flatnonzero(full).astype(np.uint64)
            rank = mixed((empty.astype(np.uint64)[:, None] << np.uint64(20)) ^ have[None, :] ^ self.salt)
            source[empty] = have[np.argmin(rank, axis=1)].astype(np.int64)
        # A bin's own salt keeps chance agreement independent between bins that hold
        # the same minimum.
        return (mixed(least[source] ^ self.bin_salt) & np.uint64((1 << self.bits) - 1)).astype(np.uint8)

    def packed(self, values: np.ndarray | None) -> str:
        """Lowercase hexadecimal text; an empty set has the empty fingerprint."""
        if values is None:
            return ""
        per = 8 // self.bits
        out = np.zeros(self.bins // per, np.uint8)
        for k in range(per):
            out |= values[k::per] << (self.bits * k)
        return out.tobytes().hex()

    def unpacked(self, text: str) -> np.ndarray | None:
        if not text:
            return None
        raw = np.frombuffer(bytes.fromhex(text), np.uint8)
        per = 8 // self.bits
        out = np.empty(self.bins, np.uint8)
        for k in range(per):
            out[k::per] = (raw >> (self.bits * k)) & ((1 << self.bits) - 1)
        return out

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        """Estimated Jaccard similarity: 1 for two empty sets, 0 for one."""
        if a is None or b is None:
            return float(a is None and b is None)
        chance = 2.0 ** -self.bits
        return float(min(1.0, max(0.0, (np.mean(a == b) - chance) / (1 - chance))))


def fingerprint(documents: DataFrame, bins: int = BINS, bits: int = BITS, seed: int = 5) -> DataFrame:
    """``doc_id, fingerprint`` of every row's five-word shingles, without a shuffle.

    Null and wordless texts have the empty fingerprint; repeated rows repeat; null
    ids stay null; other columns are not read.
    """
    maker = Fingerprinter(bins, bits, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([maker.packed(maker.values(s)) for s in sets], pa.string())],
                ["doc_id", "fingerprint"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the start of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


PAIR_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
               "edited_fingerprint string, near_edited double, near_next double")


def fingerprint_edits(documents: DataFrame, bins: int = BINS, bits: int = BITS, seed: int = 5) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and
    the likeness to the next document (ascending ``doc_id``; after the last the
    first).

    Null texts count as empty; a null id sorts first; rows that share an id follow
    each other by text; an empty table gives no rows; a single row is its own next.
    Texts are dealt once into ranges of ids, and the row that starts a range is
    copied to the end of the one before.
    """
    docs = documents.select("doc_id", "text")
    points = split_points(docs, "doc_id", 2 * scan_tasks(docs))
    first = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text").orderBy(
        "doc_id", F.coalesce("text", F.lit(""))).limit(1).collect()
    head = (first[0].text or "") if first else ""
    maker = Fingerprinter(bins, bits, seed)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256
        last = None  # the row that waits for its next: shard, id, text, fingerprint

        def batch_of(pairs):
            texts = [edited(row[2], after[2]) for row, after in pairs]
            prints = [maker.values(x) for x in shingle_sets(pa.array(texts, pa.string()))]
            columns = [[None if row[1] == NULL_ID else row[1] for row, _ in pairs],
                       [len(row[2]) for row, _ in pairs],
                       [sha256(t.encode()).hexdigest() for t in texts],
                       [maker.packed(row[3]) for row, _ in pairs], [maker.packed(x) for x in prints],
                       [maker.likeness(row[3], x) for (row, _), x in zip(pairs, prints)],
                       [maker.likeness(row[3], after[3]) for row, after in pairs]]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in text_slices(batches, 2 << 20):
            pairs = []
            sets = shingle_sets(batch.column("text"))
            for shard, doc, text, ahead, shingles in zip(
                    batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist(),
                    batch.column("text").to_pylist(), batch.column("ahead").to_pylist(), sets):
                row = (shard, doc, text or "", maker.values(shingles))
                if last is not None and last[0] == shard:
                    pairs.append((last, row))
                    last = None
                if not ahead:
                    last = row
            yield batch_of(pairs)
        if last is not None:  # only the last shard has nothing ahead
            yield batch_of([(last, (0, 0, head, maker.values(shingle_sets(pa.array([head]))[0])))])

    rows = ordered_shards(docs, points, ["doc_id", "text"],
                          ["ahead", F.coalesce("text", F.lit(""))], look_ahead=True)
    return rows.mapInArrow(run, PAIR_SCHEMA)
