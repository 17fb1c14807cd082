"""Toxicity by the nearest labelled examples.

Examples are a bounded sample of labelled rows; all their words span the space.  A vector
is TF-IDF with a weight for each of three kinds of terms: the telling terms (words, and
beginnings of words, that occur more often in toxic examples) count relative to the text's
length, so that their density stands against one dimension of fixed weight, and all other
words keep their TF-IDF weights at a fixed norm, to which words that no example holds
contribute as well.  Document frequencies are counted over all documents.

The exact nearest examples by cosine come from an inverted index whose examples lie in
blocks of similar ones.  Postings of the rarer terms are added up; for the most frequent
terms, whose postings are dense, the greatest weight in each block bounds what a block can
still add, and blocks that cannot reach the neighbours found so far are never opened.
Neighbours vote with a weight that falls with their distance, and isotonic regression on
the examples' own votes (each without itself) turns votes into probabilities.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ARROW_BYTES, forget, list_array, saved, settings, text_slices

#: At most so many labelled rows are examples; more are thinned by a hash of their id.
EXAMPLES = 12_000
#: Longer texts (in bytes) are no examples; they are scored like all others.
LONGEST = 200_000
#: At most so many terms are telling, those of the strongest evidence.
TERMS = 1024
#: A term's least evidence: the signed log-likelihood ratio of its counts in toxic
#: and other examples.
EVIDENCE = 20.0
#: How many times the odds of a toxic example a term must raise.
ODDS = 4.0
NEIGHBOURS = 25
#: The terms of most examples, whose weights are kept dense and bounded by blocks.
FREQUENT = 256
#: Examples in a block, and blocks opened first to find how near neighbours are.
BLOCK = 64
FIRST = 4
#: Texts compared with the examples at a time.
TOGETHER = 128
#: Postings of so many examples or more are copied as they lie; the shorter ones of several
#: texts, about ``GATHERED`` entries with the texts' sums, are gathered at once.
LONG = 128
GATHERED = 1 << 18
#: An example's place among the blocks and a term's weight in it, held as one 64-bit number.
POSTING = np.dtype([("place", np.int32), ("weight", np.float32)])
#: Lengths of the beginnings of words that are terms besides whole words, shortest first.
STEMS = (4, 5, 6, 7)
#: Weight of the rest of a text, where a term that makes up 1 % of it weighs its idf.
REST = 5.0
#: Norm of the TF-IDF vector of the words that are not telling.
OTHERS = 5.0
#: A neighbour's vote weighs ``1 / (NEAR + 1 - cosine)``.
NEAR = 0.02
#: Weight with which the examples' overall rate joins each vote.
PRIOR = 1.0
#: Words that are no terms but begin like some that a task remembers the terms of before it
#: starts anew, and bytes of text whose words are counted at a time.
REMEMBERED = 200_000
SLICE = 1 << 20
#: Bytes of rows that a task gets at a time, and rows of ``term_counts`` scored at a time.
BATCH = "2m"
SCORED = 8 * TOGETHER
THRESHOLD = 0.7
TERM = re.compile(r"\w+")
#: What ``TERM`` and lower case make of each byte of a text of ASCII: a space parts words.
PARTED = bytes(ord(c.lower()) if TERM.match(c) and c.isascii() else 32 for c in map(chr, range(256)))


def held_out(doc_id: str = "doc_id"):
    """The rows whose labels are never learned from; a null id is none of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def example_rows(documents: DataFrame, labels: DataFrame, most: int = EXAMPLES, seed: int = 11) -> DataFrame:
    """``example`` (an id), ``text``, ``toxic`` (0 or 1): one row for each distinct text of
    the sample, labelled by the majority of its rows; texts with a tie are left out."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.avg("toxic").alias("mean")).filter("mean <> 0.5"))
    share = most / max(1, known.count())
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    chosen = (known.withColumn("place", place).filter(F.col("place") < F.lit(share))
              .orderBy("place", "doc_id").limit(most).select("doc_id", (F.col("mean") > 0.5).cast("int").alias("toxic")))
    found = (documents.filter(F.octet_length(F.coalesce("text", F.lit(""))) <= LONGEST).select("doc_id", "text")
             .join(F.broadcast(chosen), "doc_id")
             .groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("toxic").alias("toxic")))
    return (found.groupBy("text").agg(F.min("doc_id").alias("example"), F.avg("toxic").alias("mean"))
            .filter("mean <> 0.5").select("example", "text", (F.col("mean") > 0.5).cast("int").alias("toxic")))


def term_sums(examples: DataFrame) -> DataFrame:
    """``term``, ``n`` and ``a``: in how many examples, and toxic ones, each word occurs, and
    ``len(STEMS)`` times in how many each beginning of a word.  How long a beginning is comes
    from its word's place in the text, not from ``STEMS`` (see the README).  A slice of texts
    is counted where it is read, so that no row is made for each word of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE):
            n, a = Counter(), Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = list(dict.fromkeys(words_of(text)))
                long = [w for i, w in enumerate(words) if len(w) > i]
                held = dict.fromkeys(words, 1) | {w[:i] + "*": len(STEMS) for i, w in enumerate(long)}
                n.update(held)
                if toxic:
                    a.update(held)
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([a[t] for t in n], pa.int64()),
                                              pa.array(list(n.values()), pa.int64())], ["term", "a", "n"])

    return (examples.select("toxic", "text").mapInArrow(run, "term string, a long, n long")
            .groupBy("term").agg(F.sum("a").alias("a"), F.sum("n").alias("n")))


def telling_terms(examples: DataFrame, most: int = TERMS, least: float = EVIDENCE, odds: float = ODDS) -> list[str]:
    """The terms that speak for toxicity most, by log-likelihood ratio, among those
    that raise its odds enough."""
    totals = examples.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not totals.t or totals.t == totals.n:
        return []
    counts = term_sums(examples).filter("n > 2")
    rate = totals.t / totals.n
    a, b = F.col("a"), F.col("n") - F.col("a")
    other_a, other_b = totals.t - a, totals.n - totals.t - b

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    n, rest = F.col("n"), totals.n - F.col("n")
    ratio = 2 * (part(a, n * rate) + part(b, n * (1 - rate)) + part(other_a, rest * rate) + part(other_b, rest * (1 - rate)))
    raised = a * (totals.n - totals.t) >= odds * b * totals.t
    best = (counts.withColumn("ratio", ratio).filter(raised & (F.col("ratio") >= least))
            .orderBy(F.desc("ratio"), "term").limit(most))
    return [r.term for r in best.collect()]


def other_words(examples: DataFrame, telling: list[str]) -> list[str]:
    """Every word of the examples that is not a telling term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            words = {w for t in batch.column("text").to_pylist() for w in TERM.findall((t or "").lower())}
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string())], ["word"])

    words = examples.select("text").mapInArrow(run, "word string").distinct().toArrow().column("word").to_pylist()
    return sorted(set(words).difference(telling))


class Numbered(dict):
    """The terms and their numbers, and the terms that each word holds: its own and those of
    its beginnings.  A word that is no term itself is ``strange``: it is numbered when it is
    found if it holds terms, and any other has the one number after the terms' own."""

    def __init__(self, terms: list[str]):
        super().__init__(zip(terms, range(len(terms))))
        self.count = len(terms)
        self.stems = {t[:-1]: i for i, t in enumerate(terms) if t.endswith("*")}
        self.heads = {t[:STEMS[0]] for t in self.stems}
        more = [(i, held) for i, t in enumerate(terms) if t[:STEMS[0]] in self.heads and (held := self.begun(t))]
        each = np.append(np.ones(self.count, np.int64), 0)
        each[[i for i, _ in more]] += np.array([len(held) for _, held in more], np.int64)
        begin = np.concatenate(([0], np.cumsum(each)))
        own = np.empty(begin[-1], np.int64)
        own[begin[:self.count]] = np.arange(self.count)
        for i, held in more:
            own[begin[i] + 1:begin[i + 1]] = held
        self.begin, self.terms = array("q", begin.tobytes()), array("q", own.tobytes())
        self.strange = array("b", bytes(self.count) + b"\1")

    def begun(self, word: str) -> list[int]:
        return [self.stems[n] for k in STEMS if len(word) > k and (n := word[:k]) in self.stems]

    def __missing__(self, word: str) -> int:
        if word[:STEMS[0]] not in self.heads or not (held := self.begun(word)):
            return self.count
        self.terms.extend(held)
        self.begin.append(len(self.terms))
        self.strange.append(True)
        self[word] = number = len(self.strange) - 1
        return number

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Views; they have to be gone when the next word is numbered."""
        return np.frombuffer(self.begin, np.int64), np.frombuffer(self.terms, np.int64), np.frombuffer(self.strange, bool)


@dataclass
class Counts:
    """Rows of ``term_counts`` end to end: row i holds ``terms[cut[i]:cut[i + 1]]``."""
    words: np.ndarray
    unknown: np.ndarray
    cut: np.ndarray
    terms: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table) -> "Counts":
        terms, counts = (batch.column(c).combine_chunks() if isinstance(batch, pa.Table) else batch.column(c) for c in ("terms", "counts"))
        sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
        return cls(batch.column("words").to_numpy(), batch.column("unknown").to_numpy(), np.concatenate(([0], np.cumsum(sizes))),
                   terms.flatten().to_numpy(zero_copy_only=False), counts.flatten().to_numpy(zero_copy_only=False))

    @classmethod
    def listed(cls, rows: list) -> "Counts":
        flat = [np.concatenate([np.empty(0, np.int64), *(np.asarray(getattr(r, c), np.int64) for r in rows)]) for c in ("terms", "counts")]
        return cls(np.array([r.words for r in rows], np.int64), np.array([getattr(r, "unknown", 0.0) for r in rows], float),
                   np.concatenate(([0], np.cumsum([len(r.terms) for r in rows], dtype=np.int64))).astype(np.int64), *flat)

    def rows(self, at: np.ndarray) -> "Counts":
        sizes = (self.cut[1:] - self.cut[:-1])[at]
        ends = np.cumsum(sizes)
        flat = np.repeat(self.cut[at] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return Counts(self.words[at], self.unknown[at], np.concatenate(([0], ends)), self.terms[flat], self.counts[flat])


def words_of(text: str | None) -> list[str]:
    """``TERM`` of the lower-cased text."""
    text = text or ""
    return text.encode().translate(PARTED).decode().split() if text.isascii() else TERM.findall(text.lower())


def count_terms(texts: list, numbered: Numbered) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For whole texts: their numbers of words, the squared counts of strange words, how
    many terms each holds, and the terms (ascending in a text) and their counts."""
    found = [Counter(words_of(t)) for t in texts]
    text = np.repeat(np.arange(len(texts)), [len(words) for words in found])
    word = np.fromiter(map(numbered.__getitem__, chain.from_iterable(found)), np.int64, len(text))
    times = np.fromiter(chain.from_iterable(words.values() for words in found), np.int64, len(text))
    begin, terms, strange = numbered.arrays()
    top = max(1, numbered.count)
    size = np.bincount(text, times, minlength=len(texts)).astype(np.int64)
    unknown = np.bincount(text, np.where(strange[word], times.astype(float) ** 2, 0.0), minlength=len(texts))
    each = begin[word + 1] - begin[word]
    ends = np.cumsum(each)
    at = np.repeat(begin[word] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
    pairs, times = np.repeat(text, each) * top + terms[at], np.repeat(times, each)
    order = np.argsort(pairs)
    pairs = pairs[order]
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    counts = np.add.reduceat(times[order], first) if len(first) else times
    held = pairs[first]
    return size, unknown, np.bincount(held // top, minlength=len(texts)), held % top, counts


def term_counts(rows: DataFrame, terms: list[str], columns: list[str]) -> DataFrame:
    """``columns`` with ``words`` (their number), ``terms`` (numbers, ascending), ``counts``
    and ``unknown`` (the squared counts of words that are no terms) of each whole text."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    shared = rows.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered = Numbered(shared.value)
        for batch in text_slices(batches, SLICE):
            if len(numbered) > numbered.count + REMEMBERED:
                numbered = Numbered(shared.value)
            size, unknown, held, ids, counts = count_terms(batch.column("text").to_pylist(), numbered)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(size), list_array(ids.astype(np.int32), held),
                 list_array(counts.astype(np.int32), held), pa.array(unknown)],
                [*columns, "words", "terms", "counts", "unknown"])

    schema = (", ".join(f"{c} {kinds[c]}" for c in columns)
              + ", words long, terms array<int>, counts array<int>, unknown double")
    return rows.select(*columns, "text").mapInArrow(run, schema)


def document_frequencies(counted: DataFrame, terms: int) -> np.ndarray:
    """In how many rows of ``term_counts`` each term occurs, summed up in tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=terms)
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(df[found])], ["term", "df"])

    got = counted.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(terms, np.int64)
    df[got.column("term").to_numpy()] = got.column("df").to_numpy()
    return df


def block_order(vectors: np.ndarray) -> np.ndarray:
    """An order of the rows in which similar ones lie together: by the nearest of a few
    centres, found in some rounds, and by nearness to it."""
    centres = vectors[np.linspace(0, len(vectors) - 1, max(1, len(vectors) // (4 * BLOCK))).astype(int)]
    for _ in range(6):
        near = vectors @ centres.T
        own = near.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    near = vectors @ centres.T
    own = near.argmax(axis=1)
    return np.lexsort((-near[np.arange(len(vectors)), own], own))


@dataclass
class Index:
    """The examples' weights, in the order of their blocks: ``matrix`` and the block maxima
    ``most`` of the fixed dimension and the most frequent terms (``slot`` is a term's row or
    -1), and postings of the others (``POSTING``, a term's from ``begin``).  Terms below ``telling`` are telling ones, ``unseen``
    is the idf of a word that is no term."""
    idf: np.ndarray
    telling: int
    unseen: float
    rate: float
    example: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    toxic: np.ndarray = field(default_factory=lambda: np.empty(0))
    slot: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    matrix: np.ndarray = field(default_factory=lambda: np.empty((1, 0)))
    most: np.ndarray = field(default_factory=lambda: np.empty((1, 0)))
    begin: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    post: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    opened: int = 0

    @classmethod
    def of(cls, idf: np.ndarray, rows: Iterable, rate: float, telling: int | None = None, unseen: float = 0.0) -> "Index":
        """From rows with ``example, toxic, words, terms, counts`` (and ``unknown``)."""
        rows = list(rows)
        return cls.build(idf, np.array([r.example for r in rows], np.int64), np.array([r.toxic for r in rows], float),
                         Counts.listed(rows), rate, telling, unseen)

    @classmethod
    def build(cls, idf: np.ndarray, example: np.ndarray, toxic: np.ndarray, counts: Counts, rate: float,
              telling: int | None = None, unseen: float = 0.0) -> "Index":
        index = cls(idf, len(idf) if telling is None else telling, unseen, rate)
        kept = np.flatnonzero(counts.words > 0)
        if len(kept) < len(counts.words):
            counts = counts.rows(kept)
        n = len(kept)
        # in single precision and a thousand rows at a time: the driver holds this once
        weight, rest = np.empty(len(counts.terms), np.float32), np.empty(n)
        for a in range(0, n, 1000):
            b = min(a + 1000, n)
            weight[counts.cut[a]:counts.cut[b]], rest[a:b] = index.weights(counts.rows(np.arange(a, b)))
        row = np.repeat(np.arange(n, dtype=np.int32), np.diff(counts.cut))
        often = np.argsort(-np.bincount(counts.terms, minlength=len(idf)), kind="stable")[:FREQUENT]
        index.slot = np.full(len(idf), -1, np.int32)
        index.slot[often] = np.arange(1, len(often) + 1)
        slot = index.slot[counts.terms]
        wide = -(-n // BLOCK) * BLOCK
        dense = np.zeros((1 + len(often), wide), np.float32)
        dense[0, :n] = rest
        dense[slot[slot >= 0], row[slot >= 0]] = weight[slot >= 0]
        order = np.concatenate([block_order(dense[:, :n].T), np.arange(n, wide)]) if n else np.empty(0, np.int64)
        index.matrix = np.ascontiguousarray(dense[:, order])
        index.most = index.matrix.reshape(len(dense), -1, BLOCK).max(axis=2) if n else np.empty((len(dense), 0))
        index.example, index.toxic = example[kept][order[:n]], toxic[kept][order[:n]]
        put = np.empty(wide, np.int32)
        put[order] = np.arange(wide)
        rare = slot < 0
        terms, place, weight = counts.terms[rare], put[row[rare]], weight[rare]
        del row, slot, rare, dense
        by_term = np.lexsort((place, terms))
        index.begin = np.searchsorted(terms[by_term], np.arange(len(idf) + 1))
        post = np.empty(len(terms), POSTING)
        post["place"], post["weight"] = place[by_term], weight[by_term]
        index.post = post.view(np.int64)
        return index

    def parts(self) -> dict:
        """What is broadcast, plain arrays by name: workers need no copy of this package, and
        hold the index once, for all of their tasks."""
        return vars(self) | {"most": self.most.astype(float)}

    def weights(self, counts: Counts) -> tuple[np.ndarray, np.ndarray]:
        """Every row's weights of its terms and of the fixed dimension; a row's norm is 1
        with the words that are no terms."""
        n = len(counts.words)
        row = np.repeat(np.arange(n), np.diff(counts.cut))
        v = counts.counts * self.idf[counts.terms]
        told = counts.terms < self.telling
        v = np.where(told, v * 100 / np.maximum(counts.words, 1)[row], v)
        norm = np.sqrt(np.bincount(row, np.where(told, 0.0, v ** 2), minlength=n) + counts.unknown * self.unseen ** 2)
        v = np.where(told, v, v * (OTHERS / np.where(norm > 0, norm, 1.0))[row])
        whole = np.sqrt(np.bincount(row, np.where(told, v ** 2, 0.0), minlength=n) + REST ** 2 + np.where(norm > 0, OTHERS ** 2, 0.0))
        return v / whole[row], REST / whole

    def vector(self, idf: np.ndarray, row) -> tuple[np.ndarray, np.ndarray]:
        """Terms of one row, the fixed dimension last, and their weights."""
        weight, rest = self.weights(Counts.listed([row]))
        return np.append(np.asarray(row.terms, np.int64), len(idf)), np.append(weight, rest)

    def search(self, counts: Counts, k: int = NEIGHBOURS, without: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each row the numbers and cosines of its ``k`` nearest examples and of those as
        near as the last of them, so that no order of examples decides; ``without`` are the
        numbers of examples to leave out, one a row."""
        for at in range(0, len(counts.words), TOGETHER):
            part = counts.rows(np.arange(at, min(at + TOGETHER, len(counts.words))))
            yield from self._together(part, k, None if without is None else without[at:at + TOGETHER])

    def _rarer(self, counts: Counts, weight: np.ndarray) -> np.ndarray:
        """What the rarer terms add up to, a row of all examples for each text."""
        m, wide = len(counts.words), self.matrix.shape[1]
        begin = self.begin[counts.terms]
        size = self.begin[counts.terms + 1] - begin
        score = np.empty((m, wide))

        def added(post: np.ndarray, times: np.ndarray, to: np.ndarray | int, rows: int) -> np.ndarray:
            post = post.view(POSTING)
            times *= post["weight"]
            return np.bincount(to + post["place"], times, minlength=rows * wide).reshape(rows, wide)

        short = np.flatnonzero((size > 0) & (size < LONG))
        cut = np.searchsorted(short, counts.cut)
        done = np.concatenate(([0], np.cumsum(size[short])))[cut]
        held = done + wide * np.arange(m + 1)
        a = 0
        while a < m:  # the short postings of some texts
            b = max(a + 1, int(np.searchsorted(held, held[a] + GATHERED, side="right")) - 1)
            own = short[cut[a]:cut[b]]
            each = size[own]
            at = np.repeat(begin[own] - (np.cumsum(each) - each), each) + np.arange(done[b] - done[a])
            to = np.repeat(np.repeat(np.arange(b - a) * wide, np.diff(cut[a:b + 1])), each)
            score[a:b] = added(self.post[at], np.repeat(weight[own], each), to, b - a)
            a = b
        own = np.flatnonzero(size >= LONG)
        cut = np.searchsorted(own, counts.cut).tolist()
        each, times = size[own], weight[own]
        parts = [slice(a, b) for a, b in zip(begin[own].tolist(), (begin[own] + each).tolist())]
        for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])):  # the long ones of a text, end to end
            if a < b:
                score[i] += added(np.concatenate([self.post[p] for p in parts[a:b]]), np.repeat(times[a:b], each[a:b]), 0, 1)[0]
        return score

    def _together(self, counts: Counts, k: int, without: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        m, n, wide = len(counts.words), len(self.example), self.matrix.shape[1]
        weight, rest = self.weights(counts)
        row, slot = np.repeat(np.arange(m), np.diff(counts.cut)), self.slot[counts.terms]
        query = np.zeros((m, len(self.matrix)))
        query[:, 0] = rest
        query[row[slot >= 0], slot[slot >= 0]] = weight[slot >= 0]
        score = self._rarer(counts, weight)
        bound = score.reshape(m, -1, BLOCK).max(axis=2) + query @ self.most + 1e-9
        score[:, n:] = -np.inf
        opened = np.zeros(bound.shape, bool)

        def open_blocks(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                rows, part = np.flatnonzero(wanted[:, b]), slice(b * BLOCK, min((b + 1) * BLOCK, n))
                score[rows, part] += query[rows] @ self.matrix[:, part]
            opened[wanted] = True
            self.opened += int(wanted.sum())
            if without is not None:
                score[np.arange(m), without] = -np.inf

        first = np.argpartition(-bound, min(FIRST, bound.shape[1]) - 1, axis=1)[:, :FIRST]
        wanted = np.zeros_like(opened)
        np.put_along_axis(wanted, first, True, axis=1)
        open_blocks(wanted)
        # a block can hold a neighbour only if it can reach the k-th best of the first blocks
        some = np.take_along_axis(score.reshape(m, -1, BLOCK), first[:, :, None], axis=1).reshape(m, -1)
        least = np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k] if some.shape[1] >= k else np.full(m, -np.inf)
        open_blocks(~opened & (bound >= least[:, None]))
        score.reshape(m, -1, BLOCK)[~opened] = -np.inf
        for each, limit in zip(score, np.maximum(least, -1.0)):
            kept = np.flatnonzero(each >= limit - 1e-12)
            if len(kept) > k:
                found = each[kept]
                kept = kept[found >= np.partition(found, len(found) - k)[len(found) - k] - 1e-12]
            order = kept[np.lexsort((kept, -each[kept]))]
            yield order, each[order]

    def nearest(self, row, k: int = NEIGHBOURS, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        return next(self.search(Counts.listed([row]), k, None if without is None else np.array([without])))

    def vote(self, rows: np.ndarray, near: np.ndarray) -> float:
        weight = 1 / (NEAR + np.maximum(0.0, 1 - near))
        return float(((weight * self.toxic[rows]).sum() + PRIOR * self.rate) / (weight.sum() + PRIOR))


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = SCORED) -> Iterator[pa.RecordBatch]:
    """The same rows, at most so many at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def own_votes(examples: DataFrame, shared) -> DataFrame:
    """``toxic, vote`` of each example that has words, from the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(**shared.value)
        number = {e: i for i, e in enumerate(index.example.tolist())}
        for batch in row_slices(batches):
            known = np.flatnonzero(batch.column("words").to_numpy() > 0)
            own = np.array([number[e] for e in batch.column("example").take(pa.array(known)).to_pylist()], np.int64)
            votes = [index.vote(*found) for found in index.search(Counts.of(batch).rows(known), without=own)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic").take(pa.array(known)), pa.array(votes, pa.float64())], ["toxic", "vote"])

    return examples.mapInArrow(run, "toxic int, vote double")


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function nearest to ``y``: its steps' starts and values.
    A step's value counts one half of each label besides its own."""
    steps: list[list[float]] = []
    for value in np.unique(x):
        own = y[x == value]
        steps.append([value, own.sum(), len(own)])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            last = steps.pop()
            steps[-1][1] += last[1]
            steps[-1][2] += last[2]
    return np.array([s[0] for s in steps]), np.array([(s[1] + 0.5) / (s[2] + 1) for s in steps])


def score_toxicity(documents: DataFrame, labels: DataFrame, most: int = EXAMPLES,
                   threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``documents``: ``doc_id, held_out, score, predicted`` and as evidence
    ``neighbours`` (ids of the three nearest examples) and ``words`` (terms found);
    ``row_key`` hashes the row's id and text.

    A text without any word has no neighbours and the rate of toxic examples among
    such; so have null and empty texts; very long texts are read whole.  Words that no example holds weigh as words of
    one document.  Repeated rows score alike, a null id is not held out; labels that
    are null or in conflict teach nothing; without toxic and other examples every
    score is the examples' plain rate (0 without examples); an empty table gives no
    rows; other columns are never read.
    """
    examples = saved(example_rows(documents, labels, most), "toxic-examples")
    total = examples.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("toxic"), F.lit(0.0)).alias("rate")).first()
    spark = documents.sparkSession
    with settings(spark, {ARROW_BYTES: BATCH}):
        telling = telling_terms(examples)
        both = 0 < total.rate < 1
        terms = telling + (other_words(examples, telling) if both else [])
    counted = saved(term_counts(documents.select(
        "doc_id", "text", held_out().alias("held_out"), F.xxhash64("doc_id", "text").alias("row_key")),
        terms, ["doc_id", "held_out", "row_key"]), "toxic-counts", BATCH)
    n = counted.count()
    with settings(spark, {ARROW_BYTES: BATCH}):
        idf = np.log((n + 1) / (document_frequencies(counted, len(terms)) + 1)) + 1
    known = saved(term_counts(examples, terms, ["example", "toxic"]), "toxic-example-counts", BATCH)
    own = known.orderBy("example").toArrow()
    toxic = own.column("toxic").to_numpy()
    index = Index.build(idf, own.column("example").to_numpy(), toxic.astype(float), Counts.of(own), total.rate, len(telling),
                        float(np.log((n + 1) / 2) + 1)) if both else Index(idf, 0, 0.0, total.rate)
    size, plain = len(index.example), toxic[own.column("words").to_numpy() == 0]
    shared = spark.sparkContext.broadcast(index.parts())
    del index, own
    with settings(spark, {ARROW_BYTES: BATCH}):
        votes = own_votes(known, shared).toArrow() if size else None
    starts, values = isotonic(votes.column("vote").to_numpy(), votes.column("toxic").to_numpy()) if votes else (np.zeros(1), np.full(1, total.rate))
    nothing = (plain.sum() + total.rate) / (len(plain) + 1) if both else total.rate
    names = pa.array([*telling, None], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(**shared.value)
        for batch in row_slices(batches):
            counts = Counts.of(batch)
            score, near = np.full(batch.num_rows, float(nothing)), [[]] * batch.num_rows
            known = np.flatnonzero(counts.words > 0) if len(index.example) else np.empty(0, np.int64)
            for i, (found, similar) in zip(known.tolist(), index.search(counts.rows(known))):
                step = np.searchsorted(starts, index.vote(found, similar), side="right") - 1
                score[i] = values[max(0, step)]
                near[i] = index.example[found[:3]].tolist()
            told = counts.terms < len(names) - 1
            row = np.repeat(np.arange(batch.num_rows), np.diff(counts.cut))
            words = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(np.bincount(row[told], minlength=batch.num_rows)))).astype(np.int32)),
                names.take(pa.array(counts.terms[told])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                 pa.array(near, pa.list_(pa.int64())), words, batch.column("row_key")],
                ["doc_id", "held_out", "score", "predicted", "neighbours", "words", "row_key"])

    # stored, so that no caller's shuffle runs beside the search, whose workers hold the index
    scored = saved(counted.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, "
                                           "neighbours array<long>, words array<string>, row_key long"), "toxic-scores", BATCH)
    forget(counted)
    return scored


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not predicted toxic, with all columns; rows
    that share an id go or stay by their own text."""
    rejected = score_toxicity(documents, labels).filter("predicted = 1").select(F.col("row_key").alias("_key")).distinct()
    return (documents.withColumn("_key", F.xxhash64("doc_id", "text"))
            .join(rejected, "_key", "left_anti").select(*documents.columns))
