"""Token-id output: shards of independent zstandard frames with a trailing seek
table and a checksum for each frame.

A shard holds documents in ascending ``doc_id``.  Its frames hold whole documents'
ids as little-endian unsigned 32-bit numbers; one more frame is the document
index; the seek table (a skippable frame, so that any zstandard tool reads the
file) ends it.  A reader takes the table from the end of the file, then the
index, and then decompresses only the frames of the documents it wants.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import NULL_ID, dealt_evenly, file_system, filled_text, saved, scan_tasks, text_bytes, text_slices
from .warc import ArchiveWriter
from .words import exact_letters, span_hashes

#: Fixed values of the seekable zstandard format.
SKIPPABLE, SEEKABLE, CHECKED = 0x184D2A5E, 0x8F92EAB1, 0x80
#: A frame is closed when it holds so many ids; a longer document has a frame of its own.
FRAME_IDS = 1 << 16
LEVEL = 3
END_ID = 2
#: Characters of a text by which rows of one id are ordered.
HEAD = 32
#: Pieces a worker remembers before it starts anew.
REMEMBERED = 300_000


# --- the file format ---------------------------------------------------------

class ShardWriter:
    """Writes one shard: ``document`` in order, then ``finish``.  A frame goes to ``write``
    as soon as it is closed; without ``write`` all are kept for ``bytes``."""

    def __init__(self, write: Callable[[bytes], object] | None = None):
        import zstandard
        self.zip = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.kept: list[bytes] = []
        self.write = write or self.kept.append
        self.table: list[tuple[int, int, int]] = []
        self.ids: list[np.ndarray] = []
        self.held = 0
        self.index: list[tuple[int, int, int]] = []

    def _frame(self, raw: bytes) -> None:
        import xxhash
        packed = self.zip.compress(raw)
        self.write(packed)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def _flush(self) -> None:
        if self.held:
            self._frame(np.concatenate(self.ids).astype("<u4").tobytes())
        self.ids, self.held = [], 0

    def document(self, doc_id: int, ids: np.ndarray) -> None:
        if self.held and self.held + len(ids) > FRAME_IDS:
            self._flush()
        self.index.append((doc_id, len(self.table), len(ids)))
        self.ids.append(ids)
        self.held += len(ids)

    def finish(self) -> None:
        self._flush()
        columns = np.array(self.index, np.int64).reshape(-1, 3)
        self._frame(b"".join([columns[:, 0].astype("<i8").tobytes(), columns[:, 1].astype("<u4").tobytes(),
                              columns[:, 2].astype("<u4").tobytes()]))
        table = b"".join(struct.pack("<III", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKED, SEEKABLE)
        self.write(b"".join([struct.pack("<II", SKIPPABLE, len(table) + len(footer)), table, footer]))

    def bytes(self) -> bytes:
        self.finish()
        return b"".join(self.kept)


class ShardReader:
    """Random access to a shard by range reads; every frame read is verified."""

    def __init__(self, path: str):
        import zstandard
        store, name = file_system(path)
        self.file = store.open_input_file(name)
        self.unzip = zstandard.ZstdDecompressor()
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self._range(size - 9, 9))
        if magic != SEEKABLE or flags != CHECKED:
            raise ValueError(f"{path}: no seek table")
        at = size - 9 - 12 * count
        table = np.frombuffer(self._range(at, 12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.sizes, self.raw, self.sums = table.T
        self.begin = np.concatenate(([0], np.cumsum(self.sizes)))
        if self.begin[-1] != at - 8:
            raise ValueError(f"{path}: the seek table does not fit the file")
        index = self.frame(count - 1)
        n = len(index) // 16
        self.doc_id = np.frombuffer(index, "<i8", n)
        self.doc_frame = np.frombuffer(index, "<u4", n, 8 * n)
        self.doc_size = np.frombuffer(index, "<u4", n, 12 * n).astype(np.int64)

    def _range(self, at: int, size: int) -> bytes:
        self.file.seek(int(at))
        return self.file.read(int(size))

    def frame(self, k: int) -> bytes:
        import xxhash
        raw = self.unzip.decompress(self._range(self.begin[k], self.sizes[k]), max_output_size=int(self.raw[k]))
        if len(raw) != self.raw[k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """All documents in order."""
        for rows in np.split(np.arange(len(self.doc_id)), np.flatnonzero(np.diff(self.doc_frame)) + 1):
            if len(rows):
                ids = np.frombuffer(self.frame(int(self.doc_frame[rows[0]])), "<u4")
                for row, part in zip(rows, np.split(ids, np.cumsum(self.doc_size[rows])[:-1])):
                    yield int(self.doc_id[row]), part

    def get(self, doc_id: int) -> list[np.ndarray]:
        """The ids of each row of ``doc_id``; only its frames are read."""
        lo, hi = np.searchsorted(self.doc_id, [doc_id, doc_id + 1])
        out = []
        for row in range(lo, hi):
            frame = self.doc_frame[row]
            before = self.doc_size[np.searchsorted(self.doc_frame, frame):row].sum()
            ids = np.frombuffer(self.frame(int(frame)), "<u4")
            out.append(ids[before:before + self.doc_size[row]])
        return out

    def close(self) -> None:
        self.file.close()


# --- encoding ----------------------------------------------------------------

#: Bits of a byte's class: ASCII letter or digit; other visible ASCII; may start a
#: white-space character.
ALNUM, MARK, SPACE = 1, 2, 4


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for code in range(33, 127):
        out[code] = ALNUM if chr(code).isalnum() else MARK
    out[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = SPACE
    return out


def literal_spans(raw: bytes, cut: np.ndarray, literals: re.Pattern) -> np.ndarray:
    """Start and end of each literal that lies inside one text, leftmost first."""
    spans, at = [], 0
    while match := literals.search(raw, at):
        a, b = match.span()
        inside = np.searchsorted(cut, a, side="right") == np.searchsorted(cut, b, side="left")
        if inside:
            spans.append((a, b))
        at = b if inside else a + 1
    return np.array(spans, np.int64).reshape(-1, 2)


def piece_cuts(data: np.ndarray, cut: np.ndarray, whole: np.ndarray | None = None) -> np.ndarray:
    """Where texts can be cut into pieces that encode independently of each other:
    the pre-tokenizer's pattern always ends a token before a blank that a visible
    character follows, between a letter or digit and a mark, and around a line end
    between visible ASCII characters.  The spans of ``whole`` are a piece each, and the
    text before one ends there."""
    n = len(data)
    here = np.zeros(n + 1, bool)
    if n > 1:
        kind = _classes()[data]
        here[:n - 1] = (data[:-1] == 32) & (kind[1:] < SPACE)
        here[1:n] |= (kind[:-1] == ALNUM) & (kind[1:] == MARK)
        lines = np.flatnonzero(data[1:-1] == 10) + 1
        visible = ALNUM | MARK
        lines = lines[((kind[lines - 1] & visible) > 0) & ((kind[lines + 1] & visible) > 0)]
        here[lines] = True
        here[lines + 1] = True
    if whole is not None:
        ends = np.concatenate([cut[1:], whole[:, 0]])
        ends = ends[ends > 0]
        here[ends[data[ends - 1] == 32] - 1] = False  # no visible character of the same text follows
        for a, b in whole.tolist():
            here[a:b] = False
        here[whole.ravel()] = True
    here[cut] = True
    return np.flatnonzero(here)


class Encoder:
    """Ids of whole texts by a byte-level tokenizer file of the tokenizers library.
    A piece is encoded once and then found by a 64-bit hash.  With ``added`` a literal of
    an added token (as ``<|endoftext|>``) is that token, as the file says; without, it is text."""

    def __init__(self, path: str, added: bool = False):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.literals, self.spaced = None, False
        if added:
            tokens = list(self.tokenizer.get_added_tokens_decoder().values())
            if any(t.lstrip or t.rstrip or t.single_word for t in tokens):
                raise ValueError(f"{path}: added tokens that depend on the text around them")
            names = sorted((t.content.encode() for t in tokens), key=len, reverse=True)
            self.literals = re.compile(b"|".join(map(re.escape, names))) if names else None
            self.spaced = any(t.content.split() != [t.content] for t in tokens)
        else:
            self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.letters = exact_letters()
        self._forget()

    @classmethod
    def of_worker(cls, path: str, added: bool = False) -> "Encoder":
        """One encoder for all tasks that a Python worker runs one after another."""
        import tokenizers
        kept = tokenizers.__dict__.setdefault("_encoders_of_worker", {})
        if (path, added) not in kept:
            kept[path, added] = cls(path, added)
        return kept[path, added]

    def _forget(self) -> None:
        self.place: dict[int, int] = {}
        self.begin = np.zeros(1, np.int64)  # of each known piece in flat, and the end
        self.flat = np.empty(0, np.uint32)

    def _places(self, hashes: np.ndarray, piece) -> np.ndarray:
        """The number of each distinct piece; ``piece(k)`` is the text of the k-th."""
        keys = hashes.tolist()
        if len(self.place) + len(keys) > REMEMBERED:
            self._forget()
        at = np.fromiter(map(self.place.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(at < 0)
        if len(new):
            got = self._encoded([piece(k) for k in new])
            at[new] = len(self.place) + np.arange(len(new))
            self.place.update(zip(hashes[new].tolist(), at[new].tolist()))
            ends = self.begin[-1] + np.cumsum(np.fromiter(map(len, got), np.int64, len(got)))
            self.begin = np.concatenate((self.begin, ends))
            self.flat = np.concatenate([self.flat, *got])
        return at

    def _encoded(self, pieces: list[str]) -> list[np.ndarray]:
        """Pieces whose only white space is a blank at their start are encoded many
        at a time: a token that starts with a blank starts the next of them."""
        out: list = [None] * len(pieces)
        joined = [i for i, p in enumerate(pieces) if p[0] == " " and len(p) > 1 and len(p.split()) == 1
                  and p[1:].strip() == p[1:] and not self.spaced]
        rest = np.ones(len(pieces), bool)
        rest[joined] = False
        alone = np.flatnonzero(rest).tolist()
        batch = self.tokenizer.encode_batch_fast
        for i, e in zip(alone, batch([pieces[i] for i in alone], add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32)
        groups = [joined[k:k + 256] for k in range(0, len(joined), 256)]
        texts = ["".join([pieces[i] for i in g]) for g in groups]
        for group, e in zip(groups, batch(texts, add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            starts = np.flatnonzero(self.blank[ids])
            if len(starts) != len(group):
                raise ValueError("a piece does not start with one blank token")
            for i, part in zip(group, np.split(ids, starts[1:])):
                out[i] = part
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids end to end, and the offsets that cut them."""
        data, cut = text_bytes(column)
        raw = data.tobytes()
        edge = piece_cuts(data, cut, literal_spans(raw, cut, self.literals) if self.literals else None)
        start, end = edge[:-1], edge[1:]
        if not len(start):
            return np.empty(0, np.uint32), np.zeros(len(cut), np.int64)
        import pandas as pd
        which, distinct = pd.factorize(span_hashes(data, start, end, self.letters))
        first = np.empty(len(distinct), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        where = self._places(distinct, lambda k: raw[start[first[k]]:end[first[k]]].decode())[which]
        size = self.begin[where + 1] - self.begin[where]
        total = np.cumsum(size)
        ids = self.flat[np.repeat(self.begin[where] - (total - size), size) + np.arange(total[-1])]
        return ids, np.concatenate(([0], total))[np.searchsorted(edge, cut)]


def write_token_files(documents: DataFrame, tokenizer: str, folder: str | None = None,
                      added: bool = False) -> tuple[str, DataFrame]:
    """Encode every whole text, append the end id 2 and write the shards; gives the
    folder and ``shard, path, documents, tokens`` of what was written.

    With ``added``, as the query and the pipeline call it, literals of added tokens are
    these tokens (the tokenizer's default); without, they are encoded as text.
    Null and empty texts hold the end id alone; a null id is stored as the lowest
    64-bit number and comes first; rows that share an id are all written, in order of
    the first ``HEAD`` characters of their texts, then of a hash; rows equal in both may
    lie in several shards, so however many share an id they are many tasks' work.  Very
    long texts have frames of their own; extra columns are not read; an empty table
    writes no file.  Texts are dealt once, by ranges; a shard is one task's, however
    often it runs, and its frames go to the file as they are closed.
    """
    text = F.coalesce("text", F.lit(""))
    folder = folder or scratch_path(documents.sparkSession, "llm/tokens")
    order = ["doc_id", "head", "mark", "row"]
    rows = (documents.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text", F.substring(text, 1, HEAD).alias("head"),
                             F.xxhash64(text).alias("mark"), F.monotonically_increasing_id().alias("row"))
            .repartitionByRange(2 * scan_tasks(documents), *order).sortWithinPartitions(*order).select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, file = TaskContext.get().partitionId(), None
        path = f"{folder}/shard-{number:08d}.tok.zst"
        count = tokens = 0
        for batch in text_slices(batches):
            if file is None:
                encoder, file = Encoder.of_worker(tokenizer, added), ArchiveWriter(path)
                writer = ShardWriter(file.add)
            ids, cut = encoder.encode(filled_text(batch.column("text")))
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[cut[k]:cut[k + 1]], np.uint32(END_ID))
                writer.document(doc, own)
                count, tokens = count + 1, tokens + len(own)
        if file is not None:
            writer.finish()
            file.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([number], pa.int32()), "path": [path],
                                              "documents": [count], "tokens": [tokens]})

    return folder, saved(rows.mapInArrow(run, "shard int, path string, documents long, tokens long"), "token-shards")


def read_token_files(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the
    files: ``start`` counts the ids of all documents before it.  Each frame's
    checksum is verified; a damaged file raises an error."""
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    placed = shards.withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                reader = ShardReader(path)
                crc = [zlib.crc32(part.tobytes()) for _, part in reader.documents()]
                reader.close()
                start = before + np.concatenate(([0], np.cumsum(reader.doc_size)))[:-1]
                doc = pa.array(reader.doc_id, pa.int64(), mask=reader.doc_id == NULL_ID)
                yield pa.RecordBatch.from_arrays([doc, pa.array(start, pa.int64()), pa.array(reader.doc_size),
                                                  pa.array(crc, pa.int64())],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])

    return (dealt_evenly(placed, "shard", (shards.agg(F.max("shard")).first()[0] or 0) + 1)
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_documents(shards: DataFrame, doc_ids: Iterable[int]) -> DataFrame:
    """``doc_id, ids`` of the wanted documents: a shard's seek table and index are
    read, and then only the frames that hold them."""
    wanted = sorted(doc_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                reader = ShardReader(path)
                for doc in wanted:
                    for ids in reader.get(doc):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([doc]), pa.array([ids.astype(np.int64).tolist()], pa.list_(pa.int64()))],
                            ["doc_id", "ids"])
                reader.close()

    return shards.select("path").mapInArrow(run, "doc_id long, ids array<long>")
