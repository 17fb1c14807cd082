"""Spelling variants: words that differ by one letter, found in tries kept as a table.

The words' prefixes are the nodes of one trie, the prefixes of the reversed words those
of another; an edge leads from a prefix to a longer one.  Prefixes have every length at
first, then every other, then lengths that grow by half, so a very long word costs few
levels.  A frontier of states ``(word, position, node, edits)`` is joined with the edges
level by level: every state follows the edge that its letters spell, and a state without
an edit that has come through half its word also starts one on the edges beside.  So an
edit in a word's second half is found forwards and one in its first half backwards, in
either case deep in a trie, where few edges leave a node.  A state with one edit that ends
both its word and a word of the trie is a pair.  Only replacements by a greater letter
and insertions are followed; every pair of words is one of these from one of its sides.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks import folders
from .common import forget, saved, text_bytes, text_slices

#: Bytes of text counted at a time, and letters beyond which a run is long.
SLICE = 2 << 20
LONG_RUN = 64
#: One in so many runs loses a letter in the registered query.
ONE_IN = 97
LEAST_LETTERS = 5
LEAST_COUNT = 3
#: Edges end at every length up to the first, then at every other length up to the second,
#: then at lengths that grow by half.
SINGLE, DENSE = 4, 24
#: A node with more words below it than this is dealt to several tasks.
TOGETHER = 2048
#: Lengths of words are told apart up to this one when edges are pruned.
LENGTHS = 62


def crc_table() -> np.ndarray:
    """The checksum's step for each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def runs_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all runs of letters end to end, A-Z in lower case, where each run
    ends, and the text of each.  U+00C0 to U+00FF are the two bytes C3 80 to C3 BF."""
    data, cut = text_bytes(column)
    lead = data == 0xC3
    small = data | np.uint8(0x20)
    letter = ((small >= 97) & (small <= 122)) | lead
    letter[1:] |= lead[:-1]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    begins = cut[:-1][cut[:-1] < len(data)]
    first[begins] = letter[begins]
    start = np.flatnonzero(first)
    lengths = np.diff(np.append(np.cumsum(letter)[start] - 1, letter.sum())) if len(start) else np.empty(0, np.int64)
    kept = np.where((data >= 65) & (data <= 90), small, data)[letter]
    return kept, np.cumsum(lengths), np.searchsorted(cut, start, side="right") - 1


def run_checksums(data: np.ndarray, ends: np.ndarray, begun: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The CRC-32 of each run of ``data``, each carried on from its checksum ``begun``; the
    steps of all runs are taken together, a letter at a time, but for very long runs."""
    sizes = np.diff(ends, prepend=0)
    order = np.argsort(-sizes, kind="stable")
    start, sizes = (ends - sizes)[order], sizes[order]
    state = begun[order] ^ np.uint32(0xFFFFFFFF)
    long = int(np.searchsorted(-sizes, -LONG_RUN, side="left"))
    for i in range(long):
        state[i] = zlib.crc32(data[start[i]:start[i] + sizes[i]], int(begun[order[i]])) ^ 0xFFFFFFFF
    for k in range(min(LONG_RUN, int(sizes.max(initial=0)))):
        n = int(np.searchsorted(-sizes, -k, side="left"))
        if n <= long:
            break
        part = state[long:n]
        state[long:n] = table[(part ^ data[start[long:n] + k]) & np.uint32(255)] ^ (part >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def counted_words(documents: DataFrame, one_in: int = ONE_IN, letters: int = LEAST_LETTERS,
                  least: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` (occurrences) of all runs of letters in whole texts, A-Z in
    lower case.  Of a run for which ``one_in`` divides the CRC of ``doc_id:run`` the
    letter at the CRC modulo its length is left out; 0 leaves all as they are.  A null
    id counts as empty text.  Each slice of texts is counted where it is read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = crc_table()
        for batch in text_slices(batches, SLICE):
            data, ends, text = runs_of(batch.column("text"))
            if not len(ends):
                continue
            runs = pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(data))
            cut = []
            if one_in:
                begun = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in batch.column("doc_id").to_pylist()], np.uint32)
                crc = run_checksums(data, ends, begun[text], table)
                hit = crc % one_in == 0
                for word, h in zip(runs.filter(pa.array(hit)).to_pylist(), crc[hit].tolist()):
                    at = h % len(word)
                    cut.append(word[:at] + word[at + 1:])
                runs = runs.filter(pa.array(~hit))
            for words in (runs, pa.array(cut, pa.string())):
                counts = words.value_counts()
                enough = pc.greater_equal(pc.utf8_length(counts.field("values")), letters)
                yield pa.RecordBatch.from_arrays([counts.field("values").filter(enough), counts.field("counts").filter(enough)], ["word", "n"])

    return (documents.select("doc_id", "text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


def cut_lengths(longest: int) -> list[int]:
    """The lengths at which prefixes are nodes, up to the first that holds every word."""
    cuts = [0]
    while cuts[-1] < longest:
        cuts.append(cuts[-1] + (1 if cuts[-1] < SINGLE else 2 if cuts[-1] < DENSE else cuts[-1] // 2))
    return cuts


def stride(depth: Column) -> Column:
    """From a node's length to the next."""
    return F.when(depth < SINGLE, 1).when(depth < DENSE, 2).otherwise(F.floor(depth / 2)).cast("int")


def by_level(df: DataFrame, column: str, name: str) -> Callable[[int], DataFrame]:
    """Store ``df`` by a column of levels; gives a reader of one level.  A level is a folder,
    so the same generated code serves all of them."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, f"llm/{name}")
    df.withColumn("_level", F.col(column)).write.partitionBy("_level").parquet(path)
    there = set(folders.names(spark, path))

    def read(level: int) -> DataFrame:
        if f"_level={level}" not in there:
            return spark.createDataFrame([], df.schema)
        return spark.read.schema(df.schema).parquet(f"{path}/_level={level}")
    return read


def bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.cast("int"))


def length_bit(length: Column) -> Column:
    return bit(F.least(length, F.lit(LENGTHS)))


def letter_bit(letter: Column) -> Column:
    return bit(F.ascii(letter) % LENGTHS)


def has(bits: Column, one: Column) -> Column:
    return bits.bitwiseAND(one) != 0


def next_bits(text: Column, position: Column) -> list[Column]:
    """A bit for the letter behind ``position`` and one for the two letters behind it."""
    one, two = piece(text, position, F.lit(1)), piece(text, position, F.lit(2))
    return [F.when(one != "", bit(F.ascii(one) % LENGTHS)).otherwise(F.lit(0).cast("long")),
            F.when(F.char_length(two) == 2, bit(F.pmod(F.hash(two), F.lit(LENGTHS)))).otherwise(F.lit(0).cast("long"))]


#: What a stored state is for: the next level, or as a pair.
GOES_ON, ENDED = 0, 1
STATE = ["way", "text", "start", "position", "edits", "node", "dealt"]
FORWARD, BACKWARD = ">", "<"


def ways(words: DataFrame, cuts: list[int]) -> DataFrame:
    """Each word in both directions: ``way``, ``text``, ``start``, the position from which
    edits are looked for (half the word, its longer half backwards), and ``enter``, the
    last node before it."""
    half = F.floor(F.char_length("word") / 2).cast("int")
    both = words.select(F.explode(F.array(
        F.struct(F.lit(FORWARD).alias("way"), F.col("word").alias("text"), half.alias("start")),
        F.struct(F.lit(BACKWARD).alias("way"), F.reverse("word").alias("text"), (F.char_length("word") - half).alias("start"))
    )).alias("w")).select("w.*")
    return both.withColumn("enter", F.array_max(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("start"))))


def node_at(depth: Column) -> Column:
    """A node's key: the direction and the prefix."""
    return F.concat("way", F.substring("text", F.lit(1), depth))


def depth_of(node: Column) -> Column:
    return F.char_length(node) - 1


def trie_levels(texts: DataFrame, cuts: list[int]) -> tuple[Callable[[int], DataFrame], Callable[[int], DataFrame]]:
    """By level the states of the words that enter there, and the edges: ``node, label, depth`` (the node's length), ``ends`` (whether the child, ``node`` and
    ``label`` together, is a word), ``lengths`` (a bit for each length of the words below the
    child), ``next_1`` and ``next_2`` (bits of the letters and pairs of letters behind it),
    ``child_dealt`` and ``dealt`` (over how many tasks the states of either are dealt)."""
    lengths = F.array(*map(F.lit, cuts))
    places = texts.select("way", "text", F.explode(F.filter(lengths, lambda c: c < F.char_length("text"))).alias("depth"))
    steps = places.withColumn("to", F.least(F.col("depth") + stride(F.col("depth")), F.char_length("text")))
    one, two = next_bits(F.col("text"), F.col("to"))
    edges = saved(steps.groupBy(node_at(F.col("depth")).alias("node"), piece(F.col("text"), F.col("depth"), F.col("to") - F.col("depth")).alias("label"),
                                "depth").agg(
        F.max(F.col("to") == F.char_length("text")).alias("ends"), F.bit_or(length_bit(F.char_length("text"))).alias("lengths"),
        F.bit_or(one).alias("next_1"), F.bit_or(two).alias("next_2"), F.count(F.lit(1)).alias("below")), "trie-steps")
    # one more than the words on a node's edges: the node may be a word itself
    hot = edges.groupBy("node").agg((F.sum("below") + 1).alias("words")).filter(F.col("words") > TOGETHER)
    hot = saved(hot.select("node", F.ceil(F.col("words") / TOGETHER).cast("int").alias("dealt")), "trie-hot")
    own = texts.select("way", "text", "start", F.col("enter").alias("position"), F.lit(0).alias("edits"), node_at(F.col("enter")).alias("node"))
    states = by_level(own.join(hot, "node", "left").withColumn("dealt", F.coalesce("dealt", F.lit(1))).select(*STATE), "position", "trie-texts")
    read = by_level(edges.join(hot, "node", "left").select(
        "node", "label", "depth", "ends", "lengths", "next_1", "next_2", F.coalesce("dealt", F.lit(1)).alias("dealt"),
        F.ceil(F.col("below") / TOGETHER).cast("int").alias("child_dealt")), "depth", "trie-edges")
    forget(edges)
    return states, read


def piece(word: Column, start: Column, length: Column) -> Column:
    return F.substring(word, start + 1, F.greatest(length, F.lit(0)))


REACHED = ["way", "text", "start", "position", "edits", "node", "ends", "next_1", "next_2", "dealt"]


def followed(states: DataFrame, level: DataFrame) -> DataFrame:
    """Every state along the edge that its letters spell: a whole step, or the shorter
    one that ends a word."""
    rest = F.char_length("text") - F.col("position")
    step = stride(depth_of(F.col("node")))
    takes = F.array_distinct(F.array(F.least(rest, step), step))
    spelled = (states.drop("dealt").filter(rest > 0).withColumn("take", F.explode(takes)).filter(F.col("take") <= rest)
               .withColumn("label", piece(F.col("text"), F.col("position"), F.col("take"))))
    edges = level.select("node", "label", "ends", "next_1", "next_2", F.col("child_dealt").alias("dealt"))
    return (spelled.join(edges.hint("merge"), ["node", "label"]).withColumn("position", F.col("position") + F.col("take"))
            .withColumn("node", F.concat("node", "label")).select(*REACHED))


def edited(states: DataFrame, level: DataFrame) -> DataFrame:
    """States without an edit that are far enough, with one on each edge beside."""
    text, position, label = F.col("text"), F.col("position"), F.col("label")
    salt = F.pmod(F.xxhash64("text"), F.col("dealt")).cast("int")
    own = states.filter((F.col("edits") == 0) & (position + stride(position) > F.col("start"))).withColumn("salt", salt)
    beside = level.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("dealt") - 1)))
    met = own.select("way", "text", "start", "position", "node", "salt").join(
        beside.select("node", "salt", "label", "ends", "lengths", "next_1", "next_2", F.col("child_dealt").alias("dealt")).hint("merge"),
        ["node", "salt"])
    size, left = F.char_length(label), F.char_length(text) - position
    same, fewer = piece(text, position, size), piece(text, position, size - 1)
    replaced = ((left >= size) & has(F.col("lengths"), length_bit(F.char_length(text))) & (label > same)
                & (F.levenshtein(label, same, 1) == 1))
    # a letter inserted into a run of its like counts at the run's end only
    inserted = ((left >= size - 1) & has(F.col("lengths"), length_bit(F.char_length(text) + 1)) & (label != same)
                & (F.levenshtein(label, fewer, 1) == 1))
    # few meetings pass this; arrays of moves are made of those only
    moves = F.array(F.when(replaced, position + size), F.when(inserted, position + size - 1))
    return (met.filter(replaced | inserted)
            .select("way", "text", "start", F.explode(moves).alias("position"), F.lit(1).alias("edits"),
                    F.concat("node", "label").alias("node"), "ends", "next_1", "next_2", "dealt").filter("position IS NOT NULL"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b``: each pair of ``words`` (distinct, column ``word``) that differ by one
    replaced or inserted letter, once."""
    cuts = cut_lengths(words.agg(F.max(F.char_length("word")).alias("m")).first().m or 0)
    entering, edges = trie_levels(ways(words, cuts), cuts)
    states, ends = None, []
    position, rest = F.col("position"), F.char_length("text") - F.col("position")
    for depth in cuts[:-1]:
        level, here = edges(depth), entering(depth)
        here = here if states is None else here.unionByName(states)
        reached = followed(here, level).unionByName(edited(here, level))
        ended = (F.col("edits") == 1) & F.col("ends") & (rest == 0)
        # with an edit, the next letters must be on an edge; without one, any edge will do
        one, two = next_bits(F.col("text"), position)
        goes_on = F.when(F.col("edits") == 0, F.col("next_1") != 0).otherwise(
            has(F.col("next_1"), one) & ((rest == 1) | has(F.col("next_2"), two)))
        uses = F.array(F.when(goes_on, GOES_ON), F.when(ended, ENDED))
        read = by_level(reached.select(*STATE, F.explode(uses).alias("use")).filter("use IS NOT NULL"), "use", "trie-states")
        ends.append(read(ENDED))
        if states is not None:
            forget(states)
        states = read(GOES_ON).drop("use")
    if not ends:
        return words.select(F.col("word").alias("a"), F.col("word").alias("b")).limit(0)
    every = ends[0]
    for pairs in ends[1:]:
        every = every.unionByName(pairs)
    spelt = F.substring("node", F.lit(2), F.char_length("node"))
    turned = [F.when(F.col("way") == BACKWARD, F.reverse(x)).otherwise(x) for x in (F.col("text"), spelt)]
    return every.select(turned[0].alias("a"), turned[1].alias("b")).distinct()


def variant_roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the end of the chain of forms, reached by
    repeatedly taking the form of the form."""
    links = saved(forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    while True:
        far = links.select(F.col("word").alias("via"), F.col("root").alias("far"))
        longer = (links.join(far, links.root == far.via)
                  .select("word", F.col("far").alias("root"), (F.col("far") != F.col("root")).alias("moved")))
        got = saved(longer, "spelling-roots")
        links = got.select("word", "root")
        if not got.filter("moved").limit(1).count():
            return links


def spelling_variants(documents: DataFrame, one_in: int = 0, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """Per word of ``documents.text``: ``word, form, root, n, n_near, form_n``.

    Words are runs of ``A-Za-z`` and U+00C0 to U+00FF, A-Z in lower case, of at least
    ``letters`` code points and ``least`` occurrences over all documents (each row
    counts, repeated rows too).  ``form`` is the near word of largest ``n`` (ties:
    first in code-point order) where that is at least twice the word's own; ``root``
    follows forms to the last.  Null and empty texts hold no words, texts and words of any
    length are read whole, an empty table gives no rows, and other columns than ``doc_id``
    and ``text`` are never read.  ``one_in`` deletes letters as ``counted_words`` says.
    """
    words = saved(counted_words(documents, one_in, letters, least), "spelling-words")
    pairs = saved(near_pairs(words.select("word")), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = near.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    form = F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best.form"))
    table = saved(words.join(best, "word", "left").select(
        "word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(form.isNotNull(), -F.col("best.less")).alias("form_n")), "spelling-forms")
    return table.join(variant_roots(table), "word").select("word", "form", "root", "n", "n_near", "form_n")
