"""N-gram Jaccard join: documents that share 80 % of their word shingles, by
prefix filters under several global orders of the shingles.

A set of ``n`` shingles that links to another shares at least ``need(n)`` of them,
so under any fixed order of all shingles the two must share one among the first
``n - need(n) + 1`` of each.  Three orders are used and their filters intersected:

* a hash order first, on prefixes some shingles longer, in which a linked set
  finds several of its shingles again in other sets; it needs no statistics and
  leaves the few sets that can link at all;
* on those, rarest first, counted over all of them: it makes the candidates, with
  bounds from sizes and positions, since long passages that many documents share
  come last in it;
* the hash order again and another one, as filters of each candidate pair before
  the two whole sets are fetched and compared.

Candidates are not all pairs of a group: the members of each rare shingle are
first compared with the most typical of them, and further pairs are made only
between members that are not yet in one component.  So groups of thousands of near
copies cost a comparison for each member, and no link that joins two components is
lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_array, saved, text_slices
from .components import connected_components
from .words import mixed, shingle_sets

#: A pair links when ``100 * intersection >= PERCENT * union``.
PERCENT = 80
#: The first filter's prefixes are longer by this share of the set, and as many
#: of their shingles must be found in another set.
LONGER = 0.10
#: Bits of the filter of document ids that spares the second pass over texts most
#: work; a saturated filter only costs time.
FILTER_BITS = 1 << 23
#: Rounds in which a rare shingle's members are compared with one of them.
HUB_ROUNDS = 2


def need(n: np.ndarray | int, percent: int = PERCENT):
    """The least intersection of a linked pair with a set of ``n``."""
    return -(-n * percent // 100)


def _need(n, percent: int = PERCENT):
    return F.floor((n * percent + 99) / 100).cast("long")


def set_key(shingles: np.ndarray) -> int:
    """A 64-bit name of a set; equal sets are one class."""
    import xxhash
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def _set_rows(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())], ["doc_id", "n", "cls"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, cls long")


def _long_prefixes(documents: DataFrame, percent: int) -> DataFrame:
    """``cls, token`` of the longer prefixes in hash order, once per task and class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            seen, keys, parts = set(), [], []
            for s in shingle_sets(batch.column("text")):
                n = len(s)
                key = set_key(s) if n else None
                if n and key not in seen:
                    seen.add(key)
                    keys.append(key)
                    parts.append(s[:n - need(n, percent) + max(1, int(LONGER * n))])
            counts = np.array([len(p) for p in parts], np.int64)
            tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(keys, np.int64), counts)), pa.array(tokens.view(np.int64))],
                ["cls", "token"])

    return documents.select("text").mapInArrow(run, "cls long, token long")


def _id_filter(ids: DataFrame) -> np.ndarray:
    """A fixed number of bits in which those of the given ids are set, gathered as
    at most ``FILTER_BITS / 32`` numbers."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = (ids.select(F.floor(bit / 32).cast("int").alias("word"), (bit % 32).cast("int").alias("bit")).distinct()
             .groupBy("word").agg(F.sum(F.expr("shiftleft(1L, bit)")).alias("value")).collect())
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in words:
        out[r.word] = r.value
    return out


def _whole_sets(documents: DataFrame, alive: DataFrame, percent: int) -> DataFrame:
    """``cls, n, tokens`` with the prefixes ``first`` and ``other`` of two hash orders,
    for the classes in ``alive`` (``cls, doc_id`` of one member)."""
    bits = documents.sparkSession.sparkContext.broadcast(_id_filter(alive))
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        for batch in batches:
            at = batch.column("bit").to_numpy()
            on = (bits.value[at // 32] >> (at % 32).astype(np.uint32)) & 1
            kept = pa.Table.from_batches([batch]).filter(pc.or_(pc.is_null(batch.column("doc_id")), pa.array(on == 1)))
            for piece in text_slices(iter(kept.combine_chunks().to_batches())):
                sets = shingle_sets(piece.column("text"))
                n = np.array([len(s) for s in sets], np.int64)
                short = n - need(n, percent) + (n > 0)
                others = [np.sort(s[np.argsort(mixed(s))[:k]]) for s, k in zip(sets, short)]
                lists = [list_array(np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64),
                                    np.array([len(y) for y in x], np.int64))
                         for x in (sets, [s[:k] for s, k in zip(sets, short)], others)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()), piece.column("doc_id"),
                     pa.array(n), *lists], ["cls", "id", "n", "tokens", "first", "other"])

    rows = documents.select("doc_id", "text", bit.alias("bit")).mapInArrow(
        run, "cls long, id long, n long, tokens array<long>, first array<long>, other array<long>")
    chosen = alive.select("cls", "doc_id")
    return (rows.join(chosen, (rows.cls == chosen.cls) & rows.id.eqNullSafe(chosen.doc_id), "left_semi")
            .drop("id").dropDuplicates(["cls"]))


def _bounds(a: str, b: str, percent: int):
    """Whether a shared shingle at these positions, counted from the rarest, can be one
    by which a link is found.  A link of sets of ``n`` and ``m`` needs ``o`` shared
    shingles (``100 * o >= percent * (n + m - o)``), so it shows among the first
    ``n - o + 1`` and ``m - o + 1``; and what is shared before the position is none of
    the ``single`` ones that occur in one set only."""
    n, m, i, j, s, t = (F.col(f"{x}.{y}") for y in ("n", "pos", "single") for x in (a, b))
    enough = (n + m) * percent
    after = F.least(n - i, m - j)
    return ((F.least(n, m) * 100 >= F.greatest(n, m) * percent)
            & (after * (100 + percent) >= enough)
            & ((F.least(i - s, j - t) + after) * (100 + percent) >= enough))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``a, b`` that pass the filters of both hash orders and then link."""
    short = sets.select("cls", "first", "other")
    near = (pairs.join(short.select(F.col("cls").alias("a"), F.col("first").alias("fa"), F.col("other").alias("oa")), "a")
            .join(short.select(F.col("cls").alias("b"), F.col("first").alias("fb"), F.col("other").alias("ob")), "b")
            .filter(F.arrays_overlap("fa", "fb") & F.arrays_overlap("oa", "ob")).select("a", "b"))
    near = saved(near, "join-candidates")
    whole = sets.select("cls", "tokens")
    both = (near.join(whole.select(F.col("cls").alias("a"), F.col("tokens").alias("ta")), "a")
            .join(whole.select(F.col("cls").alias("b"), F.col("tokens").alias("tb")), "b"))
    shared = F.size(F.array_intersect("ta", "tb")).cast("long")
    return saved(both.withColumn("o", shared)
                 .filter(F.col("o") * 100 >= (F.size("ta") + F.size("tb") - F.col("o")) * percent)
                 .select("a", "b"), "join-links")


def ngram_components(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``documents``: ``doc_id, n_shingles, class_id, component_id``.

    ``class_id`` is the least ``doc_id`` with an equal set, ``component_id`` the least
    reachable by links.  Null, empty and wordless texts have no shingles and are
    their own component; repeated rows repeat; a null id keeps a null id, takes part
    in links, and is the least id only where its component has no other; an empty
    table gives no rows; columns other than ``doc_id`` and ``text`` are not read.
    Sets are equal when their 64-bit shingle hashes and the 64-bit hash of those are.
    """
    meta = saved(_set_rows(documents), "join-meta")
    classes = saved(meta.filter("cls is not null").groupBy("cls").agg(
        F.first("n").alias("n"), F.min("doc_id").alias("doc_id")), "join-classes")

    # Order 1, by hash: several shingles of a prefix must occur in another class.
    rows = _long_prefixes(documents, percent)
    shared = (rows.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"))
              .filter("lo <> hi").select("token"))
    found = saved(rows.join(shared, "token", "left_semi").distinct().groupBy("cls").agg(
        F.count(F.lit(1)).alias("found")), "join-found")
    least = F.greatest(F.lit(1), F.floor(_need(F.col("n"), percent) * LONGER))
    alive = saved(found.join(classes, "cls").filter(F.col("found") >= least).select("cls", "doc_id"), "join-alive")

    # Order 2, rarest first over the sets that are left; single shingles link nothing.
    sets = saved(_whole_sets(documents, alive, percent), "join-sets")
    each = sets.select("cls", "n", F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ranked = (each.join(counts, "token").groupBy("cls").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("by")))
    single = F.col("n") - F.size("by")
    room = (F.col("n") - _need(F.col("n"), percent) + 1 - single).cast("int")
    prefix = saved(ranked.withColumn("single", single).withColumn("room", room).filter("room > 0").select(
        "cls", "n", "single", F.posexplode(F.slice("by", F.lit(1), F.col("room"))).alias("at", "entry"))
        .select("cls", "n", "single", (F.col("single") + F.col("at")).alias("pos"),
                F.col("entry.token").alias("token")), "join-prefix")

    # Each shingle's members against the most typical of them.
    links = labels = None
    members = prefix.withColumn("comp", F.col("cls"))
    for _ in range(HUB_ROUNDS):
        typical = F.min(F.struct((F.col("single") / F.col("n")).alias("odd"), "cls", "n", "pos", "single", "comp"))
        hubs = members.groupBy("token").agg(typical.alias("hub")).select(
            "token", *[F.col(f"hub.{c}").alias(c) for c in ("cls", "n", "pos", "single", "comp")])
        pairs = (members.alias("x").join(hubs.alias("h"), "token")
                 .filter((F.col("x.comp") != F.col("h.comp")) & _bounds("x", "h", percent))
                 .select(F.least("x.cls", "h.cls").alias("a"), F.greatest("x.cls", "h.cls").alias("b")).distinct())
        more = _linked(pairs, sets, percent)
        links = more if links is None else saved(links.union(more), "join-all-links")
        labels = connected_components(links)
        members = _undecided(members.join(hubs.select("token", "cls"), ["token", "cls"], "left_anti"), labels)

    # What is left: pairs of members that no component joins yet.
    pairs = (members.alias("x").join(members.alias("y"), "token")
             .filter((F.col("x.cls") < F.col("y.cls")) & (F.col("x.comp") != F.col("y.comp")) & _bounds("x", "y", percent))
             .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct())
    links = saved(links.union(_linked(pairs, sets, percent)), "join-all-links")
    labels = connected_components(links)

    named = classes.join(labels, classes.cls == labels.node, "left").select(
        "cls", F.col("doc_id").alias("class_id"), F.coalesce("label", "cls").alias("comp"))
    least_id = named.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    named = named.join(least_id, "comp").select("cls", "class_id", "component_id")
    return (meta.join(named, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id")))


def _undecided(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with their components, of shingles that still have several."""
    placed = saved(members.join(labels, members.cls == labels.node, "left")
                   .withColumn("comp", F.coalesce("label", "cls")).drop("node", "label"), "join-members")
    several = (placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
               .filter("lo <> hi").select("token"))
    return saved(placed.join(several, "token", "left_semi"), "join-open")


def keep_one_of_each(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents`` whose ``doc_id`` is the least of their component, one
    of each id and text.  Rows of null id cannot be named as copies and stay."""
    groups = ngram_components(documents, percent)
    heads = groups.filter("doc_id = component_id").select("doc_id").distinct()
    mark = F.xxhash64("text")
    return (documents.join(heads, "doc_id", "left_semi").withColumn("_mark", mark)
            .dropDuplicates(["doc_id", "_mark"]).drop("_mark")
            .unionByName(documents.filter("doc_id is null")).select(*documents.columns))
