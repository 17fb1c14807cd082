"""Mixing sources to target weights by Pareto order sampling.

Every document gets its whole copies for certain; the fractional rest of each
source is a sample in the order of ``random odds / inclusion odds`` that stops
at the source's remaining words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, saved

#: Cells into which each refinement cuts the rank interval that holds a source's stop.
CELLS = 4096


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0),
                   share: float = 1.0, most: float = 3.0) -> DataFrame:
    """``source, source_size`` with ``target``: sources by code point, null last,
    weigh ``weights`` in turn and share ``share`` of all sizes; a target stops at
    ``most`` times its source's size and the excess is shared anew by weight until
    none is above.  Each round is one aggregate over one row per source."""
    spark = sources.sparkSession
    ordered = sources.select("source", "source_size").orderBy(F.asc_nulls_last("source"))
    ranked = spark.createDataFrame(
        ordered.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])),
        "source string, source_size long, place long")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.col("place") % len(weights) + 1).cast("int"))
    table = saved(ranked.withColumn("weight", turn)
                  .withColumn("cap", F.col("source_size") * F.lit(float(most))), "mix-sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) >= F.col("cap")
        got = table.agg(F.sum(F.when(above, F.col("cap")).otherwise(0.0)),
                        F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
                        F.count(F.when(above, 1))).first()
        if not got[1] or got[2] == full:
            break
        full = got[2]
        level = (share * total - got[0]) / got[1]
    target = F.least(F.col("weight") * F.lit(level), F.col("cap"))
    return table.select("source", "source_size", "weight", target.alias("target"))


def _copies(docs: DataFrame, most: float) -> DataFrame:
    """Expected copies of each document: its weight times its source's level, at
    most ``most``, such that each source's expected words are its target."""
    level = docs.groupBy("source_key").agg(
        (F.max("target") / F.sum(F.col("weight") * F.col("size"))).alias("level"))
    count = -1
    while True:
        e = docs.join(level, "source_key")
        over = F.col("level") * F.col("weight") >= most
        now = e.filter(over).count()
        if now == count:
            return e.withColumn("expected", F.least(F.col("level") * F.col("weight"), F.lit(most)))
        count = now
        free = F.sum(F.when(over, 0.0).otherwise(F.col("weight") * F.col("size")))
        level = saved(e.groupBy("source_key").agg(
            ((F.max("target") - F.sum(F.when(over, F.lit(most) * F.col("size")).otherwise(0.0)))
             / F.when(free > 0, free)).alias("level"), F.max("level").alias("last"))
            .select("source_key", F.coalesce("level", "last").alias("level")), "mix-level")


def _stopped(rows: DataFrame, left: DataFrame, cell) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cut ``rows`` into cells of rank; gives the rows of cells that fit whole, the
    rows of the cell in which each source's words run out, and the words left there."""
    celled = rows.withColumn("cell", cell)
    sums = celled.groupBy("source_key", "cell").agg(F.sum("size").alias("cell_size"))
    up_to = Window.partitionBy("source_key").orderBy("cell")  # at most CELLS rows a source
    until = sums.withColumn("upto", F.sum("cell_size").over(up_to)).join(left, "source_key")
    stop = saved(until.groupBy("source_key").agg(
        F.min(F.when(F.col("upto") > F.col("left"), F.col("cell"))).alias("stop"),
        F.max("left").alias("left"),
        F.max(F.when(F.col("upto") <= F.col("left"), F.col("upto"))).alias("used")), "mix-stop")
    celled = celled.join(stop.select("source_key", "stop"), "source_key")
    whole = celled.filter(F.col("stop").isNull() | (F.col("cell") < F.col("stop")))
    edge = celled.filter(F.col("cell") == F.col("stop"))
    rest = stop.select("source_key", (F.col("left") - F.coalesce("used", F.lit(0))).alias("left"))
    return whole.drop("cell", "stop"), edge.drop("cell", "stop"), rest


def mix_sources(documents: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0),
                share: float = 1.0, most: float = 3.0, seed: int = 17,
                weight: str | None = None) -> DataFrame:
    """Per document ``doc_id, source, size, source_size, target, copies, taken`` and
    ``row_key``, a hash of the row's id, source and text.

    ``size`` counts words of the whole text (null: 0).  ``weight`` names a column of
    positive inclusion weights (null counts as 1); without it the documents of a
    source are equally likely.  A document of expected copies ``e`` is taken
    ``floor(e)`` times; the fraction ``p`` orders the rest by ``(u / (1 - u)) /
    (p / (1 - p))`` with ``u`` hashed from the row and the seed, and the order is
    followed until the source's words are closest to its target.  No document is
    taken more than ``most`` times.  Repeated rows have equal ranks and any of them
    may be the last taken; sources without words take nothing; an empty table gives
    no rows; only the named columns are used.

    A hot source is never one group: cells of rank are pre-summed, twice, and only
    the rows of the last cell (about one in ``CELLS`` squared) are ordered singly.
    """
    key = F.xxhash64("doc_id", "source", "text")
    own = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    sized = saved(documents.select(
        "doc_id", "source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key"),
        word_count().alias("size"), own.alias("weight"), key.alias("row_key")), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, share, most).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key"),
        "source_size", "target")
    docs = sized.join(targets, "source_key")
    if weight:
        docs = _copies(docs, most)
    else:
        docs = docs.withColumn("expected", F.coalesce(
            F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size")), F.lit(0.0)))
    bits = F.xxhash64(F.lit(seed), "row_key").bitwiseAND(F.lit(2 ** 53 - 1))
    u = (bits + F.lit(0.5)) / F.lit(float(2 ** 53))
    p = F.col("expected") - F.floor("expected")
    odds = (u / (1 - u)) * (1 - p) / F.when(p > 0, p)
    docs = saved(docs.withColumn("certain", F.floor("expected").cast("long"))
                 .withColumn("rank", odds / (1 + odds)), "mix-ranked")
    left = docs.groupBy("source_key").agg(
        (F.max("target") - F.sum(F.col("certain") * F.col("size"))).alias("left"))
    drawn = docs.filter(F.col("rank").isNotNull() & (F.col("size") > 0))
    first = F.floor(F.col("rank") * CELLS)
    whole, edge, left = _stopped(drawn, left, first)
    inner = F.floor((F.col("rank") * CELLS - first) * CELLS)
    more, last, left = _stopped(edge, left, inner)
    order = (Window.partitionBy("source_key").orderBy("rank", "row_key")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nearest = (last.join(left, "source_key").withColumn("upto", F.sum("size").over(order))
               .filter(F.col("upto") - F.col("size") / 2 <= F.col("left")))
    columns = ["doc_id", "source", "size", "source_size", "target", "certain", "row_key"]
    extra = [x.select(*columns, F.lit(1).alias("drawn")) for x in (whole, more, nearest)]
    taken = extra[0].unionByName(extra[1]).unionByName(extra[2])
    return _with_rest(docs, taken, columns)


def _with_rest(docs: DataFrame, taken: DataFrame, columns: list[str]) -> DataFrame:
    """All documents with their copies: equal rows share what was drawn of them."""
    hits = taken.groupBy("doc_id", "row_key").agg(F.sum("drawn").alias("drawn"))
    alike = docs.groupBy("doc_id", "row_key").agg(F.first("source").alias("source"),
                                                  *[F.first(c).alias(c) for c in columns[2:-1]],
                                                  F.count(F.lit(1)).alias("rows"))
    both = (alike.join(hits.select(F.col("doc_id").alias("hit_id"), F.col("row_key").alias("hit_key"), "drawn"),
                       F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("row_key") == F.col("hit_key")), "left"))
    each = both.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    copies = F.col("certain") + F.when(F.col("at") <= F.coalesce("drawn", F.lit(0)), 1).otherwise(0)
    return each.select("doc_id", "source", "size", "source_size", "target", "row_key",
                       copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def repeated_by_mix(documents: DataFrame, **options) -> DataFrame:
    """The rows of ``documents``, each as often as ``mix_sources`` takes it, with all columns.
    Documents without words take nothing and go.  Rows equal in id, source and text share
    their copies evenly; any of them may get one that is left over."""
    mix = mix_sources(documents, **options).filter("size > 0")
    shared = saved(mix.groupBy("row_key").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
                   .filter("_copies > 0"), "mix-copies")
    keyed = documents.withColumn("_key", F.xxhash64("doc_id", "source", "text"))
    at = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))  # equal rows only
    times = F.floor(F.col("_copies") / F.col("_rows")) + F.when(F.col("_at") <= F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    return (keyed.join(shared, keyed._key == shared.row_key).withColumn("_at", at)
            .withColumn("_times", times.cast("int")).filter("_times > 0")
            .withColumn("_time", F.explode(F.sequence(F.lit(1), "_times"))).select(*documents.columns))
