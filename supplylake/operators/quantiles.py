"""Exact quantiles without a per-group single task.

``percentile``/``median`` merge one value->count map per group in one task,
so a group holding a third of all rows (or a global quantile, which is one
group) lands whole on one executor.  Here, at every size, the work is a
distributed sort:

1. rows collapse to (group, value, count), map-side first, so a hot value is
   one row;
2. these are range-partitioned by (group, value), which splits a hot group
   over many partitions, and written once to the shared folder with the
   number of their partition, so that both uses below see the same blocks;
3. a small table of per-(group, partition) counts gives, by a running sum
   over at most #partitions rows per group, the rank at which a block starts;
   ranks inside a block are a running count of the block alone;
4. only values that hold a rank needed are kept and interpolated.

The interpolation is Spark's ``percentile`` rule: position p = (n-1)q,
``(ceil-p)*lower + (p-floor)*upper`` (the lower value when both ranks hold
equal values), so results equal the built-in exactly.  NULL and NaN values
are skipped; rows with a NULL group key are dropped (pandas groupby).

Quantiles of whole columns (``column_quantiles``) do not sort the input: mergeable
sketches bracket each rank from both sides, one pass counts what lies below a bracket
and keeps the values inside, and only these, a small share of the rows, are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: A sketch errs by at most one in so many ranks; brackets reach twice as far.
ACCURACY = 500


def sorted_blocks(base: DataFrame, keys: Sequence[str], counted: bool = False) -> DataFrame:
    """``keys..., _v, _c`` (value, count) in stored range partitions ``_pid``; with
    ``counted`` the rows are such already."""
    counted = base if counted else base.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    blocks = (counted.repartitionByRange(*[F.col(k) for k in keys], F.col("_v"))
              .withColumn("_pid", F.spark_partition_id()))
    return stored(blocks, "quantiles")


def ranked_values(base: DataFrame, gk: Sequence[str], counted: bool = False) -> DataFrame:
    """The distinct values ``_v`` of each group with the first and last rank they hold
    (``_first``, ``_last``, from 0) and the group's size ``_n``."""
    s = sorted_blocks(base, gk, counted)
    before = Window.partitionBy(*gk).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = s.groupBy(*gk, "_pid").agg(F.sum("_c").alias("_cnt"))
    blocks = (blocks.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
              .withColumn("_n", F.sum("_cnt").over(Window.partitionBy(*gk))))
    inside = Window.partitionBy(*gk, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (s.withColumn("_upto", F.sum("_c").over(inside)).join(blocks, [*gk, "_pid"])
            .withColumn("_last", F.col("_before") + F.col("_upto") - 1)
            .withColumn("_first", F.col("_before") + F.col("_upto") - F.col("_c")))


def quantiles(df: DataFrame, value, probs: Sequence[float], keys: Sequence[str] = (),
              names: Sequence[str] | None = None) -> DataFrame:
    """One row per group: ``keys..., n, <name_i>`` for each probability."""
    keys = list(keys)
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    gk = keys or ["_g"]
    base = df.select(*[F.col(k) for k in keys], v.alias("_v"))
    if not keys:
        base = base.withColumn("_g", F.lit(0))
    cond = F.col("_v").isNotNull() & ~F.isnan("_v")
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    ranked = ranked_values(base.where(cond), gk)
    pos = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]

    def holds(rank):
        return rank.between(F.col("_first"), F.col("_last"))

    want = F.lit(False)
    for p in pos:
        want = want | holds(F.floor(p)) | holds(F.ceil(p))
    aggs = [F.first("_n").alias("n")]
    for i, p in enumerate(pos):
        aggs += [F.max(F.when(holds(F.floor(p)), F.col("_v"))).alias(f"_lo{i}"),
                 F.max(F.when(holds(F.ceil(p)), F.col("_v"))).alias(f"_hi{i}"),
                 F.first(p).alias(f"_pos{i}")]
    g = ranked.where(want).groupBy(*gk).agg(*aggs)
    outs = []
    for i, name in enumerate(names):
        lo, hi, p = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_pos{i}")
        fl, ce = F.floor(p).cast("double"), F.ceil(p).cast("double")
        outs.append(F.when((fl == ce) | (lo == hi), lo)
                    .otherwise((ce - p) * lo + (p - fl) * hi).alias(name))
    return g.select(*keys, "n", *outs)


def interpolated(position: float, low: float, high: float) -> float:
    """Spark's ``percentile`` rule, in the same operations."""
    down, up = math.floor(position), math.ceil(position)
    return low if down == up or low == high else (up - position) * low + (position - down) * high


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, tuple[int, list[float]]]:
    """Exact quantiles of each column's values (NULL and NaN skipped): its number of values
    and a quantile for each probability; columns without values are left out.

    Pass 1 sketches all columns; pass 2 counts what lies below the brackets and keeps what
    lies inside; the sort holds at most about ``4 / ACCURACY`` of the rows a quantile.
    """
    v = [F.col(f"`{c}`").cast("double") for c in cols]
    base = df.select(*[F.when(~F.isnan(x), x).alias(f"c{i}") for i, x in enumerate(v)])
    reach = 2 / ACCURACY
    ends = [max(0.0, p - reach) for p in probs] + [min(1.0, p + reach) for p in probs]
    aggs = []
    for i in range(len(cols)):
        c = F.col(f"c{i}")
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"),
                 F.percentile_approx(c, ends, ACCURACY).alias(f"q{i}")]
    r = base.agg(*aggs).first()
    brackets, places = {}, {}
    for i in range(len(cols)):
        n = r[f"n{i}"]
        for j, p in enumerate(probs if n else ()):
            few = n < 4 * ACCURACY  # where a rank is more than the sketch's margin, take every value
            low = r[f"lo{i}"] if few or ends[j] == 0 else r[f"q{i}"][j]
            high = r[f"hi{i}"] if few or ends[len(probs) + j] == 1 else r[f"q{i}"][len(probs) + j]
            brackets[i, j], places[i, j] = (low, high), (n - 1) * float(p)
    found = _selected(base, brackets, places)
    out = {}
    for i, c in enumerate(cols):
        if r[f"n{i}"]:
            out[c] = r[f"n{i}"], [interpolated(places[i, j], *found[i, j]) for j in range(len(probs))]
    return out


def _selected(base: DataFrame, brackets: dict, places: dict) -> dict[tuple[int, int], tuple[float, float]]:
    """The values at the two ranks around each place, looked for in its bracket."""
    if not brackets:
        return {}
    # One small expression for the cells of all columns: one for each bracket makes a method
    # too long for the JVM to compile.
    listed = base.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"))
        for (i, j), (low, high) in brackets.items()])))
    cells = base.select(F.posexplode(F.array(*base.columns)).alias("i", "x")).where(F.col("x").isNotNull())
    # a row below a bracket becomes a NULL, which the partial aggregate counts
    hits = (cells.join(F.broadcast(listed), "i")  # the driver's own list of brackets
            .where(F.col("x") <= F.col("high")).select("i", "j", F.when(F.col("x") >= F.col("low"), F.col("x")).alias("_v")))
    counted = stored(hits.groupBy("i", "j", "_v").agg(F.count(F.lit(1)).alias("_c")), "quantile_brackets")
    below = {(r.i, r.j): r["_c"] for r in counted.where(F.col("_v").isNull()).collect()}  # one row a bracket
    values = counted.where(F.col("_v").isNotNull())
    want, ranks = F.lit(False), {}
    for (i, j), at in places.items():
        ranks[i, j] = math.floor(at) - below.get((i, j), 0), math.ceil(at) - below.get((i, j), 0)
        mine = (F.col("i") == i) & (F.col("j") == j)
        for rank in set(ranks[i, j]):
            want = want | (mine & F.lit(rank).between(F.col("_first"), F.col("_last")))
    ranked = ranked_values(values, ["i", "j"], counted=True)
    rows = ranked.where(want).select("i", "j", "_v", "_first", "_last").collect()  # at most two a bracket
    return {key: tuple(next(r["_v"] for r in rows if (r.i, r.j) == key and r["_first"] <= rank <= r["_last"]) for rank in pair)
            for key, pair in ranks.items()}


def quantiles_long(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   names: Sequence[str] | None = None) -> DataFrame:
    """``column, n, <names>`` for each column that has values."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    rows = [(c, n, *qs) for c, (n, qs) in column_quantiles(df, cols, probs).items()]
    schema = "column string, n long, " + ", ".join(f"`{x}` double" for x in names)
    return df.sparkSession.createDataFrame(rows, schema)


def median_scalar(df: DataFrame, value):
    """A global exact median as a scalar-subquery Column."""
    return quantiles(df, value, [0.5], names=["m"]).select("m").scalar()
