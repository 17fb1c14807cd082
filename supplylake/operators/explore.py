"""Distribution profiling over a summary table.

Everything is computed as aggregates over the frame, reshaped into long
``(column, ...)`` form with ``stack``/``unpivot``.  Multi-column statistics
are one wide aggregate (one scan), never one job per column.  Quantiles are
exact with linear interpolation (as pandas); those of whole columns select from
brackets, those of groups come from a distributed sort (``quantiles``).
``approx=True`` switches to ``percentile_approx``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.semantics import (
    clip_keep_null, cut_right, nan_to_null, round_ieee,
)
from ..session import checkpoint_root
from .quantiles import column_quantiles, quantiles, quantiles_long

# The notebook's outlier-removal columns (order matters: the
# bounds of each are computed on the frame already filtered by the previous).
IQR_COLUMNS = ["PurchasePrice", "TotalPurchaseDollars", "TotalSalesDollars",
               "VendorTotalFreight", "GrossProfit", "StockTurnover"]
# Ratio caps applied after outlier removal.
RATIO_CAPS = {"ProfitMargin": (-50, 150), "GrossMarginPct": (-50, 150), "SellThroughRatio": (0, 5)}
# Price columns that get ``<col>_log`` copies.
PRICE_COLUMNS = ["PurchasePrice", "ReferencePurchasePrice", "AvgSalesPrice", "AvgSalesPrice_imputed"]
# Notebook volume categories (upper bounds in ml, right-closed).
NOTEBOOK_VOLUME_EDGES = [200, 500, 1000, 2000]
NOTEBOOK_VOLUME_LABELS = ["Mini (≤200ml)", "Half (200-500ml)", "Standard (750ml-1L)",
                          "Large (1-2L)", "XL (>2L)"]
# Margin tiers on GrossProfit.
MARGIN_TIER_EDGES = [10, 100]
MARGIN_TIER_LABELS = ["Low Profit (<$10)", "Medium Profit ($10-100)", "High Profit (>$100)"]
# Metrics tested for normality.
NORMALITY_COLUMNS = ["GrossProfit", "ProfitMargin", "StockTurnover", "SellThroughRatio"]


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of numeric type, in frame order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _v(c: str):
    return nan_to_null(F.col(c).cast("double"))


def _quantiles(c, ps: Sequence[float], approx: bool):
    if approx:
        return F.percentile_approx(c, list(ps), 10000)
    return F.percentile(c, [float(p) for p in ps])


def _long(wide: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Reshape ``<field>_<i>`` columns of a one-row frame into one row per column."""
    parts = ", ".join(
        ", ".join([f"'{c}'"] + [f"`{fld}_{i}`" for fld in fields]) for i, c in enumerate(cols))
    names = ", ".join(["column", *fields])
    return wide.selectExpr(f"stack({len(cols)}, {parts}) AS ({names})")


# ---------------------------------------------------------------- counts

def distinct_counts(df: DataFrame) -> DataFrame:
    """Distinct vendors and brands."""
    return df.agg(F.count_distinct("VendorNumber").alias("vendors"),
                  F.count_distinct("Brand").alias("brands"), F.count(F.lit(1)).alias("rows"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A9."""
    return df.select(col).distinct()


def min_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Min and max per column (NaN skipped)."""
    wide = df.agg(*[a for i, c in enumerate(cols)
                    for a in (F.min(_v(c)).alias(f"min_{i}"), F.max(_v(c)).alias(f"max_{i}"))])
    return _long(wide, cols, ["min", "max"])


# ---------------------------------------------------------------- describe / quantiles

def describe(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Count, mean, std, min, 25/50/75 %, max per numeric column: one
    wide aggregate plus one distributed quantile sort over all columns."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for i, c in enumerate(cols):
        v = _v(c)
        aggs += [F.count(v).alias(f"count_{i}"), F.avg(v).alias(f"mean_{i}"),
                 F.stddev_samp(v).alias(f"std_{i}"), F.min(v).alias(f"min_{i}"),
                 F.max(v).alias(f"max_{i}")]
    moments = _long(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    q = _column_quantiles(df, cols, [0.25, 0.5, 0.75], ["q25", "q50", "q75"], approx)
    return (moments.join(q, "column", "left")
            .select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"))


def _column_quantiles(df: DataFrame, cols: Sequence[str], probs, names, approx: bool) -> DataFrame:
    """(column, <names>) for every column that has values: exact, by bracketed
    selection, or ``percentile_approx`` when ``approx``."""
    if not approx:
        return quantiles_long(df.select(*[_v(c).alias(c) for c in cols]), cols, probs, names).drop("n")
    aggs = []
    for i, c in enumerate(cols):
        q = _quantiles(_v(c), probs, True)
        aggs += [q[j].alias(f"{n}_{i}") for j, n in enumerate(names)]
    return _long(df.agg(*aggs), cols, list(names))


def iqr_bounds(df: DataFrame, cols: Sequence[str], factor: float = 3.0,
               approx: bool = False) -> DataFrame:
    """A16 + X1: Q1, Q3, IQR and the fences Q1 - f*IQR, Q3 + f*IQR per column."""
    long = _column_quantiles(df, cols, [0.25, 0.75], ["q1", "q3"], approx)
    iqr = F.col("q3") - F.col("q1")
    return long.select("column", "q1", "q3", iqr.alias("iqr"),
                       (F.col("q1") - F.lit(float(factor)) * iqr).alias("lower"),
                       (F.col("q3") + F.lit(float(factor)) * iqr).alias("upper"))


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir`` (cuts
    lineage; survives executor loss, unlike a local checkpoint)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_outliers_iqr(df: DataFrame, column: str, factor: float = 3.0,
                        approx: bool = False) -> DataFrame:
    """X1 applied: keep rows with lower <= x <= upper (NULL rows drop)."""
    if approx:
        q = df.select(_quantiles(_v(column), [0.25, 0.75], True).alias("q")).first()["q"]
    else:
        found = column_quantiles(df.select(_v(column).alias("v")), ["v"], [0.25, 0.75])
        q = found["v"][1] if found else None
    if q is None or q[0] is None:
        return df.where(F.lit(False))
    q1, q3 = float(q[0]), float(q[1])
    iqr = q3 - q1
    lo, hi = q1 - factor * iqr, q3 + factor * iqr
    v = _v(column)
    return df.where((v >= F.lit(lo)) & (v <= F.lit(hi)))


def iqr_filter(df: DataFrame, cols: Sequence[str] = IQR_COLUMNS, factor: float = 3.0,
               caps: dict = RATIO_CAPS, approx: bool = False,
               materialize_input: bool = True) -> DataFrame:
    """X2 + X3: sequential IQR removal (bounds recomputed on the already
    filtered frame, in column order), then ratio caps.

    The input is checkpointed once (skip with ``materialize_input=False`` when
    it already is a stored table); each step is one small quantile job over
    the filtered input, and only two numbers per step reach the driver.
    """
    cur = materialize(df) if materialize_input else df
    for c in cols:
        cur = remove_outliers_iqr(cur, c, factor, approx)
    return cur.withColumns({c: clip_keep_null(c, lo, hi) for c, (lo, hi) in caps.items()
                            if c in cur.columns})


def outlier_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before/after, removed and removed %; both counts in one plan."""
    n0 = before.select(F.count(F.lit(1))).scalar()
    n1 = after.select(F.count(F.lit(1))).scalar()
    return before.sparkSession.range(1).select(
        n0.alias("original_rows"), n1.alias("remaining_rows"), (n0 - n1).alias("removed_rows"),
        ((F.lit(1.0) - n1 / n0) * 100).alias("removed_pct"))


def log_prices(df: DataFrame, cols: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """``<col>_log = log1p(col)``; log1p(x < -1) is NULL (numpy: NaN)."""
    return df.withColumns({f"{c}_log": F.when(_v(c) >= -1, F.log1p(_v(c))) for c in cols
                           if c in df.columns})


def volume_categories(df: DataFrame, col: str = "Volume") -> DataFrame:
    """notebook bottle-size categories (NULL fails every test -> last label)."""
    v = F.col(col)
    expr = None
    for edge, label in zip(NOTEBOOK_VOLUME_EDGES, NOTEBOOK_VOLUME_LABELS):
        cond = v <= F.lit(float(edge))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn("VolumeCategory", expr.otherwise(F.lit(NOTEBOOK_VOLUME_LABELS[-1])))


def profit_tiers(df: DataFrame, col: str = "GrossProfit") -> DataFrame:
    """MarginTier = pd.cut(GrossProfit, [-inf, 10, 100, inf])."""
    return df.withColumn("MarginTier", cut_right(col, MARGIN_TIER_EDGES, MARGIN_TIER_LABELS))


def margin_tiers(df: DataFrame) -> DataFrame:
    """Per tier count(Brand), mean PurchasePrice, median Volume, mean
    ProfitMargin, mean StockTurnover, rounded 2; empty tiers listed with 0."""
    t = profit_tiers(df) if "MarginTier" not in df.columns else df
    tt = t.where(F.col("MarginTier").isNotNull())
    g = tt.groupBy("MarginTier").agg(
        F.count("Brand").alias("Brand"),
        F.avg(_v("PurchasePrice")).alias("PurchasePrice"),
        F.avg(_v("ProfitMargin")).alias("ProfitMargin"),
        F.avg(_v("StockTurnover")).alias("StockTurnover"))
    med = quantiles(tt, _v("Volume"), [0.5], ["MarginTier"], ["Volume"]).drop("n")
    g = g.join(med, "MarginTier", "left")
    spark = df.sparkSession
    tiers = spark.createDataFrame([(i, lab) for i, lab in enumerate(MARGIN_TIER_LABELS)],
                                  "tier_order INT, MarginTier STRING")
    j = tiers.join(g, "MarginTier", "left")
    return j.select("tier_order", "MarginTier",
                    F.coalesce(F.col("Brand"), F.lit(0)).alias("Brand"),
                    *[round_ieee(c, 2).alias(c) for c in
                      ("PurchasePrice", "Volume", "ProfitMargin", "StockTurnover")])


# ---------------------------------------------------------------- histogram / box

def _unpivot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return (df.select(*[_v(c).alias(c) for c in cols])
            .unpivot([], list(cols), "column", "value"))


def histogram(df: DataFrame, cols: Sequence[str] | None = None, bins: int = 30) -> DataFrame:
    """Equal-width bins between each column's min and max; the max lands
    in the last bin.  Rows are widened to (column, value) and counted with a
    partial aggregate, so the shuffle carries at most cols x bins rows per task."""
    cols = list(cols or numeric_columns(df))
    long = _unpivot(df, cols).where(F.col("value").isNotNull())
    mm = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = long.join(F.broadcast(mm), "column")  # one row per column: bounded by len(cols)
    width = F.col("hi") - F.col("lo")
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width * F.lit(float(bins))) + 1,
                F.lit(bins)))
    return (j.groupBy("column", "lo", "hi", b.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select("column", "bin",
                    (F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"),
                    "count"))


def box_stats(df: DataFrame, cols: Sequence[str] | None = None, whisker: float = 1.5,
              approx: bool = False) -> DataFrame:
    """Quartiles, whisker ends (most extreme values inside the 1.5 IQR
    fences) and flier counts per column."""
    cols = list(cols or numeric_columns(df))
    long = _unpivot(df, cols).where(F.col("value").isNotNull())
    q = _column_quantiles(df, cols, [0.25, 0.5, 0.75], ["q1", "median", "q3"], approx)
    q = q.withColumns({"lo_fence": F.col("q1") - whisker * (F.col("q3") - F.col("q1")),
                       "hi_fence": F.col("q3") + whisker * (F.col("q3") - F.col("q1"))})
    j = long.join(F.broadcast(q), "column")  # one row per column
    v = F.col("value")
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    return j.groupBy("column", "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("fliers"))


# ---------------------------------------------------------------- correlation

def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson r on pairwise-complete rows, long form (col_a, col_b, corr)
    for every ordered pair including the diagonal.

    Two passes: means and numbers of values (2k scalars), then one aggregate of sums of
    values shifted by the means, so that ``sxy - sx*sy/n`` does not cancel
    catastrophically.  A pair's sums are over rows where both columns have values; sums
    over a column that has all its values are shared by its pairs.  A constant column
    gives NULL (pandas NaN), where ``corr`` would raise DIVIDE_BY_ZERO under ANSI.
    """
    cols = list(cols or numeric_columns(df))
    clean = df.select(*[_v(c).alias(c) for c in cols])
    row = clean.agg(F.count(F.lit(1)).alias("rows"), *[a for i, c in enumerate(cols) for a in (
        F.avg(c).alias(f"m{i}"), F.count(c).alias(f"n{i}"))]).first()
    gaps = [row[f"n{i}"] < row["rows"] for i in range(len(cols))]
    shifted = clean.select(*[(F.col(f"`{c}`") - F.lit(row[f"m{i}"] if row[f"m{i}"] is not None else 0.0)).alias(f"x{i}")
                             for i, c in enumerate(cols)])
    sums: dict[str, F.Column] = {}

    def total(name: str, value) -> F.Column:
        sums.setdefault(name, F.sum(value).alias(name))
        return F.col(name)

    def masked(i: int, j: int, power: int) -> F.Column:
        """The sum of a power of column i where column j has a value."""
        x = F.col(f"x{i}") * F.col(f"x{i}") if power == 2 else F.col(f"x{i}")
        if gaps[j] and i != j:
            return total(f"s{power}_{i}_{j}", F.when(F.col(f"x{j}").isNotNull(), x))
        return total(f"s{power}_{i}", x)

    def number(i: int, j: int) -> F.Column:
        there = [k for k in sorted({i, j}) if gaps[k]]
        present = F.lit(True)
        for k in there:
            present = present & F.col(f"x{k}").isNotNull()
        return total("n" + "".join(f"_{k}" for k in there), F.when(present, 1.0))

    pairs = []
    for i in range(len(cols)):
        for j in range(len(cols)):
            a, b = min(i, j), max(i, j)
            n, sx, sy = number(i, j), masked(i, j, 1), masked(j, i, 1)
            vx, vy = (s2 - s1 * s1 / n for s2, s1 in ((masked(i, j, 2), sx), (masked(j, i, 2), sy)))
            cov = total(f"p_{a}_{b}", F.col(f"x{a}") * F.col(f"x{b}")) - sx * sy / n
            r = F.when((n >= 2) & (vx > 0) & (vy > 0), cov / F.sqrt(vx * vy))
            pairs.append((cols[i], cols[j], nan_to_null(r)))
    wide = shifted.agg(*sums.values())
    return wide.select(F.inline(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), r.alias("corr"))
                                          for a, b, r in pairs])))


def corr_pairs(matrix: DataFrame, low: float = 0.95, high: float = 1.0) -> DataFrame:
    """Pairs with low < r < high (exactly 1.0 excluded, as coded)."""
    return matrix.where((F.col("corr") > low) & (F.col("corr") < high)
                        & (F.col("col_a") != F.col("col_b")))


# ---------------------------------------------------------------- categories / shares

def top_categories(df: DataFrame, cols: Sequence[str] = ("VendorName", "Description"),
                   n: int = 10) -> DataFrame:
    """The n most frequent values per column (ties by value)."""
    out = None
    for c in cols:
        t = (df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).count()
             .orderBy(F.desc("count"), F.asc("value")).limit(n)
             .select(F.lit(c).alias("column"), "value", "count"))
        out = t if out is None else out.unionByName(t)
    return out


def round_number_pct(df: DataFrame, cols: Sequence[str] = ("TotalPurchaseDollars", "TotalSalesDollars")) -> DataFrame:
    """Share of rows whose value is a whole number, % of all rows."""
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if((_v(c) % 1) == 0).alias(f"k_{i}") for i, c in enumerate(cols)])
    long = _long(wide.select(*[F.col(f"k_{i}").alias(f"k_{i}") for i in range(len(cols))],
                             *[F.col("_n").alias(f"n_{i}") for i in range(len(cols))]),
                 cols, ["k", "n"])
    return long.select("column", (F.col("k") / F.col("n") * 100).alias("round_pct"))


def normality(df: DataFrame, cols: Sequence[str] = NORMALITY_COLUMNS, alpha: float = 0.05) -> DataFrame:
    """X8 (re-aimed): Jarque-Bera from population skewness and excess
    kurtosis over all non-null rows; p = exp(-JB/2) (chi-square, 2 dof)."""
    aggs = []
    for i, c in enumerate(cols):
        v = _v(c)
        aggs += [F.count(v).alias(f"n_{i}"), F.skewness(v).alias(f"skew_{i}"),
                 F.kurtosis(v).alias(f"kurt_{i}")]
    long = _long(df.agg(*aggs), cols, ["n", "skew", "kurt"])
    jb = F.col("n") / 6.0 * (F.col("skew") * F.col("skew") + F.col("kurt") * F.col("kurt") / 4.0)
    return long.select("column", "n", "skew", F.col("kurt").alias("excess_kurtosis"),
                       jb.alias("jb"), F.exp(-jb / 2.0).alias("p_value"),
                       (F.exp(-jb / 2.0) > alpha).alias("normal"))
