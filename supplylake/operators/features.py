"""The 23 ML features (E1-E23) over a vendor x brand summary.

Each layer is a ``DataFrame -> DataFrame`` step adding ``feat_*`` columns in
one projection.  Per-vendor statistics are a partial+final aggregate joined
back on the vendor key; global mean/std are scalar subqueries (never a
window without keys, which would run in a single task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.semantics import (
    bool_int, cut_right, exact_sum, lower_clip, nan_to_null, safe_ratio,
)

REQUIRED = [
    "VendorNumber", "Brand", "PurchasePrice", "ActualPrice", "Volume",
    "TotalPurchaseQuantity", "TotalPurchaseDollars", "TotalSalesQuantity",
    "TotalSalesDollars", "GrossProfit", "ProfitMargin", "StockTurnover",
]

# Profit-tier cut points and labels.
PROFIT_TIER_EDGES = [0, 15, 35]
PROFIT_TIER_LABELS = ["loss", "low", "medium", "high"]

# Bottle-size categories (upper bounds in ml, right-closed).
VOLUME_EDGES = [200, 500, 750, 1500]
VOLUME_LABELS = ["mini", "half", "standard", "large", "magnum"]


class FeatureInputError(ValueError):
    pass


def validate_input(df: DataFrame, required=REQUIRED, min_rows: int = 1) -> None:
    """Rows first, then columns (the reference's decorator order)."""
    if df.limit(min_rows).count() < min_rows:
        raise FeatureInputError(f"Input DataFrame has 0 rows; need at least {min_rows}")
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise FeatureInputError(f"Input DataFrame is missing columns: {missing}")


def _opt(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(0.0)


def profitability(df: DataFrame) -> DataFrame:
    gp = F.col("GrossProfit")
    return df.withColumns({
        "feat_profit_per_unit": safe_ratio(gp, "TotalSalesQuantity"),
        "feat_profit_tier": cut_right("ProfitMargin", PROFIT_TIER_EDGES, PROFIT_TIER_LABELS),
        "feat_net_profit_after_freight": gp - _opt(df, "FreightCost"),
        "feat_is_profitable": bool_int(gp > 0),
    })


def volume_category(c) -> F.Column:
    """Feature version: a NULL volume fails every test and lands in the last label."""
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for edge, label in zip(VOLUME_EDGES, VOLUME_LABELS):
        cond = c <= F.lit(float(edge))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(VOLUME_LABELS[-1]))


def volume(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "feat_volume_category": volume_category("Volume"),
        "feat_quantity_ratio": safe_ratio("TotalSalesQuantity", "TotalPurchaseQuantity"),
        "feat_demand_velocity": safe_ratio("TotalSalesDollars", "Volume"),
    })


def pricing(df: DataFrame) -> DataFrame:
    gap = F.col("ActualPrice").cast("double") - F.col("PurchasePrice").cast("double")
    return df.withColumn("feat_price_gap", gap).withColumns({
        "feat_price_gap_pct": safe_ratio("feat_price_gap", "PurchasePrice", 100),
        "feat_price_competitiveness": safe_ratio("PurchasePrice", "ActualPrice"),
        "feat_excise_burden": safe_ratio(_opt(df, "TotalExciseTax"), "TotalSalesDollars", 100),
    })


def inventory(df: DataFrame) -> DataFrame:
    rate = safe_ratio("TotalSalesQuantity", "TotalPurchaseQuantity", 100)
    return df.withColumn("feat_sell_through_rate", rate).withColumns({
        "feat_overstock_flag": bool_int(F.col("feat_sell_through_rate") < 50),
        "feat_revenue_per_purchase_dollar": safe_ratio("TotalSalesDollars", "TotalPurchaseDollars"),
    })


def vendor_stats(df: DataFrame) -> DataFrame:
    """One row per non-null vendor (pandas groupby drops NULL keys)."""
    return (df.where(F.col("VendorNumber").isNotNull())
            .groupBy("VendorNumber")
            .agg(F.count_distinct("Brand").alias("feat_vendor_brand_count"),
                 F.coalesce(exact_sum("TotalSalesDollars"), F.lit(0.0))
                  .alias("feat_vendor_total_revenue"),
                 F.avg(nan_to_null("ProfitMargin")).alias("feat_vendor_avg_margin"),
                 F.count(F.lit(1)).alias("_vendor_rows")))


def vendor_aggregates(df: DataFrame) -> DataFrame:
    """E15-E18 (+ E23's numerator): vendor aggregate merged back by key."""
    vs = vendor_stats(df).withColumnRenamed("VendorNumber", "_vkey")
    j = df.join(vs, df.VendorNumber == vs._vkey, "left").drop("_vkey")
    return j.withColumn("feat_vendor_revenue_share",
                        safe_ratio("TotalSalesDollars", "feat_vendor_total_revenue", 100))


def global_moments(df: DataFrame, col: str):
    """Mean and sample std of ``col`` (NaN skipped, as pandas) as scalar
    subqueries: one merged one-row aggregate, no keyless window, no join."""
    v = nan_to_null(col)
    return df.select(F.avg(v)).scalar(), df.select(F.stddev_samp(v)).scalar()


def statistical(df: DataFrame) -> DataFrame:
    gp = F.col("GrossProfit").cast("double")
    mean, std = global_moments(df, "ProfitMargin")
    # an infinite margin makes the deviation NaN, which Spark orders above every number
    z = F.when(nan_to_null(std) > 0, (F.col("ProfitMargin") - mean) / std).otherwise(F.lit(0.0))
    return df.withColumns({
        "feat_log_sales": F.log1p(lower_clip("TotalSalesDollars", 0.0)),
        "feat_log_purchases": F.log1p(lower_clip("TotalPurchaseDollars", 0.0)),
        "feat_log_profit": F.log1p(F.abs(gp)) * F.signum(gp),
        "feat_zscore_profit_margin": z,
    })


def categorical(df: DataFrame) -> DataFrame:
    """Share of rows belonging to the row's vendor (NULL vendor -> NULL)."""
    if "_vendor_rows" not in df.columns:
        vs = vendor_stats(df).select(F.col("VendorNumber").alias("_vkey"), "_vendor_rows")
        df = df.join(vs, df.VendorNumber == vs._vkey, "left").drop("_vkey")
    with_vendor = df.select(F.count("VendorNumber")).scalar()
    return (df.withColumn("feat_vendor_frequency",
                          F.when(F.col("VendorNumber").isNotNull(),
                                 F.col("_vendor_rows") / with_vendor))
            .drop("_vendor_rows"))


LAYERS = [profitability, volume, pricing, inventory, vendor_aggregates, statistical, categorical]


def build_features(df: DataFrame, check: bool = True) -> DataFrame:
    """All 23 features; existing ``feat_*`` columns are dropped first (idempotent)."""
    if check:
        validate_input(df)
    df = df.drop(*[c for c in df.columns if c.startswith("feat_")])
    for layer in LAYERS:
        df = layer(df)
    return df


def feature_columns(df: DataFrame) -> list[str]:
    """The ``feat_`` columns."""
    return [c for c in df.columns if c.startswith("feat_")]


def numeric_features(df: DataFrame) -> DataFrame:
    """Numeric ``feat_`` columns only."""
    keep = [f.name for f in df.schema.fields
            if f.name.startswith("feat_") and isinstance(f.dataType, T.NumericType)]
    return df.select(*keep)
