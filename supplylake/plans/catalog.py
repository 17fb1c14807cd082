"""Registry of named queries: Spark builder + independent oracle SQL.

Each Spark builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame
over the whole given tables.  ``ORACLE`` holds the DuckDB statement for the
same result; keys without one are checked by row count only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.semantics import round_ieee
from ..operators import consistency as CO
from ..operators import explore as EX
from ..operators import features as FE
from ..operators import impute as IM
from ..operators import quality as DQ
from ..operators import summary as S
from ..session import scratch_path, stored
from ..sinks import digests as DG
from ..sinks import folders
from ..sinks import loading as LD
from ..sinks import tables as TB
from ..sources import files as FS
from ..sources.star import read_table
from ..streaming import streams as ST
from ..streaming import sync as SY
from . import oracle as O
from .tables import landed, stage_table, stored_star

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.bigint_counts(sql)
        return fn
    return deco


# ------------------------------------------------------------------ summaries

@register("vendor_summary", O.q(O.SUMMARY_CLEAN, "SELECT * FROM vendor_summary"))
def _vendor_summary(spark, sf_dir):
    return S.vendor_summary(stored_star(spark, sf_dir))


@register("vendor_summary_raw", O.q(O.SUMMARY_RAW, "SELECT * FROM vendor_summary_raw"))
def _vendor_summary_raw(spark, sf_dir):
    return S.vendor_summary_raw(stored_star(spark, sf_dir))


@register("clean_summary", O.q(O.SUMMARY_CLEAN, "SELECT * FROM clean_summary"))
def _clean_summary(spark, sf_dir):
    return S.clean_summary(S.vendor_summary_raw(stored_star(spark, sf_dir)))


@register("freight_summary", O.q(O.STAR, """
SELECT VendorNumber, CAST(SUM(Freight) AS DOUBLE) AS FreightCost
FROM vendor_invoice GROUP BY VendorNumber"""))
def _freight_summary(spark, sf_dir):
    fs = S.freight_summary(stored_star(spark, sf_dir).vendor_invoice)
    return fs.withColumn("FreightCost", fs.FreightCost.cast("double"))


@register("purchase_summary", O.q(O.SUMMARY_RAW, """
SELECT * EXCLUDE (units, spent) REPLACE (CAST(PurchasePrice AS DOUBLE) AS PurchasePrice, CAST(ActualPrice AS DOUBLE) AS ActualPrice),
       CAST(units AS BIGINT) AS TotalPurchaseQuantity, CAST(spent AS DOUBLE) AS TotalPurchaseDollars
FROM priced"""))
def _purchase_summary(spark, sf_dir):
    ps = S.purchase_summary(stored_star(spark, sf_dir))
    return ps.withColumns({c: ps[c].cast("double") for c in
                           ("PurchasePrice", "ActualPrice", "TotalPurchaseDollars")})


@register("sales_summary", O.q(O.SUMMARY_RAW, f"""
SELECT VendorNo, Brand, CAST(units_out AS BIGINT) AS TotalSalesQuantity,
       {O.doubles({'TotalSalesDollars': 'revenue', 'TotalSalesPrice': 'price_sum', 'TotalExciseTax': 'excise'})}
FROM sold"""))
def _sales_summary(spark, sf_dir):
    ss = S.sales_summary(stored_star(spark, sf_dir).sales, "sum")
    return ss.withColumns({c: ss[c].cast("double") for c in
                           ("TotalSalesDollars", "TotalSalesPrice", "TotalExciseTax")})


@register("eda_summary", O.q(O.EDA, "SELECT * FROM eda_summary"))
def _eda_summary(spark, sf_dir):
    return S.eda_summary(stored_star(spark, sf_dir))


@register("brand_purchases", O.q(O.BRAND, "SELECT * FROM brand_purchases"))
def _brand_purchases(spark, sf_dir):
    return S.brand_purchases(stored_star(spark, sf_dir))


@register("brand_sales", O.q(O.BRAND, "SELECT * FROM brand_sales"))
def _brand_sales(spark, sf_dir):
    return S.brand_sales(stored_star(spark, sf_dir))


@register("brand_summary", O.q(O.BRAND, "SELECT * FROM brand_summary"))
def _brand_summary(spark, sf_dir):
    return S.brand_summary(stored_star(spark, sf_dir))


@register("brand_summary_top", O.q(O.BRAND, """
SELECT * FROM brand_summary
ORDER BY EstimatedGrossProfit DESC NULLS LAST, TotalSalesRevenue DESC NULLS LAST,
         VendorNumber, Brand, VendorName
LIMIT 20"""))
def _brand_summary_top(spark, sf_dir):
    return S.brand_summary_top(S.brand_summary(stored_star(spark, sf_dir), ordered=False))


@register("top_vendors", O.q(O.SUMMARY_CLEAN, """
SELECT * FROM vendor_summary
ORDER BY TotalPurchaseDollars DESC, VendorNumber, Brand, Description, PurchasePrice
LIMIT 10"""))
def _top_vendors(spark, sf_dir):
    return S.top_vendors(S.vendor_summary(stored_star(spark, sf_dir), ordered=False))


@register("vendor_slice", O.q(O.STAR, """
SELECT Brand, CAST(PurchasePrice AS DOUBLE) AS PurchasePrice,
       CAST(SUM(Quantity) AS BIGINT) AS Quantity, CAST(SUM(Dollars) AS DOUBLE) AS Dollars
FROM purchases WHERE VendorNumber = 7
GROUP BY Brand, PurchasePrice"""))
def _vendor_slice(spark, sf_dir):
    return S.vendor_slice(stored_star(spark, sf_dir), 7)


@register("vendor_brand_sums", O.q(O.STAR, """
SELECT VendorNo, Brand, CAST(SUM(SalesDollars) AS DOUBLE) AS SalesDollars,
       CAST(SUM(SalesPrice) AS DOUBLE) AS SalesPrice, CAST(SUM(SalesQuantity) AS BIGINT) AS SalesQuantity
FROM sales GROUP BY VendorNo, Brand"""))
def _vendor_brand_sums(spark, sf_dir):
    return S.vendor_brand_sums(stored_star(spark, sf_dir))


# ------------------------------------------------------------------ features


KEY7 = ["VendorNumber", "VendorName", "Brand", "Description", "PurchasePrice", "ActualPrice", "Volume"]
FLOAT_NOISE = {"feat_vendor_avg_margin", "feat_log_sales", "feat_log_purchases",
               "feat_log_profit", "feat_zscore_profit_margin"}


def _summary(spark, sf_dir):
    """The stored summary table, as downstream stages read it."""
    return stage_table(spark, sf_dir, "vendor_summary",
                       lambda: S.vendor_summary(stored_star(spark, sf_dir), ordered=False))


def _feature_view(df, cols):
    """Key columns + the layer's features; aggregate/transcendental outputs are
    rounded to 6 places so the engines' last-ulp differences do not matter."""
    return df.select(*KEY7, *[round_ieee(c, 6).alias(c) if c in FLOAT_NOISE else F.col(c)
                              for c in cols])


FEATURE_SETS = {
    "feat_profit": (FE.profitability, ["feat_profit_per_unit", "feat_profit_tier",
                                       "feat_net_profit_after_freight", "feat_is_profitable"], O.FEAT_PROFIT),
    "feat_volume": (FE.volume, ["feat_volume_category", "feat_quantity_ratio",
                                "feat_demand_velocity"], O.FEAT_VOLUME),
    "feat_price": (FE.pricing, ["feat_price_gap", "feat_price_gap_pct",
                                "feat_price_competitiveness", "feat_excise_burden"], O.FEAT_PRICE),
    "feat_inventory": (FE.inventory, ["feat_sell_through_rate", "feat_overstock_flag",
                                      "feat_revenue_per_purchase_dollar"], O.FEAT_INVENTORY),
    "feat_vendor": (FE.vendor_aggregates, ["feat_vendor_brand_count", "feat_vendor_total_revenue",
                                           "feat_vendor_avg_margin", "feat_vendor_revenue_share"], O.FEAT_VENDOR),
    "feat_stats": (FE.statistical, ["feat_log_sales", "feat_log_purchases", "feat_log_profit",
                                    "feat_zscore_profit_margin"], O.FEAT_STATS),
    "feat_freq": (FE.categorical, ["feat_vendor_frequency"], O.FEAT_FREQ),
}


def _make_feature_query(layer, cols):
    def build(spark, sf_dir):
        return _feature_view(layer(_summary(spark, sf_dir)), cols)
    return build


for _name, (_layer, _cols, _sql) in FEATURE_SETS.items():
    register(_name, O.features_sql(_sql))(_make_feature_query(_layer, _cols))

ALL_FEATURES = [c for _, cols, _ in FEATURE_SETS.values() for c in cols]


@register("features_all", O.features_sql(*[v[2] for v in FEATURE_SETS.values()]))
def _features_all(spark, sf_dir):
    return _feature_view(FE.build_features(_summary(spark, sf_dir)), ALL_FEATURES)


# ------------------------------------------------------------------ data quality

@register("dq_nulls", O.dq_nulls_sql())
def _dq_nulls(spark, sf_dir):
    return DQ.null_profile(_summary(spark, sf_dir))


@register("dq_ranges", O.dq_ranges_sql())
def _dq_ranges(spark, sf_dir):
    return DQ.range_frame(_summary(spark, sf_dir), DQ.VALIDATION_PROFILES["vendor_summary"])


@register("dq_outliers", O.dq_outliers_sql())
def _dq_outliers(spark, sf_dir):
    return DQ.outlier_frame(_summary(spark, sf_dir), DQ.VALIDATION_PROFILES["vendor_summary"])


SUMMARY_COLS = ["VendorNumber", "VendorName", "Brand", "Description", "Volume", *O.MEASURES, "GrossProfit",
                "ProfitMargin", "StockTurnover", "SalesToPurchaseRatio", "FreightToSalesRatio", "PriceMarkup"]
SUMMARY_DOUBLES = set(SUMMARY_COLS) - {"VendorNumber", "VendorName", "Brand", "Description"}


@register("dq_report", O.dq_details_sql(O.SUMMARY_CLEAN, "vendor_summary", SUMMARY_COLS, SUMMARY_DOUBLES,
                                        DQ.VALIDATION_PROFILES["vendor_summary"]))
def _dq_report(spark, sf_dir):
    checks = DQ.DataQualityValidator().check_frame(_summary(spark, sf_dir))
    return DQ.details_frame(checks, O.DQ_DETAILS)


@register("dq_totals", O.dq_totals_sql(O.SUMMARY_CLEAN, "vendor_summary", SUMMARY_COLS, SUMMARY_DOUBLES,
                                       DQ.VALIDATION_PROFILES["vendor_summary"], "vendor_summary"))
def _dq_totals(spark, sf_dir):
    """The report's totals and pass rate."""
    return DQ.DataQualityValidator().totals_frame(_summary(spark, sf_dir))


@register("dup_count", O.q(O.SUMMARY_CLEAN, """
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM purchases) d) AS distinct_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM purchases) d) AS duplicate_rows
FROM purchases"""))
def _dup_count(spark, sf_dir):
    return DQ.duplicate_frame(stored_star(spark, sf_dir).purchases)


# ------------------------------------------------------------------ imputation / notebook table


EDA_KEY = ["VendorNumber", "VendorName", "Brand", "Description", "PurchasePrice"]
MEDIAN_NOISE = {"AvgSalesPrice", "AvgSalesPrice_imputed", "BrandSalesPriceMedian", "BrandMarkup",
                "Volume", "BrandVolumeMedian"}


def _r6(df, cols=None):
    """Round columns fed by interpolated medians or float aggregates to 6
    places (engines interpolate with different but equivalent formulas)."""
    cols = MEDIAN_NOISE if cols is None else set(cols)
    return df.select(*[round_ieee(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def _r6sql(cols, names=None):
    names = names or cols
    return ", ".join(O.rnd(c, 6) + f" AS {n}" if n in MEDIAN_NOISE else f"{c} AS {n}"
                     for c, n in zip(cols, names))


def _eda(spark, sf_dir):
    return stage_table(spark, sf_dir, "eda_summary",
                       lambda: S.eda_summary(stored_star(spark, sf_dir), ordered=False))


def _eda_clean(spark, sf_dir):
    """The notebook's stored table, read back by the analysis stage."""
    return stage_table(spark, sf_dir, "eda_clean", lambda: IM.eda_clean(_eda(spark, sf_dir)))


def _df_clean(spark, sf_dir):
    """The stored outlier-free table that the analysis steps read."""
    return stage_table(spark, sf_dir, "df_clean", lambda: EX.iqr_filter(_eda_clean(spark, sf_dir), materialize_input=False))


@register("impute_all", O.q(O.NOTEBOOK, f"SELECT {', '.join(EDA_KEY)}, ReferencePurchasePrice, Volume FROM prep"))
def _impute_all(spark, sf_dir):
    return IM.prepare(_eda(spark, sf_dir)).select(*EDA_KEY, "ReferencePurchasePrice", "Volume")


@register("brand_medians", O.q(O.NOTEBOOK, "SELECT bkey AS Brand, " + _r6sql(
    ["BrandVolumeMedian", "BrandSalesPriceMedian"]) + " FROM bmed"))
def _brand_medians(spark, sf_dir):
    return _r6(IM.brand_medians(IM.prepare(_eda(spark, sf_dir))))


@register("brand_markup", O.q(O.NOTEBOOK, "SELECT Brand, " + O.rnd("median(ImpliedMarkup)", 6)
                              + " AS BrandMarkup FROM vm WHERE Brand IS NOT NULL GROUP BY Brand"))
def _brand_markup(spark, sf_dir):
    return _r6(IM.brand_markup(IM.prepare(_eda(spark, sf_dir))))


@register("impute_volume", O.q(O.NOTEBOOK, f"SELECT {', '.join(EDA_KEY)}, "
                               + O.rnd("COALESCE(Volume, 750.0)", 6) + " AS Volume FROM imp"))
def _impute_volume(spark, sf_dir):
    df = IM.impute(IM.prepare(_eda(spark, sf_dir)))
    return _r6(df.select(*EDA_KEY, F.coalesce("Volume", F.lit(IM.DEFAULT_VOLUME)).alias("Volume")))


@register("impute_price", O.q(O.NOTEBOOK, f"SELECT {', '.join(EDA_KEY)}, "
                              + _r6sql(["AvgSalesPrice_imputed"]) + " FROM imp"))
def _impute_price(spark, sf_dir):
    return _r6(IM.impute(IM.prepare(_eda(spark, sf_dir))).select(*EDA_KEY, "AvgSalesPrice_imputed"))


@register("eda_clean", O.q(O.NOTEBOOK, "SELECT " + _r6sql(O.EDA_CLEAN_COLS) + " FROM eda_clean"))
def _eda_clean_q(spark, sf_dir):
    return _r6(IM.eda_clean(_eda(spark, sf_dir)))


def _typed_sql():
    parts = []
    for c in O.EDA_CLEAN_COLS:
        t = IM.TYPED_SINK[c]
        if t.startswith("DECIMAL"):
            scale = int(t.split(",")[1].rstrip(")"))
            parts.append(f"CAST({O.rnd(c, scale)} AS {t}) AS {c}")
        elif t == "INT":
            parts.append(f"CAST({c} AS INTEGER) AS {c}")
        else:
            parts.append(c)
    return O.q(O.NOTEBOOK, "SELECT " + ", ".join(parts) + " FROM eda_clean")


@register("typed_sink", _typed_sql())
def _typed_sink(spark, sf_dir):
    from ..sinks.tables import write_replace
    out = IM.typed(_eda_clean(spark, sf_dir))
    return write_replace(out, "vendor_sales_summary_typed")


# ------------------------------------------------------------------ explore

@register("distinct_counts", O.q(O.BRAND, """
SELECT COUNT(DISTINCT VendorNumber) AS vendors, COUNT(DISTINCT Brand) AS brands, COUNT(*) AS rows
FROM brand_summary"""))
def _distinct_counts(spark, sf_dir):
    return EX.distinct_counts(S.brand_summary(stored_star(spark, sf_dir), ordered=False))


@register("distinct_vendors", O.q(O.EDA, "SELECT DISTINCT VendorName FROM eda_summary"))
def _distinct_vendors(spark, sf_dir):
    return EX.distinct_values(_eda(spark, sf_dir), "VendorName")


@register("min_check", O.q(O.CLEANED, """
SELECT 'TotalPurchaseQuantity' AS "column", min(TotalPurchaseQuantity) AS min, max(TotalPurchaseQuantity) AS max FROM df_clean
UNION ALL SELECT 'TotalSalesQuantity', min(TotalSalesQuantity), max(TotalSalesQuantity) FROM df_clean"""))
def _min_check(spark, sf_dir):
    return EX.min_check(_df_clean(spark, sf_dir), ["TotalPurchaseQuantity", "TotalSalesQuantity"])


def _iqr_sql():
    parts = [f"""SELECT '{c}' AS "column", {O.rnd(f'quantile_cont({c}, 0.25)', 6)} AS q1,
       {O.rnd(f'quantile_cont({c}, 0.75)', 6)} AS q3 FROM eda_clean""" for c in O.IQR_COLS]
    body = "\nUNION ALL\n".join(parts)
    return O.q(O.NOTEBOOK + [("qq", body)], """
SELECT "column", q1, q3, q3 - q1 AS iqr, q1 - 3.0 * (q3 - q1) AS lower, q3 + 3.0 * (q3 - q1) AS upper FROM qq""")


@register("iqr_bounds", _iqr_sql())
def _iqr_bounds(spark, sf_dir):
    b = EX.iqr_bounds(_eda_clean(spark, sf_dir), EX.IQR_COLUMNS)
    b = b.withColumns({"q1": round_ieee("q1", 6), "q3": round_ieee("q3", 6)})
    iqr = F.col("q3") - F.col("q1")
    return b.withColumns({"iqr": iqr, "lower": F.col("q1") - 3.0 * iqr, "upper": F.col("q3") + 3.0 * iqr})


@register("iqr_filter", O.q(O.CLEANED, "SELECT " + _r6sql(O.EDA_CLEAN_COLS) + " FROM df_clean"))
def _iqr_filter(spark, sf_dir):
    return _r6(EX.iqr_filter(_eda_clean(spark, sf_dir), materialize_input=False))


@register("outlier_stats", O.q(O.CLEANED, """
SELECT (SELECT count(*) FROM eda_clean) AS original_rows, (SELECT count(*) FROM df_clean) AS remaining_rows,
       (SELECT count(*) FROM eda_clean) - (SELECT count(*) FROM df_clean) AS removed_rows,
       (1.0 - (SELECT count(*) FROM df_clean) / (SELECT count(*) FROM eda_clean)) * 100 AS removed_pct"""))
def _outlier_stats(spark, sf_dir):
    base = _eda_clean(spark, sf_dir)
    return EX.outlier_stats(base, EX.iqr_filter(base, materialize_input=False))


@register("clip_ratios", O.q(O.NOTEBOOK, f"""
SELECT {', '.join(EDA_KEY)}, {O.clip_sql('ProfitMargin', -50, 150)} AS ProfitMargin,
       {O.clip_sql('GrossMarginPct', -50, 150)} AS GrossMarginPct,
       {O.clip_sql('SellThroughRatio', 0, 5)} AS SellThroughRatio FROM eda_clean"""))
def _clip_ratios(spark, sf_dir):
    from ..functions.semantics import clip_keep_null
    df = _eda_clean(spark, sf_dir)
    return df.select(*EDA_KEY, *[clip_keep_null(c, lo, hi).alias(c) for c, (lo, hi) in EX.RATIO_CAPS.items()])


LOGS = [f"{c}_log" for c in EX.PRICE_COLUMNS]


@register("log_prices", O.q(O.CLEANED, f"SELECT {', '.join(EDA_KEY[:-1])}, PurchasePrice AS PP, "
                            + ", ".join(f"{O.rnd(f'(CASE WHEN {c} >= -1 THEN ln(1 + {c}) END)', 6)} AS {c}_log"
                                        for c in EX.PRICE_COLUMNS) + " FROM df_clean"))
def _log_prices(spark, sf_dir):
    df = EX.log_prices(_df_clean(spark, sf_dir))
    return df.select(*EDA_KEY[:-1], F.col("PurchasePrice").alias("PP"), *[round_ieee(c, 6).alias(c) for c in LOGS])


def _vol_cat_sql(x):
    return O.vol_sql(x, EX.NOTEBOOK_VOLUME_EDGES, EX.NOTEBOOK_VOLUME_LABELS)


@register("volume_categories", O.q(O.CLEANED, f"SELECT {', '.join(EDA_KEY)}, {_vol_cat_sql('Volume')} AS VolumeCategory FROM df_clean"))
def _volume_categories(spark, sf_dir):
    return EX.volume_categories(_df_clean(spark, sf_dir)).select(*EDA_KEY, "VolumeCategory")


@register("profit_tiers", O.q(O.CLEANED, f"SELECT {', '.join(EDA_KEY)}, GrossProfit, "
                              f"{O.cut_sql('GrossProfit', EX.MARGIN_TIER_EDGES, EX.MARGIN_TIER_LABELS)} AS MarginTier FROM df_clean"))
def _profit_tiers(spark, sf_dir):
    return EX.profit_tiers(_df_clean(spark, sf_dir)).select(*EDA_KEY, "GrossProfit", "MarginTier")


def _tiers_sql():
    labels = ", ".join(f"({i}, '{lab}')" for i, lab in enumerate(EX.MARGIN_TIER_LABELS))
    cut = O.cut_sql("GrossProfit", EX.MARGIN_TIER_EDGES, EX.MARGIN_TIER_LABELS)
    return O.q(O.CLEANED + [
        ("tiers", f"SELECT * FROM (VALUES {labels}) t(tier_order, MarginTier)"),
        ("tg", f"""SELECT {cut} AS MarginTier, count(Brand) AS Brand, avg(PurchasePrice) AS PurchasePrice,
                   median(Volume) AS Volume, avg(ProfitMargin) AS ProfitMargin, avg(StockTurnover) AS StockTurnover
                   FROM df_clean GROUP BY 1""")], f"""
SELECT t.tier_order, t.MarginTier, COALESCE(g.Brand, 0) AS Brand,
       {O.rnd('g.PurchasePrice', 2)} AS PurchasePrice, {O.rnd('g.Volume', 2)} AS Volume,
       {O.rnd('g.ProfitMargin', 2)} AS ProfitMargin, {O.rnd('g.StockTurnover', 2)} AS StockTurnover
FROM tiers t LEFT JOIN tg g ON t.MarginTier = g.MarginTier""")


@register("margin_tiers", _tiers_sql())
def _margin_tiers(spark, sf_dir):
    return EX.margin_tiers(_df_clean(spark, sf_dir))


def _numeric_eda_cols():
    return ["VendorNumber", "Brand"] + O.EDA_NUM


def _describe_sql():
    parts = []
    for c in _numeric_eda_cols():
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, {O.rnd(f'avg({c})', 6)} AS mean,
  {O.rnd(f'stddev_samp({c})', 6)} AS std, CAST(min({c}) AS DOUBLE) AS min,
  {O.rnd(f'quantile_cont({c}, 0.25)', 6)} AS q25, {O.rnd(f'quantile_cont({c}, 0.5)', 6)} AS q50,
  {O.rnd(f'quantile_cont({c}, 0.75)', 6)} AS q75, CAST(max({c}) AS DOUBLE) AS max FROM eda_clean""")
    return O.q(O.NOTEBOOK, "\nUNION ALL\n".join(parts))


@register("describe_numeric", _describe_sql())
def _describe_numeric(spark, sf_dir):
    d = EX.describe(_eda_clean(spark, sf_dir))
    return _r6(d, ["mean", "std", "q25", "q50", "q75"])


def _hist_sql(bins=30):
    cols = _numeric_eda_cols()
    unp = "\nUNION ALL\n".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM eda_clean WHERE {c} IS NOT NULL" for c in cols)
    return O.q(O.NOTEBOOK + [("lng", unp), ("mm", 'SELECT "column", min(value) AS lo, max(value) AS hi FROM lng GROUP BY 1'),
                             ("bb", f"""SELECT l."column", lo, hi, CAST(CASE WHEN hi - lo = 0 THEN 1 ELSE
                               least(floor((value - lo) / (hi - lo) * {float(bins)}) + 1, {bins}) END AS INTEGER) AS bin
                               FROM lng l JOIN mm m ON l."column" = m."column" """)], f"""
SELECT "column", bin, lo + (bin - 1) * (hi - lo) / {bins} AS bin_start, count(*) AS count
FROM bb GROUP BY "column", lo, hi, bin""")


@register("histogram", _hist_sql())
def _histogram(spark, sf_dir):
    return EX.histogram(_eda_clean(spark, sf_dir), _numeric_eda_cols())


def _box_sql():
    cols = _numeric_eda_cols()
    unp = "\nUNION ALL\n".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM eda_clean WHERE {c} IS NOT NULL" for c in cols)
    return O.q(O.NOTEBOOK + [
        ("lng", unp),
        ("qs", 'SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, '
               'quantile_cont(value, 0.75) AS q3 FROM lng GROUP BY 1'),
        ("fz", "SELECT *, q1 - 1.5 * (q3 - q1) AS lof, q3 + 1.5 * (q3 - q1) AS hif FROM qs")], f"""
SELECT f."column", {O.rnd('f.q1', 6)} AS q1, {O.rnd('f.median', 6)} AS median, {O.rnd('f.q3', 6)} AS q3,
       min(CASE WHEN value >= lof AND value <= hif THEN value END) AS whisker_low,
       max(CASE WHEN value >= lof AND value <= hif THEN value END) AS whisker_high,
       count_if(NOT (value >= lof AND value <= hif)) AS fliers
FROM lng l JOIN fz f ON l."column" = f."column"
GROUP BY f."column", f.q1, f.median, f.q3""")


@register("box_stats", _box_sql())
def _box_stats(spark, sf_dir):
    return _r6(EX.box_stats(_eda_clean(spark, sf_dir), _numeric_eda_cols()), ["q1", "median", "q3"])


def _corr_sql(cols, base, ctes, pairs_only=False):
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    def r(a, b):
        both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
        x, y = f"CASE WHEN {both} THEN {a} END", f"CASE WHEN {both} THEN {b} END"
        return O.rnd(f"(covar_samp({x}, {y}) / NULLIF(stddev_samp({x}) * stddev_samp({y}), 0))", 6)
    upper = "\nUNION ALL\n".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(a, b)} AS corr FROM {base}" for a, b in pairs)
    final = "SELECT * FROM up UNION ALL SELECT col_b, col_a, corr FROM up WHERE col_a <> col_b"
    if pairs_only:
        final = f"SELECT * FROM ({final}) m WHERE corr > 0.95 AND corr < 1.0 AND col_a <> col_b"
    return O.q(ctes + [("up", upper)], final)


CORR_COLS = ["VendorNumber", "Brand"] + O.EDA_NUM + LOGS


def _df_logs(spark, sf_dir):
    return EX.log_prices(_df_clean(spark, sf_dir))


LOG_CTE = ("dl", "SELECT *, " + ", ".join(f"(CASE WHEN {c} >= -1 THEN ln(1 + {c}) END) AS {c}_log"
                                          for c in EX.PRICE_COLUMNS) + " FROM df_clean")


@register("corr_matrix", _corr_sql(CORR_COLS, "dl", O.CLEANED + [LOG_CTE]))
def _corr_matrix(spark, sf_dir):
    return _r6(EX.corr_matrix(_df_logs(spark, sf_dir), CORR_COLS), ["corr"])


@register("corr_pairs", _corr_sql(EX.PRICE_COLUMNS, "df_clean", O.CLEANED, pairs_only=True))
def _corr_pairs(spark, sf_dir):
    m = _r6(EX.corr_matrix(_df_clean(spark, sf_dir), EX.PRICE_COLUMNS), ["corr"])
    return EX.corr_pairs(m)


@register("top_categories", O.q(O.NOTEBOOK, """
SELECT * FROM (SELECT 'VendorName' AS "column", VendorName AS value, count(*) AS count FROM eda_clean
               WHERE VendorName IS NOT NULL GROUP BY VendorName ORDER BY count DESC, value LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'Description', Description, count(*) AS count FROM eda_clean
               WHERE Description IS NOT NULL GROUP BY Description ORDER BY count DESC, Description LIMIT 10)"""))
def _top_categories(spark, sf_dir):
    return EX.top_categories(_eda_clean(spark, sf_dir))


@register("round_number_pct", O.q(O.CLEANED, """
SELECT 'TotalPurchaseDollars' AS "column", count_if(TotalPurchaseDollars % 1 = 0) / count(*) * 100 AS round_pct FROM df_clean
UNION ALL SELECT 'TotalSalesDollars', count_if(TotalSalesDollars % 1 = 0) / count(*) * 100 FROM df_clean"""))
def _round_number_pct(spark, sf_dir):
    return EX.round_number_pct(_df_clean(spark, sf_dir))


def _normality_sql():
    parts = []
    for c in EX.NORMALITY_COLUMNS:
        m = f"(SELECT avg({c}) FROM df_clean)"
        m2, m3, m4 = (f"avg(pow({c} - {m}, {k}))" for k in (2, 3, 4))
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS n, {m3} / pow({m2}, 1.5) AS skew,
            {m4} / pow({m2}, 2) - 3.0 AS kurt FROM df_clean""")
    jb = "n / 6.0 * (skew * skew + kurt * kurt / 4.0)"
    return O.q(O.CLEANED + [("mo", "\nUNION ALL\n".join(parts))], f"""
SELECT "column", n, {O.rnd('skew', 6)} AS skew, {O.rnd('kurt', 6)} AS excess_kurtosis,
       {O.rnd(jb, 6)} AS jb, {O.rnd(f'exp(-({jb}) / 2.0)', 6)} AS p_value, exp(-({jb}) / 2.0) > 0.05 AS normal
FROM mo""")


@register("normality", _normality_sql())
def _normality(spark, sf_dir):
    return _r6(EX.normality(_df_clean(spark, sf_dir)), ["skew", "excess_kurtosis", "jb", "p_value"])


@register("profitable_rows", O.q(O.NOTEBOOK, "SELECT " + _r6sql(O.EDA_CLEAN_COLS)
                                 + " FROM eda_clean WHERE GrossProfit > 0 AND ProfitMargin > 0 AND TotalSalesQuantity > 0"))
def _profitable_rows(spark, sf_dir):
    df = _eda_clean(spark, sf_dir)
    return _r6(df.where((F.col("GrossProfit") > 0) & (F.col("ProfitMargin") > 0)
                        & (F.col("TotalSalesQuantity") > 0)))


# ------------------------------------------------------------------ sources / sinks


PURCHASE_COLS = ["InventoryId", "Store", "Brand", "Description", "Size", "VendorNumber", "VendorName",
                 "PONumber", "PODate", "ReceivingDate", "PurchasePrice", "Quantity", "Dollars"]


@register("sanitize_names", """
SELECT p_partkey,
       lower(regexp_replace(regexp_replace(p_name, '[^a-zA-Z0-9_]', '_', 'g'), '^[0-9]', '_')) AS name_id,
       lower(regexp_replace(regexp_replace(p_type, '[^a-zA-Z0-9_]', '_', 'g'), '^[0-9]', '_')) AS type_id
FROM part""")
def _sanitize_names(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return part.select("p_partkey", FS.sanitize_name_col("p_name").alias("name_id"),
                       FS.sanitize_name_col("p_type").alias("type_id"))


@register("coerce_numeric", O.q(O.STAR, f"""
SELECT Brand, Volume, {O.to_number('Volume')} AS VolumeNumber FROM purchase_prices"""))
def _coerce_numeric(spark, sf_dir):
    from ..functions.semantics import to_number
    pp = stored_star(spark, sf_dir).purchase_prices
    return pp.select("Brand", "Volume", to_number("Volume").alias("VolumeNumber"))


def _infer_sql():
    width = lambda c: f"CASE WHEN max(length({c})) IS NULL THEN 255 ELSE least(max(length({c})) * 2, 65535) END"
    def text(c):
        w = width(c)
        return (f"SELECT '{c}' AS \"column\", 'string' AS spark_type, CAST(max(length({c})) AS INTEGER) AS max_length, "
                f"CASE WHEN {w} <= 255 THEN 'VARCHAR(' || CAST({w} AS VARCHAR) || ')' "
                f"WHEN {w} <= 65535 THEN 'TEXT' ELSE 'LONGTEXT' END AS sql_type FROM purchases")
    fixed = {"Store": ("int", "INT"), "Brand": ("bigint", "BIGINT"), "VendorNumber": ("bigint", "BIGINT"),
             "PONumber": ("bigint", "BIGINT"), "PODate": ("date", "DATE"), "ReceivingDate": ("date", "DATE"),
             "PurchasePrice": ("decimal(14,4)", "DECIMAL(14,4)"), "Quantity": ("bigint", "BIGINT"),
             "Dollars": ("decimal(14,4)", "DECIMAL(14,4)")}
    parts = []
    for c in PURCHASE_COLS:
        if c in fixed:
            st, sq = fixed[c]
            parts.append(f"SELECT '{c}', '{st}', CAST(NULL AS INTEGER), '{sq}'")
        else:
            parts.append(text(c))
    return O.q(O.STAR, "\nUNION ALL\n".join(parts))


@register("infer_types", _infer_sql())
def _infer_types(spark, sf_dir):
    return FS.infer_types(stored_star(spark, sf_dir).purchases.select(*PURCHASE_COLS))


CSV_SQL_COLS = ("InventoryId, CAST(Store AS INTEGER) AS Store, CAST(Brand AS INTEGER) AS Brand, Description, "
                "CAST(Size AS INTEGER) AS Size, CAST(VendorNumber AS INTEGER) AS VendorNumber, VendorName, "
                "CAST(PONumber AS INTEGER) AS PONumber, PODate, ReceivingDate, "
                "CAST(PurchasePrice AS DOUBLE) AS PurchasePrice, CAST(Quantity AS INTEGER) AS Quantity, "
                "CAST(Dollars AS DOUBLE) AS Dollars")


#: Descriptions as landed: one in five holds a quote and a comma, one in seven a line end.
QUOTED_SQL = ("CASE WHEN PONumber % 35 = 0 THEN 'a \"b\", c' || chr(10) || Description "
              "WHEN PONumber % 5 = 0 THEN Description || ' \"Big\", 5L' "
              "WHEN PONumber % 7 = 0 THEN Description || chr(10) || 'x' ELSE Description END")


def _quoted(df):
    po, d = F.col("PONumber"), F.col("Description")
    text = (F.when(po % 35 == 0, F.concat(F.lit('a "b", c\n'), d)).when(po % 5 == 0, F.concat(d, F.lit(' "Big", 5L')))
            .when(po % 7 == 0, F.concat(d, F.lit("\nx"))).otherwise(d))
    return df.withColumn("Description", text)


@register("load_csv", O.q(O.STAR, f"SELECT {CSV_SQL_COLS} FROM (SELECT * REPLACE ({QUOTED_SQL} AS Description) FROM purchases)"))
def _load_csv(spark, sf_dir):
    return FS.load_csv(spark, _land_quoted_csv(spark, sf_dir), multi_line=True)


def _land_quoted_csv(spark, sf_dir):
    """Purchases with quoted line ends as CSV, in files of bounded size, since none is split."""
    return landed(spark, sf_dir, "purchases_csv",
                  lambda p: FS.write_csv(_quoted(stored_star(spark, sf_dir).purchases), p, rows_per_file=100_000))


def _land_star_csv(spark, sf_dir):
    """A landing folder of CSV drops derived from the star tables, plus an
    empty drop (exercises the 'skipped' rule) and a parquet file the glob
    must not pick up.  Made once per session."""
    def write(d):
        star = stored_star(spark, sf_dir)
        FS.write_csv(star.purchases, f"{d}/purchases.csv")
        FS.write_csv(star.sales, f"{d}/sales.csv")
        FS.write_csv(star.vendor_invoice, f"{d}/vendor-invoice.csv")
        FS.write_csv(star.purchases.limit(0), f"{d}/empty.csv")  # an empty drop, by design
        star.purchase_prices.write.parquet(f"{d}/purchase_prices.parquet")
    return landed(spark, sf_dir, "star_csv", write)


def _loaded(spark, sf_dir):
    """The landing folder loaded once per session: tables, results and folder."""
    folder = landed(spark, sf_dir, "loaded", lambda p: FS.load_directory(
        spark, _land_star_csv(spark, sf_dir), "*.csv", p)[1].write.parquet(f"{p}/_results"))
    return spark.read.parquet(f"{folder}/_results"), folder


@register("load_directory", O.q(O.STAR, """
SELECT 'empty.csv' AS file, 'empty' AS "table", CAST(0 AS BIGINT) AS total_rows, CAST(0 AS BIGINT) AS inserted_rows,
       CAST(0 AS BIGINT) AS failed_rows, 'skipped' AS status
UNION ALL SELECT 'purchases.csv', 'purchases', count(*), count(*), 0, 'success' FROM purchases
UNION ALL SELECT 'sales.csv', 'sales', count(*), count(*), 0, 'success' FROM sales
UNION ALL SELECT 'vendor-invoice.csv', 'vendor_invoice', count(*), count(*), 0, 'success' FROM vendor_invoice"""))
def _load_directory(spark, sf_dir):
    return _loaded(spark, sf_dir)[0].drop("error")


@register("loaded_purchases", O.q(O.STAR, f"SELECT {CSV_SQL_COLS} FROM purchases"))
def _loaded_purchases(spark, sf_dir):
    """A table that the load wrote, read back."""
    return spark.read.parquet(f"{_loaded(spark, sf_dir)[1]}/purchases")


@register("load_report", O.q(O.STAR, """
SELECT CAST(4 AS BIGINT) AS total_files, CAST(3 AS BIGINT) AS successful, CAST(0 AS BIGINT) AS failed,
       (SELECT count(*) FROM purchases) + (SELECT count(*) FROM sales) + (SELECT count(*) FROM vendor_invoice) AS total_rows_processed,
       (SELECT count(*) FROM purchases) + (SELECT count(*) FROM sales) + (SELECT count(*) FROM vendor_invoice) AS total_rows_inserted"""))
def _load_report(spark, sf_dir):
    return LD.load_report(_loaded(spark, sf_dir)[0])


@register("table_counts", O.q(O.STAR, """
SELECT 'purchases' AS "table", count(*) AS rows FROM purchases
UNION ALL SELECT 'sales', count(*) FROM sales
UNION ALL SELECT 'purchase_prices', count(*) FROM purchase_prices
UNION ALL SELECT 'vendor_invoice', count(*) FROM vendor_invoice"""))
def _table_counts(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return FS.table_counts({"purchases": s.purchases, "sales": s.sales,
                            "purchase_prices": s.purchase_prices, "vendor_invoice": s.vendor_invoice})


EVENTS_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


@register("scan_json", "SELECT * FROM events")
def _scan_json(spark, sf_dir):
    path = scratch_path(spark, "json/events")
    _events(spark, sf_dir).write.option("timestampNTZFormat", FS.TS_MICROS).json(path)
    return FS.scan_json(spark, path, schema=EVENTS_DDL)


@register("json_envelope", "SELECT * FROM events")
def _json_envelope(spark, sf_dir):
    """Pages of at most 100 events, each landed in one of the four payload
    forms (by page number), then unwrapped back into rows."""
    ev = _events(spark, sf_dir)
    page = F.floor(F.col("event_id") / 100)
    opts = {"timestampNTZFormat": FS.TS_MICROS}
    rec = F.to_json(F.struct(*ev.columns), opts)
    pages = (ev.withColumn("page", page).groupBy("page")
             .agg(F.collect_list(F.struct(*ev.columns)).alias("rows")))  # <= 100 rows per page
    form = F.col("page") % 4
    doc = (F.when(form == 0, F.to_json(F.struct(F.col("rows").alias("data")), opts))
           .when(form == 1, F.to_json(F.struct(F.col("rows").alias("results")), opts))
           .otherwise(F.to_json("rows", opts)))
    lists = pages.where(form != 3).select(doc.alias("value"))
    singles = ev.withColumn("page", page).where((F.col("page") % 4) == 3).select(rec.alias("value"))
    path = scratch_path(spark, "json/payloads")
    lists.unionByName(singles).write.text(path)
    out = FS.unwrap_envelope(FS.scan_json(spark, path))
    return out.select(F.col("event_id").cast("bigint"), F.to_timestamp_ntz("ts").alias("ts"),
                      F.col("user_id").cast("bigint"), "event_type", F.col("value").cast("double"), "props")


@register("json_bad_lines", """
SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_id END AS event_id, count(*) AS n FROM events GROUP BY ALL""")
def _json_bad_lines(spark, sf_dir):
    """Every fiftieth event lands as a broken line; those are kept and counted as such."""
    ev = _events(spark, sf_dir)
    whole = F.to_json(F.struct("event_id", "event_type"))
    line = F.when(F.col("event_id") % 50 == 0, F.substring(whole, 1, 9)).otherwise(whole)
    path = scratch_path(spark, "json/broken")
    ev.select(line.alias("value")).write.text(path)
    rows = FS.unwrap_envelope(FS.scan_json(spark, path, bad_lines="keep"), bad_lines="keep")
    good = F.when(F.col(FS.BAD_LINE).isNull(), F.col("event_id").cast("bigint"))
    return rows.groupBy(good.alias("event_id")).agg(F.count(F.lit(1)).alias("n"))


@register("latest_file", "SELECT * FROM events WHERE event_type = (SELECT max(event_type) FROM events)")
def _latest_file(spark, sf_dir):
    """Event drops (folders of part files), the greatest event type written last; one
    that only a loose pattern would match is newer still.  Two drops of other types
    are older."""
    ev = _events(spark, sf_dir)
    d = scratch_path(spark, "drops")
    top, low = ev.select(F.max("event_type")).scalar(), ev.select(F.min("event_type")).scalar()
    drops = [("events_low.parquet", F.col("event_type") == low), ("events_all.parquet", F.lit(True)),
             ("events_top.parquet", F.col("event_type") == top), ("eventsXother.parquet", F.col("event_type") != top)]
    for name, rows in drops:
        ev.where(rows).write.parquet(f"{d}/{name}")
    return FS.read_latest(spark, d, "events_*.parquet")


@register("sql_params", O.q(O.STAR, """
SELECT VendorNumber, count(*) AS n, CAST(sum(Dollars) AS DOUBLE) AS dollars
FROM purchases WHERE VendorNumber = 7 AND ReceivingDate >= DATE '1998-01-01' GROUP BY VendorNumber"""))
def _sql_params(spark, sf_dir):
    view = f"purchases_{abs(hash(sf_dir)) % 10**8}"
    stored_star(spark, sf_dir).purchases.createOrReplaceTempView(view)
    return FS.query_to_df(spark, f"""
        SELECT VendorNumber, count(*) AS n, CAST(sum(Dollars) AS DOUBLE) AS dollars
        FROM {view} WHERE VendorNumber = :vendor AND ReceivingDate >= :since GROUP BY VendorNumber""",
        {"vendor": 7, "since": S.DEFAULT_SINCE})


@register("recent_rows", """
SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 30 MINUTES""")
def _recent_rows(spark, sf_dir):
    ev = _events(spark, sf_dir)
    as_of = ev.select(F.max("ts")).scalar()
    return ev.where(F.col("ts") > as_of - F.expr("INTERVAL 30 MINUTES"))


@register("sink_replace", O.q(O.SUMMARY_CLEAN, "SELECT * FROM vendor_summary"))
def _sink_replace(spark, sf_dir):
    df = S.vendor_summary(stored_star(spark, sf_dir), ordered=False)
    path = TB.table_path(spark, "vendor_sales_summary")
    TB.write_table(df, path, "replace")
    TB.write_table(df, path, "replace")  # replacing again leaves one copy
    return spark.read.parquet(path)


@register("sink_append", O.q(O.SUMMARY_RAW, """
SELECT * FROM vendor_summary_raw UNION ALL SELECT * FROM vendor_summary_raw"""))
def _sink_append(spark, sf_dir):
    df = S.vendor_summary_raw(stored_star(spark, sf_dir), ordered=False)
    path = TB.table_path(spark, "vendor_summary_raw")
    TB.write_table(df, path, "append")
    TB.write_table(df, path, "append")
    return spark.read.parquet(path)


LOAD_SCHEMA = T.StructType([
    T.StructField("Brand", T.LongType()), T.StructField("Description", T.StringType()),
    T.StructField("Price", T.DoubleType()), T.StructField("Volume", T.DoubleType()),
    T.StructField("VendorNumber", T.LongType()), T.StructField("PurchasePrice", T.DoubleType())])


def _rejected(spark, sf_dir):
    """Prices landed as text (some volumes are no numbers), loaded under a schema with
    the rows that do not fit set apart; once per session."""
    def load(p):
        star = stored_star(spark, sf_dir)
        FS.write_csv(star.purchase_prices, f"{p}/_landing")
        LD.load_table(spark, f"{p}/_landing", f"{p}/good", f"{p}/bad", LOAD_SCHEMA)
    folder = landed(spark, sf_dir, "with_rejects", load)
    return spark.read.parquet(f"{folder}/good"), spark.read.parquet(f"{folder}/bad")


NO_NUMBER = "TRY_CAST(Volume AS DOUBLE) IS NULL AND Volume IS NOT NULL AND trim(Volume) NOT IN ('', 'NA', 'N/A', 'nan', 'NULL')"


@register("load_with_rejects", O.q(O.STAR, f"""
SELECT count(*) AS total_rows, count(*) - count_if({NO_NUMBER}) AS inserted_rows, count_if({NO_NUMBER}) AS failed_rows,
       CAST(count(*) - count_if({NO_NUMBER}) AS DOUBLE) / count(*) * 100 AS success_rate
FROM purchase_prices"""))
def _load_with_rejects(spark, sf_dir):
    return LD.load_stats(*_rejected(spark, sf_dir))


@register("loaded_rows", O.q(O.STAR, f"""
SELECT Brand, CAST(Price AS DOUBLE) AS Price, TRY_CAST(Volume AS DOUBLE) AS Volume, VendorNumber
FROM purchase_prices WHERE NOT ({NO_NUMBER})"""))
def _loaded_rows(spark, sf_dir):
    return _rejected(spark, sf_dir)[0].select("Brand", "Price", "Volume", "VendorNumber")


@register("rejected_rows", O.q(O.STAR, f"""
SELECT Brand, Volume FROM purchase_prices WHERE {NO_NUMBER}"""))
def _rejected_rows(spark, sf_dir):
    return _rejected(spark, sf_dir)[1].select(F.col("Brand").cast("bigint").alias("Brand"), "Volume")


def _cells_sql(columns):
    return " || ".join(f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)


def _fingerprint_sql():
    cells = _cells_sql(PURCHASE_COLS)
    missing = " + ".join(f"count_if({c} IS NULL)" for c in PURCHASE_COLS)
    return O.q(O.STAR, f"""
SELECT count(*) AS total_rows, CAST({missing} AS BIGINT) AS null_count,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM purchases) d) AS duplicate_count,
       CAST(sum(CAST('0x' || substr(md5({cells}), 1, 15) AS BIGINT)) AS VARCHAR) AS data_hash
FROM purchases""")


@register("table_fingerprint", _fingerprint_sql())
def _table_fingerprint(spark, sf_dir):
    return TB.table_fingerprint(stored_star(spark, sf_dir).purchases.select(*PURCHASE_COLS))


VERSIONS = """
WITH a AS (SELECT event_id, user_id, event_type, props FROM events),
b AS (SELECT event_id, user_id, CASE WHEN event_id % 1009 = 0 THEN event_type || '*' ELSE event_type END AS event_type, props
      FROM events WHERE event_id % 1511 <> 0
      UNION ALL SELECT -event_id, user_id, event_type, props FROM events WHERE event_id % 2003 = 1),
"""


def _versions(spark, sf_dir):
    """Two versions of the events: the second has rows changed, removed and added."""
    ev = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "props")
    k = F.col("event_id")
    starred = F.when(k % 1009 == 0, F.concat("event_type", F.lit("*"))).otherwise(F.col("event_type"))
    kept = ev.where(k % 1511 != 0).withColumn("event_type", starred)
    return ev, kept.unionByName(ev.where(k % 2003 == 1).withColumn("event_id", -k))


def _leaves_sql(table):
    cells = _cells_sql(["event_id", "user_id", "event_type", "props"])
    return f"""SELECT substr(md5({_cells_sql(['event_id'])}), 1, 3) AS leaf, count(*) AS n,
    sum(CAST('0x' || substr(md5({cells}), 1, 15) AS HUGEINT)) AS d FROM {table} GROUP BY 1"""


@register("changed_buckets", VERSIONS + f"""
la AS ({_leaves_sql('a')}), lb AS ({_leaves_sql('b')}), digits(k) AS (VALUES (0), (1), (2), (3)),
sa AS (SELECT k, substr(leaf, 1, k) AS bucket, sum(n) AS n, sum(d) AS d FROM la, digits GROUP BY 1, 2),
sb AS (SELECT k, substr(leaf, 1, k) AS bucket, sum(n) AS n, sum(d) AS d FROM lb, digits GROUP BY 1, 2)
SELECT CAST(k AS INTEGER) AS level, bucket, CAST(COALESCE(sa.n, 0) AS BIGINT) AS old_rows, CAST(COALESCE(sb.n, 0) AS BIGINT) AS new_rows
FROM sa FULL JOIN sb USING (k, bucket) WHERE sa.d IS DISTINCT FROM sb.d""")
def _changed_buckets(spark, sf_dir):
    """The key buckets in which two versions of a table differ, level by level."""
    old, new = (DG.digest_leaves(v, ["event_id"]) for v in _versions(spark, sf_dir))
    return DG.changed_buckets(stored(old, "digests"), stored(new, "digests"))


@register("changed_rows", VERSIONS + """
ka AS (SELECT event_id, count(*) AS n, max(event_type) AS t FROM a GROUP BY 1),
kb AS (SELECT event_id, count(*) AS n, max(event_type) AS t FROM b GROUP BY 1)
SELECT CASE WHEN ka.n IS NULL THEN 'added' WHEN kb.n IS NULL THEN 'removed' ELSE 'changed' END AS change, event_id,
       COALESCE(ka.n, 0) AS old_rows, COALESCE(kb.n, 0) AS new_rows
FROM ka FULL JOIN kb USING (event_id) WHERE ka.n IS DISTINCT FROM kb.n OR ka.t IS DISTINCT FROM kb.t""")
def _changed_rows(spark, sf_dir):
    old, new = _versions(spark, sf_dir)
    leaves = [stored(DG.digest_leaves(v, ["event_id"]), "digests") for v in (old, new)]
    return DG.changed_rows(old, new, ["event_id"], DG.changed_buckets(*leaves))


# ------------------------------------------------------------------ sync / streams

LATEST_SQL = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t
WHERE rn = 1"""
EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


UPSERT_BUCKETS = 16


def _drops(spark, sf_dir):
    """Two drops of the events table split at the midpoint of its time range."""
    ev = _events(spark, sf_dir)
    mid = ev.select(F.expr("min(ts) + (max(ts) - min(ts)) / 2")).scalar()
    return ev.where(F.col("ts") <= mid), ev.where(F.col("ts") > mid), ev


@register("sync_full", "SELECT * FROM events")
def _sync_full(spark, sf_dir):
    first, _, ev = _drops(spark, sf_dir)
    target = TB.table_path(spark, "events_full")
    SY.sync_full(first, target)
    return SY.sync_full(ev, target).select(*EV_COLS)


@register("sync_incremental", "SELECT * FROM events")
def _sync_incremental(spark, sf_dir):
    first, _, ev = _drops(spark, sf_dir)
    target = TB.table_path(spark, "events_incr")
    SY.sync_incremental(first, target, "ts")
    return SY.sync_incremental(ev, target, "ts").select(*EV_COLS)  # re-sent old rows are skipped


@register("sync_upsert", LATEST_SQL)
def _sync_upsert(spark, sf_dir):
    first, _, ev = _drops(spark, sf_dir)
    target = TB.table_path(spark, "events_upsert")
    SY.sync_upsert(first, target, ["user_id"], ["ts", "event_id"], buckets=UPSERT_BUCKETS)
    return SY.sync_upsert(ev, target, ["user_id"], ["ts", "event_id"],
                          buckets=UPSERT_BUCKETS).select(*EV_COLS)


@register("sync_status", """
SELECT 'events_full' AS source_name, CAST(2 AS BIGINT) AS total_syncs, CAST(2 AS BIGINT) AS successful_syncs,
       CAST(0 AS BIGINT) AS failed_syncs, 2 * count(*) AS total_rows_processed FROM events
UNION ALL SELECT 'events_incr', 2, 2, 0, 2 * count(*) FROM events
UNION ALL SELECT 'events_upsert', 1, 1, 0, count(*) FROM events""")
def _sync_status(spark, sf_dir):
    ev = _events(spark, sf_dir)
    hist = TB.table_path(spark, "pipeline_sync_history")
    for name, mode, runs in (("events_full", "full", 2), ("events_incr", "incremental", 2),
                             ("events_upsert", "upsert", 1)):
        target = TB.table_path(spark, name)
        for _ in range(runs):
            SY.run_sync(spark, name, ev, target, mode, history=hist, ts_col="ts",
                        key=["user_id"], order=["ts", "event_id"])
    return SY.sync_status(spark.read.parquet(hist)).drop("last_sync")


def _two_drops_target(spark, sf_dir, mode, second_full=False):
    first, second, ev = _drops(spark, sf_dir)
    src = scratch_path(spark, "stream/src")
    target = scratch_path(spark, "stream/target")
    ckpt = scratch_path(spark, "stream/checkpoint")
    schema = ev.schema
    first.write.mode("append").parquet(src)
    ST.run_stream(spark, src, schema, target, ckpt, mode=mode, ts_col="ts",
                  key=["user_id"], order=["ts", "event_id"], buckets=UPSERT_BUCKETS)
    (ev if second_full else second).write.mode("append").parquet(src)
    ST.run_stream(spark, src, schema, target, ckpt, mode=mode, ts_col="ts",  # restart: same checkpoint
                  key=["user_id"], order=["ts", "event_id"], buckets=UPSERT_BUCKETS)
    return target


def _stream_two_drops(spark, sf_dir, mode, second_full=False):
    return ST.read_target(spark, _two_drops_target(spark, sf_dir, mode, second_full), EV_COLS)


@register("stream_append", "SELECT * FROM events")
def _stream_append(spark, sf_dir):
    return _stream_two_drops(spark, sf_dir, "append")


@register("stream_upsert", LATEST_SQL)
def _stream_upsert(spark, sf_dir):
    return _stream_two_drops(spark, sf_dir, "upsert")


@register("stream_late", "SELECT * FROM events")
def _stream_late(spark, sf_dir):
    """Second drop re-sends every event; rows at or below the mark are late and dropped."""
    return _stream_two_drops(spark, sf_dir, "incremental", second_full=True)


@register("stream_late_counts", """
WITH m AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS mid FROM events),
     f AS (SELECT max(ts) AS hwm FROM events, m WHERE ts <= mid)
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS rows_in, count(*) AS rows_loaded, CAST(0 AS BIGINT) AS rows_late
FROM events, m WHERE ts <= mid
UNION ALL SELECT 1, count(*), count_if(ts > hwm), count_if(ts <= hwm) FROM events, f""")
def _stream_late_counts(spark, sf_dir):
    """Per micro-batch what came, what was loaded and what was late."""
    target = _two_drops_target(spark, sf_dir, "incremental", second_full=True)
    return ST.late_counts(spark, target).select(F.col("batch_id").cast("bigint").alias("batch_id"),
                                                "rows_in", "rows_loaded", "rows_late")


@register("stream_full", """
SELECT * FROM events WHERE ts > (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)""")
def _stream_full(spark, sf_dir):
    """R2: two snapshots; the second replaces the first."""
    return _stream_two_drops(spark, sf_dir, "full")


@register("stream_snapshots", """
SELECT * FROM events WHERE event_id % 3 <> 1""")
def _stream_snapshots(spark, sf_dir):
    """R2: three snapshots of several part files, looked at one file at a time: the first is
    whole, the second replaces it, the third has no marker and replaces nothing."""
    ev = _events(spark, sf_dir)
    src, target, ckpt = (scratch_path(spark, f"stream/{n}") for n in ("src", "target", "checkpoint"))
    for k, rows in enumerate((ev.where("event_id % 3 = 0"), ev.where("event_id % 3 <> 1"), ev.where("event_id % 5 = 0"))):
        rows.repartition(4).write.mode("append").parquet(src)
        if k == 2:
            folders.remove(spark, f"{src}/_SUCCESS")
        ST.run_stream(spark, src, ev.schema, target, ckpt, mode="full", max_files=1)
    return ST.read_target(spark, target, EV_COLS)


WATERMARK_SQL = """
WITH sent AS (
  SELECT *, event_id % 7 = 0 AS delayed FROM events),
edges AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS mid FROM events),
mark AS (SELECT max(ts) AS seen FROM sent, edges WHERE ts <= mid AND NOT delayed),
second AS (SELECT sent.*, ts <= seen - INTERVAL 30 MINUTES AS late FROM sent, edges, mark
           WHERE ts > mid OR delayed OR event_id % 10 = 0)
SELECT event_id, ts, 'loaded' AS outcome FROM sent, edges WHERE ts <= mid AND NOT delayed
UNION ALL SELECT event_id, ts, CASE WHEN late THEN 'late' WHEN ts > mid OR delayed THEN 'loaded' ELSE 'sent before' END
FROM second, edges"""


@register("stream_watermark", WATERMARK_SQL)
def _stream_watermark(spark, sf_dir):
    """The second drop brings rows in time, rows late within and beyond the delay,
    and rows sent before."""
    ev = _events(spark, sf_dir)
    mid = ev.select(F.expr("min(ts) + (max(ts) - min(ts)) / 2")).scalar()
    delayed = F.col("event_id") % 7 == 0
    src, target, ckpt = (scratch_path(spark, f"stream/{n}") for n in ("src", "target", "checkpoint"))
    for rows in (ev.where((F.col("ts") <= mid) & ~delayed), ev.where((F.col("ts") > mid) | delayed | (F.col("event_id") % 10 == 0))):
        rows.write.mode("append").parquet(src)
        ST.run_stream(spark, src, ev.schema, target, ckpt, mode="watermark", ts_col="ts", key=["event_id"], delay="30 minutes")
    loaded = ST.read_target(spark, target, ["event_id", "ts"]).withColumn("outcome", F.lit("loaded"))
    return loaded.unionByName(ST.set_aside(spark, target).select("event_id", "ts", F.col("reason").alias("outcome")))


@register("stream_newest_file", "SELECT * FROM events")
def _stream_newest_file(spark, sf_dir):
    """A newest-file source polled as a stream over two drops and a restart."""
    from .jobs import SourceSpec, start_streams
    first, _, ev = _drops(spark, sf_dir)
    src, target, ckpt = (scratch_path(spark, f"stream/{n}") for n in ("src", "target", "checkpoint"))
    spec = SourceSpec("newest", "latest_file", src, target, "incremental", timestamp_col="ts", options={"pattern": "drop_*"})
    for name, rows in (("drop_1", first), ("drop_2", ev)):
        rows.write.parquet(f"{src}/{name}.parquet")
        start_streams(spark, [spec], {}, ckpt, once=True)
    return ST.read_target(spark, target, EV_COLS)


@register("stream_payloads", LATEST_SQL)
def _stream_payloads(spark, sf_dir):
    """Payload pages streamed, unwrapped and upserted batch by batch, with a restart."""
    from .jobs import SourceSpec, start_streams
    first, second, ev = _drops(spark, sf_dir)
    src, target, ckpt = (scratch_path(spark, f"stream/{n}") for n in ("src", "target", "checkpoint"))
    item = F.struct(*EV_COLS)
    schema = T.StructType([T.StructField("data", T.ArrayType(ev.select(item.alias("x")).schema["x"].dataType))])
    spec = SourceSpec("pages", "api_payload", src, target, "upsert", primary_key=["user_id"], order_by=["ts", "event_id"])
    for rows in (first, second):
        pages = rows.groupBy(F.floor(F.col("event_id") / 100)).agg(F.collect_list(item).alias("data"))  # <= 100 rows a page
        pages.select("data").write.mode("append").option("timestampNTZFormat", FS.TS_MICROS).json(src)
        start_streams(spark, [spec], {"pages": schema}, ckpt, once=True)
    return ST.read_target(spark, target, EV_COLS)


@register("sync_new_columns", """
SELECT event_id, ts, user_id, value, CASE WHEN ts > (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) THEN props END AS props
FROM events""")
def _sync_new_columns(spark, sf_dir):
    """A later extract brings a column and a wider type; neither is lost."""
    first, _, ev = _drops(spark, sf_dir)
    cols = ["event_id", "ts", "user_id", "value"]
    target = TB.table_path(spark, "events_columns")
    SY.sync_incremental(first.select("event_id", "ts", F.col("user_id").cast("int").alias("user_id"), "value"), target, "ts")
    return SY.sync_incremental(ev.select(*cols, "props"), target, "ts").select(*cols, "props")


@register("upsert_new_columns", """
WITH t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT event_id, ts, user_id, CASE WHEN ts > (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) THEN props END AS props
FROM t WHERE rn = 1""")
def _upsert_new_columns(spark, sf_dir):
    """K9: the rows that a wider change set touches get its new column, the others NULL."""
    first, second, _ = _drops(spark, sf_dir)
    cols = ["event_id", "ts", "user_id"]
    target = TB.table_path(spark, "events_upsert_columns")
    SY.sync_upsert(first.select(*cols), target, ["user_id"], ["ts", "event_id"], buckets=UPSERT_BUCKETS)
    out = SY.sync_upsert(second.select(*cols, "props"), target, ["user_id"], ["ts", "event_id"], buckets=UPSERT_BUCKETS)
    return out.select(*cols, "props")


@register("round_wide", """
WITH v AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 2e13 WHEN 1 THEN 1e17 WHEN 2 THEN 'inf'::DOUBLE
           WHEN 3 THEN '-inf'::DOUBLE WHEN 4 THEN 'nan'::DOUBLE ELSE value END AS x FROM events)
SELECT event_id,
       CASE WHEN isnan(x) OR abs(x) * 1000000.0 >= 9007199254740992.0 THEN x
            ELSE sign(x) * floor(abs(x) * 1000000.0 + 0.5) / 1000000.0 END AS six,
       CASE WHEN isnan(x) OR abs(x) * 100.0 >= 9007199254740992.0 THEN x
            ELSE sign(x) * floor(abs(x) * 100.0 + 0.5) / 100.0 END AS two FROM v""")
def _round_wide(spark, sf_dir):
    """F4 over values that a BIGINT cannot hold, infinities and NaN."""
    k = F.col("event_id") % 6
    x = (F.when(k == 0, 2e13).when(k == 1, 1e17).when(k == 2, float("inf")).when(k == 3, float("-inf"))
         .when(k == 4, float("nan")).otherwise(F.col("value")))
    return _events(spark, sf_dir).select("event_id", round_ieee(x, 6).alias("six"), round_ieee(x, 2).alias("two"))


# ------------------------------------------------------------------ more registered forms

def _numeric_features_sql():
    cols = [c for c in ALL_FEATURES if c not in ("feat_profit_tier", "feat_volume_category")]
    inner = O.features_sql(*[v[2] for v in FEATURE_SETS.values()])
    return f"SELECT {', '.join(cols)} FROM ({inner}) f"


@register("numeric_features", _numeric_features_sql())
def _numeric_features_q(spark, sf_dir):
    num = FE.numeric_features(FE.build_features(_summary(spark, sf_dir)))
    return num.select(*[round_ieee(c, 6).alias(c) if c in FLOAT_NOISE else F.col(c) for c in num.columns])


@register("dq_report_purchases", O.dq_details_sql(
    O.STAR, "purchases", PURCHASE_COLS, set(), DQ.VALIDATION_PROFILES["purchases"]))
def _dq_report_purchases(spark, sf_dir):
    p = stored_star(spark, sf_dir).purchases
    return DQ.details_frame(DQ.DataQualityValidator().check_frame(p, "purchases"), O.DQ_DETAILS)


SALES_COLS = ["InventoryId", "Store", "Brand", "VendorNo", "SalesQuantity", "SalesPrice",
              "SalesDollars", "SalesDate", "ExciseTax"]


@register("dq_report_sales", O.dq_details_sql(
    O.STAR, "sales", SALES_COLS, set(), DQ.VALIDATION_PROFILES["sales"]))
def _dq_report_sales(spark, sf_dir):
    s = stored_star(spark, sf_dir).sales
    return DQ.details_frame(DQ.DataQualityValidator().check_frame(s, "sales"), O.DQ_DETAILS)


@register("csv_export", O.q(O.SUMMARY_CLEAN, "SELECT * FROM vendor_summary"))
def _csv_export(spark, sf_dir):
    """K5: export with a timestamped name, read back with the summary schema."""
    df = _summary(spark, sf_dir)
    path = TB.export_csv(df, scratch_path(spark, "exports"))
    return FS.csv_reader(spark.read).schema(df.schema).csv(path)


@register("summary_job", O.q(O.SUMMARY_CLEAN, "SELECT * FROM vendor_summary"))
def _summary_job(spark, sf_dir):
    """K6: output switch 'both' (table + CSV); the table is read back."""
    from .jobs import vendor_summary_job
    path = TB.table_path(spark, "vendor_sales_summary_job")
    vendor_summary_job(spark, sf_dir, output="both", table_path=path,
                       csv_dir=scratch_path(spark, "job_exports"))
    return spark.read.parquet(path)


EVENTS_PROFILE = {
    "events": {
        "required_columns": ["event_id", "ts", "user_id", "event_type", "value"],
        "numeric_columns": ["event_id", "user_id", "value"],
        "non_nullable": ["event_id", "event_type"],
        "unique_keys": ["event_id"],
        "range_checks": {"value": {"min": 0, "max": 50}},
        "null_threshold": 0.01,
    }
}


@register("dq_custom", O.dq_details_sql([("ev", "SELECT * FROM events")], "ev", EV_COLS, {"value"},
                                        EVENTS_PROFILE["events"]))
def _dq_custom(spark, sf_dir):
    """A user profile (with unique_keys) over the events table."""
    v = DQ.DataQualityValidator(EVENTS_PROFILE)
    return DQ.details_frame(v.check_frame(_events(spark, sf_dir), "events"), O.DQ_DETAILS)


IQR_PROFILE = {"events_iqr": {**EVENTS_PROFILE["events"], "iqr_columns": ["value", "user_id"], "iqr_factor": 1.0}}


def _iqr_sql(c):
    """Quartiles by linear interpolation between the neighbouring ranks."""
    return f"""SELECT 'iqr_{c}' AS check, far < n * 0.05 AS passed, far AS outlier_count, {O.rnd('(far / n * 100)', 2)} AS outlier_pct,
       {O.rnd('lo', 6)} AS lower, {O.rnd('hi', 6)} AS upper
FROM (SELECT count({c}) AS n, count_if({c} < lo OR {c} > hi) AS far, any_value(lo) AS lo, any_value(hi) AS hi FROM events,
      (SELECT q1 - (q3 - q1) AS lo, q3 + (q3 - q1) AS hi
       FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM events)))"""


@register("dq_iqr", " UNION ALL ".join(_iqr_sql(c) for c in ("value", "user_id")))
def _dq_iqr(spark, sf_dir):
    """The fences of a profile's ``iqr_columns`` and the values beyond them."""
    v = DQ.DataQualityValidator(IQR_PROFILE)
    rows = DQ.details_frame(v.check_frame(_events(spark, sf_dir), "events_iqr").where("check LIKE 'iqr_%'"),
                            {"outlier_count": "BIGINT", "outlier_pct": "DOUBLE", "lower": "DOUBLE", "upper": "DOUBLE"})
    return rows.withColumns({c: round_ieee(c, 6) for c in ("lower", "upper")})


def _reference_sql(ref):
    keys = ", ".join(ref.keys)
    none = " OR ".join(f"{k} IS NULL" for k in ref.keys)
    same = " AND ".join(f"p.{p} = c.{k}" for k, p in zip(ref.keys, ref.parent_keys))
    shown = " || '/' || ".join(f"CAST({k} AS VARCHAR)" for k in ref.keys)
    return f"""SELECT '{ref.name}' AS check, failed = 0 AS passed, checked, without_key, failed, failed_keys,
       CASE WHEN checked > 0 THEN failed * 100 / checked ELSE 0 END AS failed_pct, COALESCE(examples, '') AS examples
FROM (SELECT count(*) AS checked, count_if({none}) AS without_key FROM {ref.child}),
     (SELECT CAST(COALESCE(sum(n), 0) AS BIGINT) AS failed, count(*) AS failed_keys,
             string_agg({shown}, ', ' ORDER BY place) FILTER (WHERE place <= 5) AS examples
      FROM (SELECT {keys}, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {keys}) AS place FROM {ref.child} c
            WHERE NOT ({none}) AND NOT EXISTS (SELECT 1 FROM {ref.parent} p WHERE {same}) GROUP BY {keys}))"""


def _balance_sql(b):
    keys = ", ".join(b.keys)
    sums = ", ".join(f"sum({m}) AS s{i}" for i, m in enumerate(b.measures))
    differ = " OR ".join(f"l.s{i} IS DISTINCT FROM r.s{i}" for i in range(len(b.measures)))
    shown = " || '/' || ".join(f"CAST({k} AS VARCHAR)" for k in b.keys)
    return f"""SELECT '{b.name}' AS check, count_if(bad) = 0 AS passed, count(*) AS checked, CAST(0 AS BIGINT) AS without_key,
       count_if(bad) AS failed, count_if(bad) AS failed_keys,
       CASE WHEN count(*) > 0 THEN count_if(bad) * 100 / count(*) ELSE 0 END AS failed_pct,
       COALESCE(string_agg({shown}, ', ' ORDER BY {keys}) FILTER (WHERE bad AND place <= 5), '') AS examples
FROM (SELECT *, row_number() OVER (PARTITION BY bad ORDER BY {keys}) AS place
      FROM (SELECT {keys}, l.a IS NULL OR r.a IS NULL OR {differ} AS bad
            FROM (SELECT {keys}, {sums}, true AS a FROM {b.left} GROUP BY {keys}) l
            FULL JOIN (SELECT {keys}, {sums}, true AS a FROM {b.right} GROUP BY {keys}) r USING ({keys})))"""


@register("dq_cross_table", O.q(O.STAR, " UNION ALL ".join(
    f"({_reference_sql(c) if isinstance(c, CO.Reference) else _balance_sql(c)})" for c in CO.PROCUREMENT_CHECKS)))
def _dq_cross_table(spark, sf_dir):
    """References between the procurement tables, and the invoices' sums."""
    star = stored_star(spark, sf_dir)
    tables = {t: getattr(star, t) for t in ("purchases", "sales", "purchase_prices", "vendor_invoice")}
    return CO.cross_checks(tables, CO.PROCUREMENT_CHECKS)


@register("dq_infinite", """
SELECT 'value' AS "column", count(value) AS n, CAST('inf' AS DOUBLE) AS mean, CAST('nan' AS DOUBLE) AS std,
       CAST(0 AS BIGINT) AS outlier_count, CAST(0 AS DOUBLE) AS outlier_pct, true AS passed FROM events""")
def _dq_infinite(spark, sf_dir):
    """D6 with an infinity: no deviation can be told, so nothing counts as an outlier."""
    value = F.when(F.col("event_id") % 100 == 0, float("inf")).otherwise(F.col("value"))
    return DQ.outlier_frame(_events(spark, sf_dir).withColumn("value", value), {"numeric_columns": ["value"]})


@register("feat_infinite", O.features_sql(" CAST(0 AS DOUBLE) AS feat_zscore_profit_margin"))
def _feat_infinite(spark, sf_dir):
    """E22 with infinite margins: the deviation is unknown, so every z-score is 0."""
    margin = F.when(F.col("VendorNumber") == 7, float("inf")).otherwise(F.col("ProfitMargin"))
    return FE.statistical(_summary(spark, sf_dir).withColumn("ProfitMargin", margin)).select(*KEY7, "feat_zscore_profit_margin")


@register("multi_source_sync", O.q(O.STAR, """
SELECT 'events_parquet' AS source_name, CAST(1 AS BIGINT) AS total_syncs, CAST(1 AS BIGINT) AS successful_syncs,
       CAST(0 AS BIGINT) AS failed_syncs, (SELECT count(*) FROM events) AS total_rows_processed
UNION ALL SELECT 'events_json', 1, 1, 0, (SELECT count(*) FROM events)
UNION ALL SELECT 'purchases_csv', 1, 1, 0, (SELECT count(*) FROM purchases)
UNION ALL SELECT 'missing_drop', 1, 0, 1, 0"""))
def _multi_source_sync(spark, sf_dir):
    """R1 one pass + R2 + R5 + R6 + U3: sources of three formats synced with
    their own modes; a disabled source is skipped, a missing one fails alone."""
    from .jobs import SourceSpec, run_pipeline
    ev = _events(spark, sf_dir)

    def write(land):
        ev.write.parquet(f"{land}/events_parquet")
        ev.write.option("timestampNTZFormat", FS.TS_MICROS).json(f"{land}/events_json")
        FS.write_csv(stored_star(spark, sf_dir).purchases, f"{land}/purchases_csv")
    land = landed(spark, sf_dir, "multi_source", write)
    tgt = scratch_path(spark, "targets_multi")
    specs = [
        SourceSpec("events_parquet", "parquet", f"{land}/events_parquet", f"{tgt}/events_a",
                   "upsert", primary_key=["event_id"], order_by=["ts"]),
        SourceSpec("events_json", "json", f"{land}/events_json", f"{tgt}/events_b",
                   "incremental", timestamp_col="ts", options={"schema": EVENTS_DDL}),
        SourceSpec("purchases_csv", "csv", f"{land}/purchases_csv", f"{tgt}/purchases", "full"),
        SourceSpec("missing_drop", "parquet", f"{land}/not_there", f"{tgt}/never", "full"),
        SourceSpec("switched_off", "parquet", f"{land}/events_parquet", f"{tgt}/off", enabled=False),
    ]
    hist = f"{tgt}/sync_history"
    run_pipeline(spark, specs, hist)
    return SY.sync_status(spark.read.parquet(hist)).drop("last_sync")


def land_inputs(spark, sf_dir) -> None:
    """Derive every landing folder the load queries read (once per session)."""
    _land_quoted_csv(spark, sf_dir)
    _land_star_csv(spark, sf_dir)


def store_summaries(spark, sf_dir) -> None:
    """Write the stage tables that the quality, feature and analysis queries read."""
    for build in (_summary, _eda, _eda_clean):
        build(spark, sf_dir)
