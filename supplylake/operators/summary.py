"""Vendor x brand summaries: aggregates A1-A7, joins J1-J4, vendor shares
(W1/W2) and the derived metrics M0-M15.

Plan shape (checked with ``explain``): each transaction table is reduced by
a partial+final hash aggregate *before* it meets anything else, the planner and
adaptive execution choose each join from measured bytes, and vendor-level totals
are an aggregate joined back on the vendor key instead of a window, so a vendor
holding a third of all rows is reduced map-side instead of landing whole in
one window task.  Where totals and rows come from the same aggregate it is stored
once, so purchases are scanned once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.semantics import (
    exact_sum, nan_to_null, round_ieee, safe_ratio, strip_ws, to_number,
)
from ..session import stored
from ..sources.star import Star

# Defaults that stand in for the reference's 2024 floor and current date on
# the generated data (dates span 1995-01 .. 2001-11).
DEFAULT_SINCE = _dt.date(1998, 1, 1)
DEFAULT_AS_OF = _dt.date(2002, 1, 1)

MONEY = "double"


def _d(c: str):
    return F.col(c).cast(MONEY)


# ---------------------------------------------------------------- A1 / A2 / A3

def freight_summary(vendor_invoice: DataFrame, name: str = "FreightCost",
                    since=None) -> DataFrame:
    """A1: freight per vendor (exact DECIMAL sum)."""
    vi = vendor_invoice
    if since is not None:
        vi = vi.where(F.col("InvoiceDate") >= F.lit(since))
    return vi.groupBy("VendorNumber").agg(F.sum("Freight").alias(name))


def _names(collation: str | None):
    """Text group keys, optionally under a collation (e.g. ``UTF8_LCASE``
    merges case variants the way a case-insensitive database column does).
    Default: binary comparison (SURVEY §8.16)."""
    if collation is None:
        return [F.col("VendorName"), F.col("Description")]
    return [F.collate("VendorName", collation).alias("VendorName"),
            F.collate("Description", collation).alias("Description")]


BOUGHT = ["VendorNumber", "VendorName", "Brand", "Description", "PurchasePrice"]


def _bought(star: Star, collation: str | None = None) -> DataFrame:
    """Paid purchases summed by ``BOUGHT``, so that what meets the price list is no longer
    a row for each purchase; the totals are summed again where lists are grouped."""
    name, desc = _names(collation)
    return (star.purchases.where(F.col("PurchasePrice") > 0)
            .select("VendorNumber", name, "Brand", desc,
                    "PurchasePrice", "Quantity", "Dollars")
            .groupBy(*BOUGHT)
            .agg(F.sum("Quantity").alias("TotalPurchaseQuantity"),
                 F.sum("Dollars").alias("TotalPurchaseDollars")))


def _by_price(bought: DataFrame, joined: DataFrame, *price: str) -> DataFrame:
    """Totals by ``BOUGHT`` and the columns of the price list, which may repeat a brand."""
    totals = ("TotalPurchaseQuantity", "TotalPurchaseDollars")
    return joined.groupBy(*BOUGHT, *price).agg(
        *[F.sum(c).cast(bought.schema[c].dataType).alias(c) for c in totals])


def purchase_summary(star: Star, collation: str | None = None) -> DataFrame:
    """A2 + J1: purchases x price list on Brand only, grouped by 7 columns."""
    pp = star.purchase_prices.select("Brand", F.col("Price").alias("ActualPrice"), "Volume")
    bought = _bought(star, collation)
    return _by_price(bought, bought.join(pp, "Brand"), "ActualPrice", "Volume")


def sales_summary(sales: DataFrame, price_agg: str = "sum") -> DataFrame:
    """A3 (SUM of SalesPrice) or A4 (AVG of SalesPrice) per vendor x brand."""
    if price_agg == "sum":
        price = F.sum("SalesPrice").alias("TotalSalesPrice")
    else:
        # exact sum / count: bit-identical across engines, unlike avg(double)
        price = (F.sum("SalesPrice").cast(MONEY) / F.count("SalesPrice")).alias("AvgSalesPrice")
    return (sales.groupBy("VendorNo", "Brand")
            .agg(F.sum("SalesQuantity").alias("TotalSalesQuantity"),
                 F.sum("SalesDollars").alias("TotalSalesDollars"),
                 price,
                 F.sum("ExciseTax").alias("TotalExciseTax")))


# ---------------------------------------------------------------- M0 / M1 / M2-M7

RAW_COLUMNS = [
    "VendorNumber", "VendorName", "Brand", "Description", "PurchasePrice",
    "ActualPrice", "Volume", "TotalPurchaseQuantity", "TotalPurchaseDollars",
    "TotalSalesQuantity", "TotalSalesDollars", "TotalSalesPrice",
    "TotalExciseTax", "FreightCost",
]
MEASURES = [c for c in RAW_COLUMNS if c not in
            ("VendorNumber", "VendorName", "Brand", "Description", "Volume")]


def vendor_summary_raw(star: Star, ordered: bool = True, collation: str | None = None) -> DataFrame:
    """M0: the core 14-column summary (purchase x sales x freight)."""
    ps = purchase_summary(star, collation)
    ss = sales_summary(star.sales, "sum")
    fs = freight_summary(star.vendor_invoice)
    j = (ps.join(ss, (ps.VendorNumber == ss.VendorNo) & (ps.Brand == ss.Brand), "left")
         .drop(ss.VendorNo).drop(ss.Brand)
         .join(fs, "VendorNumber", "left"))
    out = j.select(
        "VendorNumber", "VendorName", "Brand", "Description",
        *[_d(c).alias(c) if c in MEASURES else F.col(c) for c in RAW_COLUMNS[4:]])
    return out.orderBy(F.desc("TotalPurchaseDollars")) if ordered else out


def clean_summary(raw: DataFrame) -> DataFrame:
    """M1: Volume -> number (bad -> 0), numeric nulls -> 0, strip two text columns."""
    cols = {"Volume": F.coalesce(to_number("Volume"), F.lit(0.0))}
    for c in MEASURES:
        if c in raw.columns:
            cols[c] = F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(0.0))
    for c in ("VendorName", "Description"):
        if c in raw.columns:
            cols[c] = strip_ws(c)
    return raw.withColumns(cols)


def add_summary_metrics(df: DataFrame) -> DataFrame:
    """M2-M7 with the script's ``!= 0`` guards."""
    gp = F.col("TotalSalesDollars") - F.col("TotalPurchaseDollars")
    return df.withColumn("GrossProfit", gp).withColumns({
        "ProfitMargin": safe_ratio("GrossProfit", "TotalSalesDollars", 100, guard="ne"),
        "StockTurnover": safe_ratio("TotalSalesQuantity", "TotalPurchaseQuantity", guard="ne"),
        "SalesToPurchaseRatio": safe_ratio("TotalSalesDollars", "TotalPurchaseDollars", guard="ne"),
        "FreightToSalesRatio": safe_ratio("FreightCost", "TotalSalesDollars", 100, guard="ne"),
        "PriceMarkup": safe_ratio(F.col("ActualPrice") - F.col("PurchasePrice"),
                                  "PurchasePrice", 100, guard="ne"),
    })


def vendor_summary(star: Star, ordered: bool = True, collation: str | None = None) -> DataFrame:
    """The flagship: cleaned core summary with derived metrics (20 columns)."""
    return add_summary_metrics(clean_summary(vendor_summary_raw(star, ordered, collation)))


# ---------------------------------------------------------------- vendor shares

def vendor_share(df: DataFrame, value: str, total_name: str) -> DataFrame:
    """Attach the per-vendor total of ``value`` (W1/W2/W3 merge-back form).

    Computed as a partial+final aggregate joined back on the vendor key
    (null-safe, like a window partition).  A window would put every row of a
    hot vendor into one task; the aggregate reduces it map-side, and the
    join-back is a plain equi-join that AQE can broadcast or split.
    """
    if isinstance(df.schema[value].dataType, T.DecimalType):  # already exact: no double round trip
        exact = F.sum(F.col(value).cast(T.DecimalType(38, 4))).cast(MONEY)
    else:
        exact = exact_sum(value)
    tot = (df.groupBy("VendorNumber").agg(exact.alias(total_name))
           .withColumnRenamed("VendorNumber", "_vkey"))
    return (df.join(tot, df.VendorNumber.eqNullSafe(tot._vkey), "left")
            .drop("_vkey"))


# ---------------------------------------------------------------- M8: EDA summary

def eda_purchase_summary(star: Star) -> DataFrame:
    """A2 + J2: left join on Brand + VendorNumber (the notebook's fix)."""
    pp = star.purchase_prices.select(
        "Brand", "VendorNumber", F.col("PurchasePrice").alias("ReferencePurchasePrice"), "Volume")
    bought = _bought(star)
    return _by_price(bought, bought.join(pp, ["Brand", "VendorNumber"], "left"), "ReferencePurchasePrice", "Volume")


EDA_COLUMNS = [
    "VendorNumber", "VendorName", "Brand", "Description", "PurchasePrice",
    "ReferencePurchasePrice", "Volume", "TotalPurchaseQuantity",
    "TotalPurchaseDollars", "TotalSalesQuantity", "TotalSalesDollars",
    "AvgSalesPrice", "TotalExciseTax", "VendorTotalFreight",
    "EstimatedGrossProfitProxy",
]


def eda_summary(star: Star, ordered: bool = True) -> DataFrame:
    """M8: 15-column notebook summary with a freight-allocated profit proxy."""
    ps = vendor_share(stored(eda_purchase_summary(star), "eda_purchases"), "TotalPurchaseDollars", "_vendor_cost")
    ss = sales_summary(star.sales, "avg")
    fs = freight_summary(star.vendor_invoice, "TotalFreightCost")
    j = (ps.join(ss, (ps.VendorNumber == ss.VendorNo) & (ps.Brand == ss.Brand), "left")
         .drop(ss.VendorNo).drop(ss.Brand)
         .join(fs, "VendorNumber", "left"))
    cost = _d("TotalPurchaseDollars")
    vendor_cost = _d("_vendor_cost")
    share = cost / F.when(vendor_cost != 0, vendor_cost)
    alloc = F.coalesce(_d("TotalFreightCost") * share, F.lit(0.0))
    sales_d = F.coalesce(_d("TotalSalesDollars"), F.lit(0.0))
    out = j.select(
        "VendorNumber", "VendorName", "Brand", "Description",
        _d("PurchasePrice").alias("PurchasePrice"),
        _d("ReferencePurchasePrice").alias("ReferencePurchasePrice"),
        "Volume",
        _d("TotalPurchaseQuantity").alias("TotalPurchaseQuantity"),
        cost.alias("TotalPurchaseDollars"),
        F.coalesce(_d("TotalSalesQuantity"), F.lit(0.0)).alias("TotalSalesQuantity"),
        sales_d.alias("TotalSalesDollars"),
        F.col("AvgSalesPrice"),
        F.coalesce(_d("TotalExciseTax"), F.lit(0.0)).alias("TotalExciseTax"),
        _d("TotalFreightCost").alias("VendorTotalFreight"),
        round_ieee(sales_d - cost - alloc, 2).alias("EstimatedGrossProfitProxy"),
    )
    return out.orderBy(F.desc("TotalPurchaseDollars")) if ordered else out


# ---------------------------------------------------------------- A5 / A6 / M9

def brand_purchases(star: Star, since=DEFAULT_SINCE) -> DataFrame:
    """A5: brand-level purchases since a date (any_value -> min for determinism)."""
    pp = star.purchase_prices.select(
        "Brand", "VendorNumber", F.col("PurchasePrice").alias("_ref_price"), "Volume")
    p = (star.purchases
         .where((F.col("PurchasePrice") > 0) & (F.col("ReceivingDate") >= F.lit(since)))
         .select("VendorNumber", "VendorName", "Brand", "Description", "Quantity",
                 "Dollars", "PONumber", "ReceivingDate")
         .join(pp, ["Brand", "VendorNumber"], "left"))
    keys = ["VendorNumber", "VendorName", "Brand"]
    # Purchases are reduced once, by hashes, to a row for each order and text;
    # sums, text minima and the distinct count all come from those.
    parts = p.groupBy(*keys, "Description", "Volume", "PONumber").agg(
        F.sum("Dollars").alias("_dollars"), F.sum("Quantity").alias("_quantity"),
        F.min("_ref_price").alias("_ref"), F.max("ReceivingDate").alias("_received"))
    g = parts.groupBy(*keys).agg(
        F.sum("_dollars").alias("_dollars"), F.sum("_quantity").alias("TotalPurchaseQty"),
        F.min("_ref").alias("_ref"), F.count_distinct("PONumber").alias("DistinctPOs"),
        F.max("_received").alias("LastReceiptDate"),
        F.min("Description").alias("MostCommonDescription"), F.min("Volume").alias("VolumeML"))
    qty = F.col("TotalPurchaseQty").cast("double")
    return g.select(
        "VendorNumber", "VendorName", "Brand", "MostCommonDescription",
        round_ieee(_d("_dollars") / F.when(qty != 0, qty), 4).alias("WeightedAvgPurchasePrice"),
        _d("_ref").alias("ReferencePurchasePrice"),
        "VolumeML", "TotalPurchaseQty",
        _d("_dollars").alias("TotalPurchaseCost"),
        "DistinctPOs", "LastReceiptDate",
    )


def brand_sales(star: Star, since=DEFAULT_SINCE) -> DataFrame:
    """Brand-level sales since a date."""
    s = star.sales.where(F.col("SalesDate") >= F.lit(since))
    g = s.groupBy("VendorNo", "Brand").agg(
        F.sum("SalesQuantity").alias("TotalSalesQty"),
        F.sum("SalesDollars").alias("_rev"),
        F.sum("SalesPrice").alias("_price_sum"),
        F.count("SalesPrice").alias("_price_n"),
        F.sum("ExciseTax").alias("_tax"),
        F.max("SalesDate").alias("LastSaleDate"),
        F.count_distinct("SalesDate").alias("SellingDays"),
    )
    return g.select(
        F.col("VendorNo").alias("VendorNumber"), "Brand", "TotalSalesQty",
        _d("_rev").alias("TotalSalesRevenue"),
        round_ieee(_d("_price_sum") / F.col("_price_n"), 4).alias("AvgSellingPrice"),
        _d("_tax").alias("TotalExciseTax"),
        "LastSaleDate", "SellingDays",
    )


BRAND_COLUMNS = [
    "VendorNumber", "VendorName", "Brand", "MostCommonDescription", "VolumeML",
    "WeightedAvgPurchasePrice", "ReferencePurchasePrice", "TotalPurchaseQty",
    "TotalPurchaseCost", "DistinctPOs", "LastReceiptDate", "TotalSalesQty",
    "TotalSalesRevenue", "AvgSellingPrice", "TotalExciseTax", "LastSaleDate",
    "SellingDays", "VendorTotalFreight", "AllocatedFreight", "TotalLandedCost",
    "EstimatedGrossProfit", "GrossMarginPct", "SellThroughRatio",
    "DaysSinceLastPurchase", "DaysSinceLastSale",
]


def brand_summary(star: Star, since=DEFAULT_SINCE, as_of=DEFAULT_AS_OF,
                  ordered: bool = True) -> DataFrame:
    """Brand summary with allocated freight, landed cost and margins."""
    ps = vendor_share(stored(brand_purchases(star, since), "brand_purchases"), "TotalPurchaseCost", "_vendor_cost")
    ss = brand_sales(star, since).withColumnsRenamed(
        {"VendorNumber": "_sv", "Brand": "_sb", "TotalSalesQty": "_sqty",
         "TotalSalesRevenue": "_srev", "TotalExciseTax": "_stax"})
    fs = freight_summary(star.vendor_invoice, "_freight", since=since)
    j = (ps.join(ss, (ps.VendorNumber == ss._sv) & (ps.Brand == ss._sb), "left")
         .join(fs, "VendorNumber", "left"))
    cost = F.col("TotalPurchaseCost")
    vc = F.col("_vendor_cost")
    alloc = F.coalesce(_d("_freight") * (cost / F.when(vc != 0, vc)), F.lit(0.0))
    rev = F.coalesce(F.col("_srev"), F.lit(0.0))
    landed = cost + alloc
    qty = F.col("TotalPurchaseQty")
    out = j.select(
        "VendorNumber", "VendorName", "Brand", "MostCommonDescription", "VolumeML",
        "WeightedAvgPurchasePrice", "ReferencePurchasePrice", "TotalPurchaseQty",
        "TotalPurchaseCost", "DistinctPOs", "LastReceiptDate",
        F.coalesce(F.col("_sqty"), F.lit(0)).alias("TotalSalesQty"),
        rev.alias("TotalSalesRevenue"),
        "AvgSellingPrice",
        F.coalesce(F.col("_stax"), F.lit(0.0)).alias("TotalExciseTax"),
        "LastSaleDate", "SellingDays",
        _d("_freight").alias("VendorTotalFreight"),
        round_ieee(alloc, 2).alias("AllocatedFreight"),
        round_ieee(landed, 2).alias("TotalLandedCost"),
        round_ieee(rev - landed, 2).alias("EstimatedGrossProfit"),
        round_ieee(F.when(rev != 0, F.lit(100.0) * (rev - landed) / rev), 2).alias("GrossMarginPct"),
        round_ieee(F.when(qty != 0, F.col("_sqty") / qty), 3).alias("SellThroughRatio"),
        F.datediff(F.lit(as_of), F.col("LastReceiptDate")).alias("DaysSinceLastPurchase"),
        F.datediff(F.lit(as_of), F.col("LastSaleDate")).alias("DaysSinceLastSale"),
    )
    if ordered:
        out = out.orderBy(F.desc("EstimatedGrossProfit"), F.desc("TotalSalesRevenue"))
    return out


# ---------------------------------------------------------------- P2 / A7 / O2 / O3

def vendor_slice(star: Star, vendor: int) -> DataFrame:
    """P2 + A7: one vendor's purchases summed by (Brand, PurchasePrice)."""
    return (star.purchases.where(F.col("VendorNumber") == F.lit(vendor))
            .groupBy("Brand", "PurchasePrice")
            .agg(F.sum("Quantity").alias("Quantity"), F.sum("Dollars").cast(MONEY).alias("Dollars"))
            .withColumn("PurchasePrice", _d("PurchasePrice")))


def vendor_brand_sums(star: Star) -> DataFrame:
    """A7 over every vendor: sales sums per (vendor, brand)."""
    return (star.sales.groupBy("VendorNo", "Brand")
            .agg(F.sum("SalesDollars").cast(MONEY).alias("SalesDollars"),
                 F.sum("SalesPrice").cast(MONEY).alias("SalesPrice"),
                 F.sum("SalesQuantity").alias("SalesQuantity")))


def top_vendors(summary: DataFrame, n: int = 10) -> DataFrame:
    """O1/O3: head(n) of the summary after a total order (unique tiebreak)."""
    return summary.orderBy(F.desc("TotalPurchaseDollars"), "VendorNumber", "Brand",
                           "Description", "PurchasePrice").limit(n)


def brand_summary_top(brand: DataFrame, n: int = 20) -> DataFrame:
    """O2: top-n by (EstimatedGrossProfit, TotalSalesRevenue) DESC, unique tiebreak."""
    return brand.orderBy(F.desc_nulls_last("EstimatedGrossProfit"),
                         F.desc_nulls_last("TotalSalesRevenue"),
                         "VendorNumber", "Brand", "VendorName").limit(n)
