"""Imputation and the notebook metric set.

Row-wise ``apply`` fallbacks become one projection over joined medians: all
brand and global medians come from one distributed sort, the former joined
back on Brand, the latter as scalar subqueries.  No Python runs per row.

Median semantics follow pandas: NULLs skipped, linear interpolation.
``Series.get(brand, default)`` returns a stored NaN, so a brand whose values
are all missing keeps a missing median instead of taking the global one
(SURVEY §8.10); the global median only serves rows whose Brand is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.semantics import (
    clip_keep_null, nan_to_null, round_ieee, safe_ratio, strip_ws, to_number,
)
from .quantiles import quantiles

DEFAULT_VOLUME = 750.0
DEFAULT_MARKUP = 1.5


def prepare(eda: DataFrame) -> DataFrame:
    """Steps before imputation: strip VendorName, Volume to number,
    ReferencePurchasePrice <- PurchasePrice when missing (I1)."""
    return eda.withColumns({
        "VendorName": strip_ws("VendorName"),
        "Volume": to_number("Volume"),
        "ReferencePurchasePrice": F.coalesce(nan_to_null("ReferencePurchasePrice"),
                                             F.col("PurchasePrice")),
    })


MEASURES = ("volume", "price", "markup")


def medians(df: DataFrame) -> DataFrame:
    """Exact medians of Volume, AvgSalesPrice and implied markup
    (average price / reference price, where both exist and the reference is
    positive), for each brand and over all rows: ``measure, scope`` ("brand" or
    "all"), ``Brand`` and ``median``, from one distributed sort."""
    ref, avg = F.col("ReferencePurchasePrice"), nan_to_null("AvgSalesPrice")
    values = {"volume": nan_to_null("Volume").cast("double"), "price": avg.cast("double"),
              "markup": F.when(ref > 0, avg / ref).cast("double")}
    each = F.array(*[F.struct(F.lit(m).alias("measure"), values[m].alias("value")) for m in MEASURES])
    scopes = F.array(F.struct(F.lit("brand").alias("scope"), F.col("Brand").alias("key")),
                     F.struct(F.lit("all").alias("scope"), F.lit(0).cast(df.schema["Brand"].dataType).alias("key")))
    long = (df.select("Brand", F.inline(each)).where(F.col("value").isNotNull())
            .select("measure", "value", F.inline(scopes)))
    return (quantiles(long, "value", [0.5], ["measure", "scope", "key"], ["median"])
            .select("measure", "scope", F.col("key").alias("Brand"), "median"))


def _of_brand(found: DataFrame, names: dict[str, str]) -> DataFrame:
    """Per brand one column for each measure in ``names``."""
    return found.where(F.col("scope") == "brand").groupBy("Brand").agg(
        *[F.max(F.when(F.col("measure") == m, F.col("median"))).alias(c) for m, c in names.items()])


def _of_all(found: DataFrame, measure: str):
    """A global median as a scalar subquery."""
    return found.where((F.col("scope") == "all") & (F.col("measure") == measure)).select("median").scalar()


def brand_medians(df: DataFrame) -> DataFrame:
    """A10: per-brand medians of Volume and AvgSalesPrice (NULL brand dropped; a
    brand with no values keeps a NULL median)."""
    brands = df.where(F.col("Brand").isNotNull()).select("Brand").distinct()
    found = _of_brand(medians(df), {"volume": "BrandVolumeMedian", "price": "BrandSalesPriceMedian"})
    return brands.join(found, "Brand", "left")


def brand_markup(df: DataFrame) -> DataFrame:
    """Median implied markup per brand that has one."""
    return _of_brand(medians(df), {"markup": "BrandMarkup"}).where(F.col("BrandMarkup").isNotNull())


def global_markup(df: DataFrame):
    """Global median markup as a scalar subquery; 1.5 when no valid row exists."""
    return F.coalesce(_of_all(medians(df), "markup"), F.lit(DEFAULT_MARKUP))


def impute(df: DataFrame, flags: bool = False) -> DataFrame:
    """I2 + I4: imputed Volume and AvgSalesPrice_imputed.

    Expects ``prepare``d input.  Adds ``AvgSalesPrice_imputed`` and replaces
    Volume; AvgSalesPrice itself is replaced by the imputed value later, as in
    the notebook.  ``flags`` adds ``VolumeWasMissing`` and ``PriceWasMissing``
    (P8).
    """
    found = medians(df)
    med = _of_brand(found, {"volume": "_volume", "price": "_price"}).withColumnRenamed("Brand", "_bkey")
    markup = F.coalesce(_of_all(found, "markup"), F.lit(DEFAULT_MARKUP))
    j = df.join(med, df.Brand == med._bkey, "left")
    vol, avg, ref = nan_to_null("Volume"), nan_to_null("AvgSalesPrice"), F.col("ReferencePurchasePrice")
    volume = (F.when(vol.isNotNull(), vol).when(F.col("Brand").isNotNull(), F.col("_volume"))
              .otherwise(_of_all(found, "volume")))
    price = (F.when(avg.isNotNull(), avg)
             .when(F.col("_price").isNotNull(), F.col("_price"))
             .when(ref.isNotNull() & (ref > 0), round_ieee(ref * markup, 2))
             .otherwise(_of_all(found, "price")))
    new = {"Volume": volume, "AvgSalesPrice_imputed": price}
    if flags:
        new |= {"VolumeWasMissing": vol.isNull(), "PriceWasMissing": avg.isNull()}
    return j.withColumns(new).drop("_bkey", "_volume", "_price")


def notebook_metrics(df: DataFrame) -> DataFrame:
    """M16-M18 + I5 on the imputed frame."""
    sales = F.col("TotalSalesDollars")
    gm = (sales - F.col("EstimatedGrossProfitProxy")) / F.when(sales != 0, sales) * 100
    st = F.col("TotalSalesQuantity") / F.when(F.col("TotalPurchaseQuantity") != 0,
                                              F.col("TotalPurchaseQuantity"))
    out = df.withColumns({
        "GrossMarginPct": F.coalesce(gm, F.lit(0.0)),
        "SellThroughRatio": st,
        "AvgSalesPrice": F.col("AvgSalesPrice_imputed"),
        "Volume": F.coalesce(F.col("Volume"), F.lit(DEFAULT_VOLUME)),
    })
    out = out.withColumn("GrossProfit", sales - F.col("TotalPurchaseDollars"))
    return out.withColumns({
        "ProfitMargin": safe_ratio("GrossProfit", "TotalSalesDollars", 100),
        "StockTurnover": safe_ratio("TotalSalesQuantity", "TotalPurchaseQuantity"),
        "SalesToPurchaseRatio": safe_ratio("TotalSalesDollars", "TotalPurchaseDollars"),
    })


def cap_and_null_inf(df: DataFrame) -> DataFrame:
    """M19 before the write: clip margins to [-50, 150]; +/-inf -> NULL everywhere."""
    df = df.withColumns({c: clip_keep_null(c, -50, 150) for c in ("GrossMarginPct", "ProfitMargin")})
    infs = [F.lit(float("inf")), F.lit(float("-inf"))]
    repl = {f.name: F.when(F.col(f.name).isin(*infs), F.lit(None)).otherwise(F.col(f.name))
            for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(repl)


EDA_CLEAN_COLUMNS = [
    "VendorNumber", "VendorName", "Brand", "Description", "PurchasePrice",
    "ReferencePurchasePrice", "Volume", "TotalPurchaseQuantity", "TotalPurchaseDollars",
    "TotalSalesQuantity", "TotalSalesDollars", "AvgSalesPrice", "TotalExciseTax",
    "VendorTotalFreight", "EstimatedGrossProfitProxy", "AvgSalesPrice_imputed",
    "GrossMarginPct", "SellThroughRatio", "GrossProfit", "ProfitMargin", "StockTurnover",
    "SalesToPurchaseRatio",
]


def eda_clean(eda: DataFrame) -> DataFrame:
    """The notebook's final 22-column table, before the typed write."""
    return cap_and_null_inf(notebook_metrics(impute(prepare(eda)))).select(*EDA_CLEAN_COLUMNS)


# The typed sink's column types (name -> Spark DDL type).
TYPED_SINK = {
    "VendorNumber": "INT", "VendorName": "VARCHAR(150)", "Brand": "INT",
    "Description": "VARCHAR(255)", "PurchasePrice": "DECIMAL(10,4)",
    "ReferencePurchasePrice": "DECIMAL(10,4)", "Volume": "DECIMAL(10,2)",
    "TotalPurchaseQuantity": "DECIMAL(12,2)", "TotalPurchaseDollars": "DECIMAL(14,2)",
    "TotalSalesQuantity": "DECIMAL(12,2)", "TotalSalesDollars": "DECIMAL(14,2)",
    "AvgSalesPrice": "DECIMAL(10,4)", "TotalExciseTax": "DECIMAL(12,2)",
    "VendorTotalFreight": "DECIMAL(12,2)", "EstimatedGrossProfitProxy": "DECIMAL(14,2)",
    "AvgSalesPrice_imputed": "DECIMAL(10,4)", "GrossMarginPct": "DECIMAL(8,4)",
    "SellThroughRatio": "DECIMAL(10,4)", "GrossProfit": "DECIMAL(14,2)",
    "ProfitMargin": "DECIMAL(8,4)", "StockTurnover": "DECIMAL(10,4)",
    "SalesToPurchaseRatio": "DECIMAL(12,4)",
}


def typed(df: DataFrame, types: dict = TYPED_SINK) -> DataFrame:
    """K4: cast to the typed schema.  Values are first rounded half-away at
    the target scale by double arithmetic, then cast; an overflowing value
    raises (ANSI cast), as an INSERT into a DECIMAL column would."""
    cols = []
    for c in df.columns:
        t = types.get(c)
        if t is None:
            cols.append(F.col(c))
        elif t.startswith("DECIMAL"):
            scale = int(t.split(",")[1].rstrip(")"))
            cols.append(round_ieee(c, scale).cast(t).alias(c))
        elif t.startswith("VARCHAR"):
            n = int(t[8:-1])
            length_ok = F.length(c) <= n
            cols.append(F.when(F.col(c).isNull() | length_ok, F.col(c))
                        .otherwise(F.raise_error(F.lit(f"value too long for {c} {t}")))
                        .cast("string").alias(c))
        else:
            cols.append(F.col(c).cast(t).alias(c))
    return df.select(*cols)
