"""Features vs. a brute-force pandas/numpy computation on random frames
with NULLs, zeros and negatives (pandas NaN == Spark NULL on input)."""

import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from supplylake.operators import features as FE
from tests.conftest import SUMMARY_SCHEMA

NUM = st.sampled_from([None, 0.0, -5.0, 1.5, 100.0, 750.0, 2000.0])
ROW = st.fixed_dictionaries({
    "VendorNumber": st.sampled_from([1, 2, 3, None]),
    "Brand": st.integers(1, 5),
    "PurchasePrice": NUM, "ActualPrice": NUM,
    "Volume": st.sampled_from([None, 150.0, 375.0, 750.0, 1000.0, 1750.0]),
    "TotalPurchaseQuantity": NUM, "TotalPurchaseDollars": NUM, "TotalSalesQuantity": NUM,
    "TotalSalesDollars": NUM, "TotalExciseTax": NUM, "FreightCost": NUM,
    "GrossProfit": NUM, "ProfitMargin": NUM,
})
COLS = [c.split()[0] for c in SUMMARY_SCHEMA.split(", ")]


def ratio(num, den, k=1.0):
    with np.errstate(all="ignore"):
        return np.where(den > 0, num / den * k, 0.0)


def brute(pdf: pd.DataFrame) -> pd.DataFrame:
    d = pdf.astype({c: float for c in pdf.columns if c not in ("VendorName", "Description")})
    o = pd.DataFrame(index=d.index)
    o["feat_profit_per_unit"] = ratio(d.GrossProfit, d.TotalSalesQuantity)
    o["feat_profit_tier"] = pd.cut(d.ProfitMargin, [-np.inf, 0, 15, 35, np.inf],
                                   labels=["loss", "low", "medium", "high"]).astype(object)
    o["feat_net_profit_after_freight"] = d.GrossProfit - d.FreightCost
    o["feat_is_profitable"] = (d.GrossProfit > 0).astype(int)

    def cat(v):
        for edge, lab in zip([200, 500, 750, 1500], ["mini", "half", "standard", "large"]):
            if v <= edge:
                return lab
        return "magnum"
    o["feat_volume_category"] = d.Volume.apply(cat)
    o["feat_quantity_ratio"] = ratio(d.TotalSalesQuantity, d.TotalPurchaseQuantity)
    o["feat_demand_velocity"] = ratio(d.TotalSalesDollars, d.Volume)
    gap = d.ActualPrice - d.PurchasePrice
    o["feat_price_gap"] = gap
    o["feat_price_gap_pct"] = ratio(gap, d.PurchasePrice, 100)
    o["feat_price_competitiveness"] = ratio(d.PurchasePrice, d.ActualPrice)
    o["feat_excise_burden"] = ratio(d.TotalExciseTax, d.TotalSalesDollars, 100)
    rate = ratio(d.TotalSalesQuantity, d.TotalPurchaseQuantity, 100)
    o["feat_sell_through_rate"] = rate
    o["feat_overstock_flag"] = (rate < 50).astype(int)
    o["feat_revenue_per_purchase_dollar"] = ratio(d.TotalSalesDollars, d.TotalPurchaseDollars)
    vs = d.groupby("VendorNumber").agg(bc=("Brand", "nunique"), tr=("TotalSalesDollars", "sum"),
                                       am=("ProfitMargin", "mean")).reset_index()
    m = d[["VendorNumber"]].merge(vs, on="VendorNumber", how="left")
    o["feat_vendor_brand_count"] = m.bc.values
    o["feat_vendor_total_revenue"] = m.tr.values
    o["feat_vendor_avg_margin"] = m.am.values
    o["feat_vendor_revenue_share"] = ratio(d.TotalSalesDollars.values, m.tr.values, 100)
    with np.errstate(all="ignore"):
        o["feat_log_sales"] = np.log1p(d.TotalSalesDollars.clip(lower=0))
        o["feat_log_purchases"] = np.log1p(d.TotalPurchaseDollars.clip(lower=0))
        o["feat_log_profit"] = np.log1p(d.GrossProfit.abs()) * np.sign(d.GrossProfit)
    mean, std = d.ProfitMargin.mean(), d.ProfitMargin.std()
    o["feat_zscore_profit_margin"] = np.where(std > 0, (d.ProfitMargin - mean) / std, 0.0)
    o["feat_vendor_frequency"] = d.VendorNumber.map(d.VendorNumber.value_counts(normalize=True))
    return o


def same(a, b) -> bool:
    na = a is None or (isinstance(a, float) and math.isnan(a))
    nb = b is None or (isinstance(b, float) and math.isnan(b))
    if na or nb:
        return na and nb
    if isinstance(a, str) or isinstance(b, str):
        return a == b
    return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=12))
def test_features_match_brute_force(spark, rows):
    full = []
    for i, r in enumerate(rows):
        full.append(tuple({**r, "VendorName": f"v{r['VendorNumber']}", "Description": f"d{i}",
                           "TotalSalesPrice": 1.0, "StockTurnover": 1.0,
                           "SalesToPurchaseRatio": 1.0}[c] for c in COLS))
    sdf = spark.createDataFrame(full, SUMMARY_SCHEMA)
    out = FE.build_features(sdf).orderBy("Description").toPandas()
    pdf = pd.DataFrame(full, columns=COLS).sort_values("Description").reset_index(drop=True)
    want = brute(pdf)
    for c in want.columns:
        for i in range(len(pdf)):
            a, b = out[c].iloc[i], want[c].iloc[i]
            a = None if a is pd.NA else a
            assert same(a, b), (c, i, a, b, pdf.iloc[i].to_dict())
