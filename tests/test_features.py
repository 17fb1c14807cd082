"""Feature engineering: golden values, guards and invariants."""

import math

import pytest
from pyspark.sql import functions as F

from supplylake.operators import features as FE


def by_brand(df):
    return {r["Brand"]: r for r in df.collect()}


def test_pipeline_keeps_rows_and_columns(sample_df):
    out = FE.build_features(sample_df)
    assert out.count() == 3
    assert set(sample_df.columns) <= set(out.columns)
    assert len(FE.feature_columns(out)) >= 15


def test_profit_per_unit_and_ratios(sample_df):
    r = by_brand(FE.build_features(sample_df))
    assert r[1]["feat_profit_per_unit"] == pytest.approx(350 / 90, abs=0.01)
    assert r[1]["feat_quantity_ratio"] == pytest.approx(0.9, abs=0.01)
    assert r[1]["feat_price_gap"] == pytest.approx(5.0, abs=0.01)
    assert r[1]["feat_price_gap_pct"] == pytest.approx(50.0, abs=0.01)
    assert r[1]["feat_sell_through_rate"] == pytest.approx(90.0, abs=0.01)


def test_overstock_and_categories(sample_df):
    out = FE.build_features(sample_df)
    assert out.agg(F.sum("feat_overstock_flag")).first()[0] == 0
    r = by_brand(out)
    assert r[1]["feat_volume_category"] == "standard"
    assert r[2]["feat_volume_category"] == "half"
    assert r[3]["feat_volume_category"] == "magnum"


def test_vendor_aggregates(sample_df):
    out = FE.build_features(sample_df)
    r = by_brand(out)
    assert r[1]["feat_vendor_brand_count"] == 2
    shares = out.groupBy("VendorNumber").agg(F.sum("feat_vendor_revenue_share").alias("s")).collect()
    for row in shares:
        assert row["s"] == pytest.approx(100.0, abs=0.1)
    assert r[3]["feat_vendor_frequency"] == pytest.approx(1 / 3)


def test_zero_rows_have_no_nan_or_inf(zero_df):
    out = FE.build_features(zero_df)
    row = out.first().asDict()
    for k, v in row.items():
        if isinstance(v, float):
            assert not math.isnan(v) and not math.isinf(v), k
    assert row["feat_zscore_profit_margin"] == 0.0


def test_profit_tiers_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (15.0,), (35.0,), (35.01,), (None,), (float("-inf"),), (float("inf"),)],
                               "ProfitMargin DOUBLE")
    got = [r[0] for r in df.select(FE.cut_right("ProfitMargin", FE.PROFIT_TIER_EDGES,
                                                FE.PROFIT_TIER_LABELS)).collect()]
    assert got == ["loss", "low", "medium", "high", None, None, "high"]


def test_guards(spark, sample_df):
    with pytest.raises(FE.FeatureInputError, match="missing columns"):
        FE.build_features(sample_df.drop("GrossProfit"))
    with pytest.raises(FE.FeatureInputError, match="0 rows"):
        FE.build_features(sample_df.limit(0))


def test_idempotent_on_own_output(sample_df):
    once = FE.build_features(sample_df)
    twice = FE.build_features(once)
    assert sorted(once.columns) == sorted(twice.columns)


def test_numeric_features(sample_df):
    num = FE.numeric_features(FE.build_features(sample_df))
    assert "feat_profit_tier" not in num.columns and "feat_log_sales" in num.columns
