"""Data-quality validator."""

import pytest

from supplylake.operators import quality as DQ


def checks(report):
    return {r["check"]: r for r in report["results"]}


def test_report_shape(sample_df):
    rep = DQ.DataQualityValidator().validate(sample_df)
    assert rep["total_checks"] == rep["passed"] + rep["failed"]
    assert rep["row_count"] == 3
    assert 0 <= rep["pass_rate"] <= 100
    c = checks(rep)
    assert c["schema_completeness"]["passed"]
    assert c["row_duplicates"]["passed"]
    assert c["dtype_numeric"]["passed"]


def test_bad_frame(bad_df):
    c = checks(DQ.DataQualityValidator().validate(bad_df))
    assert not c["non_nullable_VendorNumber"]["passed"]
    assert c["non_nullable_VendorNumber"]["details"]["null_count"] == 1
    assert c["range_PurchasePrice"]["details"]["violations"] == 2
    assert not c["range_PurchasePrice"]["passed"]
    assert not c["null_threshold"]["passed"]  # 20 % > 10 %


def test_missing_columns(spark):
    narrow = spark.createDataFrame([(1, 2)], "VendorNumber BIGINT, Brand BIGINT")
    c = checks(DQ.DataQualityValidator().validate(narrow))
    assert not c["schema_completeness"]["passed"]
    assert "VendorName" in c["schema_completeness"]["details"]["missing_columns"]


def test_duplicates(spark, sample_df):
    twins = sample_df.limit(1).unionByName(sample_df.limit(1))
    c = checks(DQ.DataQualityValidator().validate(twins))
    assert c["row_duplicates"]["details"]["duplicate_rows"] == 1
    assert not c["row_duplicates"]["passed"]


def test_unknown_profile(sample_df):
    with pytest.raises(ValueError, match="Unknown profile"):
        DQ.DataQualityValidator().validate(sample_df, profile="nope")


def test_custom_profile(spark):
    df = spark.createDataFrame([(1, 10), (2, 50), (3, 90)], "id BIGINT, value BIGINT")
    prof = {"custom": {"required_columns": ["id", "value"], "numeric_columns": ["value"],
                       "non_nullable": ["id"], "range_checks": {"value": {"min": 0, "max": 100}},
                       "null_threshold": 0.0}}
    rep = DQ.DataQualityValidator(prof).validate(df, profile="custom")
    assert rep["failed"] == 0


def test_frames_agree_with_report(sample_df):
    prof = DQ.VALIDATION_PROFILES["vendor_summary"]
    rng = {r["column"]: r for r in DQ.range_frame(sample_df, prof).collect()}
    assert rng["PurchasePrice"]["violations"] == 0
    nulls = {r["column"]: r["null_count"] for r in DQ.null_profile(sample_df).collect()}
    assert nulls["VendorName"] == 0
    dup = DQ.duplicate_frame(sample_df).first()
    assert dup["duplicate_rows"] == 0
