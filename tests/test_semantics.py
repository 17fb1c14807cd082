"""Edge matrix for the null / NaN / text rules."""

import math

from supplylake.functions import semantics as SM


def test_to_number(spark):
    vals = [" 12 ", "1e3", "abc", "", "inf", "1,000", "1d", "nan", None, "-inf", "2F"]
    df = spark.createDataFrame([(v,) for v in vals], "v STRING")
    got = [r[0] for r in df.select(SM.to_number("v")).collect()]
    assert got[0] == 12.0 and got[1] == 1000.0
    assert got[2] is None and got[3] is None and got[5] is None
    assert math.isinf(got[4]) and got[4] > 0 and math.isinf(got[9]) and got[9] < 0
    assert got[6] is None and got[7] is None and got[8] is None and got[10] is None


def test_safe_ratio_and_clip(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (3.0, 2.0)], "a DOUBLE, b DOUBLE")
    got = [r[0] for r in df.select(SM.safe_ratio("a", "b")).collect()]
    assert got == [0.0, 0.0, None, 1.5]
    got = [r[0] for r in df.select(SM.clip_keep_null("a", 0, 2)).collect()]
    assert got == [1.0, 1.0, None, 2.0]


def test_strip_and_round(spark):
    df = spark.createDataFrame([("\t x \n",), (None,)], "s STRING")
    assert [r[0] for r in df.select(SM.strip_ws("s")).collect()] == ["x", None]
    df = spark.createDataFrame([(2.675,), (-1.005,), (0.125,)], "x DOUBLE")
    got = [r[0] for r in df.select(SM.round_ieee("x", 2)).collect()]
    # half away from zero on the scaled double: 2.675 * 100 is exactly 267.5
    # in IEEE arithmetic (Python's round() says 2.67 from the binary value)
    assert got == [2.68, -1.0, 0.13]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x DOUBLE")
    assert [r[0] for r in df.select(SM.nan_to_null("x")).collect()] == [None, 1.0]


def test_clean_summary_edge_matrix(spark):
    """NULL / NaN / +-inf / -0.0 measures and dirty Volume text."""
    from supplylake.operators.summary import add_summary_metrics, clean_summary
    nan, inf = float("nan"), float("inf")
    vols = [" 12 ", "1d", "abc", "nan", "1,000", None, "750"]
    sales = [None, nan, inf, -0.0, 10.0, 5.0, 0.0]
    rows = [(1, " \tV ", 7, "d  ", 1.0, 2.0, v, 1.0, 4.0, 2.0, sd, 1.0, 0.0, None)
            for v, sd in zip(vols, sales)]
    schema = ("VendorNumber BIGINT, VendorName STRING, Brand BIGINT, Description STRING, "
              "PurchasePrice DOUBLE, ActualPrice DOUBLE, Volume STRING, TotalPurchaseQuantity DOUBLE, "
              "TotalPurchaseDollars DOUBLE, TotalSalesQuantity DOUBLE, TotalSalesDollars DOUBLE, "
              "TotalSalesPrice DOUBLE, TotalExciseTax DOUBLE, FreightCost DOUBLE")
    out = add_summary_metrics(clean_summary(spark.createDataFrame(rows, schema))).collect()
    assert [r["Volume"] for r in out] == [12.0, 0.0, 0.0, 0.0, 0.0, 0.0, 750.0]
    assert [r["TotalSalesDollars"] for r in out][:2] == [0.0, 0.0]  # NULL and NaN -> 0
    assert out[2]["TotalSalesDollars"] == inf  # pandas fillna keeps inf
    assert all(r["FreightCost"] == 0.0 for r in out)
    assert all(r["VendorName"] == "V" and r["Description"] == "d" for r in out)
    assert out[0]["ProfitMargin"] == 0.0 and out[4]["ProfitMargin"] == (10.0 - 4.0) / 10.0 * 100


def test_exact_sum_non_finite(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1, 0.1), (1, 0.2), (2, inf), (2, 1.0), (3, inf), (3, -inf),
                                (4, nan), (4, 2.5), (5, None)], "g INT, x DOUBLE")
    got = {r["g"]: r["s"] for r in df.groupBy("g").agg(SM.exact_sum("x").alias("s")).collect()}
    assert got[1] == 0.3 and got[2] == inf and math.isnan(got[3]) and got[4] == 2.5 and got[5] is None
