import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"

SUMMARY_SCHEMA = (
    "VendorNumber BIGINT, VendorName STRING, Brand BIGINT, Description STRING, "
    "PurchasePrice DOUBLE, ActualPrice DOUBLE, Volume DOUBLE, TotalPurchaseQuantity DOUBLE, "
    "TotalPurchaseDollars DOUBLE, TotalSalesQuantity DOUBLE, TotalSalesDollars DOUBLE, "
    "TotalSalesPrice DOUBLE, TotalExciseTax DOUBLE, FreightCost DOUBLE, GrossProfit DOUBLE, "
    "ProfitMargin DOUBLE, StockTurnover DOUBLE, SalesToPurchaseRatio DOUBLE")


@pytest.fixture(scope="session")
def spark():
    from supplylake.session import get_session
    s = get_session(master="local[2]", shuffle_partitions=8)
    yield s


@pytest.fixture
def sample_df(spark):
    rows = [
        (100, "Vendor_A", 1, "Prod_1", 10.0, 15.0, 750.0, 100.0, 1000.0, 90.0, 1350.0, 15.0, 10.0, 5.0, 350.0, 25.93, 0.9, 1.35),
        (100, "Vendor_A", 2, "Prod_2", 20.0, 35.0, 375.0, 200.0, 4000.0, 250.0, 8750.0, 35.0, 50.0, 20.0, 4750.0, 54.29, 1.25, 2.19),
        (200, "Vendor_B", 3, "Prod_3", 30.0, 40.0, 1750.0, 300.0, 9000.0, 280.0, 11200.0, 40.0, 100.0, 50.0, 2200.0, 19.64, 0.93, 1.24),
    ]
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)


@pytest.fixture
def zero_df(spark):
    rows = [(1, "Zero_Vendor", 999, "Zero_Product") + (0.0,) * 14]
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)


@pytest.fixture
def bad_df(spark):
    rows = []
    names = ["A", None, "C", "D", "E"]
    vendors = [1, 2, None, 4, 5]
    pp = [10.0, -5.0, 100.0, 99999.0, 20.0]
    ap = [15.0, 8.0, 150.0, 120.0, 30.0]
    sq = [90.0, 180.0, 290.0, 380.0, 480.0]
    st = [0.9, 0.9, 0.97, 0.95, 0.96]
    for i in range(5):
        rows.append((vendors[i], names[i], (i + 1) * 10, f"p{i + 1}", pp[i], ap[i], 750.0,
                     100.0 * (i + 1), 1000.0 * (i + 1), sq[i], 1500.0 * (i + 1), 15.0,
                     10.0 * (i + 1), 5.0 * (i + 1), 500.0 * (i + 1), 33.3, st[i], 1.5))
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)
