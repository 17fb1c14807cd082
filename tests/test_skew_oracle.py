"""Summary and features with one vendor holding a third of all rows,
compared with the DuckDB oracle over the same skewed tables."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="test data not present")
def test_hot_vendor_summary_and_features_match_oracle(spark):
    import duckdb

    from supplylake.operators import features as FE
    from supplylake.operators import summary as S
    from supplylake.plans import oracle as O
    from supplylake.plans.tables import stored_star
    from supplylake.session import scratch_path
    from supplylake.sources.star import Star, vendor_invoice
    from tools.check_oracle import rows_of

    base = stored_star(spark, SF_SMALL)
    hot = (F.col("Brand") % 3) == 0
    p = base.purchases.withColumn("VendorNumber", F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("VendorNumber")))
    s = base.sales.withColumn("VendorNo", F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("VendorNo")))
    d = scratch_path(spark, "skewed_star")
    tables = {"purchases": p, "sales": s, "purchase_prices": base.purchase_prices}
    for name, df in tables.items():
        df.write.parquet(f"{d}/{name}")
    read = {n: spark.read.parquet(f"{d}/{n}") for n in tables}
    vendor_invoice(read["purchases"]).write.parquet(f"{d}/vendor_invoice")
    read["vendor_invoice"] = spark.read.parquet(f"{d}/vendor_invoice")
    share = read["purchases"].agg(F.avg((F.col("VendorNumber") == 0).cast("double"))).first()[0]
    assert share > 0.3  # the hot vendor really holds about a third of the rows

    star = Star(**read)
    summary = S.vendor_summary(star, ordered=False)
    feats = FE.build_features(summary)

    con = duckdb.connect()
    for n in read:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{d}/{n}/*.parquet')")
    after_star = len(O.STAR)
    want_summary = con.sql(O.q(O.SUMMARY_CLEAN[after_star:], "SELECT * FROM vendor_summary"))
    cols = sorted(summary.columns)
    assert rows_of([r.asDict() for r in summary.collect()], cols) == \
        rows_of([dict(zip(want_summary.columns, r)) for r in want_summary.fetchall()], cols)

    exact = [c for c in FE.feature_columns(feats) if c not in
             ("feat_vendor_avg_margin", "feat_log_sales", "feat_log_purchases", "feat_log_profit",
              "feat_zscore_profit_margin")]
    layers = ",".join(O.FEAT_PROFIT.split(",") + [O.FEAT_VOLUME, O.FEAT_PRICE, O.FEAT_INVENTORY,
                                                  O.FEAT_VENDOR, O.FEAT_FREQ])
    sql = O.q(O.FEATURES[after_star:], f"SELECT s.VendorNumber, s.Brand, s.Description, s.PurchasePrice,{layers}"
              + O.FEATURE_FROM)
    got = feats.select("VendorNumber", "Brand", "Description", "PurchasePrice", *exact)
    want = con.sql(sql)
    keep = ["VendorNumber", "Brand", "Description", "PurchasePrice", *exact]
    assert rows_of([r.asDict() for r in got.collect()], sorted(keep)) == \
        rows_of([dict(zip(want.columns, r)) for r in want.fetchall()], sorted(keep))
