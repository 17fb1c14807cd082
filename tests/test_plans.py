"""Plan shape: no cartesian products, no nested-loop joins, no keyless
windows; scans pruned.  Plus results under a hot key (a third of all rows)."""

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

ANALYTIC = ["vendor_summary", "eda_summary", "brand_summary", "features_all", "dq_nulls",
            "dq_ranges", "dq_outliers", "eda_clean", "describe_numeric", "histogram", "box_stats",
            "margin_tiers", "sync_upsert"]


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="test data not present")
@pytest.mark.parametrize("name", ANALYTIC)
def test_plan_shape(spark, name):
    import __spark_entry__ as E
    text = plan_text(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    for m in re.finditer(r"Window \[.*?\], \[(.*?)\]", text):
        assert m.group(1).strip(), "window without partition keys"
    assert "ReadSchema" in text


def test_hot_key_results(spark):
    from supplylake.operators.summary import vendor_share
    from supplylake.streaming.sync import latest_per_key
    rows = [(1 if i % 5 < 2 else i % 17 + 2, i, float(i % 13)) for i in range(3000)]
    df = spark.createDataFrame(rows, "VendorNumber BIGINT, id BIGINT, v DOUBLE")
    got = {r["id"]: r["tot"] for r in vendor_share(df, "v", "tot").collect()}
    tot = {}
    for vnd, _, v in rows:
        tot[vnd] = tot.get(vnd, 0.0) + v
    assert all(got[i] == tot[vnd] for vnd, i, _ in rows)
    latest = {r["VendorNumber"]: r["id"] for r in latest_per_key(df, ["VendorNumber"], ["id"]).collect()}
    want = {}
    for vnd, i, _ in rows:
        want[vnd] = max(want.get(vnd, -1), i)
    assert latest == want
    plan = plan_text(latest_per_key(df, ["VendorNumber"], ["id"]))
    assert "partial_max_by" in plan  # reduced map-side before the shuffle


@pytest.mark.parametrize("name", ["eda_summary", "brand_summary"])
def test_purchases_are_scanned_once(spark, monkeypatch, name):
    """One scan of purchases: in the aggregate that is stored, none afterwards."""
    from supplylake.operators import summary as S
    from supplylake.plans.tables import stored_star
    star = stored_star(spark, SF_SMALL)
    plans = []
    plain = S.stored

    def watched(df, label):
        plans.append(plan_text(df))
        return plain(df, label)

    monkeypatch.setattr(S, "stored", watched)
    plans.append(plan_text(getattr(S, name)(star)))
    text = "".join(p.split("== Physical Plan ==")[1] for p in plans)
    assert len(re.findall(r"Location: \S+ \[[^\]]*star_purchases-", text)) == 1


def test_no_forced_broadcast_of_the_price_list(spark):
    from supplylake.operators import summary as S
    from supplylake.plans.tables import stored_star
    star = stored_star(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (S.purchase_summary(star), S.eda_purchase_summary(star), S.brand_purchases(star)):
            assert "Broadcast" not in plan_text(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanged(df):
    """The columns that each shuffle of a plan carries."""
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan_text(df))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_line_items_are_shuffled_without_texts(spark, no_broadcast):
    from supplylake.sources.star import purchases
    carried = exchanged(purchases(spark, SF_SMALL, 10))
    lines = [c for c in carried if "l_quantity" in c]
    assert len(lines) == 2 and not any(t in c for c in lines for t in ("p_name", "s_name"))


@pytest.mark.parametrize("name", ["purchase_summary", "eda_purchase_summary"])
def test_purchases_are_summed_before_they_meet_the_prices(spark, no_broadcast, name):
    from supplylake.operators import summary as S
    from supplylake.plans.tables import stored_star
    carried = exchanged(getattr(S, name)(stored_star(spark, SF_SMALL)))
    assert carried and not any(re.search(r"\bQuantity#", c) for c in carried)


def test_sums_of_a_brand_listed_twice(spark):
    """A brand's purchases count once for each of its prices, and equal prices add up."""
    from supplylake.operators import summary as S
    from supplylake.sources.star import Star
    bought = spark.createDataFrame(
        [(1, "V", 7, "d", "2.0", 3, "6.0"), (1, "V", 7, "d", "2.0", 4, "8.0"), (None, None, 7, None, "2.0", None, None),
         (2, "W", None, "e", "1.0", 1, "1.0"), (1, "V", 7, "d", "0.0", 9, "9.0")],
        "VendorNumber bigint, VendorName string, Brand bigint, Description string, PurchasePrice string, Quantity bigint, Dollars string")
    bought = bought.withColumns({c: bought[c].cast("decimal(14,4)") for c in ("PurchasePrice", "Dollars")})
    prices = spark.createDataFrame([(7, 1, 5.0, "750", 4.0), (7, 1, 5.0, "750", 4.0), (7, 1, 6.0, "x", 3.0)],
                                   "Brand bigint, VendorNumber bigint, Price double, Volume string, PurchasePrice double")
    star = Star(purchases=bought, sales=None, purchase_prices=prices, vendor_invoice=None)
    found = S.purchase_summary(star)
    assert dict(found.dtypes)["TotalPurchaseDollars"] == "decimal(24,4)"
    rows = [(r.VendorNumber, r.ActualPrice, r.TotalPurchaseQuantity, None if r.TotalPurchaseDollars is None else float(r.TotalPurchaseDollars))
            for r in found.collect()]
    assert sorted(rows, key=str) == sorted([(1, 5.0, 14, 28.0), (1, 6.0, 7, 14.0), (None, 5.0, None, None), (None, 6.0, None, None)], key=str)
    eda = [(r.VendorNumber, r.ReferencePurchasePrice, r.TotalPurchaseQuantity) for r in S.eda_purchase_summary(star).collect()]
    assert sorted(eda, key=str) == sorted([(1, 4.0, 14), (1, 3.0, 7), (None, None, None), (2, None, 1)], key=str)
