"""Checks between tables, fences, infinite values, fingerprints and digest trees."""

import json
import math

import pytest
from pyspark.sql import functions as F

from supplylake.operators import features as FE
from supplylake.operators import quality as DQ
from supplylake.operators.consistency import Balance, Reference, cross_checks
from supplylake.sinks import digests as DG
from supplylake.sinks.tables import table_fingerprint


def test_references_and_balances(spark):
    child = spark.createDataFrame([(1, "a")] * 3 + [(9, "z")] * 5 + [(8, "y"), (None, "a"), (2, None)], "k int, s string")
    parent = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, s string")
    left = spark.createDataFrame([(1, 5), (1, 5), (2, 1), (3, 4), (4, None)], "k int, v int")
    right = spark.createDataFrame([(1, 10), (2, 2), (4, None), (5, 0), (None, 7)], "k int, v int")
    tables = {"child": child, "parent": parent, "left": left, "right": right, "none": child.limit(0)}
    rows = {r.check: r for r in cross_checks(tables, [
        Reference("child", ("k",), "parent", ("k",)), Reference("child", ("k", "s"), "parent", ("k", "s")),
        Reference("none", ("k",), "parent", ("k",)), Reference("parent", ("k",), "none", ("k",)),
        Balance("left", "right", ("k",), ("v",))]).collect()}
    r = rows["child_k_in_parent"]
    assert (r.passed, r.checked, r.without_key, r.failed, r.failed_keys, r.examples) == (False, 11, 1, 6, 2, "9, 8")
    assert (rows["child_k_s_in_parent"].without_key, rows["child_k_s_in_parent"].failed) == (2, 6)
    assert rows["none_k_in_parent"].passed and rows["none_k_in_parent"].failed_pct == 0.0
    assert (rows["parent_k_in_none"].failed, rows["parent_k_in_none"].without_key) == (3, 1)
    b = rows["left_v_as_in_right"]
    assert (b.checked, b.failed, b.examples, b.without_key) == (5, 3, "2, 3, 5", 1)


def test_fences_of_a_profile(spark):
    df = spark.createDataFrame([(float(i), i) for i in range(20)] + [(1000.0, 5), (None, 6), (math.nan, 7)], "x double, y int")
    v = DQ.DataQualityValidator({"p": {"iqr_columns": ["x", "y", "absent"]}})
    found = {r["check"]: r for r in v.run_checks(df, "p")}
    x = found["iqr_x"]["details"]
    assert (x["outlier_count"], x["q1"], x["q3"], x["lower"], x["upper"]) == (1, 5.0, 15.0, -10.0, 30.0)
    assert found["iqr_x"]["passed"] and found["iqr_y"]["details"]["outlier_count"] == 0 and "iqr_absent" not in found
    assert "iqr_x" not in {r["check"] for r in v.run_checks(df.limit(2), "p")}


def test_infinite_values_are_no_outliers(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (math.inf,), (2.0,), (3.0,)], "x double")
    v = DQ.DataQualityValidator({"p": {"numeric_columns": ["x"]}})
    check = next(r for r in v.run_checks(df, "p") if r["check"] == "outlier_x")
    assert check["passed"] and check["details"]["outlier_count"] == 0
    row = DQ.outlier_frame(df, {"numeric_columns": ["x"]}).first()
    assert (row.outlier_count, row.passed) == (0, True)
    text = v.check_frame(df, "p").where("check = 'outlier_x'").first().details
    assert json.loads(text, parse_constant=pytest.fail)["mean"] == "Infinity"
    report = v.validate(df, "p")
    path = DQ.save_report(spark, report, f"{tmp_path}/report.json")
    with open(path) as f:
        json.load(f, parse_constant=pytest.fail)


def test_infinite_margin_gives_zero_scores(spark, sample_df):
    df = sample_df.withColumn("ProfitMargin", F.when(F.col("Brand") == 1, math.inf).otherwise(F.col("ProfitMargin")))
    assert {r[0] for r in FE.statistical(df).select("feat_zscore_profit_margin").collect()} == {0.0}


def test_fingerprint_tells_cells_apart(spark):
    a = spark.createDataFrame([("p", "q\x1f=r")], "x string, y string")
    b = spark.createDataFrame([("p\x1f=q", "r")], "x string, y string")
    c = spark.createDataFrame([("1:p", None)], "x string, y string")
    d = spark.createDataFrame([(None, "1:p")], "x string, y string")
    hashes = {table_fingerprint(t).first().data_hash for t in (a, b, c, d)}
    assert len(hashes) == 4


def test_digest_tree_names_what_changed(spark):
    old = spark.range(2000).select("id", (F.col("id") * 3).alias("v")).withColumn("key", F.when(F.col("id") < 1990, F.col("id")))
    new = old.where("id <> 5 and id <> 17").withColumn("v", F.when(F.col("id") == 400, -1).otherwise(F.col("v")))
    new = new.unionByName(spark.createDataFrame([(9000, 1, 9000), (3, 9, 3)], "id long, v long, key long"))
    key = ["key"]
    changed = DG.changed_buckets(DG.digest_leaves(old, key), DG.digest_leaves(new, key))
    rows = changed.collect()
    assert [r for r in rows if r.level == 0] and len([r for r in rows if r.level == DG.DEPTH]) == 5
    got = sorted((r.change, r.key, r.old_rows, r.new_rows) for r in DG.changed_rows(old, new, key, changed).collect())
    assert got == [("added", 9000, 0, 1), ("changed", 3, 1, 2), ("changed", 400, 1, 1), ("removed", 5, 1, 0), ("removed", 17, 1, 0)]
    same = DG.digest_leaves(old, key)
    assert DG.changed_buckets(same, DG.digest_leaves(old.repartition(3), key)).count() == 0


def test_equal_table_names_are_refused(spark, tmp_path):
    from supplylake.sources.files import load_directory, write_csv
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    write_csv(df, f"{tmp_path}/in/a-b.csv")
    write_csv(df, f"{tmp_path}/in/a_b.csv")
    with pytest.raises(ValueError, match="a-b.csv"):
        load_directory(spark, f"{tmp_path}/in", "*.csv", f"{tmp_path}/out")
    assert not (tmp_path / "out").exists()
