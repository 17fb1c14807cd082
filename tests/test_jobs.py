"""Job switches, reports, name helpers and watermark dedupe."""

import json

import pytest
from pyspark.sql import functions as F

from supplylake.operators import quality as DQ
from supplylake.session import scratch_path
from supplylake.sources import files as FS
from tests.conftest import SF_SMALL


def test_summary_job_switch(spark):
    from supplylake.plans.jobs import vendor_summary_job
    dry = vendor_summary_job(spark, SF_SMALL, dry_run=True)
    assert dry.count() > 0
    path = scratch_path(spark, "job_tbl")
    out_dir = scratch_path(spark, "job_csv")
    vendor_summary_job(spark, SF_SMALL, output="both", table_path=path, csv_dir=out_dir)
    assert spark.read.parquet(path).count() == dry.count()
    with pytest.raises(ValueError):
        vendor_summary_job(spark, SF_SMALL, output="paper")


def test_report_save_and_text(spark, sample_df, tmp_path):
    rep = DQ.DataQualityValidator().validate(sample_df)
    p = DQ.save_report(spark, rep, str(tmp_path / "r.json"))
    assert json.load(open(p))["total_checks"] == rep["total_checks"]
    assert "PASS" in DQ.summary_text(rep)


def test_name_helpers(spark):
    assert FS.sanitize_name("/x/2024 Sales-Q1.csv") == "_024_sales_q1"
    df = spark.createDataFrame([(1, 2)], "`a b` INT, `c-d` INT")
    assert FS.sanitize_columns(df).columns == ["a_b", "c_d"]
    with pytest.raises(ValueError):
        FS.sanitize_columns(spark.createDataFrame([(1, 2)], "`a b` INT, `a-b` INT"))


def test_envelope_forms(spark):
    p = scratch_path(spark, "env")
    docs = ['{"data": [{"id": 1}, {"id": 2}]}', '{"results": [{"id": 3}]}',
            '[{"id": 4}, {"id": 5}]', '{"id": 6}']
    spark.createDataFrame([(d,) for d in docs], "value STRING").coalesce(1).write.text(p)
    got = sorted(r["id"] for r in FS.unwrap_envelope(FS.scan_json(spark, p)).collect())
    assert got == [1, 2, 3, 4, 5, 6]


def test_watermark_dedupe(spark):
    from supplylake.streaming.streams import dedupe_within_watermark
    src = scratch_path(spark, "wm_src")
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:05"), (2, "2024-01-01 00:01:00")]
    df = spark.createDataFrame(rows, "event_id BIGINT, ts STRING").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    out = dedupe_within_watermark(stream, "ts", "10 minutes", ["event_id"])
    name = "wm_" + scratch_path(spark, "q").rsplit("-", 1)[-1][:8]
    q = (out.writeStream.format("memory").queryName(name).option("checkpointLocation", scratch_path(spark, "wm_ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r["event_id"] for r in spark.table(name).collect()) == [1, 2]


def test_csv_numeric_text_and_tokens(spark):
    p = scratch_path(spark, "csv_tokens")
    rows = [("1", "2.5", " x "), ("NA", "3", "y"), ("3", "n/a", "")]
    spark.createDataFrame(rows, "a STRING, b STRING, c STRING").coalesce(1).write.option("header", True).csv(p)
    df = FS.load_csv(spark, p)
    types = dict(df.dtypes)
    assert types["a"] == "double" and types["b"] == "double" and types["c"] == "string"
    got = sorted((r["a"] is None, r["b"]) for r in df.collect() if r["b"] is not None)
    assert got == [(False, 2.5), (True, 3.0)]


def test_retry_and_report(spark):
    from supplylake.plans.jobs import retry
    from supplylake.sinks import loading as LD
    calls = []

    @retry(max_attempts=3, delay=0.01)
    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise IOError("transient")
        return "ok"
    assert flaky() == "ok" and len(calls) == 3
    res = spark.createDataFrame([("a.csv", "a", 3, 3, "success"), ("b.csv", "b", 0, 0, "failed")],
                                "file STRING, table STRING, total_rows LONG, inserted_rows LONG, status STRING")
    rep = LD.load_report(res).first()
    assert (rep["total_files"], rep["successful"], rep["failed"], rep["total_rows_inserted"]) == (2, 1, 1, 3)
    out = LD.write_report(LD.load_report(res), res, scratch_path(spark, "reports"))
    assert spark.read.json(out + "/details").count() == 2


def test_run_batch(spark):
    from supplylake.plans.jobs import run_batch
    paths = run_batch(spark, SF_SMALL, scratch_path(spark, "batch"))
    assert spark.read.parquet(paths["ml_feature_store"]).count() == \
        spark.read.parquet(paths["vendor_sales_summary"]).count()
    assert spark.read.parquet(paths["analysis_margin_tiers"]).count() == 3
    assert spark.read.parquet(paths["data_quality_report"]).count() > 10


def test_case_insensitive_grouping_option(spark):
    from decimal import Decimal

    from supplylake.operators.summary import purchase_summary
    from supplylake.sources.star import Star
    p = spark.createDataFrame(
        [(1, "Acme", 5, "Gin", Decimal("2.0000"), 3, Decimal("6.0000")),
         (1, "ACME", 5, "gin", Decimal("2.0000"), 1, Decimal("2.0000"))],
        "VendorNumber BIGINT, VendorName STRING, Brand BIGINT, Description STRING, "
        "PurchasePrice DECIMAL(14,4), Quantity BIGINT, Dollars DECIMAL(14,4)")
    pp = spark.createDataFrame([(5, Decimal("3.0000"), "750")], "Brand BIGINT, Price DECIMAL(14,4), Volume STRING")
    star = Star(purchases=p, sales=None, purchase_prices=pp, vendor_invoice=None)
    assert purchase_summary(star).count() == 2
    rows = purchase_summary(star, "UTF8_LCASE").collect()
    assert len(rows) == 1 and rows[0]["TotalPurchaseQuantity"] == 4


def test_table_samples(spark):
    from supplylake.plans.tables import stored_star
    s = stored_star(spark, SF_SMALL)
    samples = FS.table_samples({"purchases": s.purchases, "sales": s.sales})
    assert {k: v.count() for k, v in samples.items()} == {"purchases": 5, "sales": 5}
