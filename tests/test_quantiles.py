"""Distributed exact quantiles equal Spark's percentile, also with a hot group."""

import random

from pyspark.sql import functions as F

from supplylake.operators.quantiles import median_scalar, quantiles


import pytest


@pytest.fixture
def conf(spark):
    """Sets options for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("reuse", ["true", "false"])
def test_grouped_and_global_match_percentile(spark, conf, adaptive, reuse):
    conf("spark.sql.adaptive.enabled", adaptive)
    conf("spark.sql.exchange.reuse", reuse)
    random.seed(7)
    rows = []
    for _ in range(6000):
        g = "hot" if random.random() < 0.4 else f"g{random.randint(0, 20)}"
        v = random.choice([random.random() * 100, float(random.randint(0, 4)), None])
        rows.append((g, v))
    rows.append((None, 1.0))
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE").repartition(12)
    ps = [0.1, 0.25, 0.5, 0.75, 0.99]
    names = [f"q{i}" for i in range(len(ps))]
    got = {r["g"]: [r[n] for n in names] for r in quantiles(df, "v", ps, ["g"], names).collect()}
    want = {r["g"]: list(r["q"]) for r in df.where("g IS NOT NULL AND v IS NOT NULL")
            .groupBy("g").agg(F.percentile("v", ps).alias("q")).collect()}
    assert got == want
    glob = quantiles(df, "v", ps, names=names).first()
    assert [glob[n] for n in names] == list(df.agg(F.percentile("v", ps)).first()[0])
    m = spark.range(1).select(median_scalar(df, "v").alias("m")).first()["m"]
    assert m == df.agg(F.median("v")).first()[0]


def test_distributed_path_on_test_tables(spark):
    from tests.conftest import SF_SMALL
    from supplylake.plans.tables import stored_star
    sales = stored_star(spark, SF_SMALL).sales
    ps = [0.25, 0.5, 0.9]
    names = ["a", "b", "c"]
    got = {r["VendorNo"]: [r[n] for n in names]
           for r in quantiles(sales, "SalesPrice", ps, ["VendorNo"], names).collect()}
    want = {r["VendorNo"]: list(r["q"]) for r in sales.groupBy("VendorNo")
            .agg(F.percentile(F.col("SalesPrice").cast("double"), ps).alias("q")).collect()}
    assert got == want


def test_approx_paths_close_to_exact(spark):
    from supplylake.operators import explore as EX
    df = spark.range(0, 20000).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 97 AS DOUBLE) AS y")
    exact = {r["column"]: r for r in EX.describe(df).collect()}
    approx = {r["column"]: r for r in EX.describe(df, approx=True).collect()}
    for c in ("x", "y"):
        for q in ("q25", "q50", "q75"):
            assert abs(exact[c][q] - approx[c][q]) <= 0.01 * (exact[c]["max"] - exact[c]["min"])
    b = {r["column"]: r for r in EX.iqr_bounds(df, ["x"], approx=True).collect()}
    assert b["x"]["q1"] < b["x"]["q3"]
    assert EX.box_stats(df, ["x", "y"], approx=True).count() == 2


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1999, 2001, 9000])
def test_columns_by_brackets_equal_percentile(spark, n):
    from supplylake.operators.quantiles import column_quantiles
    random.seed(n)
    rows = [(random.gauss(0, 1), float(random.choice([1, 1, 1, 2, 5])), None if i % 3 else random.random(), float("nan") if i % 2 else 1.5, None)
            for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(5)
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    cols = ["a", "b", "c", "d", "e"]
    clean = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in cols])
    want = clean.agg(*[a for c in cols for a in (F.percentile(c, ps).alias(c), F.count(c).alias(f"n_{c}"))]).first()
    got = column_quantiles(df, cols, ps)
    assert got == {c: (want[f"n_{c}"], list(want[c])) for c in cols if want[f"n_{c}"]}


def test_brackets_sort_a_small_share_of_the_rows(spark, monkeypatch):
    from supplylake.operators import quantiles as Q
    sorted_rows = []
    plain = Q.sorted_blocks
    monkeypatch.setattr(Q, "sorted_blocks", lambda base, *a, **k: (sorted_rows.append(base.count()), plain(base, *a, **k))[1])
    df = spark.range(100_000).select(F.hash("id").cast("double").alias("x"))
    assert Q.column_quantiles(df, ["x"], [0.5])["x"][1] == [df.agg(F.median("x")).first()[0]]
    assert len(sorted_rows) == 1 and sorted_rows[0] < 2500


def test_correlation_over_complete_pairs_without_python(spark):
    import numpy as np
    import pandas as pd

    from supplylake.operators.explore import corr_matrix
    rng = np.random.default_rng(4)
    x = rng.standard_normal((500, 5)) + 1e6
    x[:, 1] += x[:, 0] * 3
    x[rng.random((500, 5)) < 0.2] = np.nan
    x[:, 3] = 7.0
    x[:, 0] = np.arange(500)
    pdf = pd.DataFrame(x, columns=list("abcde"))
    pdf["f"] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.to_numpy()],
                               "a double, b double, c double, d double, e double, f double")
    out = corr_matrix(df, list("abcdef"))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan
    want = pdf.corr()
    got = {(r.col_a, r.col_b): r["corr"] for r in out.collect()}
    assert len(got) == 36
    for (a, b), r in got.items():
        w = want.loc[a, b]
        assert (r is None) == bool(np.isnan(w)) and (r is None or abs(r - w) < 1e-9), (a, b, r, w)


def test_brackets_of_many_columns_are_one_expression(spark, monkeypatch):
    from supplylake.operators import quantiles as Q
    plans, plain = [], Q.stored

    def watched(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, label)

    monkeypatch.setattr(Q, "stored", watched)
    df = spark.range(101).selectExpr(*[f"IF(id % {i + 2} = 0, NULL, CAST(id * {i + 1} AS DOUBLE)) AS v{i}" for i in range(12)], "CAST(NULL AS DOUBLE) AS none")
    got = Q.column_quantiles(df, df.columns, [0.25, 0.5, 0.75])
    row = df.selectExpr(*[f"percentile(v{i}, array(0.25, 0.5, 0.75)) AS v{i}" for i in range(12)]).first()
    assert {c: q for c, (_, q) in got.items()} == {c: row[c] for c in row.asDict()}
    assert plans[0].count("CASE WHEN") + plans[0].count("if (") < 30
