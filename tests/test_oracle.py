"""Registered queries vs. their DuckDB oracle on the smallest test scale."""

import os

import pytest

from tests.conftest import SF_SMALL

FAST = ["vendor_summary", "eda_summary", "brand_summary", "features_all", "dq_report",
        "iqr_filter", "corr_pairs", "impute_price", "load_csv", "sync_upsert", "stream_append",
        "stream_snapshots", "stream_watermark", "dq_cross_table", "changed_rows", "upsert_new_columns"]


def _names() -> list[str]:
    """A fast choice, or with ORACLE_ALL every query that has a statement."""
    if not os.environ.get("ORACLE_ALL"):
        return FAST
    import __spark_entry__ as E
    return sorted(E.oracle_sql())


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="test data not present")
@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    import duckdb

    import __spark_entry__ as E
    from tools.check_oracle import TABLES, compare

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL)
    assert res.get("exact"), res


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "ProfitMargin" in df.columns
