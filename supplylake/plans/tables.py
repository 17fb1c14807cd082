"""Stage tables, written once per session and read back by later stages.

The reference keeps its inputs and its summary as stored tables: the
summary job writes ``vendor_sales_summary`` and the quality, feature and
analysis jobs read it back.  Here each stage output is a parquet table below
the shared checkpoint root, keyed by (application, input folder, stage), so
a later query reads the stored table instead of re-deriving it, and a
lost executor cannot lose it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from ..sinks import folders
from ..sources.star import (
    Star, purchase_prices, purchases, sales, supplier_count, vendor_invoice,
)

_PATHS: dict[tuple[str, str, str], str] = {}


def stage_table(spark: SparkSession, sf_dir: str, stage: str,
                build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), stage)
    path = _PATHS.get(key)
    if path is None or not folders.exists(spark, path):
        path = scratch_path(spark, f"stage/{stage}")
        build().write.mode("overwrite").parquet(path)
        _PATHS[key] = path
    return spark.read.parquet(path)


def landed(spark: SparkSession, sf_dir: str, name: str,
           write: Callable[[str], None]) -> str:
    """A landing folder (e.g. CSV files derived from the given tables) made
    once per application and input folder; returns its path."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), f"landing:{name}")
    path = _PATHS.get(key)
    if path is None:
        path = scratch_path(spark, f"landing/{name}")
        write(path)
        _PATHS[key] = path
    return path


def stored_star(spark: SparkSession, sf_dir: str) -> Star:
    """The four star tables, derived once from the given tables and stored.
    ``vendor_invoice`` is grouped from the stored purchases table, so the
    lineitem joins run once."""
    ns = {}

    def count():
        if "n" not in ns:
            ns["n"] = supplier_count(spark, sf_dir)
        return ns["n"]

    # Sorted within each task by date: parquet row-group min/max statistics
    # then let the pushed-down ``since`` filters skip row groups.
    p = stage_table(spark, sf_dir, "star_purchases",
                    lambda: purchases(spark, sf_dir, count()).sortWithinPartitions("ReceivingDate"))
    s = stage_table(spark, sf_dir, "star_sales",
                    lambda: sales(spark, sf_dir, count()).sortWithinPartitions("SalesDate"))
    pp = stage_table(spark, sf_dir, "star_purchase_prices",
                     lambda: purchase_prices(spark, sf_dir, count()))
    vi = stage_table(spark, sf_dir, "star_vendor_invoice", lambda: vendor_invoice(p))
    return Star(purchases=p, sales=s, purchase_prices=pp, vendor_invoice=vi)
