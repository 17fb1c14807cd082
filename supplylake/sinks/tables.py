"""Sinks (K1-K6, K13): replace / append / fail-if-exists writes, CSV export
with a timestamped name, and a table fingerprint.

Writes are distributed (one file per task); nothing passes through the
driver.  Registered queries write below the shared checkpoint root and read
the result back, so the round trip is part of what is checked.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def table_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"tables/{name}")


def write_table(df: DataFrame, path: str, if_exists: str = "replace",
                fmt: str = "parquet") -> str:
    """K1/K2/K3: ``if_exists`` = replace | append | fail."""
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}, got {if_exists!r}")
    df.write.mode(MODES[if_exists]).format(fmt).save(path)
    return path


def save_as_table(df: DataFrame, name: str, if_exists: str = "replace") -> None:
    """K1-K3 against the session catalog (warehouse on shared storage)."""
    df.write.mode(MODES[if_exists]).saveAsTable(name)


def write_replace(df: DataFrame, name: str) -> DataFrame:
    """Replace a path table and read it back."""
    spark = df.sparkSession
    path = table_path(spark, name)
    write_table(df, path, "replace")
    return spark.read.parquet(path)


def export_csv(df: DataFrame, output_dir: str, filename: str | None = None,
               prefix: str = "vendor_sales_summary") -> str:
    """K5: CSV with header under ``output_dir/<name>``; default name carries
    a yyyyMMdd_HHmmss stamp.  Written as a folder of part files; quotes inside
    text are doubled."""
    name = filename or f"{prefix}_{_dt.datetime.now().strftime('%Y%m%d_%H%M%S')}"
    path = f"{output_dir.rstrip('/')}/{name}"
    from ..sources.files import csv_writer
    csv_writer(df.write.mode("errorifexists")).csv(path)
    return path


def cells_text(columns: list[str]) -> F.Column:
    """The cells as one text that only equal cells give: each is led by its length, and
    NULL is a dash."""
    def cell(c: str) -> F.Column:
        text = F.col(f"`{c}`").cast("string")
        return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.concat(*[cell(c) for c in columns])


def row_hash(columns: list[str]) -> F.Column:
    """60 bits of the MD5 of a row's cells."""
    return F.conv(F.substring(F.md5(cells_text(columns)), 1, 15), 16, 10).cast(T.DecimalType(38, 0))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """total_rows, null_count (NULL cells), duplicate_count and an
    order-free data hash, in two aggregates.

    The hash sums ``row_hash`` as DECIMAL(38,0): duplicates add up instead of
    cancelling (as XOR would), and a BIGINT sum would overflow under ANSI.
    """
    nulls = sum((F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    base = df.agg(F.count(F.lit(1)).alias("total_rows"), F.sum(nulls).alias("null_count"),
                  F.sum(row_hash(df.columns)).cast("string").alias("data_hash"))
    from ..operators.quality import duplicate_frame
    dups = duplicate_frame(df).select("duplicate_rows").scalar()
    return base.select("total_rows", F.coalesce("null_count", F.lit(0)).alias("null_count"),
                       dups.alias("duplicate_count"), "data_hash")


def with_surrogate_id(df: DataFrame, name: str = "id") -> DataFrame:
    """T4: a unique (not dense) row id, computed per partition, no shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_audit_timestamp(df: DataFrame, name: str = "_pipeline_updated_at") -> DataFrame:
    """T5: load time stamp, one value per query."""
    return df.withColumn(name, F.current_timestamp())


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column before a write."""
    cols = {f.name: F.when(F.isnan(F.col(f"`{f.name}`")), F.lit(None)).otherwise(F.col(f"`{f.name}`"))
            for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(cols) if cols else df
