"""Sync modes and bookkeeping.

Targets are path tables (parquet) below shared storage; each belongs to one mode.

* full: replace the target by the extract.
* incremental: keep rows with ts strictly newer than the high-water mark.  Each
  load adds one folder ``_batch=<n>`` by a rename; its mark (``max(ts)`` of rows
  actually loaded) is written just before and counts only once the folder is
  there, so a crash at any step neither loads rows twice nor loses them.
* upsert: the last row per key wins (order columns decide), then
  ``target anti-join source  UNION  source`` replaces the target, or the touched
  buckets of it.  Keys are compared null-safely.  Dedupe is ``max_by`` per key --
  a partial aggregate, so a key holding a third of all rows is reduced map-side.

New columns and wider types of an extract become the target's (``sinks/schemas.py``);
incompatible ones are refused.
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sinks import folders, schemas

log = logging.getLogger(__name__)

HISTORY_SCHEMA = T.StructType([
    T.StructField("source_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("sync_start", T.TimestampType()),
    T.StructField("sync_end", T.TimestampType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])


# --------------------------------------------------------------- K7

def sync_full(df: DataFrame, target: str) -> DataFrame:
    """K7: replace the target with ``df`` (which may read the target)."""
    return folders.replace(df, target)


# --------------------------------------------------------------- K8 / R3

BATCH = "_batch"


def _state_path(target: str) -> str:
    return target.rstrip("/") + "__sync_state"


def batches(spark: SparkSession, target: str, column: str = BATCH) -> list[int]:
    """Numbers of the batch folders that are in place."""
    return folders.numbers(spark, target, column)


def write_mark(rows: DataFrame, target: str, ts_col: str, batch: int, column: str = BATCH) -> None:
    """The mark of a batch and all before it, written before its folder is put in place;
    marks that neither this batch nor a replay of it needs are removed."""
    spark = rows.sparkSession
    earlier = high_water_mark(spark, target, column, before=batch)
    own = F.max(F.col(ts_col).cast("timestamp_ntz"))
    mark = rows.agg((own if earlier is None else F.greatest(own, earlier)).alias("hwm"))
    (mark.withColumn("updated_at", F.current_timestamp())
     .write.mode("overwrite").parquet(f"{_state_path(target)}/batch={batch}"))
    done = [n for n in batches(spark, target, column) if n < batch]
    marks = sorted(int(n.split("=")[1]) for n in folders.names(spark, _state_path(target)) if n.startswith("batch="))
    needed = max((m for m in marks if done and m <= done[-1]), default=None)
    for m in marks:
        if needed is not None and m < needed:
            folders.remove(spark, f"{_state_path(target)}/batch={m}")


def high_water_mark(spark: SparkSession, target: str, column: str = BATCH, before: int | None = None):
    """The greatest mark of the batches in place (but for numbers from ``before`` on)
    as a scalar-subquery Column, or None without any.  Reads the few marks kept."""
    done = [n for n in batches(spark, target, column) if before is None or n < before]
    if not done or not folders.exists(spark, _state_path(target)):
        return None
    marks = spark.read.parquet(_state_path(target)).where(F.col("batch") <= done[-1])
    return marks.select(F.max("hwm")).scalar()


def add_batch(df: DataFrame, target: str, batch: int, column: str = BATCH) -> None:
    """Add ``df`` as the folder of a batch, in the target's columns, and merge folders
    that have become many."""
    spark = df.sparkSession
    schema = schemas.evolve(spark, target, df.schema)
    folders.add_folder(schemas.conform(df, schema), target, f"{column}={batch}")
    folders.merge_folders(spark, target, column, lambda paths: schemas.read(spark, target, paths))


def incremental_rows(df: DataFrame, ts_col: str | None, hwm) -> DataFrame:
    """R4 rule: strictly newer than the mark; first run or no ts column -> all.
    Rows with a NULL ts are loaded only while there is no mark."""
    if ts_col is None or ts_col not in df.columns or hwm is None:
        return df
    newer = F.col(ts_col).cast("timestamp_ntz") > hwm
    return df.where(F.coalesce(newer, hwm.isNull()))


def sync_incremental(df: DataFrame, target: str, ts_col: str | None) -> DataFrame:
    """K8: append rows newer than the mark; advance the mark to max(ts) loaded."""
    spark = df.sparkSession
    batch = max(batches(spark, target), default=-1) + 1
    stage = scratch_path(spark, "incr")
    incremental_rows(df, ts_col, high_water_mark(spark, target)).write.parquet(stage)
    rows = spark.read.parquet(stage)  # decided once: mark and load see the same rows
    if ts_col is not None and ts_col in df.columns:
        write_mark(rows, target, ts_col, batch)
    add_batch(rows, target, batch)
    folders.remove(spark, stage)
    return schemas.read(spark, target)


# --------------------------------------------------------------- K9 / J7

def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order`` (ties: a stable winner from the full row)."""
    if not order:
        raise ValueError("an upsert needs order columns that tell which row of a key is the last")
    cols = df.columns
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in cols if c not in order])
    return (df.groupBy(*key).agg(F.max_by(F.struct(*cols), rank).alias("_r"))
            .select("_r.*"))


def _without_keys(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key, NULLs included, is not among ``source``'s."""
    keys = source.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)])
    same = [target[k].eqNullSafe(keys[f"_key_{i}"]) for i, k in enumerate(key)]
    return target.join(keys, same, "left_anti")


def upsert_frame(target: DataFrame | None, source: DataFrame, key: Sequence[str],
                 order: Sequence[str]) -> DataFrame:
    src = latest_per_key(source, key, order)
    if target is None:
        return src
    return _without_keys(target, src, key).unionByName(src.select(*target.columns))


BUCKET = "_bucket"


def bucket_of(key: Sequence[str], buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)).cast("int")


def sync_upsert(df: DataFrame, target: str, key: Sequence[str] | None,
                order: Sequence[str], buckets: int | None = None) -> DataFrame:
    """K9: upsert on ``key``; without a key, plain append (with a warning).

    With ``buckets`` the target is partitioned by ``pmod(xxhash64(key), B)``:
    an upsert reads only the buckets its keys fall in (static partition
    pruning on at most B bucket numbers) and replaces just those, so the cost
    follows the size of the change, not of the target.  Rows are dealt to
    tasks by bucket before the write, and a large bucket is split.  Choose B so
    that a bucket is about one task's work; it stays the table's.
    """
    spark = df.sparkSession
    if not key:
        log.warning("upsert without a primary key: appending")
        add_batch(df, target, max(batches(spark, target), default=-1) + 1)
        return schemas.read(spark, target)
    parts = None if buckets is None else f"{BUCKET}="
    there = folders.table_exists(spark, target, parts)
    held = schemas.stored(spark, target) if there and buckets else None
    if held and any(schemas.merged(held, df.schema)[k].dataType != held[k].dataType for k in key):
        raise ValueError("a key of another type would fall in other buckets; rewrite the table first")
    schema = schemas.evolve(spark, target, df.schema)
    df = schemas.conform(df, schema)
    if buckets is None:
        tgt = schemas.conform(schemas.read(spark, target), schema) if there else None
        folders.replace(upsert_frame(tgt, df, key, order), target)
        return schemas.read(spark, target)

    src = latest_per_key(df, key, order).withColumn(BUCKET, bucket_of(key, buckets))
    if not there:
        folders.replace(src.hint("rebalance", BUCKET), target, BUCKET)
        return schemas.read(spark, target)
    stage = scratch_path(spark, "upsert_src")
    src.write.parquet(stage)  # the change set, deduped, read twice below
    src = spark.read.parquet(stage)
    touched = sorted(r[0] for r in src.select(BUCKET).distinct().collect())  # <= B ints
    tgt = schemas.read(spark, target).where(F.col(BUCKET).isin(touched))
    merged = _without_keys(tgt, src, key).unionByName(src.select(*tgt.columns))
    folders.replace(merged.hint("rebalance", BUCKET), target, BUCKET, parts)
    folders.remove(spark, stage)
    return schemas.read(spark, target)


# --------------------------------------------------------------- dispatch / K12 / K14

SYNC_MODES = ("full", "incremental", "upsert")


def run_sync(spark: SparkSession, source_name: str, df: DataFrame, target: str, mode: str,
             history: str | None = None, ts_col: str | None = None,
             key: Sequence[str] | None = None, order: Sequence[str] = (),
             buckets: int | None = None) -> dict:
    """R2 + R5: one sync with status; failures are recorded, not raised.  The
    extract is read once, into the shared folder."""
    if mode not in SYNC_MODES:
        raise ValueError(f"unknown sync mode {mode!r}; expected one of {SYNC_MODES}")
    if mode == "upsert" and key and not order:
        raise ValueError("an upsert needs order columns that tell which row of a key is the last")
    start = _dt.datetime.now()
    rec = {"source_name": source_name, "table_name": target.rsplit("/", 1)[-1],
           "sync_start": start, "rows_processed": 0, "rows_loaded": 0,
           "status": "success", "error_message": None}
    stage = scratch_path(spark, "extract")
    try:
        df.write.parquet(stage)
        rows = spark.read.parquet(stage)
        n = rec["rows_processed"] = rows.count()
        if n == 0:
            rec["status"] = "empty"
        elif mode == "full":
            sync_full(rows, target)
            rec["rows_loaded"] = n
        elif mode == "incremental":
            out = sync_incremental(rows, target, ts_col)
            rec["rows_loaded"] = out.where(F.col(BATCH) == batches(spark, target)[-1]).count()
        else:
            sync_upsert(rows, target, key, order, buckets)
            rec["rows_loaded"] = n
        folders.remove(spark, stage)
    except Exception as exc:
        rec["status"] = "failed"
        rec["error_message"] = str(exc)
    rec["sync_end"] = _dt.datetime.now()
    if history:
        append_history(spark, history, [rec])
    return rec


#: Files of a history that become one.
HISTORY_FILES = 100


def append_history(spark: SparkSession, history: str, records: list[dict]) -> None:
    """One row per sync run; a history has one writer at a time."""
    rows = [tuple(r.get(f.name) for f in HISTORY_SCHEMA.fields) for r in records]
    folders.recover(spark, history)
    spark.createDataFrame(rows, HISTORY_SCHEMA).write.mode("append").parquet(history)
    if sum(n.endswith(".parquet") for n in folders.names(spark, history)) > HISTORY_FILES:
        folders.replace(spark.read.schema(HISTORY_SCHEMA).parquet(history).coalesce(1), history)


def sync_status(history: DataFrame) -> DataFrame:
    """Per source: runs, successes, failures, rows, last sync."""
    return history.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("total_syncs"),
        F.count_if(F.col("status") == "success").alias("successful_syncs"),
        F.count_if(F.col("status") == "failed").alias("failed_syncs"),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("total_rows_processed"),
        F.max("sync_end").alias("last_sync"))
