"""Continuous sync with Structured Streaming.

A source folder receives file drops; ``readStream`` picks up new files,
``foreachBatch`` applies a sync mode to each micro-batch, and the
checkpoint (under the shared checkpoint root) remembers which files were
processed, so a restart neither reprocesses nor skips a drop.

Sources that are looked at rather than listened to (whole snapshots, newest
matching file, database query) are polled: a stream of ticks, one a trigger, whose
checkpoint counts the polls; each poll reads the source anew and applies the same
sync modes under the poll's number.

Idempotence by ``batch_id``: appends put a ``batch_id=<n>`` folder in place by a
rename, so a replayed batch replaces its own output; upserts and full
replacements give the same result when replayed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sinks import folders, schemas
from . import snapshots
from .sync import add_batch, batches, high_water_mark, sync_upsert, write_mark

BATCH_ID = "batch_id"
MODES = ("append", "full", "incremental", "upsert", "watermark")
#: Applies a sync mode to the rows of a micro-batch or poll.
BatchFn = Callable[[DataFrame, int], None]


def read_target(spark: SparkSession, target: str, columns: Sequence[str]) -> DataFrame:
    return schemas.read(spark, target).select(*columns)


# ---------------------------------------------------------------- sync modes

def _append_batch(target: str, columns: Sequence[str] = ()) -> BatchFn:
    def fn(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch.select(*(columns or batch.columns)), target, batch_id, BATCH_ID)
    return fn


def _replace_batch(target: str) -> BatchFn:
    def fn(rows: DataFrame, batch_id: int) -> None:
        if not rows.isEmpty():  # as in a batch run, an empty extract replaces nothing
            folders.replace(rows, target)
    return fn


def _incremental_batch(target: str, columns: Sequence[str], ts_col: str) -> BatchFn:
    """Strict high-water-mark rule per micro-batch (late rows are dropped).

    The mark comes from the stored marks of earlier batches, one row each, so
    a replay of the same batch filters identically and the target is not read.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        hwm = high_water_mark(spark, target, BATCH_ID, before=batch_id)
        keep = F.lit(True) if hwm is None else F.coalesce(F.col(ts_col) > hwm, hwm.isNull())
        stage = scratch_path(spark, "stream_batch")
        batch.select(*(columns or batch.columns)).withColumn("_keep", keep).write.parquet(stage)  # decide once, then count and load
        staged = spark.read.parquet(stage)
        rows = staged.where("_keep").drop("_keep")
        late_log(spark, target, batch_id, staged)
        write_mark(rows, target, ts_col, batch_id, BATCH_ID)
        add_batch(rows, target, batch_id, BATCH_ID)
        folders.remove(spark, stage)
    return fn


def late_log(spark: SparkSession, target: str, batch_id: int, staged: DataFrame) -> None:
    """R4 accounting: per micro-batch rows in / loaded / dropped as late
    (overwritten per batch id, so replays do not double count)."""
    stats = staged.agg(F.count(F.lit(1)).alias("rows_in"),
                       F.count_if("_keep").alias("rows_loaded"),
                       F.count_if(~F.col("_keep")).alias("rows_late"))
    log = f"{target}__batches"
    (stats.withColumn("batch_id", F.lit(batch_id)).withColumn("logged_at", F.current_timestamp())
     .write.mode("overwrite").parquet(f"{log}/batch={batch_id}"))
    folders.merge_folders(spark, log, "batch", lambda paths: spark.read.parquet(*paths).coalesce(1))


def late_counts(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}__batches")


def _upsert_batch(target: str, key: Sequence[str], order: Sequence[str], buckets: int | None) -> BatchFn:
    def fn(batch: DataFrame, batch_id: int) -> None:
        sync_upsert(batch, target, key, order, buckets)
    return fn


def batch_function(mode: str, target: str, ts_col: str | None, key: Sequence[str], order: Sequence[str],
                   buckets: int | None) -> BatchFn:
    if mode == "upsert" and key and not order:
        raise ValueError("an upsert needs order columns that tell which row of a key is the last")
    if mode == "append":
        return _append_batch(target)
    if mode == "full":
        return _replace_batch(target)
    if mode == "incremental":
        return _incremental_batch(target, (), ts_col)
    if mode == "upsert":
        return _upsert_batch(target, key, order, buckets)
    raise ValueError(f"unknown sync mode {mode!r}")


# ---------------------------------------------------------------- running

def _started(stream: DataFrame, fn: BatchFn, checkpoint: str, once: bool, interval: str):
    """Start the query; with ``once`` drain what there is and raise what went wrong."""
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=interval)
    q = w.start()
    if once:
        q.awaitTermination()
        ex = q.exception()
        if ex is not None:
            raise RuntimeError(str(ex))
    return q


def _reader(reader, fmt: str):
    """Options of the file formats, of streams as of plain reads."""
    from ..sources.files import TS_MICROS, csv_reader
    if fmt == "csv":
        reader = csv_reader(reader)
    if fmt in ("json", "csv"):
        reader = reader.option("timestampNTZFormat", TS_MICROS)
    return reader.format(fmt)


def run_stream(spark: SparkSession, source_dir: str, schema: T.StructType, target: str,
               checkpoint: str, mode: str = "append", ts_col: str | None = None,
               key: Sequence[str] = (), order: Sequence[str] = (), fmt: str = "parquet",
               once: bool = True, interval: str = "300 seconds", max_files: int | None = None,
               buckets: int | None = None, delay: str = "10 minutes",
               change: Callable[[DataFrame], DataFrame] | None = None):
    """Start (and with ``once`` drain with ``availableNow``) one source stream.

    Mode ``full`` takes whole snapshots (``snapshots``) and is polled, whatever
    ``max_files`` says; mode ``watermark`` loads rows up to ``delay`` late once a key and
    sets the others aside (``set_aside``).  ``change`` turns each batch of source rows
    into rows of the target.
    """
    columns = [f.name for f in schema.fields]
    if mode == "full":
        def look(poll: int) -> tuple[DataFrame, int, str] | None:
            drop = snapshots.newest_drop(spark, source_dir, snapshots.taken(spark, target))
            if drop is None:
                return None
            rows = drop.load(_reader(spark.read, fmt).schema(schema)).select(*columns)
            return (change(rows) if change else rows), drop.time, drop.name
        return run_polls(spark, look, target, checkpoint, mode, once=once, interval=interval)
    reader = _reader(spark.readStream.schema(schema), fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(source_dir).select(*columns)
    if mode == "watermark":
        stream = change(stream) if change else stream
        return _started(flagged(stream, ts_col, delay, key), _watermark_batch(target, stream.columns, ts_col, key, delay),
                        checkpoint, once, interval)
    apply = batch_function(mode, target, ts_col, key, order, buckets)

    def fn(batch: DataFrame, batch_id: int) -> None:
        apply(change(batch) if change else batch, batch_id)
    return _started(stream, fn, checkpoint, once, interval)


def run_polls(spark: SparkSession, look: Callable[[int], tuple[DataFrame, int, str] | None], target: str,
              checkpoint: str, mode: str, ts_col: str | None = None, key: Sequence[str] = (),
              order: Sequence[str] = (), once: bool = True, interval: str = "300 seconds",
              buckets: int | None = None):
    """A polled source as a stream: at each trigger ``look(poll)`` gives the rows to sync
    with the time and name of what holds them, or None where nothing is new.  What was
    taken is noted beside the target after each poll; the checkpoint counts polls, and a
    poll that was cut off is done again under its number."""
    apply = batch_function(mode, target, ts_col, key, order, buckets)

    def fn(tick: DataFrame, poll: int) -> None:
        found = look(poll)
        if found is not None:
            rows, time, name = found
            apply(rows, poll)
            snapshots.take(spark, target, time, name)

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    return _started(ticks, fn, checkpoint, once, interval)


# ---------------------------------------------------------------- R4: late rows within a delay

FRESH = "_fresh"


def dedupe_within_watermark(stream: DataFrame, ts_col: str, delay: str,
                            keys: Sequence[str]) -> DataFrame:
    """R4 safe option: drop re-sent rows seen within the watermark delay."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))


def flagged(stream: DataFrame, ts_col: str, delay: str, key: Sequence[str]) -> DataFrame:
    """All rows of the stream, and once more, flagged, those that the watermark and its
    state store let through: not later than ``delay``, and the first of their key."""
    at = "_at"
    timed = stream.withColumn(at, F.col(ts_col).cast("timestamp"))
    first = dedupe_within_watermark(timed.where(F.col(at).isNotNull()), at, delay, key or stream.columns)
    return timed.withColumn(FRESH, F.lit(False)).unionByName(first.withColumn(FRESH, F.lit(True)))


def _watermark_batch(target: str, columns: Sequence[str], ts_col: str, key: Sequence[str], delay: str) -> BatchFn:
    """Load the flagged rows; every other row goes to ``<target>__aside`` with the reason:
    ``no time``, ``late`` (as the mark of the earlier batches tells) or ``sent before``."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stage = scratch_path(spark, "stream_batch")
        batch.write.parquet(stage)  # the state is asked once
        staged = spark.read.schema(batch.schema).parquet(stage)
        loaded = staged.where(FRESH).select(*columns)
        came = staged.where(~F.col(FRESH)).select(*columns)
        left = came.exceptAll(loaded)
        mark = high_water_mark(spark, target, BATCH_ID, before=batch_id)
        ts = F.col(ts_col).cast("timestamp_ntz")
        late = F.lit(False) if mark is None else F.coalesce(ts <= mark - F.expr(f"INTERVAL {delay}"), F.lit(False))
        reason = F.when(ts.isNull(), "no time").when(late, "late").otherwise("sent before")
        folders.add_folder(left.withColumn("reason", reason), f"{target}__aside", f"{BATCH_ID}={batch_id}")
        folders.merge_folders(spark, f"{target}__aside", BATCH_ID,
                              lambda paths: spark.read.option("mergeSchema", True).parquet(*paths))
        write_mark(came, target, ts_col, batch_id, BATCH_ID)
        add_batch(loaded, target, batch_id, BATCH_ID)
        folders.remove(spark, stage)
    return fn


def set_aside(spark: SparkSession, target: str) -> DataFrame:
    """The rows that a ``watermark`` stream did not load, with ``reason``."""
    batches(spark, f"{target}__aside", BATCH_ID)  # completes a merge that was cut off
    return spark.read.option("mergeSchema", True).parquet(f"{target}__aside")
