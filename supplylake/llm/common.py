"""Shared helpers: stored intermediate tables, ordered shards, Arrow text access."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sinks import folders

#: Whitespace of the word rule ``[^\x20\x09-\x0D]+``.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Stands in for a null document id where ids are ordered: nulls come first.
NULL_ID = -(2 ** 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark removes a finished write's shuffle files at once while this is set.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark sends rows to a Python worker in batches of about so many bytes.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings are these inside, and as they were afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def saved(df: DataFrame, name: str, batch: str | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    lineage, and a lost executor cannot lose it.  The shuffle files of the write
    are not needed any more and go with it.  ``batch`` bounds the bytes of rows that a
    Python worker gets at a time."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}")
    with settings(spark, {TIDY: "true"} | ({ARROW_BYTES: batch} if batch else {})):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the files of a ``saved`` table that nothing will read any more."""
    files = df.inputFiles()
    if files:
        folders.remove(df.sparkSession, files[0].rsplit("/", 1)[0])


def scan_tasks(df: DataFrame) -> int:
    """Tasks that Spark plans for reading ``df``: grows with the input's bytes."""
    return max(1, df.rdd.getNumPartitions())


def split_points(df: DataFrame, key: str, shards: int) -> np.ndarray:
    """At most ``shards - 1`` ascending values of the integer column ``key`` that
    cut its rows into about equal ranges; a range starts at its split point."""
    if shards < 2:
        return np.empty(0, np.int64)
    at = [i / shards for i in range(1, shards)]
    got = df.select(F.percentile_approx(key, F.lit(at).cast("array<double>"),
                                        F.lit(20 * shards)).alias("p")).first().p
    return np.unique(np.array(got or [], np.int64))


def shard_column(points: np.ndarray, key: str):
    """The shard of ``key`` among the ranges that start at ``points``."""
    @F.pandas_udf(T.IntegerType())
    def shard(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, ids.to_numpy(), side="right").astype(np.int32))
    return shard(F.col(key))


def dealt_evenly(df: DataFrame, column: str, n: int) -> DataFrame:
    """``df`` with each value 0 to ``n - 1`` of ``column`` in a task of its own."""
    keys = even_keys(df.sparkSession, n)

    @F.pandas_udf(T.IntegerType())
    def deal(values: pd.Series) -> pd.Series:
        return pd.Series(keys[values.to_numpy()])
    return df.withColumn("_deal", deal(column)).repartition(n, "_deal").drop("_deal")


def even_keys(spark: SparkSession, n: int) -> np.ndarray:
    """``n`` integers that hash partitioning into ``n`` parts deals to a part each."""
    part = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n))
    rows = spark.range(32 * n).groupBy(part.alias("part")).agg(F.min("id").alias("id")).collect()
    keys = {r.part: r.id for r in rows}
    return np.array([keys.get(k, 32 * n + k) for k in range(n)], np.int32)


def filled_text(column: pa.Array) -> pa.Array:
    """A string column with nulls as empty texts, offsets starting at zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        return pc.fill_null(column, "")
    return pc.fill_null(column.cast(pa.string()), "")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the offsets that cut them."""
    column = filled_text(column)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    cut = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or cut[-1] == cut[0]:
        return np.empty(0, np.uint8), cut - cut[0]
    return np.frombuffer(data, np.uint8)[cut[0]:cut[-1]], cut - cut[0]


def text_slices(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of their ``text`` column
    (a longer single text is a piece of its own), which bounds a task's memory."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0)
                         .to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def list_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(values))


def file_system(path: str):
    """The Arrow file system of a Hadoop-style path, and the path within it."""
    from pyarrow import fs
    if "://" not in path:
        path = path.removeprefix("file:")
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def write_file(path: str, data: bytes) -> None:
    """Write whole and then rename, so that a repeated or interrupted task
    leaves either the full file or none; every attempt writes equal bytes."""
    store, name = file_system(path)
    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    part = f"{name}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, name)


def ordered_shards(df: DataFrame, points: np.ndarray, columns: list[str], order: list,
                   look_ahead: bool = False) -> DataFrame:
    """``columns`` (``doc_id`` first) of ``df`` dealt by ranges of ``doc_id``, with
    ``shard`` and ``ahead``, each shard whole in one task and in ascending
    ``doc_id, order``.  A null id counts as the lowest.  With ``look_ahead`` the
    documents that start a shard also end the one before it, marked ``ahead``."""
    rows = df.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), *columns[1:])
    rows = rows.withColumn("shard", shard_column(points, "doc_id")).withColumn("ahead", F.lit(False))
    if look_ahead and len(points):
        starts = rows.sparkSession.createDataFrame([(int(x),) for x in points], "doc_id long")
        extra = (rows.join(F.broadcast(starts), "doc_id", "left_semi")
                 .withColumn("shard", F.col("shard") - 1).withColumn("ahead", F.lit(True)))
        rows = rows.unionByName(extra)
    return dealt_evenly(rows, "shard", len(points) + 1).sortWithinPartitions("shard", "doc_id", *order)
