"""Folders of the shared store, through Spark's own Hadoop file system.

A table is replaced in two steps that a crash cannot tear: the new one is
written whole to ``<target>__new`` (Spark marks it with ``_SUCCESS``), and then
takes the target's place by renames.  ``recover`` completes renames that were
begun, whenever the table is looked at again.  Errors of the store are raised,
never taken for "no table".
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

NEW, OLD, MERGED = "__new", "__old", "__merged"
#: The columns that tables of numbered folders are partitioned by.
PARTITIONS = ("_batch", "batch_id", "_bucket")


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none where it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def modified(spark: SparkSession, path: str) -> int | None:
    """When ``path`` was written, in milliseconds; None where it does not exist."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else None


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise IOError(f"cannot remove {path}")


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, a = _fs(spark, src)
    _, b = _fs(spark, dst)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise IOError(f"cannot rename {src} to {dst}")


def take_place(spark: SparkSession, new: str, target: str) -> None:
    """Put the folder ``new`` in the place of ``target``."""
    if exists(spark, target):
        parent, name = target.rsplit("/", 1)
        old = f"{parent}/.{name}{OLD}-{uuid.uuid4().hex}"  # hidden from readers of the parent
        rename(spark, target, old)
        rename(spark, new, target)
        remove(spark, old)
    else:
        rename(spark, new, target)


def recover(spark: SparkSession, target: str, parts: str | None = None) -> None:
    """Complete a replacement that was written whole but not yet in place; one that
    was not written whole is left for the next write to overwrite.  With ``parts``
    only folders of that prefix (``_bucket=``) are replaced, each by a rename."""
    target = target.rstrip("/")
    new = target + NEW
    if not exists(spark, f"{new}/_SUCCESS"):
        return
    if parts is None:
        take_place(spark, new, target)
        return
    for name in names(spark, new):
        if name.startswith(parts):
            take_place(spark, f"{new}/{name}", f"{target}/{name}")
    remove(spark, new)


def table_exists(spark: SparkSession, target: str, parts: str | None = None) -> bool:
    recover(spark, target, parts)
    return exists(spark, target)


def replace(df: DataFrame, target: str, partition_by: str | None = None,
            parts: str | None = None) -> DataFrame:
    """Replace the table (or with ``parts`` the folders that ``df`` holds) by ``df``,
    which may itself read the table."""
    spark, target = df.sparkSession, target.rstrip("/")
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(target + NEW)
    recover(spark, target, parts)
    return spark.read.parquet(target)


def add_folder(df: DataFrame, target: str, name: str) -> None:
    """Write ``df`` as ``target/name``, whole or not at all; an earlier folder of that
    name (of a replayed batch) is replaced."""
    spark = df.sparkSession
    stage = f"{target.rstrip('/')}{NEW}-{name.replace('=', '-')}"
    df.write.mode("overwrite").parquet(stage)
    take_place(spark, stage, f"{target.rstrip('/')}/{name}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, replacing one of that name."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """A new small text file that is there in full or not at all."""
    parent, name = path.rsplit("/", 1)
    part = f"{parent}/.{name}-{uuid.uuid4().hex}"
    write_text(spark, part, text)
    rename(spark, part, path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    data = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    finally:
        data.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, or of the first file in a folder that holds any."""
    fs, p = _fs(spark, path)
    if fs.getFileStatus(p).isDirectory():
        visible = [n for n in names(spark, path) if n[0] not in "._"]
        return next((line for line in (first_line(spark, f"{path}/{n}") for n in visible) if line is not None), None)
    jvm = spark._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def uri(spark: SparkSession, path: str) -> str:
    """``path`` as Spark's file metadata spells it, with special characters encoded."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toUri().toString()


# ---------------------------------------------------------------- numbered folders

#: So many folders of one size become one; a table of n loads keeps about FAN * log(n) folders.
FAN = 32


def numbers(spark: SparkSession, target: str, column: str) -> list[int]:
    """Numbers of the folders ``column=<n>`` that are in place, ascending."""
    finish_merges(spark, target, column)
    return sorted(int(n.split("=", 1)[1]) for n in names(spark, target) if re.fullmatch(rf"{column}=\d+", n))


def finish_merges(spark: SparkSession, target: str, column: str) -> None:
    """Put merged folders that were written whole in the place of those they hold."""
    parent, name = target.rstrip("/").rsplit("/", 1)
    for found in names(spark, parent):
        made = re.fullmatch(rf"{re.escape(name)}{MERGED}-{column}-(\d+)-(\d+)", found)
        if not made or not exists(spark, f"{parent}/{found}/_SUCCESS"):
            continue
        low, high = int(made[1]), int(made[2])
        for old in names(spark, target):
            if re.fullmatch(rf"{column}=\d+", old) and low <= int(old.split("=")[1]) <= high:
                hidden = f"{target}/.{old}{OLD}-{uuid.uuid4().hex}"
                rename(spark, f"{target}/{old}", hidden)
                remove(spark, hidden)
        rename(spark, f"{parent}/{found}", f"{target}/{column}={high}")


def merge_folders(spark: SparkSession, target: str, column: str, read: Callable[[list[str]], DataFrame],
                  fan: int | None = None) -> None:
    """Merge runs of ``fan`` folders of about equal numbers of loads into one, named by
    its last; the newest folder, which a replay may replace, is left alone.  A load is
    rewritten a logarithmic number of times.  A crash leaves the folders as they were
    or a whole merged one that the next look at the table puts in place."""
    fan = fan or FAN
    target = target.rstrip("/")
    while True:
        older = numbers(spark, target, column)[:-1]
        sizes = [int(math.log(n - before, fan) + 1e-9) for before, n in zip([-1, *older], older)]
        run = older[-fan:]
        if len(run) < fan or len(set(sizes[-fan:])) > 1:
            return
        stage = f"{target}{MERGED}-{column}-{run[0]}-{run[-1]}"
        read([f"{target}/{column}={n}" for n in run]).drop(column).write.mode("overwrite").parquet(stage)
        finish_merges(spark, target, column)
