"""Whole snapshots in a landing folder (R2, K7).

A drop is what one write put there: the part files of one Spark write (told by the
write's id in their names), a folder of files, a single file, or the files that a
manifest ``_manifest-<name>.json`` lists.  It counts once it is whole:

* with a manifest (written last, by ``write_manifest`` or by the sender) when every file
  it lists is there; where a landing folder holds manifests, only they make drops;
* as a Spark write or a folder when its ``_SUCCESS`` marker is at least as new as its
  newest file and no write is under way beside it;
* a single file as it is: like every file source, it must be put in place by a rename.

How the files arrive over polls or micro-batches therefore does not matter, and a drop
that is not whole is looked at again at the next poll.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import folders
from ..sources.files import list_files

MANIFEST = "_manifest-"


@dataclass(frozen=True)
class Drop:
    """``paths`` (and a glob for names below them) are what to read; ``time`` (in
    microseconds) and ``name`` order drops; ``marked`` is the folder whose marker tells
    that the drop is whole."""
    time: int
    name: str
    paths: tuple[str, ...]
    glob: str | None = None
    marked: str | None = None

    def load(self, reader) -> DataFrame:
        reader = reader.option("recursiveFileLookup", True)
        if self.glob:
            reader = reader.option("pathGlobFilter", self.glob)
        return reader.load(list(self.paths))


def write_manifest(spark: SparkSession, source: str, name: str, files: list[str]) -> None:
    """Declare that ``files`` (names below ``source``) are the whole snapshot ``name``."""
    folders.write_whole(spark, f"{source.rstrip('/')}/{MANIFEST}{name}.json", json.dumps({"files": files}))


def _micros(spark: SparkSession, path: str) -> int | None:
    at = folders.modified(spark, path)
    return None if at is None else at * 1000


def listed_drops(spark: SparkSession, source: str, after: tuple[int, str]) -> list[Drop]:
    """The drops of the manifests in ``source`` that are newer than ``after`` and whole."""
    drops = []
    for n in folders.names(spark, source):
        if not n.startswith(MANIFEST):
            continue
        at = _micros(spark, f"{source}/{n}")
        name = n[len(MANIFEST):].rsplit(".", 1)[0]
        if (at, name) <= after:
            continue
        files = json.loads(folders.read_text(spark, f"{source}/{n}"))["files"]
        paths = tuple(f"{source}/{f}" for f in files)
        if paths and all(folders.exists(spark, p) for p in paths):
            drops.append(Drop(at, name, paths))
    return drops


def found_drops(spark: SparkSession, source: str, after: tuple[int, str]) -> list[Drop]:
    """The drops among the files below ``source`` that are newer than ``after``, told by
    one aggregate over the listing; whether one is whole is not asked here."""
    base = source.split("://")[-1].removeprefix("file:")
    below = F.regexp_replace("path", r"^.*?\Q" + base + r"/\E", "")
    write = F.regexp_extract("_below", r"^part-\d+-([0-9a-f-]{36})", 1)
    kind = (F.when(F.contains("_below", F.lit("/")), F.concat(F.lit("folder:"), F.substring_index("_below", "/", 1)))
            .when(write != "", F.concat(F.lit("write:"), write)).otherwise(F.concat(F.lit("file:"), F.col("_below"))))
    rows = (list_files(spark, source).withColumn("_below", below).groupBy(kind.alias("name"))
            .agg(F.max(F.unix_micros("modificationTime")).alias("time")).where(F.col("time") >= after[0]).collect())
    drops = []
    for r in rows:
        kind, name = r.name.split(":", 1)
        if (r.time, r.name) <= after:
            continue
        if kind == "write":
            drops.append(Drop(r.time, r.name, (source,), f"part-*-{name}*", source))
        else:
            path = f"{source}/{name}"
            drops.append(Drop(r.time, r.name, (path,), None, path if kind == "folder" else None))
    return drops


def is_whole(spark: SparkSession, drop: Drop) -> bool:
    if drop.marked is None:
        return True
    done = _micros(spark, f"{drop.marked}/_SUCCESS")
    return done is not None and done >= drop.time and not folders.exists(spark, f"{drop.marked}/_temporary")


def newest_drop(spark: SparkSession, source: str, after: tuple[int, str] = (0, "")) -> Drop | None:
    """The newest whole drop in ``source`` that is newer than ``after``."""
    source = source.rstrip("/")
    if not folders.exists(spark, source):
        return None
    if any(n.startswith(MANIFEST) for n in folders.names(spark, source)):
        drops = listed_drops(spark, source, after)
    else:
        drops = found_drops(spark, source, after)
    for drop in sorted(drops, key=lambda d: (d.time, d.name), reverse=True):
        if is_whole(spark, drop):
            return drop
    return None


# ---------------------------------------------------------------- what a target holds

def _taken_path(target: str) -> str:
    return target.rstrip("/") + "__taken"


def taken(spark: SparkSession, target: str) -> tuple[int, str]:
    """Time and name of the drop that ``target`` holds."""
    path = _taken_path(target)
    if not folders.table_exists(spark, path):
        return 0, ""
    return tuple(spark.read.parquet(path).first())


def take(spark: SparkSession, target: str, time: int, name: str) -> None:
    """Note, after the target was written, which drop it holds; a crash before this
    loads the same drop, or a newer one, again."""
    folders.replace(spark.createDataFrame([(time, name)], "time long, name string").coalesce(1), _taken_path(target))
