"""The columns of a growing table (K8, K9, T3): stored beside it, widened by its loads.

``<target>__schema`` holds one small file for each change, the last of which counts; it
is written before the first file that needs it, so readers never meet a column they do
not know.  A load may bring new columns and wider types; what would lose values is an
error.  Files written before a change are read as they are: absent columns are NULL and
narrower numbers are widened by the Parquet reader.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import folders

#: The whole and floating types a column may become, narrowest first.
LADDERS = [[T.ByteType, T.ShortType, T.IntegerType, T.LongType], [T.FloatType, T.DoubleType],
           [T.ByteType, T.ShortType, T.IntegerType, T.DoubleType]]


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds every value of both without loss, or None."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    for ladder in LADDERS:
        if type(a) in ladder and type(b) in ladder:
            return ladder[max(ladder.index(type(a)), ladder.index(type(b)))]()
    return None


def merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` widened by ``new``; columns that only ``new`` has come last."""
    by_name = {f.name: f for f in new.fields}
    fields = []
    for f in old.fields:
        other = by_name.pop(f.name, None)
        kind = f.dataType if other is None else wider(f.dataType, other.dataType)
        if kind is None:
            raise ValueError(f"column {f.name!r} is {f.dataType.simpleString()} and cannot become {other.dataType.simpleString()}")
        fields.append(T.StructField(f.name, kind))
    known = {f.name.lower(): f.name for f in fields}
    for name in by_name:
        if name.lower() in known:
            raise ValueError(f"columns {known[name.lower()]!r} and {name!r} differ in case only")
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name in by_name])


def _folder(target: str) -> str:
    return target.rstrip("/") + "__schema"


def stored(spark: SparkSession, target: str) -> T.StructType | None:
    """The table's columns: as stored, else as its files have them; None without a table."""
    versions = [int(n.split(".")[0]) for n in folders.names(spark, _folder(target)) if n.endswith(".json")]
    if versions:
        return T.StructType.fromJson(json.loads(folders.read_text(spark, f"{_folder(target)}/{max(versions)}.json")))
    if not folders.exists(spark, target):
        return None
    found = spark.read.option("mergeSchema", True).parquet(target).schema
    return T.StructType([f for f in found.fields if f.name not in folders.PARTITIONS])


def evolve(spark: SparkSession, target: str, new: T.StructType) -> T.StructType:
    """The columns of ``target`` after a load of ``new``, stored if they changed.  An
    incompatible type is an error, raised before anything is written."""
    old = stored(spark, target)
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in new.fields if f.name not in folders.PARTITIONS])
    both = plain if old is None else merged(old, plain)
    versions = [int(n.split(".")[0]) for n in folders.names(spark, _folder(target)) if n.endswith(".json")]
    if both != old or not versions:
        folders.write_whole(spark, f"{_folder(target)}/{max(versions, default=-1) + 1}.json", both.json())
    return both


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` in its order; absent ones are NULL."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def read(spark: SparkSession, target: str, paths: list[str] | None = None) -> DataFrame:
    """The table, or the given folders of it, with all of its columns; folders' numbers
    (``_batch=3``) are columns as Spark reads them."""
    schema = stored(spark, target)
    if schema is None:
        raise FileNotFoundError(f"no table at {target}")
    kinds = {n.split("=")[0] for n in folders.names(spark, target) if "=" in n}
    parts = [T.StructField(p, T.IntegerType()) for p in folders.PARTITIONS if p in kinds]
    reader = spark.read.schema(T.StructType([*schema.fields, *parts]))
    return reader.option("basePath", target).parquet(*paths) if paths else reader.parquet(target)
