"""Which part of a table changed (K13): digests by key bucket, compared level by level.

A row falls in a bucket by the leading hex digits of the MD5 of its key, and a bucket's
digest is the sum of its rows' hashes, so digests neither depend on the rows' order nor
let repeated rows cancel.  Only the leaves are computed from rows; a level above is a sum
of theirs.  Two versions are compared from the root: below a bucket whose digests agree
nothing is looked at, and rows are read only from the leaves that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cells_text, row_hash

#: Hex digits of a leaf: 16 ** DEPTH leaves.
DEPTH = 3


def bucket_of(key: Sequence[str], depth: int = DEPTH) -> F.Column:
    return F.substring(F.md5(cells_text(key)), 1, depth)


def digest_leaves(df: DataFrame, key: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """``bucket, rows, digest`` of every leaf that holds rows, in one aggregate."""
    return (df.groupBy(bucket_of(key, depth).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(row_hash(df.columns)).alias("digest")))


def changed_buckets(old: DataFrame, new: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``level, bucket, old_rows, new_rows`` of the buckets on every level whose digests
    differ, given the leaves of two versions; level 0 is the whole table."""
    def level(leaves: DataFrame, digits: int, side: str) -> DataFrame:
        return leaves.groupBy(F.substring("bucket", 1, digits).alias("bucket")).agg(
            F.sum("rows").alias(f"{side}_rows"), F.sum("digest").alias(f"{side}_digest"))

    out, above = None, None
    for digits in range(depth + 1):
        a, b = level(old, digits, "old"), level(new, digits, "new")
        if above is not None:
            parents = above.select(F.col("bucket").alias("_parent"))
            a, b = (x.join(parents, F.substring("bucket", 1, digits - 1) == F.col("_parent"), "left_semi") for x in (a, b))
        above = (a.join(b, "bucket", "full_outer").where(~F.col("old_digest").eqNullSafe(F.col("new_digest")))
                 .select(F.lit(digits).alias("level"), "bucket", *[F.coalesce(f"{s}_rows", F.lit(0).cast("long")).alias(f"{s}_rows")
                                                                   for s in ("old", "new")]))
        out = above if out is None else out.unionByName(above)
    return out


def changed_rows(old: DataFrame, new: DataFrame, key: Sequence[str], buckets: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``change`` (added, removed, changed), the key and how many rows either version has
    of it, for the keys whose rows differ; only rows of the given leaves are compared."""
    leaves = buckets.where(F.col("level") == depth).select("bucket")

    def side(df: DataFrame, name: str) -> DataFrame:
        near = df.withColumn("bucket", bucket_of(key, depth)).join(leaves, "bucket", "left_semi")
        return near.groupBy(*key).agg(F.count(F.lit(1)).alias(f"{name}_rows"), F.sum(row_hash(df.columns)).alias(f"{name}_digest"))
    a, b = side(old, "old").alias("a"), side(new, "new").alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
    both = a.join(b, same, "full_outer").where(~F.col("old_digest").eqNullSafe(F.col("new_digest")))
    change = F.when(F.col("old_rows").isNull(), "added").when(F.col("new_rows").isNull(), "removed").otherwise("changed")
    return both.select(change.alias("change"), *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in key],
                       *[F.coalesce(f"{s}_rows", F.lit(0).cast("long")).alias(f"{s}_rows") for s in ("old", "new")])
