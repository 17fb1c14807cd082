"""Checks between related tables (D9): references that lead nowhere, and sums that two
tables hold of the same thing.

A child table is reduced to one row a key before it meets its parent, so a key that
holds a third of all rows meets one row, and the keys without a parent are written
once for the counts and the examples.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: Keys shown as examples of what a check found.
EXAMPLES = 5
CHECK_COLUMNS = ["check", "passed", "checked", "without_key", "failed", "failed_keys", "failed_pct", "examples"]


@dataclass(frozen=True)
class Reference:
    """Every key in ``child`` has to be in ``parent`` (names of tables and columns)."""
    child: str
    keys: tuple[str, ...]
    parent: str
    parent_keys: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{self.child}_{'_'.join(self.keys)}_in_{self.parent}"


@dataclass(frozen=True)
class Balance:
    """For each key, ``left`` and ``right`` hold the same sums of ``measures``."""
    left: str
    right: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{self.left}_{'_'.join(self.measures)}_as_in_{self.right}"


def _no_key(keys: Sequence[str]) -> F.Column:
    """A NULL in any part refers to nothing, as in SQL."""
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def _shown(keys: Sequence[str]) -> F.Column:
    return F.concat_ws("/", *[F.col(k).cast("string") for k in keys])


def _result(name: str, counts: DataFrame, bad: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One check row: ``counts`` (``checked``, ``without_key``) and the stored ``bad`` keys
    with their number of rows ``n``."""
    first = bad.orderBy(F.desc("n"), *keys).limit(EXAMPLES).withColumn("place", F.struct((-F.col("n")).alias("n"), *keys))
    shown = first.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", _shown(keys).alias("key")))),
                                               lambda x: x["key"]), ", ").alias("examples"))
    total = bad.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed"), F.count(F.lit(1)).alias("failed_keys"))
    one = counts.select("checked", "without_key", total.select("failed").scalar().alias("failed"),
                        total.select("failed_keys").scalar().alias("failed_keys"), shown.select("examples").scalar().alias("examples"))
    return one.select(F.lit(name).alias("check"), (F.col("failed") == 0).alias("passed"), "checked", "without_key", "failed",
                      "failed_keys", F.when(F.col("checked") > 0, F.col("failed") * 100 / F.col("checked")).otherwise(0.0).alias("failed_pct"),
                      "examples")


def reference_check(tables: dict[str, DataFrame], ref: Reference) -> DataFrame:
    child, keys = tables[ref.child], list(ref.keys)
    per_key = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    per_key = stored(per_key, "reference_keys")
    parent = tables[ref.parent].select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(ref.parent_keys)]).distinct()
    same = [F.col(k) == F.col(f"_p{i}") for i, k in enumerate(keys)]
    bad = stored(per_key.where(~_no_key(keys)).join(parent, same, "left_anti"), "reference_orphans")
    counts = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
                         F.coalesce(F.sum(F.when(_no_key(keys), F.col("n"))), F.lit(0)).alias("without_key"))
    return _result(ref.name, counts, bad, keys)


def balance_check(tables: dict[str, DataFrame], balance: Balance) -> DataFrame:
    """Keys whose sums differ, or that only one side has; ``checked`` counts keys."""
    keys, measures = list(balance.keys), list(balance.measures)

    def sums(name: str, side: str) -> DataFrame:
        return (tables[name].where(~_no_key(keys)).groupBy(*keys)
                .agg(*[F.sum(m).alias(f"{side}{i}") for i, m in enumerate(measures)], F.lit(True).alias(f"{side}_there")))
    both = sums(balance.left, "l").join(sums(balance.right, "r"), keys, "full_outer")
    equal = F.col("l_there").isNotNull() & F.col("r_there").isNotNull()
    for i in range(len(measures)):
        equal = equal & F.col(f"l{i}").eqNullSafe(F.col(f"r{i}"))
    compared = stored(both.select(*keys, equal.alias("equal")), "balance_keys")
    bad = compared.where(~F.col("equal")).withColumn("n", F.lit(1).cast("long"))
    nowhere = sum((tables[t].select(F.count_if(_no_key(keys))).scalar() for t in (balance.left, balance.right)), F.lit(0).cast("long"))
    counts = compared.agg(F.count(F.lit(1)).alias("checked")).select("checked", nowhere.alias("without_key"))
    return _result(balance.name, counts, bad, keys)


def cross_checks(tables: dict[str, DataFrame], checks: Sequence[Reference | Balance]) -> DataFrame:
    """One row a check: ``check, passed, checked`` (rows, of a balance keys), ``without_key,
    failed, failed_keys, failed_pct`` and ``examples`` (the keys with most failing rows)."""
    out = None
    for c in checks:
        row = reference_check(tables, c) if isinstance(c, Reference) else balance_check(tables, c)
        out = row if out is None else out.unionByName(row)
    return out


#: The relations of the procurement tables.
PROCUREMENT_CHECKS = (
    Reference("purchases", ("Brand",), "purchase_prices", ("Brand",)),
    Reference("sales", ("VendorNo",), "purchases", ("VendorNumber",)),
    Reference("sales", ("Brand",), "purchase_prices", ("Brand",)),
    Reference("vendor_invoice", ("VendorNumber",), "purchase_prices", ("VendorNumber",)),
    Reference("purchases", ("VendorNumber", "PONumber"), "vendor_invoice", ("VendorNumber", "PONumber")),
    Balance("vendor_invoice", "purchases", ("VendorNumber", "PONumber"), ("Quantity", "Dollars")),
)
