"""Profile-driven data-quality validation.

The six check groups run as three Spark jobs instead of one scan per check:

1. one fused aggregate: row count, per-column null counts, per-range-column
   below/above counts and min/max, per-numeric-column n/mean/std;
2. one aggregate counting |z| > threshold per numeric column, with the
   means and stds from job 1 as literals (a handful of scalars);
3. one duplicate count: a row-hash pre-aggregate, then exact whole-row
   grouping of the candidate rows only.

Only these bounded scalars reach the driver.  Results come back as a report
dict (the reference's shape) and as a DataFrame of check rows.
"""

from __future__ import annotations

import copy
import datetime as _dt
import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.semantics import is_numeric_type, nan_to_null, round_ieee, to_number

# The three built-in validation profiles.
VALIDATION_PROFILES = {
    "vendor_summary": {
        "required_columns": [
            "VendorNumber", "VendorName", "Brand", "Description",
            "PurchasePrice", "ActualPrice", "Volume",
            "TotalPurchaseQuantity", "TotalPurchaseDollars",
            "TotalSalesQuantity", "TotalSalesDollars",
            "GrossProfit", "ProfitMargin", "StockTurnover",
        ],
        "numeric_columns": [
            "PurchasePrice", "ActualPrice", "Volume",
            "TotalPurchaseQuantity", "TotalPurchaseDollars",
            "TotalSalesQuantity", "TotalSalesDollars",
            "GrossProfit", "ProfitMargin", "StockTurnover",
            "SalesToPurchaseRatio", "FreightCost",
        ],
        "non_nullable": ["VendorNumber", "VendorName", "Brand"],
        "unique_keys": [],
        "range_checks": {
            "PurchasePrice": {"min": 0, "max": 10000},
            "ActualPrice": {"min": 0, "max": 10000},
            "Volume": {"min": 0, "max": 100000},
            "ProfitMargin": {"min": -500, "max": 500},
            "StockTurnover": {"min": 0, "max": 1000},
        },
        "null_threshold": 0.10,
    },
    "purchases": {
        "required_columns": [
            "InventoryId", "Store", "Brand", "VendorNumber",
            "VendorName", "PurchasePrice", "Quantity", "Dollars",
        ],
        "numeric_columns": ["Store", "Brand", "VendorNumber", "PurchasePrice", "Quantity", "Dollars"],
        "non_nullable": ["InventoryId", "Brand", "VendorNumber"],
        "unique_keys": [],
        "range_checks": {
            "PurchasePrice": {"min": 0, "max": 10000},
            "Quantity": {"min": -100, "max": 100000},
        },
        "null_threshold": 0.05,
    },
    "sales": {
        "required_columns": [
            "SalesQuantity", "SalesDollars", "SalesPrice",
            "VendorNo", "Brand",
        ],
        "numeric_columns": ["SalesQuantity", "SalesDollars", "SalesPrice", "VendorNo", "Brand"],
        "non_nullable": ["VendorNo", "Brand"],
        "unique_keys": [],
        "range_checks": {
            "SalesPrice": {"min": 0, "max": 50000},
            "SalesQuantity": {"min": -1000, "max": 100000},
        },
        "null_threshold": 0.05,
    },
}

CHECK_SCHEMA = T.StructType([
    T.StructField("check", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("details", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
])


def _py_round(x, nd):
    if x is None:
        return None
    x = float(x)
    return x if math.isnan(x) else round(x, nd)


def _plain(x):
    """``x`` with infinite numbers and NaN as text, which JSON has no numbers for."""
    if isinstance(x, dict):
        return {k: _plain(v) for k, v in x.items()}
    if isinstance(x, float) and not math.isfinite(x):
        return "NaN" if math.isnan(x) else "Infinity" if x > 0 else "-Infinity"
    return x


def _num(df: DataFrame, c: str):
    """The value a check sees: numbers as-is (NaN -> NULL), text coerced."""
    dt = df.schema[c].dataType
    if isinstance(dt, T.StringType):
        return to_number(c)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return nan_to_null(c)
    if isinstance(dt, T.BooleanType):
        return F.col(c).cast("double")
    return F.col(c).cast("double")


def _is_null(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """(column, null_count, null_fraction, rows) for every column, one scan."""
    n = F.count(F.lit(1))
    aggs = []
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(_is_null(df, c)).alias(f"n{i}"))
    wide = df.agg(n.alias("rows"), *aggs)
    stack = ", ".join(f"'{c}', n{i}" for i, c in enumerate(df.columns))
    long = wide.selectExpr("rows", f"stack({len(df.columns)}, {stack}) AS (column, null_count)")
    return long.select("column", "null_count",
                       F.when(F.col("rows") > 0, F.col("null_count") / F.col("rows")).alias("null_fraction"),
                       "rows")


def duplicate_frame(df: DataFrame) -> DataFrame:
    """One row (rows, distinct_rows, duplicate_rows), exact.

    pandas ``duplicated``: first occurrence kept, NULLs equal.  Pass 1 shuffles
    only (row hash, count) partial aggregates; rows whose hash occurs once
    cannot be duplicates.  Only candidate rows (hash seen more than once) go
    through the exact whole-row grouping, so a hash collision can only add a
    candidate, never a wrong count.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    hashed = df.withColumn("_h", F.xxhash64(*cols))
    per_hash = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    rows = per_hash.select(F.sum("_n")).scalar()
    cand = per_hash.where(F.col("_n") > 1).select("_h")
    exact = (hashed.join(cand, "_h", "left_semi").groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
             .select(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("dups")))
    return exact.select(F.coalesce(rows, F.lit(0)).alias("rows"),
                        (F.coalesce(rows, F.lit(0)) - F.col("dups")).alias("distinct_rows"),
                        F.col("dups").alias("duplicate_rows"))


def duplicate_count(df: DataFrame) -> int:
    """A13 as a number."""
    return int(duplicate_frame(df).first()["duplicate_rows"])


class DataQualityValidator:
    def __init__(self, custom_profiles: dict | None = None):
        self.profiles = copy.deepcopy(VALIDATION_PROFILES)
        if custom_profiles:
            self.profiles.update(custom_profiles)

    def profile(self, name: str) -> dict:
        if name not in self.profiles:
            raise ValueError(f"Unknown profile '{name}'. Available: {list(self.profiles)}")
        return self.profiles[name]

    # -- job 1 -------------------------------------------------------------
    def _scan(self, df: DataFrame, cfg: dict) -> dict:
        cols = df.columns
        ranges = {c: b for c, b in cfg.get("range_checks", {}).items() if c in cols}
        numeric = [c for c in cfg.get("numeric_columns", []) if c in cols]
        aggs = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(cols):
            aggs.append(F.count_if(_is_null(df, c)).alias(f"null_{i}"))
        for i, (c, b) in enumerate(ranges.items()):
            v = _num(df, c)
            aggs.append(F.count_if(v < F.lit(float(b["min"]))).alias(f"lo_{i}") if "min" in b else F.lit(0).alias(f"lo_{i}"))
            aggs.append(F.count_if(v > F.lit(float(b["max"]))).alias(f"hi_{i}") if "max" in b else F.lit(0).alias(f"hi_{i}"))
            aggs.append(F.min(v).alias(f"min_{i}"))
            aggs.append(F.max(v).alias(f"max_{i}"))
        for i, c in enumerate(numeric):
            v = _num(df, c)
            aggs += [F.count(v).alias(f"n_{i}"), F.avg(v).alias(f"mean_{i}"),
                     F.stddev_samp(v).alias(f"std_{i}")]
        r = df.agg(*aggs).first().asDict()
        return {"rows": r["rows"], "ranges": ranges, "numeric": numeric,
                "nulls": {c: r[f"null_{i}"] for i, c in enumerate(cols)},
                "range": {c: (r[f"lo_{i}"], r[f"hi_{i}"], r[f"min_{i}"], r[f"max_{i}"])
                          for i, c in enumerate(ranges)},
                "moments": {c: (r[f"n_{i}"], r[f"mean_{i}"], r[f"std_{i}"])
                            for i, c in enumerate(numeric)}}

    # -- job 2 -------------------------------------------------------------
    @staticmethod
    def _outlier_counts(df: DataFrame, moments: dict, z: float) -> dict:
        live = {c: (m, s) for c, (n, m, s) in moments.items()
                if n >= 3 and s is not None and s != 0}
        if not live:
            return {}
        aggs = [F.count_if(nan_to_null(F.abs((_num(df, c) - F.lit(m)) / F.lit(s))) > F.lit(float(z))).alias(f"o_{i}")
                for i, (c, (m, s)) in enumerate(live.items())]
        r = df.agg(*aggs).first()
        return {c: int(r[f"o_{i}"]) for i, c in enumerate(live)}

    # -- fences --------------------------------------------------------------
    @staticmethod
    def _iqr_counts(df: DataFrame, cfg: dict) -> dict:
        """Values beyond the quartiles by ``iqr_factor`` (1.5) ranges, for the profile's
        ``iqr_columns`` with at least 3 values: one quantile job for all of them, one count."""
        from .explore import iqr_bounds
        cols = [c for c in cfg.get("iqr_columns", []) if c in df.columns]
        if not cols:
            return {}
        numbers = df.select(*[_num(df, c).alias(c) for c in cols])
        fences = {r["column"]: r for r in iqr_bounds(numbers, cols, float(cfg.get("iqr_factor", 1.5))).collect()}
        aggs = []
        for i, c in enumerate(cols):
            out = F.lit(False)
            if c in fences and fences[c]["lower"] is not None:
                out = (F.col(c) < F.lit(fences[c]["lower"])) | (F.col(c) > F.lit(fences[c]["upper"]))
            aggs += [F.count(c).alias(f"n_{i}"), F.count_if(out).alias(f"o_{i}")]
        r = numbers.agg(*aggs).first()
        return {c: (r[f"n_{i}"], int(r[f"o_{i}"]), *[fences[c][k] for k in ("q1", "q3", "lower", "upper")])
                for i, c in enumerate(cols) if r[f"n_{i}"] >= 3}

    def run_checks(self, df: DataFrame, profile: str = "vendor_summary",
                   z_threshold: float = 3.0) -> list[dict]:
        return self._run(df, profile, z_threshold)[0]

    def _run(self, df: DataFrame, profile: str, z_threshold: float):
        cfg = self.profile(profile)
        now = _dt.datetime.now().isoformat()
        out = []

        def add(name, passed, details):
            out.append({"check": name, "passed": bool(passed), "details": details, "timestamp": now})

        required = cfg.get("required_columns", [])
        missing = [c for c in required if c not in df.columns]
        add("schema_completeness", not missing,
            {"required": len(required), "present": len(df.columns), "missing_columns": missing})

        scan = self._scan(df, cfg)
        rows = scan["rows"]
        threshold = cfg.get("null_threshold", 0.10)
        high = {c: round(n / rows, 4) for c, n in scan["nulls"].items()
                if rows and n / rows > threshold}
        add("null_threshold", not high, {"threshold": threshold, "columns_exceeding": high})
        for c in cfg.get("non_nullable", []):
            if c in df.columns:
                add(f"non_nullable_{c}", scan["nulls"][c] == 0,
                    {"column": c, "null_count": int(scan["nulls"][c])})

        dup = duplicate_count(df)
        add("row_duplicates", dup == 0,
            {"duplicate_rows": dup, "duplicate_pct": round(dup / rows * 100, 4) if rows else 0})

        for c, b in scan["ranges"].items():
            lo, hi, mn, mx = scan["range"][c]
            viol = int(lo) + int(hi)
            add(f"range_{c}", viol == 0,
                {"column": c, "bounds": b, "violations": viol,
                 "actual_min": _py_round(mn, 4) if rows else None,
                 "actual_max": _py_round(mx, 4) if rows else None})

        counts = self._outlier_counts(df, scan["moments"], z_threshold)
        for c, (n, m, s) in scan["moments"].items():
            if c not in counts:
                continue
            k = counts[c]
            add(f"outlier_{c}", k < n * 0.05,
                {"column": c, "z_threshold": z_threshold, "outlier_count": k,
                 "outlier_pct": round(k / n * 100, 2), "mean": round(float(m), 4),
                 "std": round(float(s), 4)})

        for c, (n, far, q1, q3, low, high) in self._iqr_counts(df, cfg).items():
            add(f"iqr_{c}", far < n * 0.05,
                {"column": c, "factor": float(cfg.get("iqr_factor", 1.5)), "outlier_count": far,
                 "outlier_pct": round(far / n * 100, 2), "q1": q1, "q3": q3, "lower": low, "upper": high})

        bad = [c for c in cfg.get("numeric_columns", [])
               if c in df.columns and not is_numeric_type(df.schema[c].dataType)]
        add("dtype_numeric", not bad,
            {"expected_numeric": len(cfg.get("numeric_columns", [])), "non_numeric_columns": bad})

        if cfg.get("unique_keys"):
            keys = cfg["unique_keys"]
            dups = (df.groupBy(*keys).count().where(F.col("count") > 1)
                    .agg(F.count(F.lit(1)).alias("k")).first()["k"])
            add("unique_keys", dups == 0, {"keys": keys, "duplicate_keys": int(dups)})
        return out, rows

    def validate(self, df: DataFrame, profile: str = "vendor_summary",
                 z_threshold: float = 3.0) -> dict:
        results, rows = self._run(df, profile, z_threshold)
        total = len(results)
        passed = sum(r["passed"] for r in results)
        return {
            "profile": profile,
            "timestamp": _dt.datetime.now().isoformat(),
            "row_count": rows,
            "column_count": len(df.columns),
            "total_checks": total,
            "passed": passed,
            "failed": total - passed,
            "pass_rate": round(passed / total * 100, 2) if total else 0,
            "results": results,
        }

    def check_frame(self, df: DataFrame, profile: str = "vendor_summary",
                    z_threshold: float = 3.0) -> DataFrame:
        """The report as a DataFrame of check rows (details as JSON text)."""
        rows = [(r["check"], r["passed"], json.dumps(_plain(r["details"]), default=str), r["timestamp"])
                for r in self.run_checks(df, profile, z_threshold)]
        return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)

    def totals_frame(self, df: DataFrame, profile: str = "vendor_summary",
                     z_threshold: float = 3.0) -> DataFrame:
        """D8 as a one-row DataFrame: row and column counts, checks passed and failed,
        and the pass rate in percent."""
        report = self.validate(df, profile, z_threshold)
        return df.sparkSession.createDataFrame(
            [(report["profile"], report["row_count"], report["column_count"], report["total_checks"],
              report["passed"], report["failed"], float(report["pass_rate"]))],
            "profile STRING, row_count LONG, column_count LONG, total_checks LONG, passed LONG, failed LONG, pass_rate DOUBLE")


def details_frame(checks: DataFrame, details: dict[str, str]) -> DataFrame:
    """``check_frame`` rows with the named numbers of their details as columns."""
    return checks.select("check", "passed", *[
        F.get_json_object("details", f"$.{name}").cast(kind).alias(name) for name, kind in details.items()])


def range_frame(df: DataFrame, profile: dict) -> DataFrame:
    """D5 as a DataFrame: one row per present range column, one scan."""
    ranges = {c: b for c, b in profile.get("range_checks", {}).items() if c in df.columns}
    aggs = []
    for i, (c, b) in enumerate(ranges.items()):
        v = _num(df, c)
        aggs += [F.count_if(v < F.lit(float(b.get("min", float("-inf"))))).alias(f"lo_{i}"),
                 F.count_if(v > F.lit(float(b.get("max", float("inf"))))).alias(f"hi_{i}"),
                 F.min(v).alias(f"mn_{i}"), F.max(v).alias(f"mx_{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', CAST({b.get('min')} AS DOUBLE), CAST({b.get('max')} AS DOUBLE), lo_{i}, hi_{i}, mn_{i}, mx_{i}"
        for i, (c, b) in enumerate(ranges.items()))
    long = wide.selectExpr(
        f"stack({len(ranges)}, {parts}) AS (column, min_bound, max_bound, below, above, actual_min, actual_max)")
    return long.select(
        "column", "min_bound", "max_bound", "below", "above",
        (F.col("below") + F.col("above")).alias("violations"),
        round_ieee("actual_min", 4).alias("actual_min"),
        round_ieee("actual_max", 4).alias("actual_max"),
        ((F.col("below") + F.col("above")) == 0).alias("passed"))


def outlier_frame(df: DataFrame, profile: dict, z_threshold: float = 3.0) -> DataFrame:
    """D6 as a DataFrame: per numeric column n, mean, std, |z| > t count.

    Means and stds enter the counting pass as scalar subqueries, so the plan
    is two aggregates over the input and nothing is collected.
    """
    numeric = [c for c in profile.get("numeric_columns", []) if c in df.columns]
    aggs = []
    for i, c in enumerate(numeric):
        v = _num(df, c)
        m = df.select(F.avg(v)).scalar()
        s = df.select(F.stddev_samp(v)).scalar()
        aggs += [F.count(v).alias(f"n_{i}"), F.avg(v).alias(f"m_{i}"), F.stddev_samp(v).alias(f"s_{i}"),
                 F.count_if(nan_to_null(F.abs((v - m) / F.when(s != 0, s))) > F.lit(float(z_threshold))).alias(f"o_{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', n_{i}, m_{i}, s_{i}, o_{i}" for i, c in enumerate(numeric))
    long = wide.selectExpr(f"stack({len(numeric)}, {parts}) AS (column, n, mean, std, outlier_count)")
    long = long.where((F.col("n") >= 3) & F.col("std").isNotNull() & (F.col("std") != 0))
    return long.select(
        "column", "n", round_ieee("mean", 4).alias("mean"), round_ieee("std", 4).alias("std"),
        "outlier_count",
        round_ieee(F.col("outlier_count") / F.col("n") * 100, 2).alias("outlier_pct"),
        (F.col("outlier_count") < F.col("n") * 0.05).alias("passed"))


def save_report(spark: SparkSession, report: dict, path: str) -> str:
    """The report as JSON text in a file of the shared store (any Hadoop path)."""
    from ..sinks.folders import write_text
    report = {**report, "results": [{**r, "details": _plain(r["details"])} for r in report["results"]]}
    write_text(spark, path, json.dumps(report, indent=2, default=str))
    return path


def summary_text(report: dict) -> str:
    lines = [f"Profile: {report['profile']}  rows={report['row_count']}  "
             f"checks={report['total_checks']}  passed={report['passed']}  "
             f"failed={report['failed']}  pass_rate={report['pass_rate']}%"]
    for r in report["results"]:
        lines.append(f"  [{'PASS' if r['passed'] else 'FAIL'}] {r['check']}")
    return "\n".join(lines)
