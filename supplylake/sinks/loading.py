"""Loading with reject isolation and the load report.

The reference inserts in 1000-row batches and counts failed batches.  On
Spark the unit is the row: every input row is cast to the target schema
with ``try_cast``; a row whose non-NULL input turns NULL failed and goes to
a quarantine frame with the reason.  Counts come from one aggregate over a flag column.

A folder of many files is loaded by header: files with equal headers are one scan, whose
text is parsed once and staged by entry; one aggregate gives all entries' types, counts
and faults, and entries of equal types are written together.  The number of jobs follows
the number of different headers and types, not of files.
"""

from __future__ import annotations

import csv
import datetime as _dt
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.semantics import null_tokens_to_null
from ..session import scratch_path, stored
from ..sources.files import BAD_LINE
from . import folders

log = logging.getLogger(__name__)

REASON = "_reason"


def faults(df: DataFrame, schema: T.StructType) -> F.Column:
    """What keeps a row out of ``schema``: the cells that are not of its types, or that
    its line does not fit the header; NULL for a row that fits."""
    found = []
    for f in schema.fields:
        src = F.col(f"`{f.name}`")
        src = null_tokens_to_null(src) if isinstance(df.schema[f.name].dataType, T.StringType) else src
        found.append(F.when(src.isNotNull() & src.try_cast(f.dataType).isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}")))
    cells = F.concat_ws("; ", *found) if found else F.lit("")
    reason = F.when(cells != "", cells)
    if BAD_LINE in df.columns:
        reason = F.when(F.col(BAD_LINE).isNotNull(), "the line does not fit the header").otherwise(reason)
    return reason


def cast_cells(df: DataFrame, schema: T.StructType) -> list[F.Column]:
    """Cells of rows that fit ``schema``, as its types; missing-value tokens are NULL."""
    out = []
    for f in schema.fields:
        src = F.col(f"`{f.name}`")
        src = null_tokens_to_null(src) if isinstance(df.schema[f.name].dataType, T.StringType) else src
        out.append(src.try_cast(f.dataType).alias(f.name))
    return out


def split_rejects(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(accepted rows cast to ``schema``, rejected rows as they came in with ``_reason``)."""
    flagged = df.withColumn(REASON, faults(df, schema))
    return (flagged.where(F.col(REASON).isNull()).select(*cast_cells(df, schema)), flagged.where(F.col(REASON).isNotNull()))


def load_table(spark: SparkSession, source: str, target: str, rejects: str,
               schema: T.StructType | None = None, multi_line: bool = False) -> tuple[int, int, int]:
    """Write a CSV as a table and what does not fit it as ``rejects``; rows in all,
    inserted and rejected, counted from what was written.  An entry without rows
    writes nothing.  With a schema the text is parsed once, into the shared folder."""
    from ..sources.files import csv_with_bad_lines, load_csv
    bad = None
    if schema is None:
        rows = load_csv(spark, source, multi_line=multi_line)
    else:
        rows, bad = split_rejects(stored(csv_with_bad_lines(spark, source, schema, multi_line=multi_line), "csv_lines"), schema)
    rows.write.mode("overwrite").parquet(target)
    inserted, failed = spark.read.parquet(target).count(), 0
    if bad is not None:
        bad.write.mode("overwrite").parquet(rejects)
        failed = spark.read.parquet(rejects).count()
    for path, n in ((target, inserted), (rejects, failed)):
        if not n:
            folders.remove(spark, path)
    return inserted + failed, inserted, failed


# ---------------------------------------------------------------- many entries

ENTRY = "_entry"
#: Headers read, and groups of entries loaded, at a time.
TOGETHER = 4


def header_of(line: str | None) -> tuple[str, ...] | None:
    """The names in a header line, or None where Spark would name columns otherwise
    (empty or repeated names, a quote that goes on, a byte-order mark)."""
    if line is None:
        return ()
    if line.startswith("\ufeff") or line.count('"') % 2:
        return None
    names = tuple(next(csv.reader([line]), []))
    return names if names and all(names) and len({n.lower() for n in names}) == len(names) else None


def load_entries(spark: SparkSession, base: str, entries: dict[str, str], target: str,
                 schemas: dict[str, T.StructType], multi_line: bool) -> list[tuple]:
    """Load the entries (files or folders of CSV below ``base``, with their tables' names)
    and give for each: entry, table, total, inserted and failed rows, status, error."""
    with ThreadPoolExecutor(TOGETHER) as pool:
        lines = list(pool.map(lambda e: folders.first_line(spark, f"{base}/{e}"), entries))
        groups: dict[tuple, list[str]] = {}
        results = {}
        for e, line in zip(entries, lines):
            names, schema = header_of(line), schemas.get(entries[e])
            if names == ():
                results[e] = (e, entries[e], 0, 0, 0, "skipped", None)
            elif names is None or (schema is not None and tuple(schema.names) != names):
                groups[("alone", e)] = [e]
            else:
                groups.setdefault((names, None if schema is None else schema.json()), []).append(e)

        def load(group: tuple) -> list[tuple]:
            found = groups[group]
            if group[0] != "alone":
                try:
                    return _load_group(spark, base, {e: entries[e] for e in found}, target, group[0], schemas.get(entries[found[0]]), multi_line)
                except Exception:  # a file that cannot be read fails alone
                    log.warning("loading %d entries one by one", len(found))
            return [_load_alone(spark, base, e, entries[e], target, schemas.get(entries[e]), multi_line) for e in found]
        for rows in pool.map(load, list(groups)):
            results.update({r[0]: r for r in rows})
    return [results[e] for e in entries]


def _load_alone(spark, base, entry, name, target, schema, multi_line) -> tuple:
    try:
        total, inserted, failed = load_table(spark, f"{base}/{entry}", f"{target}/{name}", f"{target}/_rejects/{name}", schema, multi_line)
        return entry, name, total, inserted, failed, "success" if total else "skipped", None
    except Exception as exc:
        return entry, name, 0, 0, 0, "failed", str(exc)


def _load_group(spark: SparkSession, base: str, entries: dict[str, str], target: str, names: tuple[str, ...],
                schema: T.StructType | None, multi_line: bool) -> list[tuple]:
    """Entries with one header (and schema) as one scan."""
    from ..sources.files import chosen_types, csv_with_bad_lines, kind_bits, typed_cells
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    paths = [f"{base}/{e}" for e in entries]
    one_slash = ("^([a-z0-9]+):/+", "$1:/")  # the two spellings of a local path
    numbers = (spark.createDataFrame([(folders.uri(spark, p), i) for i, p in enumerate(paths)], f"_uri string, {ENTRY} int")
               .withColumn("_uri", F.regexp_replace("_uri", *one_slash)))
    lines = csv_with_bad_lines(spark, paths, text, multi_line=multi_line)
    path = F.regexp_replace(F.col("_metadata.file_path"), *one_slash)
    folder = F.regexp_replace(path, "/[^/]*$", "")
    top = F.regexp_replace(F.lit(folders.uri(spark, base)), *one_slash)
    uri = F.when(folder == top, path).otherwise(folder)  # an entry is a file, or a folder of files
    stage = scratch_path(spark, "landing_text")
    lines = lines.withColumn("_uri", uri).join(F.broadcast(numbers), "_uri").drop("_uri")  # the driver's own list of entries
    if len(entries) == 1:  # nothing to deal out, so nothing to sort
        lines.drop(ENTRY).write.parquet(f"{stage}/{ENTRY}=0")
    else:
        lines.write.partitionBy(ENTRY).parquet(stage)
    kinds = T.StructType([*text.fields, T.StructField(BAD_LINE, T.StringType()), T.StructField(ENTRY, T.IntegerType())])
    staged = spark.read.schema(kinds).parquet(stage)
    bad = F.col(BAD_LINE).isNotNull() if schema is None else faults(staged, schema).isNotNull()
    # sums and bits alone: a text among them would make Spark sort all rows by entry
    stats = staged.groupBy(ENTRY).agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad")).collect()  # one row an entry
    by_number = {r[ENTRY]: r for r in stats}
    kinds_of, example = {}, {}
    if schema is None:
        for r in kind_bits(staged, list(names), keys=[ENTRY]).collect():  # one row a column of an entry
            kinds_of.setdefault(r[ENTRY], []).append(r)
        if any(r["bad"] for r in stats):
            example = {r[ENTRY]: r["line"] for r in staged.where(bad).groupBy(ENTRY).agg(F.min(BAD_LINE).alias("line")).collect()}
    results, writes = [], {}
    for i, (entry, name) in enumerate(entries.items()):
        r = by_number.get(i)
        if r is None:
            results.append((entry, name, 0, 0, 0, "skipped", None))
        elif schema is None and r["bad"]:
            results.append((entry, name, 0, 0, 0, "failed", f"{r['bad']} lines do not fit the header, such as {example[i]!r}"))
        else:
            results.append((entry, name, r["rows"], r["rows"] - r["bad"], r["bad"], "success", None))
            types = tuple(chosen_types(list(names), kinds_of.get(i, ())).items()) if schema is None else ()
            writes.setdefault(types, []).append(i)
    titles = list(entries.values())
    for types, members in writes.items():
        rows = staged.where(F.col(ENTRY).isin(members))
        if schema is None:
            good = rows.select(*typed_cells(list(names), dict(types)), ENTRY)
        else:
            good = rows.where(~bad).select(*cast_cells(rows, schema), ENTRY)
        _put_entries(spark, good, {i: f"{target}/{titles[i]}" for i in members if by_number[i]["rows"] > by_number[i]["bad"]})
        rejected = [i for i in members if by_number[i]["bad"]]
        for i in set(members) - set(rejected):
            folders.remove(spark, f"{target}/_rejects/{titles[i]}")  # of an earlier load
        if rejected:
            why = rows.where(bad).withColumn(REASON, faults(rows, schema))
            _put_entries(spark, why, {i: f"{target}/_rejects/{titles[i]}" for i in rejected})
    folders.remove(spark, stage)
    return results


def _put_entries(spark: SparkSession, rows: DataFrame, places: dict[int, str]) -> None:
    """Write the rows of all entries at once, then put each entry's folder in its place."""
    stage = scratch_path(spark, "landing_typed")
    if not places:
        return
    if len(places) == 1:
        only = next(iter(places))
        rows.where(F.col(ENTRY) == only).drop(ENTRY).write.parquet(f"{stage}/{ENTRY}={only}")
    else:
        rows.write.partitionBy(ENTRY).parquet(stage)
    there = set(folders.names(spark, stage))
    for i, place in places.items():
        if f"{ENTRY}={i}" in there:
            folders.take_place(spark, f"{stage}/{ENTRY}={i}", place)
    folders.remove(spark, stage)


def load_stats(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """K10 counts: total, inserted, failed, success_rate (%)."""
    good = accepted.agg(F.count(F.lit(1)).alias("inserted_rows"))
    bad = rejected.agg(F.count(F.lit(1)).alias("failed_rows")).select("failed_rows").scalar()
    agg = good.select("inserted_rows", bad.alias("failed_rows"))
    total = F.col("inserted_rows") + F.col("failed_rows")
    return agg.select(
        total.alias("total_rows"), "inserted_rows", "failed_rows",
        F.when(total > 0, F.col("inserted_rows") / total * 100).otherwise(F.lit(0.0)).alias("success_rate"))


def load_report(results: DataFrame) -> DataFrame:
    """Totals over per-file results (file, table, total_rows,
    inserted_rows, status, ...) in one aggregate."""
    return results.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows_processed"),
        F.coalesce(F.sum("inserted_rows"), F.lit(0)).alias("total_rows_inserted"))


def write_report(report: DataFrame, details: DataFrame, path: str) -> str:
    """Report + details as JSON under ``path`` (timestamped folder)."""
    stamp = _dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    out = f"{path.rstrip('/')}/report_{stamp}"
    report.withColumn("timestamp", F.current_timestamp()).write.mode("errorifexists").json(f"{out}/summary")
    details.write.mode("errorifexists").json(f"{out}/details")
    return out
