"""File and SQL sources (S1-S17) and name/type helpers.

Readers are plain ``spark.read`` calls; listing uses the ``binaryFile``
source without reading contents, so it works on any Hadoop-compatible
store.  Per-file loops run on the driver only over file *names*.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.semantics import NULL_TOKENS, strip_ws

# --------------------------------------------------------------- T1 / T2

# What a name may not hold, and how it may not begin.
NOT_IN_NAME, NOT_FIRST = "[^a-zA-Z0-9_]", "^[0-9]"


def sanitize_name(name: str) -> str:
    """File stem -> lower-case identifier (non [A-Za-z0-9_] -> '_',
    a leading digit -> '_')."""
    stem = name.rsplit("/", 1)[-1]
    stem = stem.rsplit(".", 1)[0] if "." in stem else stem
    s = re.sub(NOT_IN_NAME, "_", stem)
    s = re.sub(NOT_FIRST, "_", s)
    return s.lower()


def sanitize_name_col(c) -> F.Column:
    """T1 as a column expression (for catalogs of names held in a table)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.regexp_replace(F.regexp_replace(c, NOT_IN_NAME, "_"), NOT_FIRST, "_"))


def sanitize_columns(df: DataFrame, lower: bool = False) -> DataFrame:
    """Rename columns to identifiers; raise on collisions."""
    new = []
    for c in df.columns:
        s = re.sub(NOT_IN_NAME, "_", str(c))
        if lower:
            s = re.sub(NOT_FIRST, "_", s).lower()
        new.append(s)
    if len(set(new)) != len(new):
        raise ValueError(f"column names collide after sanitising: {new}")
    return df.toDF(*new)


# --------------------------------------------------------------- T3

# The longest VARCHAR of an empty column and the longest of any; the SQL
# names of types are those below.
SHORT_TEXT, LONG_TEXT = 255, 65535


def sql_type(dt: T.DataType, max_len: int | None = None) -> str:
    """Target SQL type for a Spark type (string width from the data)."""
    if isinstance(dt, (T.ByteType, T.ShortType)):
        return "SMALLINT"
    if isinstance(dt, T.IntegerType):
        return "INT"
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return "DOUBLE"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "DATETIME"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if max_len and max_len <= SHORT_TEXT:
        return f"VARCHAR({max_len})"
    if max_len and max_len <= LONG_TEXT:
        return "TEXT"
    return "LONGTEXT"


def infer_types(df: DataFrame) -> DataFrame:
    """(column, spark_type, max_length, sql_type) in one aggregate.

    Text width is ``min(2 * max length, 65535)`` (255 when the column is
    empty), as the loader sizes VARCHARs.
    """
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    lens = {}
    if strings:
        row = df.agg(*[F.max(F.length(F.col(f"`{c}`"))).alias(f"l{i}")
                       for i, c in enumerate(strings)]).first()
        lens = {c: row[f"l{i}"] for i, c in enumerate(strings)}
    rows = []
    for f in df.schema.fields:
        if f.name in lens:
            m = lens[f.name]
            width = min(m * 2, LONG_TEXT) if m else SHORT_TEXT
            rows.append((f.name, f.dataType.simpleString(), m, sql_type(f.dataType, width)))
        else:
            rows.append((f.name, f.dataType.simpleString(), None, sql_type(f.dataType)))
    return df.sparkSession.createDataFrame(
        rows, "column STRING, spark_type STRING, max_length INT, sql_type STRING")


# --------------------------------------------------------------- S1 / S6

def normalise_null_tokens(df: DataFrame, tokens=NULL_TOKENS) -> DataFrame:
    """Text cells equal to a missing-value token (after stripping) -> NULL."""
    cols = {f.name: F.when(strip_ws(F.col(f"`{f.name}`")).isin(list(tokens)), F.lit(None))
                     .otherwise(F.col(f"`{f.name}`"))
            for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(cols) if cols else df


#: Kinds of values, in the order in which a column's type is chosen from them.
KINDS = ("int", "bigint", "double", "date", "timestamp", "boolean")
#: Bit of a column in which text stands for a missing value, as an empty cell does not.
MARKED = 1 << len(KINDS)


#: What every text holds that casts to a double (a superset of those): a sign, a digit, point,
#: "inf" or "nan", and the letters of exponents, hex digits and "infinity" after it.
LIKE_NUMBER = r"^[\x00-\x20]*[+-]?([0-9.]|[iI][nN][fF]|[nN][aA][nN])[0-9a-fA-FxXpPiInNtTyY+.-]*[\x00-\x20]*$"


def kind_bits(df: DataFrame, columns: list[str], tokens=NULL_TOKENS, keys: Sequence[str] = ()) -> DataFrame:
    """``keys..., i, m, t`` of raw text cells: ``m``, the bits of the kinds that every value of
    column i has, and ``t``, ``MARKED`` if some cell is a missing-value token.

    Each cell becomes a row first, so that one small expression, compiled once, reads all
    columns; one for each column makes a method too long for the JVM to compile.  Text that
    cannot be a number is never cast to one: a cast that fails costs an exception."""
    from ..functions.semantics import to_number
    bit = {k: 1 << i for i, k in enumerate(KINDS)}
    whole = bit["bigint"] | bit["double"]
    cells = (df.select(*keys, F.posexplode(F.array(*[F.col(f"`{c}`") for c in columns])).alias("i", "raw"))
             .withColumn("_bare", strip_ws("raw")))
    token = F.col("_bare").isin(list(tokens))
    cells = cells.select(*keys, "i", F.when(~token, F.col("raw")).alias("x"),
                         (token & (F.col("_bare") != "")).alias("marked"))
    x = F.col("x")
    mask = (F.when(x.rlike(r"^[+-]?\d+$"), F.when(x.try_cast("int").isNotNull(), bit["int"] | whole)
                   .when(x.try_cast("bigint").isNotNull(), whole).otherwise(bit["double"]))
            .when(x.rlike(r"^[+-]?\d*\.?\d+$"), bit["double"])
            .when(x.rlike(r"^\d{4}-\d{2}-\d{2}$") & x.try_cast("date").isNotNull(), bit["date"])
            .when(x.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}") & x.try_cast("timestamp").isNotNull(), bit["timestamp"])
            .when(F.lower(x).isin("true", "false"), bit["boolean"])
            .when(strip_ws(x).rlike(LIKE_NUMBER) & to_number(x).isNotNull(), bit["double"]).otherwise(0))
    return cells.groupBy(*keys, "i").agg(F.bit_and(F.when(x.isNotNull(), mask)).alias("m"),
                                         F.max(F.when(F.col("marked"), MARKED).otherwise(0)).alias("t"))


def chosen_types(columns: list[str], rows) -> dict[str, str]:
    """The type of each column by the rows of ``kind_bits``: the first of int, bigint, double,
    date, timestamp and boolean that every value has, else string.  A column of whole numbers
    in which some text stood for a missing value becomes double, as pandas types it."""
    found = {r["i"]: r for r in rows}
    types = {}
    for i, c in enumerate(columns):
        bits, marked = (found[i]["m"] or 0, found[i]["t"]) if i in found else (0, 0)
        kind = next((k for j, k in enumerate(KINDS) if bits & (1 << j)), "string")
        types[c] = "double" if kind in ("int", "bigint") and marked else kind
    return types


def text_types(df: DataFrame, tokens=NULL_TOKENS) -> dict[str, str]:
    """The type of each text column by all its cells, in one aggregate."""
    return chosen_types(df.columns, kind_bits(df, df.columns, tokens).collect())  # one row a column


def typed_cells(columns: list[str], types: dict[str, str], tokens=NULL_TOKENS) -> list[F.Column]:
    """Text cells as values of the chosen types; missing-value tokens are NULL."""
    from ..functions.semantics import to_number
    out = []
    for c in columns:
        x = F.when(~strip_ws(F.col(f"`{c}`")).isin(list(tokens)), F.col(f"`{c}`"))
        out.append((to_number(x) if types[c] == "double" else x.cast(types[c])).alias(c))
    return out


def load_csv(spark: SparkSession, path: str, encoding: str = "UTF-8",
             infer_schema: bool = True, schema: T.StructType | str | None = None,
             null_tokens=NULL_TOKENS, multi_line: bool = False) -> DataFrame:
    """Header CSV with inferred (or given) schema and encoding.

    Surrounding whitespace in text is kept (pandas keeps it too); missing
    tokens become NULL.  Types are inferred from all values in one pass; for very
    large inputs pass ``schema`` to skip it.

    A line that does not fit the header is refused with an error;
    ``csv_with_bad_lines`` sets such lines apart instead.  ``multi_line`` reads
    quoted line ends; such files are not split among tasks.
    """
    r = csv_reader(spark.read.option("encoding", encoding).option("multiLine", multi_line)
                   .option("columnPruning", False))
    if schema is not None:
        return normalise_null_tokens(r.option("mode", "FAILFAST").schema(schema).csv(path), null_tokens)
    names = r.csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    raw = r.option("mode", "FAILFAST").schema(text).csv(path)
    if not infer_schema or not names:
        return normalise_null_tokens(raw, null_tokens)
    return raw.select(*typed_cells(names, text_types(raw, null_tokens), null_tokens))


#: Holds a line that its reader could not parse.
BAD_LINE = "_corrupt_record"


def csv_with_bad_lines(spark: SparkSession, path: str, schema: T.StructType,
                       encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """All lines of a CSV as text columns of ``schema``'s names, with ``_corrupt_record``
    on those whose number of cells is wrong; no line is lost."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                        + [T.StructField(BAD_LINE, T.StringType())])
    return csv_reader(spark.read.option("encoding", encoding).option("multiLine", multi_line)).option(
        "mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE).schema(text).csv(path)


def csv_reader(reader):
    """Options of every CSV read: a header, kept blanks, quotes doubled inside quotes."""
    return (reader.option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def csv_writer(writer):
    """The same for every CSV write."""
    return (writer.option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_csv(df: DataFrame, path: str, rows_per_file: int = 0) -> str:
    """``rows_per_file`` bounds the files, for readers that do not split one (``multi_line``)."""
    csv_writer(df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)).csv(path)
    return path


# --------------------------------------------------------------- S2 / S7

def list_files(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """Distributed listing: (path, modificationTime, length); contents unread."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .load(directory).select("path", "modificationTime", "length")
            .where(~F.regexp_extract("path", r"[^/]+$", 0).rlike(r"^[._]")))


def dataset_entries(spark: SparkSession, directory: str, pattern: str = "*") -> list[str]:
    """Top-level entries (files or dataset folders) below ``directory`` whose
    name matches the glob ``pattern``.  Only names reach the driver."""
    base = directory.rstrip("/")
    files = list_files(spark, directory)
    rel = F.regexp_replace("path", r"^.*?" + re.escape(base.split("://")[-1]) + "/", "")
    entries = [r[0] for r in files.select(F.split(rel, "/")[0].alias("e")).distinct().collect()]
    return sorted(e for e in entries if fnmatch.fnmatch(e, pattern))


RESULT_DDL = ("file STRING, table STRING, total_rows LONG, inserted_rows LONG, failed_rows LONG, "
              "status STRING, error STRING")


def refuse_equal_names(entries: list[str]) -> None:
    """T2 for tables: two entries that would become one table are an error."""
    by_name: dict[str, list[str]] = {}
    for e in entries:
        by_name.setdefault(sanitize_name(e), []).append(e)
    same = {n: es for n, es in by_name.items() if len(es) > 1}
    if same:
        raise ValueError(f"table names collide after sanitising: {same}")


def load_directory(spark: SparkSession, directory: str, pattern: str = "*.csv", target: str | None = None,
                   schemas: dict[str, T.StructType] | None = None,
                   multi_line: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """S2 + S3 + K10: each matching entry is written as a table below ``target``; gives
    the written tables and a per-entry result frame with counts of what was written.

    With a schema in ``schemas`` (by table name) rows that do not fit it, and lines
    that do not fit the header, go to ``<target>/_rejects/<table>`` with the reason;
    without one types are inferred from all values and nothing can be rejected but a bad
    line, which fails the entry.  An entry that fails does not stop the others.  Entries
    with equal headers are loaded by the same few jobs, however many they are.
    """
    from ..session import scratch_path
    from ..sinks.loading import load_entries
    target = target or scratch_path(spark, "loaded")
    entries = dataset_entries(spark, directory, pattern)
    refuse_equal_names(entries)
    rows = load_entries(spark, directory.rstrip("/"), {e: sanitize_name(e) for e in entries}, target, schemas or {}, multi_line)
    tables = {r[1]: spark.read.parquet(f"{target}/{r[1]}") for r in rows if r[3]}
    return tables, spark.createDataFrame(rows, RESULT_DDL)


def glob_pattern(pattern: str) -> str:
    """An anchored regular expression for a file-name glob (``*``, ``?``, ``[...]``)."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        close = pattern.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out += "[^/]*"
        elif c == "?":
            out += "[^/]"
        elif close > 0:
            body = pattern[i + 1:close].replace("\\", "\\\\")
            out += "[" + ("^" + body[1:] if body[0] == "!" else body) + "]"
            i = close
        else:
            out += re.escape(c)
        i += 1
    return f"^{out}$"


def latest_entry(spark: SparkSession, directory: str, pattern: str = "*"):
    """``name`` and ``time`` (microseconds) of the entry directly below ``directory`` whose
    name matches the glob and that was written last (ties: the greatest name), chosen by
    one aggregate over the listing; None without any.  A folder of part files is one
    entry, as new as its newest file."""
    base = directory.rstrip("/")
    below = F.regexp_replace("path", r"^.*?" + re.escape(base.split("://")[-1]) + "/", "")
    files = list_files(spark, directory).withColumn("entry", F.split(below, "/")[0])
    rows = (files.where(F.col("entry").rlike(glob_pattern(pattern)))
            .agg(F.max(F.struct(F.unix_micros("modificationTime").alias("time"), F.col("entry").alias("name"))).alias("e")))
    return rows.first().e


def latest_file(spark: SparkSession, directory: str, pattern: str = "*") -> str | None:
    """The path of ``latest_entry``."""
    found = latest_entry(spark, directory, pattern)
    return f"{directory.rstrip('/')}/{found.name}" if found is not None else None


def read_entry(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return load_csv(spark, path)
    return spark.read.format(fmt).load(path)


def read_latest(spark: SparkSession, directory: str, pattern: str = "*", fmt: str = "parquet") -> DataFrame:
    path = latest_file(spark, directory, pattern)
    if path is None:
        raise FileNotFoundError(f"no file matching {pattern!r} in {directory}")
    return read_entry(spark, path, fmt)


# --------------------------------------------------------------- S4 / S8

TS_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

def scan_json(spark: SparkSession, path: str, multi_line: bool = False,
              schema: T.StructType | str | None = None, bad_lines: str = "raise") -> DataFrame:
    """JSON lines (or whole-document with ``multi_line``).  A line that is not a
    JSON object (or array of them) is an error; with ``bad_lines="keep"`` it is
    kept in ``_corrupt_record``."""
    if bad_lines not in ("raise", "keep"):
        raise ValueError("bad_lines must be raise or keep")
    r = (spark.read.option("multiLine", multi_line).option("timestampNTZFormat", TS_MICROS)
         .option("columnNameOfCorruptRecord", BAD_LINE))
    if schema is not None:
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    elif bad_lines == "raise":
        schema = r.option("mode", "FAILFAST").json(path).schema
    else:
        schema = r.option("mode", "PERMISSIVE").json(path).schema
    if bad_lines == "raise":
        return r.option("mode", "FAILFAST").schema(schema).json(path)
    if BAD_LINE not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    return r.option("mode", "PERMISSIVE").schema(schema).json(path)


def unwrap_envelope(raw: DataFrame, bad_lines: str = "raise") -> DataFrame:
    """Payload records in any of the envelope forms -> rows, in one pass.

    Top-level JSON arrays are already split into records by the reader.  A
    record with a ``data`` array yields its elements, else one with a
    ``results`` array yields those, else the record itself is the row.  An
    unreadable record raises an error, or with ``bad_lines="keep"`` becomes a row that
    holds it in ``_corrupt_record``.
    """
    lists = [c for c in ("data", "results") if c in raw.columns]
    plain = [c for c in raw.columns if c not in (*lists, BAD_LINE)]
    kinds: dict[str, T.DataType] = {f.name: f.dataType for f in raw.schema.fields if f.name in plain}
    for c in lists:
        for f in raw.schema[c].dataType.elementType.fields:
            kinds.setdefault(f.name, f.dataType)

    def row(source, fields: list[str]) -> F.Column:
        return F.struct(*[(source(n) if n in fields else F.lit(None)).cast(t).alias(n) for n, t in kinds.items()])

    def element(c: str):
        names = raw.schema[c].dataType.elementType.names
        return lambda x: row(lambda n: x[n], names)

    rows = F.array(row(lambda n: F.col(f"`{n}`"), plain))
    for c in reversed(lists):
        rows = F.when(F.col(c).isNotNull(), F.transform(c, element(c))).otherwise(rows)
    if BAD_LINE not in raw.columns:
        return raw.select(F.inline(rows))
    if bad_lines == "raise":
        ok = F.when(F.col(BAD_LINE).isNotNull(), F.raise_error(F.concat(F.lit("unexpected payload: "), F.col(BAD_LINE))).cast("boolean"))
        return raw.where(F.coalesce(ok, F.lit(True))).select(F.inline(rows))
    return raw.select(F.inline(rows), F.col(BAD_LINE))


# --------------------------------------------------------------- S9 / S10 / S14

def jdbc_query(spark: SparkSession, url: str, query: str, props: dict | None = None,
               partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A database query as a DataFrame (partitioned reads when a numeric
    column and its bounds are given)."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    if partition:
        col, lo, hi, n = partition
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", col)
             .option("lowerBound", lo).option("upperBound", hi).option("numPartitions", n))
    else:
        r = r.option("query", query)
    return r.load()


def query_to_df(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """SQL text with optional ``:name`` parameters."""
    return spark.sql(query, args=params) if params else spark.sql(query)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) for every table, as one union of counts."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def table_samples(tables: dict[str, DataFrame], n: int = 5) -> dict[str, DataFrame]:
    """The first ``n`` rows of each table (a preview; the limit is the point)."""
    return {name: df.limit(n) for name, df in tables.items()}


# --------------------------------------------------------------- S13 / S15 / S16

def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Catalog listing as a DataFrame."""
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")


def table_definition(df: DataFrame) -> str:
    """The frame's columns as DDL text, as ``CREATE TABLE`` takes them."""
    return df.sparkSession._jvm.org.apache.spark.sql.types.StructType.fromJson(df.schema.json()).toDDL()


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    """S16."""
    return df.dtypes
