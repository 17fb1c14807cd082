"""Job entry points: the multi-source sync pipeline
and the summary job with its output switch and dry run (K5, K6).

A source is a plain spec; readers are looked up by type in a registry a
user can extend.  Each enabled source is read and synced on its own, and
a failure is recorded in the history instead of stopping the others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import summary as S
from ..session import stored
from ..sinks import folders
from ..sinks.tables import export_csv, write_table
from ..sources import files as FS
from ..streaming import snapshots as SN
from ..streaming import streams as ST
from ..streaming import sync as SY
from .tables import stored_star


@dataclass
class SourceSpec:
    name: str
    type: str                      # key in READERS
    path: str                      # file/folder, or JDBC url
    target: str                    # target table path
    sync_mode: str = "full"        # full | incremental | upsert (streams of files: watermark too)
    timestamp_col: str | None = None
    primary_key: list[str] = field(default_factory=list)
    order_by: list[str] = field(default_factory=list)
    options: dict = field(default_factory=dict)
    enabled: bool = True
    schedule_seconds: int = 300
    buckets: int | None = None     # of an upsert target
    attempts: int = 3              # reads and writes of the source, with growing waits
    retry_seconds: float = 2.0


Reader = Callable[[SparkSession, SourceSpec], DataFrame]


def _csv(spark, spec):
    return FS.load_csv(spark, spec.path, **spec.options)


def _json(spark, spec):
    return FS.scan_json(spark, spec.path, **spec.options)


def _envelope(spark, spec):
    return FS.unwrap_envelope(FS.scan_json(spark, spec.path, **spec.options))


def _parquet(spark, spec):
    return spark.read.parquet(spec.path)


def _latest(spark, spec):
    return FS.read_latest(spark, spec.path, spec.options.get("pattern", "*"),
                          spec.options.get("format", "parquet"))


def _jdbc(spark, spec):
    opts = dict(spec.options)
    query = opts.pop("query")
    return FS.jdbc_query(spark, spec.path, query, opts)


READERS: dict[str, Reader] = {
    "csv": _csv, "json": _json, "api_payload": _envelope, "parquet": _parquet,
    "latest_file": _latest, "database": _jdbc,
}


def register_reader(kind: str, reader: Reader) -> None:
    READERS[kind] = reader


def extract(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.type not in READERS:
        raise ValueError(f"no reader registered for source type {spec.type!r}")
    return READERS[spec.type](spark, spec)


def retry(max_attempts: int = 3, delay: float = 2.0, backoff: float = 2.0,
          exceptions: tuple = (Exception,)):
    """R7 for driver-side actions (external reads and writes, catalog calls); task
    failures inside a job are already retried by Spark."""
    import functools
    import time

    def deco(fn):
        @functools.wraps(fn)
        def run(*a, **kw):
            wait = delay
            for attempt in range(1, max_attempts + 1):
                try:
                    return fn(*a, **kw)
                except exceptions:
                    if attempt == max_attempts:
                        raise
                    time.sleep(wait)
                    wait *= backoff
        return run
    return deco


def run_pipeline(spark: SparkSession, specs: list[SourceSpec], history: str) -> list[dict]:
    """R1 (one pass) + R2 + R5 + R6 + R7: sync every enabled source once; what fails
    is tried again and then recorded, without stopping the others."""
    import datetime as _dt
    out = []
    for spec in specs:
        if not spec.enabled:
            continue
        again = retry(spec.attempts, spec.retry_seconds)
        start = _dt.datetime.now()
        try:
            df = again(extract)(spark, spec)
            out.append(again(_sync_once)(spark, spec, df))
        except Exception as exc:
            out.append({"source_name": spec.name, "table_name": spec.target.rsplit("/", 1)[-1],
                        "rows_processed": 0, "rows_loaded": 0, "status": "failed", "error_message": str(exc),
                        "sync_start": start, "sync_end": _dt.datetime.now()})
        SY.append_history(spark, history, out[-1:])
    return out


def _sync_once(spark: SparkSession, spec: SourceSpec, df: DataFrame) -> dict:
    rec = SY.run_sync(spark, spec.name, df, spec.target, spec.sync_mode, None,
                      spec.timestamp_col, spec.primary_key, spec.order_by, spec.buckets)
    if rec["status"] == "failed":
        raise RuntimeError(rec["error_message"])
    return rec


#: Types whose files are streamed as they arrive, and types that are polled.
STREAMED = ("parquet", "json", "csv", "api_payload")
POLLED = ("latest_file", "database")


def _newest_matching(spark: SparkSession, spec: SourceSpec):
    """A poll of a ``latest_file`` source: its newest entry, unless the target holds it."""
    def look(poll: int):
        found = FS.latest_entry(spark, spec.path, spec.options.get("pattern", "*"))
        if found is None or (found.time, found.name) <= SN.taken(spark, spec.target):
            return None
        return FS.read_entry(spark, f"{spec.path.rstrip('/')}/{found.name}", spec.options.get("format", "parquet")), found.time, found.name
    return look


def _queried(spark: SparkSession, spec: SourceSpec):
    """A poll of a ``database`` source; an incremental one asks for rows newer than the
    mark only, as a literal that the database itself can apply."""
    def look(poll: int):
        rows = extract(spark, spec)
        if spec.sync_mode == "incremental":
            mark = SY.high_water_mark(spark, spec.target, ST.BATCH_ID, before=poll)
            latest = None if mark is None else spark.range(1).select(mark.alias("m")).first().m
            if latest is not None:
                rows = rows.where(F.col(spec.timestamp_col) > F.lit(latest))
        return rows, poll, "poll"
    return look


def _checked_stream(spark: SparkSession, spec: SourceSpec, schemas: dict) -> None:
    name = f"source {spec.name!r}"
    if spec.type not in (*STREAMED, *POLLED):
        raise ValueError(f"{name}: type {spec.type!r} cannot be streamed (only {', '.join((*STREAMED, *POLLED))})")
    if spec.sync_mode not in (*SY.SYNC_MODES, "watermark") or (spec.sync_mode == "watermark" and spec.type in POLLED):
        raise ValueError(f"{name}: sync mode {spec.sync_mode!r} is unknown or not for this type")
    if spec.type == "database":
        if "query" not in spec.options:
            raise ValueError(f"{name}: a database source needs a query")
    elif not folders.exists(spark, spec.path):
        raise ValueError(f"{name}: there is no folder {spec.path}")
    if spec.type in STREAMED and spec.name not in schemas:
        raise ValueError(f"{name}: files are streamed with a given schema")


def start_streams(spark: SparkSession, specs: list[SourceSpec], schemas: dict,
                  checkpoint_root: str, once: bool = False) -> list:
    """R1 continuous form: one stream per enabled source, each with its own checkpoint and
    trigger interval.  Files are streamed with ``schemas[name]`` (of ``api_payload``: the
    schema of the payload records, which are unwrapped batch by batch); newest-file and
    database sources are polled at each trigger.  What cannot be streamed is an error,
    raised before any stream is started."""
    on = [s for s in specs if s.enabled]
    for spec in on:
        _checked_stream(spark, spec, schemas)
    started = []
    for spec in on:
        again = retry(spec.attempts, spec.retry_seconds)
        checkpoint = f"{checkpoint_root.rstrip('/')}/{spec.name}"
        same = dict(ts_col=spec.timestamp_col, key=spec.primary_key, order=spec.order_by, once=once,
                    interval=f"{spec.schedule_seconds} seconds", buckets=spec.buckets)
        if spec.type in POLLED:
            look = _newest_matching(spark, spec) if spec.type == "latest_file" else _queried(spark, spec)
            started.append(again(ST.run_polls)(spark, look, spec.target, checkpoint, spec.sync_mode, **same))
            continue
        payload = spec.type == "api_payload"
        started.append(again(ST.run_stream)(
            spark, spec.path, schemas[spec.name], spec.target, checkpoint, mode=spec.sync_mode,
            fmt="json" if payload else spec.type, change=FS.unwrap_envelope if payload else None,
            delay=spec.options.get("delay", "10 minutes"), **same))
    return started


def vendor_summary_job(spark: SparkSession, sf_dir: str, output: str = "db",
                       table_path: str | None = None, csv_dir: str | None = None,
                       dry_run: bool = False) -> DataFrame:
    """K6: build the summary; write to the table, CSV or both; a dry run
    writes nothing and returns the frame (``.show(10)`` to preview)."""
    if output not in ("db", "csv", "both"):
        raise ValueError("output must be db, csv or both")
    df = S.vendor_summary(stored_star(spark, sf_dir))
    if dry_run:
        return df
    if output == "both":
        df = stored(df, "summary_job")  # built once for both outputs
    if output in ("db", "both"):
        write_table(df, table_path, "replace")
    if output in ("csv", "both"):
        export_csv(df, csv_dir)
    return df


def run_batch(spark: SparkSession, sf_dir: str, out_root: str) -> dict[str, str]:
    """The reference's batch stages in order, each stage writing a table the
    next one reads: summary -> quality report -> feature table; EDA summary
    -> imputed notebook table -> outlier-filtered analysis outputs.
    Returns stage name -> path."""
    from ..operators import explore as EX
    from ..operators import features as FE
    from ..operators import impute as IM
    from ..operators import quality as DQ

    root = out_root.rstrip("/")
    paths = {}

    def save(name: str, df: DataFrame) -> DataFrame:
        paths[name] = write_table(df, f"{root}/{name}", "replace")
        return spark.read.parquet(paths[name])

    star = stored_star(spark, sf_dir)
    summary = save("vendor_sales_summary", S.vendor_summary(star, ordered=False))
    save("data_quality_report", DQ.DataQualityValidator().check_frame(summary))
    save("ml_feature_store", FE.build_features(summary))
    eda = save("eda_summary", S.eda_summary(star, ordered=False))
    table = save("vendor_sales_summary_typed", IM.typed(IM.eda_clean(eda)))
    clean = EX.log_prices(EX.iqr_filter(table, materialize_input=False))
    clean = save("analysis_clean", EX.profit_tiers(EX.volume_categories(clean)))
    save("analysis_describe", EX.describe(table))
    save("analysis_margin_tiers", EX.margin_tiers(clean))
    save("analysis_correlation", EX.corr_matrix(clean))
    save("analysis_normality", EX.normality(clean))
    return paths
