"""Whole snapshots, polled sources, the watermark mode, growing tables and their upkeep."""

import pytest
from pyspark.sql import functions as F

from supplylake.plans.jobs import SourceSpec, start_streams
from supplylake.session import scratch_path
from supplylake.sinks import folders, schemas
from supplylake.streaming import snapshots as SN
from supplylake.streaming import streams as ST
from supplylake.streaming import sync as SY

from .test_sync import ROWS, frame


def numbers(spark, n, shift=0):
    return spark.range(shift, shift + n).select("id", (F.col("id") * 2).alias("twice"))


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


# ---------------------------------------------------------------- snapshots

def full(spark, src, target, ckpt, **kw):
    ST.run_stream(spark, src, numbers(spark, 1).schema, target, ckpt, mode="full", **kw)


def test_a_snapshot_of_many_files_is_whole_at_any_trigger_size(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("w_src", "w_tgt", "w_ck"))
    numbers(spark, 100).repartition(4).write.parquet(src)
    full(spark, src, target, ckpt, max_files=1)
    assert ids(spark.read.parquet(target)) == list(range(100))
    full(spark, src, target, ckpt, max_files=1)  # nothing new
    numbers(spark, 30, 5).repartition(3).write.mode("append").parquet(src)
    full(spark, src, target, ckpt, max_files=1)
    assert ids(spark.read.parquet(target)) == list(range(5, 35))


def test_a_snapshot_without_its_marker_never_replaces(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("m_src", "m_tgt", "m_ck"))
    numbers(spark, 10).write.parquet(src)
    full(spark, src, target, ckpt)
    numbers(spark, 50).repartition(4).write.mode("append").parquet(src)
    folders.remove(spark, f"{src}/_SUCCESS")  # as while the part files land
    full(spark, src, target, ckpt)
    assert ids(spark.read.parquet(target)) == list(range(10))
    folders.write_text(spark, f"{src}/_SUCCESS", "")
    folders.write_text(spark, f"{src}/_temporary/x", "")
    full(spark, src, target, ckpt)  # another write is under way
    assert ids(spark.read.parquet(target)) == list(range(10))
    folders.remove(spark, f"{src}/_temporary")
    full(spark, src, target, ckpt)  # no new file, but now it is whole
    assert ids(spark.read.parquet(target)) == list(range(50))


def test_manifests_say_which_files_make_a_snapshot(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("l_src", "l_tgt", "l_ck"))
    for k in range(4):
        numbers(spark, 5, 5 * k).coalesce(1).write.parquet(f"{src}/.stage{k}")
        part = next(n for n in folders.names(spark, f"{src}/.stage{k}") if n.startswith("part"))
        folders.rename(spark, f"{src}/.stage{k}/{part}", f"{src}/file{k}.parquet")
        if k == 0:
            SN.write_manifest(spark, src, "one", ["file0.parquet"])
            full(spark, src, target, ckpt)
    assert ids(spark.read.parquet(target)) == list(range(5))  # the other files are in no manifest
    SN.write_manifest(spark, src, "two", ["file1.parquet", "file2.parquet", "file9.parquet"])
    full(spark, src, target, ckpt)
    assert ids(spark.read.parquet(target)) == list(range(5))  # one listed file is missing
    SN.write_manifest(spark, src, "three", ["file3.parquet", "file1.parquet"])
    full(spark, src, target, ckpt)
    assert ids(spark.read.parquet(target)) == [*range(5, 10), *range(15, 20)]


def test_folders_and_single_files_are_drops_and_empty_ones_replace_nothing(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("d_src", "d_tgt", "d_ck"))
    numbers(spark, 7).repartition(2).write.parquet(f"{src}/monday")
    numbers(spark, 8).repartition(2).write.parquet(f"{src}/tuesday")
    folders.remove(spark, f"{src}/tuesday/_SUCCESS")
    full(spark, src, target, ckpt)
    assert len(ids(spark.read.parquet(target))) == 7
    numbers(spark, 9).limit(0).write.parquet(f"{src}/wednesday")
    full(spark, src, target, ckpt)
    assert len(ids(spark.read.parquet(target))) == 7
    assert SN.taken(spark, target)[1] == "folder:wednesday"
    assert SN.newest_drop(spark, scratch_path(spark, "nowhere")) is None


def test_a_crash_after_replacing_takes_the_snapshot_again(spark, monkeypatch):
    src, target, ckpt = (scratch_path(spark, n) for n in ("c_src", "c_tgt", "c_ck"))
    numbers(spark, 12).write.parquet(src)
    with monkeypatch.context() as m:
        m.setattr(SN, "take", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            full(spark, src, target, ckpt)
    full(spark, src, target, ckpt)
    assert ids(spark.read.parquet(target)) == list(range(12)) and SN.taken(spark, target)[0] > 0


# ---------------------------------------------------------------- polled and payload sources

def test_newest_file_source_is_polled(spark):
    src, target, ck = (scratch_path(spark, n) for n in ("n_src", "n_tgt", "n_ck"))
    df = frame(spark, ROWS)
    df.where("event_id <= 2").write.parquet(f"{src}/drop_a.parquet")
    spec = SourceSpec("newest", "latest_file", src, target, "incremental", timestamp_col="ts", options={"pattern": "drop_*"})
    start_streams(spark, [spec], {}, ck, once=True)
    start_streams(spark, [spec], {}, ck, once=True)  # restart: nothing new, nothing written
    assert len(SY.batches(spark, target, ST.BATCH_ID)) == 1
    df.write.parquet(f"{src}/other.parquet")
    df.write.parquet(f"{src}/drop_b.parquet")
    start_streams(spark, [spec], {}, ck, once=True)
    assert sorted(r.event_id for r in ST.read_target(spark, target, df.columns).collect()) == [1, 2, 3, 4]


def test_payloads_are_streamed_and_unwrapped(spark):
    src, target, ck = (scratch_path(spark, n) for n in ("p_src", "p_tgt", "p_ck"))

    def page(*values):
        spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").text(src)
    schema = spark.createDataFrame([], "data array<struct<id:long,x:string>>, id long, x string").schema
    page('{"data": [{"id": 1, "x": "a"}, {"id": 2, "x": "b"}]}')
    spec = SourceSpec("api", "api_payload", src, target, "upsert", primary_key=["id"], order_by=["x"])
    start_streams(spark, [spec], {"api": schema}, ck, once=True)
    page('{"id": 2, "x": "c"}', '{"data": [{"id": 3, "x": "d"}]}')
    start_streams(spark, [spec], {"api": schema}, ck, once=True)
    assert sorted(map(tuple, spark.read.parquet(target).select("id", "x").collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_database_source_is_polled_with_its_mark(spark, monkeypatch):
    """The reader stands in for a database; that the mark reaches one is not tried here."""
    from supplylake.plans import jobs
    df = frame(spark, ROWS)
    held = {"rows": df.where("event_id <= 2")}
    monkeypatch.setitem(jobs.READERS, "database", lambda s, spec: held["rows"])
    target, ck = scratch_path(spark, "b_tgt"), scratch_path(spark, "b_ck")
    spec = SourceSpec("db", "database", "jdbc:x", target, "incremental", timestamp_col="ts", options={"query": "select 1"})
    start_streams(spark, [spec], {}, ck, once=True)
    held["rows"] = df
    start_streams(spark, [spec], {}, ck, once=True)
    assert sorted(r.event_id for r in ST.read_target(spark, target, df.columns).collect()) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        start_streams(spark, [SourceSpec("db", "database", "jdbc:x", target)], {}, ck)


# ---------------------------------------------------------------- late rows within a delay

def test_watermark_mode_loads_late_rows_within_the_delay_once(spark):
    src, target, ck = (scratch_path(spark, n) for n in ("r_src", "r_tgt", "r_ck"))

    def send(*rows):
        frame(spark, [(i, t, i, "x", 1.0, "{}") for i, t in rows]).coalesce(1).write.mode("append").parquet(src)
        ST.run_stream(spark, src, frame(spark, []).schema, target, ck, mode="watermark", ts_col="ts", key=["event_id"],
                      delay="10 minutes")
    send((1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:30:00"), (2, "2024-01-01 10:30:00"))
    send((3, "2024-01-01 10:25:00"), (4, "2024-01-01 10:15:00"), (2, "2024-01-01 10:30:00"), (5, "2024-01-01 11:00:00"), (6, None))
    send((7, "2024-01-01 10:55:00"), (3, "2024-01-01 10:25:00"), (5, "2024-01-01 11:00:00"))
    loaded = sorted(r.event_id for r in ST.read_target(spark, target, ["event_id"]).collect())
    assert loaded == [1, 2, 3, 5, 7]
    aside = sorted((r.event_id, r.reason) for r in ST.set_aside(spark, target).collect())
    assert aside == [(2, "sent before"), (2, "sent before"), (3, "late"), (4, "late"), (5, "sent before"), (6, "no time")]


# ---------------------------------------------------------------- growing tables

def test_new_columns_and_wider_types_are_kept(spark):
    base = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, ts string")
    change = spark.createDataFrame([(2, "2024-01-03", "new"), (2 ** 40, "2024-01-04", "big")], "id long, ts string, extra string")
    for buckets in (None, 4):
        target = scratch_path(spark, "evolve")
        SY.sync_upsert(base, target, ["ts"] if buckets is None else ["id"], ["ts"], buckets)
        if buckets is None:
            out = SY.sync_upsert(change, target, ["ts"], ["id"], buckets)
            want = {(1, None), (2, None), (2, "new"), (2 ** 40, "big")}
        else:
            with pytest.raises(ValueError):  # a wider key would fall in other buckets
                SY.sync_upsert(change, target, ["id"], ["ts"], buckets)
            out = SY.sync_upsert(change.where("id = 2").withColumn("id", F.col("id").cast("int")), target, ["id"], ["ts"], buckets)
            want = {(1, None), (2, "new")}
        assert {(r.id, r.extra) for r in out.collect()} == want
        back = SY.sync_upsert(base.where("id = 1"), target, ["id"], ["ts"], buckets) if buckets else out
        assert "extra" in back.columns
    target = scratch_path(spark, "evolve_incr")
    SY.sync_incremental(base, target, "ts")
    out = SY.sync_incremental(change, target, "ts")
    assert {(r.id, r.extra) for r in out.collect()} == {(1, None), (2, None), (2, "new"), (2 ** 40, "big")}
    assert out.schema["id"].dataType.simpleString() == "bigint"


def test_incompatible_changes_are_refused_before_anything_is_written(spark):
    target = scratch_path(spark, "evolve_bad")
    SY.sync_incremental(spark.createDataFrame([(1, 5)], "id int, ts int").withColumn("ts", F.lit("2024").cast("timestamp_ntz")), target, "ts")
    for bad in ("id string, ts timestamp_ntz", "ID int, ts timestamp_ntz"):
        rec = SY.run_sync(spark, "s", spark.createDataFrame([], bad).unionByName(
            spark.createDataFrame([("x" if "string" in bad else 3, None)], bad)), target, "incremental", ts_col="ts")
        assert rec["status"] == "failed" and spark.read.parquet(target).count() == 1
    merged = schemas.merged(spark.createDataFrame([], "a decimal(10,2), b float, c int").schema,
                            spark.createDataFrame([], "a decimal(12,4), b double, c double, d date").schema)
    assert merged.simpleString() == "struct<a:decimal(12,4),b:double,c:double,d:date>"


# ---------------------------------------------------------------- upkeep

def load(spark, target, k):
    rows = [(k * 2 + j, f"2024-01-{k + 1:02d} 00:00:0{j}", k, "x", 1.0, "{}") for j in range(2)]
    return SY.sync_incremental(frame(spark, rows), target, "ts")


def test_many_loads_leave_few_files(spark, monkeypatch):
    monkeypatch.setattr(folders, "FAN", 3)
    target = scratch_path(spark, "upkeep")
    for k in range(20):
        out = load(spark, target, k)
    assert sorted(r.event_id for r in out.collect()) == list(range(40))
    assert len(SY.batches(spark, target)) <= 8
    assert len([n for n in folders.names(spark, target + "__sync_state") if n.startswith("batch=")]) <= 3
    assert SY.sync_incremental(frame(spark, [(99, "2024-01-10 00:00:00", 1, "x", 1.0, "{}")]), target, "ts").count() == 40
    log = scratch_path(spark, "hist")
    monkeypatch.setattr(SY, "HISTORY_FILES", 4)
    for k in range(11):
        SY.append_history(spark, log, [{"source_name": "s", "rows_processed": k, "status": "success"}])
    assert SY.sync_status(spark.read.parquet(log)).first().total_rows_processed == 55
    assert len(folders.names(spark, log)) < 8


def test_a_crash_while_merging_neither_loses_nor_repeats(spark, monkeypatch):
    monkeypatch.setattr(folders, "FAN", 3)
    for step, nth in [("rename", n) for n in range(1, 7)] + [("remove", n) for n in range(1, 5)]:
        target = scratch_path(spark, "upkeep_crash")
        for k in range(3):
            load(spark, target, k)
        plain, calls = getattr(folders, step), []

        def crash(s, path, *a):
            if "upkeep_crash" in path and "sync_state" not in path:
                calls.append(path)
                if len(calls) == nth:
                    raise IOError("crash")
            return plain(s, path, *a)

        with monkeypatch.context() as m:
            m.setattr(folders, step, crash)
            try:
                load(spark, target, 3)
            except IOError:
                pass
        out = load(spark, target, 3)
        assert sorted(r.event_id for r in out.collect()) == list(range(8)), (step, nth)
