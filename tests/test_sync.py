"""Sync modes and streams: exactly-once over two drops and a restart."""

from pyspark.sql import functions as F

from supplylake.session import scratch_path
from supplylake.streaming import streams as ST
from supplylake.streaming import sync as SY

ROWS = [(1, "2024-01-01 00:00:00", 7, "a", 1.0, "{}"), (2, "2024-01-01 00:01:00", 7, "b", 2.0, "{}"),
        (3, "2024-01-01 00:02:00", 8, "c", 3.0, "{}"), (4, "2024-01-01 00:03:00", 7, "d", 4.0, "{}")]
DDL = "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL).withColumn("ts", F.to_timestamp_ntz("ts"))


def test_upsert_last_row_wins(spark):
    target = scratch_path(spark, "t_upsert")
    SY.sync_upsert(frame(spark, ROWS[:2]), target, ["user_id"], ["ts", "event_id"])
    out = SY.sync_upsert(frame(spark, ROWS[2:]), target, ["user_id"], ["ts", "event_id"])
    got = {r["user_id"]: r["event_id"] for r in out.collect()}
    assert got == {7: 4, 8: 3}


def test_incremental_strict_mark(spark):
    target = scratch_path(spark, "t_incr")
    SY.sync_incremental(frame(spark, ROWS[:2]), target, "ts")
    out = SY.sync_incremental(frame(spark, ROWS), target, "ts")  # re-sent rows are late
    assert sorted(r["event_id"] for r in out.collect()) == [1, 2, 3, 4]


def test_unknown_mode(spark):
    import pytest
    with pytest.raises(ValueError):
        SY.run_sync(spark, "s", frame(spark, ROWS), scratch_path(spark, "x"), "merge")


def test_empty_extract_recorded(spark):
    rec = SY.run_sync(spark, "s", frame(spark, ROWS).limit(0), scratch_path(spark, "e"), "full")
    assert rec["status"] == "empty"


def test_stream_restart_exactly_once(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("s_src", "s_tgt", "s_ckpt"))
    df = frame(spark, ROWS)
    df.where("event_id <= 2").write.mode("append").parquet(src)
    ST.run_stream(spark, src, df.schema, target, ckpt, mode="append")
    ST.run_stream(spark, src, df.schema, target, ckpt, mode="append")  # nothing new
    df.where("event_id > 2").write.mode("append").parquet(src)
    ST.run_stream(spark, src, df.schema, target, ckpt, mode="append")
    got = sorted(r["event_id"] for r in ST.read_target(spark, target, df.columns).collect())
    assert got == [1, 2, 3, 4]


def test_bucketed_upsert_rewrites_only_touched_buckets(spark):
    target = scratch_path(spark, "t_bucket")
    rows = [(i, f"2024-01-01 00:{i:02d}:00", i, "x", float(i), "{}") for i in range(40)]
    SY.sync_upsert(frame(spark, rows), target, ["user_id"], ["ts", "event_id"], buckets=8)
    before = {r["user_id"]: r["_bucket"] for r in spark.read.parquet(target).collect()}
    upd = [(100, "2024-01-02 00:00:00", 3, "y", 9.0, "{}")]
    out = SY.sync_upsert(frame(spark, upd), target, ["user_id"], ["ts", "event_id"], buckets=8)
    got = {r["user_id"]: (r["event_id"], r["_bucket"]) for r in out.collect()}
    assert len(got) == 40 and got[3][0] == 100
    assert all(got[u][1] == b for u, b in before.items())


def test_pipeline_isolates_failures(spark):
    from supplylake.plans.jobs import SourceSpec, run_pipeline
    src = scratch_path(spark, "p_src")
    frame(spark, ROWS).write.parquet(src)
    hist = scratch_path(spark, "p_hist")
    specs = [SourceSpec("ok", "parquet", src, scratch_path(spark, "p_t1"), "upsert",
                        primary_key=["user_id"], order_by=["ts", "event_id"]),
             SourceSpec("broken", "parquet", src + "_missing", scratch_path(spark, "p_t2"), retry_seconds=0.01),
             SourceSpec("off", "parquet", src, scratch_path(spark, "p_t3"), enabled=False)]
    recs = run_pipeline(spark, specs, hist)
    assert [r["status"] for r in recs] == ["success", "failed"]
    status = {r["source_name"]: r for r in SY.sync_status(spark.read.parquet(hist)).collect()}
    assert status["ok"]["successful_syncs"] == 1 and status["broken"]["failed_syncs"] == 1


def test_sinks_modes(spark):
    import pytest
    from supplylake.sinks import tables as TB
    df = frame(spark, ROWS)
    p = scratch_path(spark, "sink")
    TB.write_table(df, p, "replace")
    TB.write_table(df, p, "append")
    assert spark.read.parquet(p).count() == 8
    with pytest.raises(Exception):
        TB.write_table(df, p, "fail")
    out = TB.export_csv(df, scratch_path(spark, "csv"))
    assert "vendor_sales_summary_" in out and spark.read.option("header", True).csv(out).count() == 4
    ids = TB.with_surrogate_id(df).select("id").distinct().count()
    assert ids == 4


def test_replayed_batch_is_idempotent(spark):
    target = scratch_path(spark, "t_replay")
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    fn = ST._append_batch(target, cols)
    df = frame(spark, ROWS)
    fn(df, 0)
    fn(df, 0)  # the same micro-batch delivered again after a failure
    assert ST.read_target(spark, target, cols).count() == 4
    inc_target = scratch_path(spark, "t_replay_inc")
    inc = ST._incremental_batch(inc_target, cols, "ts")
    inc(df.where("event_id <= 2"), 0)
    inc(df, 1)  # re-sends 1 and 2: late, dropped
    inc(df, 1)  # replay of batch 1
    got = sorted(r["event_id"] for r in ST.read_target(spark, inc_target, cols).collect())
    assert got == [1, 2, 3, 4]


def test_audit_and_catalog_helpers(spark):
    from supplylake.sinks import tables as TB
    from supplylake.sources import files as FS
    df = TB.with_audit_timestamp(frame(spark, ROWS))
    assert "_pipeline_updated_at" in df.columns
    assert df.select("_pipeline_updated_at").distinct().count() == 1
    assert "tableName" in FS.list_tables(spark).columns
    assert FS.table_definition(df).startswith("event_id BIGINT")
    nan = spark.createDataFrame([(float("nan"),)], "x DOUBLE")
    assert TB.nan_to_null_all(nan).first()[0] is None


def test_continuous_trigger_picks_up_new_drops(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("c_src", "c_tgt", "c_ckpt"))
    df = frame(spark, ROWS)
    df.where("event_id <= 2").write.mode("append").parquet(src)
    q = ST.run_stream(spark, src, df.schema, target, ckpt, mode="upsert",
                      key=["user_id"], order=["ts", "event_id"], once=False, interval="1 second")
    try:
        q.processAllAvailable()
        df.where("event_id > 2").write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["user_id"]: r["event_id"] for r in ST.read_target(spark, target, df.columns).collect()}
    assert got == {7: 4, 8: 3}


def test_stream_counts_late_rows(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("l_src", "l_tgt", "l_ckpt"))
    df = frame(spark, ROWS)
    df.where("event_id <= 2").write.mode("append").parquet(src)
    ST.run_stream(spark, src, df.schema, target, ckpt, mode="incremental", ts_col="ts")
    df.write.mode("append").parquet(src)  # re-sends 1 and 2, adds 3 and 4
    ST.run_stream(spark, src, df.schema, target, ckpt, mode="incremental", ts_col="ts")
    tot = ST.late_counts(spark, target).agg(F.sum("rows_in"), F.sum("rows_loaded"), F.sum("rows_late")).first()
    assert tuple(tot) == (6, 4, 2)
    assert sorted(r["event_id"] for r in ST.read_target(spark, target, df.columns).collect()) == [1, 2, 3, 4]


def test_start_streams_one_per_enabled_source(spark):
    from supplylake.plans.jobs import SourceSpec, start_streams
    df = frame(spark, ROWS)
    a, b = scratch_path(spark, "ss_a"), scratch_path(spark, "ss_b")
    df.write.parquet(a)
    df.write.parquet(b)
    ta, tb = scratch_path(spark, "ss_ta"), scratch_path(spark, "ss_tb")
    specs = [SourceSpec("a", "parquet", a, ta, "upsert", primary_key=["user_id"], order_by=["ts", "event_id"]),
             SourceSpec("b", "parquet", b, tb, "full"),
             SourceSpec("c", "parquet", b, scratch_path(spark, "ss_tc"), enabled=False)]
    qs = start_streams(spark, specs, {"a": df.schema, "b": df.schema}, scratch_path(spark, "ss_ck"), once=True)
    assert len(qs) == 2
    assert ST.read_target(spark, ta, df.columns).count() == 2
    assert ST.read_target(spark, tb, df.columns).count() == 4


def test_stream_from_csv_and_json_drops(spark):
    from supplylake.sources.files import TS_MICROS, write_csv
    df = frame(spark, ROWS)
    c_src, j_src = scratch_path(spark, "csv_src"), scratch_path(spark, "json_src")
    write_csv(df, c_src)
    df.write.option("timestampNTZFormat", TS_MICROS).json(j_src)
    for fmt, src in (("csv", c_src), ("json", j_src)):
        tgt = scratch_path(spark, f"{fmt}_tgt")
        ST.run_stream(spark, src, df.schema, tgt, scratch_path(spark, f"{fmt}_ck"), mode="append", fmt=fmt)
        got = ST.read_target(spark, tgt, df.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_unreadable_file_raises_and_leaves_the_target(spark, tmp_path):
    import pytest
    rows = [(i, f"2024-01-01 00:{i:02d}:00", i, "x", float(i), "{}") for i in range(40)]
    target = f"{tmp_path}/target"
    SY.sync_upsert(frame(spark, rows), target, ["user_id"], ["ts"])
    part = sorted((tmp_path / "target").glob("part-*"))[0]
    good = part.read_bytes()
    part.write_bytes(b"not parquet at all")
    (tmp_path / "target" / f".{part.name}.crc").unlink(missing_ok=True)
    change = [(100, "2024-01-02 00:00:00", 3, "y", 9.0, "{}")]
    with pytest.raises(Exception):
        SY.sync_upsert(frame(spark, change), target, ["user_id"], ["ts"])
    part.write_bytes(good)
    assert spark.read.parquet(target).count() == 40
    out = SY.sync_upsert(frame(spark, change), target, ["user_id"], ["ts"])
    assert out.count() == 40 and out.where("event_id = 100").count() == 1


def test_null_keys_do_not_pile_up(spark):
    import pytest
    rows = [(1, "2024-01-01 00:00:00", None, "a", 1.0, "{}"), (2, "2024-01-01 00:01:00", 7, "b", 2.0, "{}")]
    for buckets in (None, 4):
        target = scratch_path(spark, "t_null")
        for _ in range(3):
            out = SY.sync_upsert(frame(spark, rows), target, ["user_id"], ["ts"], buckets)
        assert sorted((r["event_id"], r["user_id"]) for r in out.collect()) == [(1, None), (2, 7)]
    with pytest.raises(ValueError):
        SY.sync_upsert(frame(spark, rows), scratch_path(spark, "t_order"), ["user_id"], [])
    with pytest.raises(ValueError):
        SY.run_sync(spark, "s", frame(spark, rows), scratch_path(spark, "t_order"), "upsert", key=["user_id"])


def test_a_crash_between_steps_neither_loses_nor_repeats(spark, monkeypatch):
    import pytest

    from supplylake.sinks import folders
    df = frame(spark, ROWS)

    def crash(*a, **k):
        raise IOError("crash")

    # Incremental: the mark is written, the folder is not in place.
    target = scratch_path(spark, "t_crash_incr")
    SY.sync_incremental(df.where("event_id <= 2"), target, "ts")
    with monkeypatch.context() as m:
        m.setattr(folders, "add_folder", crash)
        with pytest.raises(IOError):
            SY.sync_incremental(df, target, "ts")
    out = SY.sync_incremental(df, target, "ts")
    assert sorted(r["event_id"] for r in out.collect()) == [1, 2, 3, 4]
    # Full: the new table is whole, the renames were not done or half done.
    for step in ("rename", "remove"):
        target = scratch_path(spark, "t_crash_full")
        SY.sync_full(df.where("event_id <= 2"), target)
        with monkeypatch.context() as m:
            m.setattr(folders, step, crash)
            with pytest.raises(IOError):
                SY.sync_full(df, target)
        assert folders.table_exists(spark, target)
        assert spark.read.parquet(target).count() == 4
    # Buckets: one of them is in place, the others follow.
    target = scratch_path(spark, "t_crash_bucket")
    rows = [(i, f"2024-01-01 00:{i:02d}:00", i, "x", float(i), "{}") for i in range(40)]
    SY.sync_upsert(frame(spark, rows), target, ["user_id"], ["ts"], buckets=4)
    plain, calls = folders.rename, []

    def third(*a):
        calls.append(a)
        return plain(*a) if len(calls) < 4 else crash()

    change = [(100 + i, "2024-01-02 00:00:00", i, "y", 9.0, "{}") for i in range(40)]
    with monkeypatch.context() as m:
        m.setattr(folders, "rename", third)
        with pytest.raises(IOError):
            SY.sync_upsert(frame(spark, change), target, ["user_id"], ["ts"], buckets=4)
    out = SY.sync_upsert(frame(spark, change[:1]), target, ["user_id"], ["ts"], buckets=4)
    assert sorted(r["event_id"] for r in out.collect()) == list(range(100, 140))


def test_full_stream_replaces(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("f_src", "f_tgt", "f_ckpt"))
    df = frame(spark, ROWS)
    df.where("event_id <= 2").repartition(2).write.mode("append").parquet(src)
    ST.run_stream(spark, src, df.schema, target, ckpt, mode="full")
    df.where("event_id <= 2").repartition(2).write.mode("append").parquet(src)
    df.where("event_id > 1").repartition(3).write.mode("append").parquet(src)  # two drops at once: the last holds
    ST.run_stream(spark, src, df.schema, target, ckpt, mode="full")
    assert sorted(r["event_id"] for r in ST.read_target(spark, target, df.columns).collect()) == [2, 3, 4]


def test_streams_refuse_types_they_cannot_serve(spark):
    import pytest

    from supplylake.plans.jobs import SourceSpec, start_streams
    for kind in ("latest_file", "api_payload", "database"):
        with pytest.raises(ValueError):
            start_streams(spark, [SourceSpec("x", kind, "p", "t")], {}, "ck")
