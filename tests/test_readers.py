"""Readers keep or refuse every line; listings match names as globs do."""

import time

import pytest
from pyspark.sql import types as T

from supplylake.session import scratch_path
from supplylake.sinks import loading as LD
from supplylake.sinks import tables as TB
from supplylake.sources import files as FS


def put(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.text(path)


def test_csv_round_trip_of_quotes_and_line_ends(spark):
    rows = [("Joe \"Big\" Wine, 5L", "1"), ("two\nlines", "2"), (" kept ", "3"), ('"', "4"), ("back\\slash", "5")]
    df = spark.createDataFrame(rows, "name STRING, n STRING")
    for path in (FS.write_csv(df, scratch_path(spark, "quotes")), TB.export_csv(df, scratch_path(spark, "quotes_out"))):
        got = FS.load_csv(spark, path, multi_line=True)
        assert sorted(map(tuple, got.collect())) == sorted((a, int(b)) for a, b in rows)


def test_types_come_from_all_values(spark):
    path = scratch_path(spark, "types")
    put(spark, path, ["i,l,d,day,at,b,t,na,e", "1,5000000000,1.5,2020-01-02,2020-01-02 03:04:05,true,x,1,",
                      "-2,6,2,2021-12-31,2020-01-02T03:04:05,FALSE,2,NA,", ",7,1e3,,,,,3,"])
    assert dict(FS.load_csv(spark, path).dtypes) == {
        "i": "int", "l": "bigint", "d": "double", "day": "date", "at": "timestamp", "b": "boolean", "t": "string",
        "na": "double", "e": "string"}


def test_bad_csv_lines_are_refused_or_set_apart(spark):
    path = scratch_path(spark, "bad_csv")
    put(spark, path, ["a,b", "1,x", "2", "3,y,z", "four,w"])
    with pytest.raises(Exception):
        FS.load_csv(spark, path).collect()
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    base = scratch_path(spark, "bad_csv_out")
    assert LD.load_table(spark, path, f"{base}/good", f"{base}/bad", schema) == (4, 1, 3)
    assert [tuple(r) for r in spark.read.parquet(f"{base}/good").collect()] == [(1, "x")]
    bad = spark.read.parquet(f"{base}/bad").collect()
    assert sorted(r[FS.BAD_LINE] or f"{r.a},{r.b}" for r in bad) == ["2", "3,y,z", "four,w"]


def test_load_directory_writes_tables_and_rejects(spark):
    folder = scratch_path(spark, "landing")
    put(spark, f"{folder}/good one.csv", ["a,b", "1,x", "2,y"])
    put(spark, f"{folder}/mixed.csv", ["a,b", "1,x", "bad,y", "NA,z"])
    put(spark, f"{folder}/broken.csv", ["a,b", "1,x,too,many"])
    put(spark, f"{folder}/empty.csv", ["a,b"])
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    target = scratch_path(spark, "landing_out")
    tables, res = FS.load_directory(spark, folder, "*.csv", target, {"mixed": schema})
    got = {r.file: (r.table, r.total_rows, r.inserted_rows, r.failed_rows, r.status) for r in res.collect()}
    assert got == {"good one.csv": ("good_one", 2, 2, 0, "success"), "mixed.csv": ("mixed", 3, 2, 1, "success"),
                   "broken.csv": ("broken", 0, 0, 0, "failed"), "empty.csv": ("empty", 0, 0, 0, "skipped")}
    assert set(tables) == {"good_one", "mixed"}
    assert sorted(map(tuple, tables["mixed"].collect()), key=str) == [(1, "x"), (None, "z")]
    assert [r.a for r in spark.read.parquet(f"{target}/_rejects/mixed").collect()] == ["bad"]


def test_latest_entry_by_glob(spark, tmp_path):
    for name in ("sales_1.txt", "sales_2.txt", "salesX3.txt", "sales_[4].txt", "other.txt"):
        (tmp_path / name).write_text(name)
        time.sleep(0.02)
    deep = tmp_path / "below"
    deep.mkdir()
    (deep / "sales_9.txt").write_text("not directly below")
    base = str(tmp_path)
    assert FS.latest_file(spark, base, "sales_*.txt").endswith("/sales_[4].txt")
    assert FS.latest_file(spark, base, "sales_?.txt").endswith("/sales_2.txt")
    assert FS.latest_file(spark, base, "sales[!_]*.txt").endswith("/salesX3.txt")
    assert FS.latest_file(spark, base, "none*") is None
    spark.range(100).repartition(4).write.parquet(f"{base}/drop.parquet")
    assert FS.read_latest(spark, base, "drop.*").count() == 100
    with pytest.raises(FileNotFoundError):
        FS.read_latest(spark, base, "none*")


def test_bad_json_is_an_error_or_kept(spark):
    path = scratch_path(spark, "bad_json")
    put(spark, path, ['{"id": 1}', '{"id": ', '"a bare string"', '{"data": [{"id": 2}, {"id": 3}]}'])
    with pytest.raises(Exception):
        FS.scan_json(spark, path).collect()
    kept = FS.scan_json(spark, path, bad_lines="keep")
    rows = FS.unwrap_envelope(kept, bad_lines="keep").collect()
    assert sorted(r.id for r in rows if r[FS.BAD_LINE] is None) == [1, 2, 3]
    assert sorted(r[FS.BAD_LINE] for r in rows if r[FS.BAD_LINE]) == ['"a bare string"', '{"id": ']
    with pytest.raises(Exception):
        FS.unwrap_envelope(kept).collect()


def test_own_reader(spark):
    from supplylake.plans.jobs import READERS, SourceSpec, extract, register_reader
    register_reader("numbers", lambda s, spec: s.range(int(spec.path)))
    try:
        assert extract(spark, SourceSpec("n", "numbers", "7", "t")).count() == 7
        with pytest.raises(ValueError):
            extract(spark, SourceSpec("n", "unheard of", "7", "t"))
    finally:
        READERS.pop("numbers")


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from supplylake.session import checkpoint_root
    context = SimpleNamespace(applicationId="app-other", master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError):
        checkpoint_root(session)


def test_a_thousand_files_are_a_few_jobs(spark, tmp_path):
    """Files with equal headers and types are loaded together; odd ones alone."""
    land = tmp_path / "in"
    land.mkdir()
    for k in range(60):
        body = {0: "1,x\n2,y", 1: "1.5,x", 2: "NA,z\n4,q", 3: "", 4: "5,a,b", 5: "2024-01-01,é +1"}[k % 6]
        (land / f"t {k:02d}+ü.csv").write_text(f"a,b\n{body}\n" if body else "a,b\n")
    (land / "other.csv").write_text('c,"d e"\n1,2\n')
    (land / "twice.csv").write_text("x,x\n1,2\n")
    (land / "nothing.csv").write_text("")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    schemas = {FS.sanitize_name(f"t {k:02d}+ü.csv"): schema for k in range(30)}
    tracker, group = spark.sparkContext.statusTracker(), "many files"
    spark.sparkContext.setJobGroup(group, group)
    try:
        tables, res = FS.load_directory(spark, str(land), "*.csv", f"{tmp_path}/out", schemas)
        rows = {r.file: r for r in res.collect()}
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert len(tracker.getJobIdsForGroup(group)) < 60
    want = {0: (2, 2, 0), 1: (1, 0, 1), 2: (2, 2, 0), 3: (0, 0, 0), 4: (1, 0, 1), 5: (1, 0, 1)}
    for k in range(30):
        r = rows[f"t {k:02d}+ü.csv"]
        assert (r.total_rows, r.inserted_rows, r.failed_rows) == want[k % 6], k
        assert r.status == ("skipped" if k % 6 == 3 else "success")
    types = {0: "int", 1: "double", 2: "double", 5: "date"}
    for k in range(30, 60):
        r = rows[f"t {k:02d}+ü.csv"]
        assert r.status == {3: "skipped", 4: "failed"}.get(k % 6, "success")
        if k % 6 in types:
            assert dict(tables[r.table].dtypes) == {"a": types[k % 6], "b": "string"}
    assert "1 lines do not fit" in rows["t 34+ü.csv"].error
    reasons = {k: spark.read.parquet(f"{tmp_path}/out/_rejects/{FS.sanitize_name(f't {k:02d}+ü.csv')}").first()[LD.REASON] for k in (1, 4, 5)}
    assert reasons == {1: "a is no int", 4: "the line does not fit the header", 5: "a is no int"}
    assert sorted(map(tuple, tables["t_02__"].collect()), key=str) == [(4, "q"), (None, "z")]
    assert tables["other"].columns == ["c", "d e"] and "nothing.csv" not in rows  # Spark lists no file of 0 bytes
    assert rows["twice.csv"].total_rows == 1 and set(tables) == {r.table for r in rows.values() if r.inserted_rows}


def test_types_are_found_without_sorting_rows_or_wide_expressions(spark, monkeypatch):
    """One expression reads the cells of all columns, and rows are not sorted by entry."""
    plans = []
    plain = FS.kind_bits

    def watched(*args, **kw):
        out = plain(*args, **kw)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(FS, "kind_bits", watched)
    folder = scratch_path(spark, "many_columns")
    for name in ("a", "b"):
        put(spark, f"{folder}/{name}.csv", [",".join(f"c{i}" for i in range(30)), ",".join(map(str, range(30)))])
    tables, _ = FS.load_directory(spark, folder, "*.csv", scratch_path(spark, "many_columns_out"))
    assert set(dict(tables["a"].dtypes).values()) == {"int"}
    assert len(plans) == 1
    assert "SortAggregate" not in plans[0] and "Sort [" not in plans[0]
    assert plans[0].count("RLIKE") < 30


@pytest.mark.parametrize("text,kind", [
    ("1e3", "double"), ("-.5", "double"), ("5.", "double"), (" 7 ", "double"), ("inf", "double"), ("-Infinity", "double"),
    ("0x1p3", "double"), ("1d", "string"), ("2F", "string"), ("1_1", "string"), ("12 l", "string"), ("12e", "string"),
    ("infinite", "string"), ("nano", "string"), ("3000000000", "bigint"), ("99999999999999999999", "double"), ("2020-13-01", "string")])
def test_kinds_of_odd_texts(spark, text, kind):
    df = spark.createDataFrame([(text, "x"), (None, "y"), ("  ", "z")], "v STRING, w STRING")
    assert FS.text_types(df) == {"v": kind, "w": "string"}


def test_files_of_bounded_size(spark):
    df = spark.range(95).selectExpr("id", "concat('a', char(10), id) AS t").coalesce(1)
    path = FS.write_csv(df, scratch_path(spark, "bounded"), rows_per_file=10)
    assert FS.list_files(spark, path).where("length > 0").count() == 10
    assert FS.load_csv(spark, path, multi_line=True).count() == 95


def test_entries_of_one_header_or_several_without_good_rows(spark):
    """A single entry is written without dealing its rows out; rejects alone leave no table."""
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    for names in (("one",), ("one", "two")):
        folder, target = scratch_path(spark, "dealt"), scratch_path(spark, "dealt_out")
        for n in names:
            put(spark, f"{folder}/{n}.csv", ["a", "x"])
        tables, res = FS.load_directory(spark, folder, "*.csv", target, {n: schema for n in names})
        assert tables == {}
        assert [(r.total_rows, r.inserted_rows, r.failed_rows) for r in res.collect()] == [(1, 0, 1)] * len(names)
        for n in names:
            assert [r.a for r in spark.read.parquet(f"{target}/_rejects/{n}").collect()] == ["x"]
