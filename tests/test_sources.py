"""Delimited input, fingerprints, sinks and run records."""

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.functions.columns import settled
from millrace.operators import profile
from millrace.sources import readers, sinks

TEXT = """age;emp.var.rate;job;empty;code;flag
30;1.1;admin;;007;unknown
NA;-0.5;NA;;12;null
45;NaN;"blue;collar";;5d;x
28;2e3;student;NA;9;None
"""


@pytest.fixture()
def path(tmp_path):
    p = tmp_path / "in.csv"
    p.write_text(TEXT)
    return str(p)


def test_types_nulls_and_names(spark, path):
    df = readers.read_delimited(spark, path, ";")
    assert dict(df.dtypes) == {"age": "bigint", "emp_var_rate": "double", "job": "string", "empty": "double",
                               "code": "string", "flag": "string"}
    rows = df.collect()
    assert [r["age"] for r in rows] == [30, None, 45, 28]
    assert [r["emp_var_rate"] for r in rows] == [1.1, -0.5, None, 2000.0]
    assert [r["job"] for r in rows] == ["admin", None, "blue;collar", "student"]
    assert [r["flag"] for r in rows] == ["unknown", None, "x", None]
    assert readers.original_name(df, "emp_var_rate") == "emp.var.rate"


def test_schema_is_used_as_given(spark, path):
    df = readers.read_delimited(spark, path, ";", schema="age int, `emp.var.rate` double, job string, empty string, code string, flag string")
    assert df.schema["age"].dataType.simpleString() == "int"
    assert [r["emp_var_rate"] for r in df.collect()] == [1.1, -0.5, None, 2000.0]


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_delimited(spark, str(tmp_path / "none.csv"))


def test_fingerprint_ignores_order_and_layout(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    a = readers.row_fingerprint(df).first()
    assert a == readers.row_fingerprint(df.repartition(9).orderBy(F.desc("id"))).first()
    assert a != readers.row_fingerprint(df.withColumn("v", F.when(F.col("id") == 3, 9).otherwise(F.col("v")))).first()


def test_file_hash(spark, path):
    row = readers.file_hashes(spark, path).first()
    assert row["sha256"] == hashlib.sha256(TEXT.encode()).hexdigest() and row["length"] == len(TEXT)


def test_csv_round_trip_with_maps(spark, tmp_path):
    df = spark.createDataFrame([(2, {"cluster_0": 5, "cluster_1": 7})], "k int, sizes map<string,bigint>")
    sinks.write_csv(df, str(tmp_path / "k"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "k")).first()
    assert back["sizes"] == '{"cluster_0":5,"cluster_1":7}'


def test_export_a_flat_mapping(spark, tmp_path):
    sinks.export_results(spark, {"model": "ridge", "r2": 0.5, "mape": None}, str(tmp_path / "e"))
    row = spark.read.option("header", True).csv(str(tmp_path / "e")).first()
    assert (row["model"], row["r2"], row["mape"]) == ("ridge", "0.5", None)


def test_runs_accumulate(spark, path, tmp_path):
    log = str(tmp_path / "runs")
    df = readers.read_delimited(spark, path, ";")
    for k in (3, 4):
        sinks.append_run(sinks.run_record(spark, 42, "bank", df, path, hash_files=True, details={"best_k": k}), log)
    rows = sinks.read_runs(spark, log).collect()
    assert sorted(r["details"]["best_k"] for r in rows) == ["3", "4"]
    assert {r["dataset_sha256"] for r in rows} == {hashlib.sha256(TEXT.encode()).hexdigest()}
    assert all(r["n_rows"] == 4 and isinstance(r["finished_at"], datetime.datetime) for r in rows)


def test_top_values_of_long_texts(spark):
    """Long texts share a head and a hot one holds a third of the rows; ties fall back to the whole text."""
    head = "x" * 100
    rows = [("hot " + head,)] * 30 + [(head + str(i),) for i in range(40)] + [("short",)] * 7 + [(None,)] * 3
    got = profile.profile_top_values(spark.createDataFrame(rows, "t string"), 4).orderBy("rank").collect()
    assert [(r["value"], r["n"]) for r in got] == [
        ("hot " + head, 30), ("short", 7), (head + "0", 1), (head + "1", 1)]


def test_small_results_settle_and_large_ones_stay(spark):
    df = spark.range(10)
    assert settled(df).count() == 10 and settled(df, limit=5) is df


def test_scratch_paths_are_new(spark):
    assert sinks.scratch_path(spark, "a") != sinks.scratch_path(spark, "a")
    assert sinks.scratch_path(spark, "a").startswith(sinks.shared_dir(spark))


def write(tmp_path, text):
    (tmp_path / "t.csv").write_text(text)
    return str(tmp_path / "t.csv")


def test_long_whole_numbers_keep_their_digits(spark, tmp_path):
    df = readers.read_delimited(spark, write(tmp_path, "a,b\n1234567890123456789,1\n1234567890123456780,12345678901234567890\n"))
    assert df.dtypes == [("a", "bigint"), ("b", "string")]
    assert [r["a"] for r in df.orderBy("a").collect()] == [1234567890123456780, 1234567890123456789]


def test_true_and_false_columns(spark, tmp_path):
    df = readers.read_delimited(spark, write(tmp_path, "a,b\nTrue,true\nFalse,1\nNA,x\n"))
    assert df.dtypes == [("a", "boolean"), ("b", "string")]
    assert [r["a"] for r in df.collect()] == [True, False, None]


def test_line_breaks_in_quoted_cells(spark, tmp_path):
    df = readers.read_delimited(spark, write(tmp_path, 'a,b\n"one\ntwo",1\n"say ""hi""",2\n'))
    assert [tuple(r) for r in df.collect()] == [("one\ntwo", 1), ('say "hi"', 2)]


@pytest.mark.parametrize("schema", [None, "a int, b int"])
def test_too_many_cells_are_an_error_and_too_few_are_null(spark, tmp_path, schema):
    short = readers.read_delimited(spark, write(tmp_path, "a,b\n1,2\n3\n"), schema=schema)
    assert [tuple(r) for r in short.collect()] == [(1, 2), (3, None)]
    path = write(tmp_path, "a,b\n1,2\n3,4,5\n")
    for columns in (["a", "b"], ["a"]):
        with pytest.raises(Exception, match="more than 2 cells"):
            readers.read_delimited(spark, path, schema=schema).select(*columns).collect()


def test_a_cell_that_fails_the_schema_is_an_error(spark, tmp_path):
    path = write(tmp_path, "a,b\n1,x\nNA,y\n")
    assert [r["a"] for r in readers.read_delimited(spark, path, schema="a int, b string").collect()] == [1, None]
    with pytest.raises(Exception, match="not int in b: x"):
        readers.read_delimited(spark, path, schema="a int, b int").collect()


def test_blanks_at_the_ends_of_cells_survive(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame([("  pad  ",)], "a string"), str(tmp_path / "p"))
    assert readers.read_delimited(spark, str(tmp_path / "p")).first()["a"] == "  pad  "


def test_fingerprints_tell_null_from_empty_and_cells_apart(spark):
    mark = lambda rows: readers.row_fingerprint(spark.createDataFrame(rows, "a string, b string")).first()
    assert len({mark(r)["checksum"] for r in ([(None, "x")], [("", "x")], [("x", None)], [("a|b", "c")], [("a", "b|c")])}) == 5


def test_models_do_not_overwrite_each_other(spark, tmp_path):
    from millrace.operators import preprocess

    model = preprocess.Preprocessor(numeric=["id"]).fit(spark.range(5))
    first, second = (sinks.save_model(model, str(tmp_path), "m") for _ in range(2))
    assert first != second and sinks.load_model(first).stages and sinks.load_model(second).stages
    with pytest.raises(Exception, match="exists"):
        sinks.save_model(model, str(tmp_path), "m", first.rsplit("m_", 1)[1])


def test_files_are_split_unless_a_quoted_cell_breaks(spark, tmp_path):
    plain, broken = (tmp_path / n for n in ("plain", "broken"))
    plain.mkdir()
    broken.mkdir()
    rows = "".join(f'{i},"say ""{i}"""\n' for i in range(40_000))
    (plain / "x.csv").write_text("a,b\n" + rows)
    (broken / "x.csv").write_text("a,b\n" + rows + '7,"one\ntwo"\n')
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        one, two = (readers.read_delimited(spark, str(p), schema="a int, b string") for p in (plain, broken))
        assert one.rdd.getNumPartitions() > 4 and two.rdd.getNumPartitions() == 1
        assert one.count() == 40_000 and two.count() == 40_001
        assert two.where("b = 'one\ntwo'").count() == 1 and one.where("b = 'say \"7\"'").first()["a"] == 7
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


def test_files_are_hashed_by_piece(spark, tmp_path):
    import hashlib

    contents = {"one file": b"x" * 3_000_001, "b%20c": b"y", "d": bytes(range(256)) * 50}
    for name, body in contents.items():
        (tmp_path / name).write_bytes(body)
    rows = readers.file_hashes(spark, str(tmp_path)).collect()
    assert sorted((r["length"], r["sha256"]) for r in rows) == sorted((len(b), hashlib.sha256(b).hexdigest()) for b in contents.values())


def test_hashing_by_piece_reads_no_contents_into_a_cell(spark, tmp_path):
    """A cell holds 2 GB at most; the limit is set to less here."""
    import hashlib

    limit = "spark.sql.sources.binaryFile.maxLength"
    (tmp_path / "large").write_bytes(b"z" * 5_000)
    spark.conf.set(limit, "1000")
    try:
        rows = readers.file_hashes(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset(limit)
    assert [(r["length"], r["sha256"]) for r in rows] == [(5_000, hashlib.sha256(b"z" * 5_000).hexdigest())]
