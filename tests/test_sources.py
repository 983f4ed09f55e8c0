import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from sluice.sources import files, scratch, tables


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_blank_header_becomes_a_numbered_column(spark, tmp_path):
    path = write(tmp_path / "m.csv", "a,b,c,d,e,f,g,h,i,\n1,2,3,4,5,6,7,8,9,\n")
    df = files.read_csv(spark, path)
    assert df.columns[-1] == "_c9"
    assert [r._c9 for r in df.collect()] == [None]


def test_quotes_and_newlines_survive(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'A,B\n1,"he said ""hi""\nand left"\n2,plain\n')
    assert files.read_csv_multiline(spark, path).orderBy("A").collect() == [
        Row(A=1, B='he said "hi"\nand left'), Row(A=2, B="plain")]


def test_explicit_schema_is_used_as_given(spark, tmp_path):
    path = write(tmp_path / "s.csv", "A,B\n1,2\n")
    schema = T.StructType([T.StructField("A", T.StringType()), T.StructField("B", T.DoubleType())])
    assert files.read_csv(spark, path, schema).collect() == [Row(A="1", B=2.0)]
    assert files.read_csv_multiline(spark, path, schema, partitions=3).rdd.getNumPartitions() == 3


def test_types_by_name_need_no_order(spark, tmp_path):
    path = write(tmp_path / "t.csv", "Extra,Email_Open_Rate(%),Customer_ID \nx,1.5,7\ny,oops,8\n")
    df = files.read_csv(spark, path, types=files.MARKETING_TYPES)
    assert df.dtypes == [("Extra", "string"), ("Email_Open_Rate(%)", "double"),
                         ("Customer_ID ", "string")]
    assert [tuple(r) for r in df.collect()] == [("x", 1.5, "7"), ("y", None, "8")]
    again = files.read_csv_multiline(spark, path, types=files.SALES_TYPES)
    assert dict(again.dtypes)["Email_Open_Rate(%)"] == "string"


def test_written_csv_reads_back_unchanged(spark, tmp_path):
    rows = [(1, '  padded "x" '), (2, "two\nlines, and a comma"), (3, "back\\slash")]
    df = spark.createDataFrame(rows, "k int, v string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv_multiline(spark, str(tmp_path / "out"), df.schema)
    assert sorted(map(tuple, back.collect())) == rows


def test_save_replaces_and_database_is_idempotent(spark):
    tables.create_database(spark, "src_test")
    tables.create_database(spark, "src_test")
    tables.save_table(spark.range(5).toDF("k"), "src_test.t")
    assert tables.save_table(spark.range(3).toDF("k"), "src_test.t").count() == 3
    before = spark.catalog.currentDatabase()
    tables.create_database(spark, "src_test", use=True)
    assert spark.catalog.currentDatabase() == "src_test"
    assert tables.read_table(spark, "t").count() == 3
    spark.catalog.setCurrentDatabase(before)


def test_runs_are_appended(spark):
    tables.create_database(spark, "runs_test")
    for run in ("a", "b"):
        records = tables.run_records(spark, run, "f1", [(0, {"x": 1}, 0.5), (1, {"x": 2.5}, 0.7)])
        stored = tables.append_runs(records, "runs_test.model_runs")
    rows = stored.orderBy("run_name", "trial_id").collect()
    assert [(r.run_name, r.trial_id, r.params, r.value) for r in rows] == [
        ("a", 0, {"x": "1"}, 0.5), ("a", 1, {"x": "2.5"}, 0.7),
        ("b", 0, {"x": "1"}, 0.5), ("b", 1, {"x": "2.5"}, 0.7)]
    assert all(isinstance(r.logged_at, datetime.datetime) for r in rows)


def test_preview_is_ordered(spark):
    assert [r.id for r in tables.preview(spark.range(100), 3, "id").collect()] == [0, 1, 2]
    assert tables.preview(spark.range(100), 3).count() == 3


def test_materialised_tables_have_a_known_size(spark):
    assert scratch.fresh_path(spark, "x") != scratch.fresh_path(spark, "x")
    kept = scratch.materialise(spark.range(10).toDF("k"), "t")
    assert kept.count() == 10 and scratch.shared_dir(spark) in kept.inputFiles()[0]
    assert 0 < scratch.plan_bytes(kept) < 100_000


class StubSession:
    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name.rsplit(".", 1)[1], default)


def test_the_shared_folder_is_the_one_the_cluster_names():
    assert scratch.shared_dir(StubSession(dir="hdfs:///shared/", master="yarn")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_dir(StubSession(master="yarn"))
