import csv
import os

import pytest
from pyspark.sql import functions as F

from regweave.schemas import text_schema
from regweave.sinks import tables
from regweave.sinks.tables import export_csv, export_single_csv, write_table, write_table_once
from regweave.sources.delimited import read_delimited
from regweave.storage import is_complete, scratch_directory

AB = text_schema(["a", "b"])
TEXT = [("  edge ", 'say "hi"'), ("a,b", "back\\slash"), ("tab\t", "\\\"x"), ("ã€", None),
        ("two\nlines", "x"), (None, None)]


def test_table_is_replaced_and_marked_complete(spark, bag, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([("1", "x")] * 3, AB), path)
    write_table(spark.createDataFrame([("2", "y")], AB), path)
    assert bag(spark.read.parquet(path)) == {("2", "y"): 1}
    assert is_complete(spark, path)


def test_once_skips_complete_and_rebuilds_half_written(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1", "x")], AB)
    assert write_table_once(spark, lambda: df, path)
    assert not write_table_once(spark, lambda: pytest.fail("not needed"), path)
    os.remove(f"{path}/_SUCCESS")
    assert write_table_once(spark, lambda: df, path)
    assert spark.read.parquet(path).count() == 1


def test_rebalance_merges_the_small_files_of_a_narrow_slice(spark, tmp_path):
    few = spark.range(0, 10_000, 1, 40).filter("id % 1000 = 0")
    write_table(few, str(tmp_path / "t"), rebalance=True)
    files = [name for name in os.listdir(tmp_path / "t") if name.endswith(".parquet")]
    assert len(files) == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


@pytest.mark.parametrize("single", [True, False])
def test_csv_export_keeps_every_character(spark, bag, tmp_path, single):
    df = spark.createDataFrame(TEXT, AB).repartition(3)
    path = str(tmp_path / "out.csv")
    (export_single_csv if single else export_csv)(df, path)
    back = read_delimited(spark, path, AB, ",", "UTF-8", header=True, multi_line=True)
    assert bag(back) == bag(df)


def test_single_csv_replaces_an_older_file(spark, tmp_path):
    target = tmp_path / "out.csv"
    target.write_text("old")
    export_single_csv(spark.createDataFrame([("1", "x")], AB), str(target))
    with open(target, newline="", encoding="utf-8") as file:
        assert list(csv.reader(file)) == [["a", "b"], ["1", "x"]]
    assert [name for name in os.listdir(tmp_path) if name.endswith(".tmp")] == []


def test_single_csv_of_nothing_has_a_header(spark, tmp_path):
    target = tmp_path / "out.csv"
    export_single_csv(spark.createDataFrame([], AB), str(target))
    assert target.read_text() == "a,b\n"


def test_single_csv_is_written_and_put_together_by_many_tasks(spark, tmp_path, monkeypatch):
    written = []

    def spy(df, *args, **options):
        written.append(df.rdd.getNumPartitions())
        export_csv(df, *args, **options)

    # Pieces end inside rows and inside characters, and hold several short files.
    monkeypatch.setattr(tables, "_PIECE_BYTES", 50)
    monkeypatch.setattr(tables, "_BLOCK_BYTES", 7)
    monkeypatch.setattr(tables, "export_csv", spy)
    rows = [(str(i), "ã€ \"x\", y" * (i % 9)) for i in range(60)]
    df = spark.createDataFrame(rows, AB).repartitionByRange(12, F.col("a").cast("int"))
    target = tmp_path / "with space" / "out.csv"
    target.parent.mkdir()
    export_single_csv(df.sortWithinPartitions(F.col("a").cast("int")), str(target))
    with open(target, newline="", encoding="utf-8") as file:
        assert list(csv.reader(file)) == [["a", "b"], *map(list, rows)]
    assert max(written) == 12
    assert os.listdir(target.parent) == ["out.csv"]
    assert spark.read.option("header", True).csv(str(target)).count() == 60


def test_empty_text_comes_back_as_null(spark, tmp_path):
    path = str(tmp_path / "out")
    export_csv(spark.createDataFrame([("", "x")], AB), path)
    assert read_delimited(spark, path, AB, ",", "UTF-8", header=True).first().a is None


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_directory(spark, "x")
    assert path != scratch_directory(spark, "x")
    # As a URI, so that a path without a scheme means the same to every process.
    assert ":/" in path
    assert shared is None or shared.split(":")[-1].rstrip("/") in path
