import pytest
from pyspark.sql import functions as F

from regweave.operators.quality import (
    EmptySliceError,
    duplicate_keys,
    require_slice,
    validation_report,
)
from regweave.operators.relational import (
    bounded_count,
    distinct_keys,
    probe_count,
    prefixed,
    renamed,
    slice_equal,
    summarise_many,
)


def test_slice_is_exact_text_equality(spark, bag):
    rows = spark.createDataFrame([("ES",), ("SP",), (None,), ("es",), ("ES ",)], "uf string")
    assert bag(slice_equal(rows, "uf", "ES")) == {("ES",): 1}


def test_distinct_keys_and_renames(spark, bag):
    rows = spark.createDataFrame([("1", "a"), ("1", "a"), (None, "b")], "k string, x string")
    assert bag(distinct_keys(rows, "k")) == {("1",): 1, (None,): 1}
    assert renamed(rows, {"x": "y"}).columns == ["y"]
    assert prefixed(rows, "p_", ["x"], keep=["k"]).columns == ["k", "p_x"]


def test_summary_counts_kinds_and_compares_dates_as_text(spark):
    rows = [("c", "1", "20200101"), ("c", "2", "00000000"), ("c", "3", None), ("c", "9", "20190101"),
            ("c", None, None)]
    got = summarise_many(
        spark.createDataFrame(rows, "k string, t string, d string"),
        "k", "t", {"n1": "1", "n2": "2", "n3": "3"}, "d", "n", "first", "last",
    )
    assert dict(got.dtypes) == {
        "k": "string", "n": "bigint", "n1": "bigint", "n2": "bigint", "n3": "bigint",
        "first": "string", "last": "string",
    }
    assert tuple(got.first()) == ("c", 5, 1, 1, 1, "00000000", "20200101")


def test_bounded_count_stops_at_the_bound(spark):
    assert bounded_count(spark.range(50), 10, "n").first().n == 10
    assert bounded_count(spark.range(3), 10, "n").first().n == 3
    assert probe_count(spark.range(50), 10) == 10 and probe_count(spark.range(3), 10) == 3


def test_report_and_empty_slice(spark):
    some, none = spark.range(1500), spark.range(0)
    report = validation_report(some, none, some)
    assert report.first().asDict() == {"slice_rows": 1000, "company_rows": 0, "activity_rows": 1500}
    assert require_slice(report, "ES").collect() == report.collect()
    bounded = validation_report(some, none, some, bound=7)
    assert bounded.first().slice_rows == 7
    with pytest.raises(EmptySliceError, match="ES"):
        require_slice(validation_report(none, some, some), "ES")


def test_duplicate_keys_leave_out_null(spark, bag):
    rows = spark.createDataFrame([("1",), ("1",), ("2",), (None,), (None,)], "k string")
    assert bag(duplicate_keys(rows, "k")) == {("1", 2): 1}


def test_partial_aggregation_before_the_shuffle(spark, plan):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"))
    assert plan(distinct_keys(rows, "k")).count("HashAggregate") == 2
    assert "partial_count" in plan(duplicate_keys(rows, "k"))
