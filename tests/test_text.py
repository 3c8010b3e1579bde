import pytest
from pyspark.sql import functions as F

from regweave.functions import blank_to_null, composite_key, digits_only, phone_number


def one(spark, column, **values):
    schema = ", ".join(f"{name} string" for name in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize("parts, expected", [
    (("12345678", "0001", "90"), "12345678000190"),
    (("12345678", None, "90"), "1234567890"),
    ((None, None, None), ""),
])
def test_composite_key_leaves_out_null_parts(spark, parts, expected):
    assert one(spark, composite_key("a", "b", "c"), **dict(zip("abc", parts))) == expected


@pytest.mark.parametrize("value, expected", [
    ("   ", None), ("", None), (None, None), ("  x y ", "x y"), ("\t", "\t"), (" ", " "),
])
def test_blank_to_null_knows_ascii_spaces_only(spark, value, expected):
    assert one(spark, blank_to_null("a"), a=value) == expected


@pytest.mark.parametrize("area, number, expected", [
    ("27", "3", "(27) 3"), (" 27 ", " 3 ", "(27) 3"), (None, "3", "3"), ("  ", "3", "3"),
    ("27", None, None), ("27", "  ", None), (None, None, None),
])
def test_phone_number(spark, area, number, expected):
    assert one(spark, phone_number("a", "n"), a=area, n=number) == expected


@pytest.mark.parametrize("value, expected", [
    ("12.345.678/0001-90", "12345678000190"), ("abc", ""), (None, None), ("١a1", "1"),
])
def test_digits_only(spark, value, expected):
    assert one(spark, digits_only(F.col("a")), a=value) == expected
