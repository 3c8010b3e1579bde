"""Text functions of the registry, built from JVM-side expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def composite_key(*parts: ColumnOrName) -> Column:
    """Join key parts without a separator; NULL parts are left out."""
    return F.concat_ws("", *[_column(part) for part in parts])


def blank_to_null(value: ColumnOrName) -> Column:
    """Trim ASCII spaces; text with nothing left becomes NULL."""
    return F.nullif(F.trim(_column(value)), F.lit(""))


def phone_number(area: ColumnOrName, number: ColumnOrName) -> Column:
    """``(area) number``, or the number alone, or NULL where there is no number."""
    area, number = blank_to_null(area), blank_to_null(number)
    # concat is NULL as soon as one part is, so the fallback covers a missing area
    # code, and a missing number makes both branches NULL.
    return F.coalesce(F.concat(F.lit("("), area, F.lit(") "), number), number)


def digits_only(value: ColumnOrName) -> Column:
    """Drop every character outside 0-9."""
    return F.regexp_replace(_column(value), "[^0-9]", "")
