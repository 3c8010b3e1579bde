"""Filters, projections, aggregations and limits, with column names as arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slice_equal(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose ``column`` is exactly ``value``; NULL never matches."""
    return df.filter(F.col(column) == F.lit(value))


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct key rows. Partial aggregation removes copies before the shuffle."""
    return df.select(*columns).distinct()


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the columns in ``names``, under their new names."""
    return df.select([F.col(old).alias(new) for old, new in names.items()])


def prefixed(df: DataFrame, prefix: str, columns: list[str], keep: list[str]) -> DataFrame:
    """``keep`` unchanged plus ``columns`` with a prefix, so a wide join stays unambiguous."""
    return df.select(*keep, *[F.col(name).alias(prefix + name) for name in columns])


def summarise_many(
    df: DataFrame,
    key: str,
    kind: str,
    kinds: dict[str, str],
    date: str,
    count_as: str,
    first_as: str,
    last_as: str,
) -> DataFrame:
    """One row per ``key``: row count, one count per kind value, first and last date.

    ``kinds`` maps an output column to the kind value it counts; any other value and
    NULL count towards none of them. Dates compare as they are typed, so text dates
    compare as text. Every measure has a partial form, so a key that holds a large
    share of the rows reaches the shuffle as one row per task.
    """
    measures: list[Column] = [F.count(F.lit(1)).alias(count_as)]
    measures += [
        F.count_if(F.col(kind) == F.lit(value)).alias(name) for name, value in kinds.items()
    ]
    measures += [F.min(date).alias(first_as), F.max(date).alias(last_as)]
    return df.groupBy(key).agg(*measures)


def merge_summaries(
    partial: DataFrame, key: str, counts: list[str], first: str, last: str
) -> DataFrame:
    """One row per ``key`` from summaries of parts of its rows: counts add up, of the dates
    the first and the last stay."""
    sums = [F.sum(name).alias(name) for name in counts]
    return partial.groupBy(key).agg(*sums, F.min(first).alias(first), F.max(last).alias(last))


def bounded_count(df: DataFrame, bound: int, name: str) -> DataFrame:
    """One row: the number of rows, counted up to ``bound`` ("is there data?")."""
    return df.select(F.lit(1).alias("one")).limit(bound).agg(F.count("one").alias(name))


def probe_count(df: DataFrame, bound: int) -> int:
    """The same number, at once. ``take`` reads a few partitions and goes on to more only
    while rows are missing, where a counted limit starts a task for every partition."""
    return len(df.select(F.lit(1)).take(bound))


def total_count(df: DataFrame, name: str) -> DataFrame:
    """One row: the number of rows."""
    return df.agg(F.count(F.lit(1)).alias(name))
