"""Validation reports and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.operators.relational import bounded_count, total_count

# Default bound of counts that only ask whether there is data.
PROBE_ROWS = 1000


class EmptySliceError(RuntimeError):
    """The requested state has no establishments."""


def validation_report(
    sliced: DataFrame,
    companies: DataFrame,
    activities: DataFrame,
    slice_as: str = "slice_rows",
    companies_as: str = "company_rows",
    activities_as: str = "activity_rows",
    bound: int = PROBE_ROWS,
) -> DataFrame:
    """One row: counts of the slice and the companies up to ``bound``, and of all activities."""
    counts = [
        bounded_count(sliced, bound, slice_as),
        bounded_count(companies, bound, companies_as),
        total_count(activities, activities_as),
    ]
    # Scalar subqueries put three one-row counts next to each other without a join.
    spark = sliced.sparkSession
    return spark.range(1).select(
        *[count.scalar().alias(count.columns[0]) for count in counts]
    )


def require_slice(report: DataFrame, state: str, slice_as: str = "slice_rows") -> DataFrame:
    """Run the report, and fail if it counted no slice rows; give its row back otherwise."""
    row = report.first()
    if row[slice_as] == 0:
        raise EmptySliceError(f"no establishments for state {state}")
    return report.sparkSession.createDataFrame([row], report.schema)


def duplicate_keys(df: DataFrame, *key: str, count_as: str = "copies") -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    As the right side of a left join such a key multiplies rows. NULL keys never join,
    so they are left out.
    """
    keyed = df.select(*key).na.drop(subset=list(key))
    return keyed.groupBy(*key).agg(F.count(F.lit(1)).alias(count_as)).filter(F.col(count_as) > 1)
