"""Choice of a release and of its files, as table operations on names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.schemas import DATASETS

# Fixed value: a release label is four digits, a dash and two digits.
RELEASE_LABEL = "^[0-9]{4}-[0-9]{2}$"


def _is_label(label: str) -> Column:
    # In Java a final $ also matches before a line break, hence the length test.
    return F.col(label).rlike(RELEASE_LABEL) & (F.length(label) == 7)


def latest_release(df: DataFrame, label: str) -> DataFrame:
    """The rows of the greatest well-formed release label, by text order.

    The label comes from a scalar subquery: one partially aggregated value, and on a
    table partitioned by the label it prunes the second scan to one partition. Without
    any well-formed label the query fails instead of giving an empty result.
    """
    newest = df.filter(_is_label(label)).agg(F.max(label).alias("newest"))
    newest = newest.select(
        F.coalesce("newest", F.raise_error(F.lit("no release label found")).cast("string"))
    )
    return df.filter(F.col(label) == newest.scalar())


def _is_archive_of(name: str, prefix: str, split: bool) -> Column:
    if not split:
        return F.col(name) == f"{prefix}.zip"
    stem_digits = F.regexp_extract(F.col(name), f"^{prefix}([0-9]+)[.]zip$", 1)
    return F.col(name) == F.concat(F.lit(prefix), F.nullif(stem_digits, F.lit("")), F.lit(".zip"))


def select_files(
    files: DataFrame, name: str, partners: bool, family: str = "family"
) -> DataFrame:
    """Keep the archives of the known file families and add the family name.

    Split families are numbered (``Empresas0.zip``), the others have one fixed name.
    The partner family is kept only on request.
    """
    branches = [
        (_is_archive_of(name, dataset.prefix, dataset.split), dataset.name)
        for dataset in DATASETS.values()
        if dataset.prefix and (partners or dataset.name != "socios")
    ]
    first_test, first_name = branches[0]
    label = reduce(
        lambda chain, branch: chain.when(branch[0], F.lit(branch[1])),
        branches[1:],
        F.when(first_test, F.lit(first_name)),
    )
    return files.withColumn(family, label).filter(F.col(family).isNotNull())


def first_of_split_families(
    selected: DataFrame, name: str, family: str = "family"
) -> DataFrame:
    """Test profile: the first name of each split family and every other name.

    A grouped minimum instead of a ranking window, so no family is sorted in one task.
    """
    split = [dataset.name for dataset in DATASETS.values() if dataset.split]
    kept_apart = F.when(~F.col(family).isin(split), F.col(name))
    return (
        selected.groupBy(F.col(family), kept_apart.alias("_apart"))
        .agg(F.min(name).alias(name))
        .select(name, family)
    )


def sorted_names(df: DataFrame, name: str) -> DataFrame:
    """Distinct names in text order."""
    return df.select(name).distinct().orderBy(name)
