"""What the operators share: text handling, column-wise Python steps, joins to skewed groups.

Helper columns next to a caller's columns have names that begin with ``__rw_``.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regweave.storage import scratch_directory

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_PIECE_BYTES = 4 << 20
_WORD_BYTES = frozenset(string.digits.encode() + _LOWER.encode()) | frozenset(range(128, 256))

#: Byte tables. UTF-8 bytes of non-ASCII characters are all above 0x7F and stay.
LOWER_TABLE = bytes.maketrans(_UPPER.encode(), _LOWER.encode())
WORD_TABLE = bytes(b if b in _WORD_BYTES else 32 for b in LOWER_TABLE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is; NULL becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def id_remainder(name: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(modulus))


def alnum_words(data: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text, A-Z lower-cased."""
    return data.translate(WORD_TABLE).split()


def space_words(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z lower-cased."""
    return data.translate(LOWER_TABLE).split()


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column, NULL as empty."""
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(binary).to_pylist()]


def append_columns(
    rows: DataFrame,
    ddl: str,
    compute: Callable[[pa.RecordBatch], list[pa.Array]],
) -> DataFrame:
    """``rows`` with columns computed batch by batch in Python; nothing is shuffled.

    A new column takes the place of one of the same name. ``compute`` gets an Arrow batch, cut
    to a few MB as it makes several times its bytes of it, and returns one array for each
    column of ``ddl``.
    """
    added = T._parse_datatype_string(ddl)
    taken = {field.name.lower() for field in added}
    kept = [name for name in rows.columns if name.lower() not in taken]
    names = kept + added.names
    schema = T.StructType([rows.schema[name] for name in kept] + list(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, whole.num_rows * _PIECE_BYTES // max(1, whole.nbytes))
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                old = [batch.column(batch.schema.get_field_index(name)) for name in kept]
                yield pa.RecordBatch.from_arrays(old + compute(batch), names=names)

    return rows.mapInArrow(run, schema)


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written to the shared scratch folder and read again: a cut in the lineage."""
    spark = rows.sparkSession
    path = scratch_directory(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def small_side(rows: DataFrame, purpose: str, limit: int = 100_000) -> DataFrame:
    """``rows``, narrow and usually few, as the right side of a join: written, counted, and
    broadcast up to ``limit`` rows; beyond that they are joined by a shuffle."""
    kept = stored(rows, purpose)
    return F.broadcast(kept) if kept.count() <= limit else kept.hint("shuffle_hash")


def attach_groups(
    rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int
) -> DataFrame:
    """Inner join of ``rows`` with one row for each key, where few keys may hold most rows.

    ``size`` is the number of rows of a group. Groups above ``total / 2000`` rows are fewer
    than 2000, so they are broadcast and their rows do not move; the others are shuffled.
    """
    large = F.col(size) > max(200, total // 2000)
    hot = F.broadcast(groups.where(large))
    cold = rows.join(F.broadcast(groups.where(large).select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(cold.join(groups.where(~large), keys))
