"""Equi-joins that stay whole and balanced when a few keys hold most of the rows.

Each join picks one of two ways:

* The right side is small. The optimizer's estimate has to be under the session's
  ``spark.sql.autoBroadcastJoinThreshold``, as for Spark itself. File sizes say little
  about repetitive data, though, so the rows are also measured, which is cheap for files
  that small. Spark then broadcasts this side. The left side is not shuffled, so its skew
  does not matter.
* Otherwise both sides are shuffled, and keys that would overload one task are spread
  first. Counting rows per shuffle partition, and per key where a partition is too full,
  finds the keys with more rows than a few average partitions; there are fewer of those
  than partitions, whatever the data size. A row of such a key goes to one of several buckets, and the rows it has to meet
  are repeated in each of them. All other keys keep a single bucket. No row is dropped,
  and without such keys the plan is Spark's plain join.

Neither takes a job where the tables come with profiles, taken when they were written
(``regweave.operators.profiles``).
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from regweave.operators.profiles import Frequent

# A key is spread when it holds more rows than this many average shuffle partitions.
HOT_PARTITIONS = 4
# Below this estimate of a table's size and so many rows its keys are not counted: even if
# one key held all of it, one task would manage. A small file can hold any number of rows, so
# its rows are counted. This changes the plan only, never the rows.
SPREAD_BYTES = 256 << 20
SPREAD_ROWS = 4 << 20
# Rows in memory may take this many times the broadcast threshold, which is meant for
# compressed files.
BROADCAST_EXPANSION = 8


@dataclass
class Right:
    """Right side of a left join.

    ``unique`` says the key is unique by construction. ``bound`` is a table that cannot
    be smaller than ``df`` and is cheaper to measure, such as the input of an aggregate.
    ``small`` says that ``df`` can be broadcast (None = not measured yet), ``misjudged``
    that Spark would broadcast it though it is too large. ``size`` (a bound of its bytes)
    and ``frequent`` (its most frequent keys) come from a profile, if there is one.
    """

    df: DataFrame
    unique: bool = False
    bound: DataFrame | None = None
    small: bool | None = None
    misjudged: bool = False
    size: int | None = None
    frequent: Frequent | None = None

    def shuffled(self, df: DataFrame) -> DataFrame:
        """``df``, derived from this side, kept from a broadcast by estimate alone."""
        return df.hint("merge") if self.misjudged else df


def _shuffle_partitions(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _broadcast_limit(spark: SparkSession) -> int:
    text = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")).strip().lower()
    if text.lstrip("-").isdigit():
        return int(text)
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def _row_bytes(df: DataFrame) -> Column:
    """Payload bytes of a row: 8 per column plus text, and nested values as JSON text."""
    sizes = []
    for field in df.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            value = F.to_json(F.struct(value))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        sizes.append(F.coalesce(F.octet_length(value), F.lit(0)))
    return reduce(Column.__add__, sizes, F.lit(8 * len(df.columns))).cast("bigint")


def _estimate(df: DataFrame) -> int:
    """Spark's own estimate of a table's bytes."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def measure(rights: Sequence[Right]) -> None:
    """Decide for all ``rights`` whether they can be broadcast, in one Spark job for those
    that have no profile."""
    candidates = []
    for right in rights:
        if right.small is None:
            limit = _broadcast_limit(right.df.sparkSession)
            right.small = _estimate(right.df) <= limit
            if right.small and right.size is not None:
                right.small = right.size <= BROADCAST_EXPANSION * limit
                right.misjudged = not right.small
            elif right.small:
                candidates.append(right)
    if not candidates:
        return
    measured = [right.df if right.bound is None else right.bound for right in candidates]
    # One aggregate over all tables: one exchange, where one for each table would cost a stage
    # for each. A table without rows has no sum and stays small.
    sizes = [
        df.select(F.lit(i).alias("i"), _row_bytes(df).alias("bytes"))
        for i, df in enumerate(measured)
    ]
    limit = BROADCAST_EXPANSION * _broadcast_limit(measured[0].sparkSession)
    for i, size in reduce(DataFrame.unionAll, sizes).groupBy("i").agg(F.sum("bytes")).collect():
        candidates[i].small = size <= limit
        candidates[i].misjudged = not candidates[i].small


def hot_keys(sides: Sequence[tuple[DataFrame, str]]) -> list[dict[object, int]]:
    """Per (table, key column): overloaded keys and the number of buckets each needs
    (None = NULL key).

    First the rows are counted per partition the shuffle would send them to, which is one
    number per task and partition whatever the number of keys. Only if some partitions
    come out overloaded are the keys in those counted. Each of the two steps is one job
    for all sides, whatever joins they belong to. The driver receives one row per shuffle
    partition, and fewer hot keys than that.
    """
    hot: list[dict[object, int]] = [{} for _ in sides]
    if not sides:
        return hot
    partitions = _shuffle_partitions(sides[0][0].sparkSession)
    rows = F.count(F.lit(1)).alias("n")

    def partition(key: str) -> Column:
        return F.pmod(F.hash(F.col(key)), F.lit(partitions))

    loads = [
        df.select(F.lit(i).alias("side"), partition(key).alias("p"))
        for i, (df, key) in enumerate(sides)
    ]
    sizes: list[dict[int, int]] = [{} for _ in sides]
    for side, p, n in reduce(DataFrame.unionAll, loads).groupBy("side", "p").agg(rows).collect():
        sizes[side][p] = n
    limits = [HOT_PARTITIONS * sum(size.values()) / partitions for size in sizes]
    counts: dict[str, list[DataFrame]] = {}
    for i, (df, key) in enumerate(sides):
        full = [p for p, n in sizes[i].items() if n > limits[i]]
        if full:
            kept = df.filter(partition(key).isin(full)).groupBy(F.col(key).alias("key"))
            keys = kept.agg(rows).filter(F.col("n") > limits[i])
            kind = df.schema[key].dataType.simpleString()
            counts.setdefault(kind, []).append(keys.select(F.lit(i).alias("side"), "key", "n"))
    for tables in counts.values():
        for side, value, n in reduce(DataFrame.unionAll, tables).collect():
            hot[side][value] = math.ceil(n * HOT_PARTITIONS / limits[side])
    return hot


def _bucket_table(
    like: DataFrame, key: str, sides: Sequence[dict[object, int]]
) -> DataFrame:
    """Rows (key, n0, n1, ...): how many buckets each side cuts a hot key into."""
    spark = like.sparkSession
    limit = _shuffle_partitions(spark)
    rows = []
    for value in {value for side in sides for value in side if value is not None}:
        counts = [side.get(value, 1) for side in sides]
        product = math.prod(counts)
        if product > limit:
            # Hot on several sides: shrink each cut so that the grid still has about
            # one bucket per shuffle partition.
            shrink = math.log(limit) / math.log(product)
            counts = [max(2, int(n**shrink)) if n > 1 else 1 for n in counts]
        rows.append((value, *counts))
    # Arrow keeps such a small table as a relation inside the plan.
    keys, *counts = zip(*rows) if rows else [[] for _ in range(len(sides) + 1)]
    columns = {"_hot_key": pa.array(keys, to_arrow_type(like.schema[key].dataType))}
    columns |= {f"_n{i}": pa.array(column, pa.int32()) for i, column in enumerate(counts)}
    return spark.createDataFrame(pa.table(columns))


def _bucketed(
    df: DataFrame, key: str, table: DataFrame, own: int, cuts: Sequence[int], null_buckets: int = 1
) -> DataFrame:
    """Add one bucket column per cut: a side splits its rows by its own cut (``own``)
    and repeats them over the buckets of the other cuts.

    The split hashes the row and the number of the task that read it. Copies of one row
    therefore spread as well, and a task that is run again after a lost executor sends
    every row to the bucket it was in before, in whatever order the rows arrive.
    """
    names = df.columns
    result = df.join(F.broadcast(table), F.col(key) == F.col("_hot_key"), "left")
    # Maps and variants, also inside other values, have no hash.
    types = {field.name: field.dataType.simpleString() for field in df.schema}
    hashable = [name for name, text in types.items() if not re.search("map<|variant", text)]
    for cut in cuts:
        if cut == own:
            buckets = F.when(F.col(key).isNull(), F.lit(null_buckets)).otherwise(F.col(f"_n{cut}"))
            spread = F.xxhash64(F.spark_partition_id(), *[F.col(name) for name in hashable])
            split = F.when(buckets > 1, F.pmod(spread, buckets.cast("bigint")).cast("int"))
            bucket = F.coalesce(split, F.lit(0))
        else:
            last = F.coalesce(F.col(f"_n{cut}"), F.lit(1)) - 1
            bucket = F.explode(F.sequence(F.lit(0), last))
        result = result.withColumn(f"_b{cut}", bucket)
    # The left side keeps the cut counts for the check on unmatched repeats.
    counts = [f"_n{cut}" for cut in cuts if own == 0 and cut > 0]
    return result.select(*names, *[f"_b{cut}" for cut in cuts], *counts)


@dataclass
class Join:
    """A left join with every table of ``rights`` on the same-named ``key``.

    ``sketch`` is a table with the left side's keys, cheaper to count than the left side
    if that is itself the result of joins; ``frequent`` are its most frequent ones, if there
    is a profile. ``hot`` holds the hot keys of the left side and of each right side that has
    to be shuffled (None = not counted yet).
    """

    key: str
    rights: list[Right]
    sketch: DataFrame
    frequent: Frequent | None = None
    hot: list[dict[object, int]] | None = None

    @property
    def shuffled(self) -> list[Right]:
        return [right for right in self.rights if not right.small]


def worth_counting(sides: Sequence[DataFrame]) -> list[bool]:
    """Whether tables are so large that a hot key matters: by Spark's estimate, else by their
    rows, counted for all of them in one job."""
    large = [_estimate(df) >= SPREAD_BYTES for df in sides]
    counts = [df.select(F.lit(i).alias("i")) for i, df in enumerate(sides) if not large[i]]
    if counts:
        for i, n in reduce(DataFrame.unionAll, counts).groupBy("i").count().collect():
            large[i] = n >= SPREAD_ROWS
    return large


def prepare(joins: Sequence[Join], also: Sequence[Right] = ()) -> None:
    """Measure the right sides of all ``joins`` (and of ``also``) in one job, and count the
    rows and, of large tables, the hot keys of what has to be shuffled in one more each, or
    in three if there are hot keys. Tables with a profile take part in none of them."""
    measure([right for join in joins for right in join.rights] + list(also))
    sides, owners = [], []
    for join in joins:
        if join.hot is not None:
            continue
        join.hot = [{} for _ in range(len(join.shuffled) + 1)]
        if not join.shuffled:
            continue
        partitions = _shuffle_partitions(join.sketch.sparkSession)
        # A NULL on the right matches nothing, and Spark filters it out before the shuffle.
        asked = [(join.sketch, join.frequent, True)]
        asked += [(r.df, None if r.unique else r.frequent, False) for r in join.shuffled]
        for i, (df, frequent, nulls) in enumerate(asked):
            if i and join.shuffled[i - 1].unique:
                continue
            if frequent is not None:
                known = frequent.above(partitions, HOT_PARTITIONS, nulls)
                if frequent.rows < SPREAD_ROWS and _estimate(df) < SPREAD_BYTES:
                    known = {}
                if known is not None:
                    join.hot[i] = known
                    continue
            sides.append((df if nulls else df.filter(F.col(join.key).isNotNull()), join.key))
            owners.append((join, i))
    large = worth_counting([df for df, _ in sides])
    sides = [side for side, counted in zip(sides, large) if counted]
    owners = [owner for owner, counted in zip(owners, large) if counted]
    for (join, i), found in zip(owners, hot_keys(sides)):
        join.hot[i] = found


def _require_equal_types(left: DataFrame, key: str, rights: Sequence[DataFrame]) -> None:
    """Hot keys of all sides are compared as values, so the sides must agree on the type."""
    types = {df.schema[key].dataType.simpleString() for df in [left, *rights]}
    if len(types) > 1:
        raise TypeError(f"join key {key!r} has types {sorted(types)}; cast it on one side")


def left_join(
    left: DataFrame, key: str, rights: Sequence[Right], sketch_on: DataFrame | None = None
) -> DataFrame:
    """Left outer join of ``left`` with every right side on the same-named ``key``.

    Ordinary left-join semantics: all left rows stay, a duplicate right key multiplies
    them, NULL keys match nothing. The key must have the same type on all sides. All sides
    that must be shuffled share one distribution of the left side. ``sketch_on`` is a
    cheaper table with the left side's keys, for when ``left`` itself is the result of
    earlier joins.
    """
    join = Join(key, list(rights), left if sketch_on is None else sketch_on)
    return apply(left, join)


def apply(left: DataFrame, join: Join) -> DataFrame:
    """``left_join`` as ``prepare`` found best; prepares ``join`` if nobody has."""
    key, rights = join.key, join.rights
    _require_equal_types(left, key, [right.df for right in rights])
    if join.hot is None:
        prepare([join])
    result = left
    if join.shuffled:
        result = _shuffled_left_join(left, key, join.shuffled, join.hot)
    # Broadcast sides come last, so that their columns do not travel in a shuffle. They
    # have been measured, which the hint tells to Spark.
    for right in rights:
        if right.small:
            result = result.join(F.broadcast(right.df), key, "left")
    columns = [key] + [name for name in left.columns if name != key]
    columns += [name for right in rights for name in right.df.columns if name != key]
    return result.select(*columns)


def _shuffled_left_join(
    left: DataFrame, key: str, rights: Sequence[Right], sides: Sequence[dict[object, int]]
) -> DataFrame:
    cuts = [i for i, side in enumerate(sides) if side]
    if not cuts:
        return reduce(
            lambda df, right: df.join(right.shuffled(right.df), key, "left"), rights, left
        )

    table = _bucket_table(left, key, sides)
    on = [key] + [f"_b{cut}" for cut in cuts]
    joined = _bucketed(left, key, table, 0, cuts, sides[0].get(None, 1))
    for i, right in enumerate(rights, start=1):
        side = _bucketed(right.df, key, table, i, cuts).withColumn(f"_hit{i}", F.lit(True))
        joined = joined.join(right.shuffled(side), on, "left")
    # A left row repeated for the cuts of right side i finds all its partners across
    # them, and has at least one, as the key was found on that side. A repeat without a
    # partner of its own is therefore not an unmatched row.
    for i in cuts:
        if i > 0:
            uncut = F.coalesce(F.col(f"_n{i}"), F.lit(1)) == 1
            joined = joined.filter(uncut | F.col(f"_hit{i}"))
    return joined


def lookup(
    left: DataFrame, column: str, codes: DataFrame, code: str, description: str, output: str
) -> DataFrame:
    """Add the description of the code in ``column`` as ``output`` (NULL if unknown)."""
    return left_join(left, column, [code_list(column, codes, code, description, output)])


def code_list(
    column: str, codes: DataFrame, code: str, description: str, output: str
) -> Right:
    """A code list as the right side of a join on ``column``."""
    return Right(codes.select(F.col(code).alias(column), F.col(description).alias(output)))


def normalised_key_join(
    left: DataFrame, key: str, right: DataFrame, right_key: Column
) -> DataFrame:
    """Left join where the right key is an expression, e.g. a formatted number's digits."""
    return left_join(left, key, [Right(right.withColumn(key, right_key))])


def _mask(key: Column) -> Column:
    """Four of 64 bits, by a hash that is independent of the one that picks the word."""
    places = F.xxhash64(key, F.lit(1))
    bits = []
    for i in range(4):
        place = F.shiftrightunsigned(places, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bits.append(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return reduce(Column.bitwiseOR, bits)


def key_filter(keys: DataFrame, key: str, rows: int) -> tuple[DataFrame, int]:
    """A Bloom filter of about ``rows`` keys as a table (word, bits), and its number of words.

    A key sets four bits of one word of 64, and a word serves six keys, so about one in
    twenty-five other keys passes. The table is a few bytes for each key, however long the
    keys are.
    """
    words = max(1, -(-rows // 6))
    word = F.pmod(F.xxhash64(F.col(key)), F.lit(words))
    made = keys.filter(F.col(key).isNotNull()).groupBy(word.alias("_word"))
    return made.agg(F.bit_or(_mask(F.col(key))).alias("_bits")), words


def may_match(df: DataFrame, column: str, bloom: DataFrame, words: int) -> DataFrame:
    """Rows of ``df`` whose ``column`` passes the filter: all that match, and a few others."""
    word = F.pmod(F.xxhash64(F.col(column)), F.lit(words))
    mask = _mask(F.col(column))
    hit = (F.col("_word") == word) & (F.col("_bits").bitwiseAND(mask) == mask)
    return df.join(F.broadcast(bloom), hit, "left_semi")


def _prefiltered(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``df`` without most rows that match no key, where a filter of the keys can be broadcast."""
    rows = keys.count()
    limit = BROADCAST_EXPANSION * _broadcast_limit(df.sparkSession)
    if not 0 < 16 * -(-rows // 6) <= limit:
        return df
    return may_match(df, column, *key_filter(keys, column, rows))


def semi_join(
    df: DataFrame,
    column: str,
    keys: DataFrame | Right,
    key: str | None = None,
    spread: bool = True,
    prefilter: bool = False,
) -> DataFrame:
    """Rows of ``df`` whose ``column`` occurs among ``keys``; columns of ``df`` only.

    This is also the inner join with distinct keys. NULL matches nothing. ``key`` names
    the key column if it is not ``column``. Without ``spread``, hot keys are left to the
    adaptive skew join, which saves reading ``df`` once more to find them; it needs keys
    that are a plain table of unique values. With ``prefilter``, rows that match no key are
    dropped where ``df`` is read, by a Bloom filter of keys that are too many to broadcast
    but have a filter that is not; this pays where few of the rows match.
    """
    wanted = keys if isinstance(keys, Right) else Right(keys)
    wanted_keys = wanted.df.select(F.col(key or column).alias(column))
    _require_equal_types(df, column, [wanted_keys])
    if wanted.small is None:
        wanted = Right(wanted_keys, wanted.unique)
        measure([wanted])
    if wanted.small:
        return df.join(F.broadcast(wanted_keys), column, "left_semi").select(*df.columns)
    # Existence needs one row per key. Partial aggregation removes the copies before the
    # shuffle, and before a hot key is repeated in its buckets.
    if not wanted.unique:
        wanted_keys = wanted_keys.distinct()
    names = df.columns
    if prefilter:
        df = _prefiltered(df, column, wanted_keys)
    hot = {}
    if spread:
        present = df.filter(F.col(column).isNotNull())
        if worth_counting([present])[0]:
            (hot,) = hot_keys([(present, column)])
    if not hot:
        return df.join(wanted.shuffled(wanted_keys), column, "left_semi").select(*names)
    table = _bucket_table(df, column, [hot])
    on = [column, "_b0"]
    left = _bucketed(df, column, table, 0, [0])
    right = _bucketed(wanted_keys, column, table, 1, [0])
    return left.join(wanted.shuffled(right), on, "left_semi").select(*names)
