import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from regweave.operators import joins
from regweave.operators.joins import Right, hot_keys, left_join, lookup, measure, semi_join


def keyed(spark, rows, hot, columns, distinct=40, null_share=0.1, hot_share=0.4, seed=1):
    """Random rows in which one key holds about ``hot_share`` of them."""
    rng = random.Random(seed)
    data = []
    for _ in range(rows):
        draw = rng.random()
        key = f"k{rng.randrange(distinct)}"
        key = None if draw < null_share else hot if draw < null_share + hot_share else key
        data.append((key, *[f"{name}{rng.randrange(4)}" for name in columns]))
    values = [pa.array(column, pa.string()) for column in zip(*data)]
    return spark.createDataFrame(pa.Table.from_arrays(values, names=["k", *columns])).repartition(4)


@pytest.fixture
def hot_is_twice_average(monkeypatch):
    monkeypatch.setattr(joins, "HOT_PARTITIONS", 2)
    monkeypatch.setattr(joins, "SPREAD_BYTES", 0)


@pytest.mark.parametrize("left_hot, right_hots", [
    ("k1", ["zz"]), ("k1", ["k1"]), ("none", ["k1"]), ("k1", ["k1", "k2"]),
    ("k1", ["k1", "k1"]), ("none", ["k3", "k3", "zz"]),
])
def test_left_join_with_hot_keys_equals_plain_join(
    spark, bag, no_broadcast, hot_is_twice_average, left_hot, right_hots
):
    left = keyed(spark, 300, left_hot, ["a", "b"])
    rights = [
        keyed(spark, 60, hot, [f"r{i}"], seed=i + 2) for i, hot in enumerate(right_hots)
    ]
    want = left
    for right in rights:
        want = want.join(right, "k", "left")
    got = left_join(left, "k", [Right(right) for right in rights])
    assert got.columns == want.columns
    assert bag(got) == bag(want)


@pytest.mark.parametrize("seed", range(3))
def test_left_join_with_many_random_shapes(spark, bag, no_broadcast, hot_is_twice_average, seed):
    rng = random.Random(seed)
    left = keyed(spark, 200, "k1", ["a"], rng.choice([2, 30]), rng.choice([0, 0.5]), seed=seed)
    right = keyed(spark, 80, "k1", ["c"], rng.choice([2, 30]), rng.choice([0, 0.5]), seed=seed + 9)
    assert bag(left_join(left, "k", [Right(right)])) == bag(left.join(right, "k", "left"))


def test_left_join_without_hot_keys_is_the_plain_plan(spark, bag, plan, no_broadcast):
    left = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("a"))
    rights = [
        spark.range(0, 1000, 2).select(F.col("id").alias("k"), F.lit(i).alias(f"r{i}"))
        for i in range(2)
    ]
    got = left_join(left, "k", [Right(right) for right in rights])
    text = plan(got)
    assert "_b0" not in text
    # Three inputs, three exchanges: the left side is distributed once for both joins.
    assert text.count("Exchange hashpartitioning") == 3
    assert bag(got) == bag(left.join(rights[0], "k", "left").join(rights[1], "k", "left"))


def test_hot_chain_distributes_the_left_side_once(spark, plan, no_broadcast, hot_is_twice_average):
    left = keyed(spark, 300, "k1", ["a"])
    rights = [Right(keyed(spark, 50, "zz", [f"r{i}"], seed=i)) for i in range(3)]
    text = plan(left_join(left, "k", rights))
    assert text.count("Exchange hashpartitioning") == 4


def test_hot_key_and_its_copies_spread_over_partitions(
    spark, no_broadcast, hot_is_twice_average
):
    # A third of all rows are copies of one row.
    left = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    right = spark.range(0, 3000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    got = left_join(left.repartition(8), "k", [Right(right)])
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(row["count"] for row in sizes) == 3000
    assert max(row["count"] for row in sizes) < 1000


def test_null_keys_spread_and_stay(spark, bag, no_broadcast, hot_is_twice_average):
    left = keyed(spark, 300, "k1", ["a"], null_share=0.6, hot_share=0)
    right = keyed(spark, 40, "k1", ["c"], null_share=0.5, hot_share=0, seed=5)
    assert None in hot_keys([(left, "k")])[0]
    assert bag(left_join(left, "k", [Right(right)])) == bag(left.join(right, "k", "left"))


def test_small_side_leaves_the_left_side_in_place(spark, plan):
    left = spark.range(1000).select(F.col("id").alias("k"))
    right = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    text = plan(left_join(left, "k", [Right(right)]))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_repetitive_file_is_not_broadcast_on_the_strength_of_its_size(
    spark, tmp_path, plan, monkeypatch
):
    path = str(tmp_path / "copies")
    copies = spark.range(0, 200_000, 1, 1).select(F.lit("7").alias("k"), F.lit("y" * 50).alias("v"))
    copies.write.parquet(path)
    monkeypatch.setattr(joins, "BROADCAST_EXPANSION", 1)
    right = Right(spark.read.parquet(path))
    measure([right])
    assert right.small is False
    left = spark.createDataFrame([("7",), ("8",)], "k string")
    joined = left_join(left, "k", [right])
    assert "SortMergeJoin [k" in plan(joined)
    assert joined.count() == 200_001


def test_lookup_keeps_unknown_and_null_codes(spark, bag):
    rows = spark.createDataFrame([("1", "a"), ("9", "b"), (None, "c")], "code string, x string")
    codes = spark.createDataFrame([("1", "one"), (None, "none")], "codigo string, descricao string")
    got = lookup(rows, "code", codes, "codigo", "descricao", "text")
    assert got.columns == ["code", "x", "text"]
    assert bag(got) == {("1", "a", "one"): 1, ("9", "b", None): 1, (None, "c", None): 1}


@pytest.mark.parametrize("spread", [True, False])
def test_semi_join_with_hot_keys(spark, bag, no_broadcast, hot_is_twice_average, spread):
    df = keyed(spark, 300, "k1", ["a"])
    keys = keyed(spark, 60, "k1", [], distinct=10, seed=3).withColumnRenamed("k", "other")
    got = semi_join(df, "k", keys, "other", spread)
    wanted = {row[0] for row in keys.collect()} - {None}
    assert got.columns == df.columns
    assert bag(got) == bag(df.filter(F.col("k").isin(sorted(wanted))))


def test_semi_join_small_keys(spark, bag):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "c")], "k string, x string")
    keys = spark.createDataFrame([("1",), ("1",), (None,)], "k string")
    assert bag(semi_join(df, "k", keys)) == {("1", "a"): 1}


def test_lone_semi_join_is_split_by_adaptive_execution(spark, tmp_path, no_broadcast):
    """What ``spread=False`` relies on, with thresholds made small enough for test data."""
    path = str(tmp_path / "rows")
    key = F.when(F.col("id") % 3 != 0, "hot").otherwise(F.col("id").cast("string"))
    rows = spark.range(0, 60_000, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    rows.write.parquet(path)
    rows.select("k").distinct().write.parquet(path + "_keys")
    keys = Right(spark.read.parquet(path + "_keys").cache(), unique=True)
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        got = semi_join(spark.read.parquet(path), "k", keys, spread=False)
        got = got.hint("rebalance")
        assert got.count() == 60_000
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_hot_keys_counts_exactly_and_sends_little_to_the_driver(spark):
    df = spark.range(8000).select(F.when(F.col("id") < 6000, -1).otherwise(F.col("id")).alias("k"))
    even = spark.range(8000).withColumnRenamed("id", "k")
    assert hot_keys([(even, "k"), (df, "k"), (df.limit(0), "k")]) == [{}, {-1: 6}, {}]
    assert hot_keys([]) == []


def test_nested_columns_are_measured_and_carried(spark, bag, no_broadcast, hot_is_twice_average):
    left = spark.range(300).select(
        F.when(F.col("id") < 200, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.array("id").alias("a"), F.create_map(F.lit("m"), "id").alias("m"),
    )
    right = spark.range(250).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.struct("id").alias("s"),
    )
    got = left_join(left, "k", [Right(right)])
    assert "_b0" in got._jdf.queryExecution().optimizedPlan().toString()
    flat = ["k", "a", F.to_json("m").alias("m"), "s.id"]
    def rows(df):
        return {(r.k, tuple(r.a), r.m, r.id) for r in df.select(*flat).collect()}
    assert rows(got) == rows(left.join(right, "k", "left")) and got.count() == 300
    side = left.agg(F.sum(joins._row_bytes(left))).first()[0]
    assert side > 300 * 24


@pytest.mark.parametrize("left, right", [("int", "bigint"), ("int", "string"), ("date", "string")])
def test_keys_of_different_types_are_refused_before_any_job(spark, left, right):
    value = "cast(null as {}) as k"
    one, other = [spark.range(1).selectExpr(value.format(kind), "id") for kind in (left, right)]
    with pytest.raises(TypeError, match="join key 'k'"):
        left_join(one, "k", [Right(other.withColumnRenamed("id", "r"))])
    with pytest.raises(TypeError, match="join key 'k'"):
        semi_join(one, "k", other)


def test_several_joins_are_prepared_together(spark, bag, no_broadcast, hot_is_twice_average):
    left = keyed(spark, 300, "k1", ["a", "b"])
    first = joins.Join("k", [Right(keyed(spark, 60, "k1", ["r"], seed=3))], left)
    renamed = keyed(spark, 40, "b1", ["s"], seed=4).withColumnRenamed("k", "b")
    second = joins.Join("b", [Right(renamed)], left)
    joins.prepare([first, second])
    assert "k1" in first.hot[0] and "b1" in second.hot[1]
    got = joins.apply(joins.apply(left, first), second)
    want = left.join(first.rights[0].df, "k", "left").join(renamed, "b", "left")
    assert bag(got.select(want.columns)) == bag(want)


def test_keys_of_small_tables_are_not_counted(spark, no_broadcast, monkeypatch):
    left = keyed(spark, 300, "k1", ["a"])
    join = joins.Join("k", [Right(keyed(spark, 60, "k1", ["r"], seed=3))], left)
    monkeypatch.setattr(joins, "hot_keys", lambda sides: [{}] * len(sides) if not sides else 1 / 0)
    joins.prepare([join])
    assert join.hot == [{}, {}]


@pytest.fixture
def keys_too_many_to_broadcast(spark):
    """A limit under which 20,000 keys are too large, but a filter of them is not."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "20KB")
    yield
    spark.conf.set(key, before)


def test_rows_without_a_key_are_dropped_before_the_shuffle(spark, plan, tmp_path, keys_too_many_to_broadcast):
    text = F.concat(F.lit("company-"), F.col("id").cast("string"))
    path = str(tmp_path / "keys")
    spark.range(0, 200_000, 10, 4).select(text.alias("k")).write.parquet(path)
    keys = Right(spark.read.parquet(path), unique=True)
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 100 == 5, None).otherwise(text).alias("k"), "id"
    )
    got = semi_join(rows, "k", keys, spread=False, prefilter=True)
    assert keys.small is False or keys.small is None
    below = plan(got)[plan(got).index("SortMergeJoin"):]
    assert "BroadcastHashJoin" in below and "LeftSemi" in below
    assert [r.id for r in got.orderBy("id").collect()] == list(range(0, 200_000, 10))
    bloom, words = joins.key_filter(keys.df, "k", 20_000)
    passed = joins.may_match(rows, "k", bloom, words).count()
    assert 20_000 <= passed < 20_000 + 0.08 * 180_000


def test_filters_too_large_to_broadcast_are_left_out(spark, bag, plan, no_broadcast):
    rows = spark.range(500).select((F.col("id") % 50).cast("string").alias("k"), "id")
    keys = spark.range(0, 50, 3).select(F.col("id").cast("string").alias("k"))
    got = semi_join(rows, "k", keys, prefilter=True)
    assert "BroadcastHashJoin" not in plan(got)
    assert bag(got) == bag(rows.where("cast(k as int) % 3 = 0"))
    none = spark.createDataFrame([], "k string")
    assert semi_join(rows, "k", none, prefilter=True).count() == 0
