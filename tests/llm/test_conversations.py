"""Conversation repair against a plain version."""

import random

import brute
import numpy as np
import pytest

from regweave.llm import conversations, queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def repaired(spark, rows, block_bits, schema=SCHEMA, damage=True):
    given = spark.createDataFrame(rows, schema)
    own = conversations.damage(given) if damage else given
    mended = conversations.repair(own, block_bits)
    report = conversations.report(given, mended)
    return {r.conv_id: tuple(r)[1:] for r in report.collect()}, mended


def random_rows(seed, count, long=0):
    draw = random.Random(seed)
    texts = ["Yes.", "No", "a b!", "", " \t", "é?", "ok. ", None, "Why"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = []
    for conv in [None, *range(count)]:
        size = long if conv == 0 else draw.randint(1, 9)
        for _ in range(size):
            turn = draw.choice([None, *range(max(6, size // 2))])
            rows.append((conv, turn, draw.choice(roles), draw.choice(texts)))
    return rows


@pytest.mark.parametrize("block_bits", [1, 3, 14])
def test_repairs_equal_the_plain_version(spark, block_bits):
    rows = random_rows(block_bits, 60, long=90)
    convs = {r[0] for r in rows}
    got, _ = repaired(spark, rows, block_bits)
    assert got == brute.repairs(brute.damaged(rows), convs)
    got, _ = repaired(spark, rows, block_bits, damage=False)
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got == brute.repairs(spaced, convs)


def test_long_runs_and_one_hot_conversation(spark):
    """Runs far longer than a block, in one conversation that holds nearly all rows."""
    rows = [(1, i, "user" if i < 700 else "assistant", f"t{i}.") for i in range(1400)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Ho.")]
    got, mended = repaired(spark, rows, 4)
    assert got == brute.repairs(brute.damaged(rows), {1, 2})
    assert mended.turns.select("block").distinct().count() > 60


def test_registered_query(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversations(spark, SMALL)
    assert got.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256",
    ]
    assert [kind for _, kind in got.dtypes] == ["bigint"] * 7 + ["string"] * 2
    want = brute.repairs(brute.damaged(rows), {r[0] for r in rows})
    assert {r.conv_id: tuple(r)[1:] for r in got.collect()} == want


def test_repaired_turns_are_legal(spark):
    _, mended = repaired(spark, random_rows(5, 40), 2)
    turns = mended.repaired.toPandas()
    for _, own in turns.groupby("conv_id", dropna=False):
        roles = "".join(own.sort_values("place").role.str[0])
        assert (own.sort_values("place").place.to_numpy() == np.arange(len(own))).all()
        body = roles.removeprefix("s")
        assert body and body == "ua" * (len(body) // 2)


def test_empty_table_and_other_columns(spark):
    got, _ = repaired(spark, [], 14)
    assert got == {}
    rows = [("x", 1, "user", "Hi.", 7), ("x", 2, "assistant", "Ho.", 8), (None, None, None, None, 9)]
    schema = "conv_id string, turn int, role string, text string, block int"
    got, _ = repaired(spark, rows, 14, schema, damage=False)
    assert got["x"][5:7] == (0, "KK") and got[None][5:7] == (4, "D")


def test_powers_are_repeated_steps():
    for symbol in range(9):
        step = conversations._power(symbol, 0)
        total = step
        for length in range(2, 12):
            total = conversations._times(total, step)
            assert (conversations.segment_matrix([(symbol, length)]) == total).all()
