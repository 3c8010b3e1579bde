"""Conversation structure repair: the cheapest edits that give turns a legal order of roles.

A legal conversation is empty, or has an optional system turn and then pairs of a user and an
assistant turn. A turn is a symbol: the initial of its role and whether its end is cut off, or
that it has to go. The cost of what follows is a vector over the states of the legal form, and
a symbol is a min-plus matrix that takes the vector behind a turn to the one in front of it.
Equal consecutive symbols are one run, and a run of any length is a few products with cached
binary powers of its matrix.

1. All turns get a global order, by a range partitioning that also divides one very long
   conversation, and with it a block of at most ``2 ** block_bits`` consecutive turns.
2. A conversation inside one block is solved there. One that reaches a block's border leaves
   the matrix of its segment; a conversation's matrices are combined, and each segment gets
   the costs of what follows it.
3. With these its edits are unrolled for every state that it may be entered in, and the
   conversation's chain of states picks one of them for each segment.
4. The turns, read in order beside their edits, become the repaired conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import attach_groups, stored

_BLANKS = " \t\n\x0b\x0c\r"
_INSERT, _REROLE, _DELETE, _CUT = 3, 3, 4, 3
#: States: nothing yet, after system, after user, after assistant.
_NEXT = (2, 2, 3, 2)  # by an inserted or re-roled turn
_ROLE = {2: "user", 3: "assistant"}  # of such a turn, by the state it leads to
_KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # by the class of the role: s, u, a, other
_FINAL = (0, 2 * _INSERT, _INSERT, 0)
_MUST_GO = 8  # the other symbols are twice the class, plus one if the end is cut off
_NEVER = 1 << 60
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def damage(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, turn, role, text) with planted faults, by crc32 of ``conv_id:turn`` modulo 20:
    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes
    it a user's. NULLs count as one space there, and are one in role and text."""
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in (conv_id, turn)]
    )
    fate = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    filled = {name: F.coalesce(F.col(name), F.lit(" ")) for name in (role, text)}
    spoilt = (
        F.when(fate == 1, "").when(fate == 2, F.translate(filled[text], ".!?", ""))
        .otherwise(filled[text])
    )
    return rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(fate == 4, "user").otherwise(filled[role]).alias("role"), spoilt.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)))
        .alias("_copy"),
    ).drop("_copy")


def _ordered(rows: DataFrame, block_bits: int) -> DataFrame:
    """The turns in order: ``pos`` ascends by conversation and turn, NULLs first, turns of the
    same number by role and SHA-256 of the text. Rows equal in all of that may trade places."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    visible = F.rtrim(text, F.lit(_BLANKS))
    initial = F.substring(role, 1, 1)
    own = F.coalesce(F.octet_length(F.col("conv_id").cast("string")), F.lit(-1))
    content = F.concat(
        own.cast("string"), F.lit(":"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
        F.octet_length(role).cast("string"), F.lit(":"), role, text,
    )
    marked = rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.unhex(F.sha2(content, 256)).alias("content"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
        .alias("kind"),
        (visible == "").alias("blank"),
        (~F.substring(visible, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.sha2(text, 256).alias("_text"), F.monotonically_increasing_id().alias("_row"),
    )
    keys = ["conv_id", "turn", "role", "_text"]
    placed = (
        marked.repartitionByRange(*keys, "_row").sortWithinPartitions(*keys, "_row")
        .drop("_text", "_row").withColumn("pos", F.monotonically_increasing_id())
    )
    return stored(placed.withColumn("block", F.shiftright("pos", block_bits)), "turns")


def _repeats(turns: DataFrame) -> DataFrame:
    """``pos`` of the turns whose role and text their conversation has had before."""
    said = turns.where("not blank").select("content", "pos")
    several = said.groupBy("content").agg(
        F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_n")
    ).where("_n > 1")
    several = stored(several, "repeated-turns")
    total = several.agg(F.sum("_n")).first()[0] or 0
    return attach_groups(said, several, ["content"], "_n", total).where("pos > _first").select("pos")


@cache
def _closure() -> np.ndarray:
    """Costs of reaching a state by inserted turns alone."""
    costs = np.full((4, 4), _NEVER)
    for start in range(4):
        state = start
        for count in range(3):
            costs[start, state] = min(costs[start, state], count * _INSERT)
            state = _NEXT[state]
    return costs


def _times(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.minimum((one[:, :, None] + other[None]).min(axis=1), _NEVER)


@cache
def _edits(symbol: int) -> tuple:
    """(letter, costs, states reached) of a turn's edits, in the order of their letters."""
    found = [("D", [_DELETE] * 4, [0, 1, 2, 3])]
    if symbol != _MUST_GO:
        kind, cut = divmod(symbol, 2)
        kept = [_KEPT[kind].get(s) for s in range(4)]
        found.append(("K", [_NEVER if t is None else cut * _CUT for t in kept], kept))
        found.append(("R", [_REROLE + cut * _CUT] * 4, list(_NEXT)))
    return tuple(found)


@cache
def _powers(symbol: int) -> list[np.ndarray]:
    """The transition of one turn; ``_power`` appends those of 2, 4, 8... equal turns."""
    step = np.full((4, 4), _NEVER)
    for _, costs, states in _edits(symbol):
        for start, (cost, state) in enumerate(zip(costs, states)):
            if state is not None:
                step[start, state] = min(step[start, state], cost)
    return [_times(_closure(), step)]


def _power(symbol: int, bit: int) -> np.ndarray:
    powers = _powers(symbol)
    while len(powers) <= bit:
        powers.append(_times(powers[-1], powers[-1]))
    return powers[bit]


@lru_cache(100_000)
def _advance(symbol: int, length: int, after: tuple) -> tuple:
    """Costs in front of a run of equal symbols, from those behind it."""
    costs = np.array(after)
    for bit in range(length.bit_length()):
        if length >> bit & 1:
            costs = (_power(symbol, bit) + costs).min(axis=1)
    return tuple(costs.tolist())


def _less(costs: tuple) -> tuple[int, tuple]:
    """(smallest, the others above it): few vectors differ in more than their smallest."""
    least = min(costs)
    return least, tuple(c - least for c in costs)


@lru_cache(100_000)
def _choices(symbol: int, after: tuple) -> tuple:
    """For each state in front of a turn: letters of its cheapest edits up to and with that
    turn, the ASCII-least of equal ones, and the state behind it."""
    before = _advance(symbol, 1, after)
    found = []
    for state in range(4):
        letters = ""
        while True:
            options = {
                letter: states[state] for letter, costs, states in _edits(symbol)
                if states[state] is not None and costs[state] + after[states[state]] == before[state]
            }
            if _INSERT + before[_NEXT[state]] == before[state]:
                options["I"] = None
            letter = min(options)
            letters += letter
            if letter != "I":
                found.append((letters, options[letter]))
                break
            state = _NEXT[state]
    return tuple(found)


def _runs(symbols: list[int]) -> list[tuple[int, int]]:
    return [(symbol, sum(1 for _ in same)) for symbol, same in groupby(symbols)]


def segment_matrix(runs: list[tuple[int, int]]) -> np.ndarray:
    """The costs from each state in front of a segment to each state behind it."""
    total = np.full((4, 4), _NEVER)
    np.fill_diagonal(total, 0)
    for symbol, length in runs:
        for bit in range(length.bit_length()):
            if length >> bit & 1:
                total = _times(total, _power(symbol, bit))
    return total


def solve(
    runs: list[tuple[int, int]], after: tuple, states: tuple[int, ...], last: bool
) -> tuple[tuple, list[tuple[str, int]]]:
    """(costs in front of the runs, for each state in front of them its letters and the state
    behind). ``after``: costs behind them; ``last``: the conversation ends there."""
    behind = []
    costs = after
    for symbol, length in reversed(runs):
        behind.append(costs)
        least, shape = _less(costs)
        costs = tuple(c + least for c in _advance(symbol, length, shape))
    found: list[list] = [[[], state] for state in states]
    for (symbol, length), costs_behind in zip(runs, reversed(behind)):
        shapes = [_less(costs_behind)[1]]
        for _ in range(length - 1):
            shapes.append(_less(_advance(symbol, 1, shapes[-1]))[1])
        for one in found:
            for shape in reversed(shapes):
                letters, one[1] = _choices(symbol, shape)[one[1]]
                one[0].append(letters)
    if last:
        for one in found:
            one[0].append("I" * (_FINAL[one[1]] // _INSERT))
    return costs, [("".join(letters), state) for letters, state in found]


def _segments(table: pa.Table) -> Iterator[tuple]:
    """(conversation, number of its turns, runs, illegal neighbours, first, last) of a block."""
    table = table.sort_by("pos")
    convs, kinds = table.column("conv_id").to_pylist(), table.column("kind").to_pylist()
    symbols = np.where(
        table.column("gone").to_numpy(), _MUST_GO,
        2 * table.column("kind").to_numpy() + table.column("cut").to_numpy(),
    ).tolist()
    at = 0
    for conv, same in groupby(convs):
        end = at + sum(1 for _ in same)
        own = kinds[at:end]
        illegal = sum(pair not in _LEGAL for pair in zip(own, own[1:]))
        yield conv, _runs(symbols[at:end]), illegal, own[0], own[-1]
        at = end


def _solve_block(table: pa.Table) -> list[dict]:
    """The audits of conversations inside the block, matrices of those at its borders."""
    segments = list(_segments(table))
    rows = []
    for i, (conv, runs, illegal, first, last) in enumerate(segments):
        row = {"conv_id": conv, "block": table.column("block")[0].as_py(), "illegal": illegal}
        if 0 < i < len(segments) - 1:
            costs, [(audit, _)] = solve(runs, _FINAL, (0,), True)
            rows.append(row | {"cost": costs[0], "audit": audit})
        else:
            matrix = segment_matrix(runs).ravel().tolist()
            rows.append(row | {"first": first, "last": last, "matrix": matrix})
    return rows


@dataclass
class Repair:
    """``turns``: the given rows in order, with faults. ``edits``: (conv_id, block, illegal,
    cost, audit) of each segment of a conversation. ``repaired``: (conv_id, place, role, text),
    the partitions hold whole conversations in order."""

    turns: DataFrame
    edits: DataFrame
    repaired: DataFrame


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns, from rows sorted by conversation and block, a segment's edits first."""
    current, state, place, letters = object(), 0, 0, iter("")
    for batch in batches:
        out: dict[str, list] = {"conv_id": [], "place": [], "role": [], "text": []}

        def emit(role: str, text: str) -> None:
            nonlocal place
            for column, value in zip(out.values(), (current, place, role, text)):
                column.append(value)
            place += 1

        def insert() -> None:
            nonlocal state
            state = _NEXT[state]
            emit(_ROLE[state], "")

        for conv, audit, kind, role, text in zip(
            *[batch.column(i).to_pylist() for i in range(batch.num_columns)]
        ):
            if audit is not None:
                for letter in letters:  # behind the last turn only insertions are left
                    insert()
                if conv != current:
                    current, state, place = conv, 0, 0
                letters = iter(audit)
                continue
            while (letter := next(letters)) == "I":
                insert()
            if letter == "K":
                state = _KEPT[kind][state]
                emit(role, text)
            elif letter == "R":
                state = _NEXT[state]
                emit(_ROLE[state], text)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["conv_id"], batch.schema.field(0).type), pa.array(out["place"], pa.int64()),
             pa.array(out["role"], pa.string()), pa.array(out["text"], pa.string())],
            names=list(out),
        )
        last_type = batch.schema.field(0).type
    rest = list(letters)
    if rest:
        roles = []
        for _ in rest:
            state = _NEXT[state]
            roles.append(_ROLE[state])
        yield pa.RecordBatch.from_arrays(
            [pa.array([current] * len(rest), last_type),
             pa.array(range(place, place + len(rest)), pa.int64()),
             pa.array(roles, pa.string()), pa.array([""] * len(rest), pa.string())],
            names=["conv_id", "place", "role", "text"],
        )


def repair(rows: DataFrame, block_bits: int = 14) -> Repair:
    """Repair the conversations of rows (conv_id, turn, role, text).

    Turns come by number, NULLs first, those of one number by role and the SHA-256 of the text
    (as hex). A turn without a
    visible character is blank, one whose role and text came before in its conversation is a
    duplicate, and both are deleted; one whose last visible character is not ``.!?`` is cut.
    Deleting costs 4, giving the role that is due (user or assistant) 3, inserting an empty
    turn of the due role 3, leaving a cut turn 3 more; of equally cheap edits the ASCII-least
    letters (D, I, K, R) win. NULL roles and texts are one space, a NULL conv_id is a
    conversation, an empty table gives no rows. One block is held by a task, without its texts.
    """
    turns = _ordered(rows, block_bits)
    conv = turns.schema["conv_id"].dataType.simpleString()
    repeats = _repeats(turns).withColumn("_repeat", F.lit(True))
    repeat = F.coalesce("_repeat", F.lit(False))
    narrow = stored(
        turns.select("block", "pos", "conv_id", "turn", "kind", "blank", "cut")
        .join(repeats, "pos", "left")
        .withColumns({"repeat": repeat, "gone": F.col("blank") | repeat}).drop("_repeat"),
        "turn-symbols",
    )
    signs = narrow.select("block", "pos", "conv_id", "kind", "gone", "cut")
    found = (
        f"conv_id {conv}, block long, illegal long, cost long, audit string, first int, last int,"
        " matrix array<long>"
    )
    kind = pa.schema([
        ("conv_id", _arrow(conv)), ("block", pa.int64()), ("illegal", pa.int64()),
        ("cost", pa.int64()), ("audit", pa.string()), ("first", pa.int32()), ("last", pa.int32()),
        ("matrix", pa.list_(pa.int64())),
    ])

    def solve_block(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(_solve_block(table), kind)

    solved = stored(signs.groupBy("block").applyInArrow(solve_block, found), "segments")

    link_kind = pa.schema([
        ("conv_id", _arrow(conv)), ("block", pa.int64()), ("place", pa.int64()),
        ("illegal", pa.int64()), ("cost", pa.int64()), ("after", pa.list_(pa.int64())),
        ("last", pa.bool_()),
    ])

    def link(table: pa.Table) -> pa.Table:
        """What follows each segment of one conversation: 16 numbers for a block's turns."""
        segments = table.sort_by("block").to_pylist()
        costs, made = _FINAL, []
        for place in reversed(range(len(segments))):
            one = segments[place]
            matrix = np.array(one["matrix"]).reshape(4, 4)
            after, costs = costs, tuple((matrix + np.array(costs)).min(axis=1).tolist())
            illegal = one["illegal"]
            if place:
                illegal += (segments[place - 1]["last"], one["first"]) not in _LEGAL
            made.append({
                "conv_id": one["conv_id"], "block": one["block"], "place": place,
                "illegal": illegal, "cost": 0 if place else costs[0], "after": list(after),
                "last": place == len(segments) - 1,
            })
        return pa.Table.from_pylist(made, link_kind)

    links = solved.where("matrix is not null").groupBy("conv_id").applyInArrow(
        link, f"conv_id {conv}, block long, place long, illegal long, cost long,"
        " after array<long>, last boolean",
    )
    links = stored(links, "segment-links")

    variant_kind = pa.schema([
        *list(link_kind)[:5], ("audits", pa.list_(pa.string())), ("states", pa.list_(pa.int32())),
    ])

    def unroll(table: pa.Table, wanted: pa.Table) -> pa.Table:
        """The edits of border segments for every state that they may be entered in."""
        asked = {one["conv_id"]: one for one in wanted.to_pylist()}
        made = []
        for conv_id, runs, *_ in _segments(table) if asked else ():
            if conv_id in asked:
                one = asked[conv_id]
                states = (0, 1, 2, 3) if one["place"] else (0,)
                _, variants = solve(runs, tuple(one["after"]), states, one["last"])
                own = {name: one[name] for name in ("conv_id", "block", "place", "illegal", "cost")}
                made.append(own | {
                    "audits": [audit for audit, _ in variants],
                    "states": [state for _, state in variants],
                })
        return pa.Table.from_pylist(made, variant_kind)

    variants = signs.groupBy("block").cogroup(links.groupBy("block")).applyInArrow(
        unroll, f"conv_id {conv}, block long, place long, illegal long, cost long,"
        " audits array<string>, states array<int>",
    )

    edit_kind = pa.schema([*[f for f in link_kind if f.name in ("conv_id", "block", "illegal", "cost")],
                           ("audit", pa.string())])

    def choose(table: pa.Table) -> pa.Table:
        state, made = 0, []
        for one in table.sort_by("place").to_pylist():
            own = {name: one[name] for name in ("conv_id", "block", "illegal", "cost")}
            made.append(own | {"audit": one["audits"][state if one["place"] else 0]})
            state = one["states"][state if one["place"] else 0]
        return pa.Table.from_pylist(made, edit_kind)

    names = ["conv_id", "block", "illegal", "cost", "audit"]
    chosen = variants.groupBy("conv_id").applyInArrow(
        choose, f"conv_id {conv}, block long, illegal long, cost long, audit string"
    )
    edits = stored(
        solved.where("matrix is null").select(*names).unionByName(chosen.select(*names)), "edits"
    )
    texts = turns.select(
        "conv_id", "block", "pos", F.lit(None).cast("string").alias("audit"), "kind", "role", "text"
    )
    both = texts.unionByName(
        edits.select("conv_id", "block", F.lit(-1).cast("long").alias("pos"), "audit"),
        allowMissingColumns=True,
    )
    order = ["conv_id", "block", "pos"]
    repaired = (
        both.repartition("conv_id").sortWithinPartitions(*order)
        .select("conv_id", "audit", "kind", "role", "text")
        .mapInArrow(_apply, f"conv_id {conv}, place long, role string, text string")
    )
    return Repair(narrow, edits, repaired)


def _arrow(kind: str) -> pa.DataType:
    plain = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(),
             "string": pa.string()}
    return plain[kind]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of each conversation, whose turns follow each other."""
    current, running, kind = None, None, None
    done: list[tuple] = []
    for batch in batches:
        kind = batch.schema.field(0).type
        for conv, role, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            if running is None or conv != current:
                if running is not None:
                    done.append((current, running.hexdigest()))
                current, running = conv, hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(f"{role}:{text}".encode())
        if done:
            convs, values = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array(convs, kind), pa.array(values)], names=["conv_id", "repaired_sha256"]
            )
            done = []
    if running is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([current], kind), pa.array([running.hexdigest()])],
            names=["conv_id", "repaired_sha256"],
        )


def report(rows: DataFrame, mended: Repair) -> DataFrame:
    """One row per conversation of ``rows``: gaps in its numbers, faults by their first kind,
    illegal neighbours, cost, letters of all edits, digest of the repaired turns."""
    conv = mended.edits.schema["conv_id"].dataType.simpleString()
    first = {
        "blank": F.col("blank"), "duplicate": ~F.col("blank") & F.col("repeat"),
        "truncated": ~F.col("blank") & ~F.col("repeat") & F.col("cut"),
    }
    counted = mended.turns.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).cast("long").alias("gaps"),
        *[F.count_if(test).alias(name) for name, test in first.items()],
    )
    letters = F.array_sort(F.collect_list(F.struct("block", "audit")))
    audits = mended.edits.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(letters, lambda one: one["audit"]), "").alias("audit"),
    )
    digests = mended.repaired.select("conv_id", "role", "text").mapInArrow(
        _digests, f"conv_id {conv}, repaired_sha256 string"
    )
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = rows.select("conv_id").distinct()
    for part in (counted, audits, digests):
        every = every.unionByName(part, allowMissingColumns=True)
    empty = hashlib.sha256().hexdigest()
    return every.groupBy("conv_id").agg(
        *[F.coalesce(F.max(name), F.lit(0)).cast("long").alias(name) for name in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(empty)).alias("repaired_sha256"),
    )
