"""Suffix-array dedup: removes every byte of a long string that also starts earlier.

A window is a string of ``length`` bytes inside one document. Equal windows have the same
smallest 32-gram (by hash, the leftmost of equal ones) at the same offset. So each window
belongs to one anchor, consecutive windows with the same anchor form an interval, and windows
can only be equal if their anchors have the same hash.

1. Batches of documents exchange their anchor hashes; those that occur once are done, which
   leaves out nearly all text that is not repeated (``regweave.llm.packed``).
2. The intervals of repeated anchors are dealt by anchor hash to shards. A shard builds a
   suffix array of its texts by Larsson-Sadakane refinement and the common prefixes by
   Kasai's rule, both in numpy. Neighbours with ``length`` common bytes are equal windows, and
   the earliest one is marked as a first occurrence.
3. Anchors above ``hot`` occurrences would fill a shard. Their windows are sorted in each
   batch instead, and the sorted lists of all batches are merged by binary search, in parts by
   the leading bits of the windows' 128-bit hashes.
4. Back in its batch, a document loses the bytes of all windows with a repeated anchor that
   are no first occurrence.

Groups of any size are therefore met in pieces: a shard has at most ``hot`` intervals of one
anchor, and a merged window arrives once from each batch.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import as_bytes
from regweave.llm.packed import (
    PACKED, in_batches, pack, parts_for, positions, repeated, unpack, whole_groups,
)

_STEP = 256 << 10
_SHARD_BYTES = 1 << 19
_BATCH_BYTES = 2 << 20
_NO_ID = np.iinfo(np.int64).max
_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _random.integers(1, 2**64, (2, 256), np.uint64)
_FACTORS = _random.integers(1, 2**63, (2, 8), np.uint64) * np.uint64(2) + np.uint64(1)
_ROWS = (
    "kind int, key long, batch long, doc_id long, tie long, row int, start int, content binary"
)
_MARKS = "batch long, rows binary, starts binary, counts binary"


def gram_hashes(data: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """A hash of each ``length`` bytes of ``data``, from hashes of powers of two."""
    level = _BYTE_VALUES[which][data]
    total, done, bit = None, 0, 0
    count = len(data) - length + 1
    while True:
        if length >> bit & 1:
            part = level[done : done + count]
            total = part if total is None else total * _FACTORS[which][bit] + part
            done += 1 << bit
        bit += 1
        if not length >> bit:
            return total
        half = 1 << bit - 1
        level = level[:-half] * _FACTORS[which][bit] + level[half:]


def intervals(
    data: np.ndarray, ends: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of windows, anchor hash) over documents that end at ``ends``."""
    gram = 32 if length >= 64 else 1 << max(0, length.bit_length() - 2)
    count = len(data) - length + 1
    if count < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = gram_hashes(data, gram)
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(29)
    best, place = hashes, np.arange(len(hashes), dtype=np.int32)
    span, wanted = 1, length - gram + 1
    while span < wanted:
        shift = min(span, wanted - span)
        later = best[shift:] < best[:-shift]
        place = np.where(later, place[shift:], place[:-shift])
        best = np.where(later, best[shift:], best[:-shift])
        span += shift
    starts = np.concatenate([[0], ends[:-1]])
    long = ends - starts >= length
    step = np.zeros(count + 1, np.int32)
    np.add.at(step, starts[long], 1)
    np.add.at(step, ends[long] - length + 1, -1)
    valid = np.cumsum(step[:count]) > 0
    change = np.concatenate([[True], place[1:count] != place[: count - 1]])
    change[1:] |= ~valid[:-1]
    begin = np.flatnonzero(change & valid)
    cuts = np.append(np.flatnonzero(change | ~valid), count)
    counts = cuts[np.searchsorted(cuts, begin, side="right")] - begin
    return begin, counts, hashes[place[begin]]


class _Batch:
    """The documents of a batch in the order of their ids, given in pieces of bounded size."""

    def __init__(self, table: pa.Table):
        texts = as_bytes(table.column("text").combine_chunks()) if table.num_rows else []
        ids = table.column("doc_id").to_pylist()
        # Rows with the same id come in the order of a hash of their texts.
        keyed = [
            (_NO_ID if i is None else i, xxhash.xxh3_64_intdigest(t) - 2**63, t, i)
            for i, t in zip(ids, texts)
        ]
        keyed.sort(key=lambda row: row[:3])
        self.order = np.array([row[0] for row in keyed], np.int64)
        self.ties = np.array([row[1] for row in keyed], np.int64)
        self.texts = [row[2] for row in keyed]
        self.ids = [row[3] for row in keyed]

    def pieces(self, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, where the piece begins in it, bytes, ends of rows).

        A piece has whole rows, or a part of a long one that overlaps the next part by
        ``length - 1`` bytes, so that each window of the row lies in one part.
        """
        first, size = 0, 0
        for row, text in enumerate(self.texts):
            if len(text) > 2 * _STEP:
                if row > first:
                    yield self._rows(first, row)
                raw = np.frombuffer(text, np.uint8)
                for start in range(0, len(text), _STEP):
                    part = raw[start : start + _STEP + length - 1]
                    yield row, start, part, np.array([len(part)])
                first, size = row + 1, 0
                continue
            size += len(text)
            if size >= _STEP:
                yield self._rows(first, row + 1)
                first, size = row + 1, 0
        if first < len(self.texts):
            yield self._rows(first, len(self.texts))

    def _rows(self, first: int, end: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        own = self.texts[first:end]
        return first, 0, np.frombuffer(b"".join(own), np.uint8), np.cumsum([len(t) for t in own])


def _batch_keys(length: int, parts: int):
    def run(table: pa.Table) -> pa.Table:
        pieces = _Batch(table).pieces(length)
        found = [intervals(data, ends, length)[2] for _, _, data, ends in pieces]
        batch = table.column("batch")[0].as_py()
        return pa.Table.from_batches([pack(batch, np.concatenate(found), parts)])

    return run


def _batch_intervals(length: int, parts: int, hot: int):
    """Intervals of repeated anchors, each text once, and sorted windows of frequent ones."""

    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        keys, totals = unpack(shared)
        batch = _Batch(table)
        number = table.column("batch")[0].as_py() if table.num_rows else None
        kinds, values, rows, starts, contents = [], [], [], [], []
        windows: list[tuple] = []
        seen: set[bytes] = set()
        for first, base, data, ends in batch.pieces(length):
            begin, counts, anchors = intervals(data, ends, length)
            at = positions(keys, anchors)
            chosen = np.flatnonzero(at >= 0)
            if not len(chosen):
                continue
            row = np.searchsorted(ends, begin, side="right")
            offset = base + begin - np.concatenate([[0], ends])[row]
            frequent = totals[at] > hot
            raw = data.tobytes()
            for i in chosen[~frequent[chosen]].tolist():
                content = raw[begin[i] : begin[i] + counts[i] + length - 1]
                if content not in seen:  # rows come in order, so the first one stays
                    seen.add(content)
                    kinds.append(0)
                    values.append(anchors[i])
                    rows.append(first + row[i])
                    starts.append(offset[i])
                    contents.append(content)
            many = chosen[frequent[chosen]]
            if len(many):
                which = np.repeat(many, counts[many])
                inside = np.arange(len(which)) - np.repeat(
                    np.cumsum(counts[many]) - counts[many], counts[many]
                )
                place = begin[which] + inside
                windows.append((
                    gram_hashes(data, length, 0)[place], gram_hashes(data, length, 1)[place],
                    first + row[which], offset[which] + inside,
                ))
        if windows:
            one, two, row, start = (np.concatenate(column) for column in zip(*windows))
            one, kept = np.unique(one, return_index=True)  # the first of equal ones
            two, row, start = two[kept], row[kept].astype(np.int32), start[kept].astype(np.int32)
            bits = np.uint64(65 - parts.bit_length())
            part = (one >> bits).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            for begin, end in zip(cuts, [*cuts[1:], len(part)]):
                own = slice(begin, end)
                kinds.append(1)
                values.append(np.uint64(part[begin]))
                rows.append(0)
                starts.append(0)
                contents.append(b"".join(column.tobytes() for column in (
                    one[own], two[own], batch.order[row[own]], batch.ties[row[own]],
                    row[own], start[own],
                )))
        rows_array = np.array(rows, np.int64)
        return pa.table(
            [
                pa.array(kinds, pa.int32()),
                pa.array(np.array(values, np.uint64).view(np.int64)),
                pa.array([number] * len(kinds), pa.int64()),
                pa.array(batch.order[rows_array] if kinds else [], pa.int64()),
                pa.array(batch.ties[rows_array] if kinds else [], pa.int64()),
                pa.array(rows, pa.int32()), pa.array(starts, pa.int32()),
                pa.array(contents, pa.binary()),
            ],
            names=["kind", "key", "batch", "doc_id", "tie", "row", "start", "content"],
        )

    return run


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank of each suffix) of symbols from 0 to 256.

    Larsson-Sadakane: after suffixes are sorted by their first symbols, only groups that are
    still equal are sorted again, by the ranks of the suffixes ``depth`` further on, and the
    depth doubles each time.
    """
    size = len(text)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(6, np.uint64)])
    packed = np.zeros(size, np.uint64)
    for i in range(7):  # seven symbols of nine bits
        packed = packed << np.uint64(9) | padded[i : i + size]
    order = np.argsort(packed, kind="stable")
    sorted_keys = packed[order]
    new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    rank = np.empty(size, np.int64)
    group = np.maximum.accumulate(np.where(new, np.arange(size), 0))
    rank[order] = group
    depth = 7
    while True:
        alone = new & np.append(new[1:], True)
        places = np.flatnonzero(~alone)  # in the suffix array
        if not len(places):
            return order, rank
        suffixes = order[places]
        further = suffixes + depth
        second = np.where(further < size, rank[np.minimum(further, size - 1)] + 1, 0)
        moved = np.argsort(group[places] * np.int64(size + 1) + second, kind="stable")
        order[places] = suffixes[moved]
        second, owner = second[moved], group[places]
        split = np.concatenate([[True], (second[1:] != second[:-1]) | (owner[1:] != owner[:-1])])
        new[places] = split
        group = np.maximum.accumulate(np.where(new, np.arange(size), 0))
        rank[order[places]] = group[places]
        depth *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix, by text position, with the one before it in order.

    Kasai: going from one position to the next, the common prefix shrinks by at most one, and
    by exactly one where both suffixes are preceded by the same symbol. So symbols are compared
    only at the other positions, and the rest follows from the last of those.
    """
    size = len(text)
    before = np.empty(size, np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    own = np.arange(size)
    follows = np.zeros(size, bool)
    usable = (own > 0) & (before > 0)
    follows[usable] = text[own[usable] - 1] == text[before[usable] - 1]
    compared = np.flatnonzero(~follows & (before >= 0))
    padded = np.concatenate([text.astype(np.uint64), np.full(8, 511, np.uint64)])
    words = np.zeros(size + 2, np.uint64)
    for i in range(7):
        words[:size] = words[:size] << np.uint64(9) | padded[i : i + size]
    prefix = np.zeros(size, np.int64)
    active, done = compared, np.zeros(len(compared), np.int64)
    while len(active):
        a, b = active + done, before[active] + done
        inside = np.maximum(a, b) + 7 <= size
        same = inside & (words[np.minimum(a, size)] == words[np.minimum(b, size)])
        stopped = ~same
        ends, length = active[stopped], done[stopped]
        for _ in range(7):
            a, b = ends + length, before[ends] + length
            ok = np.maximum(a, b) < size
            ok[ok] = text[a[ok]] == text[b[ok]]
            prefix[ends[~ok]] = length[~ok]
            ends, length = ends[ok], length[ok] + 1
        prefix[ends] = length
        active, done = active[same], done[same] + 7
    source = np.maximum.accumulate(np.where(follows, 0, own))
    return np.maximum(0, np.where(follows, prefix[source] - (own - source), prefix))


def first_windows(contents: list[bytes], length: int) -> list[np.ndarray]:
    """For texts in order: which windows of each occur in no earlier place of any."""
    sizes = np.array([len(c) for c in contents])
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(contents), np.int16)  # 0 separates
    for start, content in zip(starts, contents):
        text[start : start + len(content)] = np.frombuffer(content, np.uint8)
        text[start : start + len(content)] += 1
    order, _ = suffix_array(text)
    prefix = common_prefixes(text, order)
    new = prefix[order] < length
    new[0] = True
    groups = np.flatnonzero(new)
    first = np.zeros(len(text), bool)
    first[np.minimum.reduceat(order, groups)] = True
    return [first[s : s + n - length + 1] for s, n in zip(starts.tolist(), sizes.tolist())]


class _Marks:
    """First occurrences, as runs of windows, packed by batch."""

    def __init__(self):
        self.found: dict[int, list] = defaultdict(list)
        self.count = 0

    def add(self, batch: int, row: int, start: int, count: int) -> None:
        self.found[batch].append((row, start, count))
        self.count += 1

    def add_flags(self, batch: int, row: int, start: int, first: np.ndarray) -> None:
        edges = np.flatnonzero(np.diff(first, prepend=False, append=False))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            self.add(batch, row, start + begin, end - begin)

    def take(self) -> pa.RecordBatch:
        packed = [np.array(runs_, np.int32).T.copy() for runs_ in self.found.values()]
        made = pa.RecordBatch.from_arrays(
            [pa.array(list(self.found), pa.int64())]
            + [pa.array([p[i].tobytes() for p in packed], pa.binary()) for i in range(3)],
            names=["batch", "rows", "starts", "counts"],
        )
        self.found, self.count = defaultdict(list), 0
        return made


def _solve(rows: list[tuple], length: int, marks: _Marks) -> None:
    """Marks for the intervals of whole anchors: (key, doc_id, tie, row, start, batch, content)."""
    rows.sort(key=lambda r: r[1:5])
    distinct: dict[bytes, tuple] = {}
    for row in rows:
        distinct.setdefault(row[6], row)
    several = defaultdict(int)
    for row in distinct.values():
        several[row[0]] += 1
    compared = []
    for key, _, _, row, start, batch, content in distinct.values():
        if several[key] == 1:
            marks.add(batch, row, start, len(content) - length + 1)
        else:
            compared.append((batch, row, start, content))
    if compared:
        flags = first_windows([c[3] for c in compared], length)
        for (batch, row, start, _), first in zip(compared, flags):
            marks.add_flags(batch, row, start, first)


def _merge(one: tuple, other: tuple) -> tuple:
    """Two lists of windows, sorted by hash, as one: of equal windows the earlier stays."""
    if len(one[0]) < len(other[0]):
        one, other = other, one
    at = np.searchsorted(one[0], other[0])
    inside = np.minimum(at, len(one[0]) - 1)
    same = (one[0][inside] == other[0]) & (one[1][inside] == other[1])
    mine, theirs = inside[same], np.flatnonzero(same)
    earlier = np.zeros(len(mine), bool)
    undecided = np.ones(len(mine), bool)
    for column in range(2, 6):  # doc_id, tie, row, start
        a, b = one[column][mine], other[column][theirs]
        earlier |= undecided & (b < a)
        undecided &= a == b
    merged = []
    for a, b in zip(one, other):
        a = a.copy()
        a[mine[earlier]] = b[theirs[earlier]]
        merged.append(np.insert(a, at[~same], b[~same]))
    return tuple(merged)


def _merge_all(table: pa.Table, marks: _Marks) -> None:
    lists = []
    for batch, content in zip(table.column("batch").to_pylist(), table.column("content").to_pylist()):
        count = len(content) // 40
        wide = [np.frombuffer(content, t, count, 8 * count * i)
                for i, t in enumerate((np.uint64, np.uint64, np.int64, np.int64))]
        narrow = [np.frombuffer(content, np.int32, count, 32 * count + 4 * count * i) for i in (0, 1)]
        lists.append((*wide, *narrow, np.full(count, batch)))
    while len(lists) > 1:
        pairs = [_merge(a, b) for a, b in zip(lists[::2], lists[1::2])]
        lists = pairs + ([lists[-1]] if len(lists) % 2 else [])
    _, _, _, _, row, start, batch = lists[0]
    order = np.lexsort((start, row, batch))
    row, start, batch = row[order], start[order], batch[order]
    cut = np.ones(len(row), bool)
    cut[1:] = (np.diff(start) != 1) | (np.diff(row) != 0) | (np.diff(batch) != 0)
    begin = np.flatnonzero(cut)
    counts = np.diff(np.append(begin, len(row)))
    for b, r, s, n in zip(*[x.tolist() for x in (batch[begin], row[begin], start[begin], counts)]):
        marks.add(b, r, s, n)


def _shard(length: int):
    """Marks of first occurrences, from rows sorted by kind and key."""
    names = ("key", "doc_id", "tie", "row", "start", "batch", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = _Marks()
        for table in whole_groups(batches, "key", _SHARD_BYTES):
            kinds = table.column("kind").to_numpy()
            cut = int(np.searchsorted(kinds, 1))
            if cut:
                own = table.slice(0, cut)
                _solve(list(zip(*[own.column(name).to_pylist() for name in names])), length, marks)
            frequent = table.slice(cut)
            keys = frequent.column("key").to_numpy()
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for begin, end in zip(edges, edges[1:]):
                if begin < end:
                    _merge_all(frequent.slice(begin, end - begin), marks)
            if marks.count > 50_000:
                yield marks.take()
        yield marks.take()

    return run


def _remove(length: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        shared = answers.filter(pa.compute.is_valid(answers.column("keys")))
        keys, _ = unpack(shared)
        firsts = answers.filter(pa.compute.is_null(answers.column("keys")))
        row, start, count = (
            np.frombuffer(b"".join(firsts.column(name).to_pylist()), np.int32)
            for name in ("rows", "starts", "counts")
        )
        order = np.argsort(row, kind="stable")
        row, start, count = row[order], start[order], count[order]
        batch = _Batch(table)
        spans: list[list] = [[] for _ in batch.texts]
        for first, base, data, ends in batch.pieces(length):
            begin, windows, anchors = intervals(data, ends, length)
            found = positions(keys, anchors) >= 0
            step = np.zeros(len(data) + 1, np.int32)
            np.add.at(step, begin[found], 1)
            np.add.at(step, (begin + windows)[found], -1)
            own = slice(*np.searchsorted(row, [first, first + len(ends)]))
            starts = np.concatenate([[0], ends])
            at = starts[row[own] - first] + start[own] - base
            # The first windows of other parts of a long row lie outside.
            low, high = np.clip(at, 0, len(data)), np.clip(at + count[own], 0, len(data))
            np.add.at(step, low, -1)
            np.add.at(step, high, 1)
            gone = np.flatnonzero(np.cumsum(step[:-1]) > 0)  # windows that are not first
            rows_gone = np.searchsorted(ends, gone, side="right")
            new = np.ones(len(gone), bool)  # windows that touch no earlier one of their row
            new[1:] = (gone[1:] > gone[:-1] + length) | (rows_gone[1:] != rows_gone[:-1])
            last = np.append(new[1:], True)[: len(gone)]
            offset = base - starts[rows_gone]
            for r, s, e in zip(
                (first + rows_gone[new]).tolist(), (gone + offset)[new].tolist(),
                (gone + offset)[last].tolist(),
            ):
                if spans[r] and s <= spans[r][-1]["end"]:  # goes on from the part before
                    spans[r][-1]["end"] = e + length
                else:
                    spans[r].append({"start": s, "end": e + length})
        kept = []
        for text, own in zip(batch.texts, spans):
            edges = [0, *[edge for span in own for edge in span.values()], len(text)]
            kept.append(b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2])))
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table(
            [
                pa.array(batch.ids, pa.int64()),
                pa.array([len(text) for text in batch.texts], pa.int64()),
                pa.array(spans, kind), pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "removed", "kept"],
        )

    return run


def dedup(
    docs: DataFrame,
    length: int = 100,
    doc_id: str = "doc_id",
    text: str = "text",
    hot: int = 2000,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, removed (byte ranges) and kept (bytes).

    A byte is removed if a string of ``length`` bytes around it also starts earlier: in a row
    with a smaller id, or before in the same row. NULL ids come last; rows with the same id
    come in the order of a hash of their texts, and of rows equal in both one is first. NULL
    and short texts lose nothing. Ids must be integers. An empty table gives no rows.
    """
    rows, size = in_batches(docs, doc_id, text, _BATCH_BYTES)
    by_batch = rows.groupBy("batch")
    keys = by_batch.applyInArrow(_batch_keys(length, parts_for(size // 32)), PACKED)
    shared = repeated(keys)
    found = by_batch.cogroup(shared.groupBy("batch")).applyInArrow(
        _batch_intervals(length, parts_for(size), hot), _ROWS
    )
    marks = (
        found.repartition("kind", "key").sortWithinPartitions("kind", "key")
        .mapInArrow(_shard(length), _MARKS)
    )
    answers = shared.unionByName(marks, allowMissingColumns=True)
    return by_batch.cogroup(answers.groupBy("batch")).applyInArrow(
        _remove(length),
        "doc_id long, n_bytes long, removed array<struct<start:int,end:int>>, kept binary",
    )


def report(deduped: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, and the digest of what is kept."""
    return deduped.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
