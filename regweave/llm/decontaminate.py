"""Benchmark decontamination: a broadcast set of test n-grams against every token window.

The benchmark is the stated query set. Its windows are collected in blocks of bounded size
(``block_bytes`` of benchmark text); each block is broadcast and compared with all
documents in one narrow pass. One block is the usual case; more are applied one after the
other, each to the written result of the one before.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import WORD_TABLE, alnum_words, append_columns, as_bytes, stored

_HITS = "hit_words array<struct<start:int,end:int>>, hit_items array<string>, n_words long"
_WORD = re.compile(rb"[^ ]+")


class WindowSet:
    """All windows of a block of items as word numbers, with the items they come from."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, set]] = {}
        for item, text in items:
            words = alnum_words((text or "").encode())
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            length = min(width, len(numbers))
            for i in range(len(numbers) - length + 1 if length else 0):
                key = np.array(numbers[i : i + length], np.int32).tobytes()
                self.windows.setdefault(length, {}).setdefault(key, set()).add(item)
        self.hashes = {
            length: np.unique(self._hash(np.frombuffer(b"".join(found), np.int32), length)[::length])
            for length, found in self.windows.items()
        }

    @staticmethod
    def _hash(numbers: np.ndarray, length: int) -> np.ndarray:
        """One hash for each place; windows of equal words have equal hashes."""
        count = len(numbers) - length + 1
        total = np.zeros(max(0, count), np.uint64)
        for i in range(length if count > 0 else 0):
            total *= np.uint64(0x9E3779B97F4A7C15)
            total += numbers[i : i + count].astype(np.uint64)
        return total

    def occurrences(self, numbers: np.ndarray):
        """(start, length, items) of every window that occurs in ``numbers`` (-1: unknown)."""
        known = np.concatenate([[0], np.cumsum(numbers < 0)])
        for length, found in self.windows.items():
            if len(numbers) < length:
                continue
            starts = np.flatnonzero(known[length:] == known[:-length])
            hashes = self._hash(numbers, length)[starts]
            table = self.hashes[length]
            at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
            for start in starts[table[at] == hashes].tolist():
                items = found.get(numbers[start : start + length].tobytes())
                if items is not None:
                    yield start, length, items


def _scan_block(text: str, shared, previous: bool):
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        windows: WindowSet = shared.value
        get = windows.vocabulary.get
        parts, counts = [], []
        for data in as_bytes(batch.column(text)):
            words = alnum_words(data)
            counts.append(len(words))
            numbers = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
            parts += [numbers, np.array([-1], np.int32)]  # no window crosses documents
        ends = np.cumsum(np.array(counts) + 1)
        hits: list[list] = [[] for _ in counts]
        items: list[set] = [set() for _ in counts]
        if previous:
            for i, (old, ids) in enumerate(
                zip(batch.column("hit_words").to_pylist(), batch.column("hit_items").to_pylist())
            ):
                hits[i] += [(span["start"], span["end"]) for span in old]
                items[i] |= set(ids)
        for start, length, ids in windows.occurrences(np.concatenate(parts)):
            i = int(np.searchsorted(ends, start, side="right"))
            first = start - int(ends[i]) + counts[i] + 1
            hits[i].append((first, first + length))
            items[i] |= {item for item in ids if item is not None}
        merged = [_merge(spans) for spans in hits]
        span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return [
            pa.array([[{"start": s, "end": e} for s, e in spans] for spans in merged], span_type),
            pa.array([sorted(ids) for ids in items], pa.list_(pa.string())),
            pa.array(counts, pa.int64()),
        ]

    return compute


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = 10,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """``docs`` with ``hit_words`` (merged word ranges), ``hit_items`` and ``n_words``.

    A window is ``width`` consecutive item words, or all words of a shorter item. NULL and
    empty texts, on either side, have no words and no windows. Items without an id mark
    words but are not listed; repeated items count once. An empty benchmark hits nothing.
    Input columns with the names of the new ones are replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("string").alias("i"), F.col(item_text).alias("t"))
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast(
            WindowSet([tuple(row) for row in chosen.toLocalIterator()], width)
        )
        docs = append_columns(docs, _HITS, _scan_block(text, shared, previous=block > 0))
        if blocks > 1:
            docs = stored(docs, "decontaminate")
    return docs


def report(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document: hit words, items, their digest and the verdict."""
    hit = F.aggregate(
        "hit_words", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"]
    )
    return scanned.select(
        doc_id,
        "n_words",
        hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def remove_documents(scanned: DataFrame, columns: list[str]) -> DataFrame:
    """The documents without any hit word."""
    return scanned.where(F.size("hit_words") == 0).select(*columns)


def remove_spans(scanned: DataFrame, text: str = "text") -> DataFrame:
    """All documents, without the characters from a hit range's first to its last word."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        cleaned = []
        spans = batch.column("hit_words").to_pylist()
        for value, data, hit in zip(batch.column(text), as_bytes(batch.column(text)), spans):
            if hit:
                places = [m.span() for m in _WORD.finditer(data.translate(WORD_TABLE))]
                kept, last = [], 0
                for span in hit:
                    kept.append(data[last : places[span["start"]][0]])
                    last = places[span["end"] - 1][1]
                cleaned.append(b"".join([*kept, data[last:]]).decode())
            else:
                cleaned.append(value.as_py())
        return [pa.array(cleaned, pa.string())]

    return append_columns(scanned, f"`{text}` string", compute)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
