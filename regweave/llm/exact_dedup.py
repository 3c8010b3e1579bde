"""Exact dedup by two passes over a counting Bloom filter.

Pass one builds a filter of two-step counters: a cell knows "hit once" and "hit more
often". Pass two asks it for every hash. A hash whose cells were all hit more than once is
possibly repeated, and only such rows are shuffled and grouped; all others are certainly
unique and pass straight through. A false alarm costs a shuffled row, nothing else.

The filter is a table of blocks of 32 KB; the number of blocks grows with the rows. Blocks
are broadcast in rounds of at most ``round_bytes``, each round asking only for the hashes
that belong to its blocks, so that neither driver nor executors hold more than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import append_columns, attach_groups, stored

_BLOCK_BITS = 1 << 18
_CELLS = 4
_FLUSH = 1 << 20


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _cells(hashes: np.ndarray) -> np.ndarray:
    """The cells, within its block, of each hash: one column each."""
    mixed = hashes * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    first, step = mixed & np.uint64(0xFFFFFFFF), (mixed >> np.uint64(32)) | np.uint64(1)
    return np.stack(
        [(first + step * np.uint64(i)) & np.uint64(_BLOCK_BITS - 1) for i in range(_CELLS)], axis=1
    ).astype(np.uint32)


def _blocks(hashes: np.ndarray, count: int) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(count)).astype(np.int64)


def _as_hashes(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _partial_filter(count: int):
    def emit(hashes: np.ndarray) -> pa.RecordBatch:
        # A repeated hash must saturate its cells, so each hash counts twice at most here.
        unique, times = np.unique(hashes, return_counts=True)
        hashes = np.concatenate([unique, unique[times > 1]])
        blocks = _blocks(hashes, count)
        order = np.argsort(blocks, kind="stable")
        names, starts = np.unique(blocks[order], return_index=True)
        cells = _cells(hashes[order])
        payload = [part.tobytes() for part in np.split(cells, starts[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(payload, pa.binary())], names=["block", "cells"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(_as_hashes(batch.column(0)))
            size += len(held[-1])
            if size >= _FLUSH:
                yield emit(np.concatenate(held))
                held, size = [], 0
        if size:
            yield emit(np.concatenate(held))

    return run


def _merge_block(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counters = np.zeros(_BLOCK_BITS, np.uint8)
    for batch in rows:
        for payload in batch.column("cells").to_pylist():
            found = np.bincount(np.frombuffer(payload, np.uint32), minlength=_BLOCK_BITS)
            counters = np.minimum(counters + np.minimum(found, 2).astype(np.uint8), 2)
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int64()), pa.array([np.packbits(counters > 1).tobytes()])],
        names=["block", "bits"],
    )


def flag_repeats(
    rows: DataFrame,
    key: str,
    flag: str = "maybe_repeated",
    keys: DataFrame | None = None,
    bits_per_key: int = 12,
    round_bytes: int = 32 << 20,
) -> DataFrame:
    """``rows`` with a boolean: False if no other row has its 64-bit ``key``, else True.

    True may be wrong now and then, False never is. ``keys`` may name a cheaper table with
    the same key column. Keys must not be NULL.
    """
    keys = rows if keys is None else keys
    spark = rows.sparkSession
    total = keys.count()
    count = max(1, -(-total * bits_per_key // _BLOCK_BITS))
    partial = keys.select(key).mapInArrow(_partial_filter(count), "block long, cells binary")
    merged = partial.groupBy("block").applyInArrow(_merge_block, "block long, bits binary")
    per_round = max(1, round_bytes * 8 // _BLOCK_BITS)
    rounds = -(-count // per_round)
    if rounds > 1:
        merged = stored(merged, "bloom")

    def asker(shared):
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            numbers, bits = shared.value
            hashes = _as_hashes(batch.column(key))
            if not len(numbers):
                return [pa.array(np.ones(len(hashes), bool))]
            blocks = _blocks(hashes, count)
            at = np.minimum(np.searchsorted(numbers, blocks), len(numbers) - 1)
            found = numbers[at] == blocks
            for cell in _cells(hashes).T:
                found &= (bits[at, cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
            return [pa.array(found)]

        return compute

    result = None
    unsigned = F.shiftrightunsigned(F.col(key), 20)
    for number in range(rounds):
        mine = F.pmod(F.col("block"), F.lit(rounds)) == number
        held = sorted(merged.where(mine).toLocalIterator(), key=lambda row: row["block"])
        bits = [np.frombuffer(row["bits"], np.uint8) for row in held]
        shared = spark.sparkContext.broadcast(
            (np.array([row["block"] for row in held], np.int64), np.stack(bits) if bits else None)
        )
        chosen = rows
        if rounds > 1:
            chosen = rows.where(F.pmod(F.pmod(unsigned, F.lit(count)), F.lit(rounds)) == number)
        asked = append_columns(chosen, f"`{flag}` boolean", asker(shared))
        result = asked if result is None else result.unionByName(asked)
    return result


def duplicate_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", purpose: str = "digests"
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are compared after white space is normalised; NULL counts as empty. The row with
    the smallest id stays, a NULL id only if all are NULL; of rows that also share the id,
    exactly one stays. An empty table gives an empty result.
    """
    digests = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        purpose,
    ).withColumn("key", F.xxhash64("digest"))
    flagged = flag_repeats(digests, "key")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    maybe = flagged.where("maybe_repeated")
    groups = maybe.groupBy("digest").agg(
        F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    joined = attach_groups(maybe, groups, ["digest"], "group_size", digests.count())
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    repeated = joined.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        sha,
    )
    unique = flagged.where("not maybe_repeated").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        sha,
    )
    return unique.unionByName(repeated)


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows whose text is certainly unique are not moved; of the others, those named by their
    class stay. Rows that share text and id count as one.
    """
    names = docs.columns
    digest = F.sha2(normalised(F.col(text)), 256)
    keyed = docs.withColumns({"__rw_digest": digest, "__rw_key": F.xxhash64(F.unhex(digest))})
    keys = stored(keyed.select("__rw_key", "__rw_digest", F.col(doc_id).alias("__rw_id")), "keys")
    flagged = flag_repeats(keyed, "__rw_key", "__rw_maybe", keys)
    rank = F.struct(F.col("__rw_id").isNull().alias("none"), "__rw_id")
    best = (
        flag_repeats(keys, "__rw_key", "__rw_maybe").where("__rw_maybe")
        .groupBy("__rw_digest").agg(F.min(rank).alias("best"))
        .select("__rw_digest", F.col("best.__rw_id").alias("__rw_best"))
    )
    maybe = flagged.where("__rw_maybe")
    same = (maybe["__rw_digest"] == best["__rw_digest"]) & maybe[doc_id].eqNullSafe(best["__rw_best"])
    staying = maybe.join(best, same, "left_semi").dropDuplicates(["__rw_digest", doc_id])
    return flagged.where("not __rw_maybe").select(*names).unionByName(staying.select(*names))
