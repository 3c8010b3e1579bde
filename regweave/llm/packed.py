"""Keys that occur in more than one place, found by exchanging packed arrays.

Documents are dealt over batches of a few MB by a hash of the row. A batch reduces its keys
(64-bit hashes) to distinct ones with counts and sends them, packed as arrays and divided by
the keys' leading bits, to parts; a part adds up the counts and sends each batch those of its
keys that occurred at least twice in all. A key costs eight bytes and a count on the way, a
frequent one arrives once per batch, and the size of a part is set by the number of parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PACKED = "part int, batch long, keys binary, counts binary"


def in_batches(
    docs: DataFrame, doc_id: str, text: str, batch_bytes: int = 4 << 20
) -> tuple[DataFrame, int]:
    """Rows (batch, doc_id, text) and the bytes of all texts. Equal rows share a batch."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    batches = max(1, -(-size // batch_bytes))
    row = F.xxhash64(F.col(doc_id), F.xxhash64(F.col(text)))
    return docs.select(
        F.pmod(row, F.lit(batches)).alias("batch"),
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
    ), size


def parts_for(keys: int, per_part: int = 1 << 20) -> int:
    """A power of two of parts for about so many keys."""
    return 1 << max(6, (max(1, keys) // per_part).bit_length())


def pack(batch: int, keys: np.ndarray, parts: int) -> pa.RecordBatch:
    """The rows of a batch's keys (uint64, with repeats)."""
    return pack_counted(batch, *np.unique(keys, return_counts=True), parts)


def pack_counted(
    batch: int, distinct: np.ndarray, counts: np.ndarray, parts: int
) -> pa.RecordBatch:
    """The rows of a batch's keys, in order, with their counts."""
    counts = np.minimum(counts, 0xFFFFFFFF).astype(np.uint32)
    bits = parts.bit_length() - 1
    bounds = np.arange(1, parts, dtype=np.uint64) << np.uint64(64 - bits)
    cuts = np.concatenate([[0], np.searchsorted(distinct, bounds), [len(distinct)]])
    used = [i for i in range(parts) if cuts[i] < cuts[i + 1]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(used, pa.int32()),
            pa.array([batch] * len(used), pa.int64()),
            pa.array([distinct[cuts[i] : cuts[i + 1]].tobytes() for i in used], pa.binary()),
            pa.array([counts[cuts[i] : cuts[i + 1]].tobytes() for i in used], pa.binary()),
        ],
        names=["part", "batch", "keys", "counts"],
    )


def _add_up(table: pa.Table) -> pa.Table:
    batches = table.column("batch").to_pylist()
    keys = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
    counts = [np.frombuffer(c, np.uint32) for c in table.column("counts").to_pylist()]
    lengths = [len(k) for k in keys]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(place, np.concatenate(counts), len(distinct))[place]
    cuts = np.concatenate([[0], np.cumsum(lengths)])
    found = {"batch": [], "keys": [], "totals": []}
    for i, batch in enumerate(batches):
        own = totals[cuts[i] : cuts[i + 1]]
        repeated = own > 1
        if repeated.any():
            found["batch"].append(batch)
            found["keys"].append(keys[i][repeated].tobytes())
            found["totals"].append(np.minimum(own[repeated], 2**40).astype(np.int64).tobytes())
    return pa.table(
        [
            pa.array(found["batch"], pa.int64()), pa.array(found["keys"], pa.binary()),
            pa.array(found["totals"], pa.binary()),
        ],
        names=["batch", "keys", "totals"],
    )


def repeated(packed: DataFrame) -> DataFrame:
    """Rows (batch, keys, totals) of the keys that occur at least twice over all batches."""
    return packed.groupBy("part").applyInArrow(
        _add_up, "batch long, keys binary, totals binary"
    )


def frequent(packed: DataFrame, least: int) -> DataFrame:
    """Rows (batch, part, bits): of the keys that a batch sent to a part, in their order, those
    that occur at least so often over all batches. A batch that can make its keys again needs
    no more than a bit for each."""

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
        counts = [np.frombuffer(c, np.uint32) for c in table.column("counts").to_pylist()]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        enough = np.bincount(place, np.concatenate(counts), len(distinct)) >= least
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        bits = [np.packbits(own).tobytes() for own in np.split(enough[place], cuts)]
        return pa.table(
            [table.column("batch"), table.column("part"), pa.array(bits, pa.binary())],
            names=["batch", "part", "bits"],
        )

    return packed.groupBy("part").applyInArrow(answer, "batch long, part int, bits binary")


def answered(keys: np.ndarray, parts: int, answers: dict[int, bytes]) -> np.ndarray:
    """Which of a batch's distinct keys, in order, the bits of its parts name."""
    bits = parts.bit_length() - 1
    bounds = np.arange(1, parts, dtype=np.uint64) << np.uint64(64 - bits)
    cuts = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
    found = np.zeros(len(keys), bool)
    for part, packed in answers.items():
        own = slice(cuts[part], cuts[part + 1])
        raw = np.frombuffer(packed, np.uint8)
        found[own] = np.unpackbits(raw, count=int(cuts[part + 1] - cuts[part])).astype(bool)
    return found


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A batch's repeated keys in order, and their total counts."""
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
    totals = np.frombuffer(b"".join(table.column("totals").to_pylist()), np.int64)
    order = np.argsort(keys)
    return keys[order], totals[order]


def positions(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted value in the sorted ``keys``, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def whole_groups(
    batches: Iterator[pa.RecordBatch], key: str, limit_bytes: int
) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``, of about ``limit_bytes`` each or
    of one group."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < limit_bytes:
            continue
        table = pa.Table.from_batches(held)
        values = table.column(key).to_numpy()
        starts = np.flatnonzero(values[1:] != values[:-1]) + 1
        # A batch may hold many times the limit, so it is cut at several places.
        pieces = max(1, size // limit_bytes)
        wanted = np.linspace(0, table.num_rows, pieces + 1)[1:]
        cuts = np.unique(starts[np.searchsorted(starts, wanted, side="right") - 1]) if len(starts) else []
        last = 0
        for cut in list(cuts):
            if cut > last:
                yield table.slice(last, int(cut) - last)
                last = int(cut)
        held = [b for b in table.slice(last).to_batches() if b.num_rows]
        size = size * (table.num_rows - last) // table.num_rows
    if held:
        yield pa.Table.from_batches(held)
