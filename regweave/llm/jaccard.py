"""N-gram Jaccard join with signature trees.

Sets of word shingles are linked when 100 * intersection >= threshold * union. The way there:

1. Prefix filter. Tokens are ordered by their hash. Two linked sets of sizes m and n share at
   least k tokens among their first n - ceil(t n) + k ones. So a set is dropped as certainly
   unlinked unless enough tokens of that prefix occur elsewhere, which is counted by an
   exchange of packed tokens. This drops most documents.
2. Equal sets, by a digest of 128 bits, become one class; only its representative goes on, under
   a number of its own.
3. Token groups. For each prefix token (k = 1) the sets that have it form a signature tree:
   nodes hold the OR of their members' token bitmaps and their size range, and a dual
   traversal leaves out node pairs whose largest possible overlap is too small. What remains
   is kept as a spanning forest, so a group of n sets yields fewer than n candidate links.
4. Every link lies within one component of the candidate graph. The full sets of a component
   meet once; the same trees are traversed, and what passes is verified exactly. Pairs that
   are already connected are skipped, as only components are asked for.

Groups above ``group_rows`` sets are divided into blocks, and each pair of blocks is a group
of its own, so no task holds more than two blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import as_bytes, attach_groups, small_side, space_words, stored
from regweave.llm.components import components
from regweave.llm.packed import (
    PACKED, in_batches, pack, parts_for, positions, repeated, unpack, whole_groups,
)

_GROUP_BITS = 512  # of a bitmap that travels with each prefix token
_FULL_BITS = 4096  # of a bitmap made where the full set is at hand
_LEAF = 16
_SMALL = 8
_CHUNK_BYTES = 4 << 20
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64
)


class _Hashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(words: list[bytes], width: int, hashes: dict) -> np.ndarray:
    """The sorted distinct 64-bit hashes of ``width`` consecutive words."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        short = xxhash.xxh3_64_intdigest(b"\n".join(words), seed=len(words))
        return np.array([short], np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    count = len(words) - width + 1
    total = np.zeros(count, np.uint64)
    for i in range(width):  # the shift makes the order of the words count
        part = values[i : i + count] * _MULTIPLIERS[i % 4]
        total = (total << np.uint64(7) | total >> np.uint64(57)) ^ part ^ (part >> np.uint64(29))
        total *= _MULTIPLIERS[(i + 1) % 4]
    total ^= total >> np.uint64(32)
    total *= _MULTIPLIERS[3]
    total ^= total >> np.uint64(29)
    return np.unique(total)


class Bounds:
    """The arithmetic of a threshold in percent.

    ``reach``: by how many levels the bitmaps of linked sets can differ, as a level covers
    half the tokens of the one before. A bitmap can be halved three times.
    """

    def __init__(self, percent: int):
        if not 13 <= percent <= 100:
            raise ValueError(f"a threshold of {percent} percent is not between 13 and 100")
        self.percent = percent
        self.reach = math.ceil(math.log2(100 / percent))

    def least_overlap(self, size: int) -> int:
        """What a set of this size shares with any set that it is linked to."""
        return -(-self.percent * size // 100)

    def spare(self, size: int) -> int:
        return max(1, size - self.least_overlap(size))

    def prefix(self, size: int, shared: int = 1) -> int:
        """Length of the prefix in which linked sets have ``shared`` tokens in common."""
        return min(size, size - self.least_overlap(size) + shared)

    def needed(self, size: int) -> int:
        """Tokens of the longer prefix that a linked set of any fitting size has too."""
        return min(self.spare(n) for n in (size, self.least_overlap(size)))

    def linked(self, overlap, m, n):
        return (100 + self.percent) * overlap >= self.percent * (m + n)


def signature(tokens: np.ndarray, width: int) -> tuple[int, np.ndarray]:
    """(level, bitmap): the tokens with ``level`` leading zero bits, hashed to ``width`` bits.

    The level keeps their number at half the width or less.
    """
    places = width.bit_length() - 1
    level = max(0, int(len(tokens) - 1).bit_length() - places + 1)
    if level:
        tokens = tokens[: np.searchsorted(tokens, np.uint64(1) << np.uint64(64 - level))]
    bits = np.zeros(width, np.uint8)
    bits[(tokens << np.uint64(level) >> np.uint64(64 - places)).astype(np.int64)] = 1
    return level, np.packbits(bits, bitorder="little").view(np.uint64)


def _bits(bitmaps: np.ndarray) -> np.ndarray:
    return np.unpackbits(bitmaps.view(np.uint8), axis=1, bitorder="little")


def _coarser(bitmaps: np.ndarray, levels: int) -> np.ndarray:
    """The part of each bitmap that covers what a bitmap so many levels higher does."""
    return np.ascontiguousarray(bitmaps[:, : bitmaps.shape[1] >> levels])


def _paired(bitmaps: np.ndarray, levels: int) -> np.ndarray:
    """Bitmaps as narrow as ``_coarser`` ones: each bit stands for ``2 ** levels`` bits."""
    bits = _bits(bitmaps)
    either = bits.reshape(len(bits), -1, 1 << levels).any(axis=2)
    return np.packbits(either, axis=1, bitorder="little").view(np.uint64)


def _weights(bitmaps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bitmaps).sum(axis=1).astype(np.int64)


def _allowed(bounds: Bounds, m, n, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether sets of sizes m and n with these bitmaps may be linked: a set lacks at least
    as many tokens of the other as bits of its bitmap."""
    common = _weights(one & other)
    overlap = np.minimum(m - (_weights(one) - common), n - (_weights(other) - common))
    return bounds.linked(np.minimum(overlap, np.minimum(m, n)), m, n)


class SignatureTree:
    """Sets in order of size under binary nodes; finds linked pairs by dual traversal."""

    def __init__(self, bounds: Bounds, sizes: np.ndarray, bitmaps: np.ndarray):
        """``bitmaps`` must all be of one level. ``sizes`` ascend."""
        self.bounds, self.sizes, self.bitmaps = bounds, sizes, bitmaps
        self.weights = _weights(bitmaps)
        self.label = np.arange(len(sizes))
        self.members = {i: [i] for i in range(len(sizes))}
        self.nodes: dict[tuple[int, int], tuple] = {}

    def node(self, start: int, end: int) -> tuple:
        """(OR of the bitmaps, fewest bits, smallest size, largest size)."""
        if (start, end) not in self.nodes:
            own = slice(start, end)
            self.nodes[start, end] = (
                np.bitwise_or.reduce(self.bitmaps[own], axis=0), int(self.weights[own].min()),
                int(self.sizes[start]), int(self.sizes[end - 1]),
            )
        return self.nodes[start, end]

    def _possible(self, u: tuple, v: tuple) -> bool:
        """Whether any member of u may be linked to any of v."""
        (bits_u, few_u, low_u, high_u), (bits_v, few_v, low_v, high_v) = u, v
        if 100 * high_u < self.bounds.percent * low_v or 100 * high_v < self.bounds.percent * low_u:
            return False
        common = int(np.bitwise_count(bits_u & bits_v).sum())
        # A member has at least its bits outside the other node that the other set lacks.
        overlap = min(high_u - max(0, few_u - common), high_v - max(0, few_v - common))
        return self.bounds.linked(overlap, low_u, low_v)

    def _connected(self, u: tuple[int, int], v: tuple[int, int]) -> bool:
        first = self.label[u[0]]
        return bool(
            (self.label[u[0] : u[1]] == first).all() and (self.label[v[0] : v[1]] == first).all()
        )

    def _join(self, i: int, j: int) -> bool:
        a, b = self.label[i], self.label[j]
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        moved = self.members.pop(b)
        self.label[moved] = a
        self.members[a] += moved
        return True

    def _leaves(self, u: tuple[int, int], v: tuple[int, int]) -> Iterator[tuple[int, int]]:
        """Pairs (i < j) between two leaves whose bitmaps allow a link."""
        i, j = np.meshgrid(np.arange(*u), np.arange(*v), indexing="ij")
        i, j = i.ravel(), j.ravel()
        keep = (i < j) & (self.label[i] != self.label[j])
        i, j = i[keep], j[keep]
        keep = _allowed(
            self.bounds, self.sizes[i], self.sizes[j], self.bitmaps[i], self.bitmaps[j]
        )
        yield from zip(i[keep].tolist(), j[keep].tolist())

    def forest(self, verify=None) -> list[tuple[int, int]]:
        """Links that connect all that is linked, without a redundant one."""
        links = []
        whole = (0, len(self.sizes))
        stack = [(whole, whole)]
        while stack:
            u, v = stack.pop()
            if self._connected(u, v) and (u != v or u[1] - u[0] > 1):
                continue
            if u != v and not self._possible(self.node(*u), self.node(*v)):
                continue
            if u[1] - u[0] <= _LEAF and v[1] - v[0] <= _LEAF:
                for i, j in self._leaves(u, v):
                    if self.label[i] != self.label[j] and (verify is None or verify(i, j)):
                        self._join(i, j)
                        links.append((i, j))
                continue
            if u == v:
                middle = (u[0] + u[1]) // 2
                left, right = (u[0], middle), (middle, u[1])
                stack += [(left, right), (right, right), (left, left)]
            elif u[1] - u[0] >= v[1] - v[0]:
                middle = (u[0] + u[1]) // 2
                stack += [((middle, u[1]), v), ((u[0], middle), v)]
            else:
                middle = (v[0] + v[1]) // 2
                stack += [(u, (middle, v[1])), (u, (v[0], middle))]
        return links


def _forests(bounds: Bounds, nodes, sizes, levels, bitmaps, verify=None):
    """Links among sets whose bitmaps may have different levels.

    Sets of one level make a tree; those of two levels that links can span make another one,
    over bitmaps that mean the same for both.
    """
    order = np.lexsort((nodes, sizes))
    nodes, sizes, levels, bitmaps = nodes[order], sizes[order], levels[order], bitmaps[order]
    links = []
    present = np.unique(levels).tolist()

    def run(chosen: np.ndarray, maps: np.ndarray):
        tree = SignatureTree(bounds, sizes[chosen], maps)
        check = None
        if verify is not None:
            check = lambda i, j: verify(order[chosen[i]], order[chosen[j]])
        for i, j in tree.forest(check):
            links.append((int(nodes[chosen[i]]), int(nodes[chosen[j]])))

    for level in present:
        chosen = np.flatnonzero(levels == level)
        if len(chosen) > 1:
            run(chosen, bitmaps[chosen])
        for distance in range(1, bounds.reach + 1):
            if level + distance not in present:
                continue
            low, high = chosen, np.flatnonzero(levels == level + distance)
            # Only sizes near the border can be linked across it.
            low = low[100 * sizes[low] >= bounds.percent * sizes[high].min()]
            high = high[bounds.percent * sizes[high] <= 100 * sizes[chosen].max()]
            if len(low) and len(high):
                maps = np.concatenate(
                    [_coarser(bitmaps[low], distance), _paired(bitmaps[high], distance)]
                )
                run(np.concatenate([low, high]), maps)
    return links


def _batch_tokens(bounds: Bounds, width: int, parts: int):
    hashes = _Hashes()

    def run(table: pa.Table) -> pa.Table:
        found = []
        for data in as_bytes(table.column("text").combine_chunks()):
            tokens = shingle_set(space_words(data), width, hashes)
            found.append(tokens[: bounds.prefix(len(tokens), bounds.spare(len(tokens)))])
        keys = np.concatenate(found)
        batch = table.column("batch")[0].as_py()
        return pa.Table.from_batches([pack(batch, keys, parts)])

    return run


_SETS = (
    "doc_id long, identity binary, n_shingles long, class binary, tokens binary, probes binary"
)


def identity(doc_id: str, text: str) -> Column:
    """What tells rows apart: SHA-256 of the id (NULL: nothing), a colon and the text. Rows of
    equal identity are copies of one document."""
    own = F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.concat(own, F.lit(":"), F.coalesce(F.col(text), F.lit(""))), 256))


def _batch_sets(bounds: Bounds, width: int):
    hashes = _Hashes()

    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        keys, _ = unpack(shared)
        rows = {"identity": [], "n": [], "class": [], "tokens": [], "probes": []}
        texts = as_bytes(table.column("text").combine_chunks()) if table.num_rows else []
        for doc_id, data in zip(table.column("doc_id").to_pylist(), texts):
            own = b"%d:" % doc_id if doc_id is not None else b":"
            rows["identity"].append(hashlib.sha256(own + data).digest())
            tokens = shingle_set(space_words(data), width, hashes)
            size = len(tokens)
            digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
            rows["n"].append(size)
            rows["class"].append(digest if size else None)
            known = positions(keys, tokens[: bounds.prefix(size, bounds.spare(size))]) >= 0
            if size and known.sum() >= bounds.needed(size):
                first = bounds.prefix(size)
                rows["tokens"].append(tokens.tobytes())
                rows["probes"].append(tokens[:first][known[:first]].tobytes())
            else:
                rows["tokens"].append(None)
                rows["probes"].append(None)
        ids = table.column("doc_id").combine_chunks() if table.num_rows else pa.array([], pa.int64())
        return pa.table(
            [
                ids, pa.array(rows["identity"], pa.binary()), pa.array(rows["n"], pa.int64()),
                *[pa.array(rows[name], pa.binary()) for name in ("class", "tokens", "probes")],
            ],
            names=["doc_id", "identity", "n_shingles", "class", "tokens", "probes"],
        )

    return run


def _explode_probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, size, tokens, probes in zip(*[column.to_pylist() for column in batch.columns]):
            found = np.frombuffer(probes, np.uint64)
            level, bitmap = signature(np.frombuffer(tokens, np.uint64), _GROUP_BITS)
            count = len(found)
            for start in range(0, count, 4096):
                own = found[start : start + 4096]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own.view(np.int64)), pa.array(np.full(len(own), node)),
                        pa.array(np.full(len(own), size)),
                        pa.array(np.full(len(own), level, np.int32)),
                        pa.array([bitmap.tobytes()] * len(own), pa.binary()),
                    ],
                    names=["token", "node", "n_shingles", "level", "bitmap"],
                )


def _split_large(rows: DataFrame, key: str, load, limit: int) -> DataFrame:
    """``rows`` with a column ``group``: the key, or for a key whose load exceeds ``limit`` one
    of the pairs of blocks into which its rows are divided."""
    total = rows.groupBy(key).agg(F.sum(load).alias("_load"))
    large = small_side(
        total.where(F.col("_load") > limit)
        .select(key, F.ceil(F.col("_load") / limit).cast("int").alias("_blocks")),
        "large-groups",
    )
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("_blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda other: F.xxhash64(F.col(key), F.least(own, other), F.greatest(own, other)),
    )
    split = F.when(F.col("_blocks").isNull(), F.array(F.xxhash64(F.col(key)))).otherwise(pairs)
    return rows.join(large, key, "left").withColumn("group", F.explode(split)).drop("_blocks")


def _small_groups(bounds: Bounds, small, groups, nodes, sizes, levels, maps) -> np.ndarray:
    """Pairs of rows of the same group of at most ``_SMALL``, all groups at once."""
    found = []
    for distance in range(1, _SMALL):
        i = np.flatnonzero(small[:-distance] & (groups[:-distance] == groups[distance:]))
        j = i + distance
        low, high = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        near = (100 * low >= bounds.percent * high) & (nodes[i] != nodes[j])
        i, j = i[near], j[near]
        upper = levels[i] > levels[j]
        i, j = np.where(upper, j, i), np.where(upper, i, j)  # i has the lower level
        apart = levels[j] - levels[i]
        for gap in range(bounds.reach + 1):
            a, b = i[apart == gap], j[apart == gap]
            if len(a):
                one, other = maps[a], maps[b]
                if gap:
                    one, other = _coarser(one, gap), _paired(other, gap)
                keep = _allowed(bounds, sizes[a], sizes[b], one, other)
                found.append(np.stack([nodes[a[keep]], nodes[b[keep]]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


def _spanning(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of the pairs that connect what all of them connect."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for a, b in pairs:
        root, other = find(a), find(b)
        if root != other:
            parent[root] = other
            kept.append((a, b))
    return kept


def _group_links(bounds: Bounds):
    """Candidate links of token groups, from rows sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "group", _CHUNK_BYTES):
            groups, nodes, sizes, levels = (
                table.column(name).to_numpy() for name in ("group", "node", "n_shingles", "level")
            )
            maps = np.frombuffer(b"".join(table.column("bitmap").to_pylist()), np.uint64)
            maps = maps.reshape(table.num_rows, -1)
            begin = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
            lengths = np.diff(np.append(begin, len(groups)))
            small = np.repeat(lengths <= _SMALL, lengths)
            pairs = _small_groups(bounds, small, groups, nodes, sizes, levels, maps)
            found = list(map(tuple, np.unique(pairs, axis=0).tolist()))
            for start, length in zip(*[x[lengths > _SMALL].tolist() for x in (begin, lengths)]):
                own = slice(start, start + length)
                found += _forests(bounds, nodes[own], sizes[own], levels[own], maps[own])
            yield _links(_spanning(found))

    return run


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    array = np.array(sorted({(min(p), max(p)) for p in pairs}), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(array[:, 0]), pa.array(array[:, 1])], names=["a", "b"]
    )


def _verified_links(bounds: Bounds):
    """Links of one candidate component, every one checked on the full sets."""

    def run(table: pa.Table) -> pa.Table:
        nodes, place = np.unique(table.column("node").to_numpy(), return_index=True)
        tokens = table.column("tokens").combine_chunks()
        sets = [np.frombuffer(tokens[i].as_buffer(), np.uint64) for i in place.tolist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        marks = [signature(s, _FULL_BITS) for s in sets]

        def verify(i: int, j: int) -> bool:
            small, large = sorted((sets[i], sets[j]), key=len)
            overlap = int((positions(large, small) >= 0).sum())
            return bool(bounds.linked(overlap, len(small), len(large)))

        links = _forests(
            bounds, nodes, sizes, np.array([level for level, _ in marks]),
            np.stack([bitmap for _, bitmap in marks]), verify,
        )
        return pa.Table.from_batches([_links(links)])

    return run


def linked(
    docs: DataFrame,
    percent: int = 85,
    width: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
    group_rows: int = 8192,
    group_tokens: int = 4 << 20,
) -> DataFrame:
    """One row per document: doc_id, identity, n_shingles, component_id, component.

    As ``join``. ``component`` is the same for the documents of one component and for no other,
    also where ids repeat, and NULL for empty sets; ``identity`` is that of the function.
    """
    bounds = Bounds(percent)
    rows, size = in_batches(docs, doc_id, text)
    # About six bytes a word; the longer prefix holds twice the share that may differ.
    parts = parts_for(size * 2 * (100 - percent) // 600)
    by_batch = rows.groupBy("batch")
    shared = repeated(by_batch.applyInArrow(_batch_tokens(bounds, width, parts), PACKED))
    sets = stored(
        by_batch.cogroup(shared.groupBy("batch")).applyInArrow(_batch_sets(bounds, width), _SETS),
        "sets",
    )
    # The numbers are written once, so they stay what they are.
    survivors = stored(
        sets.where("tokens is not null").select("class", "n_shingles", "tokens", "probes")
        .dropDuplicates(["class"]).withColumn("node", F.monotonically_increasing_id()),
        "survivors",
    )
    probes = survivors.select("node", "n_shingles", "tokens", "probes").mapInArrow(
        _explode_probes, "token long, node long, n_shingles long, level int, bitmap binary"
    )
    probes = stored(probes, "probes")
    grouped = _split_large(probes, "token", F.lit(1), group_rows)
    columns = ["group", "node", "n_shingles", "level", "bitmap"]
    candidates = (
        grouped.select(*columns).repartition("group").sortWithinPartitions("group")
        .mapInArrow(_group_links(bounds), "a long, b long")
    )
    members = components(candidates).withColumnRenamed("root", "candidate")
    gathered = survivors.select("node", "n_shingles", "tokens").join(members, "node")
    load = F.col("n_shingles") + group_tokens // group_rows
    links = (
        _split_large(gathered, "candidate", load, group_tokens).select("group", "node", "tokens")
        .groupBy("group").applyInArrow(_verified_links(bounds), "a long, b long")
    )
    roots = survivors.select("node", "class").join(components(links), "node").select("class", "root")
    classes = sets.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("best"), F.count(F.lit(1)).alias("_size")
    )
    # A class without a link is a component of its own; its digest is longer than a number.
    number = F.unhex(F.lpad(F.hex("root"), 16, "0"))
    named = classes.join(roots, "class", "left").withColumn(
        "component", F.coalesce(number, F.col("class"))
    )
    # A component of many classes is one key here; only numbers move, and partial sums first.
    least = named.groupBy("component").agg(
        F.min("best").alias("component_id"), F.count(F.lit(1)).alias("_classes")
    )
    total = sets.count()
    known = attach_groups(named, least, ["component"], "_classes", total)
    known = known.select("class", "component", "component_id", "_size")
    narrow = sets.select("doc_id", "identity", "n_shingles", "class")
    linked_rows = attach_groups(narrow.where("class is not null"), known, ["class"], "_size", total)
    none = F.lit(None).cast("binary")
    empty = narrow.where("class is null").withColumns(
        {"component_id": F.col("doc_id"), "component": none}
    )
    out = ["doc_id", "identity", "n_shingles", "component_id", "component"]
    return linked_rows.select(*out).unionByName(empty.select(*out))


def join(docs: DataFrame, *args, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id; parameters as ``linked``.

    Words are runs of other than ASCII white space, A-Z lower-cased; a set holds the
    distinct shingles of ``width`` words, a shorter text makes one shingle. NULL and empty
    texts have empty sets, linked with nothing. ``component_id`` is the smallest doc_id that
    links reach, the row's own included; NULL ids count as larger than all others. Repeated
    rows are linked like any equal sets. Ids must be integers. An empty table gives no rows.
    ``percent`` is 13 at least.
    """
    return linked(docs, *args, **options).select("doc_id", "n_shingles", "component_id")


def keep_one(
    docs: DataFrame, percent: int = 85, width: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id, of several texts
    with that id the one with the smallest identity. NULL ids count as larger than all others.

    Exactly the other rows of a component go, whatever else shares their ids; copies of one
    row (same id and text) are one document, of which any one stays. Documents with empty
    sets all stay.
    """
    found = stored(linked(docs, percent, width, doc_id, text), "linked")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "identity")
    groups = stored(
        found.where("component is not null").groupBy("component").agg(
            F.min(first).alias("_first"), F.count(F.lit(1)).alias("_rows")
        ).where("_rows > 1"),
        "near-copies",
    )
    members = attach_groups(
        found.select("component", "identity"), groups, ["component"], "_rows", found.count()
    )
    stays = F.col("identity") == F.col("_first.identity")
    losers = small_side(members.where(~stays).select("identity").distinct(), "near-losers")
    repeats = stored(
        members.where(stays).groupBy("identity").count().where("count > 1").select("identity"),
        "near-repeats",
    )
    named = docs.withColumn("__rw_identity", identity(doc_id, text))
    kept = named.join(losers.withColumnRenamed("identity", "__rw_identity"), "__rw_identity", "left_anti")
    if repeats.take(1):
        several = repeats.withColumnRenamed("identity", "__rw_identity")
        kept = kept.join(several, "__rw_identity", "left_anti").unionByName(
            kept.join(several, "__rw_identity", "left_semi").dropDuplicates(["__rw_identity"])
        )
    return kept.select(*docs.columns)
