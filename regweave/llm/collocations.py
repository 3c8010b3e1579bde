"""Phrase collocations from an FM-index per shard.

A shard is a run of one language's words within an input task, at most ``shard_words`` of them.
Its index is a Burrows-Wheeler transform over word numbers: suffixes sorted by their first four
words, which is as deep as intervals of four words go. A phrase is an interval of rows. The
inverse of the last-to-first mapping leads from a row to that of the next word, so the rows of a
longer phrase are those where the interval of its beginning, extended to the right, and that of
its end, extended to the left, meet. All phrases of a length are extended at once.

1. Shards are built where the text is read and stored once, bucketed by shard, so that no later
   step moves them. A text that is longer than a shard is cut inside a piece with three words of
   overlap, and the overlap is counted once more with a negative sign.
2. Length by length, shards send the hashes and counts of their phrases to be summed and get
   back a bit for each: whether it has at least ``least`` occurrences in all shards
   (``regweave.llm.packed``). Only phrases whose beginning and end have passed are extended. Equal hashes of different phrases
   could only let more pass.
3. Shards send what passed as text, and exact sums by text are the frequencies.
4. Scores need the frequencies of the parts of a phrase, joined with frequent parts split, and
   its most frequent extensions by a word, which are phrases themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regweave.llm.common import LOWER_TABLE, as_bytes, attach_groups, small_side, stored
from regweave.llm.packed import PACKED, answered, frequent, pack_counted, parts_for
from regweave.storage import scratch_directory

_LONGEST = 4
_SLICE = 1 << 16
_BREAK = b"\xff"  # no byte of UTF-8
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(
    0xFF if b in _ENDS else 0x20 if b == 0x09 else LOWER_TABLE[b] for b in range(256)
)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_INDEX = "shard long, lang string, sign int, n long, words binary, bwt binary"
_INDEX_NAMES = ["shard", "lang", "sign", "n", "words", "bwt"]


class _Numbers(dict):
    """Word numbers in order of appearance; 0 stands between pieces."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def transform(numbers: np.ndarray) -> np.ndarray:
    """For each suffix in the order of its first four words, the word in front of it.

    Suffixes are ranked by two words and then by the ranks of their first and second pair.
    """
    size = len(numbers)
    wide = np.concatenate([numbers.astype(np.uint64), np.zeros(2, np.uint64)])
    pairs = wide[:size] << np.uint64(32) | wide[1 : size + 1]
    order = np.argsort(pairs)
    same = pairs[order]
    rank = np.zeros(size + 2, np.uint64)
    rank[order] = np.cumsum(np.concatenate([[True], same[1:] != same[:-1]])).astype(np.uint64)
    order = np.argsort(rank[:size] << np.uint64(32) | rank[2:])
    return numbers[order - 1]


class PhraseIndex:
    """Intervals of the phrases of a shard, one length at a time.

    ``labels`` holds for each row the number of the phrase that it starts with, or -1; of each
    phrase ``hashes``, ``counts``, and the numbers of the phrases without its last word
    (``before``) and without its first word (``after``).
    """

    def __init__(self, words: list[bytes], bwt: np.ndarray, seed: int):
        self.follow = np.argsort(bwt, kind="stable").astype(np.int32)  # the row of the next word
        sizes = np.bincount(bwt, minlength=len(words))
        self.labels = np.repeat(np.arange(len(words), dtype=np.int32), sizes) - 1
        self.counts = sizes[1:]
        self.hashes = np.array(
            [xxhash.xxh3_64_intdigest(word, seed) for word in words[1:]], np.uint64
        )
        self.length = 1
        self.before = self.after = None

    def keep(self, chosen: np.ndarray) -> None:
        """Forget the phrases that are not chosen; ``chosen`` has the numbers of the others."""
        self.chosen = np.flatnonzero(chosen)
        numbers = np.append(np.where(chosen, np.cumsum(chosen) - 1, -1), -1)
        self.labels = numbers.astype(np.int32)[self.labels]
        self.counts, self.hashes = self.counts[chosen], self.hashes[chosen]
        if self.length > 1:
            self.before, self.after = self.before[chosen], self.after[chosen]

    def extend(self) -> None:
        """From phrases to those that are one word longer, of which both ends are kept."""
        right = self.labels[self.follow]
        rows = np.flatnonzero((self.labels >= 0) & (right >= 0))
        left, right = self.labels[rows], right[rows]
        new = np.ones(len(rows), bool)
        new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        starts = np.flatnonzero(new)
        one, other = self.hashes[left[starts]], self.hashes[right[starts]]
        self.before, self.after = left[starts], right[starts]
        self.counts = np.diff(np.append(starts, len(rows)))
        mixed = one * _MIX[0] ^ (other << np.uint64(23) | other >> np.uint64(41)) * _MIX[1]
        self.hashes = (mixed ^ mixed >> np.uint64(31)) * _MIX[2]
        self.labels = np.full(len(self.labels), -1, np.int32)
        self.labels[rows] = np.cumsum(new) - 1
        self.length += 1


class _Buffer:
    """The words of a shard that is being filled."""

    def __init__(self):
        self.numbers, self.parts, self.size = _Numbers(), [], 0

    def add(self, words: list[bytes]) -> None:
        # Zero stands in front and behind, so phrases never run from one text to the next.
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.size += len(words)

    def tail(self) -> list[bytes]:
        """The last words of the piece at the end, at most one fewer than a phrase has."""
        names = list(self.numbers)
        last = np.concatenate(self.parts[1 - _LONGEST :])[1 - _LONGEST :] if self.parts else []
        words: list[bytes] = []
        for number in reversed(last):
            if not number:
                break
            words.insert(0, names[number])
        return words


def _slices(data: bytes) -> Iterator[bytes]:
    """The text in slices that end behind a word."""
    start = 0
    while len(data) - start > _SLICE:
        end = max(data.rfind(c, start, start + _SLICE) for c in (b" ", _BREAK))
        if end < start:  # a word longer than a slice
            ends = [e for c in (b" ", _BREAK) if (e := data.find(c, start + _SLICE)) >= 0]
            if not ends:
                break
            end = min(ends)
        yield data[start : end + 1]
        start = end + 1
    yield data[start:]


def _shards(shard_words: int):
    """Index rows from rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        buffers: dict[tuple[str, int], _Buffer] = {}
        made = 0

        def close(key: tuple[str, int]) -> pa.RecordBatch:
            nonlocal made
            buffer = buffers.pop(key)
            numbers = np.concatenate([*buffer.parts, np.zeros(1, np.uint32)])
            bwt = transform(numbers)
            narrow = np.uint16 if len(buffer.numbers) <= 1 << 16 else np.uint32
            made += 1
            row = [
                task << 32 | made, key[0], key[1], int((numbers > 0).sum()),
                b" ".join(buffer.numbers), bwt.astype(narrow).tobytes(),
            ]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, kinds)], names=_INDEX_NAMES
            )

        for batch in batches:
            texts = batch.column("text")
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                own = buffers.setdefault((lang, 1), _Buffer())
                data = as_bytes(texts.slice(i, 1))[0]  # one text at a time is held twice
                if not data:
                    continue
                data = _BREAK + data.translate(_TABLE)
                for part in _slices(data):
                    words = part.replace(_BREAK, b" \xff ").split()
                    if own.size and own.size + len(words) > shard_words:
                        shared = own.tail() if words and words[0] != _BREAK else []
                        yield close((lang, 1))
                        own = buffers.setdefault((lang, 1), _Buffer())
                        if shared:
                            own.add([_BREAK, *shared])
                            buffers.setdefault((lang, -1), _Buffer()).add([_BREAK, *shared])
                    if words:
                        own.add(words)
                if sum(b.size for b in buffers.values()) > 2 * shard_words:
                    yield close(max(buffers, key=lambda key: buffers[key].size))
        for key in list(buffers):
            yield close(key)

    return run


def _index(table: pa.Table) -> PhraseIndex:
    words = table.column("words")[0].as_py().split(b" ")
    raw = table.column("bwt")[0].as_py()
    width = np.uint16 if len(words) <= 1 << 16 else np.uint32
    seed = xxhash.xxh3_64_intdigest(table.column("lang")[0].as_py().encode())
    return PhraseIndex(words, np.frombuffer(raw, width), seed)


def _levels(
    table: pa.Table, answers: pa.Table, lengths: int, parts: int
) -> Iterator[PhraseIndex]:
    """The index at each length, reduced to the phrases that passed."""
    bits: dict[int, dict[int, bytes]] = {}
    for length, part, own in zip(
        *[answers.column(name).to_pylist() for name in ("length", "part", "bits")]
    ):
        bits.setdefault(length, {})[part] = own
    index = _index(table)
    for length in range(1, lengths + 1):
        if length > 1:
            index.extend()
        keys, place = np.unique(index.hashes, return_inverse=True)
        index.keep(answered(keys, parts, bits.get(length, {}))[place])
        yield index


def _packed(table: pa.Table, index: PhraseIndex, parts: int) -> pa.RecordBatch:
    keys, place = np.unique(index.hashes, return_inverse=True)
    counts = np.bincount(place, index.counts, len(keys)).astype(np.int64)
    return pack_counted(table.column("shard")[0].as_py(), keys, counts, parts)


def _first_keys(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                table = pa.Table.from_batches([batch.slice(row, 1)])
                yield _packed(table, _index(table), parts)

    return run


def _keys(length: int, parts: int):
    """Keys of the phrases of this length, from an index row and the answers to shorter ones."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        for index in _levels(table, answers, length - 1, parts):
            pass
        index.extend()
        return pa.Table.from_batches([_packed(table, index, parts)])

    return run


_PHRASES = "lang string, phrase string, width int, f long"


def _texts(longest: int, parts: int):
    """What passed, as text with the shard's counts."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        sign = table.column("sign")[0].as_py()
        lang = table.column("lang")[0].as_py()
        words = np.array(table.column("words")[0].as_py().split(b" ")[1:], object)
        phrases, widths, counts = [], [], []
        own = ends = None
        for index in _levels(table, answers, longest, parts):
            if index.length == 1:
                own = ends = words[index.chosen]
            else:
                ends = ends[index.after]
                own = own[index.before] + b" " + ends if len(index.after) else own[:0]
            phrases += own.tolist()
            widths.append(np.full(len(own), index.length, np.int32))
            counts.append(index.counts.astype(np.int64) * sign)
        return pa.table(
            [
                pa.array([lang] * len(phrases), pa.string()),
                pa.array(phrases, pa.binary()).cast(pa.string()),
                pa.array(np.concatenate(widths)), pa.array(np.concatenate(counts)),
            ],
            names=["lang", "phrase", "width", "f"],
        )

    return run


def index_shards(
    docs: DataFrame, lang: str = "lang", text: str = "text", shard_words: int = 1 << 19
) -> tuple[DataFrame, int]:
    """Index rows bucketed by shard, and the bytes of all texts. NULL languages are ``und``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(50_000, max(1, -(-size // (24 << 20))))
    path = scratch_directory(spark, "phrase-index")
    name = f"phrase_index_{uuid.uuid4().hex}"
    made = rows.mapInArrow(_shards(shard_words), _INDEX)
    (
        made.repartition(buckets, "shard").write.format("parquet")
        .bucketBy(buckets, "shard").option("path", path).saveAsTable(name)
    )
    return spark.table(name), size


def phrases(
    docs: DataFrame,
    longest: int = 4,
    least: int = 30,
    lang: str = "lang",
    text: str = "text",
    shard_words: int = 1 << 19,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, width, f) of all phrases of up to ``longest`` words with at least
    ``least`` occurrences in a language, and (lang, n): its words.

    A-Z is lower-cased. Texts are split at ``.,;:!?`` and line ends into pieces, those at
    spaces and tabs into words, and phrases lie within a piece. Overlapping occurrences all
    count. NULL texts are empty, NULL languages are ``und``. An empty table gives no rows.
    """
    if not 1 <= longest <= _LONGEST:
        raise ValueError(f"phrases have 1 to {_LONGEST} words")
    shards, size = index_shards(docs, lang, text, shard_words)
    parts = parts_for(size // 8)
    answers = None
    for length in range(1, longest + 1):
        if answers is None:
            keys = shards.mapInArrow(_first_keys(parts), PACKED)
        else:
            keys = shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(
                _keys(length, parts), PACKED
            )
        passed = frequent(keys, least).select(
            F.col("batch").alias("shard"), F.lit(length).alias("length"), "part", "bits"
        )
        passed = stored(passed, f"phrase-keys-{length}")
        answers = passed if answers is None else answers.unionByName(passed)
    found = shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(
        _texts(longest, parts), _PHRASES
    )
    counted = found.groupBy("lang", "phrase", "width").agg(F.sum("f").alias("f"))
    words = shards.groupBy("lang").agg(F.sum(F.col("n") * F.col("sign")).alias("n"))
    return stored(counted.where(F.col("f") >= least), "phrases"), words


def _words(first: Column, count: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def collocations(found: DataFrame, longest: int = 4, scale: int = 2_000_000) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words and more in ``found``.

    A phrase is cut in two with frequencies l and r; ``score`` is the smallest
    ``floor(scale * a / (l + r))`` of its cuts, of equal ones that of the shortest first part.
    Phrases that stand in a longer one with at least 80 % of their frequency are left out.
    """
    candidates = found.where("width > 1").withColumnRenamed("f", "a")
    one, width = F.lit(1), F.col("width")
    cuts = candidates.withColumn("k", F.explode(F.sequence(one, width - 1)))
    requests = cuts.select("lang", "phrase", "k", F.explode(F.array(
        F.struct(F.lit("l").alias("side"), _words(one, F.col("k")).alias("part")),
        F.struct(F.lit("r").alias("side"), _words(F.col("k") + 1, width - F.col("k")).alias("part")),
    )).alias("own")).select("lang", "phrase", "k", "own.side", "own.part")
    requests = stored(requests, "phrase-parts")
    asked = requests.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("_n"))
    frequencies = found.select("lang", F.col("phrase").alias("part"), "f")
    known = stored(asked.join(frequencies, ["lang", "part"]), "part-frequencies")
    parts = attach_groups(requests, known, ["lang", "part"], "_n", requests.count())
    longer = candidates.where("width > 2").select("lang", F.explode(F.array(
        _words(one, width - 1), _words(F.lit(2), width - 1)
    )).alias("phrase"), F.col("a").alias("longer"))
    both = (
        candidates.select("lang", "phrase", "a")
        .unionByName(parts.select("lang", "phrase", "k", "side", "f"), allowMissingColumns=True)
        .unionByName(longer, allowMissingColumns=True)
    )
    sides = [(k, side) for k in range(1, longest) for side in "lr"]
    rows = both.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.max("longer").alias("longer"),
        *[
            F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f"))).alias(f"{side}{k}")
            for k, side in sides
        ],
    )
    wide = "decimal(20, 0)"
    rows = rows.where(
        F.col("longer").isNull()
        | (F.lit(100) * F.col("longer").cast(wide) < F.lit(80) * F.col("a").cast(wide))
    )
    scored = [
        F.when(F.col(f"l{k}").isNotNull(), F.struct(
            F.expr(f"(cast({scale} as {wide}) * cast(a as decimal(18, 0)))"
                   f" div (cast(l{k} as {wide}) + cast(r{k} as {wide}))").alias("score"),
            F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"),
        ))
        for k in range(1, longest)
    ]
    best = F.array_min(F.filter(F.array(*scored), lambda cut: cut.isNotNull()))
    return rows.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def best_of_each(rows: DataFrame, key: str, order: list[Column], count: int, name: str) -> DataFrame:
    """The first ``count`` rows of each key in a total order, with their rank from 1.

    Rows are first ranked within salted parts of a key, and only the best of each part meet;
    with many rows that is repeated, so that a key with most of the rows fills no task.
    """
    rows = stored(rows, "ranked")
    part = max(50_000, 25 * count)
    left = rows.count()
    while left > part:
        salts = -(-left // part)
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns, F.lit(left)), F.lit(salts)))
        within = Window.partitionBy(key, "_salt").orderBy(*order)
        rows = rows.withColumn(name, F.row_number().over(within)).where(F.col(name) <= count)
        rows = rows.drop("_salt", name)
        left = salts * count
    whole = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(whole)).where(F.col(name) <= count)


def report(scored: DataFrame, words: DataFrame, count: int = 2000) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    top = best_of_each(scored, "lang", order, count, "rank")
    named = top.join(small_side(words, "words-of-languages"), "lang")
    return named.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
