"""Exact dedup, suffix dedup, Jaccard join, components, mixing, WARC and the pipeline."""

import gzip
import hashlib
import random

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from regweave.llm import (
    components, exact_dedup, jaccard, mixing, packed, suffix_dedup, toxicity, warc,
)
from regweave.llm.common import attach_groups, id_remainder, small_side

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def small_docs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return docs, [tuple(r) for r in docs.select("doc_id", "text").collect()]


# Exact dedup

def test_exact_classes(make, awkward):
    got = exact_dedup.duplicate_classes(make(awkward))
    assert rows(got.select("doc_id", "keep_id", "group_size")) == brute.exact_classes(awkward)
    kept = got.where("kept")
    assert kept.count() == kept.select("text_sha256").distinct().count()
    assert kept.where("not doc_id <=> keep_id").count() == 0
    assert exact_dedup.duplicate_classes(make([])).collect() == []


def test_kept_rows_have_all_columns(make, awkward):
    docs = make(awkward)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.dtypes == docs.dtypes
    ids = dict(docs.select('_key', 'doc_id').collect())
    assert all(ids[r._key] == r.doc_id for r in kept.collect())
    want = {(keep, size) for _, keep, size in brute.exact_classes(awkward)}
    assert kept.count() == len({brute.normalised(t) for _, t in awkward})
    assert {r.doc_id for r in kept.collect()} == {keep for keep, _ in want}
    assert exact_dedup.drop_duplicates(make([])).collect() == []


@pytest.mark.parametrize("round_bytes", [32 << 20, 32 << 10])
def test_filter_never_misses_a_repeat(spark, round_bytes):
    keys = spark.range(3000).select(
        F.xxhash64(F.when(F.col("id") % 10 == 0, F.lit(0)).otherwise(F.col("id") % 2500)).alias("k")
    ).repartition(7)
    flagged = exact_dedup.flag_repeats(keys, "k", bits_per_key=400, round_bytes=round_bytes)
    counts = keys.groupBy("k").count()
    joined = flagged.join(counts, "k")
    assert joined.count() == 3000
    assert joined.where("count > 1 and not maybe_repeated").count() == 0
    assert joined.where("count = 1 and maybe_repeated").count() < 20


def test_attach_groups_splits_large_groups(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"))
    groups = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = attach_groups(left, groups, ["k"], "n", 3000)
    assert got.count() == 3000 and got.where("n = 1000").count() == 1000


def test_only_counted_sides_are_broadcast(spark, plan):
    left, right = spark.range(50), spark.range(10)
    for limit, wanted in ((10, True), (9, False)):
        joined = left.join(small_side(right, "side", limit), "id")
        assert ("BroadcastHashJoin" in plan(joined)) == wanted and joined.count() == 10


def test_whole_groups_are_never_cut():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    for limit in (1, 100, 10**9):
        keys = np.sort(rng.integers(0, 30, 500))
        table = pa.table({"g": keys, "x": np.arange(500)})
        found = list(packed.whole_groups(iter(table.to_batches(max_chunksize=37)), "g", limit))
        assert pa.concat_tables(found).column("x").to_pylist() == list(range(500))
        groups = [set(t.column("g").to_pylist()) for t in found]
        assert sum(map(len, groups)) == len(set(keys.tolist()))
    assert len(found) == 1


# Suffix dedup

def test_suffix_array_and_common_prefixes():
    random.seed(3)
    for round_ in range(60):
        letters = "ab" if round_ % 2 else "abcdefgh"
        base = "".join(random.choices(letters, k=60))
        texts = [
            "".join(random.choices(letters, k=random.randrange(20)))
            + base[random.randrange(30):] * random.randrange(1, 3) for _ in range(random.randrange(1, 6))
        ]
        text = np.concatenate([
            np.append(np.frombuffer(t.encode(), np.uint8).astype(np.int16) + 1, 0) for t in texts
        ])
        order, _ = suffix_dedup.suffix_array(text)
        symbols = text.tolist()
        assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])
        prefixes = suffix_dedup.common_prefixes(text, order)
        for a, b in zip(order, order[1:]):
            common = 0
            while max(a, b) + common < len(symbols) and symbols[a + common] == symbols[b + common]:
                common += 1
            assert prefixes[b] == common


def test_intervals_cover_each_window_once_and_agree():
    random.seed(4)
    same = bytes(random.choices(b"abc", k=150))
    texts = [b"x" * 30 + same + b"y" * 9, same, b"short", b"", b"ab" * 200, b"q" + b"ab" * 100 + same]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts, counts, anchors = suffix_dedup.intervals(data, ends, 100)
    owner = {}
    for s, n, a in zip(starts.tolist(), counts.tolist(), anchors.tolist()):
        for w in range(s, s + n):
            assert w not in owner
            owner[w] = a
    bounds = [0, *ends.tolist()]
    want = {w for s, e in zip(bounds, bounds[1:]) for w in range(s, e - 99)}
    assert set(owner) == want
    by_text = {}
    for w, a in owner.items():
        assert by_text.setdefault(bytes(data[w : w + 100]), a) == a


@pytest.mark.parametrize("hot", [2000, 2])
def test_suffix_dedup_equals_brute_force(spark, make, awkward, hot):
    docs, pairs = small_docs(spark)
    got = suffix_dedup.report(suffix_dedup.dedup(docs, hot=hot))
    assert rows(got) == brute.repeats(pairs)
    ids = [p for p in awkward if p[0] not in (5, None)]
    got = suffix_dedup.report(suffix_dedup.dedup(make(ids), hot=hot))
    assert rows(got) == brute.repeats(ids)


def test_suffix_dedup_of_rows_with_the_same_id(make, awkward):
    got = suffix_dedup.report(suffix_dedup.dedup(make(awkward))).collect()
    assert len(got) == len(awkward)
    tied = sorted(r.n_removed for r in got if r.doc_id == 5 and r.n_bytes > 100)
    assert tied[0] == 0 and tied[1] > 0
    last = [r for r in got if r.doc_id is None and r.n_bytes]
    assert last[0].n_removed == last[0].n_bytes
    assert suffix_dedup.dedup(make([])).collect() == []


def test_texts_longer_than_a_piece(monkeypatch):
    """Windows, repeats and removed runs across the cuts of a long text."""
    monkeypatch.setattr(suffix_dedup, "_STEP", 700)
    random.seed(12)
    letters = "abcdefgh"
    block = ["".join(random.choices(letters, k=n)) for n in (130, 333, 1500, 99)]
    pairs = []
    for i in range(14):
        parts = [random.choice(block) if random.random() < 0.5 else
                 "".join(random.choices(letters, k=random.randrange(400))) for _ in range(random.randrange(12))]
        pairs.append((i, "".join(parts)))
    pairs += [(50, "ab" * 2000), (51, "x" * 3000), (52, block[2] + block[2]), (53, "x" * 120), (54, None)]
    batch = suffix_dedup._Batch(pa.table({
        "doc_id": [i for i, _ in pairs], "text": [t for _, t in pairs]}))
    assert max(len(data) for _, _, data, _ in batch.pieces(100)) <= 700 + 1400
    for first, base, data, ends in batch.pieces(100):
        assert base == 0 or len(ends) == 1
    assert solved_in_one_process(pairs) == solved_in_one_process(pairs, hot=3) == brute.repeats(pairs)


def solved_in_one_process(pairs, length=100, hot=2000):
    """The steps of ``dedup`` on one batch, where changed settings reach."""
    table = pa.table({
        "batch": pa.array([0] * len(pairs), pa.int64()), "doc_id": pa.array([i for i, _ in pairs], pa.int64()),
        "text": pa.array([t for _, t in pairs], pa.string()),
    })
    keys = suffix_dedup._batch_keys(length, 64)(table)
    found = pa.concat_tables([
        packed._add_up(keys.filter(pa.compute.equal(keys.column("part"), part)))
        for part in set(keys.column("part").to_pylist())
    ])
    rows_ = suffix_dedup._batch_intervals(length, 64, hot)(table, found)
    rows_ = rows_.sort_by([("kind", "ascending"), ("key", "ascending")])
    marks = pa.Table.from_batches(list(suffix_dedup._shard(length)(rows_.to_batches())))
    answers = pa.concat_tables([found, marks], promote_options="default")
    done = suffix_dedup._remove(length)(table, answers).to_pylist()
    return sorted(
        ((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["removed"]),
          hashlib.sha256(r["kept"]).hexdigest()) for r in done), key=str,
    )


@pytest.mark.parametrize("hot", [2000, 1])
def test_steps_in_one_process_equal_brute_force(hot):
    random.seed(13)
    parts = ["".join(random.choices("abc", k=150)) for _ in range(4)]
    pairs = [(i, "".join(random.choices(parts, k=3)) + str(i)) for i in range(30)]
    assert solved_in_one_process(pairs, hot=hot) == brute.repeats(pairs)


# Jaccard join

def near_copies():
    random.seed(9)
    base = [f"v{random.randrange(400)}" for _ in range(300)]
    pairs = []
    for i in range(60):
        words = list(base)
        for _ in range(i % 12):
            words[random.randrange(300)] = f"n{random.randrange(10**6)}"
        pairs.append((1000 + i, " ".join(words)))
    for i in range(30):  # sizes around the border between two signature levels
        words = [f"u{j}" for j in range(240 + i)]
        pairs.append((2000 + i, " ".join(words)))
    for i, size in enumerate((70, 256, 610, 1400, 3000)):  # links across levels, for low thresholds
        pairs.append((3000 + i, " ".join(f"z{j}" for j in range(size))))
    return pairs


@pytest.mark.parametrize("percent, width, limits", [
    (85, 4, {}), (80, 5, {"group_rows": 4, "group_tokens": 2000}), (40, 2, {}),
    (20, 3, {"group_rows": 20}),
])
def test_jaccard_equals_brute_force(make, awkward, percent, width, limits):
    pairs = awkward + near_copies()
    got = jaccard.join(make(pairs), percent, width, **limits)
    assert rows(got) == brute.jaccard_components(pairs, percent, width)


def test_jaccard_on_documents_and_empty_table(spark, make):
    docs, pairs = small_docs(spark)
    assert rows(jaccard.join(docs)) == brute.jaccard_components(pairs)
    assert jaccard.join(make([])).collect() == []


def test_thresholds_that_bitmaps_cannot_serve():
    for percent in (0, 12, 101):
        with pytest.raises(ValueError):
            jaccard.Bounds(percent)


def keep_one_rows(make, pairs):
    """(id, first word) of the rows that stay."""
    docs = make(pairs)
    kept = jaccard.keep_one(docs, 80, 5)
    assert kept.dtypes == docs.dtypes
    return sorted(((r.doc_id, (r.text or "").split(" ")[0]) for r in kept.collect()), key=str)


def test_only_the_near_copies_of_a_shared_id_go(make):
    one = " ".join(f"a{i}" for i in range(80))
    two, three = [" ".join(f"{c}{i}" for i in range(70)) for c in "bc"]
    unrelated = " ".join(f"d{i}" for i in range(50))
    assert keep_one_rows(make, [(1, one), (5, one + " x"), (5, unrelated)]) == [(1, "a0"), (5, "d0")]
    # Two components whose smallest id is the same, and near copies of one id.
    pairs = [(5, one), (6, one + " x"), (5, two), (7, two + " y"), (8, three), (8, three + " z")]
    assert keep_one_rows(make, pairs) == [(5, "a0"), (5, "b0"), (8, "c0")]


def test_near_copies_without_ids_and_repeated_rows(make):
    one = " ".join(f"a{i}" for i in range(80))
    other = " ".join(f"d{i}" for i in range(50))
    pairs = [(None, one), (None, one + " x"), (None, other), (3, None), (3, ""), (None, None)]
    assert keep_one_rows(make, pairs) == [(3, ""), (3, ""), (None, ""), (None, "a0"), (None, "d0")]
    assert keep_one_rows(make, [(None, one), (9, one + " x")]) == [(9, "a0")]
    # Copies of one row are one document.
    assert keep_one_rows(make, [(7, one)] * 3 + [(8, one), (2, other)] + [(None, other)] * 2) == [
        (2, "d0"), (7, "a0")]
    assert keep_one_rows(make, []) == []


def test_many_equal_rows_without_an_id(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = spark.range(50_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    other = spark.createDataFrame([(1, "b " * 9)], "doc_id long, text string")
    docs = rows.unionByName(other)
    assert jaccard.join(docs).where("n_shingles = 27 and component_id is null").count() == 50_000
    assert sorted(r.doc_id or 0 for r in jaccard.keep_one(docs).collect()) == [0, 1]


def test_sets_of_equal_numbers_are_told_apart_by_128_bits(make):
    pairs = [(i, f"w{i} x{i} y{i} z{i} v{i}") for i in range(20)]
    found = jaccard.linked(make(pairs + [(50, pairs[0][1])]))
    assert found.where("octet_length(component) = 16").count() == 21
    assert found.select("component").distinct().count() == 20
    assert found.select("identity").distinct().count() == 21


def test_tree_finds_all_links_of_random_sets():
    rng = np.random.default_rng(2)
    bounds = jaccard.Bounds(85)
    for size in (3, 60, 255, 300, 1100):
        base = rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2)
        sets = []
        for i in range(40):
            own = base.copy()
            change = rng.integers(0, size, rng.integers(0, max(1, size // 6) + 1))
            own[change] = rng.integers(0, 2**63, len(change)).astype(np.uint64)
            sets.append(np.unique(own[: size - rng.integers(0, size // 8 + 1)]))
        marks = [jaccard.signature(s, jaccard._GROUP_BITS) for s in sets]

        def linked(i, j):
            return bounds.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))

        links = jaccard._forests(
            bounds, np.arange(40), np.array([len(s) for s in sets]),
            np.array([level for level, _ in marks]), np.stack([b for _, b in marks]), linked,
        )
        label = list(range(40))
        want = list(range(40))
        for i in range(40):
            for j in range(i):
                if linked(i, j):
                    old, new = want[i], want[j]
                    want = [new if x == old else x for x in want]
        for i, j in links:
            old, new = label[i], label[j]
            label = [new if x == old else x for x in label]
        partition = lambda found: {frozenset(k for k in range(40) if found[k] == x) for x in found}
        assert partition(label) == partition(want)


def test_packed_keys_find_all_repeats():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    batches = [rng.integers(0, 50, 30).astype(np.uint64) << np.uint64(58) for _ in range(4)]
    batches.append(np.array([7, 7], np.uint64))
    batches.append(np.array([9], np.uint64))
    table = pa.Table.from_batches([packed.pack(i, keys, 64) for i, keys in enumerate(batches)])
    everything = np.concatenate(batches)
    found = {}
    for part in set(table.column("part").to_pylist()):
        own = table.filter(pa.compute.equal(table.column("part"), part))
        answer = packed._add_up(own)
        for batch, keys, totals in zip(*[c.to_pylist() for c in answer.columns]):
            for key, total in zip(np.frombuffer(keys, np.uint64), np.frombuffer(totals, np.int64)):
                found[batch, int(key)] = int(total)
    want = {
        (i, int(key)): int((everything == key).sum())
        for i, keys in enumerate(batches) for key in keys if (everything == key).sum() > 1
    }
    assert found == want


def test_components_of_chains_stars_and_rings(spark):
    random.seed(6)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)]
    links += [(500 + i, 500 + (i + 1) % 9) for i in range(9)] + [(7, 7), (600, 601), (601, 600)]
    random.shuffle(links)
    got = dict(rows(components.components(spark.createDataFrame(links, "a long, b long"))))
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(300)}
    want |= {500 + i: 500 for i in range(9)} | {600: 600, 601: 600}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# Mixing

def test_targets():
    sizes = [("a", 100), ("b", 100), ("c", 100), (None, 1)]
    goal = mixing.targets(sizes, (3, 1, 2), 1.5)
    assert goal["a"] == 200 and goal[None] == 2
    assert abs(sum(goal.values()) - 1.5 * 301) < 1e-6 and abs(goal["c"] - 2 * goal["b"]) < 1e-6
    assert mixing.targets([], (1,), 1.5) == {} and mixing.targets([("a", 0)], (1,), 1.5) == {"a": 0}


def test_mix_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = docs.withColumn("source", F.when(F.col("doc_id") % 7 > 0, F.col("source")))
    for given in (docs, odd):
        taken, goal = brute.mix([tuple(r) for r in given.select("doc_id", "text", "source").collect()])
        got = mixing.mix(given).collect()
        assert {(r.doc_id, r.source): r.taken for r in got} == taken
        assert all(abs(r.target - goal[r.source]) < 1e-5 for r in got)


def test_mix_of_awkward_rows(make, awkward):
    got = mixing.mix(make(awkward))
    assert got.count() == len(awkward) and got.columns.count("size") == 1
    assert all(0 <= r.taken <= 2 * r.size for r in got.collect())
    assert mixing.mix(make([])).collect() == []
    assert rows(got) == rows(mixing.mix(make(awkward)))


# WARC

@pytest.fixture
def pages(spark, awkward):
    big = "".join(f"<p>{i} é</p>" for i in range(60_000))
    data = [(i, "http://x/" + str(n), t) for n, (i, t) in enumerate(awkward)]
    data += [
        (100, None, big), (101, "http://a b/\r\nX: y", big), (102, "u", "short"), (103, "u", "short"),
        (104, "u", "z" * 999), (105, "u", "z" * 999), (None, "u", big), (None, "u", "q" * 2000),
    ]
    return spark.createDataFrame(data, "page_id long, url string, html string"), data


def test_archives_round_trip(pages):
    frame, data = pages
    chunks = warc.read(warc.write(warc.decide(frame))).collect()
    payloads, kinds = {}, {}
    for row in sorted(chunks, key=lambda r: (r.record or "", r.chunk_no)):
        kinds.setdefault(row.record, set()).add(row.record_type)
        if row.record_type == "response" and row.record == "101":
            payloads["101"] = payloads.get("101", b"") + row.chunk
    big = data[-8][2].encode()
    assert payloads["101"] == big and sum(r.record == "101" for r in chunks) > 3
    report = warc.report(warc.read(warc.write(warc.decide(frame)), with_data=False)).collect()
    assert len(report) == len(data)
    largest = {}
    for page_id, _, html in data:
        if page_id is not None and html and len(html.encode()) >= 1000:
            largest[html] = max(page_id, largest.get(html, page_id))
    import hashlib

    want = []
    for page_id, _, html in data:
        body = (html or "").encode()
        best = largest.get(html) if len(body) >= 1000 else None
        other = best is not None and page_id != best
        want.append((page_id, len(body), hashlib.sha1(body).hexdigest(),
                     "revisit" if other else "response", best if other else None))
    assert sorted(map(tuple, report), key=str) == sorted(want, key=str)


def test_damage_is_an_error_and_empty_tables_are_not(spark, tmp_path, pages):
    frame, _ = pages
    archives = warc.write(warc.decide(frame), folder=f"file://{tmp_path}/w").collect()
    for row in archives:
        path = row.archive.removeprefix("file://")
        content = bytearray(gzip.open(path).read())
        at = content.find(b"<p>777 ")
        if at > 0:
            content[at + 3] ^= 1
            with gzip.open(path, "wb") as out:
                out.write(bytes(content))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read(spark.createDataFrame(archives)).count()
    assert warc.read(warc.write(warc.decide(frame.limit(0)))).collect() == []


def test_a_payload_unlike_its_digest_is_not_written(spark):
    pages = spark.createDataFrame([(1, "u", "x" * 600_000), (2, "u", "y")], "page_id long, url string, html string")
    decided = warc.decide(pages)
    chunks = warc.chunk_table(decided, "page_id", "url", "html").where("record = '1'")
    assert [len(r.chunk) for r in chunks.orderBy("chunk_no").collect()] == [262144, 262144, 75712]
    with pytest.raises(Exception, match="not what its digest says"):
        warc.write(decided.withColumn("html", F.concat("html", F.lit("z"))))


# The pipeline

def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    lexicon = toxicity.fit(docs, labels, id_remainder("doc_id", 5) != 0)
    left = sorted((r.doc_id, r.text, r.source) for r in docs.collect())
    left = [d for d in left if lexicon.score(d[1] or "") < 0.5]
    seen = set()
    left = [d for d in left if not ((t := brute.normalised(d[1])) in seen or seen.add(t))]
    groups = {i: c for i, _, c in brute.jaccard_components([d[:2] for d in left], 80, 5)}
    left = [d for d in left if groups[d[0]] == d[0]]
    left = [d for d in left if not brute.leaks(d[1], items)[1]]
    taken, _ = brute.mix(left)
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert {(r.doc_id, r.source): r.taken for r in got.collect()} == {
        key: n for key, n in taken.items() if n
    }


def test_short_benchmark_items_remove_no_clean_documents(spark, make, tmp_path, caplog):
    items = [(1, "the"), (2, "Is it so?"), (3, None), (4, "five Words of one item"),
             (5, " ".join(f"w{i}" for i in range(12)))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    docs = make([
        (1, "the cat"), (2, "Is it so? It is."), (3, "say five words of one item aloud"),
        (4, "five words of one"), (5, " ".join(f"w{i}" for i in range(1, 11))), (6, None),
        (7, " ".join(f"w{i}" for i in range(9))),
    ])
    with caplog.at_level("WARNING"):
        kept = corpus_pipeline.remove_leaks(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6, 7]
    assert "2 benchmark items of under 5 words" in caplog.text and "hit documents 2 times" in caplog.text
    report = corpus_pipeline.short_items(docs, spark.read.parquet(f"{tmp_path}/benchmark.parquet"), 5)
    assert rows(report) == [(1, 1, 1), (2, 3, 1)]
    kept = corpus_pipeline.remove_leaks(spark, docs, str(tmp_path), least_item_words=1)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 6, 7]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_awkward_rows(spark, make, awkward, name, stage):
    for pairs in (awkward, []):
        docs = make(pairs).select("doc_id", "text", "lang", "source", F.lit(1).alias("n_chars"), "_key")
        kept = stage(spark, docs, SMALL)
        assert kept.columns[: len(docs.columns)] == docs.columns
        assert kept.count() <= len(pairs)
