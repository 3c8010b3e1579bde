"""Phrase collocations against a plain version."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from regweave.llm import collocations

SMALL = "/root/testdata/sf0.001"


def prose(seed, count):
    draw = random.Random(seed)
    words = "the a of cat dog sat on mat big red New York city ÉTÉ été x_y 1 \xa0".split(" ")
    weights = [9, 8, 7] + [2] * (len(words) - 3)
    docs = []
    for n in range(count):
        size = draw.randint(0, 60)
        text = "".join(
            draw.choices(words, weights)[0] + draw.choice([" ", " ", " ", " ", "\t", ". ", ",", "\n", "  "])
            for _ in range(size)
        )
        docs.append((draw.choice(["en", "en", "de", None]), text))
    return docs + [("en", None), ("fr", ""), (None, "New York city")]


def found(spark, docs, **options):
    given = spark.createDataFrame(docs, "lang string, text string")
    return collocations.phrases(given, **options)


def result(spark, docs, least=30, best=2000, **options):
    phrases, words = found(spark, docs, least=least, **options)
    rows = collocations.report(collocations.collocations(phrases), words, best)
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("shard_words", [1 << 20, 400])
def test_equals_the_plain_version(spark, shard_words):
    docs = prose(1, 150)
    got = result(spark, docs, least=5, shard_words=shard_words)
    assert got == sorted(brute.collocations(docs, least=5)) and len(got) > 50


def test_frequencies_of_texts_longer_than_shards(spark, monkeypatch):
    """Cuts inside a piece and inside a text; the overlap must not count twice."""
    draw = random.Random(3)
    body = " ".join(draw.choice("abcdefg") for _ in range(60_000))
    docs = [("en", body), ("en", body[:50_000] + ". " + body[:70_000]), ("en", "z" * 200_000 + " z z")]
    phrases, words = found(spark, docs, least=1, shard_words=9000)
    counts, totals = brute.phrase_counts(docs)
    got = {(r.lang, tuple(r.phrase.split(" "))): r.f for r in phrases.collect()}
    assert got == counts
    assert {r.lang: r.n for r in words.collect()} == totals


def test_best_are_ranked_in_salted_parts(spark):
    rows = spark.range(200_000).selectExpr(
        "if(id % 3 = 0, 'a', 'b') as lang", "id * 7919 % 1000 as score", "id"
    )
    order = [F.desc("score"), F.col("id")]
    got = collocations.best_of_each(rows, "lang", order, 50, "rank").collect()
    for lang in "ab":
        own = sorted((r for r in got if r.lang == lang), key=lambda r: r["rank"])
        want = sorted(
            (-(i * 7919 % 1000), i) for i in range(200_000) if (i % 3 == 0) == (lang == "a")
        )[:50]
        assert [(-r.score, r.id) for r in own] == want
        assert [r["rank"] for r in own] == list(range(1, 51))


def test_index_rows_are_not_moved_again(spark, plan):
    shards, _ = collocations.index_shards(spark.createDataFrame(prose(2, 20), "lang string, text string"))
    again = shards.groupBy("shard").count()
    assert "Exchange" not in plan(again)


def test_intervals_of_an_index():
    numbers = np.array([0, 1, 2, 1, 2, 3, 0, 1, 2, 3, 0], np.uint32)
    index = collocations.PhraseIndex([b"", b"a", b"b", b"c"], collocations.transform(numbers), 0)
    index.keep(np.ones(3, bool))
    assert index.counts.tolist() == [3, 3, 2]
    index.extend()
    assert sorted(index.counts.tolist()) == [1, 2, 3]  # ba, bc, ab
    index.keep(index.counts > 1)
    index.extend()
    assert index.counts.tolist() == [2]  # abc


def test_empty_tables_other_columns_and_lengths(spark):
    assert result(spark, []) == []
    assert result(spark, [(None, None), ("en", "  ")]) == []
    docs = spark.createDataFrame([("en", "p q. " * 40, 1, "x")], "lang string, text string, shard int, f string")
    phrases, words = collocations.phrases(docs, longest=2)
    assert sorted((r.phrase, r.f) for r in phrases.collect()) == [("p", 40), ("p q", 40), ("q", 40)]
    with pytest.raises(ValueError):
        collocations.phrases(docs, longest=5)
