"""Quality rules: counts and estimate against plain versions, verdicts against labels."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from regweave.llm import quality, queries

DATA = "/root/testdata/sf0.01"


def test_base_counts_equal_the_plain_version(make, awkward):
    repeated = [(20, "a b c d e f " * 9), (21, "x y\n\nx y\nx y \n"), (22, "## |a| <b> $5 %"), (23, "a b c d e a b c d e")]
    docs = awkward + repeated
    measured = quality.measure(make(docs))
    got = sorted((tuple(r) for r in measured.select("doc_id", *brute.QUALITY_COUNTS).collect()), key=str)
    assert got == sorted(((i, *brute.quality_counts(t)) for i, t in docs), key=str)
    assert quality.measure(make([])).collect() == []
    assert "_key" in measured.columns and "text" not in measured.columns


@pytest.mark.parametrize("text, doubled, odd, ends, bare", [
    ("", 0, 0, 0, 0), ("a-b don't, x. y", 0, 0, 1, 0), ("a## | (b) !! c!!", 3, 8, 2, 2),
    ("é. ü?\n-z", 0, 1, 2, 0), (".", 0, 1, 1, 1),
])
def test_counts_of_signs(text, doubled, odd, ends, bare):
    counts = dict(zip(quality.COUNTS, quality.counts_of(text.encode())))
    assert (counts["n_doubled"], counts["n_odd"], counts["n_ends"], counts["n_bare"]) == (
        doubled, odd, ends, bare
    )


def test_repeated_words_with_many_distinct_words():
    draw = random.Random(1)
    words = [draw.randrange(30_000) for _ in range(20_000)]
    words += words[100:900] + [40_000 + i for i in range(50)] + words[5:9]
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    numbers = np.array([names[w] for w in words])
    text = " ".join(f"w{w}" for w in words)
    assert quality.repeated_words(numbers, len(names)) == brute.quality_counts(text)[4] >= 1600


def plain_estimate(rows, good=0.8, trust=0.2, rounds=30):
    """Expectation-maximisation text by text, with lists."""
    rules = range(len(rows[0]))
    failing = [[quality.BELIEF[y] for _ in rules] for y in (0, 1)]
    share = good
    for _ in range(rounds):
        right = []
        for votes in rows:
            odds = [1 - share, share]
            for y in (0, 1):
                for r, vote in enumerate(votes):
                    odds[y] *= {0: failing[y][r], 1: 1, 2: 1 - failing[y][r]}[vote]
            right.append(odds[1] / sum(odds))
        for y in (0, 1):
            weights = [p if y else 1 - p for p in right]
            own = trust * sum(weights) + 1e-9
            for r in rules:
                failed = sum(w for w, votes in zip(weights, rows) if votes[r] == 0)
                voted = sum(w for w, votes in zip(weights, rows) if votes[r] != 1)
                failing[y][r] = (failed + own * quality.BELIEF[y]) / (voted + own)
        share = (sum(right) + trust * len(rows) * good) / (len(rows) * (1 + trust))
    return failing, share


def test_estimate_equals_the_plain_version():
    draw = random.Random(2)
    rules = len(quality.RULES)
    rows = []
    for _ in range(300):
        bad = draw.random() < 0.3
        rows.append([draw.choices([0, 1, 2], [3, 2, 5] if bad else [0.1, 3, 7])[0] for _ in range(rules)])
    codes = [sum(v * 3**r for r, v in enumerate(votes)) for votes in rows]
    patterns, counts = np.unique(codes, return_counts=True)
    model = quality.estimate(patterns, counts.astype(float), rounds=30)
    failing, share = plain_estimate(rows)
    assert np.allclose(model.failing, failing) and abs(model.good - share) < 1e-9
    shown = model.accuracies()
    assert set(shown) == {rule.name for rule in quality.RULES}
    assert all(good > 0.9 and bad > 0.2 for good, bad in shown.values())


def test_verdicts_against_labels_never_used(spark):
    judged = queries.op12_quality(spark, DATA)
    assert judged.columns[:8] == ["doc_id", "n_words", *brute.QUALITY_COUNTS[1:], "base_failed", "kept"]
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    rows = judged.where("n_words >= 10").join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.label == 1]
    bad = [r.kept for r in rows if r.label == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.2
    assert all(r.base_failed == (r.n_words < 10 or 5 * r.n_repeat_words > r.n_words) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)
    assert all(0 <= r.quality <= 1 and len(r.votes) == len(quality.RULES) for r in rows)


def test_odd_rows_and_empty_table(spark, make, awkward):
    measured = quality.measure(make(awkward))
    judged = quality.report(quality.judge(measured, quality.fit(measured))).collect()
    assert len(judged) == len(awkward)
    assert not any(r.kept for r in judged if r.n_words < 10)
    none = quality.measure(make([]))
    assert quality.judge(none, quality.fit(none)).collect() == []


@pytest.mark.parametrize("size", [1, 7])
def test_model_of_few_texts_is_the_belief(size):
    pattern = np.array([sum(2 * 3**r for r in range(len(quality.RULES)))])
    model = quality.estimate(pattern, np.array([float(size)]))
    assert model.posterior(pattern)[0] > 0.9
