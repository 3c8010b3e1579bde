"""Quality rules under weak supervision.

Each rule looks at a few counts of a text and votes bad, good, or abstains. No rule decides
alone: expectation-maximisation estimates how often each one that votes is right on good and
on bad texts, and the posterior probability that a text is good replaces the filter that all
rules must pass. Abstaining says nothing. The votes of a text are one of ``3 ** len(RULES)`` patterns, so a table of
any size is fitted on the counts of its patterns, which hold all that the estimate needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import append_columns, as_bytes

_SPACES = b" \t\n\x0b\x0c\r"
_CONTINUED = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(0x41, 0x5B))
_ASCII = bytes(range(0x80))
_DIGITS = bytes(range(0x30, 0x3A))
_SYMBOLS = b"#*$%&|<>"
_BARE = bytes(b for b in range(0x80) if not chr(b).isalnum() and b not in _SPACES)
_NOT_LETTER = bytes(b for b in range(0xC0) if not (b < 0x80 and chr(b).isalpha()))
_IS_END = np.isin(np.arange(256), list(b".!?"))
_IS_SPACE = np.isin(np.arange(256), list(_SPACES))
_IS_SIGN = np.isin(np.arange(256), list(_BARE))
_IS_JOINT = np.isin(np.arange(256), list(b"-'"))

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
    "n_letters", "n_upper", "n_digits", "n_ends", "n_bare", "n_doubled", "n_odd",
)


@dataclass(frozen=True)
class Rule:
    """Tests on the counts of a text; a text that passes neither gets no vote."""

    name: str
    bad: Callable[[dict], np.ndarray]
    good: Callable[[dict], np.ndarray]


RULES = (
    Rule("length", lambda c: c["n_words"] < 10, lambda c: c["n_words"] >= 50),
    Rule(
        "word length",
        lambda c: (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 15 * c["n_words"]),
        lambda c: (c["word_chars"] >= 3 * c["n_words"]) & (c["word_chars"] <= 10 * c["n_words"]),
    ),
    Rule(
        "symbols", lambda c: 10 * c["n_symbols"] > c["n_words"],
        lambda c: 100 * c["n_symbols"] <= c["n_words"],
    ),
    Rule(
        "repeated lines", lambda c: 10 * c["n_dup_lines"] > 3 * c["n_lines"],
        lambda c: (c["n_dup_lines"] == 0) & (c["n_lines"] > 2),
    ),
    Rule(
        "repeated phrases", lambda c: 100 * c["n_repeat_words"] > 20 * c["n_words"],
        lambda c: (100 * c["n_repeat_words"] <= 2 * c["n_words"]) & (c["n_words"] >= 20),
    ),
    # Distinct words grow with about the root of all words.
    Rule(
        "vocabulary", lambda c: (c["n_distinct"] ** 2 < 4 * c["n_words"]) & (c["n_words"] >= 20),
        lambda c: (c["n_distinct"] ** 2 >= 25 * c["n_words"]) & (c["n_words"] >= 20),
    ),
    Rule(
        "capitals", lambda c: (5 * c["n_upper"] > 2 * c["n_letters"]) & (c["n_letters"] >= 20),
        lambda c: (8 * c["n_upper"] <= c["n_letters"]) & (c["n_letters"] >= 20),
    ),
    Rule(
        "digits", lambda c: 4 * c["n_digits"] > c["word_chars"],
        lambda c: (20 * c["n_digits"] <= c["word_chars"]) & (c["n_words"] >= 10),
    ),
    Rule(
        "sentences",
        lambda c: ((c["n_ends"] == 0) | (2 * c["n_ends"] > c["n_words"])) & (c["n_words"] >= 20),
        lambda c: (4 * c["n_ends"] <= c["n_words"]) & (60 * c["n_ends"] >= c["n_words"]),
    ),
    Rule(
        "bare signs", lambda c: 10 * c["n_bare"] > c["n_words"],
        lambda c: (50 * c["n_bare"] <= c["n_words"]) & (c["n_words"] >= 10),
    ),
    Rule(
        "letters", lambda c: 4 * c["n_letters"] < 3 * c["word_chars"],
        lambda c: (8 * c["n_letters"] >= 7 * c["word_chars"]) & (c["n_words"] >= 10),
    ),
    Rule(
        "doubled signs", lambda c: 10 * c["n_doubled"] > c["n_words"],
        lambda c: (50 * c["n_doubled"] <= c["n_words"]) & (c["n_words"] >= 10),
    ),
    Rule(
        "odd signs", lambda c: 4 * c["n_odd"] > c["n_words"],
        lambda c: (10 * c["n_odd"] <= c["n_words"]) & (c["n_words"] >= 10),
    ),
)


def repeated_words(numbers: np.ndarray, distinct: int, width: int = 5) -> int:
    """How many of the numbers (below ``distinct``) lie in a window found twice or more."""
    count = len(numbers) - width + 1
    if count < 2 or distinct == len(numbers):
        return 0
    keys, values = numbers[:count], distinct
    for i in range(1, width):
        if values * distinct >= 1 << 62:  # name the different beginnings anew
            _, keys = np.unique(keys, return_inverse=True)
            values = int(keys.max()) + 1
        keys = keys * distinct + numbers[i : i + count]
        values *= distinct
    _, keys, counts = np.unique(keys, return_inverse=True, return_counts=True)
    step = np.zeros(len(numbers) + 1, np.int64)
    again = np.flatnonzero(counts[keys] > 1)
    np.add.at(step, again, 1)
    np.add.at(step, again + width, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def counts_of(data: bytes) -> tuple[int, ...]:
    """``COUNTS`` of one text in UTF-8. Letters are a-z, A-Z and characters above U+007F, capitals
    are A-Z; ``n_ends`` counts ``.!?`` in front of white space or the end, ``n_bare`` words
    without a letter or digit, ``n_doubled`` signs behind the same sign, ``n_odd`` signs other
    than one behind a word or a hyphen or apostrophe inside one."""
    words = data.split()
    distinct = dict.fromkeys(words)
    numbers = np.empty(0, np.int64)
    if len(words) > len(distinct):
        index = dict(zip(distinct, range(len(distinct))))
        numbers = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    size = len(data)
    raw = np.frombuffer(data, np.uint8)
    ends, signs, spaces = _IS_END[raw], _IS_SIGN[raw], _IS_SPACE[raw]
    plain = np.concatenate([[False], ~signs & ~spaces, [False]])
    last = np.append(spaces, True)[1:]  # white space or the end follows
    usual = plain[:-2] & (last | _IS_JOINT[raw] & plain[2:])
    return (
        len(words), len(data.translate(None, _SPACES + _CONTINUED)),
        size - len(data.translate(None, _SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(numbers, len(distinct)), len(lines), len(distinct),
        len(data.translate(None, _NOT_LETTER)), size - len(data.translate(None, _UPPER)),
        size - len(data.translate(None, _DIGITS)),
        int((ends & last).sum()), len(words) - len(data.translate(None, _BARE).split()),
        int((signs[1:] & (raw[1:] == raw[:-1])).sum()),
        int((signs & ~usual).sum()),
    )


def votes_of(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Votes by text and rule: 0 bad, 1 none, 2 good. Texts without a word vote by length only."""
    empty = counts["n_words"] == 0
    votes = np.ones((len(empty), len(RULES)), np.int64)
    for i, rule in enumerate(RULES):
        usable = ~empty if i else np.ones_like(empty)
        bad = rule.bad(counts) & usable
        votes[rule.good(counts) & usable & ~bad, i] = 2
        votes[bad, i] = 0
    return votes


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text but with its counts (``COUNTS``) and the ``pattern`` of votes,
    a number of one digit to the base of three for each rule. NULL counts as empty."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = as_bytes(batch.column(batch.schema.get_field_index(text)))
        found = np.array([counts_of(data) for data in texts], np.int64)
        columns = dict(zip(COUNTS, found.T))
        pattern = votes_of(columns) @ (3 ** np.arange(len(RULES)))
        return [pa.array(column) for column in found.T] + [pa.array(pattern)]

    ddl = ", ".join(f"{name} long" for name in (*COUNTS, "pattern"))
    return append_columns(docs, ddl, compute).drop(text)


@dataclass
class Model:
    """``failing[y, rule]``: how often the rule, where it votes, votes bad on bad (0) and on
    good (1) texts. ``good``: the share of good texts."""

    failing: np.ndarray
    good: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that texts with these votes are good."""
        votes = patterns[:, None] // 3 ** np.arange(len(RULES)) % 3
        bad, good = np.log(self.failing), np.log(1 - self.failing)
        logs = (votes == 0) @ (bad[1] - bad[0]) + (votes == 2) @ (good[1] - good[0])
        return 1 / (1 + np.exp(-logs - np.log(self.good / (1 - self.good))))

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """By rule, how often its vote on a good and on a bad text is right."""
        right = zip(RULES, 1 - self.failing[1], self.failing[0])
        return {rule.name: (float(good), float(bad)) for rule, good, bad in right}


#: What is believed of any rule before its votes are seen: on a bad text it votes bad now and
#: then, on a good one hardly ever.
BELIEF = (0.3, 0.01)


def estimate(
    patterns: np.ndarray, counts: np.ndarray, good: float = 0.8, trust: float = 0.2,
    rounds: int = 200,
) -> Model:
    """Expectation-maximisation over the counts of patterns.

    ``trust``: the weight of ``BELIEF``, and of ``good`` as the share of good texts, against
    the votes on a class's texts; it keeps "good" and "bad" from trading places. Without texts
    the model is the belief alone.
    """
    prior = np.repeat(np.array(BELIEF)[:, None], len(RULES), axis=1)
    model = Model(prior, good)
    total = counts.sum()
    if not total:
        return model
    votes = patterns[:, None] // 3 ** np.arange(len(RULES)) % 3
    failed, voted = (votes == 0).astype(float), (votes != 1).astype(float)
    for _ in range(rounds):
        right = model.posterior(patterns)
        weights = np.stack([(1 - right) * counts, right * counts])
        mass = weights.sum(axis=1)
        own = trust * mass[:, None] + 1e-9
        failing = (weights @ failed + own * prior) / (weights @ voted + own)
        share = float((mass[1] + trust * total * good) / (total * (1 + trust)))
        settled = np.abs(failing - model.failing).max() < 1e-9
        model = Model(failing, share)
        if settled:
            break
    return model


def fit(measured: DataFrame, **options) -> Model:
    """A model of all rows of ``measure``; the driver gets one number for each of at most
    ``3 ** len(RULES)`` patterns."""
    found = measured.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern")
    rows = found.toPandas()
    return estimate(rows["pattern"].to_numpy(np.int64), rows["n"].to_numpy(np.float64), **options)


def base_failed() -> Column:
    """Fewer than ten words, or over a fifth of the words in repeated windows."""
    words = F.col("n_words")
    return (words < 10) | (100 * F.col("n_repeat_words") > 20 * words)


def judge(measured: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``measured`` with ``quality`` (posterior probability of a good text), ``base_failed``
    and ``kept``: not ``base_failed`` and a quality of at least ``least``.

    The table of posteriors that is sent to all tasks has a row for each pattern that occurs.
    """
    spark = measured.sparkSession
    patterns = measured.select("pattern").distinct().toPandas()["pattern"].to_numpy(np.int64)
    rows = list(zip(patterns.tolist(), model.posterior(patterns).tolist())) if len(patterns) else []
    known = F.broadcast(spark.createDataFrame(rows, "pattern long, quality double"))
    return (
        measured.join(known, "pattern").withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    )


def report(judged: DataFrame) -> DataFrame:
    """One row per document: counts, verdicts, quality and the votes, one sign a rule."""
    digits = F.reverse(F.lpad(F.conv(F.col("pattern").cast("string"), 10, 3), len(RULES), "0"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality", F.translate(digits, "012", "-.+").alias("votes"),
    )
