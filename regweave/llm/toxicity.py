"""Toxicity: a weighted lexicon found by Aho-Corasick in folded text.

Folding undoes disguises: case, Cyrillic and Greek look-alikes, digits and signs in place of
letters. The lexicon holds whole words and word beginnings with weights learned from
labelled rows, added to a small hand-written start list. Matches inside exception phrases
don't count. The weights found are normalised by the length of the text and turned into a
probability by a logistic curve fitted on the same rows.

Fitting uses at most ``max_rows`` labelled rows, drawn by a hash of the id, and learns words of
3 to 24 letters and beginnings of 5 to 8. The fitted model is a few thousand short terms, whatever the size of the corpus.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import append_columns, stored

# Letters that look like Latin ones, and signs that stand for letters.
_HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i",
}
_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_FOLD = str.maketrans(
    _HOMOGLYPHS | _SIGNS | {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
)
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")

#: Terms that any model starts from, and phrases in which they are harmless.
START_TERMS = (
    "idiot", "stupid", "moron", "trash", "worthless", "disgusting", "pathetic", "loser", "clown",
    "scum", "imbecile", "vermin", "subhuman", "retard", "bastard", "asshole", "bitch",
)
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash collection", "trash folder",
    "clown fish", "circus clown", "clown car", "sore loser", "loser bracket",
    "worthless currency", "stupid mistake",
)
_START_WEIGHT = 2.0


def fold(text: str) -> str:
    return text.lower().translate(_FOLD)


@dataclass
class Lexicon:
    """Terms with weights (a trailing ``*`` marks a word beginning) and the fitted curve."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-3.0, 1.0, 0.2)
    automaton: object = field(default=None, repr=False)

    def build(self) -> Lexicon:
        """The automaton of all terms; a term may be a word, a beginning or both."""
        machine = ahocorasick.Automaton()
        entries: dict[str, list] = {}
        for term, weight in self.weights.items():
            begins = term.endswith("*")
            entries.setdefault(term.rstrip("*"), []).append((begins, weight))
        for phrase in self.exceptions:
            entries.setdefault(phrase, []).append((None, 0.0))
        for term, uses in entries.items():
            machine.add_word(term, (len(term), uses))
        machine.make_automaton()
        self.automaton = machine
        return self

    def features(self, text: str) -> tuple[float, float]:
        """(summed weights, summed weights for each hundred words) of a text."""
        if self.automaton is None:
            self.build()
        folded = fold(text)
        hits, excused = {}, []
        last = len(folded) - 1
        for end, (length, uses) in self.automaton.iter(folded):
            start = end - length + 1
            if start and folded[start - 1].isalpha():
                continue
            whole = end == last or not folded[end + 1].isalpha()
            for begins, weight in uses:
                if begins is None:
                    if whole:
                        excused.append((start, end))
                elif begins or whole:
                    # The strongest of the terms that begin here stands for the word.
                    hits[start] = max(hits.get(start, 0.0), weight)
        if not hits:
            return 0.0, 0.0
        if excused:
            hits = _outside(hits, sorted(excused))
        total = sum(hits.values())
        return total, 100.0 * total / (folded.count(" ") + 1 + 50)

    def score(self, text: str) -> float:
        total, dense = self.features(text)
        base, by_total, by_density = self.curve
        margin = base + by_total * math.log1p(total) + by_density * math.log1p(dense)
        return 1.0 / (1.0 + math.exp(-margin))


def _outside(hits: dict[int, float], spans: list[tuple[int, int]]) -> dict[int, float]:
    """The hits that start in none of the spans, which come by start; one pass over both."""
    left, reach, i = {}, -1, 0
    for at in sorted(hits):
        while i < len(spans) and spans[i][0] <= at:
            reach = max(reach, spans[i][1])
            i += 1
        if at > reach:
            left[at] = hits[at]
    return left


def _terms(text: str) -> set[str]:
    """Words and word beginnings of the folded text."""
    found = set()
    for word in set(_WORD.findall(fold(text))):
        if 3 <= len(word) <= 24:
            found.add(word)
        found.update(word[:n] + "*" for n in range(5, min(len(word), 9)))
    return found


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = {0: Counter(), 1: Counter()}
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[label].update(_terms(text or ""))
        terms = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(terms, pa.string()),
                pa.array([counts[1][term] for term in terms], pa.int64()),
                pa.array([counts[0][term] for term in terms], pa.int64()),
            ],
            names=["term", "toxic", "clean"],
        )


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method, slightly regularised."""
    ones = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(ones @ beta, -30, 30)))
        gradient = ones.T @ (y - p) - 0.1 * beta
        hessian = (ones * (p * (1 - p))[:, None]).T @ ones + 0.1 * np.eye(3)
        beta += np.linalg.solve(hessian, gradient)
    return tuple(float(b) for b in beta)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    use: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_rows: int = 20_000,
    max_terms: int = 2_000,
    min_documents: int = 5,
) -> Lexicon:
    """A lexicon from labelled documents; ``use`` says which rows of ``labels`` may be used.

    Labels of several rows for one id count as toxic if any says so; NULL ids and labels are
    left out. Of rows that repeat an id the text that sorts first counts, once, so at most
    ``max_rows`` texts are counted and collected. Without any usable label the start list and a default curve remain. A term
    needs ``min_documents`` toxic documents and clearly more than its share of them.
    """
    usable = labels if use is None else labels.where(use)
    sample = (
        usable.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
        .where("_id is not null and _label is not null")
        .groupBy("_id").agg(F.greatest(F.least(F.max("_label"), F.lit(1)), F.lit(0)).alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    )
    texts = stored(
        docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
        .join(F.broadcast(sample), "_id")
        .groupBy("_id", "_label").agg(F.min("_text").alias("_text")).select("_text", "_label"),
        "labelled",
    )
    seen = {row["_label"]: row["count"] for row in texts.groupBy("_label").count().collect()}
    toxic, clean = seen.get(1, 0), seen.get(0, 0)
    weights = {term: _START_WEIGHT for term in START_TERMS}
    if not toxic or not clean:
        return Lexicon(weights)
    counted = (
        texts.mapInArrow(_count_terms, "term string, toxic long, clean long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= min_documents)
    )
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(t / (toxic + 1)) - F.log(c / (clean + 1))
    sure = odds / F.sqrt(1 / t + 1 / c)  # standard errors above chance
    learned = (
        counted.select("term", odds.alias("odds"), sure.alias("sure"))
        .where("odds > 1.5 and sure > 3.5")
        .orderBy(F.desc("sure"), "term").limit(max_terms)
    )
    weights |= {row["term"]: min(5.0, row["odds"]) for row in learned.collect()}
    lexicon = Lexicon(weights)
    rows = append_columns(texts, "total double, dense double", _featurer(lexicon, "_text"))
    found = rows.select("total", "dense", "_label").toPandas()
    x = np.log1p(found[["total", "dense"]].to_numpy(float))
    lexicon.curve = _curve(x, found["_label"].to_numpy(float))
    return lexicon


def _featurer(lexicon: Lexicon, text: str):
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [lexicon.features(value or "") for value in batch.column(text).to_pylist()]
        return [pa.array([row[i] for row in found], pa.float64()) for i in (0, 1)]

    return compute


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every whole text; NULL scores as empty.

    A column of that name is replaced. Nothing is shuffled.
    """
    plain = Lexicon(lexicon.weights, lexicon.exceptions, lexicon.curve)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if plain.automaton is None:
            plain.build()
        values = batch.column(text).to_pylist()
        return [pa.array([plain.score(value or "") for value in values], pa.float64())]

    return append_columns(docs, f"`{name}` double", compute)
