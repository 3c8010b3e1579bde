"""A training corpus from raw documents: five stages, each of them one of the operators.

Every stage gets all that its predecessor kept, written as Parquet and read again, and
returns what it keeps with the columns of ``documents``; the last one adds what the mix
takes of each document.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave.llm import decontaminate, exact_dedup, jaccard, mixing, toxicity
from regweave.llm.common import ascii_lower, id_remainder, stored, table

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_log = logging.getLogger(__name__)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half.

    The model learns from those labelled documents that reach this stage and whose
    remainder is not held out.
    """
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"), id_remainder("doc_id", 5) != 0)
    scored = toxicity.score(docs, lexicon, name="__rw_toxicity")
    return scored.where("__rw_toxicity < 0.5").select(*docs.columns)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, up to white space, the one with the smallest id."""
    return exact_dedup.drop_duplicates(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of 0.8 on five-word shingles, the
    document with the smallest id; exactly the other rows of the group go."""
    return jaccard.keep_one(docs, percent=80, width=5)


def short_items(docs: DataFrame, benchmark: DataFrame, least_item_words: int) -> DataFrame:
    """(item_id, n_words, n_documents): items of one to fewer than so many words, and the
    documents that hold all of their words in order."""
    words = F.size(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(_WORD), F.lit(0)))
    short = benchmark.select("item_id", "text", words.alias("n_words")).where(
        (F.col("n_words") > 0) & (F.col("n_words") < least_item_words)
    )
    scanned = decontaminate.scan(docs.select("doc_id", "text"), short.select("item_id", "text"))
    found = scanned.select(F.explode("hit_items").alias("item_id")).groupBy("item_id").count()
    counted = short.groupBy("item_id").agg(F.max("n_words").cast("long").alias("n_words"))
    named = found.select(F.col("item_id").alias("_id"), F.col("count").alias("n_documents"))
    joined = counted.join(named, F.col("item_id").cast("string") == F.col("_id"), "left")
    return joined.select("item_id", "n_words", F.coalesce("n_documents", F.lit(0)).alias("n_documents"))


def remove_leaks(
    spark: SparkSession, docs: DataFrame, sf_dir: str, least_item_words: int = 5
) -> DataFrame:
    """Documents without any ten-word window of a benchmark item.

    The one window of a shorter item is all of its words. Fewer than ``least_item_words``
    words in their order stand in documents that know nothing of an item, so such items remove
    nothing here (1 makes every item count); a warning names them and the documents that they
    would remove (``short_items``).
    """
    benchmark = table(spark, sf_dir, "benchmark")
    words = F.size(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(_WORD), F.lit(0)))
    few = benchmark.where((words > 0) & (words < least_item_words)).count()
    if few:
        report = short_items(docs, benchmark, least_item_words)
        most = report.agg(F.sum("n_documents")).first()[0]
        examples = [row.item_id for row in report.orderBy(F.desc("n_documents"), "item_id").take(5)]
        _log.warning(
            "%d benchmark items of under %d words remove nothing; they would have hit documents"
            " %d times, first of all items %s", few, least_item_words, most, examples,
        )
    scanned = decontaminate.scan(docs, benchmark.where(words >= least_item_words))
    return decontaminate.remove_documents(scanned, docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, source_size, target and taken words."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("toxicity", remove_toxic),
    ("exact dedup", remove_copies),
    ("n-gram Jaccard join", remove_near_copies),
    ("benchmark decontamination", remove_leaks),
    ("mixing sources to target weights", mix_sources),
]

#: SQL can express neither the fitted toxicity model nor the order of its learned terms.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {}
