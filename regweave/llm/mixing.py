"""Mixing sources to target weights by hash-threshold histograms.

Each document has a fixed hash. What a source contributes is all documents whose hash is
below a threshold, so a smaller budget always takes a subset of a larger one, and nothing
is sorted. The threshold is found by histograms: words by source and the hash's leading
digits, the bucket in which the running sum passes the budget, and the same again inside
that bucket only, until single hashes are told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regweave.llm.common import stored

_LEVEL_BITS = 12
_HASH_BITS = 60
_COPIES = 2  # most times that a document is taken


def words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def document_hash(doc_id: str) -> Column:
    """60 bits of the id's MD5, the same in every run and engine."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, _HASH_BITS // 4), 16, 10).cast("long")


def targets(
    sizes: list[tuple[str | None, int]], weights: tuple[int, ...], share: float
) -> dict[str | None, float]:
    """Words wanted of each source: its weight's part, at most ``_COPIES`` times its size.

    ``sizes`` in the order in which the weights repeat. What a full source can't take goes
    to the others by weight. Sources fill up in the order of size by weight, so one pass in
    that order finds who is full.
    """
    left = share * sum(size for _, size in sizes)
    rows = [(source, size, weights[i % len(weights)]) for i, (source, size) in enumerate(sizes)]
    rows.sort(key=lambda row: row[1] / row[2])
    weight = sum(row[2] for row in rows)
    found = {}
    for source, size, own in rows:
        found[source] = min(float(_COPIES * size), left * own / weight)
        left -= found[source]
        weight -= own
    return found


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): documents with a smaller hash hold about the budget's words.

    ``rows`` has (source, size, hash), ``budgets`` (source, budget) with one row per source,
    whose budget is below its size.
    The document at the boundary is taken if that brings the sum nearer to the budget.
    """
    state = budgets.select("source", "budget", F.lit(0).cast("long").alias("low"))
    for level in range(1, _HASH_BITS // _LEVEL_BITS + 1):
        shift = _HASH_BITS - level * _LEVEL_BITS
        inside = rows.join(F.broadcast(state), rows["source"].eqNullSafe(state["source"])).where(
            F.shiftright("hash", shift + _LEVEL_BITS) == F.shiftright("low", shift + _LEVEL_BITS)
        ).select(rows["source"], "size", "hash", "budget", "low")
        histogram = inside.groupBy(
            "source", "budget", F.shiftright("hash", shift).alias("bucket")
        ).agg(F.sum("size").alias("words"))
        # At most 4096 buckets for each source.
        running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        sums = histogram.withColumns({"upto": running})
        passed = F.min_by(F.struct("bucket", "upto", "words"), "bucket")
        found = sums.where("upto > budget").groupBy("source", "budget").agg(passed.alias("hit"))
        state = found.select(
            "source",
            (F.col("budget") - F.col("hit.upto") + F.col("hit.words")).alias("budget"),
            F.shiftleft("hit.bucket", shift).alias("low"),
            F.col("hit.words").alias("words"),
        )
        state = rows.sparkSession.createDataFrame(state.collect(), state.schema)
    nearer = 2 * F.col("budget") > F.col("words")
    return state.select("source", (F.col("low") + nearer.cast("long")).alias("threshold"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with size, source_size, target and taken (words that the mix takes).

    Sources in code-point order, NULL last, have the weights in turn. A source whose target
    exceeds its size is taken whole, and once more below a threshold; else it is taken
    below a threshold. NULL and empty texts have size 0. An empty table gives no rows. New
    columns replace those of the same name. One row per source passes through the driver.
    """
    spark = docs.sparkSession
    own = {"size": words(F.col(text)), "__rw_hash": document_hash(doc_id)}
    rows = stored(
        docs.select(
            F.col(source).alias("source"), own["size"].alias("size"), own["__rw_hash"].alias("hash")
        ),
        "mixing",
    )
    totals = [tuple(row) for row in rows.groupBy("source").agg(F.sum("size")).collect()]
    totals.sort(key=lambda row: (row[0] is None, (row[0] or "").encode()))
    wanted = {name: round(goal, 6) for name, goal in targets(totals, weights, share).items()}
    plan = [
        (name, size, wanted[name], int(wanted[name] >= size)) for name, size in totals
    ]
    budgets = [(name, int(round(goal)) - size * whole, size) for name, size, goal, whole in plan]
    settled = {name: 1 << _HASH_BITS for name, budget, size in budgets if budget >= size}
    partly = [(name, budget) for name, budget, size in budgets if budget < size]
    if partly:
        found = _thresholds(rows, _small(spark, partly, "source string, budget long"))
        settled |= {row["source"]: row["threshold"] for row in found.collect()}
    rules = _small(
        spark,
        [(*row, settled[row[0]]) for row in plan],
        "__rw_source string, source_size long, target double, __rw_whole int, __rw_threshold long",
    )
    names = [name for name in docs.columns if name not in ("size", "source_size", "target", "taken")]
    copies = F.col("__rw_whole") + (F.col("__rw_hash") < F.col("__rw_threshold")).cast("int")
    return (
        docs.select(*names).withColumns(own)
        .join(F.broadcast(rules), F.col(source).eqNullSafe(F.col("__rw_source")))
        .select(*names, "size", "source_size", "target", (F.col("size") * copies).alias("taken"))
    )


def _small(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    return spark.createDataFrame(rows, T._parse_datatype_string(ddl))
