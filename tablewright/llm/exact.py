"""Exact deduplication with the heavy hitters taken out of the shuffle (operator 3).

Texts are equal when they are the same after deleting blanks. A Misra-Gries summary per partition
finds the digests that may be frequent; an exact count over all rows verifies them and finds the row
of each that stays. These winners are few by the summary's bound, so they are broadcast and their
copies are settled where they are read. All other digests have at most two ``COUNTERS``-ths of the
rows each and are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import freeze
from .common import BLANKS, PART_CHARS, column, fresh, gathered, text_of

COUNTERS = 1024  # counters of a summary, and so the most digests that are broadcast
WINNERS_PART = 64  # of these, rows that are worth a partition


def digest(text: Column) -> Column:
    """SHA-256 of the text without blanks, in lower-case hex."""
    return F.sha2(F.translate(text, BLANKS, ""), 256)


def summary(counts: dict[str, int], counters: int) -> dict[str, int]:
    """At most ``counters`` entries: the largest, less the largest that goes."""
    if len(counts) <= counters:
        return counts
    ranked = sorted(counts.values(), reverse=True)
    less = ranked[counters]
    return {key: n - less for key, n in counts.items() if n > less}


def heavy_hitters(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``sha`` of at most ``counters`` digests, among them all that have more than two ``counters``-ths of the rows.

    A summary counts a digest too low by at most a ``counters``-th of its partition's rows, so such a digest keeps a
    sum of more than a ``counters``-th of all rows, and no more than ``counters`` digests can have that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for entry in pc.value_counts(batch.column(0)).to_pylist():
                counts[entry["values"]] = counts.get(entry["values"], 0) + entry["counts"]
            counts = summary(counts, counters)
        # A digest that is frequent in all may be seen once in each partition, so every counter goes on.
        yield pa.RecordBatch.from_pydict({"sha": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    counted = digests.select("sha").mapInArrow(run, "sha string, n bigint")
    return counted.groupBy("sha").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "sha").limit(counters).select("sha")


def _staying() -> list[Column]:
    return [F.col("n_points").desc(), F.col("doc_id").asc_nulls_last()]


def winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The heavy digests with exact ``group_size``, and ``keep_id`` and ``keep_points`` of the row that stays.

    A digest counts as heavy from 3 copies on, so the split is at work on small tables too. The table
    is written before it is broadcast and has at most ``counters`` rows of fixed width.
    """
    heavy = F.broadcast(heavy_hitters(digests, counters))
    # max_by over the id as text would not do: the smallest id wins, missing ids last
    rank = F.struct("n_points", F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("back"))
    exact = digests.join(heavy, "sha").groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), F.max(rank).alias("top"))
    chosen = exact.filter("group_size > 2").select("sha", (-F.col("top.back")).alias("keep_id"), F.col("top.n_points").alias("keep_points"), "group_size")
    return freeze(gathered(chosen, counters, WINNERS_PART), "winners")


def digests_of(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_points`` (code points of the original text) and ``sha``, as a table in the shared folder."""
    text = text_of()
    return freeze(docs.select(column("doc_id").cast("bigint").alias("doc_id"), F.char_length(text).alias("n_points"), digest(text).alias("sha")), "digests")


def exact_duplicates(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the most code points stays, then the smallest ``doc_id`` (null last).
    Null texts are empty, and all empty texts are equal. Repeated rows count each; rows that agree in
    ``doc_id`` and length with the one that stays are all marked as kept. Other columns are not read.
    """
    digests = digests_of(docs)
    heavy = winners(digests, counters)
    marked = digests.join(F.broadcast(heavy), "sha", "left")
    settled = marked.filter("group_size IS NOT NULL")
    group = Window.partitionBy("sha").orderBy(*_staying()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = marked.filter("group_size IS NULL").select(
        "sha", "doc_id", "n_points", F.first("doc_id").over(group).alias("keep_id"), F.first("n_points").over(group).alias("keep_points"), F.count(F.lit(1)).over(group).alias("group_size")
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))
    return settled.select(*rest.columns).unionByName(rest).select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, one per group of equal texts, with all their columns.

    Rules as in ``exact_duplicates``; of rows that agree in ``doc_id`` and length one stays, chosen by
    a hash of all columns that can be hashed.
    """
    digests = digests_of(docs)
    heavy = winners(digests, counters)
    chars = digests.agg(F.sum("n_points")).first()[0] or 0
    sha, points, keep_id, keep_points, place = fresh(docs, "_sha", "_points", "_keep_id", "_keep_points", "_place")
    text = text_of()
    rows = docs.withColumns({sha: digest(text), points: F.char_length(text)})
    known = heavy.select(F.col("sha").alias(sha), F.col("keep_id").alias(keep_id), F.col("keep_points").alias(keep_points))
    # Copies of a heavy text go here, before the shuffle; its winner goes on like any other row.
    stays = F.col(keep_points).isNull() | (column("doc_id").eqNullSafe(F.col(keep_id)) & (F.col(points) == F.col(keep_points)))
    rows = rows.join(F.broadcast(known), sha, "left").filter(stays).drop(keep_id, keep_points)
    content = F.xxhash64(*[column(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()])
    order = Window.partitionBy(sha).orderBy(F.col(points).desc(), column("doc_id").asc_nulls_last(), content)
    staying = rows.withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1).select(*[column(c) for c in docs.columns])
    return gathered(staying, chars, PART_CHARS)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""


def op3_exact_dedup(spark, folder: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
