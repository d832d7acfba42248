"""Joins against a side that is unique on the key, safe when the other side piles up on few keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_list, col, free_names, is_orderable

HOT_ROWS = 1_000_000  # rows per key from which a key is spread over several tasks
BROADCAST_ROWS = 100_000  # most hot keys sent to every executor: the largest; any other has fewer than this share of the rows
BROADCAST_BYTES = 32 << 20  # most bytes of their texts
SAMPLED_ROWS = 10_000  # rows of a hot key that the sample should still show
UNMATCHED_SLICES = 4096  # tasks over which rows without a key are spread


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str] | str,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    measure: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, on, how)`` where ``right`` has one row per key.

    Keys with more than ``hot_rows`` rows on the left are cut into slices of about that
    size, and their single right row is copied once per slice. Other keys join as usual.
    ``measure`` is a cheaper table with at least the rows of ``left`` per key, to count on.
    """
    on = as_list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join does not support {how!r}")
    spark = left.sparkSession
    seed, slot, slices_of = free_names([*left.columns, *right.columns], "_seed", "_slot", "_slices")
    counts, n = key_counts(left if measure is None else measure, on, hot_rows)
    counted = counts.filter(F.col(n) > hot_rows).orderBy(F.desc(n)).limit(BROADCAST_ROWS)
    hot = counted.select(*[col(c) for c in on], F.ceil(F.col(n) / hot_rows).cast("int").alias(slices_of))
    # Keys are bounded in number; the longest of them go first out of the bytes that may be sent.
    size = sum((F.octet_length(col(c).cast("string")) for c in on), F.lit(16))
    found, held = [], 0
    for row in hot.withColumn(seed, size).toLocalIterator():
        held += row[seed] or 16
        if held > BROADCAST_BYTES:
            break
        found.append(row[:-1])
    if not found:
        return left.join(right, on, how)
    hot = F.broadcast(spark.createDataFrame(found, hot.schema))
    # Partition id and row content are the same when a task is run again, and copies of one
    # row that sit in different partitions still get different slices.
    content = [col(f.name) for f in left.schema.fields if is_orderable(f.dataType)]
    sliced = left.withColumn(seed, F.xxhash64(*content, F.spark_partition_id())).join(hot, on, "left")
    # A missing key matches nothing, so its rows may go anywhere.
    number = F.coalesce(F.col(slices_of), F.lit(1)).cast("long")
    slices = F.when(_known(on), number).otherwise(UNMATCHED_SLICES)
    sliced = sliced.withColumn(slot, F.pmod(seed, slices)).drop(seed, slices_of)
    copied = right.join(hot, on, "left")
    copied = copied.withColumn(slot, F.explode(F.sequence(F.lit(0).cast("long"), number - 1))).drop(slices_of)
    return sliced.join(copied, [*on, slot], how).drop(slot)


def key_counts(df: DataFrame, on: list[str], hot_rows: int) -> tuple[DataFrame, str]:
    """Rows per key, and the name of their column: exact for small limits, else estimated from a sample.

    The sample only decides how work is cut up, never what the result is. It keeps the
    shuffle small where most keys are rare.
    """
    share = min(1.0, SAMPLED_ROWS / hot_rows)
    keys = df.select(*[col(c) for c in on])
    if share < 1.0:
        keys = keys.sample(share, seed=17)
    name = free_names(on, "_rows")[0]
    return keys.groupBy(*[col(c) for c in on]).agg((F.count(F.lit(1)) / share).cast("long").alias(name)), name


def _known(on: list[str]):
    known = F.lit(True)
    for c in on:
        known = known & col(c).isNotNull()
    return known
