"""Quality scores of a stream so far: every batch adds its counts, the scores are made of the sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import build_rules, partial_counts, results_of, roll_up
from .commits import read_sink
from .files import write_batchwise


def write_quality(df: DataFrame, rules: dict, uri: str, checkpoint: str | None = None, once: bool = True, name: str | None = None) -> StreamingQuery:
    """Keep the counts of each micro-batch under ``uri``, each batch exactly once; places as for ``write_batchwise``.

    A batch leaves one row for each rule that counts rows, and one for each distinct digest of rules about duplicates.
    """
    return write_batchwise(df, lambda batch: partial_counts(batch, rules), uri, checkpoint, once, name)


def running_quality(spark: SparkSession, uri: str, schema: str | T.StructType, rules: dict | None = None) -> dict:
    """What ``check_quality`` says of all rows that came so far; ``schema`` is that of the stream.

    Duplicates are told by digests, as with ``duplicate_method="fingerprint"``. Before the first batch there are no rows.
    """
    empty = spark.createDataFrame([], schema)
    try:
        parts = read_sink(spark, uri).drop("batch")
    except FileNotFoundError:
        parts = partial_counts(empty, rules)
    return roll_up(results_of(parts, build_rules(empty, rules)), rules or {}, len(empty.columns))
