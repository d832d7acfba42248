"""Row conditions, given as Spark SQL text or as a Column."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def condition(cond: str | Column) -> Column:
    return F.expr(cond) if isinstance(cond, str) else cond


@contextmanager
def lenient(spark: SparkSession) -> Iterator[None]:
    """Frames made inside give NULL where an operation has no result, as a division by zero.

    Expressions take over the setting when they are resolved, so it does not reach other frames.
    """
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def names_text(df: DataFrame, cond: str | Column) -> bool:
    """Does a condition given as text name a text column?"""
    return isinstance(cond, str) and any(c in cond for c, kind in df.dtypes if kind == "string")


def compares_unlike(df: DataFrame, cond: str | Column) -> str | None:
    """The error of a condition that reads text cells as numbers or dates, where some are not; else None.

    Only a condition given as text that names a text column is tried, on the columns it reads.
    """
    if df.isStreaming or not names_text(df, cond):
        return None
    try:
        df.agg(F.count_if(condition(cond))).first()
    except PySparkException as error:
        if "CAST_INVALID_INPUT" in str(error):
            return str(error).split("\n")[0]
    return None


# What tells a missing value from others; without these words and without calls, a condition that is
# true with a missing value is true whatever stands in its place.
_TELLS_MISSING = re.compile(r"\b(?:is|null|case|exists|select)\b|<=>|[\w`]\s*\(", re.I)


def tells_missing(cond: str) -> bool:
    return bool(_TELLS_MISSING.search(re.sub(r"\b(?:in|and|or|not|between)\s*\(", "=(", re.sub(r"'[^']*'", "''", cond), flags=re.I)))


def holds(cond: str | Column) -> Column:
    """True or false, never NULL: an undecidable row does not hold."""
    return F.coalesce(condition(cond), F.lit(False))


def violates(cond: str | Column) -> Column:
    return ~holds(cond)


def why_invalid(df: DataFrame, cond: str | Column) -> str | None:
    """The analysis error of ``cond`` against ``df``, or None when it resolves."""
    try:
        df.filter(condition(cond)).schema
    except AnalysisException as error:
        return str(error).split("\n")[0]
    return None
