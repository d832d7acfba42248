"""Skip runs whose configuration and input have not changed."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import col

SCHEMA = "pipeline string, config_hash string, content string, recorded_at timestamp, reset boolean"
FILE_NOTES = "_files"  # below the ledger; readers of the runs skip such names


def config_hash(config: dict) -> str:
    """16 hex digits over the configuration with sorted keys."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:16]


def fingerprint(df: DataFrame) -> DataFrame:
    """rows and an order-free hash sum of the whole content: one partial aggregate, no row shuffle."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_digest(df)).alias("digest"))


def row_digest(df: DataFrame) -> Column:
    """A hash of the row; maps count as their entries in order."""
    return F.xxhash64(*[_hashable(col(f.name), f.dataType) for f in df.schema.fields]).cast("decimal(38,0)")


def _hashable(c: Column, kind: T.DataType) -> Column:
    """A form without maps, equal exactly where the value is."""
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return F.array_sort(F.transform(F.map_entries(c), lambda e: _hashable(e, entry)))
    if isinstance(kind, T.ArrayType) and _has_map(kind):
        return F.transform(c, lambda e: _hashable(e, kind.elementType))
    if isinstance(kind, T.StructType) and _has_map(kind):
        return F.when(c.isNotNull(), F.struct(*[_hashable(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]))
    return F.to_json(c) if isinstance(kind, T.VariantType) else c


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def content_of(df: DataFrame) -> str:
    row = fingerprint(df).first()
    return f"{row['rows']}:{row['digest']}"


FILES = "file string, size bigint, changed timestamp, rows bigint, digest decimal(38,0)"


def content_of_files(spark: SparkSession, ledger: str, path: str | list[str], fmt: str, storage: dict[str, str] | None = None) -> str:
    """The content of files as ``content_of`` gives it, from what the ledger knows of each.

    A file is known by path, size and time of change. Only unknown files are read, and what they hold is added to
    the ledger; where all are known no column is read. Text formats (``csv``, ``json``) count by their lines.
    """
    listed = spark.read.options(**(storage or {})).format("binaryFile").load(path)  # names and sizes; contents are not opened
    now = listed.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"), "path")
    place = f"{ledger.rstrip('/')}/{FILE_NOTES}"
    known = _stored(spark, place, FILES).groupBy("file", "size", "changed").agg(F.first("rows").alias("rows"), F.first("digest").alias("digest"))
    same = ["file", "size", "changed"]
    new = [r["path"] for r in now.join(known, same, "left_anti").select("path").orderBy("path").toLocalIterator()]
    if new:
        read = _files_read(spark, path, new, fmt, storage or {})
        digests = read.groupBy(F.col("_file").alias("file")).agg(F.count("_digest").alias("rows"), F.sum("_digest").alias("digest"))
        # A file without rows is known as well.
        found = now.join(known, same, "left_anti").select(*same).join(digests, "file", "left")
        found.select(*same, F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("digest", F.lit(0)).cast("decimal(38,0)").alias("digest")).write.mode("append").parquet(place)
        known = _stored(spark, place, FILES).groupBy(*same).agg(F.first("rows").alias("rows"), F.first("digest").alias("digest"))
    row = now.join(known, same).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.sum("digest").alias("digest")).first()
    return f"{row['rows']}:{row['digest']}"


def _files_read(spark: SparkSession, path, new: list[str], fmt: str, storage: dict[str, str]) -> DataFrame:
    """``_file`` and ``_digest`` of each row of the new files."""
    reader = spark.read.options(**storage)
    if fmt != "parquet":
        lines = reader.text(new)
        return lines.select(F.col("_metadata.file_path").alias("_file"), F.xxhash64("value").cast("decimal(38,0)").alias("_digest"))
    rows = reader.schema(spark.read.options(**storage).parquet(*([path] if isinstance(path, str) else path)).schema)
    if isinstance(path, str) and not any(c in path for c in "*?[{") and not path.endswith(tuple(new)):
        rows = rows.option("basePath", path)  # values that stand in the names of folders count too
    rows = rows.parquet(*new)
    return rows.select(F.col("_metadata.file_path").alias("_file"), row_digest(rows).alias("_digest"))


def _entries(spark: SparkSession, ledger: str) -> DataFrame:
    return _stored(spark, ledger, SCHEMA)


def _stored(spark: SparkSession, place: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(place)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise


def unchanged(spark: SparkSession, ledger: str, pipeline: str, config: dict, content: str) -> bool:
    """Was the last successful run of ``pipeline`` made with this configuration and this content?"""
    own = _entries(spark, ledger).filter(F.col("pipeline") == pipeline)
    last = own.orderBy(F.col("recorded_at").desc()).limit(1).collect()
    if not last or last[0]["reset"]:
        return False
    return (last[0]["config_hash"], last[0]["content"]) == (config_hash(config), content)


def record(spark: SparkSession, ledger: str, pipeline: str, config: dict, content: str) -> None:
    """Append after a run has succeeded, with the content it was made from."""
    _append(spark, ledger, (pipeline, config_hash(config), content, _now(), False))


def reset(spark: SparkSession, ledger: str, pipeline: str) -> None:
    """The next run of ``pipeline`` is made in any case."""
    _append(spark, ledger, (pipeline, None, None, _now(), True))


def _append(spark: SparkSession, ledger: str, entry: tuple) -> None:
    spark.createDataFrame([entry], SCHEMA).coalesce(1).write.mode("append").parquet(ledger)


def _now() -> datetime:
    return datetime.now(timezone.utc)
