"""Keyed tables in buckets: an upsert reads and writes only the buckets that its keys fall into.

A table is a folder with the files of its buckets and a log of versions, each naming the folder of every bucket.
New files are written beside the old ones and count from the moment their version is written; a run that is lost
before leaves files that no version names. Readers of an older version still find its files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import as_list, col, free_names, nan_to_null, require_columns

BUCKETS = 64  # of a new table; choose so many that a bucket is a few files
VERSIONS = "_versions"  # readers of the files skip such names
_LOG = "version bigint, bucket int, folder string, description string"


class Version:
    """What one version of a table consists of."""

    def __init__(self, number: int, keys: list[str], buckets: int, schema: T.StructType, folders: dict[int, str]):
        self.number, self.keys, self.buckets, self.schema, self.folders = number, keys, buckets, schema, folders

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")


def latest(spark: SparkSession, uri: str, version: int | None = None) -> Version:
    """The newest version, or the one with the given number."""
    try:
        log = spark.read.schema(_LOG).json(f"{uri.rstrip('/')}/{VERSIONS}/*")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no table of buckets in {uri}") from error
        raise
    number = log.agg(F.max("version")).first()[0] if version is None else version
    rows = log.filter(F.col("version") == number).collect()  # one row for each bucket
    if not rows:
        raise FileNotFoundError(f"no version {number} in {uri}")
    about = json.loads(rows[0]["description"])
    folders = {r["bucket"]: r["folder"] for r in rows if r["folder"]}
    return Version(number, about["keys"], about["buckets"], T.StructType.fromJson(about["schema"]), folders)


def read_buckets(spark: SparkSession, uri: str, only: list[int] | None = None, version: int | None = None) -> DataFrame:
    """The table, or the rows of some of its buckets."""
    return _read(spark, uri, latest(spark, uri, version), only)


def _read(spark: SparkSession, uri: str, at: Version, only: list[int] | None) -> DataFrame:
    folders = [f"{uri.rstrip('/')}/{at.folders[b]}" for b in sorted(at.folders) if only is None or b in only]
    return spark.read.schema(at.schema).parquet(*folders) if folders else spark.createDataFrame([], at.schema)


def create_buckets(df: DataFrame, uri: str, keys: list[str] | str, buckets: int = BUCKETS) -> None:
    """A new table with the rows of ``df``; ``keys`` decide the bucket of a row."""
    keys = as_list(keys)
    require_columns(df, keys, "Bucket key")
    if buckets < 1:
        raise ValueError("a table needs a bucket")
    df = nan_to_null(df)
    _write(df, uri, Version(0, keys, buckets, _nullable(df.schema), {}))


def upsert_buckets(spark: SparkSession, uri: str, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """Put ``merge(existing, incoming)`` in place of the buckets that the keys of ``incoming`` fall into, which are returned.

    ``merge`` gets the rows of these buckets only, and may give only rows that belong there, as a keyed upsert does. It
    may add columns; rows of other buckets have nulls there. An upsert that finds its version written meanwhile fails
    and changes nothing.
    """
    now = latest(spark, uri)
    require_columns(incoming, now.keys, "Bucket key")
    # Hashes depend on the type, so keys are taken as the table has them.
    incoming = nan_to_null(incoming).withColumns({k: col(k).cast(now.schema[k].dataType) for k in now.keys})
    touched = sorted(r[0] for r in incoming.select(now.bucket()).distinct().collect())  # at most the number of buckets
    if not touched:
        return []
    result = merge(_read(spark, uri, now, touched), incoming)
    kept = {f.name: f for f in _nullable(result.schema).fields}
    lost = [f.name for f in now.schema.fields if kept.get(f.name) is None or kept[f.name].dataType != f.dataType]
    if lost:
        raise ValueError(f"columns missing or of another type after the merge: {lost}")
    schema = T.StructType([*now.schema.fields, *[f for n, f in kept.items() if n not in now.schema.names]])
    rest = {b: f for b, f in now.folders.items() if b not in touched}
    _write(result.select(*[col(n) for n in schema.names]), uri, Version(now.number + 1, now.keys, now.buckets, schema, rest), touched)
    return touched


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def _write(df: DataFrame, uri: str, then: Version, touched: list[int] | None = None) -> None:
    spark, uri = df.sparkSession, uri.rstrip("/")
    name = free_names(df.columns, "bucket")[0]
    folder = f"data/{then.number}-{uuid.uuid4().hex}"
    # Rows of a bucket come together; adaptive execution gives a large bucket to several tasks.
    dealt = df.withColumn(name, then.bucket()).hint("rebalance", name)
    dealt.write.partitionBy(name).parquet(f"{uri}/{folder}")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{uri}/{folder}").select("path")
    made = listed.select(F.regexp_extract("path", rf"/{name}=(\d+)/[^/]*$", 1).cast("int").alias("bucket")).distinct()
    full = {r["bucket"] for r in made.collect() if r["bucket"] is not None}
    if touched is not None and not full <= set(touched):
        raise ValueError("the merge gave rows of buckets that no incoming key falls into")
    folders = then.folders | {b: f"{folder}/{name}={b}" for b in full}
    about = json.dumps({"keys": then.keys, "buckets": then.buckets, "schema": then.schema.jsonValue()})
    rows = [(then.number, b, folders.get(b), about) for b in range(then.buckets)]
    try:
        spark.createDataFrame(rows, _LOG).coalesce(1).write.json(f"{uri}/{VERSIONS}/{then.number}")
    except AnalysisException as error:
        if "PATH_ALREADY_EXISTS" in str(error):
            raise FileExistsError(f"version {then.number} of {uri} has been written meanwhile") from error
        raise
