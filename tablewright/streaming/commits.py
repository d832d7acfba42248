"""What a folder of micro-batches holds: a commit for each batch of each stream, written after its files.

Readers and repeated batches go by the commits. A batch is known by the id that Spark keeps in the progress
folder of its stream, so streams with progress folders of their own never replace each other's files.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

BATCH_COLUMN = "batch"  # folders of a sink, one for each batch
COMMITS = "_commits"  # readers of the sink's files skip such names
SCHEMA = "stream string, number bigint, file string"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream has from its first start on."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def commits(spark: SparkSession, uri: str, stream: str | None = None, number: int | None = None) -> DataFrame:
    """``stream``, ``number`` and ``file`` (its name below the sink's folder; null for a batch without files)."""
    place = f"{uri.rstrip('/')}/{COMMITS}/{stream or '*'}/{'*' if number is None else number}"
    try:
        return spark.read.schema(SCHEMA).json(place)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], SCHEMA)
        raise


def write_batch(batch: DataFrame, uri: str, stream: str, number: int) -> None:
    """Write the files of a batch and then its commit; a batch that has a commit is not written again."""
    spark, uri = batch.sparkSession, uri.rstrip("/")
    if not commits(spark, uri, stream, number).isEmpty():
        return
    if BATCH_COLUMN in {c.lower() for c in batch.columns}:
        raise ValueError(f"column '{BATCH_COLUMN}' is the sink's own: rename it first")
    folder = f"{BATCH_COLUMN}={stream}-{number}"
    batch.write.mode("overwrite").parquet(f"{uri}/{folder}")
    files = spark.read.schema(batch.schema).parquet(f"{uri}/{folder}").inputFiles()
    rows = [(stream, number, f"{folder}/{f.rsplit('/', 1)[-1]}") for f in files] or [(stream, number, None)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").json(f"{uri}/{COMMITS}/{stream}/{number}")


def read_sink(spark: SparkSession, uri: str) -> DataFrame:
    """The rows of all committed batches, with ``batch``, the name of their folder; half-written batches are not seen."""
    uri = uri.rstrip("/")
    files = [f"{uri}/{r['file']}" for r in commits(spark, uri).filter("file IS NOT NULL").select("file").distinct().toLocalIterator()]
    if not files:
        raise FileNotFoundError(f"no committed batch in {uri}")
    return spark.read.option("basePath", uri).parquet(*files)

