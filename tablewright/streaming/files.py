"""Streams of files through the same operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.nulls import as_list, col, free_names, is_orderable, nan_to_null
from ..operators.clean import clean, drop_missing, fill_missing, filter_rows, standardize_columns
from ..operators.quality import split_violations
from .commits import stream_id, write_batch


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    max_files: int = 100,
    fmt: str = "parquet",
    name_filter: str | None = None,
    **options,
) -> DataFrame:
    """A folder as a stream, ``max_files`` new files per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.options(**options).load(folder)


def clean_stream(
    df: DataFrame,
    config: dict | None = None,
    event_time: str | None = None,
    delay: str = "1 hour",
    slices: int = 8,
) -> DataFrame:
    """The row-wise cleaning steps on a stream.

    Duplicates need ``event_time``: the first arrival within ``delay`` is kept and older
    state is dropped. A stateful step gets all rows of a key in one task and adaptive
    execution does not apply to streams, so each key is first reduced in ``slices`` parts
    (1 turns this off). Steps that need the whole table run per micro-batch, see ``write_cleaned``.
    """
    config = config or {}
    for key in ("remove_outliers", "dtype_conversions"):
        if config.get(key):
            raise ValueError(f"'{key}' needs a whole table; use write_cleaned")
    df = nan_to_null(df)
    if config.get("remove_duplicates", True):
        if not event_time:
            raise ValueError("duplicates on a stream need event_time, to bound the state")
        df = df.withWatermark(event_time, delay)
        subset = as_list(config.get("dedup_cols")) or df.columns
        if slices > 1:
            content = [col(f.name) for f in df.schema.fields if is_orderable(f.dataType)]
            piece = free_names(df.columns, "_slice")[0]
            df = df.withColumn(piece, F.pmod(F.xxhash64(*content, F.spark_partition_id()), F.lit(slices)))
            df = df.dropDuplicatesWithinWatermark([*subset, piece]).drop(piece)
        df = df.dropDuplicatesWithinWatermark(subset)
    strategy = config.get("missing_strategy", "drop")
    if strategy == "drop":
        df = drop_missing(df)
    elif strategy == "fill":
        if not config.get("fill_values"):
            raise ValueError("a stream needs fill_values: means and modes need a whole table")
        df = fill_missing(df, config["fill_values"])
    if config.get("filter_expr"):
        df = filter_rows(df, config["filter_expr"], on_error="skip")
    return standardize_columns(df) if config.get("standardize_columns", True) else df


def write_batchwise(
    df: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    uri: str,
    checkpoint: str | None = None,
    once: bool = True,
    name: str | None = None,
) -> StreamingQuery:
    """Apply a table step to each micro-batch and keep its result under ``uri``, each batch exactly once.

    A batch has a folder of its own and a commit, written last; ``commits.read_sink`` reads what is committed, and a
    batch that runs again after its commit is not written twice. Progress is kept below ``uri`` unless ``checkpoint``
    names a place, so a later start goes on where the last one ended. A stream belongs to its source folder; streams
    of several folders into one place need a ``name`` or a ``checkpoint`` each.
    """
    place = checkpoint or progress_of(uri, name)

    def write(batch: DataFrame, number: int) -> None:
        write_batch(step(batch), uri, stream_id(batch.sparkSession, place), number)

    return _start(df.writeStream.foreachBatch(write), df, place, once)


def write_cleaned(df: DataFrame, config: dict, uri: str, checkpoint: str | None = None, once: bool = True, name: str | None = None):
    """Full cleaning per micro-batch: statistics are those of the batch."""
    return write_batchwise(df, lambda batch: clean(batch, config), uri, checkpoint, once, name)


def write_quarantine(
    df: DataFrame,
    rules: dict,
    good_uri: str,
    bad_uri: str,
    checkpoint: str | None = None,
    once: bool = True,
    name: str | None = None,
    out: str = "violated_rules",
) -> StreamingQuery:
    """Good rows to one place, violating rows with their rule names in ``out`` to another; places as for ``write_batchwise``."""
    place = checkpoint or progress_of(good_uri, name)

    def write(batch: DataFrame, number: int) -> None:
        stream = stream_id(batch.sparkSession, place)
        batch = batch.persist()
        try:
            good, bad = split_violations(batch, rules, out)
            write_batch(good, good_uri, stream, number)
            write_batch(bad, bad_uri, stream, number)
        finally:
            batch.unpersist()

    return _start(df.writeStream.foreachBatch(write), df, place, once)


def write_append(
    df: DataFrame,
    uri: str,
    checkpoint: str | None = None,
    once: bool = True,
    state_partitions: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to Parquet files, each row exactly once, over any number of starts and progress folders.

    Places and ``name`` as for ``write_batchwise``; read with ``commits.read_sink``.
    ``state_partitions`` sets the number of state stores of stateful steps, which a stream
    keeps from its first start on; the default is the session's shuffle partitions.
    """
    spark = df.sparkSession
    if state_partitions is None:
        return write_batchwise(df, lambda batch: batch, uri, checkpoint, once, name)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", state_partitions)
    try:  # a stream takes its own copy of the settings when it starts
        return write_batchwise(df, lambda batch: batch, uri, checkpoint, once, name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def progress_of(uri: str, name: str | None = None) -> str:
    """Where a sink keeps the progress of a stream; readers of the sink skip such folders."""
    return f"{uri.rstrip('/')}/_progress" + (f"-{name}" if name else "")


def _start(writer, df: DataFrame, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()
