"""File sinks, per-batch writes and materialised intermediates."""

from __future__ import annotations

from collections.abc import Callable
from itertools import batched

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..functions.nulls import require_frame
from ..session import scratch_uri
from .files import BATCH_FORMATS, file_address, load_intermediate

MODES = ("error", "overwrite", "append")

# Times are written with all six digits, which the readers take as they are.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _write(write, uri: str) -> None:
    try:
        write()
    except AnalysisException as error:
        if "PATH_ALREADY_EXISTS" in str(error):
            raise FileExistsError(f"already exists: {uri}; ask for overwrite or append") from error
        raise


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "error",
    sep: str = ",",
    header: bool = True,
    encoding: str = "utf-8",
    single_file: bool = False,
    storage: dict[str, str] | None = None,
) -> None:
    """Write a folder of CSV files; ``single_file`` only for tables known to be small.

    Every file of the folder has its own header line, which readers of folders expect.
    """
    require_frame(df, "write_csv")
    if not path:
        raise ValueError("CSV sink requires 'path'")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    df = df.coalesce(1) if single_file else df
    writer = (
        df.write.mode(mode)
        .option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("quote", '"')
        .options(**TIMES)
        .options(**(storage or {}))
    )
    _write(lambda: writer.csv(path), path)


def write_object(df: DataFrame, uri: str, overwrite: bool = False, storage: dict[str, str] | None = None) -> None:
    """Write to any file-system URI, the format taken from the suffix; other suffixes are CSV.

    ``storage`` holds access settings for this write only, see ``object_settings``.
    """
    require_frame(df, "write_object")
    uri = file_address(uri)
    fmt = next((f for s, f in BATCH_FORMATS.items() if uri.endswith(s)), "csv")
    mode = "overwrite" if overwrite else "error"
    writer = df.write.mode(mode).options(**(storage or {}))
    if fmt == "csv":
        write_csv(df, uri, mode, storage=storage)
    elif fmt == "json":
        _write(lambda: writer.option("ignoreNullFields", "false").options(**TIMES).json(uri), uri)
    else:
        _write(lambda: writer.parquet(uri), uri)


def write_batches(df: DataFrame, fn: Callable[[list[dict]], None], batch_size: int = 1000) -> None:
    """Call ``fn`` with lists of records, on the executors; it runs again when a task is retried."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")

    def send(rows):
        for batch in batched((r.asDict(recursive=True) for r in rows), batch_size):
            fn(list(batch))

    df.foreachPartition(send)


def materialize(df: DataFrame, uri: str | None = None, fmt: str = "parquet", storage: dict[str, str] | None = None) -> DataFrame:
    """Write the table and read it back, so that later steps start from the files.

    Without ``uri`` it goes to the shared folder of the session. ``storage`` holds access settings for ``uri``.
    """
    require_frame(df, "materialize")
    spark: SparkSession = df.sparkSession
    uri = file_address(uri) if uri else scratch_uri(spark, "intermediate")
    writer = df.write.mode("overwrite").options(**(storage or {}))
    if fmt == "parquet":
        writer.parquet(uri)
    elif fmt == "csv":
        write_csv(df, uri, "overwrite", storage=storage)
    elif fmt == "json":
        writer.option("ignoreNullFields", "false").options(**TIMES).json(uri)
    else:
        raise ValueError(f"unsupported format: {fmt}")
    return load_intermediate(spark, uri, fmt, storage)
