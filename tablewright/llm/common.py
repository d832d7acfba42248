"""Small helpers that several operators of this package share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package as ship  # noqa: F401  operators and the pipeline ship the package before they use it

#: The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"

MODEL_BYTES = 64 << 20  # most bytes of a vocabulary or model sent to every executor
SLICE_CHARS = 1 << 20  # characters of text a task holds in pieces at a time
PART_CHARS = 4 << 20  # characters of text that are worth a partition, and so a file, of their own
PART_ROWS = 250_000  # rows of a few numbers that are


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    made = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        made.append(name)
    return made


def column(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str = "text") -> Column:
    """The text, a missing one as the empty text."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def partitions(spark: SparkSession, number: int | None = None) -> int:
    return number or int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(spark: SparkSession, amount: float, each: int) -> int:
    """Partitions for ``amount`` at ``each`` a partition: at least one a core, at most those of a shuffle."""
    return min(partitions(spark), max(spark.sparkContext.defaultParallelism, math.ceil(amount / each)))


def gathered(df: DataFrame, amount: float, each: int) -> DataFrame:
    """A table about to be written, in as many partitions as ``amount`` is worth; a large one as it is.

    Hadoop starts a process for each of several steps of a local file, and until it is its own program that
    process holds all memory of its executor once more. So a small table is not cut into a file per shuffle partition.
    """
    n = parts_for(df.sparkSession, amount, each)
    return df.coalesce(n) if n < partitions(df.sparkSession) else df


def send(spark: SparkSession, content: bytes):
    """Broadcast a vocabulary or model, whose size does not depend on the corpus; refused above the bound."""
    if len(content) > MODEL_BYTES:
        raise ValueError(f"{len(content)} bytes are above the bound of {MODEL_BYTES} for a broadcast model")
    return spark.sparkContext.broadcast(content)


def read_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about ``chars`` bytes of text; a text is never cut."""
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index(text)).nbytes
        step = max(1, int(batch.num_rows * chars / max(sizes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
