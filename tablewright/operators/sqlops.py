"""Spark SQL over one registered table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import nan_to_null, require_frame
from ..functions.predicates import lenient

TEXT_BYTES = 16 << 20  # longest query text


def sql_transform(
    df: DataFrame, query: str | None = None, table_name: str = "source_data", sql_file: str | None = None
) -> DataFrame:
    """Run ``query`` (or the text in ``sql_file``, which wins) with ``df`` visible as ``table_name``.

    NaN is missing there, and a division by zero has no result. The view is dropped again at once: the returned plan is already resolved.
    """
    require_frame(df, "sql_transform")
    if not query and not sql_file:
        raise ValueError("sql_transform requires either 'sql_query' or 'sql_file'")
    spark = df.sparkSession
    df = nan_to_null(df)
    if sql_file:
        query = read_text(df, sql_file)
    shadowed = None
    if spark.catalog.tableExists(table_name) and spark.catalog.getTable(table_name).isTemporary:
        shadowed = f"_saved_{uuid.uuid4().hex}"
        spark.table(table_name).createOrReplaceTempView(shadowed)
    df.createOrReplaceTempView(table_name)
    try:
        with lenient(spark):
            return spark.sql(query)
    finally:
        if shadowed:
            spark.table(shadowed).createOrReplaceTempView(table_name)
            spark.catalog.dropTempView(shadowed)
        else:
            spark.catalog.dropTempView(table_name)


def read_text(df: DataFrame, uri: str) -> str:
    """A text file of at most ``TEXT_BYTES`` from any file system Spark can reach."""
    files = df.sparkSession.read.format("binaryFile").load(uri)
    found = files.select("path", "length").orderBy("path").limit(2).collect()
    if not found or not found[0]["length"]:
        raise FileNotFoundError(f"SQL file is empty or missing: {uri}")
    if len(found) > 1 or found[0]["length"] > TEXT_BYTES:
        raise ValueError(f"{uri} is not one file of at most {TEXT_BYTES} bytes")
    return files.select(F.decode("content", "UTF-8")).first()[0]


def apply_sql_transform(df: DataFrame, sql_query: str, table_name: str = "data") -> DataFrame:
    return sql_transform(df, sql_query, table_name)
