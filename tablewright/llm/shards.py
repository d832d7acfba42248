"""Sharding by extendible hashing (operator 8).

A document belongs to the shard that holds the first bits of its hash. The directory starts with one
shard; only a shard above its byte limit splits, on the next bit, until every shard fits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import freeze
from .common import column, fresh, text_of

LIMIT = 1 << 20  # bytes of a shard of the query
HALF = 60  # bits of the hash of the id; as many of the row itself follow, for repeated ids
MORE_BITS = 8  # bits by which shards that are still too large are looked at again


def hash_bits(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id as text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("bigint")


def assign(rows: DataFrame, limit: int, h: str = "h", r: str = "r", size: str = "bytes") -> DataFrame:
    """``rows`` with ``shard`` (its bits as text, empty for a single shard), ``shard_bytes`` and ``shard_docs``.

    ``h`` and ``r`` hold 60 bits each, ``size`` the bytes; they are dropped. ``rows`` is read several
    times and must be stored. Bytes are summed per cell of a depth below which no even hash needs to
    split, so the directory is made of a few cells per shard, whatever the number of rows; only rows
    of cells that are themselves too large are looked at again with more bits. The directory grows with
    the rows, so it is joined by shuffle and never broadcast.
    """
    total = rows.agg(F.sum(size)).first()[0] or 0
    wanted = math.ceil(math.log2(max(1.0, total / limit)))

    def prefix(depth: int) -> Column:
        return F.substring(F.concat(F.lpad(F.bin(column(h)), HALF, "0"), F.lpad(F.bin(column(r)), HALF, "0")), 1, depth)

    out = [c for c in rows.columns if c not in (h, r, size)]
    cell = fresh(rows, "_cell")[0]
    settled, first, last = None, 0, wanted + 4
    while True:
        cells = freeze(rows.groupBy(prefix(last).alias(cell)).agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("docs")), "cells")
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(last)))).withColumn("shard", F.expr(f"substring(`{cell}`, 1, depth)"))
        sums = freeze(levels.groupBy("shard", "depth").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs")), "levels")
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.col("depth") == 2 * HALF)
        # Sums fall with depth: the first depth of a cell that fits is its shard.
        fitting = levels.select(cell, "shard").join(sums.filter(fits).hint("merge"), "shard")
        found = freeze(fitting.groupBy(cell).agg(F.min_by(F.struct("shard", "shard_bytes", "shard_docs"), "depth").alias("s")), "directory")
        placed = rows.withColumn(cell, prefix(last)).join(found.hint("merge"), cell).select(*[column(c) for c in out], "s.shard", "s.shard_bytes", "s.shard_docs")
        settled = placed if settled is None else settled.unionByName(placed)
        large = cells.select(cell).join(found.hint("merge"), cell, "left_anti")
        if large.isEmpty():
            return settled
        rows = freeze(rows.withColumn(cell, prefix(last)).join(large.hint("merge"), cell, "left_semi").drop(cell), "large-cells")
        first, last = last + 1, min(last + MORE_BITS, 2 * HALF)


def _row_bits() -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 4)


def shard_documents(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, bytes, shard, shard_depth, shard_bytes, shard_docs``.

    Bytes are those of the text in UTF-8, none for a null text. Shards are above ``limit`` only where
    they hold a single document. A null ``doc_id`` hashes as an empty one. Rows with the same id have
    the same first 60 bits; beyond these, bits of a number that each row gets when it is first stored
    tell them apart, so even a third of all rows under one id splits. Other columns are not read.
    """
    rows = docs.select(column("doc_id"), F.octet_length(text_of()).cast("bigint").alias("bytes"))
    rows = freeze(rows.select("doc_id", "bytes", hash_bits(F.col("doc_id")).alias("h"), _row_bits().alias("r"), F.col("bytes").alias("size")), "sizes")
    found = assign(rows, limit, size="size")
    return found.select("doc_id", "bytes", "shard", F.length("shard").alias("shard_depth"), "shard_bytes", "shard_docs")


def write_shards(docs: DataFrame, uri: str, limit: int = LIMIT) -> None:
    """Write all columns of ``docs`` below ``uri``, a folder ``shard=…`` with one file for each shard."""
    h, r, size = fresh(docs, "_h", "_r", "_size")
    stored = freeze(docs.withColumns({h: hash_bits(column("doc_id")), r: _row_bits(), size: F.octet_length(text_of()).cast("bigint")}), "sharded")
    found = assign(stored, limit, h, r, size).withColumn("shard", F.concat(F.lit("b"), "shard"))
    found.drop("shard_bytes", "shard_docs").repartition("shard").sortWithinPartitions("shard").write.partitionBy("shard").parquet(uri)


ORACLE = f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
         lpad(bin(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT), {HALF}, '0') AS bits
  FROM documents),
p AS (
  SELECT depth, substr(bits, 1, depth) AS shard, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM d, range(0, {HALF + 1}) AS g(depth) GROUP BY ALL),
f AS (
  SELECT d.doc_id, d.bytes, min(p.depth) AS shard_depth, min_by(p.shard, p.depth) AS shard,
         min_by(p.shard_bytes, p.depth) AS shard_bytes, min_by(p.shard_docs, p.depth) AS shard_docs
  FROM d JOIN p ON substr(d.bits, 1, p.depth::INT) = p.shard
  WHERE p.shard_bytes <= {LIMIT} OR p.shard_docs = 1
  GROUP BY ALL)
SELECT doc_id, bytes, shard, shard_depth::INT AS shard_depth, shard_bytes, shard_docs FROM f
"""


def op8_sharding(spark, folder: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{folder}/documents.parquet"))
