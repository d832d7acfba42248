"""Mixing sources to target weights by Poisson replication (operator 1), in DataFrame operations only.

Every row of a source is repeated a Poisson number of times. The mean is the source's target size over
its size, so that the expected mixture has the target weights. The count inverts the distribution
at a number in [0, 1) hashed from seed and ``doc_id``: the same row gets the same count in any run,
partitioning or retry.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import freeze
from .common import PART_CHARS, column, fresh, parts_for, text_of

STEP = 16.0  # largest mean that is inverted at once; larger ones are sums of several numbers
TERMS = 80  # terms of a distribution of mean STEP after which no hashed number is left (below 2**-70)
SOURCES = 20_000  # most sources whose rates are broadcast
SOURCE_CHARS = 4 << 20  # most characters of their names in all
SLICES = 64  # over which each source is spread where rates are too many to broadcast


def uniform(*parts: Column) -> Column:
    """A multiple of 2**-52 in [0, 1), hashed from the parts."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: dict[str, float], other: float = 1.0, budget: float | None = None) -> DataFrame:
    """``source``, ``size`` (characters, and one for the end of each text) and ``rate``, the mean of its rows' counts.

    ``weights`` are relative and need not sum to anything; a source without a weight has ``other``, and
    weights of sources without rows do not count. A null source is a source of its own. ``budget`` is
    the size of the mixture, by default that of ``docs``.
    """
    if other < 0 or any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    sizes = docs.select(column("source").cast("string").alias("source"), (F.char_length(text_of()) + 1).cast("bigint").alias("size"))
    sizes = freeze(sizes.groupBy("source").agg(F.sum("size").alias("size")), "source-sizes")
    # One value however many weights there are, taken apart into a table of its own.
    listed = json.dumps({str(name): float(weight) for name, weight in weights.items()})
    named = docs.sparkSession.range(1).select(F.explode(F.from_json(F.lit(listed), "map<string,double>")).alias("name", "weight"))
    weighed = sizes.join(named, F.col("source") == F.col("name"), "left").select("source", "size", F.coalesce("weight", F.lit(float(other))).alias("weight"))
    total = weighed.agg(F.sum("weight").alias("w"), F.sum("size").alias("s")).first()
    if not total["w"]:
        return weighed.select("source", "size", F.lit(0.0).alias("rate"))
    goal = float(total["s"] if budget is None else budget)
    return weighed.select("source", "size", (F.col("weight") / F.lit(float(total["w"])) * F.try_divide(F.lit(goal), F.col("size"))).alias("rate"))


def _inverse(rate: Column, seed: int, key: Column) -> Column:
    """The Poisson count of a row."""
    parts = F.greatest(F.ceil(rate / F.lit(STEP)).cast("int"), F.lit(1))  # a filter on the rate may come later in the plan
    mean = rate / parts
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all"))

    def term(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), (state["c"] + p).alias("c"), F.array_append(state["all"], state["c"] + p).alias("all"))

    sums = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, term, lambda state: state["all"])
    return parts, sums, lambda sums_column: F.aggregate(
        F.sequence(F.lit(1), F.col("parts")),
        F.lit(0),
        lambda total, i: total + F.size(F.filter(sums_column, lambda c: c <= uniform(F.lit(str(seed)), key, i.cast("string")))),
    )


def mix_sources(docs: DataFrame, weights: dict[str, float], other: float = 1.0, budget: float | None = None, seed: int = 7, copy: str = "copy", parts: int | None = None) -> DataFrame:
    """The mixture: all columns of ``docs`` and ``copy`` (1, 2, …), in a global random order.

    The order is that of a hash of seed, ``doc_id`` and copy, over partitions (``parts``, or as many as its
    expected size is worth) and within them. Rows with the same ``doc_id``, repeated or not, get the same
    count; a null ``doc_id`` is a value like any other. Null and empty texts have the size of their end alone. Rows of a source with weight 0 go.
    An empty table gives an empty table. The column named ``copy`` gets underscores if it is taken.

    Two passes: sizes per source (combined before the shuffle), then one shuffle of the mixture. Rates
    are broadcast after their number and the length of their names were checked; beyond the bound
    they are joined with every source spread over ``SLICES`` keys.
    """
    spark = docs.sparkSession
    name, rates_source, sums, times, number, order, slot, expected, parts_column = fresh(docs, copy, "_source", "_sums", "_times", "_number", "_order", "_slot", "_expected", "parts")
    if parts_column != "parts":
        return _renamed(docs, "parts", lambda d: mix_sources(d, weights, other, budget, seed, copy, parts))
    rates = source_rates(docs, weights, other, budget).filter("rate > 0")
    key = F.coalesce(column("doc_id").cast("string"), F.lit(""))
    many, table, count = _inverse(F.col("rate"), seed, key)
    rates = freeze(rates.select(F.col("source").alias(rates_source), many.alias("parts"), table.alias(sums), (F.col("size") * F.col("rate")).alias(expected)), "rates")
    bound = rates.agg(F.count(F.lit(1)), F.sum(F.coalesce(F.char_length(rates_source), F.lit(0))), F.sum(expected)).first()
    same = column("source").cast("string").eqNullSafe(F.col(rates_source))
    if bound[0] <= SOURCES and (bound[1] or 0) <= SOURCE_CHARS:
        joined = docs.join(F.broadcast(rates), same)
    else:
        spread = rates.withColumn(slot, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SLICES - 1).cast("bigint"))))
        own = F.pmod(F.xxhash64(column("doc_id").cast("string"), text_of()), F.lit(SLICES).cast("bigint"))
        joined = docs.withColumn(slot + "own", own).join(spread, same & (F.col(slot + "own") == F.col(slot)))
    counted = joined.withColumn(times, count(F.col(sums))).filter(F.col(times) > 0)
    copies = counted.select(*[column(c) for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(times))).alias(number))
    n = parts or parts_for(spark, bound[2] or 0, PART_CHARS)
    placed = copies.withColumn(order, uniform(F.lit(f"{seed}|order"), key, F.col(number).cast("string")))
    # The hash is spread evenly, so equal ranges of it are equal partitions, and no sample is needed.
    dealt = placed.repartitionById(n, F.floor(F.col(order) * n).cast("int")).sortWithinPartitions(order, key)
    return dealt.select(*[column(c) for c in docs.columns], F.col(number).alias(name))


def _renamed(docs: DataFrame, taken: str, work):
    """Do the work with a column out of the way."""
    aside = fresh(docs, "_aside")[0]
    mine = next(c for c in docs.columns if c.lower() == taken)
    done = work(docs.withColumnRenamed(mine, aside))
    return done.withColumnRenamed(aside, mine)


#: Relative weights of the query and the pipeline: the largest source counts three times an ordinary one.
WEIGHTS = {"src0": 3.0}

ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT *, length(coalesce(text, '')) + 1 AS size FROM documents),
s AS (
  SELECT source, sum(size)::DOUBLE AS size, CASE source WHEN 'src0' THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM d GROUP BY source),
r AS (
  SELECT source, weight / (SELECT sum(weight) FROM s) * ((SELECT sum(size) FROM s) / size) AS rate FROM s),
m AS (
  SELECT source, ceil(rate / {STEP})::INT AS parts, rate / ceil(rate / {STEP}) AS mean FROM r WHERE rate > 0),
t AS (
  SELECT source, parts, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM m
  UNION ALL
  SELECT source, parts, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM t WHERE k < {TERMS}),
u AS (
  SELECT d.doc_id, d.source, i,
         ('0x' || substr(md5('7|' || d.doc_id || '|' || i), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source, generate_series(1, m.parts) AS g(i)),
n AS (
  SELECT u.doc_id, count(t.k) AS times
  FROM u JOIN t ON t.source IS NOT DISTINCT FROM u.source AND t.c <= u.u GROUP BY u.doc_id)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy::INT AS copy
FROM d JOIN n ON n.doc_id = d.doc_id, generate_series(1, n.times) AS c(copy)
"""


def op1_mixing(spark, folder: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{folder}/documents.parquet"), WEIGHTS)
