"""Row-shaped group operations: running total, rank, shift and head, keys kept.

An ordinary window puts a whole group in one task. Where a group is larger than
``row_limit`` its rows are range-partitioned in order into slices first; each slice is a
window of its own and takes over the totals of the slices before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import as_list, col, free_names, nan_to_null, nulls_last, quoted, refuse_taken, require_columns, total_order, value_of
from ..session import freeze
from .joins import key_counts, spread_join

ROW_LIMIT = 2_000_000  # largest group run as a single window
GROUP_LIMIT_ROWS = 999  # up to here Spark keeps only the first n rows per task before the shuffle


def _fits(df: DataFrame, keys: list[str], row_limit: int) -> bool:
    """Is the largest group, by count or sample, small enough for a single window?"""
    counts, n = key_counts(df, keys, row_limit)
    return (counts.agg(F.max(n)).first()[0] or 0) <= row_limit


def _window(keys: list[str], order: list[Column], *extra: str) -> Window:
    return Window.partitionBy(*[col(k) for k in keys], *extra).orderBy(*order)


def _ordering(df: DataFrame, keys: list[str], order_by, ascending) -> list[Column]:
    first = as_list(order_by)
    require_columns(df, keys + first, "window")
    rest = [c for c in total_order(df, first, skip=keys) if c not in first]
    return nulls_last(first, ascending) + nulls_last(rest)


def _sliced(df: DataFrame, keys: list[str], order: list[Column], row_limit: int) -> tuple[DataFrame, str]:
    """``df`` with the number of a slice, and its column's name: consecutive pieces of each group, in order."""
    copy, piece = free_names(df.columns, "_copy", "_slice")
    total = df.count()
    pieces = max(2, 2 * total // row_limit + 1)
    # The partition id separates exact copies that would otherwise share one range.
    ranged = df.withColumn(copy, F.spark_partition_id()).repartitionByRange(
        pieces, *[col(k).asc_nulls_last() for k in keys], *order, F.col(copy).asc()
    )
    # Frozen: range bounds are sampled, and both uses of the slices must see the same ones.
    return freeze(ranged.drop(copy).withColumn(piece, F.spark_partition_id()), "slices"), piece


def _running(df: DataFrame, piece: str, keys: list[str], order: list[Column], amount: Column, out: str) -> DataFrame:
    """Running sum of ``amount`` over the slices of ``_sliced``, whose numbers go."""
    total, before, of, *names = free_names(df.columns, "_sum", "_before", "_of", *[f"_b{i}" for i in range(len(keys))])
    per_slice = df.groupBy(*[col(k) for k in keys], piece).agg(F.sum(amount).alias(total))
    earlier = _window(keys, [F.col(piece)]).rowsBetween(Window.unboundedPreceding, -1)
    # Only groups that run over a slice border need a carried amount: at most one per slice.
    carried = per_slice.withColumn(before, F.sum(total).over(earlier)).filter(F.col(before).isNotNull()).drop(total)
    renamed = carried.withColumnsRenamed(dict(zip(keys, names)) | {piece: of})
    match = df[piece] == renamed[of]
    for k, name in zip(keys, names):
        match = match & df[quoted(k)].eqNullSafe(renamed[name])
    joined = df.join(renamed, match, "left").drop(of, *names)
    inside = _window(keys, order, piece).rowsBetween(Window.unboundedPreceding, 0)
    running = F.sum(amount).over(inside)
    result = F.coalesce(running + F.coalesce(F.col(before), F.lit(0)), F.col(before))
    return joined.withColumn(out, result).drop(before, piece)


def _indexed(df: DataFrame, keys: list[str], order: list[Column], row_limit: int, out: str) -> DataFrame:
    """Position of each row in its group, from 1, for groups above the limit."""
    sliced, piece = _sliced(df, keys, order, row_limit)
    return _running(sliced, piece, keys, order, F.lit(1).cast("long"), out)


def cumulative_sum(
    df: DataFrame,
    keys: list[str] | str,
    order_by: list[str] | str,
    column: str,
    out: str | None = None,
    ascending: bool | list[bool] = True,
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """Running total in order; a missing value stays missing and adds nothing."""
    df = nan_to_null(df)
    keys, out = as_list(keys), out or f"{column}_cumsum"
    refuse_taken(df.columns, out)
    order = _ordering(df, keys, order_by, ascending)
    value = value_of(df, column)
    if _fits(df, keys, row_limit):
        rows = _window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.when(value.isNotNull(), F.sum(value).over(rows)))
    sliced, piece = _sliced(df, keys, order, row_limit)
    result = _running(sliced, piece, keys, order, value, out)
    return result.withColumn(out, F.when(value.isNotNull(), col(out)))


def row_index(
    df: DataFrame,
    keys: list[str] | str,
    order_by: list[str] | str,
    out: str = "row_index",
    ascending: bool | list[bool] = True,
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """Position of each row within its group, from 1."""
    df = nan_to_null(df)
    keys = as_list(keys)
    refuse_taken(df.columns, out)
    order = _ordering(df, keys, order_by, ascending)
    if _fits(df, keys, row_limit):
        return df.withColumn(out, F.row_number().over(_window(keys, order)).cast("long"))
    return _indexed(df, keys, order, row_limit, out)


def shift(
    df: DataFrame,
    keys: list[str] | str,
    order_by: list[str] | str,
    column: str,
    periods: int = 1,
    out: str | None = None,
    ascending: bool | list[bool] = True,
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """The value ``periods`` rows earlier in the group (later when negative)."""
    df = nan_to_null(df)
    keys, out = as_list(keys), out or f"{column}_shift"
    refuse_taken(df.columns, out)
    order = _ordering(df, keys, order_by, ascending)
    if _fits(df, keys, row_limit):
        return df.withColumn(out, F.lag(value_of(df, column), periods).over(_window(keys, order)))
    # Large groups: number the rows, then look the neighbour up by number; (keys, number) spreads evenly.
    at, other, *names = free_names([*df.columns, out], "_at", "_other", *[f"_n{i}" for i in range(len(keys))])
    numbered = freeze(_indexed(df, keys, order, row_limit, at), "numbered")
    source = numbered.select(
        *[col(k).alias(name) for k, name in zip(keys, names)],
        (F.col(at) + periods).alias(other),
        value_of(numbered, column).alias(out),
    )
    match = numbered[at] == source[other]
    for k, name in zip(keys, names):
        match = match & numbered[quoted(k)].eqNullSafe(source[name])
    return numbered.join(source, match, "left").drop(at, other, *names)


def average_rank(
    df: DataFrame, keys: list[str] | str, column: str, out: str | None = None, row_limit: int = ROW_LIMIT
) -> DataFrame:
    """Rank of the value in its group, ties sharing their mean rank; missing stays missing."""
    df = nan_to_null(df)
    keys, out = as_list(keys), out or f"{column}_rank"
    refuse_taken(df.columns, out)
    require_columns(df, [*keys, column], "window")
    value = value_of(df, column)
    if _fits(df, keys, row_limit):
        w = Window.partitionBy(*[col(k) for k in keys]).orderBy(value.asc_nulls_last())
        ties = F.count(F.lit(1)).over(Window.partitionBy(*[col(k) for k in keys], value))
        return df.withColumn(out, F.when(value.isNotNull(), F.rank().over(w) + (ties - 1) / F.lit(2.0)))
    ties, upto, *names = free_names([*df.columns, out], "_ties", "_upto", *[f"_k{i}" for i in range(len(keys))])
    counts = (
        df.filter(value.isNotNull())
        .groupBy(*[col(k) for k in keys], value.alias(column))
        .agg(F.count(F.lit(1)).alias(ties))
    )
    ranked = cumulative_sum(counts, keys, column, ties, upto, row_limit=row_limit)
    ranks = ranked.select(
        *[F.struct(col(k)).alias(name) for k, name in zip(keys, names)],
        col(column),
        (F.col(upto) - (F.col(ties) - 1) / F.lit(2.0)).alias(out),
    )
    # Keys are compared as one-field structs, so that a missing key finds its own group.
    tagged = df.withColumns({name: F.struct(col(k)) for k, name in zip(keys, names)} | {column: value})
    joined = spread_join(tagged, ranks, [*names, column], "left", hot_rows=row_limit)
    return joined.select(*[col(c) for c in df.columns], col(out))


def group_head(
    df: DataFrame,
    keys: list[str] | str,
    order_by: list[str] | str,
    n: int = 5,
    ascending: bool | list[bool] = True,
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """The first ``n`` rows of each group."""
    df = nan_to_null(df)
    keys = as_list(keys)
    at = free_names(df.columns, "_at")[0]
    if n <= GROUP_LIMIT_ROWS:
        order = _ordering(df, keys, order_by, ascending)
        picked = df.withColumn(at, F.row_number().over(_window(keys, order)))
    else:
        picked = row_index(df, keys, order_by, at, ascending, row_limit)
    return picked.filter(F.col(at) <= n).drop(at)
