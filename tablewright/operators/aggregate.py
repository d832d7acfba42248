"""Group-by aggregation with sort, post-filter and limit; summary statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import NESTED, QUANTILES, approx_quantiles, check_name, measures
from ..functions.nulls import as_list, col, nan_to_null, nulls_last, numeric_columns, require_columns, require_frame, value_of
from ..functions.predicates import names_text
from ..functions.quantiles import ROW_LIMIT, quantile_frame, quantile_values
from ..session import freeze
from .clean import filter_rows

ARRAY_LIMIT = 100_000  # most distinct values allowed in one array cell
SUMMARY_PROBS = [0.25, 0.5, 0.75]


def aggregate(
    df: DataFrame,
    group_by: list[str] | str,
    aggregations: dict[str, str | list[str]],
    *,
    sort_by: list[str] | str | None = None,
    sort_ascending: bool | list[bool] = True,
    post_filter=None,
    limit: int | None = None,
    naming: str = "suffix",
    dropna: bool = True,
    sorted_groups: bool = False,
    order_by: list[str] | str | None = None,
    label: str | None = None,
    method: str = "exact",
    row_limit: int = ROW_LIMIT,
    array_limit: int = ARRAY_LIMIT,
) -> DataFrame:
    """Aggregate, then filter, sort and limit.

    ``aggregations`` maps a column to one function name or a list of them. Rows whose key
    is missing are dropped unless ``dropna=False``. ``naming="legacy"`` gives bare column
    names when no value of the map is a list.
    """
    require_frame(df, "aggregate")
    keys = as_list(group_by)
    if not keys:
        raise ValueError("aggregate requires 'group_by'")
    if not aggregations:
        raise ValueError("aggregate requires 'aggregations'")
    if naming not in ("suffix", "legacy"):
        raise ValueError("naming must be 'suffix' or 'legacy'")
    require_columns(df, keys, "Group by")
    require_columns(df, list(aggregations), "Aggregated")
    requests = _requests(aggregations, naming)
    df = nan_to_null(df)

    if dropna:
        for k in keys:
            df = df.filter(value_of(df, k).isNotNull())

    plain, exact, nested = [], [], []
    for name, func, out in requests:
        plain += measures(df, name, func, out, as_list(order_by), label)
        if func in QUANTILES:
            if method == "approx":
                plain += approx_quantiles(value_of(df, name), func, out)
            else:
                exact.append((name, func, out))
        elif func in NESTED:
            nested.append((name, out))

    parts = []
    if plain or not (exact or nested):
        parts.append(df.groupBy(*[col(k) for k in keys]).agg(*(plain or [F.count(F.lit(1)).alias("_n")])))
    if exact:
        parts.append(_quantile_part(df, keys, exact, row_limit))
    parts += [_unique_part(df, keys, name, out, array_limit) for name, out in nested]
    result = parts[0]
    for part in parts[1:]:
        result = _join_groups(result, part, keys)
    result = result.select(*[col(k) for k in keys], *[col(c) for c in _output_columns(requests)])

    if post_filter is not None and post_filter != "":
        if names_text(result, post_filter):
            result = freeze(result, "aggregated")  # its text cells are looked at before they are compared
        result = filter_rows(result, post_filter)
    sort_cols = as_list(sort_by)
    if sort_cols:
        require_columns(result, sort_cols, "Sort")
        ties = [k for k in keys if k not in sort_cols]
        result = result.orderBy(*nulls_last(sort_cols, sort_ascending), *nulls_last(ties))
    elif sorted_groups or limit:
        result = result.orderBy(*nulls_last(keys))
    return result.limit(limit) if limit else result


def _requests(aggregations: dict, naming: str) -> list[tuple[str, str, str]]:
    bare = naming == "legacy" and not any(isinstance(f, (list, tuple)) for f in aggregations.values())
    requests = []
    for name, funcs in aggregations.items():
        for func in as_list(funcs):
            check_name(func)
            requests.append((name, func, name if bare else f"{name}_{func}"))
    return requests


def _output_columns(requests: list[tuple[str, str, str]]) -> list[str]:
    suffixes = {
        "ohlc": ["_open", "_high", "_low", "_close"],
        "describe": ["_count", "_mean", "_std", "_min", "_p25", "_p50", "_p75", "_max"],
    }
    return [out + s for _, func, out in requests for s in suffixes.get(func, [""])]


def _quantile_part(df: DataFrame, keys: list[str], exact: list, row_limit: int) -> DataFrame:
    cols = list(dict.fromkeys(name for name, *_ in exact))
    frame = quantile_frame(df, cols, SUMMARY_PROBS, keys, row_limit)
    picked = []
    for name, func, out in exact:
        values = F.col(f"_q{cols.index(name)}")
        if func == "describe":
            picked += [F.get(values, F.lit(j)).alias(f"{out}_p{int(p * 100)}") for j, p in enumerate(SUMMARY_PROBS)]
        else:
            picked.append(F.get(values, F.lit(1)).alias(out))
    return frame.select(*[col(k) for k in keys], *picked)


def _unique_part(df: DataFrame, keys: list[str], name: str, out: str, array_limit: int) -> DataFrame:
    pairs = distinct_values(df, keys, name)
    most = pairs.groupBy(*[col(k) for k in keys]).count().agg(F.max("count")).first()[0] or 0
    if most > array_limit:
        raise ValueError(
            f"'unique' of '{name}' reaches {most} values in one group, above {array_limit}: "
            "use distinct_values, which returns them as rows"
        )
    return pairs.groupBy(*[col(k) for k in keys]).agg(F.sort_array(F.collect_list(col(name))).alias(out))


def distinct_values(df: DataFrame, keys: list[str] | str, name: str) -> DataFrame:
    """The distinct values of a column per group, one row each, for groups of any size."""
    keys = as_list(keys)
    return df.select(*[col(k) for k in keys], value_of(df, name).alias(name)).dropDuplicates()


def _join_groups(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join two one-row-per-group frames, a missing key matching itself."""
    renamed = right.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate(keys)})
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & left[k].eqNullSafe(renamed[f"_r{i}"])
    return left.join(renamed, match, "left").drop(*[f"_r{i}" for i in range(len(keys))])


def summarize(
    df: DataFrame,
    cols: list[str] | None = None,
    group_cols: list[str] | str | None = None,
    *,
    numeric: str = "strict",
    method: str = "exact",
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """count, mean, std, min, quartiles and max: one row per column, or per group and column."""
    require_frame(df, "summarize")
    keys = as_list(group_cols)
    cols = [c for c in (cols or numeric_columns(df, numeric)) if c not in keys]
    if not cols:
        raise ValueError("no numeric columns to summarise")
    for k in keys:
        df = df.filter(value_of(df, k).isNotNull())
    stats = []
    for i, c in enumerate(cols):
        v = value_of(df, c).cast("double")
        stats += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
        ]
        if method == "approx":
            stats.append(F.percentile_approx(v, SUMMARY_PROBS).alias(f"_q{i}"))
    wide = df.groupBy(*[col(k) for k in keys]).agg(*stats)
    if method != "approx":
        if keys:
            wide = _join_groups(wide, quantile_frame(df, cols, SUMMARY_PROBS, keys, row_limit), keys)
        else:
            values = quantile_values(df, cols, SUMMARY_PROBS, row_limit)
            wide = wide.withColumns(
                {f"_q{i}": F.array(*[F.lit(v).cast("double") for v in values[c]]) for i, c in enumerate(cols)}
            )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("count"),
            F.col(f"mean{i}").alias("mean"),
            F.col(f"std{i}").alias("std"),
            F.col(f"min{i}").alias("min"),
            *[F.get(F.col(f"_q{i}"), F.lit(j)).alias(f"p{int(p * 100)}") for j, p in enumerate(SUMMARY_PROBS)],
            F.col(f"max{i}").alias("max"),
        )
        for i, c in enumerate(cols)
    ]
    return wide.select(*[col(k) for k in keys], F.inline(F.array(*rows)))
