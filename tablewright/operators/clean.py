"""Cleaning: duplicates, missing values, filters, names, types and outliers."""

from __future__ import annotations

import logging
import re
from itertools import batched

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import (
    CAST_TARGETS,
    as_list,
    col,
    free_names,
    is_orderable,
    nan_to_null,
    nulls_last,
    numeric_columns,
    quoted,
    require_columns,
    require_frame,
    total_order,
    value_of,
)
from ..functions.predicates import compares_unlike, condition, lenient, tells_missing
from ..functions.quantiles import approx_values, quantile_values
from ..session import freeze

log = logging.getLogger(__name__)

COUNTED_AT_ONCE = 32  # columns whose values are counted in one scan


def dedup(df: DataFrame, subset: list[str] | str | None = None, order_by: list[str] | str | None = None) -> DataFrame:
    """Drop repeated rows, or keep the first row per ``subset``.

    "First" needs an order: ``order_by``, then all other columns, so that only exact
    copies can tie. ``row_number() = 1`` lets Spark drop all but one row per key before
    the shuffle, so a key holding much of the table costs no more than any other.
    """
    subset = as_list(subset)
    df = nan_to_null(df)
    if not subset:
        return df.dropDuplicates()
    require_columns(df, subset + as_list(order_by), "dedup")
    order = total_order(df, as_list(order_by), skip=subset)
    if not order:
        return df.dropDuplicates(subset)
    first = Window.partitionBy(*[col(c) for c in subset]).orderBy(*nulls_last(order))
    place = free_names(df.columns, "_place")[0]
    return df.withColumn(place, F.row_number().over(first)).filter(col(place) == 1).drop(place)


def drop_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=[quoted(c) for c in cols] if cols else None)


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    """Fill from a map; unknown columns are ignored, values of another type are refused."""
    fills = {}
    for name, value in values.items():
        if name not in df.columns:
            continue
        data_type = df.schema[name].dataType
        if not _fits(value, data_type):
            raise ValueError(f"fill value {value!r} does not fit column '{name}' of type {data_type.simpleString()}")
        fills[name] = F.coalesce(value_of(df, name), F.lit(value).cast(data_type))
    return df.withColumns(fills) if fills else df


def _fits(value, data_type: T.DataType) -> bool:
    if isinstance(value, bool):
        return isinstance(data_type, T.BooleanType)
    if isinstance(data_type, T.IntegralType):
        return isinstance(value, int)
    if isinstance(data_type, (T.FractionalType, T.NumericType)):
        return isinstance(value, (int, float))
    if isinstance(data_type, T.BooleanType):
        return False
    return isinstance(value, str) or not isinstance(data_type, T.StringType)


def fill_mean(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Numeric gaps take the column mean; all means come from one aggregate."""
    cols = numeric_columns(df) if cols is None else cols
    if not cols:
        return df
    means = df.agg(*[F.avg(value_of(df, c)).alias(f"m{i}") for i, c in enumerate(cols)])
    return df.withColumns(
        {c: F.coalesce(value_of(df, c).cast("double"), means.select(f"m{i}").scalar()) for i, c in enumerate(cols)}
    )


def fill_mode(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Other gaps take the most frequent value, the smallest one on ties.

    Two scans for any number of columns: one finds the columns with gaps, one counts the values of these, each
    value combined before the shuffle, so no task holds a whole column.
    """
    if cols is None:
        numeric = set(numeric_columns(df))
        cols = [c for c in df.columns if c not in numeric]
    cols = [c for c in cols if is_orderable(df.schema[c].dataType)]  # maps have no most frequent value
    if not cols:
        return df
    gaps = df.agg(*[F.count_if(value_of(df, c).isNull()).alias(f"g{i}") for i, c in enumerate(cols)]).first()
    gappy = [c for i, c in enumerate(cols) if gaps[f"g{i}"]]
    fills = {}
    for c, top in most_frequent(df, gappy).items():
        choices = [value_of(df, c), top]
        if isinstance(df.schema[c].dataType, T.StringType):
            choices.append(F.lit("Unknown"))
        fills[c] = F.coalesce(*choices)
    return df.withColumns(fills) if fills else df


def value_counts(df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[Column]]:
    """How often each value of each column occurs, in one scan, and for each column which rows of the result are its own.

    The result has ``v0, v1, ...`` for the columns and ``n``; a row belongs to one of them, missing values included.
    """
    names = [f"v{i}" for i in range(len(cols))]
    values = df.select(*[value_of(df, c).alias(n) for c, n in zip(cols, names)])
    counts = values.groupingSets([[n] for n in names], *names).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    every = (1 << len(cols)) - 1
    return counts, [F.col("g") == every - (1 << (len(cols) - 1 - i)) for i in range(len(cols))]


def most_frequent(df: DataFrame, cols: list[str]) -> dict[str, Column]:
    """For each column its most frequent value, the smallest on ties, as a one-cell subquery."""
    found = {}
    for some in batched(cols, COUNTED_AT_ONCE):
        counts, own = value_counts(df, list(some))
        tops = [
            F.min_by(f"v{i}", F.when(mine & F.col(f"v{i}").isNotNull(), F.struct(-F.col("n"), F.col(f"v{i}")))).alias(f"m{i}")
            for i, mine in enumerate(own)
        ]
        row = freeze(counts.agg(*tops), "modes")
        found |= {c: row.select(f"m{i}").scalar() for i, c in enumerate(some)}
    return found


def filter_rows(df: DataFrame, cond: str | Column, on_error: str = "raise", skipped: list[str] | None = None) -> DataFrame:
    """Keep rows where ``cond`` is true. Where it has no result, as after a division by zero, it is not.

    NaN is missing in a condition given as text; a Column is taken as it is. A condition that does not resolve or
    that takes text cells for numbers is refused, or with ``on_error="skip"`` left out, logged and added to ``skipped``.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be 'raise' or 'skip'")
    raw = df
    if isinstance(cond, str):
        df = nan_to_null(df)
    try:
        if unlike := compares_unlike(df, cond):
            if on_error == "raise":
                raise ValueError(f"filter {cond!r} takes text for another type: {unlike}")
            return _skip(df, "filter", cond, unlike, skipped)
        with lenient(df.sparkSession):
            if isinstance(cond, str) and not tells_missing(cond):
                df = nan_to_null(raw.filter(condition(cond)))  # drops NaN rows too few, and reaches the scan
            kept = df.filter(condition(cond))
            kept.schema
        return kept
    except AnalysisException as error:
        if on_error == "raise":
            raise
        return _skip(df, "filter", cond, error, skipped)


def _skip(df: DataFrame, step: str, what, why, skipped: list[str] | None) -> DataFrame:
    reason = str(why).split("\n")[0]
    log.warning("%s %s was skipped: %s", step, what, reason)
    if skipped is not None:
        skipped.append(f"{step} {what}: {reason}")
    return df


def standard_name(name: str) -> str:
    return re.sub(r"[^a-zA-Z0-9_]", "", name.lower().replace(" ", "_"))


def standardize_columns(df: DataFrame) -> DataFrame:
    names = [standard_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"standardised names collide: {clashes}")
    return df if names == df.columns else df.toDF(*names)


def convert_types(df: DataFrame, conversions: dict[str, str], skipped: list[str] | None = None) -> DataFrame:
    """Cast each listed column whose every value converts; leave the others as they are, and name them in ``skipped``.

    One aggregate counts the failures of all columns.
    """
    targets = {c: CAST_TARGETS.get(t, t) for c, t in conversions.items() if c in df.columns}
    casts = {}
    for c, t in targets.items():
        try:
            attempt = value_of(df, c).try_cast(t)
            df.select(attempt).schema
            casts[c] = attempt
        except AnalysisException as error:  # no such type, or no cast between the two types
            _skip(df, "conversion", c, error, skipped)
    if not casts:
        return df
    failures = df.agg(
        *[F.count_if(value_of(df, c).isNotNull() & a.isNull()).alias(f"f{i}") for i, (c, a) in enumerate(casts.items())]
    ).first()
    good = {c: a for i, (c, a) in enumerate(casts.items()) if failures[f"f{i}"] == 0}
    for i, c in enumerate(casts):
        if failures[f"f{i}"]:
            _skip(df, "conversion", c, f"{failures[f'f{i}']} values do not convert to {targets[c]}", skipped)
    return df.withColumns(good) if good else df


def fences(q1: float | None, q3: float | None, k: float = 1.5) -> tuple[float | None, float | None]:
    if q1 is None or q3 is None:
        return None, None
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)


def remove_outliers(
    df: DataFrame, cols: list[str] | str | None = None, k: float = 1.5, method: str = "exact", numeric: str = "strict"
) -> DataFrame:
    """Keep rows inside the quartile fences, column after column on what is left.

    Fences are plain numbers in the filter, so they reach the scan. A column without
    values keeps no row.
    """
    quartiles = _quartiles(method)
    chosen = [c for c in (as_list(cols) or numeric_columns(df, numeric)) if c in df.columns]
    for c in chosen:
        if not isinstance(df.schema[c].dataType, T.NumericType):
            raise ValueError(f"column '{c}' is not numeric")
    for c in chosen:
        low, high = fences(*quartiles(df, [c], [0.25, 0.75])[c], k)
        if low is None:
            return df.filter(F.lit(False))
        df = df.filter(col(c).between(low, high))
    return df


def _quartiles(method: str):
    if method not in ("exact", "approx"):
        raise ValueError(f"method must be 'exact' or 'approx', got {method!r}")
    return quantile_values if method == "exact" else approx_values


def clean(
    df: DataFrame,
    config: dict | None = None,
    metrics: dict[str, Observation] | None = None,
    skipped: list[str] | None = None,
) -> DataFrame:
    """The cleaning steps in their fixed order: duplicates, missing values, filter, names, types, outliers.

    Conditions, fill values and ``dedup_cols`` use the raw column names; ``dtype_conversions``
    and ``outlier_cols`` the standardised ones. ``metrics`` receives row counts that are
    filled in by the first action on the result, without a job of their own. Filters and conversions
    that cannot be carried out are left out, logged, and added to ``skipped``.
    """
    require_frame(df, "clean")
    config = config or {}
    df = _watched(nan_to_null(df), metrics, "rows_in")
    strategy = config.get("missing_strategy", "drop")
    conversions = config.get("dtype_conversions") or {}
    outliers = config.get("remove_outliers", False)
    repeated = False  # would a later statistic run the duplicate shuffle again?

    if config.get("remove_duplicates", True):
        df = dedup(df, config.get("dedup_cols"), config.get("order_by"))
        repeated = True

    if strategy == "drop":
        df = drop_missing(df)
    elif strategy == "fill":
        if config.get("fill_values"):
            df = fill_missing(df, config["fill_values"])
        else:
            if repeated:
                df, repeated = freeze(df, "clean"), False
            others = [c for c in df.columns if c not in numeric_columns(df)]
            df = fill_mode(fill_mean(df), others)

    if config.get("filter_expr") is not None and config.get("filter_expr") != "":
        df = filter_rows(df, config["filter_expr"], on_error="skip", skipped=skipped)
    if config.get("standardize_columns", True):
        df = standardize_columns(df)

    if repeated and (conversions or outliers):
        df = freeze(df, "clean")
    if conversions:
        df = convert_types(df, conversions, skipped)
    if outliers:
        df = remove_outliers(
            df,
            config.get("outlier_cols"),
            k=config.get("outlier_factor", 1.5),
            method=config.get("outlier_method", "exact"),
            numeric=config.get("numeric", "strict"),
        )
    return _watched(df, metrics, "rows_out")


def _watched(df: DataFrame, metrics: dict | None, name: str) -> DataFrame:
    if metrics is None:
        return df
    metrics[name] = Observation()
    return df.observe(metrics[name], F.count(F.lit(1)).alias("rows"))


def dedup_and_filter(df: DataFrame, rules: dict) -> DataFrame:
    """Standalone duplicates-then-filter step; a bad filter raises here."""
    require_frame(df, "dedup_and_filter")
    df = nan_to_null(df)
    df = dedup(df, rules.get("dedup_cols"), rules.get("order_by"))
    cond = rules.get("filter_expr")
    return df if cond is None or cond == "" else filter_rows(df, cond, on_error="raise")
