"""Aggregate functions by name, with missing values skipped and empty groups defined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .nulls import clean_nan, col, value_of


def _skew(c: Column) -> Column:
    n = F.count(c)
    raw = F.skewness(c)
    corrected = F.try_divide(raw * F.sqrt(n * (n - 1)), n - 2)
    return F.when(n >= 3, F.coalesce(clean_nan(corrected), F.lit(0.0)))


def _truth(df: DataFrame, name: str) -> Column:
    data_type = df.schema[name].dataType
    c = value_of(df, name)
    if isinstance(data_type, T.BooleanType):
        return c
    return c != (F.lit("") if isinstance(data_type, T.StringType) else F.lit(0))


# name -> Column of one value
SIMPLE = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "mean": F.avg,
    "count": F.count,
    "nunique": F.count_distinct,
    "approx_nunique": F.approx_count_distinct,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "sem": lambda c: F.try_divide(F.stddev_samp(c), F.sqrt(F.count(c))),
    "prod": lambda c: F.coalesce(F.product(c), F.lit(1.0)),
    "size": lambda c: F.count(F.lit(1)),
    "skew": lambda c: _skew(c.cast("double")),
}
COUNTED = ("sum", "mean", "std", "var", "sem", "prod", "skew")
TRUTH = {
    "any": lambda c: F.coalesce(F.bool_or(c), F.lit(False)),
    "all": lambda c: F.coalesce(F.bool_and(c), F.lit(True)),
}
ORDERED = ("first", "last", "ohlc")
LABELLED = ("idxmin", "idxmax")
QUANTILES = {"median": [0.5], "quantile": [0.5], "describe": [0.25, 0.5, 0.75]}
NESTED = ("unique",)
NAMES = sorted([*SIMPLE, *TRUTH, *ORDERED, *LABELLED, *QUANTILES, *NESTED])


def check_name(func: str) -> None:
    if func not in NAMES:
        raise ValueError(f"Unknown aggregate function: {func}. Available: {', '.join(NAMES)}")


def measures(
    df: DataFrame, name: str, func: str, out: str, order_by: list[str], label: str | None
) -> list[Column]:
    """The aggregate columns of one (column, function) request, quantiles excepted."""
    c = value_of(df, name)
    if func in COUNTED and isinstance(df.schema[name].dataType, T.BooleanType):
        c = c.cast("int")  # true counts as one
    if func in SIMPLE:
        return [SIMPLE[func](c).alias(out)]
    if func in TRUTH:
        return [TRUTH[func](_truth(df, name)).alias(out)]
    if func in ORDERED:
        if not order_by:
            raise ValueError(f"'{func}' needs order_by: rows have no order of their own")
        # The value itself breaks ties, so the answer does not depend on partitioning.
        place = F.when(c.isNotNull(), F.struct(*[F.struct(col(o).isNull(), col(o)) for o in order_by], c))
        first, last = F.min_by(c, place), F.max_by(c, place)
        if func == "ohlc":
            return [
                first.alias(f"{out}_open"),
                F.max(c).alias(f"{out}_high"),
                F.min(c).alias(f"{out}_low"),
                last.alias(f"{out}_close"),
            ]
        return [(first if func == "first" else last).alias(out)]
    if func in LABELLED:
        if not label:
            raise ValueError(f"'{func}' needs label, the column that names a row")
        if not isinstance(df.schema[name].dataType, T.NumericType):
            raise ValueError(f"'{func}' needs a numeric column, '{name}' is not")
        if isinstance(df.schema[name].dataType, T.IntegralType):
            c = c.cast("decimal(20,0)")  # room for the opposite of the smallest bigint
        # Ties go to the smallest label.
        place = F.struct(c if func == "idxmin" else -c, col(label))
        return [F.min_by(col(label), F.when(c.isNotNull(), place)).alias(out)]
    if func == "describe":
        return [
            F.count(c).alias(f"{out}_count"),
            F.avg(c).alias(f"{out}_mean"),
            F.stddev_samp(c).alias(f"{out}_std"),
            F.min(c).alias(f"{out}_min"),
            F.max(c).alias(f"{out}_max"),
        ]
    return []


def approx_quantiles(c: Column, func: str, out: str) -> list[Column]:
    c = c.cast("double")
    if func != "describe":
        return [F.percentile_approx(c, 0.5).alias(out)]
    return [F.percentile_approx(c, p).alias(f"{out}_p{int(p * 100)}") for p in QUANTILES["describe"]]
