"""Profiling: sizes, missing values, statistics, correlations, duplicates, outliers, samples."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import (
    as_list,
    col,
    is_orderable,
    legacy_type,
    nan_to_null,
    nulls_last,
    numeric_columns,
    require_frame,
    total_order,
    value_of,
)
from ..functions.quantiles import ROW_LIMIT, approx_values, quantile_values
from .clean import fences

# Bytes per value of the fixed-width types.
WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DecimalType: 16,
}
PROBS = [0.25, 0.5, 0.75]


def percent(part: Column, whole: Column) -> Column:
    """Half-even percentage with two decimals, null for an empty table."""
    return F.bround(F.try_divide(part * F.lit(100.0), whole), 2)


def _bytes(df: DataFrame, name: str) -> Column:
    """Logical size of one value."""
    data_type = df.schema[name].dataType
    c = col(name)
    if type(data_type) in WIDTHS:
        return F.lit(WIDTHS[type(data_type)])
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.octet_length(c)
    if isinstance(data_type, T.ArrayType) and type(data_type.elementType) in WIDTHS:
        return F.greatest(F.size(c), F.lit(0)) * WIDTHS[type(data_type.elementType)]
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(c))
    return F.octet_length(c.cast("string"))


DIRECT_ROWS = 5_000_000  # rows compared in full without looking at hashes first
REPEATED_HASHES = 500_000  # most repeated row hashes sent to every task


@dataclass
class Facts:
    """What one pass over a table tells; reused by profile, quality and report."""

    rows: int
    bytes: int
    nulls: dict[str, int]
    stats: dict[str, dict[str, float | None]]
    correlations: dict[tuple[str, str], float | None] = field(default_factory=dict)
    duplicates: dict[str, float | None] | None = None


def gather(df: DataFrame, numeric: list[str], with_correlations: bool = False) -> Facts:
    measures = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        measures.append(F.count_if(value_of(df, c).isNull()).alias(f"null{i}"))
        measures.append(F.sum(_bytes(df, c)).alias(f"bytes{i}"))
    for i, c in enumerate(numeric):
        v = value_of(df, c)
        measures += [
            F.count(v).alias(f"count{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
        ]
    row = df.agg(*measures).first()
    matrix = correlations(df, numeric).collect() if with_correlations and numeric else []
    return Facts(
        rows=row["n"],
        bytes=sum(row[f"bytes{i}"] or 0 for i in range(len(df.columns))),
        nulls={c: row[f"null{i}"] for i, c in enumerate(df.columns)},
        stats={
            c: {s: _number(row[f"{s}{i}"]) for s in ("count", "mean", "std", "min", "max")}
            for i, c in enumerate(numeric)
        },
        correlations={(r["column_a"], r["column_b"]): r["correlation"] for r in matrix},
    )


def _number(value):
    return None if value is None else float(value)


def null_analysis(df: DataFrame) -> DataFrame:
    """column, null_count, null_percentage: one aggregate over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(value_of(df, c).isNull()).alias(f"null{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"null{i}").alias("null_count"),
            percent(F.col(f"null{i}"), F.col("n")).alias("null_percentage"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def correlations(df: DataFrame, cols: list[str] | None = None, numeric: str = "strict") -> DataFrame:
    """column_a, column_b, correlation for every ordered pair, over the rows where both are known.

    No row is spread over pairs: a task adds up matrices of counts, sums and products, and these are summed by
    position, one row per pair and task. Values are taken less a middle one of their column, so that large
    values with a small spread lose no digits; a constant has no correlation.
    """
    cols = cols or numeric_columns(df, numeric)
    n, spark = len(cols), df.sparkSession
    if not n:
        return spark.createDataFrame([], "column_a string, column_b string, correlation double")
    values = df.select(*[value_of(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    middle = values.agg(*[F.percentile_approx(f"v{i}", 0.5, 100) for i in range(n)]).first()
    shift = [m or 0.0 for m in middle]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((5, n, n))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - shift
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            with np.errstate(invalid="ignore"):
                sums += (known.T.astype(float) @ known, x.T @ known, known.T @ x, (x * x).T @ known, x.T @ x)
        i, j = np.triu_indices(n)
        # Squares of the second column where the first is known: those of the first, mirrored.
        found = [*(s[i, j] for s in sums[:4]), sums[3][j, i], sums[4][i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *map(pa.array, found)], names=["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    parts = values.mapInArrow(run, "i int, j int, n double, x double, y double, xx double, yy double, xy double")
    none = spark.range(n * n).select((F.col("id") / n).cast("int").alias("i"), (F.col("id") % n).cast("int").alias("j")).filter("i <= j")
    parts = parts.unionByName(none.withColumns({c: F.lit(0.0) for c in ("n", "x", "y", "xx", "yy", "xy")}))  # for an empty table
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    spread = F.sqrt(F.greatest(_moment("xx", "x", "x"), F.lit(0.0))) * F.sqrt(F.greatest(_moment("yy", "y", "y"), F.lit(0.0)))
    raw = F.try_divide(_moment("xy", "x", "y"), spread)
    found = total.select("i", "j", F.when(raw > 1, 1.0).when(raw < -1, -1.0).otherwise(raw).alias("correlation"))
    name = F.array(*[F.lit(c) for c in cols])
    pair = F.array(F.struct(F.col("i").alias("a"), F.col("j").alias("b")), F.struct(F.col("j").alias("a"), F.col("i").alias("b")))
    both = found.select(F.explode(F.when(F.col("i") == F.col("j"), F.slice(pair, 1, 1)).otherwise(pair)).alias("p"), "correlation")
    return both.select(F.get(name, F.col("p.a")).alias("column_a"), F.get(name, F.col("p.b")).alias("column_b"), "correlation")


def _moment(product: str, first: str, second: str) -> Column:
    """Mean of the product less the product of the means."""
    return F.try_divide(F.col(product), F.col("n")) - F.try_divide(F.col(first), F.col("n")) * F.try_divide(F.col(second), F.col("n"))


def duplicates(
    df: DataFrame,
    subset: list[str] | None = None,
    method: str = "exact",
    hash_limit: int = REPEATED_HASHES,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """rows, duplicate_rows (beyond the first copy), duplicate_percentage, unique_rows: one row.

    ``exact`` compares whole rows up to ``direct_rows``; above, it first counts 64-bit row hashes. Only rows whose hash repeats can be copies; while
    those hashes are few they are sent to every task and just these rows are compared in full,
    else all rows are. ``fingerprint`` counts 256-bit digests and compares no rows. Copies are
    counted before each shuffle, so a heavily repeated row costs one entry per task.
    """
    if method not in ("exact", "fingerprint"):
        raise ValueError(f"method must be 'exact' or 'fingerprint', got {method!r}")
    names = [f"c{i}" for i in range(len(subset or df.columns))]
    rows = df.select(*[value_of(df, c).alias(n) for c, n in zip(subset or df.columns, names)])
    if method == "fingerprint":
        # A struct prints every field and tells a missing one from text.
        # JSON would cut times to milliseconds and tell 0.0 from -0.0.
        exact = [printed(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema.fields]
        text = F.to_json(F.struct(*exact), {"ignoreNullFields": "false"})
        return _copies(rows.groupBy(F.sha2(text, 256).alias("d")))
    hashable = all(is_orderable(f.dataType) for f in rows.schema.fields)
    if len(names) == 1 or not hashable or df.count() <= direct_rows:
        return _copies(rows.groupBy(*names))

    hashed = rows.select("*", F.xxhash64(*names).alias("h"))
    hashes = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    found = hashes.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("n") > 1).alias("repeated")).first()
    if found["repeated"] > hash_limit:
        return _copies(rows.groupBy(*names))
    suspects = hashed.join(F.broadcast(hashes.filter("n > 1").select("h")), "h", "left_semi")
    settled = found["all"] - found["repeated"]  # rows whose hash no other row has
    return _copies(suspects.groupBy(*names), settled)


def printed(c: Column, data_type: T.DataType) -> Column:
    """A form of the value whose text is the same exactly where the value is."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("string")
    return c + F.lit(0.0).cast(data_type) if isinstance(data_type, (T.DoubleType, T.FloatType)) else c


def _copies(grouped, settled: int = 0) -> DataFrame:
    totals = grouped.agg(F.count(F.lit(1)).alias("n")).agg(
        (F.coalesce(F.sum("n"), F.lit(0)) + settled).alias("rows"),
        (F.count(F.lit(1)) + settled).alias("unique_rows"),
    )
    repeated = F.col("rows") - F.col("unique_rows")
    return totals.select(
        "rows",
        repeated.alias("duplicate_rows"),
        percent(repeated, F.col("rows")).alias("duplicate_percentage"),
        "unique_rows",
    )


def outlier_counts(
    df: DataFrame,
    cols: list[str] | None = None,
    k: float = 1.5,
    method: str = "exact",
    numeric: str = "strict",
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """column, outlier_count, outlier_percentage, lower_bound, upper_bound; columns independent."""
    cols = cols or numeric_columns(df, numeric)
    if not cols:
        raise ValueError("no numeric columns to check")
    quartiles = quantile_values(df, cols, [0.25, 0.75], row_limit) if method == "exact" else approx_values(
        df, cols, [0.25, 0.75]
    )
    bounds = {c: fences(*quartiles[c], k) for c in cols}
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(_outside(value_of(df, c), *bounds[c])).alias(f"o{i}") for i, c in enumerate(cols)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"o{i}").alias("outlier_count"),
            percent(F.col(f"o{i}"), F.col("n")).alias("outlier_percentage"),
            F.lit(bounds[c][0]).cast("double").alias("lower_bound"),
            F.lit(bounds[c][1]).cast("double").alias("upper_bound"),
        )
        for i, c in enumerate(cols)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _outside(c: Column, low: float | None, high: float | None) -> Column:
    return F.lit(False) if low is None else (c < low) | (c > high)


def sample(df: DataFrame, n: int = 5, order_by: list[str] | str | None = None) -> tuple[DataFrame, DataFrame]:
    """First and last ``n`` rows by ``order_by`` (default: all columns), the last ones in order too."""
    order = total_order(df, as_list(order_by))
    head = df.orderBy(*nulls_last(order)).limit(n)
    backwards = [c.desc_nulls_first() for c in (col(o) for o in order)]
    tail = df.orderBy(*backwards).limit(n).orderBy(*nulls_last(order))
    return head, tail


def profile_table(df: DataFrame, numeric: str = "strict", row_limit: int = ROW_LIMIT) -> DataFrame:
    """The profile as rows: column, metric, value."""
    df = nan_to_null(df)
    cols = numeric_columns(df, numeric)
    quartiles = quantile_values(df, cols, PROBS, row_limit)
    measures = {(c, "null_count"): F.count_if(col(c).isNull()).cast("double") for c in df.columns}
    for c in cols:
        measures[c, "count"] = F.count(col(c)).cast("double")
        measures[c, "mean"] = F.avg(col(c))
        measures[c, "std"] = F.stddev_samp(col(c))
        measures[c, "min"] = F.min(col(c)).cast("double")
        for p, value in zip(PROBS, quartiles[c]):
            measures[c, f"p{int(p * 100)}"] = F.first(F.lit(value).cast("double"))
        measures[c, "max"] = F.max(col(c)).cast("double")
    wide = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures.values())])
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(metric).alias("metric"), F.col(f"m{i}").alias("value"))
        for i, (c, metric) in enumerate(measures)
    ]
    return wide.select(F.inline(F.array(*rows)))


def inspect(df: DataFrame, config: dict | None = None, facts: Facts | None = None) -> dict:
    """The whole profile as a dictionary."""
    require_frame(df, "inspect")
    config = config or {}
    df = nan_to_null(df)
    cols = numeric_columns(df, config.get("numeric", "strict"))
    wants_corr = config.get("include_correlations", False) and len(cols) > 1
    if facts is None or (wants_corr and not facts.correlations):
        facts = gather(df, cols, wants_corr)
    row_limit = config.get("row_limit", ROW_LIMIT)
    quartiles = quantile_values(df, cols, PROBS, row_limit)
    n = min(config.get("sample_size", 5), facts.rows)
    head, tail = sample(df, n, config.get("order_by"))
    nulls = facts.nulls
    result = {
        "basic_info": {
            "rows": facts.rows,
            "columns": len(df.columns),
            "memory_usage_mb": facts.bytes / 1024 / 1024,
            "column_names": df.columns,
        },
        "summary_stats": {
            c: {
                **{s: facts.stats[c][s] for s in ("count", "mean", "std", "min")},
                **dict(zip(("25%", "50%", "75%"), quartiles[c])),
                "max": facts.stats[c]["max"],
            }
            for c in cols
        },
        "null_analysis": {
            "null_counts": nulls,
            "null_percentages": {c: rounded(v, facts.rows) for c, v in nulls.items()},
            "columns_with_nulls": [c for c, v in nulls.items() if v > 0],
            "total_null_values": sum(nulls.values()),
        },
        "data_types": {f.name: legacy_type(f.dataType) for f in df.schema.fields},
        "sample_data": {
            "head": [r.asDict() for r in head.collect()],
            "tail": [r.asDict() for r in tail.collect()],
        },
    }
    if config.get("include_correlations", False):
        result["correlations"] = (
            {a: {b: facts.correlations[a, b] for b in cols} for a in cols} if wants_corr else {}
        )
    if config.get("include_duplicates", True):
        if facts.duplicates is None:
            facts.duplicates = duplicates(df, method=config.get("duplicate_method", "exact")).first().asDict()
        result["duplicates"] = {
            k: facts.duplicates[k] for k in ("duplicate_rows", "duplicate_percentage", "unique_rows")
        }
    if config.get("include_outliers", False):
        result["outliers"] = {}
        if cols:
            q13 = {c: (quartiles[c][0], quartiles[c][2]) for c in cols}
            bounds = {c: fences(*q13[c]) for c in cols}
            counted = df.agg(
                *[F.count_if(_outside(col(c), *bounds[c])).alias(f"o{i}") for i, c in enumerate(cols)]
            ).first()
            for i, c in enumerate(cols):
                result["outliers"][c] = {
                    "outlier_count": counted[f"o{i}"],
                    "outlier_percentage": rounded(counted[f"o{i}"], facts.rows),
                    "lower_bound": bounds[c][0],
                    "upper_bound": bounds[c][1],
                }
    return result


def rounded(part: int, whole: int) -> float | None:
    return round(part * 100.0 / whole, 2) if whole else None


def inspect_data(df: DataFrame, config: dict | None = None) -> dict:
    return inspect(df, config)
